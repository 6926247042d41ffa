"""Contract-aware chunks of documents.

A text is cut at the strongest boundary it has: articles, sections, recitals,
numbered clauses, paragraphs, lines, sentences, words, and at last anywhere.
Neighbouring pieces are put together again up to the target size, and each chunk
starts with the end of the one before it.

The text itself is never cut up: a work list of spans (offsets) is divided until
all fit, which gives a row of atoms, and one pass over the atoms makes the chunks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import estimate_tokens

CHARS_PER_TOKEN = 4

# Boundaries, strongest first; the look-ahead ones leave a heading with its text.
BOUNDARIES = [re.compile(p) for p in (r"(?=\n\s*ARTICLE\b)", r"(?=\n\s*SECTION\b)", r"(?=\n\s*WHEREAS\b)", r"(?=\n\s*NOW,?\s+THEREFORE\b)", r"(?=\n\s*\d+\.\s)", r"\n\s*\n", r"\n", r"(?<=[.?!])\s+", r"\s+")]
NOT_BLANK = re.compile(r"\S")


def divided(text: str, lo: int, hi: int, rank: int, most: int) -> tuple[list[tuple[int, int]], int]:
    """Spans that aren't blank between the strongest boundaries, from ``rank`` on, that leave several; and the next rank."""
    for level in range(rank, len(BOUNDARIES)):
        # the end of one part and the start of the next; what stands before a span is no part of it
        marks = [(m.start(), m.end()) for m in BOUNDARIES[level].finditer(text, lo, hi) if m.start() > lo or level != 7]
        spans = [(a, b) for a, b in zip([lo, *(e for _, e in marks)], [*(s for s, _ in marks), hi], strict=True) if NOT_BLANK.search(text, a, b)]
        if len(spans) > 1:
            return spans, level + 1
    return [(a, min(a + most, hi)) for a in range(lo, hi, most)], len(BOUNDARIES)


def atoms(text: str, most: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, group) of spans of at most ``most`` characters, in order; those of a group come from one division."""
    group = count()
    todo = [(0, len(text), 0, next(group))]
    while todo:
        lo, hi, rank, own = todo.pop()
        if hi - lo <= most:
            yield lo, hi, own
        else:
            spans, deeper = divided(text, lo, hi, rank, most)
            own = next(group)
            todo += [(a, b, deeper, own) for a, b in reversed(spans)]


def pieces(text: str, most: int) -> Iterator[str]:
    """Stripped texts of as many neighbouring atoms of a group as fit into ``most`` characters."""
    start: list[tuple[int, int]] = []
    size, group = 0, -1
    for lo, hi, own in (*atoms(text, most), (0, 0, -1)):
        if start and (own != group or size + hi - lo > most):
            whole = "".join(text[a:b] for a, b in start).strip()
            if whole:
                yield whole
            start, size = [], 0
        group, size = own, size + hi - lo
        start.append((lo, hi))


def chunks(text: str | None, target_tokens: int = 1000, overlap_tokens: int = 150) -> list[str]:
    """Chunks of a text; each but the first begins with whole words from the end of the piece before it."""
    plain = list(pieces(text or "", target_tokens * CHARS_PER_TOKEN))
    back = overlap_tokens * CHARS_PER_TOKEN
    if back <= 0:
        return plain
    # the words after the first space of the piece's last characters
    ends = [p[-back:].partition(" ")[2] if " " in p[-back:] else p[-back:] for p in plain]
    return plain[:1] + [f"{end} {own}".strip() for end, own in zip(ends, plain[1:], strict=False)]


def chunk_documents(docs: DataFrame, key: str, text: str = "text", target_tokens: int = 1000, overlap_tokens: int = 150) -> DataFrame:
    """(key, chunk_seq, chunk_text, chunk_id, token_estimate): a map over whole documents, nothing is shuffled."""

    def run(batches):
        for b in batches:
            keys, seqs, texts = [], [], []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = chunks(t, target_tokens, overlap_tokens)
                keys += [k] * len(own)
                seqs += range(len(own))
                texts += own
            yield pa.RecordBatch.from_arrays([pa.array(keys, b.column(0).type), pa.array(seqs, pa.int32()), pa.array(texts, pa.string())], names=["k", "chunk_seq", "chunk_text"])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(key, text).mapInArrow(run, f"k {kind}, chunk_seq int, chunk_text string").withColumnRenamed("k", key)
    return out.withColumn("chunk_id", chunk_id(key, "chunk_seq")).withColumn("token_estimate", estimate_tokens("chunk_text"))


def chunk_id(file: str, seq: str):
    """A chunk's key: SHA-256 of ``file:seq``."""
    return F.sha2(F.concat(F.col(file).cast("string"), F.lit(":"), F.col(seq).cast("string")), 256)
