"""Exact removal of repeated substrings by a depth-limited radix sort of suffixes.

A byte goes if it lies in a string of ``threshold`` bytes that also starts
earlier.  Suffixes need to be ordered only through their first ``threshold``
bytes: those that are still together then are the repeated windows.  The sort
goes by most significant digits, and its first digits deal the work out:

1. *Anchor digit.*  Every window of ``threshold`` bytes holds ``w`` grams of
   ``gram`` bytes; the least by hash (leftmost of ties) is its anchor.  Equal
   windows have equal anchors at equal places, so suffixes with different
   anchors can't be equal and only one row per anchor is dealt out, not one per
   suffix (about ``2 / (w + 1)`` rows a byte).
2. *Context digit.*  The windows that share one anchor occurrence cover one
   span of bytes.  Where two such spans are equal, all their suffixes are equal
   groups at once; where an anchor has a single context, there is nothing to
   sort.
3. *Byte digits.*  Only suffixes of anchors with several different contexts are
   left.  Their bytes are fetched and sorted, eight bytes to a digit, from the
   most significant on; groups of one drop out of each pass
   (:func:`msd_groups`).  An anchor with more than ``hot`` contexts is dealt
   out once more, by the eight bytes on either side of it.  Windows that don't
   reach so far, and contexts that share these bytes with more than ``hot`` others,
   go by pieces: some neighbouring windows of a context, under the bytes that all
   of these have in common.  Equal pieces are equal groups at once; only of pieces
   that are still more than ``hot`` under one key each window goes by the hashes of
   its halves.

Gram and context digits are 64-bit hashes each, so that two spans count as equal
only if both 64-bit values agree.

Nulls and empty texts have no windows.  Texts under ``threshold`` bytes are
kept whole.  ``doc_id`` must be unique and not null: rows without one are kept
and never a source (they have no place in the order).  Columns other than
``doc_id`` and ``text`` are ignored, or returned unchanged by
:func:`remove_repeats`.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..staging import reclaim, written
from .components import join_hot
from .tables import unused
from .textbuf import BASE, BYTE_VALUE, U64, Prefix, blocks, flat, mix64, powers, tidy

#: Bytes handled at a time; a longer text is cut into overlapping segments.
SEGMENT = (1 << 20) - (1 << 13)
#: Low bits of a sliding-minimum key that hold the position.
PLACE_BITS = 24
#: One text in SAMPLED tells which anchors are common: those it has at least COMMON times, MOST_COMMON of them.
SAMPLED, COMMON, MOST_COMMON = 64, 64, 1000
#: A common anchor's contexts are dealt out to so many keys.
SALTS = 4096
#: From so many hot windows on, those with more than a thousandth of them stay out of the shuffle.
FEW_WINDOWS = 20_000


def anchors(buf: np.ndarray, offsets: np.ndarray, threshold: int, gram: int):
    """Row, anchor position, first and last window start, anchor hash and context hash of each anchor occurrence in one buffer (under 2**24 bytes)."""
    n = len(buf)
    none = np.zeros(0, np.int64)
    if n < threshold:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    value = BYTE_VALUE[buf]
    h, span = value, 1
    # a gram's hash, by doubling; the rest of a length that isn't a power of two overlaps
    while span * 2 <= gram:
        h = h[: len(h) - span] * U64(pow(BASE, span, 1 << 64)) + h[span:]
        span *= 2
    left = gram - span
    if left:
        h = h[: len(h) - left] * U64(pow(BASE, 97, 1 << 64)) + h[left:]
    h = mix64(h)
    place = np.arange(len(h), dtype=np.uint64)
    low = (h & U64((~((1 << PLACE_BITS) - 1)) & (2**64 - 1))) | place
    w, span = threshold - gram + 1, 1
    while span * 2 <= w:
        low = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    if span < w:
        low = np.minimum(low[: len(low) - (w - span)], low[w - span :])
    arg = (low & U64((1 << PLACE_BITS) - 1)).astype(np.int64)
    steps = np.zeros(len(arg) + 1, np.int32)
    s, e = offsets[:-1], offsets[1:] - threshold + 1
    ok = e > s
    np.add.at(steps, s[ok], 1)
    np.add.at(steps, e[ok], -1)
    at = np.flatnonzero(np.cumsum(steps[:-1]) > 0)
    if not len(at):
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    arg = arg[at]
    first = np.flatnonzero(np.r_[True, arg[1:] != arg[:-1]])
    last = np.r_[first[1:], len(arg)] - 1
    lo, hi, m = at[first], at[last], arg[first]
    rows = np.searchsorted(offsets, lo, "right") - 1
    c = Prefix(value).span(lo, hi + threshold)
    c = mix64(c + ((m - lo) * 4096 + (hi - lo)).astype(np.uint64) * U64(0xD6E8FEB86659FD93))
    return rows, m, lo, hi, h[m], c


def windows_of(data: np.ndarray, starts: np.ndarray, threshold: int, at: int) -> np.ndarray:
    """Eight bytes of each suffix from ``at`` on as one big-endian digit; zeros beyond ``threshold``."""
    take = min(8, threshold - at)
    raw = np.zeros((len(starts), 8), np.uint8)
    raw[:, :take] = data[(starts + at)[:, None] + np.arange(take)]
    return raw.view(">u8").ravel().astype(np.uint64)


def msd_groups(data: np.ndarray, starts: np.ndarray, group: np.ndarray, threshold: int) -> np.ndarray:
    """Radix sort of the suffixes at ``starts`` through ``threshold`` bytes, most significant digits first.

    ``group`` is the bucket of each suffix on entry.  Returns the bucket of each
    at the end (any numbers), or -1 for a suffix that shares its first
    ``threshold`` bytes with no other of its bucket.
    """
    out = np.full(len(starts), -1, np.int64)
    left = np.arange(len(starts))
    group = group.astype(np.int64)
    for at in range(0, threshold, 8):
        digit = windows_of(data, starts[left], threshold, at)
        order = np.lexsort((digit, group))
        g, d = group[order], digit[order]
        fresh = np.r_[True, (g[1:] != g[:-1]) | (d[1:] != d[:-1])] if len(order) else np.zeros(0, bool)
        number = np.cumsum(fresh) - 1
        stay = np.bincount(number)[number] > 1 if len(order) else fresh
        left, group = left[order[stay]], number[stay]
        if not len(left):
            break
    out[left] = group
    return out


A_SCHEMA = "a long, c long, doc long, at long, dup boolean"
X_SCHEMA = "a long, doc long, lo long, back int, ctx binary, hot boolean, key long"
P_SCHEMA = "key long, u long, doc long, lo long, back int, ctx binary"
R_SCHEMA = "doc long, lo long, hi long"


def _pack(m, lo, hi):
    """Anchor position, its distance from the first window and the number of further windows in one long."""
    return (m.astype(np.int64) << 24) | ((m - lo) << 12) | (hi - lo)


def _unpack(at):
    m, back, more = at >> 24, (at >> 12) & 4095, at & 4095
    return m, m - back, m - back + more


def _emit_anchors(threshold: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count = 0
        for block in blocks(batches, "text", SEGMENT):
            buf, offs = flat(block.column(1))
            ids = block.column(0).to_numpy(zero_copy_only=False)
            for base in range(0, max(len(buf) - threshold + 1, 1), SEGMENT):
                part = buf[base : base + SEGMENT + threshold - 1]
                cut = np.clip(offs - base, 0, len(part)) if base or len(part) < len(buf) else offs
                rows, m, lo, hi, a, c = anchors(part, cut, threshold, gram)
                shift = base - offs[rows]
                held.append((a, c, ids[rows], _pack(m + shift, lo + shift, hi + shift)))
                count += len(rows)
            if count >= 1 << 19:
                yield _combined(held)
                held, count = [], 0
        if count:
            yield _combined(held)

    return run


def _combined(held: list[tuple]) -> pa.RecordBatch:
    """One batch of anchor rows; those with an earlier equal context in the batch are marked and dealt out evenly."""
    a, c, doc, at = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((at, doc, c, a))
    a, c, doc, at = a[order], c[order], doc[order], at[order]
    head = np.r_[True, (a[1:] != a[:-1]) | (c[1:] != c[:-1])]
    lead = np.flatnonzero(head)[np.cumsum(head) - 1]
    dup = (doc != doc[lead]) | (at != at[lead])
    a = np.where(dup, mix64(doc.astype(np.uint64) * U64(BASE) + at.astype(np.uint64)), a)
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(c.view(np.int64)), pa.array(doc), pa.array(at), pa.array(dup)], names=["a", "c", "doc", "at", "dup"])


def _emit_contexts(threshold: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", SEGMENT * 4):
            buf, offs = flat(block.column(1))
            ids = block.column(0).to_numpy(zero_copy_only=False)
            found = block.column(2)
            rows = np.repeat(np.arange(len(ids)), np.diff(found.offsets.to_numpy()))
            flat_found = found.flatten()
            _, lo, hi = _unpack(flat_found.field(1).to_numpy())
            lo, hi = lo + offs[rows], hi + offs[rows] + threshold
            ok = hi <= offs[rows + 1]  # other texts may share a doc_id
            rows, lo, hi = rows[ok], lo[ok], hi[ok]
            raw = buf.tobytes()
            ctx = pa.array([raw[x:y] for x, y in zip(lo.tolist(), hi.tolist(), strict=True)], pa.binary())
            back = (flat_found.field(1).to_numpy()[ok] >> 12) & 4095
            is_hot = flat_found.field(2).to_numpy(zero_copy_only=False)[ok]
            out = [pa.array(flat_found.field(0).to_numpy()[ok]), pa.array(ids[rows]), pa.array(lo - offs[rows]), pa.array(back.astype(np.int32)), ctx, pa.array(is_hot), pa.array(_beside(buf, lo + back, gram, flat_found.field(0).to_numpy()[ok]))]
            for at in range(0, len(rows), 50_000):
                yield pa.RecordBatch.from_arrays([x.slice(at, 50_000) for x in out], names=["a", "doc", "lo", "back", "ctx", "hot", "key"])

    return run


def _beside(buf: np.ndarray, m: np.ndarray, gram: int, a: np.ndarray) -> np.ndarray:
    """A hash of an anchor and the eight bytes on either side of it."""
    last = max(len(buf) - 8, 0)
    left, right = (windows_of(buf, np.clip(x, 0, last), 8, 0) if len(m) else np.zeros(0, np.uint64) for x in (m - 8, m + gram))
    return mix64(mix64(a.view(np.uint64) + left * U64(BASE)) + right).view(np.int64)


def _inner(back: np.ndarray, step: np.ndarray, threshold: int, gram: int) -> np.ndarray:
    """Windows that reach eight bytes at least beyond their anchor on both sides."""
    left = back - step
    return (left >= 8) & (threshold - gram - left >= 8)


def _whole_groups(batches: Iterator[pa.RecordBatch], key: int, least: int) -> Iterator[pa.Table]:
    """Tables of about ``least`` rows that never split a run of equal keys; the input is sorted by the key."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= least:
            table = pa.Table.from_batches(held)
            keys = table.column(key).to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield table.slice(0, cut)
                held, rows = table.slice(cut).to_batches(), table.num_rows - cut
            least = max(least, 2 * rows) if not cut else least
    if rows:
        yield pa.Table.from_batches(held)


def _sort_buckets(threshold: int, inner: int = 0):
    """Runs of windows that also start earlier in their bucket, the first column; with ``inner`` (a gram's length), of inner windows only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, 0, 8_000):
            a, doc, lo, back = (table.column(i).to_numpy() for i in range(4))
            data, offs = flat(table.column(4).combine_chunks())
            n = np.diff(offs) - threshold + 1  # windows of each context
            rows = np.repeat(np.arange(len(a)), n)
            step = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
            if inner:
                stay = _inner(back[rows], step, threshold, inner)
                rows, step = rows[stay], step[stay]
            starts = offs[rows] + step
            # windows at different distances before the anchor can't be equal
            bucket = _bucket(a[rows], back[rows] - step)
            group = msd_groups(data, starts, bucket, threshold)
            keep = np.flatnonzero(group >= 0)
            order = keep[np.lexsort((lo[rows[keep]] + step[keep], doc[rows[keep]], group[keep]))]
            g, d, p = group[order], doc[rows[order]], lo[rows[order]] + step[order]
            head = np.r_[True, g[1:] != g[:-1]] if len(g) else np.zeros(0, bool)
            lead = np.flatnonzero(head)[np.cumsum(head) - 1]
            later = (d != d[lead]) | (p != p[lead])
            yield _runs(d[later], p[later])

    return run


def _bucket(a: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """A number for each pair of an anchor (sorted) and a distance under 4096."""
    number = np.cumsum(np.r_[False, a[1:] != a[:-1]]) if len(a) else a
    return number * 8192 + distance + 4096


def _runs(doc: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Window starts as (doc, lo, hi) of maximal runs."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    head = np.r_[True, (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)] if len(doc) else np.zeros(0, bool)
    first = np.flatnonzero(head)
    last = np.r_[first[1:], len(doc)] - 1 if len(first) else first
    return pa.RecordBatch.from_arrays([pa.array(doc[first]), pa.array(start[first]), pa.array(start[last])], names=["doc", "lo", "hi"])


def _emit_pieces(threshold: int, gram: int, size: int):
    """Windows of hot contexts in pieces: those of a context whose anchor is ``size * k`` to ``size * (k + 1) - 1`` bytes from their start.

    ``key`` is a hash of the bytes that all windows of such a piece have in common,
    ``u`` one of all its bytes.  Inner windows are left out unless the context's
    neighbours are common too.
    """
    last = threshold - gram  # the greatest distance

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "ctx", SEGMENT // 4):
            doc, lo, back = (block.column(i).to_numpy() for i in (1, 2, 3))
            every = block.column(5).to_numpy(zero_copy_only=False)
            data, offs = flat(block.column(4))
            n = np.diff(offs) - threshold + 1
            rows = np.repeat(np.arange(len(doc)), n)
            step = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
            stay = every[rows] | ~_inner(back[rows], step, threshold, gram)
            rows, step = rows[stay], step[stay]
            if not len(rows):
                continue
            nth = (back[rows] - step) // size
            head = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]) | (nth[1:] != nth[:-1]) | (step[1:] != step[:-1] + 1)])
            tail = np.r_[head[1:], len(rows)] - 1
            of, nth = rows[head], nth[head].astype(np.int64)
            start, end = offs[of] + step[head], offs[of] + step[tail] + threshold
            m = offs[of] + back[of]
            sums = Prefix(BYTE_VALUE[data])
            key = mix64(sums.span(m - nth * size, m + threshold - np.minimum(nth * size + size - 1, last)) + nth.astype(np.uint64) * U64(BASE))
            left = back[of] - step[head]
            u = mix64(sums.span(start, end) + (left.astype(np.int64) * 4096 + end - start).astype(np.uint64) * U64(BASE))
            raw = data.tobytes()
            ctx = pa.array([raw[x:y] for x, y in zip(start.tolist(), end.tolist(), strict=True)], pa.binary())
            out = [pa.array(key.view(np.int64)), pa.array(u.view(np.int64)), pa.array(doc[of]), pa.array(lo[of] + step[head]), pa.array(left.astype(np.int32)), ctx]
            for at in range(0, len(of), 50_000):
                yield pa.RecordBatch.from_arrays([x.slice(at, 50_000) for x in out], names=["key", "u", "doc", "lo", "back", "ctx"])

    return run


def _emit_windows(threshold: int):
    """Every window of crowded pieces under the hashes of its two halves, the digits it is dealt out by."""
    half = threshold // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "ctx", SEGMENT // 4):
            doc, lo = block.column(1).to_numpy(), block.column(2).to_numpy()
            data, offs = flat(block.column(4))
            n = np.diff(offs) - threshold + 1
            rows = np.repeat(np.arange(len(doc)), n)
            step = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
            starts = offs[rows] + step
            sums = Prefix(BYTE_VALUE[data])
            h1, h2 = (mix64(sums.span(starts + x, starts + y)).view(np.int64) for x, y in ((0, half), (half, threshold)))
            for at in range(0, len(rows), 100_000):
                z = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h1[z], h2[z], doc[rows[z]], lo[rows[z]] + step[z])], names=["h1", "h2", "doc", "p"])

    return run


def _merge_starts():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _runs(b.column(0).to_numpy(), b.column(1).to_numpy())

    return run


def _common_anchors(texts: DataFrame, threshold: int, gram: int) -> DataFrame:
    """(_a) of anchors that a sample of the texts has often, MOST_COMMON at most; it only says how rows are dealt out."""
    rows = texts.sample(1 / SAMPLED, 11).mapInArrow(tidy(_emit_anchors(threshold, gram)), A_SCHEMA).where("not dup")
    own = rows.groupBy("a").count().where(F.col("count") >= COMMON).orderBy(F.desc("count"), "a").limit(MOST_COMMON).collect()
    return texts.sparkSession.createDataFrame([(r["a"],) for r in own], "_a long")


def _crowded(rows: DataFrame, hot: int) -> DataFrame:
    """(_key) of keys with more than ``hot`` rows, MOST_COMMON at most; it only says how rows are dealt out."""
    return rows.groupBy("key").count().where(F.col("count") > hot).orderBy(F.desc("count"), "key").limit(MOST_COMMON).select(F.col("key").alias("_key"))


def repeated_windows(docs: DataFrame, threshold: int = 100, gram: int | None = None, hot: int = 2_000) -> DataFrame:
    """(doc, lo, hi): first and last start of runs of windows that also start earlier in ``docs`` (doc_id, text).

    Every window that starts earlier is in a run; runs of one text may touch or
    overlap.  ``threshold`` is from 16 to 4000 bytes.  Anchors with more than
    ``hot`` contexts are dealt out by their windows, and so are those that a sample
    shows to be common, so that no task holds all rows of one anchor.
    """
    if not 16 <= threshold <= 4000:
        raise ValueError("threshold must be from 16 to 4000 bytes")
    gram = gram or max(8, threshold // 4 - 1)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= threshold))
    rows = texts.mapInArrow(tidy(_emit_anchors(threshold, gram)), A_SCHEMA)
    common = F.broadcast(_common_anchors(texts, threshold, gram))
    rows = rows.join(common, F.col("a") == F.col("_a"), "left").withColumn("common", F.col("_a").isNotNull()).withColumn("salt", F.when(F.col("common"), F.pmod("c", F.lit(SALTS))).otherwise(0)).drop("_a")
    of_context = Window.partitionBy("a", "salt", "c").orderBy("doc", "at")
    of_anchor = Window.partitionBy("a", "salt")
    rows = rows.repartition("a", "salt").withColumn("nth", F.rank().over(of_context)).withColumn("kinds", F.sum(F.when((F.col("nth") == 1) & ~F.col("dup"), 1).otherwise(0)).over(of_anchor)).withColumn("one", (F.min("c").over(of_anchor) == F.max("c").over(of_anchor)) & ~F.col("common"))
    kinds = F.when(F.col("common"), hot + 1).otherwise(F.col("kinds")).alias("kinds")
    kept = written(rows.where(F.col("dup") | (F.col("nth") > 1) | ~F.col("one")).select("a", "doc", "at", (F.col("dup") | (F.col("nth") > 1)).alias("covered"), kinds))
    reclaim(docs.sparkSession)

    m, back, more = F.shiftright("at", 24), F.shiftright("at", 12).bitwiseAND(F.lit(4095)), F.col("at").bitwiseAND(F.lit(4095))
    whole = kept.where("covered").select("doc", (m - back).alias("lo"), (m - back + more).alias("hi"))
    open_rows = kept.where("not covered")
    asked = open_rows.groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list(F.struct("a", "at", (F.col("kinds") > hot).alias("hot"))).alias("found"))
    contexts = texts.join(asked.hint("shuffle_hash"), "doc_id").select("doc_id", "text", "found").mapInArrow(tidy(_emit_contexts(threshold, gram)), X_SCHEMA)
    if open_rows.where(F.col("kinds") > hot).limit(1).count():
        contexts = written(contexts)
        # of a hot anchor's windows, those beyond eight bytes on both sides are dealt out by these bytes, a row a context; the others, and all of contexts whose neighbours are hot again, by pieces
        again = _crowded(contexts.where("hot"), hot)
        flagged = contexts.where("hot").join(F.broadcast(again), F.col("key") == F.col("_key"), "left").withColumn("every", F.col("_key").isNotNull())
        beside = flagged.where("not every").select("key", "doc", "lo", "back", "ctx")
        whole = whole.unionByName(beside.repartition("key").sortWithinPartitions("key").mapInArrow(tidy(_sort_buckets(threshold, gram)), R_SCHEMA))
        size = max(1, isqrt(threshold - gram + 1))
        pieces = written(flagged.select("a", "doc", "lo", "back", "ctx", "every").mapInArrow(tidy(_emit_pieces(threshold, gram, size)), P_SCHEMA))
        # all windows of a piece that starts earlier too are covered; the first ones tell the rest
        heads = written(pieces.groupBy("key", "u").agg(F.min(F.struct("doc", "lo", "back", "ctx")).alias("first"), F.count(F.lit(1)).alias("rows")))
        firsts = heads.where("rows > 1").select("key", "u", F.struct("first.doc", "first.lo").alias("first"), "rows")
        places = pieces.select("key", "u", "doc", "lo", (F.col("lo") + F.octet_length("ctx") - threshold).alias("hi"))
        whole = whole.unionByName(join_hot(places, firsts, ["key", "u"], "rows", places.count(), few=FEW_WINDOWS).where(F.struct("doc", "lo") > F.col("first")).select("doc", "lo", "hi"))
        dealt = heads.select("key", "first.*").join(F.broadcast(_crowded(heads, hot)), F.col("key") == F.col("_key"), "left")
        few = dealt.where("_key IS NULL").select("key", "doc", "lo", "back", "ctx")
        whole = whole.unionByName(few.repartition("key").sortWithinPartitions("key").mapInArrow(tidy(_sort_buckets(threshold)), R_SCHEMA))
        wide = written(dealt.where("_key IS NOT NULL").select("key", "doc", "lo", "back", "ctx").mapInArrow(tidy(_emit_windows(threshold)), "h1 long, h2 long, doc long, p long"))
        firsts = wide.groupBy("h1", "h2").agg(F.min(F.struct("doc", "p")).alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
        later = join_hot(wide, firsts, ["h1", "h2"], "rows", wide.count(), few=FEW_WINDOWS).where(F.struct("doc", "p") > F.col("first")).select("doc", "p")
        whole = whole.unionByName(later.mapInArrow(tidy(_merge_starts()), R_SCHEMA))
        contexts = contexts.where("not hot")
    sorted_out = contexts.repartition("a").sortWithinPartitions("a").mapInArrow(tidy(_sort_buckets(threshold)), R_SCHEMA)
    return whole.unionByName(sorted_out)


def _cut(threshold: int, text_at: int, runs_at: int, characters: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", SEGMENT * 2):
            buf, offs = flat(block.column(text_at))
            runs = block.column(runs_at)
            has = runs.is_valid().to_numpy(zero_copy_only=False)
            lengths = np.where(has, runs.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0)
            rows = np.repeat(np.arange(block.num_rows), lengths)
            pairs = runs.flatten()
            steps = np.zeros(len(buf) + 1, np.int32)
            if len(rows):
                lo = np.minimum(pairs.field(0).to_numpy() + offs[rows], offs[rows + 1])
                hi = np.minimum(pairs.field(1).to_numpy() + threshold + offs[rows], offs[rows + 1])
                np.add.at(steps, lo, 1)
                np.add.at(steps, hi, -1)
            gone = np.cumsum(steps[:-1], dtype=np.int32) > 0
            if characters and len(buf):
                first = np.flatnonzero((buf & 0xC0) != 0x80)
                gone = np.repeat(np.minimum.reduceat(gone, first), np.diff(np.r_[first, len(buf)]))
            kept = buf[~gone]
            keep_at = np.r_[0, np.cumsum(~gone)][offs]
            # maximal runs of removed bytes, cut where a row ends
            edge = gone.copy()
            edge[1:] &= ~gone[:-1]
            inner = offs[:-1][(offs[:-1] < offs[1:])]
            edge[inner] = gone[inner]
            ends = gone.copy()
            ends[:-1] &= ~gone[1:]
            tail = offs[1:][(offs[:-1] < offs[1:])] - 1
            ends[tail] = gone[tail]
            s, e = np.flatnonzero(edge), np.flatnonzero(ends) + 1
            of = np.searchsorted(offs, s, "right") - 1
            counts = np.bincount(of, minlength=block.num_rows)
            spans = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.StructArray.from_arrays([pa.array(s - offs[of]), pa.array(e - offs[of])], names=["start", "end"]))
            left = pa.Array.from_buffers(pa.large_binary(), block.num_rows, [None, pa.py_buffer(keep_at.astype(np.int64).tobytes()), pa.py_buffer(kept.tobytes())]).cast(pa.binary())
            others = [x for i, x in enumerate(block.columns) if i != runs_at]
            names = [x for i, x in enumerate(block.schema.names) if i != runs_at]
            yield pa.RecordBatch.from_arrays([*others, pa.array(np.diff(offs)), left, spans], names=[*names, "n_bytes", "kept", "removed"])

    return run


def remove_repeats(docs: DataFrame, threshold: int = 100, characters: bool = False, **options) -> DataFrame:
    """``docs`` with ``n_bytes``, ``kept`` (binary: the bytes left) and ``removed`` (array of start and end, in bytes, of maximal removed runs).

    ``docs`` has doc_id and text; all its other columns come back unchanged,
    unless they bear one of the three new names.  A null text counts as empty.
    With ``characters``, a character of several bytes goes only if all of them do,
    so that what is kept is valid UTF-8.
    """
    rest = [c for c in docs.columns if c not in ("n_bytes", "kept", "removed")]
    docs = docs.select(*rest)
    own, found = unused(rest, "_doc"), unused(rest, "_runs")
    runs = repeated_windows(docs, threshold, **options)
    per_doc = runs.groupBy(F.col("doc").alias(own)).agg(F.collect_list(F.struct("lo", "hi")).alias(found))
    both = docs.join(per_doc.hint("shuffle_hash"), docs["doc_id"] == per_doc[own], "left").select(*[docs[c] for c in rest], per_doc[found])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return both.mapInArrow(tidy(_cut(threshold, rest.index("text"), len(rest), characters)), f"{kinds}, n_bytes long, kept binary, removed array<struct<start: long, end: long>>")
