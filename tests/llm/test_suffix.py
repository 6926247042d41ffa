import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.llm import suffix


def brute(texts: dict[int, str | None], n: int) -> dict[int, tuple]:
    seen, out = set(), {}
    for d in sorted(texts):
        b = (texts[d] or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1):
            w = b[p : p + n]
            if w in seen:
                gone[p : p + n] = b"\1" * n
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[d] = (len(b), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(kept).hexdigest())
    return out


def found(spark, texts, n, **options):
    rows = suffix.remove_repeats(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), n, **options).collect()
    return {r["doc_id"]: (r["n_bytes"], sum(x["end"] - x["start"] for x in r["removed"]), len(r["removed"]), hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in rows}


def made(seed: int) -> dict[int, str | None]:
    r = np.random.default_rng(seed)
    words = ["le", "thing", "été", "a", "of", "stone", "ab" * 7]
    say = lambda n: " ".join(r.choice(words, n))
    shared, texts = say(60), {}
    for i in range(40):
        kind = i % 5
        texts[int(i * 3 + 1)] = [say(int(r.integers(0, 80))), say(10) + shared + say(9), shared, "x" * int(r.integers(0, 400)), None][kind]
    texts[500] = texts[4]
    return texts


@pytest.mark.parametrize("options", [{}, {"hot": 1}])
def test_against_brute_force(spark, options):
    texts = made(len(options))
    assert found(spark, texts, 20, **options) == brute(texts, 20)


def test_segments_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix, "SEGMENT", 1000)
    text = "".join(np.random.default_rng(5).choice(list("abcdefgh"), 2500))
    texts = {1: text, 2: text[300:2200] + "tail", 3: "z" * 3000}
    rows = list(suffix._emit_anchors(100, 24)(iter([_batch(texts)])))
    assert rows
    assert found(spark, texts, 100) == brute(texts, 100)


def _batch(texts):
    import pyarrow as pa

    return pa.RecordBatch.from_pydict({"doc_id": list(texts), "text": list(texts.values())})


def test_empty_table_and_extra_columns(spark):
    assert suffix.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    df = spark.createDataFrame([(1, "k", "y" * 150, 7), (2, "k", "y" * 150, 8), (None, "n", "y" * 150, 9)], "doc_id long, kept string, text string, lo int")
    rows = {r["lo"]: r for r in suffix.remove_repeats(df).collect()}
    # one document's own repeats count too: all but the first 100 bytes' first byte starts earlier
    assert [len(rows[k]["removed"]) for k in (7, 8, 9)] == [1, 1, 0]
    assert rows[8]["kept"] == b""


def test_repeated_rows_keep_the_first_occurrence(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    assert [r["removed"] for r in suffix.remove_repeats(df).collect()] == [[], []]


def test_whole_characters(spark):
    a, b = "é" * 30 + "q" * 80, "x" + "é" * 30 + "q" * 80
    rows = suffix.remove_repeats(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string"), 101, characters=True).collect()
    for r in rows:
        bytes(r["kept"]).decode()


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=0, max_size=80), st.lists(st.integers(0, 60), max_size=40))
def test_msd_groups(data, starts):
    n = 12
    starts = np.array([s for s in starts if s + n <= len(data)], np.int64)
    buf = np.frombuffer(data, np.uint8)
    group = suffix.msd_groups(buf, starts, np.zeros(len(starts), np.int64), n)
    windows = [data[s : s + n] for s in starts]
    for i in range(len(starts)):
        assert (group[i] >= 0) == (windows.count(windows[i]) > 1)
        for j in range(i):
            if group[i] >= 0 and group[j] >= 0:
                assert (group[i] == group[j]) == (windows[i] == windows[j])


def test_pieces_hold_each_window_once():
    import pyarrow as pa

    n, gram, r = 20, 8, np.random.default_rng(1)
    sizes, backs = [31, 24, 20, 28], [12, 9, 0, 11]
    texts = [bytes(r.integers(97, 99, k).astype(np.uint8)) for k in sizes]
    batch = pa.RecordBatch.from_arrays([pa.array([1] * 4), pa.array(range(4)), pa.array([5] * 4), pa.array(backs, pa.int32()), pa.array(texts, pa.binary()), pa.array([True] * 4)], names=["a", "doc", "lo", "back", "ctx", "every"])
    rows = [x for b in suffix._emit_pieces(n, gram, 3)(iter([batch])) for x in b.to_pylist()]
    held = [(x["doc"], x["lo"] + i, x["back"] - i, x["key"]) for x in rows for i in range(len(x["ctx"]) - n + 1)]
    assert sorted(h[:2] for h in held) == [(d, 5 + i) for d in range(4) for i in range(sizes[d] - n + 1)]
    assert all(x["ctx"] == texts[x["doc"]][x["lo"] - 5 :][: len(x["ctx"])] for x in rows)
    # equal windows at one distance are under one key
    keys = {}
    for d, p, left, key in held:
        assert keys.setdefault((texts[d][p - 5 : p - 5 + n], left), key) == key


@pytest.mark.parametrize("few,hot", [(0, 1), (20_000, 8), (20_000, 2_000)])
def test_common_anchors_are_dealt_out_by_their_neighbours(spark, monkeypatch, few, hot):
    for name, value in {"SAMPLED": 1, "COMMON": 2, "SALTS": 3, "FEW_WINDOWS": few}.items():
        monkeypatch.setattr(suffix, name, value)
    texts = made(3) | {700 + i: f"{i * 91} before: " + "a sentence that many texts share, of some length, with other words on both sides of it" + f" after: {i * 53}" for i in range(40)} | {900 + i: "the same licence line before all of them, " + f"text {i * 37}" for i in range(60)}
    assert found(spark, texts, 20, hot=hot) == brute(texts, 20)
    assert found(spark, texts, 60, hot=hot) == brute(texts, 60)


def test_columns_with_the_names_of_steps_are_kept(spark):
    df = spark.createDataFrame([(i, "y" * 150, f"r{i}", f"d{i}") for i in range(3)], "doc_id long, text string, _runs string, _doc string")
    assert {(r["doc_id"], r["_runs"], r["_doc"]) for r in suffix.remove_repeats(df).collect()} == {(i, f"r{i}", f"d{i}") for i in range(3)}
