import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from tidewater.operators import matching
from tidewater.operators.components import connected

SCHEMA = "id long, name string, country string, address string, email string"
FIRST, LAST = "ANNA ELSAMA JORDAN MARTHA MÉNI OLÖF".split(), "BERLEYBEREZ GUKOORLEY STRÖMBEREZ HAMGULO WARTHON".split()


def people(seed, n):
    """Records of invented people, some written again with typos, swapped or marked names."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        if out and rng.random() < 0.5:
            _, name, country, address, email = rng.choice(out)
            kind = rng.randrange(5)
            if kind == 0 and len(name) > 3:
                at = rng.randrange(len(name) - 1)
                name = name[:at] + name[at + 1] + name[at] + name[at + 2 :]
            elif kind == 1:
                name = " ".join(reversed(name.split()))
            elif kind == 2:
                name, email = name.lower().replace(" ", "  "), None
            elif kind == 3:
                address = address + "."
        else:
            name, country = f"{rng.choice(FIRST)} {rng.choice(LAST)}{rng.choice('AEIO')}", rng.choice(["DE", "FR", None])
            address, email = f"{rng.randint(1, 9)} Main Street {rng.choice(['Ilar', 'Arvik'])}", rng.choice([None, f"p{i}@x.example", "not an address"])
        out.append((i, name, country, address, email))
    return out


def plain_matches(kinds):
    """All pairs of (country, name, address) that match, by comparing every pair."""
    sound = {}

    def sounds(name):
        return {sound_of(w) for w in name.split()}

    def sound_of(w):
        if w not in sound:
            codes = dict(zip("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "01230127022455012623017202", strict=True))
            out, last = w[0], codes.get(w[0], "0")
            for c in w[1:]:
                code = codes.get(c, "0")
                if code == "7":
                    continue
                if code != "0" and code != last:
                    out += code
                last = code
            sound[w] = (out + "000")[:4]
        return sound[w]

    found = set()
    for (c1, n1, a1), (c2, n2, a2) in combinations(sorted(kinds, key=lambda k: (k[0], k[1], k[2])), 2):
        if c1 != c2 or not sounds(n1) & sounds(n2):
            continue
        s = matching.jaro_winkler(n1, n2)
        x, y = set(a1.split()), set(a2.split())
        share = len(x & y) / len(x | y)
        if s >= 0.92 and share >= 0.8:
            found.add((c1, n1, a1, n2, a2, round(s, 6), round(share, 6)))
    return found


def test_jaro_winkler_has_its_known_values():
    for a, b, s in [("MARTHA", "MARHTA", 0.961111), ("DIXON", "DICKSONX", 0.813333), ("DWAYNE", "DUANE", 0.84), ("ABC", "XYZ", 0.0), ("", "", 1.0), ("A", "", 0.0), ("SAME", "SAME", 1.0)]:
        assert matching.jaro_winkler(a, b) == pytest.approx(s, abs=1e-6) and matching.jaro_winkler(b, a) == pytest.approx(s, abs=1e-6)


def test_no_close_pair_is_lost_by_the_bound():
    rng = random.Random(9)
    names = ["".join(rng.choices("ABCD ", k=rng.randint(1, 9))) for _ in range(150)]
    want = {(i, j) for i, a in enumerate(names) for j, b in enumerate(names) if matching.jaro_winkler(a, b) >= 0.9}
    assert {(i, j) for i, j, _ in matching.close_names(names, names, 0.9)} == want


def test_u_is_a_vowel_and_v_sounds_like_b(spark):
    """As in Soundex: the first pair shares A515 by its V, the second doesn't share a sound, as U has no digit."""
    names = spark.createDataFrame([("D", "ANVINI VICGUKOSTROM"), ("D", "ANVINIAVICGUKOSTROM"), ("F", "ELOLLU MALOLOSTROM"), ("F", "ELOLLUMALOLOSTROM")], "country string, name string")
    assert [(r["a"], r["b"]) for r in matching.similar_names(names).collect()] == [("ANVINI VICGUKOSTROM", "ANVINIAVICGUKOSTROM")]


@pytest.mark.parametrize("block", [512, 3])
def test_matches_are_those_of_all_pairs(spark, block, monkeypatch):
    rows = matching.standardized(spark.createDataFrame(people(block, 160), SCHEMA))
    kinds = {(r["country"], r["name"], r["address"]) for r in rows.collect() if None not in (r["country"], r["name"], r["address"])}
    names = matching.similar_names
    monkeypatch.setattr(matching, "similar_names", lambda df, least: names(df, least, block))
    columns = ("country", "l_name", "l_address", "r_name", "r_address", "name_score", "address_score")
    got = {tuple(r[c] for c in columns) for r in matching.fuzzy_matches(rows).collect()}
    assert got == plain_matches(kinds) and len(got) > 5


def test_groups_and_queue(spark):
    rows = [
        (1, "Elsama Berleyberez", "11", "Coraril", "e@x.example"), (2, "BERLEYBEREZ, Elsama", "11", "coraril", None), (3, "Elsmaa Berleyberez", "11", "Coraril", None), (4, "Elsama Berleyberez", "12", "Coraril", None),
        (5, "Someone Else", "11", "Coraril", "E@X.example "), (6, None, None, None, None), (7, "Anna", None, "Coraril", None), (7, "Anna", None, "Coraril", None), (None, "Elsama Berleyberez", "11", "Coraril", None), (8, "Elsma Berlyberez", "11", "Coraril", None),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x"))
    groups, queue = matching.match_records(df)
    told = lambda g: {r["id"]: r["group_id"] for r in g.collect()}
    assert told(groups) == {1: 1, 2: 1, 3: 1, 4: 4, 5: 1, 6: 6, 7: 7, 8: 8}
    pairs = {(r["u"], r["v"]) for r in queue.collect()}
    assert pairs and all(8 in p for p in pairs)
    same = spark.createDataFrame([(1, 8, True), (5, 1, False), (4, 1, True)], "u long, v long, same boolean")
    groups, queue = matching.match_records(df, same)
    assert told(groups) == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 6, 7: 7, 8: 1} and queue.collect() == []
    assert matching.match_records(df.limit(0))[0].collect() == []


def test_keys_outlive_reruns_merges_and_splits(spark):
    def keys(groups, xref=None, overrides=None):
        df = lambda rows, schema: spark.createDataFrame(rows, schema)
        out = matching.assign_keys(df(list(groups.items()), "id long, group_id long"), xref and df(list(xref.items()), "id long, customer_key string"), overrides and df(list(overrides.items()), "id long, customer_key string"))
        return {r["id"]: r["customer_key"] for r in out.collect()}

    first = keys({1: 1, 2: 1, 3: 3, 4: 3, 5: 3})
    assert first[1] == first[2] != first[3] == first[5]
    assert keys({1: 1, 2: 1, 3: 3, 4: 3, 5: 3}, first) == first
    # a record with a smaller number joins: the key stays, though the group's first record is another
    assert keys({0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 3}, first) == first | {0: first[1]}
    # merged: the key that most had; split again: most of it keeps the key, the rest gets one of its own
    one = keys({i: 1 for i in range(1, 6)}, first)
    assert set(one.values()) == {first[3]}
    two = keys({1: 1, 2: 1, 3: 3, 4: 3, 5: 3}, one)
    assert two[3] == first[3] and two[1] == two[2] != two[3]
    # a record that is gone keeps its row; a steward's word wins, and isn't evidence for the rest
    assert keys({1: 1}, first)[4] == first[4]
    assert keys({1: 1, 2: 1, 3: 3}, first, {2: "K"}) == {1: first[1], 2: "K", 3: first[3], 4: first[4], 5: first[5]}


def test_components(spark):
    rng = random.Random(3)
    chain = [(f"n{i:03}", f"n{i + 1:03}") for i in range(40)]
    star = [("a", f"s{i}") for i in range(50)]
    links = chain + star + [("x", "x"), ("y", "z"), ("y", "z"), (None, "q")]
    rng.shuffle(links)
    got = {r["node"]: r["least"] for r in connected(spark.createDataFrame(links, "p string, q string"), "p", "q").collect()}
    assert got == {f"n{i:03}": "n000" for i in range(41)} | {f"s{i}": "a" for i in range(50)} | {"a": "a", "y": "y", "z": "y"}
    assert connected(spark.createDataFrame([], "u long, v long")).collect() == []


def test_clients_are_told_apart_by_and_large(spark):
    """Against the tables' own word on who is who: nobody is merged wrongly by name."""
    clients = spark.read.parquet(f"{DATA}/clients.parquet")
    records = clients.select(F.col("client_id").alias("id"), "name", F.col("nation_id").cast("string").alias("country"), F.col("city").alias("address"), F.lit(None).cast("string").alias("email"))
    groups, _ = matching.match_records(records)
    truth = {r["client_id"]: r["master_id"] for r in clients.collect()}
    got = {r["id"]: r["group_id"] for r in groups.collect()}
    wrong = [i for i, g in got.items() if truth[i] != truth[g]]
    linked = [i for i, g in got.items() if i != g]
    assert linked and len(wrong) <= 0.05 * len(linked)
