"""Who is who: deterministic and fuzzy links between records, groups, and customer keys that last.

Records are (id, name, country, address, email); equal ids are one record.  Two
records are linked at once if they share an e-mail address, or name, country and
address.  Others are compared where they share their country and the sound of any
word of their names: a Jaro-Winkler similarity of the names of at least 0.92 and
an overlap of the addresses' words of at least 0.8 make a match, whose confidence
says whether it counts at once (from 0.95) or a steward decides (from 0.80).
What a steward has decided wins.  Groups of linked records are customers; a
customer's key is made from its first record once, and kept in a cross-reference
from then on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import written
from .components import connected

# What makes a match, and what makes it certain.
NAME_LEAST, OVERLAP_LEAST, AUTO, REVIEW = 0.92, 0.8, 0.95, 0.80

# Letters with marks, and those letters without.
MARKED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝŸŠŽŁŚŹŻĆŃĄĘĞİŞČĎĚŇŘŤŮ"
UNMARKED = "AAAAAACEEEEIIIINOOOOOOUUUUYYSZLSZZCNAEGISCDENRTU"

#: Names of a block compared with one another in one task.
BLOCK = 512


def standard(text: Column | str) -> Column:
    """Upper case without marks, punctuation and extra blanks; null if nothing is left."""
    upper = F.translate(F.upper(F.col(text) if isinstance(text, str) else text), MARKED, UNMARKED)
    return F.nullif(F.trim(F.regexp_replace(F.regexp_replace(upper, "[^A-Z0-9 ]+", " "), " +", " ")), F.lit(""))


def sorted_words(text: Column) -> Column:
    """The words in alphabetical order, so that first and last name may change places."""
    return F.array_join(F.array_sort(F.split(text, " ")), " ")


def standardized(records: DataFrame) -> DataFrame:
    """One row a record: id, name (words sorted), country, address, email, all in standard form; of repeated ids the greatest values stay."""
    email = F.lower(F.trim("email"))
    rows = records.where("id IS NOT NULL").select("id", sorted_words(standard("name")).alias("name"), F.upper(F.trim("country")).alias("country"), standard("address").alias("address"), F.when(F.contains(email, F.lit("@")), email).alias("email"))
    return rows.groupBy("id").agg(F.max_by(F.struct("name", "country", "address", "email"), F.struct("name", "country", "address", "email")).alias("r")).select("id", "r.*")


def exact_links(records: DataFrame) -> DataFrame:
    """(u, v, rule) of standardized records that share an address to write to, or name, country and address: each with the first of its kind, so a value that many share costs one link a record."""
    out = None
    for rule, by in (("email", ["email"]), ("name", ["name", "country", "address"])):
        some = records.dropna(subset=by)
        first = some.groupBy(*by).agg(F.min("id").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        own = some.join(first, by).where("id <> v").select(F.col("id").alias("u"), "v", F.lit(rule).alias("rule"))
        out = own if out is None else out.unionByName(own)
    return out


def jaro_winkler(a: str, b: str) -> float:
    """Similarity of two strings, 1 for equal ones; common first letters, four at most, count more."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(len(a), len(b)) // 2 - 1
    taken = [False] * len(b)
    mine = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                mine.append(c)
                break
    m = len(mine)
    if not m:
        return 0.0
    swapped = sum(x != y for x, y in zip(mine, (c for c, hit in zip(b, taken, strict=True) if hit), strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    common = 0
    while common < min(4, len(a), len(b)) and a[common] == b[common]:
        common += 1
    return jaro + 0.1 * common * (1 - jaro) if jaro > 0.7 else jaro


def _letters(names: list[str]) -> np.ndarray:
    """How often each name has each letter, digit and blank."""
    out = np.zeros((len(names), 64), np.int16)
    for i, name in enumerate(names):
        at, often = np.unique(np.frombuffer(name.encode(), np.uint8) & 63, return_counts=True)
        out[i, at] = often
    return out


def close_names(left: list[str], right: list[str], least: float) -> list[tuple[int, int, float]]:
    """Pairs of names with at least that similarity.

    A pair's matches can't outnumber the letters that both have, which bounds the
    similarity; only pairs that can reach ``least`` are compared letter by letter.
    """
    found = []
    a, b = _letters(left), _letters(right)
    m, n = a.sum(axis=1), b.sum(axis=1)
    for i in range(len(left)):
        both = np.minimum(a[i], b).sum(axis=1)
        jaro = np.where(both > 0, (both / max(m[i], 1) + both / np.maximum(n, 1) + 1) / 3, 0)
        for j in np.flatnonzero(jaro + 0.4 * (1 - jaro) >= least - 1e-9).tolist():
            if (s := jaro_winkler(left[i], right[j])) >= least:
                found.append((i, j, s))
    return found


def _compared(least: float):
    """(l, r, score) of the pairs of names of one task: of its part of a block with itself (side 0), or of one part with another (1 and 2)."""

    def run(table: pa.Table) -> pa.Table:
        side, number, name = table.column("side").to_numpy(), table.column("n").to_numpy(), np.array(table.column("name").to_pylist(), object)
        x, y = np.flatnonzero(side < 2), np.flatnonzero(side == 2)
        own = side[0] == 0
        y = x if own else y
        pairs = [(number[x[i]], number[y[j]], s) for i, j, s in close_names(name[x].tolist(), name[y].tolist(), least) if not own or i < j]
        return pa.table({"l": pa.array([p[0] for p in pairs], pa.int64()), "r": pa.array([p[1] for p in pairs], pa.int64()), "score": pa.array([p[2] for p in pairs], pa.float64())})

    return run


def similar_names(names: DataFrame, least: float = NAME_LEAST, block: int = BLOCK) -> DataFrame:
    """(country, a, b, score), a < b, of distinct (country, name) that share the sound of a word and are so similar.

    Names are numbered and dealt to blocks of their sound; a block with many is
    split, and each pair of parts is one task's work, so no task grows with a
    common sound.  A pair with several common sounds comes out once.
    """
    distinct = written(names.dropna(subset=["country", "name"]).select("country", "name").distinct().withColumn("n", F.monotonically_increasing_id()))
    sounds = distinct.select("country", "n", "name", F.explode(F.array_distinct(F.transform(F.split("name", " "), F.soundex))).alias("sound"))
    sizes = sounds.groupBy("country", "sound").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"), F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows")
    dealt = sounds.join(sizes, ["country", "sound"]).withColumn("own", F.pmod(F.xxhash64("n"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    lo, hi = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(lo == hi, 0).when(F.col("own") == lo, 1).otherwise(2)
    tasks = dealt.select("country", "sound", lo.alias("lo"), hi.alias("hi"), side.alias("side"), "n", "name")
    pairs = tasks.groupBy("country", "sound", "lo", "hi").applyInArrow(_compared(least), "l long, r long, score double")
    pairs = pairs.select(F.least("l", "r").alias("l"), F.greatest("l", "r").alias("r"), "score").distinct()
    a, b = distinct.select(F.col("n").alias("l"), "country", F.col("name").alias("x")), distinct.select(F.col("n").alias("r"), F.col("name").alias("y"))
    return pairs.join(a, "l").join(b, "r").select("country", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "score")


def overlap(a: Column | str, b: Column | str) -> Column:
    """Share of two addresses' distinct words that both have; 0 if either is missing."""
    x, y = (F.array_distinct(F.split(F.col(c) if isinstance(c, str) else c, " ")) for c in (a, b))
    return F.coalesce(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)), F.lit(0.0))


def fuzzy_matches(records: DataFrame, name_least: float = NAME_LEAST, overlap_least: float = OVERLAP_LEAST) -> DataFrame:
    """(country, l_name, l_address, r_name, r_address, name_score, address_score, confidence, decision) of distinct standardized (name, country, address) that match.

    Confidence is the name's similarity, times half of one plus the addresses'
    overlap; ``decision`` is auto, review or distinct by it.
    """
    kinds = records.dropna(subset=["country", "name", "address"]).select("country", "name", "address").distinct()
    names = similar_names(kinds, name_least).unionByName(kinds.select("country", F.col("name").alias("a"), F.col("name").alias("b"), F.lit(1.0).alias("score")).distinct())
    own = lambda side, name: kinds.select("country", F.col("name").alias(name), F.col("address").alias(f"{side}_address"))
    # two sets of words with that overlap share one of the first of each, in any order that is the same for all
    def word(side: str) -> Column:
        every = F.array_sort(F.transform(F.array_distinct(F.split(f"{side}_address", " ")), lambda w: F.struct(F.xxhash64(w).alias("h"), w.alias("w"))))
        return F.explode(F.slice(every, 1, (F.size(every) - F.ceil(overlap_least * F.size(every) - 1e-9) + 1).cast("int"))["w"]).alias("word")

    l = names.join(own("l", "a"), ["country", "a"]).select("*", word("l"))  # noqa: E741
    r = own("r", "b").select("*", word("r"))
    met = l.join(r, ["country", "b", "word"]).where((F.col("a") < F.col("b")) | (F.col("l_address") < F.col("r_address"))).drop("word").distinct()
    share = overlap("l_address", "r_address")
    confidence = F.col("score") * (0.5 + 0.5 * share)
    scored = met.where(share >= overlap_least).select("country", F.col("a").alias("l_name"), "l_address", F.col("b").alias("r_name"), "r_address", F.round("score", 6).alias("name_score"), F.round(share, 6).alias("address_score"), F.round(confidence, 6).alias("confidence"))
    return scored.withColumn("decision", F.when(F.col("confidence") >= AUTO, "auto").when(F.col("confidence") >= REVIEW, "review").otherwise("distinct"))


def fuzzy_links(records: DataFrame, matches: DataFrame) -> DataFrame:
    """(u, v, confidence, decision): for each match the first records of its two kinds, as records of one kind are linked already."""
    by = ["country", "name", "address"]
    first = records.dropna(subset=by).groupBy(*by).agg(F.min("id").alias("id"))
    side = lambda p: first.select("country", F.col("name").alias(f"{p}_name"), F.col("address").alias(f"{p}_address"), F.col("id").alias(p))
    both = matches.join(side("l"), ["country", "l_name", "l_address"]).join(side("r"), ["country", "r_name", "r_address"])
    return both.select(F.greatest("l", "r").alias("u"), F.least("l", "r").alias("v"), "confidence", "decision")


def match_records(records: DataFrame, reviews: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(id, group_id) of every record, and the stewards' queue (u, v, confidence) of pairs still to be decided.

    ``reviews`` has (u, v, same: boolean), in either order: an accepted pair is
    linked and a rejected one isn't, whatever the rules say of that pair.
    """
    rows = written(standardized(records))
    links = fuzzy_links(rows, fuzzy_matches(rows)).select("u", "v", "confidence", "decision")
    links = links.unionByName(exact_links(rows).select("u", "v", F.lit(1.0).alias("confidence"), F.lit("auto").alias("decision")))
    if reviews is not None:
        decided = reviews.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), "same").groupBy("u", "v").agg(F.max("same").alias("same"))
        links = links.join(decided, ["u", "v"], "left_anti").unionByName(decided.where("same").select("u", "v", F.lit(1.0).alias("confidence"), F.lit("auto").alias("decision")))
    links = written(links.groupBy("u", "v").agg(F.max("confidence").alias("confidence"), F.min("decision").alias("decision")))
    groups = connected(links.where("decision = 'auto'"))
    out = rows.select("id").join(groups, F.col("id") == F.col("node"), "left").select("id", F.coalesce("least", "id").alias("group_id"))
    out = written(out)
    mine = lambda c: out.select(F.col("id").alias(c), F.col("group_id").alias(f"g_{c}"))
    queue = links.where("decision = 'review'").join(mine("u"), "u").join(mine("v"), "v").where("g_u <> g_v").select("u", "v", "confidence")
    return out, queue


def assign_keys(groups: DataFrame, xref: DataFrame | None = None, overrides: DataFrame | None = None) -> DataFrame:
    """The next cross-reference (id, customer_key) of records' groups (id, group_id).

    A group keeps the key that most of its records had (ties: the least key); a key
    that several groups would keep, as a group was split, stays with the group that
    has most of its records (ties: the least group).  A group without one gets the
    hash of its first record, told apart from keys in use.  ``overrides`` (id,
    customer_key) win over all of this, and are no evidence for the group's key.
    Records that are no longer there keep their row.
    """
    new = F.sha2(F.concat(F.lit("customer:"), F.col("group_id").cast("string")), 256)
    if xref is not None:
        names = groups.select("group_id").distinct()
        free = groups if overrides is None else groups.join(overrides.select("id"), "id", "left_anti")
        votes = free.join(xref, "id").groupBy("group_id", "customer_key").agg(F.count(F.lit(1)).alias("n"))
        wish = votes.groupBy("group_id").agg(F.min_by(F.struct("customer_key", "n"), F.struct(-F.col("n"), "customer_key")).alias("w")).select("group_id", "w.*")
        kept = wish.groupBy("customer_key").agg(F.min_by("group_id", F.struct(-F.col("n"), "group_id")).alias("group_id"))
        used = xref.select(F.col("customer_key").alias("used")).distinct()
        names = names.join(kept, "group_id", "left").withColumn("fresh", new).join(used, F.col("fresh") == F.col("used"), "left")
        again = F.sha2(F.concat(F.lit("again:"), "fresh", F.lit(":"), F.col("group_id").cast("string")), 256)
        names = names.select("group_id", F.coalesce("customer_key", F.when(F.col("used").isNotNull(), again).otherwise(F.col("fresh"))).alias("customer_key"))
        out = groups.join(names, "group_id").select("id", "customer_key")
    else:
        out = groups.select("id", new.alias("customer_key"))
    if overrides is not None:
        own = overrides.groupBy("id").agg(F.max("customer_key").alias("_own"))
        out = out.join(own, "id", "left").select("id", F.coalesce("_own", "customer_key").alias("customer_key"))
    if xref is not None:
        out = out.unionByName(xref.select("id", "customer_key").join(groups.select("id"), "id", "left_anti"))
    return out
