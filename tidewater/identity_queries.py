"""Registered queries that say who is who among clients, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import matching
from .plans.registry import Context


def _records(ctx: Context) -> DataFrame:
    return ctx.read("clients").select(F.col("client_id").alias("id"), "name", F.col("nation_id").cast("string").alias("country"), F.col("city").alias("address"), "email")


def client_matches(ctx: Context) -> DataFrame:
    """Kinds of client records (name, nation, city) that match, with their scores."""
    return matching.fuzzy_matches(matching.standardized(_records(ctx)))


def client_keys(ctx: Context) -> DataFrame:
    """Every client's group and customer key."""
    groups, _ = matching.match_records(_records(ctx))
    keys = matching.assign_keys(groups)
    return groups.join(keys, "id").select("id", "group_id", "customer_key")


BUILDS = {f.__name__: f for f in (client_matches, client_keys)}

#: A word's sound: its first letter and the digits of what follows; h and w don't part equal digits, vowels do.
_RECORDS = r"""r AS (SELECT client_id AS id, nullif(array_to_string(list_sort(string_split(trim(regexp_replace(regexp_replace(strip_accents(upper(name)), '[^A-Z0-9 ]+', ' ', 'g'), ' +', ' ', 'g')), ' ')), ' '), '') AS name,
  nation_id::VARCHAR AS country, nullif(trim(regexp_replace(regexp_replace(strip_accents(upper(city)), '[^A-Z0-9 ]+', ' ', 'g'), ' +', ' ', 'g')), '') AS address, CASE WHEN contains(email, '@') THEN lower(trim(email)) END AS email FROM clients WHERE client_id IS NOT NULL),
k AS (SELECT DISTINCT country, name, address FROM r WHERE country IS NOT NULL AND name IS NOT NULL AND address IS NOT NULL),
n AS (SELECT DISTINCT country, name FROM k),
t AS (SELECT country, name, unnest(string_split(name, ' ')) AS w FROM n),
d AS (SELECT country, name, w, translate(replace(replace(w, 'H', ''), 'W', ''), 'ABCDEFGIJKLMNOPQRSTUVXYZ', '012301202245501262310202') AS raw FROM t),
c AS (SELECT country, name, w, list_reduce(list_prepend('', string_split(raw, '')), lambda x, y: CASE WHEN right(x, 1) = y THEN x ELSE x || y END) AS digits FROM d),
s AS (SELECT DISTINCT country, name, CASE WHEN regexp_matches(w, '^[A-Z]') THEN left(w, 1) || rpad(left(replace(CASE WHEN left(w, 1) IN ('H', 'W') THEN digits ELSE substr(digits, 2) END, '0', ''), 3), 3, '0') ELSE w END AS sound FROM c),
p AS (SELECT DISTINCT a.country, a.name AS a, b.name AS b, jaro_winkler_similarity(a.name, b.name) AS score FROM s a JOIN s b ON a.country = b.country AND a.sound = b.sound AND a.name < b.name
  UNION ALL SELECT country, name, name, 1.0 FROM n),
o AS (SELECT p.country, a AS l_name, x.address AS l_address, b AS r_name, y.address AS r_address, score, len(list_intersect(string_split(x.address, ' '), string_split(y.address, ' '))) / len(list_distinct(list_concat(string_split(x.address, ' '), string_split(y.address, ' ')))) AS share
  FROM p JOIN k x ON x.country = p.country AND x.name = a JOIN k y ON y.country = p.country AND y.name = b AND (a < b OR x.address < y.address) WHERE score >= 0.92),
m AS (SELECT country, l_name, l_address, r_name, r_address, round(score, 6) AS name_score, round(share, 6) AS address_score, round(score * (0.5 + 0.5 * share), 6) AS confidence FROM o WHERE share >= 0.8)"""

ORACLES = {
    "client_matches": f"WITH {_RECORDS} SELECT *, CASE WHEN confidence >= 0.95 THEN 'auto' WHEN confidence >= 0.8 THEN 'review' ELSE 'distinct' END AS decision FROM m",
    "client_keys": f"""WITH RECURSIVE {_RECORDS},
f AS (SELECT country, name, address, min(id) AS id FROM r GROUP BY ALL),
l AS (SELECT x.id AS u, y.id AS v FROM m JOIN f x ON x.country = m.country AND x.name = l_name AND x.address = l_address JOIN f y ON y.country = m.country AND y.name = r_name AND y.address = r_address WHERE confidence >= 0.95
  UNION SELECT id, min(id) OVER (PARTITION BY email) FROM r WHERE email IS NOT NULL UNION SELECT id, min(id) OVER (PARTITION BY country, name, address) FROM r WHERE country IS NOT NULL AND name IS NOT NULL AND address IS NOT NULL),
e AS (SELECT u, v FROM l UNION SELECT v, u FROM l),
reach AS (SELECT id, id AS other FROM r UNION SELECT reach.id, e.v FROM reach JOIN e ON e.u = reach.other),
g AS (SELECT id, min(other) AS group_id FROM reach GROUP BY id)
SELECT id, group_id, sha256('customer:' || group_id::VARCHAR) AS customer_key FROM g""",
}
