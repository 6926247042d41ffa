"""URL filters: pattern rules indexed by their rarest literal token.

A rule is text: ``||host^`` anchors at a host or any of its subdomains, ``|`` at
the start or the end of the url, ``*`` stands for anything and ``^`` for a
separator or the end; other text is literal, and ``@@`` in front makes a rule an
exception that allows.  Each rule is filed under one literal token (a whole run
of letters and digits that any url it fits must contain): the rarest, by how
often the rule set's tokens occur in the urls at hand.  A url's own tokens fetch
the candidate rules, and only those run their regular expressions; rules without
a token are candidates for all.

Directory rules (``host/path``) are the second kind: they fit a host and its
subdomains if the path starts with theirs, and the longest that fits wins.  They
are looked up by the url's host suffixes, and settle a url before patterns do.

The rule set and its token counts are the only things sent to all tasks; they
are as large as the rules, not the urls.  A null url has an empty host and path
and fits no rule.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbuf import tidy

TOKEN = re.compile(r"[a-z0-9%]+")
_ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path, both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    stop = min((i for i in (rest.find("?", end), rest.find("#", end)) if i >= 0), default=len(rest))
    return rest[:end].translate(_ASCII_LOWER), rest[end:stop]


def expression(pattern: str) -> str:
    """The regular expression of a pattern rule, over a lower-cased url."""
    body, lead, tail = pattern, "", ""
    if body.startswith("||"):
        body, lead = body[2:], r"^[^:]*://(?:[^/?#]*\.)?"
    elif body.startswith("|"):
        body, lead = body[1:], "^"
    if body.endswith("|"):
        body, tail = body[:-1], "$"
    parts = {"*": ".*", "^": r"(?:[^a-z0-9_.%-]|$)"}
    return lead + "".join(parts.get(c) or re.escape(c) for c in body) + tail


def literal_tokens(pattern: str) -> list[str]:
    """Tokens that every url the pattern fits has as whole tokens: runs whose both neighbours are known not to go on."""
    body = pattern.lower()
    start, end = body.startswith("|"), body.endswith("|")
    body = body.lstrip("|").rstrip("|") if end else body.lstrip("|")
    found = []
    for m in TOKEN.finditer(body):
        before = body[m.start() - 1] if m.start() else ("|" if start else "*")
        after = body[m.end()] if m.end() < len(body) else ("|" if end else "*")
        if "*" not in (before, after):
            found.append(m[0])
    return found


class Rules:
    """An index of pattern rules and of directory rules."""

    def __init__(self, patterns: list[str], directories: list[tuple[str, str]], counts: dict[str, int] | None = None):
        own = [(p.startswith("@@"), p.removeprefix("@@").translate(_ASCII_LOWER)) for p in patterns]
        seen = Counter(t for _, p in own for t in set(literal_tokens(p)))
        counts = counts or {}
        self.filed: dict[str | None, list[tuple[bool, re.Pattern, str]]] = defaultdict(list)
        for (allows, p), text in zip(own, patterns, strict=True):
            key = min(literal_tokens(p), key=lambda t: (counts.get(t, 0), seen[t], -len(t), t), default=None)
            self.filed[key].append((allows, re.compile(expression(p)), text))
        self.by_host: dict[str, list[tuple[str, str, str]]] = defaultdict(list)
        for verdict, rule in directories:
            host, mark, path = rule.partition("/")
            self.by_host[host.translate(_ASCII_LOWER)].append((mark + path, rule, verdict))

    @staticmethod
    def tokens_of(patterns: list[str]) -> list[str]:
        return sorted({t for p in patterns for t in literal_tokens(p.removeprefix("@@").translate(_ASCII_LOWER))})

    def directory(self, host: str, path: str) -> tuple[str, str] | None:
        best, at = None, 0
        while host:
            for start, rule, verdict in self.by_host.get(host[at:], ()):
                if path.startswith(start) and (best is None or len(rule) > len(best[0])):
                    best = rule, verdict
            at = host.find(".", at) + 1
            if not at:
                return best
        return best

    def pattern(self, url: str) -> str | None:
        """The pattern rule that decides on a url: an exception if any fits, else the first that blocks."""
        url = url.translate(_ASCII_LOWER)
        blocked = None
        for key in [*dict.fromkeys(TOKEN.findall(url)), None]:
            for allows, fits, text in self.filed.get(key, ()):
                if (allows or blocked is None) and fits.search(url):
                    if allows:
                        return text
                    blocked = text
        return blocked

    def judge(self, url: str | None) -> tuple[str, str, str | None, str, str | None]:
        host, path = split_url(url)
        if found := self.directory(host, path):
            return host, path, found[0], found[1], None
        text = self.pattern(url or "")
        return host, path, None, "block" if text and not text.startswith("@@") else "allow", text


def _judge(rules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Rules = rules.value
        for b in batches:
            out = [own.judge(u) for u in b.column(b.schema.names.index("url")).to_pylist()]
            columns = zip(*out, strict=True) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(list(c), pa.string()) for c in columns]], names=[*b.schema.names, "host", "path", "rule", "verdict", "pattern"])

    return run


def judge_urls(urls: DataFrame, patterns: list[str], directories: list[tuple[str, str]]) -> DataFrame:
    """``urls`` (with a column url) with host, path, rule (the directory rule that decides, else null), verdict (allow or block) and pattern (the pattern rule that decides, else null)."""
    spark = urls.sparkSession
    urls = urls.select(*[c for c in urls.columns if c not in ("host", "path", "rule", "verdict", "pattern")])
    tokens = Rules.tokens_of(patterns)
    counts = {}
    if tokens:  # one row for each token of the rules at most
        seen = urls.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("url"), F.lit("([a-z0-9%]+)"), F.lit(1)))).alias("t")).where(F.col("t").isin(tokens))
        counts = {r["t"]: r["count"] for r in seen.groupBy("t").count().collect()}
    rules = spark.sparkContext.broadcast(Rules(patterns, directories, counts))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in urls.schema.fields)
    return urls.mapInArrow(tidy(_judge(rules)), f"{kinds}, host string, path string, rule string, verdict string, pattern string")
