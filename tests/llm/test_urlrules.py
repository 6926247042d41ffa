import re

import pytest

from tidewater.llm import urlrules

RULES = ["||ads.example^", "/banner/", "@@||good.example/banner/", "|http://exact.example/|", "track*pixel", "&id=7^", "||cdn.*/spy.", "noise"]
URLS = [
    "http://ads.example/x", "https://sub.ads.example:80/", "http://badads.example/", "https://x.org/banner/1", "https://good.example/banner/1", "http://exact.example/", "http://exact.example/a",
    "http://a.org/track/1/pixel.gif", "http://a.org/?a=1&id=7", "http://a.org/?a=1&id=77", "http://cdn.z.org/spy.js", "http://a.org/noisemaker", "", None, "no scheme", "HTTPS://UP.Example/BANNER/",
]


def slow(url):
    """All rules' regular expressions over a url."""
    url = (url or "").translate(urlrules._ASCII_LOWER)
    hits = [r for r in RULES if re.search(urlrules.expression(r.removeprefix("@@")), url)]
    return "block" if hits and not any(r.startswith("@@") for r in hits) else "allow"


@pytest.mark.parametrize("counts", [None, {"banner": 100, "example": 3}])
def test_index_gives_what_all_rules_give(counts):
    rules = urlrules.Rules(RULES, [], counts)
    assert [rules.judge(u)[3] for u in URLS] == [slow(u) for u in URLS]


def test_rules_are_filed_under_their_rarest_token():
    rules = urlrules.Rules(["||rare.common^", "||other.common^", "*wild*"], [], {"common": 9, "rare": 1, "other": 2})
    assert set(rules.filed) == {"rare", "other", None}


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("http://A.B.example.org/es/x?q#f", ("a.b.example.org", "/es/x", "block", "example.org/es/")),
        ("http://example.org", ("example.org", "", None, None)),
        ("http://example.org/en/17", ("example.org", "/en/17", "block", "example.org/en/1")),
        ("http://org/", ("org", "/", "allow", "org/")),
        ("http://xorg/", ("xorg", "/", None, None)),
        ("x?://h.com/fr/#a://b", ("h.com", "/fr/", "allow", "com/fr/")),
    ],
)
def test_directories(url, want):
    from tidewater.llm.queries import DIRECTORIES

    host, path, rule, verdict, _ = urlrules.Rules([], DIRECTORIES).judge(url)
    assert (host, path, verdict if rule else None, rule) == want


def test_frame(spark):
    df = spark.createDataFrame([(u, 1, "h") for u in URLS], "url string, rule int, host string")
    rows = urlrules.judge_urls(df, RULES, []).collect()
    assert [r["verdict"] for r in rows] == [slow(r["url"]) for r in rows]
    assert urlrules.judge_urls(df.limit(0), RULES, []).collect() == []
