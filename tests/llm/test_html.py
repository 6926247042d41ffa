import math
import random
from collections import Counter
from xml.etree import ElementTree

from pyspark.sql import functions as F

from tidewater.llm import html

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<header><a href="/">Home</a></header><nav><ul><li>One<li>Two</ul></nav><div class="cookie-notice">We use cookies</div>
<article><header><h1>Title &eacute;&#33;</h1></header><p>First&nbsp;para<p>Second <b>bold</i> text<br>more</p><!-- x --><div class="ad">Buy</div><aside>Side</aside>
<ul><li>Item 1<li>Item 2</ul><blockquote>Quote &lt;b&gt;</blockquote><form><p>Your mail</p></form><p>Last &unknown; &amp</p>
<section id="comments"><h2>Comments</h2><p>I like it</p></section></article><footer>&copy; 2024</footer></body></html>"""


def text(page: str) -> str:
    return html.main_text(html.parse(page)[0])


def test_article():
    assert text(PAGE).split("\n") == ["Title é!", "First para", "Second bold text more", "Item 1", "Item 2", "Quote <b>", "Last &unknown; &"]


def test_regions():
    assert text("<main><p>a</p><nav>n</nav></main><p>b</p>") == "a"
    assert text("<div>one</div>two<p>three") == "one\ntwo\nthree"
    assert text("<div class='sidebar'>s</div><div id=x>body text</div>") == "body text"
    assert text("plain words") == "plain words"
    assert text("<p>x <span class=ad>buy</span> y</p>") == "x\ny"
    assert text("<table><tr><td>a<td>b<tr><td>c</table>") == "a\nb\nc"
    assert text("<article></article>") == "" == text("<script>x") == text("<!-- open")


def test_text_is_whole():
    long = " ".join(f"w{i}" for i in range(50_000))
    assert text(f"<article><p>{long}</p></article>") == long
    assert text("<p>" * 3000 + "deep") == "deep"
    assert text("<div>" * 100_000 + "very deep") == "very deep"


def test_odd_markup_takes_linear_time():
    import time

    began = time.time()
    for odd in ("<a " * 100_000 + '"', '<a title="' * 100_000, "<" * 200_000, "<!--" * 100_000, "</p>" * 100_000, "&" * 200_000, "<script>" * 50_000, "<b>x" * 50_000):
        text(odd + "<p>end")
    assert time.time() - began < 20


def pages(n, body):
    return [(i, f"http://Site.example/{i}", body(i)) for i in range(n)]


def test_style_tree_cuts_what_repeats(spark):
    div = lambda i: f"<body><div class=top>Same words on every page</div><div class=body><p>Own words {i} of page {i * 7}</p></div><div class=end>All rights</div></body>"
    inside = lambda i: f"<article><p>Text {i}</p><div class=x1>Tell your friends</div></article>"
    rows = pages(30, div) + [(100 + i, f"http://other.example/{i}", inside(i)) for i in range(30)] + [(200, "http://lone.example/", div(1)), (201, None, div(2)), (202, "x", None), (203, "http://site.example/", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for most in (1 << 19, 0):
        got = {r["page_id"]: r["main_text"] for r in html.extract(df, most_broadcast=most).collect()}
        assert got[3] == "Own words 3 of page 21" and got[105] == "Text 5"
        assert got[200].split("\n") == ["Same words on every page", "Own words 1 of page 7", "All rights"]
        assert got[201].count("\n") == 2 and got[202] == got[203] == "" and len(got) == len(rows)


def test_copies_are_no_evidence(spark):
    df = spark.createDataFrame([(i, "http://a.example/", "<article><div class=story>The same story</div></article>") for i in range(40)], "page_id long, url string, html string")
    assert {r["main_text"] for r in html.extract(df).collect()} == {"The same story"}


def test_importance(spark):
    df = spark.createDataFrame(pages(16, lambda i: f"<body><div class=same>x</div><div class=new>{i}</div></body>"), "page_id long, url string, html string")
    rows = {(r["content"], r["information"]): r for r in html.style_tree(df).collect()}
    # the repeated leaf, the leaf that is new on each page, and their body with texts of both
    assert sorted(rows)[0] == (0, 0) and sorted(rows)[-1] == (1, 1) and abs(sorted(rows)[1][0] - 16 / 17) < 1e-9
    assert {r["pages"] for r in rows.values()} == {16} and {r["presentation"] for r in rows.values()} == {0}


def plain_tree_texts(rows):
    """Texts by the tree alone, for well-formed pages in which each block is one element's own text."""
    trees, found = {}, {}
    for key, host, page in rows:
        nodes, blocks = trees.setdefault(host, {}), []

        def walk(e, at, host=host, key=key, nodes=nodes, blocks=blocks):
            label = ".".join([e.tag, *sorted((e.get("class") or "").split())])
            path = (*at, label)
            own = nodes.setdefault(path, {"pages": set(), "styles": {}, "texts": {}, "plain": e.tag in ("p", "h1", "ul", "li") and not e.get("class"), "h1": False})
            if key not in own["pages"]:
                own["styles"][key] = [".".join([c.tag, *sorted((c.get("class") or "").split())]) for c in e]
            own["pages"].add(key)
            if e.text and e.text.strip():
                text = " ".join(e.text.split())
                blocks.append((path, text))
                for k in range(1, len(path) + 1):
                    nodes[path[:k]]["texts"].setdefault((path, text), set()).add(key)
            for c in e:
                walk(c, path)
                own["h1"] |= c.tag == "h1" or nodes[(*path, ".".join([c.tag, *sorted((c.get("class") or "").split())]))]["h1"]

        walk(ElementTree.fromstring(page), ())
        found[key] = host, blocks
    cut = set()
    for host, nodes in trees.items():
        told = {}
        for path, x in nodes.items():
            m = len(x["pages"])
            if m < html.LEAST_PAGES or not x["texts"]:
                continue
            styles = Counter(map(tuple, x["styles"].values()))
            presentation = -sum(n / m * math.log(n / m) for n in styles.values()) / math.log(m)
            importance = {t: 1 - math.log(len(on)) / math.log(m) for t, on in x["texts"].items()}
            information = sum(len(t[1].split()) * len(on) * importance[t] for t, on in x["texts"].items()) / m
            told[path] = presentation, sum(importance.values()) / len(importance), information
        for path, (presentation, content, information) in told.items():
            beside = max((told[q][2], not nodes[q]["plain"]) for q in told if q[:-1] == path[:-1])
            minor = beside[0] > 0 and beside[1] and 0.2 * presentation + 0.8 * information / beside[0] < html.MINOR and not nodes[path]["plain"] and not nodes[path]["h1"]
            if 0.1 * presentation + 0.9 * content < html.THRESHOLD or minor:
                cut.add((host, path))
    out = {}
    for key, (host, blocks) in found.items():
        left = [t for path, t in blocks if not any((host, path[:k]) in cut for k in range(1, len(path) + 1))]
        out[key] = "\n".join(left or [t for _, t in blocks])
    return out


def test_tree_alone_against_a_plain_version(spark):
    r = random.Random(4)

    def words(n):
        return " ".join("".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(n))

    pool = [words(6) for _ in range(20)]
    rows = []
    for host in range(6):
        named, wrapped = host % 2, host % 3 == 0
        for i in range((3, 12, 25, 40, 9, 60)[host]):
            body = f"<h1>{words(6)}</h1>" + "".join(f"<p>{words(r.randint(1, 40))}</p>" for _ in range(r.randint(1, 9)))
            if r.random() < 0.3:
                body += f"<ul><li>{words(3)}</li><li>{words(3)}</li></ul>"
            body = f'<{("section", "div")[named]} class="{("", "text")[named]}">{body}</{("section", "div")[named]}>'
            if wrapped:
                body = f'<div class="wrap"><div class="lead">{words(3)}</div>{body}<div class="share">Tell your friends</div></div>'
            rest = "".join(f'<div class="b{chr(97 + k)}">{r.choice(pool)}</div>' for k in range(r.randint(1, 3)))
            menu = "".join(f"<li>{w}</li>" for w in r.choice(pool).split()[: r.randint(4, 6)])
            rows.append((len(rows), f"h{host}.example", f"<html><body><div class='top'><ul>{menu}</ul></div>{body}{rest}<p>All rights</p></body></html>"))
    want = plain_tree_texts(rows)
    df = spark.createDataFrame([(k, f"http://{host}/{k}", page) for k, host, page in rows], "page_id long, url string, html string")
    got = {r["page_id"]: r["main_text"] for r in html.extract(df, declared=False).collect()}
    assert got == want
    gone = [k for k, _, page in rows if "All rights" not in got[k]]
    assert len(gone) > 0.9 * (len(rows) - 3) and not any("Tell your friends" in got[k] for k in gone)


def test_tree_alone_finds_the_article_of_the_given_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r["page_id"]: text(r["html"]) for r in rows.collect()}
    nameless = rows.withColumn("html", F.regexp_replace("html", r"(</?)(article|main)\b", "$1div"))
    enough = {r["host"] for r in rows.groupBy(html.host_of("url").alias("host")).count().where(f"count >= {html.LEAST_PAGES}").collect()}
    got = html.extract(nameless, declared=False).select("page_id", html.host_of("url").alias("host"), "main_text").collect()
    own = [r for r in got if r["host"] in enough]
    assert len(own) > 80 and sum(r["main_text"] == want[r["page_id"]] for r in own) >= 0.95 * len(own)


def test_declared_main_branch_is_shown(spark):
    # what calls itself a sidebar is the page's text here; a page of a small host goes by its names
    body = lambda i: f"<body><div class=top>Site menu</div><div class=sidebar><p>{' '.join(f'w{i}x{k}' for k in range(50))}</p></div></body>"
    rows = pages(20, body) + [(100, "http://small.example/", body(1))]
    got = {r["page_id"]: r["main_text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i].startswith(f"w{i}x0 ") for i in range(20)) and got[100] == "Site menu"


def invented(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(n))


def read(spark, rows, **options):
    return {r["page_id"]: r["main_text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), **options).collect()}


def test_cards_that_are_articles_dont_hide_the_story(spark):
    def body(i):
        cards = "".join(f"<article><h2>{invented(2, 10 * i + k)}</h2><p>{invented(4, 10 * i + k + 5)}</p></article>" for k in range(3))
        return "<body><div class=story>" + "".join(f"<p>{invented(40, 1000 * i + k)}</p>" for k in range(8)) + f"</div><div class=grid>{cards}</div></body>"

    rows = [*pages(40, body), (100, "http://small.example/", body(7))]
    got = read(spark, rows)
    for i in range(40):
        assert got[i].split("\n") == [invented(40, 1000 * i + k) for k in range(8)]
    # a lone page has no tree: its names decide
    assert got[100].startswith(invented(2, 70))
    assert read(spark, rows[:40], least_pages=1000) != {i: got[i] for i in range(40)}  # it is the tree that tells


def test_a_teaser_in_main_isnt_the_page(spark):
    body = lambda i: f"<body><main><p>{invented(5, i)}</p></main><div class=text><h1>{invented(3, 50 + i)}</h1><p>{invented(120, 100 + i)}</p></div></body>"
    got = read(spark, pages(30, body))
    assert all(got[i] == f"{invented(3, 50 + i)}\n{invented(120, 100 + i)}" for i in range(30))


def test_comments_that_are_articles_are_no_text(spark):
    r = random.Random(3)

    def body(i, own="article"):
        comments = "".join(f"<article><p>{invented(r.randint(3, 12), 7000 + 10 * i + k)}</p></article>" for k in range(r.randint(0, 4)))
        return f"<body><{own} class=post><h1>{invented(4, i)}</h1><p>{invented(90, 500 + i)}</p></{own}><div class=below>{comments}</div></body>"

    want = {i: f"{invented(4, i)}\n{invented(90, 500 + i)}" for i in range(30)}
    assert read(spark, pages(30, body)) == want
    # the same label for both: the longest of a page's articles counts
    alike = lambda i: body(i).replace(" class=post", "").replace("<div class=below>", "").replace("</div>", "")
    assert read(spark, pages(30, alike)) == want
    # on a host without a tree too
    assert read(spark, [(3, "http://few.example/", body(3))]) == {3: want[3]}


def test_the_region_that_says_most_is_chosen(spark):
    body = lambda i: f"<body><main><div class=lead><p>{invented(20, i)}</p></div><article><p>{invented(60, 100 + i)}</p></article></main><div class=menu>Same menu here</div></body>"
    df = spark.createDataFrame(pages(20, body), "page_id long, url string, html string")
    chosen = [r for r in html.judged(html.style_tree(df)).where("region").collect()]
    assert len(chosen) == 1 and chosen[0]["path"] != 0
    assert {r["page_id"]: r["main_text"] for r in html.extract(df).collect()} == {i: invented(60, 100 + i) for i in range(20)}
    assert [r["path"] for r in html.judged(html.style_tree(df, False)).where("region").collect()] == [0]  # without names no region counts


def test_empty_table_and_other_columns(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string, main_text string, _cut string")
    assert html.extract(df).collect() == []
    rows = [(i, f"http://a.example/{i}", f"<p>own {i}</p>", "old", f"c{i}", f"h{i}", "i", "s", "f") for i in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, main_text string, _cut string, _host string, _inside string, _salt string, host string")
    for most in (1 << 19, -1):
        got = html.extract(df, most_broadcast=most)
        assert got.columns == [c for c in df.columns if c != "main_text"] + ["main_text"]
        assert sorted(tuple(r) for r in got.collect()) == sorted((*r[:3], *r[4:], f"own {r[0]}") for r in rows)


def test_copies_with_other_adverts_are_no_evidence(spark):
    story = "The same story, told at some length. " * 5
    bodies = [
        lambda i: f"<body><div class=top>Site</div><div class=ad{i % 3}><b>ad {i}</b></div><div class=story>{story}</div><div class=menu><p>menu {i}</p></div></body>",
        lambda i: f"<article><h1>T</h1><div class=story>{story}</div></article><nav>{i}</nav>",
        # adverts that don't say so: the copies can't be told from pages of one template, but their text is kept
        lambda i: f"<article><h1>T</h1><div class=story>{story}</div><div class=x>visit {i}</div></article>",
        lambda i: f"<body><div class=story>{story}</div></body>" if i else "<body><div class=story>Other</div></body>",
    ]
    rows = [(100 * k + i, f"http://h{k}.example/{i}", body(i)) for k, body in enumerate(bodies) for i in range(40)]
    got = {r["page_id"]: r["main_text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {got[i] for i in range(40)} == {"Site\n" + story.strip()}
    assert {got[100 + i] for i in range(40)} == {"T\n" + story.strip()}
    assert [got[200 + i] for i in range(40)] == [f"T\n{story.strip()}\nvisit {i}" for i in range(40)]
    assert [got[300 + i] for i in range(40)] == ["Other", *[story.strip()] * 39]


def test_styles_of_copies_count_as_one_page(spark):
    df = spark.createDataFrame(pages(12, lambda i: f"<body><div class=new>{i // 2}</div>{'<div class=ad>x</div>' * (i % 2)}</body>"), "page_id long, url string, html string")
    tree = html.style_tree(df).collect()
    assert {r["pages"] for r in tree} == {6} and all(0 <= r["importance"] <= 1 for r in tree)


def test_deep_elements_are_read_as_any_other():
    for deep in (10, 300, 5000):
        into = "<div>" * deep
        assert text(into + "<p>a</p><nav>n</nav><div class=ad>buy</div><form>mail</form><p>b") == "a\nb"
        assert text(into + "one<article><p>x<p>y</article><div>two") == "x\ny"
        assert text(into + "<ul><li>1<li>2</ul>3<div>4</div>5") == "1\n2\n3\n4\n5"
    blocks, styles = html.parse("<div>" * 5000 + "<p>a")
    assert len(blocks[0].paths) == html.DEEPEST == len(styles)


def test_deep_markup_takes_linear_time():
    import time

    began = time.time()
    for odd in ("<span>" * 50_000 + "<li>x</li>" * 50_000, "<div>" * 50_000 + "</b>" * 50_000, "<div class=ad>x" * 30_000, "<b>" * 50_000 + "<i>x</i><p>" * 30_000):
        text(odd + "<p>end")
    assert time.time() - began < 20
