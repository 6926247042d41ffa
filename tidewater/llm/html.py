"""Main text of web pages: a site style tree per host, with what elements say of themselves as a second witness.

Pages of one host are merged into a *style tree*: a node for every path of
element labels (tag, classes and id, digits left out), with the sequences of child
labels seen there (presentation) and the blocks of text seen below it (content).
The tree is never in one place: its counts are a distributed aggregation over
distinct pages.  Pages are told apart by the text they would have without a tree, so
that copies with other adverts or menus are copies too, and no evidence; by all of
their text if that is more than ten times as long.

*Presentation importance* of a node is the entropy of its child sequences, 1 if
every page has another one.  *Content importance* is the mean over its distinct
texts of 1 - log n / log m, for a text that n of the node's m pages have at one
place below it.  A node's
*information* is the number of words a page has there, each weighted by its text's
importance.  What is cut from every page of the host, on nodes of enough pages:

* *Repeated branches*: 0.1 of the presentation's and 0.9 of the content's
  importance are under ``threshold``.
* *Minor branches*: beside a sibling that holds the page's information, a branch
  whose composite importance (0.2 of the presentation's, 0.8 of its information over
  the sibling's) is under ``minor``.  So menus, adverts and footers go even if their
  words are new on every page.  Only containers go this way (not paragraphs, lists,
  headings and the like without a class or an id), none with an h1 in it, and only
  outside an ``article`` or ``main``, where short branches are parts of the text.

The tree chooses the region that text is taken from, too: of a host's ``article``
and ``main`` nodes the one with the most information (an ``article`` counts twice, as
``main`` may hold more than one), if no node outside of regions has more.  If one has,
as beside cards that are articles, or a teaser in ``main``, no region counts, and the
whole page is cut as above.  Inside a region only repeated branches with a class or
an id of their own are cut.  Of several regions at one node of a page the longest
counts, if it has half of their words (readers' comments can be articles).  A region
that the tree would cut all or most of keeps its whole text; a page without one does
if the tree would leave nothing.

Names come second: elements that declare themselves (``nav``, ``footer``, ``aside``,
``form``, roles, and class or id words such as ``ad`` or ``comments``) go from what
the tree has left, unless the tree shows one of them to be its page's main branch.
On a host with too few pages for a tree names alone decide, and an ``article``, else
``main``, sets the region.  With ``declared`` off, names count for nothing and the
tree alone decides.

A null or empty html has no text; a null url, or one without ``://``, is of the
host ''.  Repeated rows are extracted one by one.  An empty table gives an empty
result.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import written
from .tables import unused
from .textbuf import blocks, tidy

#: Branches below this importance are cut, if their node is on at least LEAST_PAGES distinct pages of the host.
THRESHOLD, LEAST_PAGES = 0.2, 8
#: The same inside an article.
THRESHOLD_INSIDE, LEAST_PAGES_INSIDE = 0.05, 20
#: Containers of less composite importance than this beside their most informative sibling are minor branches.
MINOR = 0.12
#: A declared branch is kept if it holds at least this share of what its siblings say, and has this content importance.
MAIN_SHARE, MAIN_CONTENT = 0.5, 0.5
#: A region of whose text less than this share would be left isn't cut.
LEAST_LEFT = 0.2

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Elements nested deeper than this are no nodes of the style tree; they are noise, regions and blocks as any other.
DEEPEST = 256

# Names of HTML elements, by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body html head td th tr tbody thead tfoot caption".split())
#: An opening tag ends an open element of its own group, up to the nearest enclosing limit.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
NOISE_TAGS = frozenset("nav footer aside form button select dialog menu svg canvas object applet audio video map datalist head".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words of classes and ids of what isn't the article.
NOISE_WORDS = frozenset(
    "ad ads adsense adslot advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disclaimer disqus footer gdpr login masthead menu menus modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted promotion recommended related replies respond share sharing sidebar signup social sponsor sponsored subscribe subscription teaser toolbar tracking widget widgets".split()
)
PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol b i em strong span a article main section blockquote pre table tbody thead tr td th dl dt dd figure figcaption br code".split())


REGIONS = ("article", "main", "section")
#: What is known of a node besides its path; HOLDS: a region is below it.
PLAIN_NODE, DECLARED, INSIDE, TITLED, ARTICLE, MAIN, HOLDS = 1, 2, 4, 8, 16, 32, 64


class Element:
    """An open element.  ``path`` is None beyond DEEPEST; ``noisy`` is the chain of elements that are noise, from the innermost on, ``block`` and ``region`` the places of the innermost block and article or main (-1: none), itself included."""

    __slots__ = ("tag", "at", "path", "parent", "noisy", "noise", "outer", "inside", "plain", "block", "region", "titled", "holds", "number", "children")

    def __init__(self, tag: str, parent: Element | None, path: int | None, noise: bool, inside: str, plain: bool, number: int):
        self.tag, self.path, self.inside, self.plain, self.noise, self.number = tag, path, inside, plain, noise, number
        self.at = parent.at + 1 if parent else 0
        self.parent = parent.path if parent else 0
        self.outer = parent.noisy if parent else None
        self.noisy = self if noise else self.outer
        self.block = self.at if tag in BLOCK else parent.block if parent else -1
        self.region = self.at if tag in ("article", "main") else parent.region if parent else -1
        self.titled = tag == "h1"
        self.holds = False
        self.children: list[str] = []

    def flags(self) -> int:
        return PLAIN_NODE * (self.plain and self.tag not in REGIONS) | DECLARED * self.noise | INSIDE * bool(self.inside) | TITLED * self.titled | ARTICLE * (bool(self.inside) and self.tag == "article") | MAIN * (bool(self.inside) and self.tag == "main") | HOLDS * self.holds


def _label(tag: str, attributes: str, declared: bool = True) -> tuple[str, bool, bool]:
    """Label of an element, whether it declares itself as other than the article, and whether it has a class or an id."""
    if not attributes or attributes.isspace():
        return tag, declared and tag in NOISE_TAGS, False
    own = {}
    for m in ATTRIBUTE.finditer(attributes):
        own.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    names = f"{own.get('class', '')} {own.get('id', '')}".strip()
    words = {w.lower() for w in WORD.findall(names)} if names else set()
    noise = declared and (tag in NOISE_TAGS or own.get("role", "").lower() in NOISE_ROLES or "hidden" in own or own.get("aria-hidden") == "true" or bool(words & NOISE_WORDS) or "display:none" in own.get("style", "").replace(" ", ""))
    if tag in ("html", "body"):
        noise = declared and "hidden" in own
    return f"{tag}.{'.'.join(sorted(words))}" if words else tag, noise, bool(words)


class Block:
    """A block's text and the elements it is in: all paths from the outermost on, those of noise, the region, what is below it and not plain, and the path and place in the page of each region around it."""

    __slots__ = ("text", "paths", "noise", "inside", "noise_inside", "named", "regions")

    def __init__(self, text: str, nodes: list[Element], last: Element | None):
        self.text = text
        self.paths = [e.path for e in nodes]
        self.inside = last.inside if last else ""
        at = last.region if last else -1
        self.noise: list[int | None] = []
        e = last.noisy if last else None
        while e is not None:
            self.noise.append(e.path)
            e = e.outer if e.path is not None else None  # what is too deep for a node is never shown
        self.noise_inside = at < 0 or last.noisy is not None and last.noisy.at >= at
        self.named = [e.path for e in nodes[at + 1 :] if not e.plain] if at >= 0 else self.paths
        self.regions = {e.path: e.number for e in nodes if e.tag in ("article", "main")} if self.inside else {}


def parse(page: str, declared: bool = True) -> tuple[list[Block], dict[int, tuple[int, int, list[str]]]]:
    """Blocks of text in page order, and of every path its parent's, flags and child labels; with ``declared`` off, without noise and regions."""
    out: list[Block] = []
    styles: dict[int, tuple[int, int, list[str]]] = {}
    stack: list[Element] = []
    places: dict[str, list[int]] = {}  # of the open elements of each tag
    held: list[str] = []
    owner: tuple[list[Element], Element | None] = [], None

    def flush() -> None:
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            if text:
                out.append(Block(text, *owner))
            held.clear()

    def say(text: str) -> None:
        nonlocal owner
        if not text:
            return
        # inline elements that aren't part of the article end the block's own text
        last = stack[-1] if stack else None
        if held and (last and last.noisy) is not (owner[1] and owner[1].noisy):
            flush()
        if not held:
            owner = stack[:DEEPEST], last
        held.append(text)

    def close(count: int) -> None:
        while len(stack) > count:
            e = stack.pop()
            places[e.tag].pop()
            if e.tag in BLOCK:
                flush()
            if e.titled and stack:
                stack[-1].titled = True
            if stack and (e.holds or e.inside and e.tag in ("article", "main")):
                stack[-1].holds = True
            if e.path is not None:
                had = styles.get(e.path)
                styles[e.path] = (e.parent, e.flags() | had[1], had[2]) if had else (e.parent, e.flags(), e.children)

    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                say(m[0][9:-3].replace("&", "&amp;"))
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "br":
                say(" ")
            elif places.get(tag):
                k = places[tag][-1]
                # an inline end tag doesn't reach beyond the block it is in
                if tag in BLOCK or stack[-1].block <= k:
                    close(k)
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in VOID:
            if tag in BLOCK:
                flush()
            else:
                say(" " if tag == "br" else "")
            continue
        if tag in CLOSES_P and stack and stack[-1].block >= 0 and stack[stack[-1].block].tag == "p":
            close(stack[-1].block)
        if tag in IMPLIED:
            same, limit = IMPLIED[tag]
            end = max((places[x][-1] for x in limit if places.get(x)), default=-1)
            own = [places[x][k] for x in same if (k := bisect_right(places.get(x, ()), end)) < len(places.get(x, ()))]
            if own:
                close(min(own))
        if tag in BLOCK:
            flush()
        label, noise, named = _label(tag, m[3], declared)
        parent = stack[-1] if stack else None
        inside = parent.inside if parent else ""
        if tag == "header" and not inside:
            noise = declared
        if declared and tag == "article" or declared and (tag == "main" or 'role="main"' in m[3]) and inside != "article":
            inside = "article" if tag == "article" else "main"
        if parent and parent.path is not None:
            parent.children.append(label)
        if not m[0].endswith("/>") or tag in BLOCK:
            path = xxhash.xxh64_intdigest(f"{parent.path if parent else 0}/{label}") - (1 << 63) if len(stack) < DEEPEST else None
            places.setdefault(tag, []).append(len(stack))
            stack.append(Element(tag, parent, path, noise, inside, tag in PLAIN and not named, at))
    close(0)
    flush()
    return out, styles


NOTHING: frozenset[int] = frozenset()


def _one_of(own: list[Block], place: Callable[[Block], int | None]) -> list[Block]:
    """The blocks of the longest of several regions, if it has half of all words; else all blocks."""
    words: dict[int | None, int] = {}
    for b in own:
        words[place(b)] = words.get(place(b), 0) + b.text.count(" ") + 1
    most = max(words, key=words.__getitem__)
    return [b for b in own if place(b) == most] if 2 * words[most] >= sum(words.values()) else own


def main_text(found: list[Block], cut: frozenset[int] | set[int] = NOTHING, cut_inside: frozenset[int] | set[int] = NOTHING, shown: frozenset[int] | set[int] = NOTHING, regions: frozenset[int] | set[int] = NOTHING) -> str:
    """Text of the article.  ``cut`` holds unimportant paths, ``cut_inside`` those unimportant enough to go from a region too, ``shown`` declared ones that are main branches, and ``regions`` the region that the tree has chosen, or 0 if none; empty without a tree."""

    def within(own: list[Block]) -> str:
        left = [b.text for b in own if not any(p in cut_inside for p in b.named)]
        every = [b.text for b in own]
        return "\n".join(left if sum(map(len, left)) >= LEAST_LEFT * sum(map(len, every)) else every)

    clean = [b for b in found if not b.noise or shown and all(p in shown for p in b.noise)]
    for path in regions:
        if own := [b for b in clean if path in b.regions]:
            return within(_one_of(own, lambda b, path=path: b.regions[path]))
    if not regions:
        for region in ("article", "main"):
            if own := [b for b in clean if b.inside == region]:
                # the outermost regions of a kind are apart
                return within(_one_of(own, lambda b: next(iter(b.regions.values()), None)))
    if clean:
        return "\n".join([b.text for b in clean if not any(p in cut for p in b.paths)] or [b.text for b in clean])
    return "\n".join(b.text for b in found if b.inside and not b.noise_inside)


FEATURES = "host string, path long, kind string, feature long, size long, page long"


def _signed(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _features(declared: bool):
    """What every distinct page adds to its host's tree: marks, texts of the innermost node they are in (their words as size) and child sequences; and, once for all pages at hand, nodes' parents and flags and what is above a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "html", 4 << 20):
            rows = set()
            for host, page in zip(block.column(0).to_pylist(), block.column(1).to_pylist(), strict=True):
                if not page:
                    continue
                found, styles = parse(page, declared)
                own, whole = main_text(found), "\n".join(b.text for b in found)
                mark = _signed(own if 10 * len(own) >= len(whole) else whole)
                seen = set()
                for b in found:
                    leaf = b.paths[-1] if b.paths else 0  # 0 stands above all elements
                    rows.add((host, leaf, "c", _signed(b.text), b.text.count(" ") + 1, mark))
                    rows.update((host, leaf, "a", p, 0, 0) for p in b.paths)
                    seen.update(b.paths)
                for p in seen:
                    parent, flags, children = styles[p]
                    rows.add((host, p, "m", 0, 0, mark))
                    rows.add((host, p, "s", _signed(" ".join(children)), 0, mark))
                    rows.add((host, p, "p", parent, 0, 0))
                    rows.add((host, p, "f", flags, 0, 0))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=["host", "path", "kind", "feature", "size", "page"])

    return run


def host_of(url: str):
    """A url's host, A-Z lower-cased; '' without ``://``."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(F.regexp_extract(url, "^(?s:.*?)://([^/?#]*)", 1), capitals, capitals.lower()), F.lit(""))


def style_tree(pages: DataFrame, declared: bool = True) -> DataFrame:
    """(host, path, parent, flags, pages, presentation, content, importance, information) of every node of the hosts' style trees that several pages have; ``pages`` has url and html."""
    rows = pages.select(host_of("url").alias("host"), "html").mapInArrow(tidy(_features(declared)), FEATURES)
    each = rows.groupBy("host", "path", "kind", "feature", "size").agg(F.countDistinct("page").alias("n"))
    ln, word = F.log(F.col("n").cast("double")), F.col("kind") == "c"
    # copies of a page can have several styles, or flags, at a node
    own = each.groupBy("host", "path").agg(
        F.max(F.when(F.col("kind") == "p", F.col("feature"))).alias("parent"),
        F.bit_or(F.when(F.col("kind") == "f", F.col("feature"))).alias("flags"),
        F.sum(F.when(F.col("kind") == "m", F.col("n"))).alias("pages"),
        F.sum(F.when(F.col("kind") == "s", F.col("n"))).alias("seen"),
        F.sum(F.when(F.col("kind") == "s", F.col("n") * ln)).alias("styles"),
        F.sum(F.when(word, ln)).alias("texts"),
        F.sum(F.when(word, 1)).alias("distinct"),
        F.sum(F.when(word, F.col("size") * F.col("n"))).alias("words"),
        F.sum(F.when(word, F.col("size") * F.col("n") * ln)).alias("common"),
        F.collect_set(F.when(F.col("kind") == "a", F.col("feature"))).alias("above"),
    )
    own = written(own)
    # a text counts at its place and at all nodes above
    sums = ("texts", "distinct", "words", "common")
    below = own.where("distinct > 0").select("host", F.explode("above").alias("path"), *sums).groupBy("host", "path").agg(*[F.sum(c).alias(c) for c in sums])
    node = own.drop(*sums, "above").join(below, ["host", "path"])
    scale = F.log(F.col("pages").cast("double"))
    presentation = F.greatest(F.least((F.log(F.col("seen").cast("double")) - F.col("styles") / F.col("seen")) / scale, F.lit(1.0)), F.lit(0.0))
    content = 1 - F.least(F.col("texts") / F.col("distinct") / scale, F.lit(1.0))
    information = F.greatest(F.col("words") - F.col("common") / scale, F.lit(0.0)) / F.col("pages")
    node = node.where("pages > 1 and distinct > 0")
    return node.select("host", "path", "parent", "flags", "pages", presentation.alias("presentation"), content.alias("content"), (0.1 * presentation + 0.9 * content).alias("importance"), information.alias("information"))


def judged(tree: DataFrame, threshold: float = THRESHOLD, least_pages: int = LEAST_PAGES, minor: float = MINOR) -> DataFrame:
    """(host, path, cut, cut_inside, shown, region) of the nodes that a decision is made about; ``tree`` as of :func:`style_tree`.  Every host with enough pages has one region, of path 0 if none holds what its pages say."""
    has = lambda bit: F.col("flags").bitwiseAND(F.lit(bit)) != 0
    nodes = tree.where(F.col("pages") >= least_pages)
    # what a region says, against what is said outside of all regions
    weight = F.when(has(ARTICLE), 2.0).when(has(MAIN) & ~has(DECLARED), 1.0)
    rival = F.max(F.when(~has(INSIDE) & ~has(HOLDS) & ~has(DECLARED), F.col("information")))
    chosen = nodes.groupBy("host").agg(rival.alias("rival"), F.max_by(F.struct("path", "information"), F.when(weight.isNotNull(), F.struct(weight * F.col("information"), "path"))).alias("best"))
    wins = F.col("best").isNotNull() & (F.col("best.information") >= F.coalesce("rival", F.lit(0.0)))
    chosen = chosen.select("host", F.when(wins, F.col("best.path")).otherwise(F.lit(0).cast("long")).alias("region"))
    beside = nodes.groupBy("host", "parent").agg(
        F.max(F.struct("information", F.when(has(PLAIN_NODE), 0).otherwise(1).alias("container"), "path")).alias("top"),
        F.sum(F.when(~has(DECLARED), F.col("information"))).alias("undeclared"),
        F.sum("information").alias("all"),
    )
    both = nodes.join(beside, ["host", "parent"]).join(chosen, "host")
    composite = 0.2 * F.col("presentation") + 0.8 * F.col("information") / F.col("top.information")
    small = (F.col("top.information") > 0) & (F.col("top.container") == 1) & (composite < minor) & ~has(PLAIN_NODE) & ~has(TITLED)
    main = has(DECLARED) & (F.col("top.path") == F.col("path")) & (F.col("information") >= MAIN_SHARE * F.col("all")) & (F.col("content") >= MAIN_CONTENT) & (F.coalesce("undeclared", F.lit(0.0)) * 2 < F.col("information"))
    inside = has(INSIDE) & ~has(PLAIN_NODE) & (F.col("importance") < THRESHOLD_INSIDE) & (F.col("pages") >= LEAST_PAGES_INSIDE)
    free = ~has(INSIDE) | (F.col("region") == 0)
    out = both.select("host", "path", (free & ((F.col("importance") < threshold) | small)).alias("cut"), inside.alias("cut_inside"), main.alias("shown"), F.lit(False).alias("region"))
    no = F.lit(False)
    return out.where("cut or cut_inside or shown").unionByName(chosen.select("host", F.col("region").alias("path"), no.alias("cut"), no.alias("cut_inside"), no.alias("shown"), F.lit(True).alias("region")))


def _extract(html_at: int, declared: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "html", 4 << 20):
            n = block.num_columns - 4
            texts = []
            for page, *sets in zip(*(block.column(i).to_pylist() for i in (html_at, n, n + 1, n + 2, n + 3)), strict=True):
                texts.append(main_text(parse(page, declared)[0], *(set(x or ()) for x in sets)) if page else "")
            yield pa.RecordBatch.from_arrays([*block.columns[:n], pa.array(texts, pa.string())], names=[*block.schema.names[:n], "main_text"])

    return run


def extract(pages: DataFrame, threshold: float = THRESHOLD, least_pages: int = LEAST_PAGES, minor: float = MINOR, declared: bool = True, most_broadcast: int = 1 << 19, salts: int = 64) -> DataFrame:
    """``pages`` (url, html, ...) with ``main_text``, '' if there is none; a column of that name is replaced, all others come back unchanged.

    What the tree has decided for each host goes to all tasks if it is at most
    ``most_broadcast`` paths (8 bytes each), and pages stay where they are;
    else it is joined to the pages of its host, dealt out by ``salts``.
    """
    pages = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c != "main_text"])
    host, salt, *lists = (unused(pages.columns, c) for c in ("_host", "_salt", "_cut", "_inside", "_shown", "_region"))
    tree = judged(style_tree(pages, declared), threshold, least_pages, minor)
    decided = [F.collect_list(F.when(F.col(flag), F.col("path"))).alias(name) for flag, name in zip(("cut", "cut_inside", "shown", "region"), lists, strict=True)]
    cut = written(tree.groupBy(F.col("host").alias(host)).agg(*decided))
    paths = cut.agg(F.sum(1 + sum(F.size(c) for c in lists))).first()[0] or 0
    own = host_of("url")
    if paths <= most_broadcast:
        both = pages.join(F.broadcast(cut), own == cut[host], "left")
    else:
        dealt = cut.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        both = pages.join(dealt, (own == dealt[host]) & (F.pmod(F.xxhash64("url", "html"), F.lit(salts)) == dealt[salt]), "left")
    both = both.select(*[F.col(f"`{c}`") for c in (*pages.columns, *lists)])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields)
    return both.mapInArrow(tidy(_extract(pages.columns.index("html"), declared)), f"{kinds}, main_text string")
