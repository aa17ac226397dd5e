"""Main text of web pages by wrapper induction.

The pages of a host, and those of each layout of a host, are aligned by simple
tree matching.  Text that stands at the same place in most of them is template
and is left out of their texts; elements that are no article by their tag or
name (menus, forms, adverts, comments and the like) are skipped wherever they
stand.  Nothing else is left out.
"""

from __future__ import annotations

import hashlib
import html as _html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, staged, table
from .near_duplicates import few
from .url_filter import host_of

#: Text is template when at least this share of the different pages of a host or layout, and two at least, have it at the same place.
TEMPLATE_SHARE = 0.75
#: Elements of a page below html and body that name its layout: containers down to this depth.
LAYOUT_DEPTH = 2
#: Up to so many template keys in all (8 bytes each, some 100 with their hosts and layouts) are broadcast.
BROADCAST_KEYS = 200_000
#: Up to so many characters of pages that others are aligned with are broadcast.
BROADCAST_CHARS = 16_000_000

# Kinds of elements, and words that name what is no article.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe template svg annotation xmp object".split())
#: What a head holds; it ends before anything else, whether its end is written or not.
_HEAD = frozenset("base link meta noscript script style template title".split())
#: Raw elements that reach to the end of the page if they are not closed.
_CODE = frozenset("script style textarea title".split())
_SKIPPED = frozenset("head nav footer aside form dialog menu button select".split())
#: Left open, these end where a block begins.
_CONTROLS = frozenset("button select option optgroup".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
_CONTAINERS = frozenset("article main section div body td".split())
_NO_ARTICLE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs masthead footer cookie cookies consent notice notices banner comment comments feedback disqus respond replies related recommended share sharing social newsletter subscribe popup modal widget login signup search pagination".split()
)
#: Words that may stand beside one of those in a name; with any other the name is about something else, as related-work is.
_BESIDE = frozenset(
    "area bar block body bottom box button buttons col column container content count desktop form global group header icon icons inline inner item items left link links list main mobile module outer page panel post posts primary reader readers region right row secondary section site slot stories text thread title top unit user users wrap wrapper x y z".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())

_TOKEN = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?/][^>]*>|([^<]+|<)""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


def _events(page: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """open, close and text in page order; elements left open are closed where a parser would."""
    stack: list[str] = []
    held: dict[str, int] = {}
    at, n = 0, len(page)

    def closed() -> tuple[str, str, dict[str, str]]:
        held[stack[-1]] -= 1
        return "close", stack.pop(), {}

    while at < n:
        m = _TOKEN.match(page, at)
        if not m:  # a tag whose quotes do not close
            end = page.find(">", at)
            at = n if end < 0 else end + 1
            continue
        at = m.end()
        if stack and stack[-1] == "head" and (m[4].strip() if m[4] is not None else m[2] and not m[1] and m[2].lower() not in _HEAD):
            yield closed()
        if m[4] is not None:
            yield "text", _html.unescape(m[4]), {}
            continue
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            while held.get(tag):
                event = closed()
                yield event
                if event[1] == tag:
                    break
            continue
        if tag in _RAW:
            end = None if m[3].endswith("/") and tag not in _CODE else re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else n if tag in _CODE else at
            yield "open", tag, {}
            yield "close", tag, {}
            continue
        shut: set[str] = set(_CLOSES.get(tag, ()))
        if tag in _BLOCKS:
            shut |= _CONTROLS | {"p"}
        if tag in ("article", "main") and not held.get("article") and not held.get("main"):
            shut |= {x for x, k in held.items() if k and (x not in ("html", "body", "section", "div") or x in _SKIPPED)}
        scope = ("ul", "ol", "menu") if tag == "li" else ("table",) if tag in ("tr", "td", "th") else ()
        while any(held.get(x) for x in shut) and not (scope and shut.isdisjoint(_after(stack, scope))):
            yield closed()
        attributes = {a[1].lower(): a[2] or a[3] or a[4] or "" for a in _ATTRIBUTE.finditer(m[3])} if m[3].strip() else {}
        yield "open", tag, attributes
        if tag in _VOID or m[3].endswith("/"):
            yield "close", tag, {}
        else:
            stack.append(tag)
            held[tag] = held.get(tag, 0) + 1
    for tag in reversed(stack):
        yield "close", tag, {}


def _after(stack: list[str], tags: tuple[str, ...]) -> list[str]:
    """The open elements within the innermost of ``tags``."""
    for i in range(len(stack) - 1, -1, -1):
        if stack[i] in tags:
            return stack[i + 1 :]
    return stack


def _names(attributes: dict[str, str], keys: tuple[str, ...] = ("class", "id")) -> list[list[str]]:
    """The words of each name that an element has."""
    whole = [name for k in keys for name in attributes.get(k, "").split()]
    return [[w for w in re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()) if w] for name in whole]


def _no_article_name(words: list[str]) -> bool:
    """True if a name says what is no article, and nothing else."""
    return not _NO_ARTICLE.isdisjoint(words) and all(w in _NO_ARTICLE or w in _BESIDE or w.isdigit() for w in words)


#: Inside an article these have ids for links to them, which say what the text is about.
_ANCHORS = frozenset("section h1 h2 h3 h4 h5 h6 p dt dd li figure".split())


def _is_article(tag: str, attributes: dict[str, str], inside: bool, section: bool = False) -> bool:
    """False for what is skipped; a header counts as article inside of one or of a section, and what stands for scripts inside of one."""
    if tag in _RAW or tag in _SKIPPED or (tag == "header" and not inside and not section) or (tag == "noscript" and not inside):
        return False
    if not attributes:
        return True
    if "hidden" in attributes or "display:none" in attributes.get("style", "").replace(" ", "") or attributes.get("role", "").lower() in _ROLES:
        return False
    return tag in ("html", "body", "article", "main") or not any(map(_no_article_name, _names(attributes, ("class",) if inside and tag in _ANCHORS else ("class", "id"))))


def _signature(tag: str, attributes: dict[str, str]) -> str:
    return ".".join([tag, *sorted(w for words in _names(attributes, ("class",)) for w in words)]) if attributes else tag


class _Place:
    """An open element: its sign, the one around it, a number for the whole path, its first elements below body, and the outermost article around it."""

    __slots__ = ("sign", "up", "number", "top", "article", "section")

    def __init__(self, sign: str, up: _Place | None) -> None:
        tag = sign.split(".")[0]
        self.section = tag == "section" or (up is not None and up.section)
        self.sign, self.up = sign, up
        self.number = _number(str(up.number), sign) if up else 0
        above = up.top if up else ()
        self.top = above if tag in ("html", "body", "") or len(above) == LAYOUT_DEPTH else (*above, sign)
        #: what a page itself calls its article is kept, even where all pages have it
        self.article: _Place | None = up.article if up and up.article else self if tag in ("article", "main") else None

    def path(self) -> list[str]:
        out, at = [], self
        while at.up is not None:
            out.append(at.sign)
            at = at.up
        return out[::-1]


def _whole_forms(page: str) -> set[int]:
    """The numbers of forms that are no part of a page but wrap it: with an article, a heading of the first level or most of the text inside."""
    if "<form" not in page and "<FORM" not in page and "<Form" not in page:
        return set()
    open_: list[tuple[int, str]] = []
    size: dict[int, int] = {}
    whole: set[int] = set()
    made = total = 0
    for kind, value, _ in _events(page):
        if kind == "text":
            n = len(value.split())
            total += n
            for k, tag in open_:
                if tag == "form":
                    size[k] = size.get(k, 0) + n
        elif kind == "open":
            made += 1
            if value in ("article", "main", "h1"):
                whole |= {k for k, tag in open_ if tag == "form"}
            if value == "form":
                open_.append((made, value))
        elif value == "form" and open_:
            open_.pop()
    return whole | {k for k, n in size.items() if 2 * n > total}


def _blocks(page: str) -> Iterator[tuple[_Place, str]]:
    """Each block of article text: the element it ends in, and its text."""
    at = _Place("", None)
    skip, made = 0, 0  # no places are made for what is skipped
    whole = _whole_forms(page)
    text: list[str] = []
    for kind, value, attributes in _events(page):
        if kind == "text":
            if not skip:
                text.append(value)
            continue
        if value in _BLOCKS and text:
            block = " ".join("".join(text).split())
            text = []
            if block:
                yield at, block
        if value == "br" and kind == "open" and not skip:
            text.append(" ")
        if kind == "open":
            made += 1
            if skip or not (made in whole or _is_article(value, attributes, at.article is not None, at.section)):
                skip += 1
            else:
                at = _Place(_signature(value, attributes), at)
        elif skip:
            skip -= 1
        else:
            at = at.up
    block = " ".join("".join(text).split())
    if block:
        yield at, block


class _Node:
    """An element that holds text: the number of its path, the blocks that end in it, and numbers that are equal for equal trees and for equal shapes."""

    __slots__ = ("sign", "number", "blocks", "children", "shape", "same", "size")

    def __init__(self, sign: str, number: int) -> None:
        self.sign, self.number, self.blocks, self.children = sign, number, [], []


def _tree(page: str) -> _Node:
    """The page's elements that hold article text, with their blocks; what an article or main holds is no template and left out."""
    root = _Node("", 0)
    nodes: dict[_Place, _Node] = {}
    for place, text in _blocks(page):
        last, lead = place.article or place, []
        at = last
        while at.up is not None and at not in nodes:
            lead.append(at)
            at = at.up
        node = nodes[at] if at.up is not None else root
        for p in reversed(lead):
            nodes[p] = _Node(p.sign, p.number)
            node.children.append(nodes[p])
            node = nodes[p]
        if place.article is None:
            node.blocks.append(text)
    for node in [*reversed(nodes.values()), root]:  # children are made after their parents
        node.shape = hash((node.sign, *[c.shape for c in node.children]))
        node.same = hash((node.shape, *node.blocks, *[c.same for c in node.children]))
        node.size = 1 + sum(c.size for c in node.children)
    return root


#: So many weights are remembered; beyond that they are worked out again.
_KNOWN = 1_000_000
#: A matched element outweighs all ties between equal subtrees.
_ELEMENT = 1 << 32


class _Weights(dict):
    """The size of the best match of two elements, by their shapes."""

    def simple(self, a: _Node, b: _Node) -> int | None:
        """The weight, if it needs no match of children or is remembered."""
        if a.sign != b.sign:
            return 0
        if a.shape == b.shape:
            return a.size * _ELEMENT + (a.same == b.same)
        if not a.children or not b.children:
            return _ELEMENT
        return self.get((a.shape, b.shape))

    def of(self, a: _Node, b: _Node) -> int:
        """The weight; pairs of children are worked out before their parents, without recursion, as elements may be deep."""
        if len(self) >= _KNOWN:
            self.clear()
        left = [(a, b)]
        while left:
            u, v = left[-1]
            if self.simple(u, v) is not None:
                left.pop()
                continue
            missing = [(x, y) for x in u.children for y in v.children if self.simple(x, y) is None]
            if missing:
                seen = set()
                left += [(x, y) for x, y in missing if (k := (x.shape, y.shape)) not in seen and not seen.add(k)]
                continue
            self[u.shape, v.shape] = (1 + _best(u.children, v.children, self)[-1] // _ELEMENT) * _ELEMENT
            left.pop()
        return self.simple(a, b)


def _best(x: list[_Node], y: list[_Node], weight: _Weights) -> list[int]:
    """The weight of the best order-preserving match of ``x`` with each beginning of ``y``."""
    best = [0] * (len(y) + 1)
    for u in x:
        corner = left = 0
        for j, v in enumerate(y, 1):
            w = weight.simple(u, v)
            here = max(corner + (weight.of(u, v) if w is None else w), best[j], left)
            corner, best[j], left = best[j], here, here
    return best


def _align(x: list[_Node], y: list[_Node], weight: _Weights) -> list[tuple[_Node, _Node]]:
    """The pairs of a best match of all of ``x`` and ``y``: equal ends first, the rest by halves, so memory is linear."""
    n, s, e = min(len(x), len(y)), 0, 0
    while s < n and x[s].same == y[s].same:
        s += 1
    while e < n - s and x[-1 - e].same == y[-1 - e].same:
        e += 1
    ends = [*zip(x[:s], y[:s]), *zip(x[len(x) - e :], y[len(y) - e :])]
    x, y = x[s : len(x) - e], y[s : len(y) - e]
    if not x or not y:
        return ends
    if len(x) == 1:
        v = max(y, key=lambda v: weight.of(x[0], v))
        return ends + [(x[0], v)] * (weight.of(x[0], v) > 0)
    half = len(x) // 2
    front, back = _best(x[:half], y, weight), _best(x[:half - 1 : -1], y[::-1], weight)
    cut = max(range(len(y) + 1), key=lambda j: front[j] + back[len(y) - j])
    return ends + _align(x[:half], y[:cut], weight) + _align(x[half:], y[cut:], weight)


def _match(a: _Node, b: _Node) -> tuple[int, list[tuple[_Node, _Node]]]:
    """Simple tree matching: the size of the best order-preserving top-down match, and its pairs; of matches of one size, one with most equal subtrees."""
    if a.sign != b.sign:
        return 0, []
    weight, pairs, left = _Weights(), [], [(a, b)]
    while left:
        u, v = left.pop()
        pairs.append((u, v))
        left += _align(u.children, v.children, weight)
    return len(pairs), pairs


def _number(*words: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(words).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _key(number: int, text: str) -> int:
    return _number(str(number), text)


def _profile(page: str) -> tuple[int, int, list[int]]:
    """A number for all the page's blocks, one for its layout, and the keys of the blocks that may be template."""
    whole, keys, layout = hashlib.blake2b(digest_size=8), set(), set()
    for place, text in _blocks(page):
        key = _key(place.number, text)
        whole.update(key.to_bytes(8, "little", signed=True))
        if place.article is None:
            keys.add(key)
        top = list(place.top)
        while top and top[-1].split(".")[0] not in _CONTAINERS:
            top.pop()
        layout.add("/".join(top))
    return int.from_bytes(whole.digest(), "little", signed=True), _number(*sorted(layout)) or 1, sorted(keys)


def _repeated(model: _Node, tree: _Node, wanted: set[int]) -> set[int]:
    """The ``wanted`` keys of ``model`` whose text the matching element of ``tree`` has too."""
    return {key for u, v in _match(model, tree)[1] for text in u.blocks if text in v.blocks and (key := _key(u.number, text)) in wanted}


def induce(pages: list[str]) -> dict:
    """The wrapper of pages of one layout, as ``extract_main_text`` finds it: constants as [path, text], and the innermost element that holds all else."""
    different = {p[0]: (page, set(p[2])) for page in sorted(pages) for p in [_profile(page)]}
    least = max(2, TEMPLATE_SHARE * len(different))
    keys = [k for _, ks in different.values() for k in ks]
    often = {k for k in set(keys) if keys.count(k) >= least}
    trees = {page: _tree(page) for page, _ in different.values()}
    known = set()
    for key in often:
        model = max((len(ks & often), page) for page, ks in different.values() if key in ks)[1]
        if sum(key in _repeated(trees[model], t, {key}) for t in trees.values()) >= least:
            known.add(key)
    constants: dict[int, list] = {}
    held: dict[tuple[str, ...], int] = {}
    often_in: dict[tuple[str, ...], int] = {}
    total = 0
    for page in pages:
        seen: dict[tuple[str, ...], set[_Place]] = {}
        for place, text in _blocks(page):
            if (key := _key(place.number, text)) in known:
                constants[key] = [place.path(), text]
                continue
            total += len(text)
            while place.up is not None:
                path = tuple(place.path())
                held[path] = held.get(path, 0) + len(text)
                seen.setdefault(path, set()).add(place)
                place = place.up
        for p, s in seen.items():
            often_in[p] = max(often_in.get(p, 0), len(s))
    fit = [p for p in held if often_in[p] == 1 and p[-1].split(".")[0] in _CONTAINERS and held[p] == total]
    return {"container": list(max(fit, key=len, default=())), "constants": list(constants.values())}


def _extract(page: str, constants: set[int]) -> str:
    """All blocks that are no constants, wherever they stand."""
    return "\n\n".join(text for place, text in _blocks(page) if not constants or _key(place.number, text) not in constants)


@F.arrow_udf(T.StructType().add("digest", T.LongType()).add("layout", T.LongType()).add("keys", T.ArrayType(T.LongType())))
def _profiles(page: pa.Array) -> pa.Array:
    digest, layout, keys = zip(*[_profile(p.as_py() or "") for p in page]) if len(page) else ((), (), ())
    return pa.StructArray.from_arrays([pa.array(digest, pa.int64()), pa.array(layout, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], ["digest", "layout", "keys"])


@F.arrow_udf(T.ArrayType(T.LongType()))
def _repeats(page: pa.Array, model: pa.Array, wanted: pa.Array) -> pa.Array:
    trees: dict[str, _Node] = {}
    out = []
    for p, m, w in zip(page.to_pylist(), model.to_pylist(), wanted.to_pylist()):
        if m not in trees:
            trees[m] = _tree(m)
        out.append(sorted(_repeated(trees[m], _tree(p), set(w))))
    return pa.array(out, pa.list_(pa.int64()))


@F.arrow_udf(T.StringType())
def _texts(page: pa.Array, of_host: pa.Array, of_layout: pa.Array) -> pa.Array:
    return pa.array([_extract(p.as_py(), {*(h.as_py() or ()), *(k.as_py() or ())}) if p.as_py() else "" for p, h, k in zip(page, of_host, of_layout)], pa.string())


def _few_by(rows: DataFrame, size: Column, most: int) -> DataFrame:
    """``rows``, marked for broadcast if the sum of their sizes is ``most`` at the highest."""
    held = rows.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return F.broadcast(rows) if held <= most else rows


def _constants(hosted: DataFrame) -> DataFrame:
    """From _host and html: _host, group and keys: the template of each host (group 0) and of each layout of a host.

    Keys are counted over all different pages.  A key that is frequent enough
    has a model, the page with most such keys among those that have it; all
    pages of the group are aligned with it, and the aligned repeats are counted.
    """
    by = ["_host", "group"]
    groups = lambda layout: F.explode(F.array(F.lit(0).cast("long"), layout)).alias("group")
    read = hosted.filter(F.length("html") > 0).select("_host", "html", F.md5(F.col("html").cast("binary")).alias("page"))
    different = read.select("_host", "page", _profiles("html").alias("p")).groupBy("_host", "p.digest").agg(F.min(F.struct("page", "p.layout", "p.keys")).alias("p"))
    different = staged(different.select("_host", "p.*"), "different")
    sizes = different.select("_host", groups("layout")).groupBy(by).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    keyed = different.select("_host", "page", groups("layout"), "keys").select(*by, "page", F.explode("keys").alias("key"))
    counts = keyed.groupBy(*by, "key").agg(F.count(F.lit(1)).alias("hits")).filter("hits > 1")
    often = staged(counts.join(few(sizes), by).filter(F.col("hits") >= F.col("n") * TEMPLATE_SHARE).select(*by, "key", "n"), "often")

    scored = keyed.join(few(often), [*by, "key"]).groupBy(*by, "page").agg(F.collect_set("key").alias("keys"))
    model = F.max_by("page", F.struct(F.size("keys"), "page")).alias("page")
    chosen = scored.withColumn("key", F.explode("keys")).groupBy(*by, "key").agg(model)
    chosen = staged(chosen.groupBy(*by, "page").agg(F.collect_set("key").alias("wanted")), "chosen")
    html = read.join(few(chosen.select("_host", "page").distinct()), ["_host", "page"]).groupBy("_host", "page").agg(F.first("html").alias("model"))
    models = staged(chosen.join(html, ["_host", "page"]).drop("page"), "models")

    several = read.join(few(models.select("_host").distinct()), "_host", "left_semi").select("_host", "html", _profiles("html").alias("p"))
    pairs = several.select("_host", "html", "p.digest", groups("p.layout")).join(_few_by(models, F.length("model") + 8 * F.size("wanted"), BROADCAST_CHARS), by)
    repeats = pairs.select(*by, "digest", F.explode(_repeats("html", "model", "wanted")).alias("key")).distinct()
    hits = repeats.groupBy(*by, "key").agg(F.count(F.lit(1)).alias("hits"))
    found = often.join(hits, [*by, "key"]).filter(F.col("hits") >= F.col("n") * TEMPLATE_SHARE)
    return staged(found.groupBy(by).agg(F.collect_set("key").alias("keys")), "constants")


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html and any other columns) with a column text.

    Blocks of the article in page order, white space inside a block turned into
    one space, joined by two line ends.  Whole pages are read.  A null or empty
    page gives an empty text.  Pages without a host form one host of their own.
    Template is what ``TEMPLATE_SHARE`` of all different pages of a host or of
    one of its layouts have; pages of the same blocks count once, so a host with
    one page has none.  A column named text is replaced, all others stay.  No row
    is dropped or repeated, and an empty table gives an empty result.
    """
    held = pages.drop("text")
    host, layout, of_host, of_layout = fresh(held, "host", "layout", "of_host", "of_layout")
    told = F.coalesce(host_of(F.col("url")), F.lit(""))
    constants = _constants(pages.select(told.alias("_host"), "html"))
    by_host = constants.filter("group = 0").select(F.col("_host").alias(host), F.col("keys").alias(of_host))
    by_layout = constants.filter("group <> 0").select(F.col("_host").alias(host), F.col("group").alias(layout), F.col("keys").alias(of_layout))
    known = held.withColumn(host, told).withColumn(layout, _profiles("html")["layout"])
    known = known.join(_few_by(by_host, F.size(of_host) + 1, BROADCAST_KEYS), host, "left").join(_few_by(by_layout, F.size(of_layout) + 1, BROADCAST_KEYS), [host, layout], "left")
    return known.select(*[F.col(f"`{c}`") for c in held.columns], _texts("html", of_host, of_layout).alias("text"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    out = extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
