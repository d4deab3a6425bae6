"""Main text of web pages: site templates are found by their recurrence and removed.

Each page is parsed to its element tree, and every element gets a hash of its whole subtree: its tag,
the hashes of its children and its text. Spark counts, for each host, the pages on which a subtree
occurs. A subtree that recurs on many pages of its host is deleted with all that it holds. Pages with
one and the same body count once, so a page served under many addresses is no template of itself.

How often a subtree must recur depends on where it is. The content of a page is its ``main`` or
``article`` elements, or else the smallest element that holds most of its text. Outside of it, and for
runs of links, few pages are enough (``SHARE``); boxes inside of it (``div``, lists, tables) must recur
in more different contents (``SHARE_OF_BOX``). A plain block of a content that the page names, such as
a paragraph, is the article's own however often it is quoted; of a content that was only guessed, it
goes if half of the host's pages have it (``SHARE_OF_BLOCK``).

What is rare on its host is judged by its markup: elements that HTML has for menus, headers, footers,
sidebars, forms and the like, their ARIA roles, and class or id words such as ``cookie`` or
``comments``. Where a page names its content, nothing outside of it stays.

The text: character references decoded, white space in a block turned into one space, blocks joined
by line breaks. ``br`` is white space, cells of a table row share a block. NULL and empty pages have
an empty text; pages without a host (no ``scheme://host``) share templates with no one. Very long pages
are whole, each in the memory of one task, about 50 times its size; elements nested more than 512 deep
are flattened, as browsers do, and keep their text. Repeated rows stay, each with its text, and NULL in
``page_id`` or ``url`` stays NULL. Other columns are not read; empty tables give empty results.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgepulse.llm.support import Scratch, row_slices

#: A subtree is a template on at least so many pages of its host, and this share of them.
LEAST_PAGES, SHARE = 3, 0.005
#: The same for boxes inside a content, and for plain blocks of a content that was guessed.
LEAST_PAGES_INSIDE, SHARE_OF_BOX, SHARE_OF_BLOCK = 5, 0.05, 0.5
#: Elements are nested so deep at most.
DEPTH = 512

# Elements of HTML by what they are, ARIA roles, and words of class names and ids.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
_IN_ROW = frozenset(("td", "th"))
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An opening element -> elements that it ends, and those behind which it does not look for them.
_SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}
_TABLE_PARTS = frozenset("table thead tbody tfoot tr td th caption".split())
_IN_HEAD = frozenset("title meta link base script style noscript template".split())
#: Blocks of running text; other blocks are boxes.
_PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd address figcaption center".split())
_NO_TEXT = frozenset(
    "head title script style noscript template iframe object embed svg math canvas audio video map textarea "
    "select datalist xmp noembed noframes".split()
)
_FURNITURE = frozenset("nav aside footer menu dialog button search fieldset".split())
_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar "
    "tablist tooltip status".split()
)
_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs captcha "
    "comment comments consent cookie cookies copyright disqus footer gdpr login masthead menu menus "
    "modal nav navbar navigation newsletter notice notices notification notifications pager pagination paywall "
    "popup popups promo promoted promotion promotions recommended recommendations related reply replies respond "
    "search share sharing sidebar sidebars signin signup skip social sponsor sponsored sponsors subscribe "
    "subscription toolbar widget widgets".split()
)
_NEGATIONS = frozenset(("no", "has", "with", "without", "hide", "hides"))

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|</(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+>?"
    r"|<(?P<tag>[a-zA-Z][^\s/>]*+)"
    r"(?P<attributes>(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+)(?:>|\Z)"
    r"|<[!?/][^>]*+>?",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"(?<![^\s\"'/])(class|id|role|hidden|style|aria-hidden)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?(?=[\s/\"']|\Z)",
    re.IGNORECASE,
)
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_SPACE = re.compile(r"\s+")
_NO_WORD = re.compile(r"[^a-z0-9]+")
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


# How an element is marked.
_CONTENT, _UNMARKED, _HEADER, _FORM, _FURNISHED = -1, 0, 1, 2, 3


class Element:
    """An element of a page, with what the decisions need to know of its subtree."""

    __slots__ = (
        "tag", "parent", "depth", "children", "mark", "hash", "chars", "linked", "titled", "within", "under",
    )

    def __init__(self, tag: str, parent: Element | None, mark: int):
        self.tag, self.parent, self.mark = tag, parent, mark
        self.depth = parent.depth + 1 if parent else 0
        self.children: list = []
        self.hash = self.chars = self.linked = 0  # of the subtree; characters of text, and of links
        self.titled = False  # holds a heading
        self.within = 0  # 0 outside the content, 1 inside, 2 around it
        self.under: tuple = ()  # candidates that it is part of

    def elements(self) -> list[Element]:
        return [c for c in self.children if isinstance(c, Element)]

    def upward(self) -> Iterator[Element]:
        here: Element | None = self
        while here is not None:
            yield here
            here = here.parent


def _mark(tag: str, attributes: str) -> int:
    if tag in _FURNITURE or tag in _NO_TEXT:
        return _FURNISHED
    mark = {"header": _HEADER, "form": _FORM, "main": _CONTENT}.get(tag, _UNMARKED)
    if "=" not in attributes and "hidden" not in attributes.lower():
        return mark
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), references.unescape(value.strip("\"'")).strip()
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return _FURNISHED
        if name == "role" and value.lower() in _ROLES:
            return _FURNISHED
        if name == "role" and value.lower() == "main":
            return _CONTENT
        if name == "style" and _HIDDEN_STYLE.search(value):
            return _FURNISHED
        if name in ("class", "id") and tag not in ("body", "main"):
            for part in value.split():
                words = [w for w in _NO_WORD.split(_CAMEL.sub("-", part).lower()) if w]
                if not _NEGATIONS.isdisjoint(words):
                    continue
                if not _WORDS.isdisjoint(words):
                    return _FURNISHED
                if "header" in words and mark == _UNMARKED:
                    mark = _HEADER
    return mark


def parse(page: str) -> Element:
    """The element tree, open ends as browsers close them: paragraphs, list items, rows and cells end
    where the next one or their parent does, and stray end tags are passed over."""
    root = Element("#page", None, _UNMARKED)
    here, at, size, flat = root, 0, len(page), Counter()
    while at < size:
        token = _TOKEN.search(page, at)
        begin = token.start() if token else size
        if begin > at:
            text = page[at:begin]
            if here.tag == "head" and not text.isspace():
                here = here.parent
            here.children.append(text)
        if not token:
            break
        at = token.end()
        if token["end"]:
            tag = token["end"].lower()
            if flat[tag]:
                flat[tag] -= 1
            else:
                here = _close(here, tag)
            continue
        if not token["tag"]:
            continue
        tag = token["tag"].lower()
        if here.tag == "head" and tag not in _IN_HEAD:
            here = here.parent
        if tag in _ENDS_P:
            here = _end(here, {"p"}, {"table", "td", "th", "caption", "button"})
        if tag in _SIBLINGS:
            here = _end(here, *_SIBLINGS[tag])
        if tag in ("html", "body") and (tag == "html" or any(a.tag == "body" for a in here.upward())):
            continue
        element = Element(tag, here, _mark(tag, token["attributes"]))
        here.children.append(element)
        if tag in _VOID:
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(page, at)
            if not end:
                break
            at = end.start()
            here = element
        elif here.depth < DEPTH:
            here = element
        else:
            flat[tag] += 1
    return root


def _end(here: Element, tags: set, limits: set) -> Element:
    """Behind the nearest open element of ``tags``, if one is open before any of ``limits``."""
    look = here
    while look.parent is not None and look.tag not in limits:
        if look.tag in tags:
            return look.parent
        look = look.parent
    return here


def _close(here: Element, tag: str) -> Element:
    inline = tag in _INLINE
    for look in here.upward():
        if look.parent is None:
            break
        if look.tag == tag:
            return look.parent
        if inline and look.tag not in _INLINE or look.tag in _IN_ROW and tag not in _TABLE_PARTS:
            break
    if tag in ("br", "p"):  # both stand for an element without text
        here.children.append(Element(tag, here, _UNMARKED))
    return here


def in_order(root: Element) -> list[Element]:
    """All elements, parents before their children."""
    found, waiting = [], [root]
    while waiting:
        element = waiting.pop()
        found.append(element)
        waiting += reversed(element.elements())
    return found


def measure(elements: list[Element]) -> None:
    """Subtree hashes and sizes, children before their parents. What is marked does not count as text
    of its parent; a form does not count as marked if it holds most of the page."""
    for element in reversed(elements):
        parts = [element.tag.encode()]
        for child in element.children:
            if isinstance(child, str):
                text = " ".join(child.split())
                parts.append(b"text:" + text.encode())
                element.chars += len(text)
                continue
            parts.append(b"tree:" + child.hash.to_bytes(8, "little"))
            if child.mark < _FURNISHED and child.mark != _HEADER:
                element.chars += child.chars
                element.linked += child.chars if child.tag == "a" else child.linked
            element.titled |= child.titled or child.tag in _HEADING
        element.hash = xxhash.xxh3_64_intdigest(b"\0".join(parts))
    for element in elements:
        if element.mark == _FORM and 2 * element.chars > elements[0].chars:
            element.mark = _UNMARKED


def content(elements: list[Element]) -> tuple[list[Element], bool]:
    """The elements that hold a page's content, and whether the page itself names them."""
    named = [e for e in elements if e.mark == _CONTENT and e.chars]
    if not named:
        named = [
            e for e in elements
            if e.tag == "article" and e.chars and not any(a.mark in (_HEADER, _FURNISHED) for a in e.upward())
        ]
    if named:
        inside = set(map(id, named))
        return [e for e in named if not any(id(a) in inside for a in e.parent.upward())], True
    holder = elements[0]
    while True:
        inner = [
            e for e in holder.elements()
            if e.mark == _UNMARKED and e.tag not in _INLINE and e.tag not in _PLAIN and 2 * e.chars > elements[0].chars
        ]
        if not inner:
            return [holder], False
        holder = inner[0]


def candidates(elements: list[Element], held: list[Element], named: bool) -> dict[int, tuple[int, float]]:
    """What may be a template: name of the subtree -> the page or content that it counts for, and the
    share of the pages that it needs. Also tells each element its place and the candidates around it."""
    body = next((e for e in elements if e.tag == "body"), elements[0]).hash
    own = xxhash.xxh3_64_intdigest(b"".join(e.hash.to_bytes(8, "little") for e in held))
    for element in held:
        element.within = 1
        for around in element.parent.upward() if element.parent else ():
            around.within = 2
    roots = set(map(id, held))
    found: dict[int, tuple[int, float]] = {}
    for element in elements[1:]:
        parent = element.parent
        if not element.within:
            element.within = 1 if parent.within == 1 else 0
        element.under = parent.under
        if not element.chars or element.tag in _INLINE or element.tag in _NO_TEXT or element.tag == "body":
            continue
        if element.within == 2 or id(element) in roots:
            continue
        if not element.within or element.mark == _FURNISHED or 2 * element.linked >= element.chars:
            rule = body, SHARE
        elif element.tag not in _PLAIN:
            rule = own, SHARE_OF_BOX
        elif not named:
            rule = own, SHARE_OF_BLOCK
        else:
            continue
        # Counted apart by rule, so each count is of one kind.
        name = _signed(element.hash ^ hash(rule[1]))
        found[name] = _signed(rule[0]), rule[1]
        element.under = (*parent.under, name)
    return found


def _signed(number: int) -> int:
    return number - 2**64 if number >= 2**63 else number


def _kept(element: Element, named: bool) -> bool:
    """By its markup and place alone. What is around the content stays whatever it is called, and so
    does the header of a named content with its heading."""
    if element.within == 2:
        return True
    if element.mark >= _FORM:
        return False
    if element.mark == _HEADER:
        return named and element.within == 1 and element.titled
    return element.within == 1 or not named


def pieces_of(root: Element, named: bool) -> list[tuple[str, tuple]]:
    """Runs of text that markup keeps, each with the candidates that it is part of; "\\n" ends a block."""
    runs: list[tuple[str, tuple]] = []
    waiting: list = [root]
    while waiting:
        node = waiting.pop()
        if isinstance(node, tuple):
            runs.append(node)
            continue
        block = node.tag not in _INLINE and node.tag not in _IN_ROW
        if not _kept(node, named):
            runs.append(_BREAK if block else ("", ()))
            continue
        if block:
            runs.append(_BREAK)
            waiting.append(_BREAK)
        elif node.tag == "br" or node.tag in _IN_ROW:
            runs.append((" ", node.under))
        for child in reversed(node.children):
            if isinstance(child, Element):
                waiting.append(child)
            elif node.within == 1 or not named:
                waiting.append((child, node.under))
    return _merged(runs)


_BREAK = ("\n", None)


def _merged(runs: list[tuple]) -> list[tuple[str, tuple]]:
    out: list[tuple[str, tuple]] = []
    for under, group in groupby(runs, key=lambda r: r[1]):
        if under is None:
            out.append(("\n", ()))
            continue
        text = _SPACE.sub(" ", references.unescape("".join(t for t, _ in group)))
        if text:
            out.append((text, under))
    return out


_PARSED = (
    "host string, body long, pieces array<struct<text:string,under:array<long>>>, "
    "trees array<struct<tree:long,seen:long,share:double>>"
)


def parse_pages(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) without their markup: page_id, url, host, body (hash), pieces and
    trees, the candidates for templates."""
    kinds = ", ".join(f"{n} {pages.schema[n].dataType.simpleString()}" for n in ("page_id", "url"))
    of_pieces = pa.list_(pa.struct([("text", pa.string()), ("under", pa.list_(pa.int64()))]))
    of_trees = pa.list_(pa.struct([("tree", pa.int64()), ("seen", pa.int64()), ("share", pa.float64())]))

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            bodies, pieces, trees = [], [], []
            for page in batch.column(3):
                elements = in_order(root := parse(page.as_py() or ""))
                measure(elements)
                held, named = content(elements)
                found = candidates(elements, held, named)
                bodies.append(_signed(next((e for e in elements if e.tag == "body"), root).hash))
                pieces.append([{"text": t, "under": u} for t, u in pieces_of(root, named)])
                trees.append([{"tree": t, "seen": seen, "share": share} for t, (seen, share) in found.items()])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(bodies, pa.int64()), pa.array(pieces, of_pieces), pa.array(trees, of_trees)],
                ["page_id", "url", "host", "body", "pieces", "trees"],
            )

    read = pages.select("page_id", "url", host_of("url").alias("host"), "html")
    return read.mapInArrow(parsed, f"{kinds}, {_PARSED}")


def host_of(url: str | Column) -> Column:
    """Host of an address in lower case, without user, port or ``www.``; NULL if it names none."""
    named = F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:\s]+)", 1)
    return F.nullif(F.regexp_replace(F.lower(named), r"^www\.|\.$", ""), F.lit(""))


def templates(parsed: DataFrame, least: int = LEAST_PAGES) -> DataFrame:
    """(host, tree, pages) of the subtrees that recur on enough pages of their host.

    What is shuffled is numbers, not markup; the subtrees of a hot host are many keys, and one that is
    on all its pages is counted in each map task first.
    """
    own = parsed.where(F.col("host").isNotNull())
    bodies = own.select("host", "body").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("bodies"))
    counted = (
        own.select("host", F.explode("trees").alias("t")).select("host", "t.tree", "t.seen", "t.share").distinct()
        .groupBy("host", "tree", "share").agg(F.count(F.lit(1)).alias("pages"))
    )
    enough = F.when(F.col("share") == SHARE, F.lit(least)).otherwise(F.lit(max(least, LEAST_PAGES_INSIDE)))
    return (
        counted.where(F.col("pages") >= enough).join(bodies, "host")
        .where(F.col("pages") >= F.col("share") * F.col("bodies")).select("host", "tree", "pages")
    )


def main_text(pages: DataFrame, least: int = LEAST_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of every page: its main text, and the code points of that.

    Pages whose remaining text is not part of any candidate are done once they are parsed; only the
    others are joined with the templates of their hosts, by subtree.
    """
    scratch = Scratch(pages.sparkSession, "pages")
    parsed, _ = scratch.write(
        parse_pages(pages).withColumn("place", F.monotonically_increasing_id())
        .withColumn("asks", F.array_distinct(F.flatten("pieces.under")))
    )
    recurring, _ = scratch.write(templates(parsed, least))
    asking = parsed.where(F.size("asks") > 0)
    gone = (
        asking.select("place", "host", F.explode("asks").alias("tree"))
        .join(recurring, ["host", "tree"]).groupBy("place").agg(F.collect_list("tree").alias("gone"))
    )
    none = F.array().cast("array<long>")
    joined = asking.join(gone, "place", "left").select("page_id", "url", "pieces", F.coalesce("gone", none).alias("gone"))
    done = parsed.where(F.size("asks") == 0).select("page_id", "url", "pieces", none.alias("gone"))
    kept = F.filter("pieces", lambda piece: ~F.arrays_overlap(piece["under"], F.col("gone")))
    text = F.array_join(F.transform(kept, lambda piece: piece["text"]), "")
    text = F.regexp_replace(F.regexp_replace(text, " {2,}", " "), r" ?\n[ \n]*", "\n")
    found = joined.unionAll(done).select("page_id", "url", F.trim(text, F.lit(" \n")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
