"""HTML extraction (operator 11): tag-path ratios.

A page is read once into text nodes, each with its path of tags from the root. For each path of a page, text length,
punctuation and links are summed over its nodes; the ratios (characters and punctuation a node, share of link text) are spread
along the page by a Gaussian, so that short nodes among long ones count with them, and fused with what names of tags and
classes say. Paths beyond a threshold are content. The content's container is then the smallest element with nearly all of
their text, and what stands in it, headings and short paragraphs included, is the main text but for navigation, notices,
adverts, forms and comments, which tags, classes and the paths' link ratios tell.

A page is a row and is judged by itself: no shuffle, and a task holds a page at a time."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAG = re.compile(r"""<(?:!--(?P<comment>)|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|(?P<broken>/?[a-zA-Z!?/])[^>]*+>)""")
#: A tag that the end of the page cuts off.
CUT = re.compile(r"<[a-zA-Z/!?][^>]*\Z")
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What is inside is no markup; it goes to the end tag of the same name.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements whose start and end part blocks of text.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul caption".split())
#: A start tag ends the nearest open element of these, unless one of the others is nearer.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "thead": ({"tr", "tbody"}, {"table"}), "tbody": ({"tr", "thead", "tbody"}, {"table"}), "tfoot": ({"tr", "tbody"}, {"table"})}
#: Elements that are never main text, and the names in class, id and role that say so.
NOT_TEXT = frozenset("head title script style noscript template textarea select option button form nav footer aside menu svg math canvas object iframe noembed noframes audio video dialog datalist map search label input".split())
NAMES = frozenset("nav navbar navigation navbox menu menubar breadcrumb breadcrumbs masthead topbar banner footer bottombar sidebar aside rail ad ads adbox adsense advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion promoted cookie cookies consent gdpr notice notices notification notifications popup popups modal overlay dialog newsletter subscribe subscription signup share sharing sharebar social related recommended recommendations trending comment comments commentlist disqus replies respond reply widget widgets toolbar pagination pager login search searchbox contentinfo complementary toc".split())
#: "header" among a class's names means the page's, unless it is that of the text itself.
OF_TEXT = frozenset("article entry post story content section title headline".split())
#: Beside such a word a name tells what the whole page has or lacks (has-sidebar, no-ads), not what the element is.
OF_PAGE = frozenset("has with no without".split())
COMMENTS = frozenset("comment comments commentlist disqus replies respond reply".split())
TEXT_HOLDERS, HEADINGS = frozenset(("article", "main")), frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Elements too small to hold a whole text.
SMALL = HEADINGS | frozenset("p pre td th tr tbody li blockquote dd dt figcaption".split())
SPLIT_NAME = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z0-9])(?=[A-Z])")
PUNCTUATION = re.compile(r"[.,;:!?、。！，：；？]")
#: Spread of the ratios along the page, in nodes; the share of the best path's value that makes a path content; how much more a path
#: below article or main counts; the share of the content's text that its container holds.
SIGMA, THRESHOLD, HELD, WHOLE = 1.0, 0.2, 3.0, 0.9
#: A path of so many nodes or more is a menu if that share of its text is links, of so few characters a node.
MENU_NODES, MENU_LINKS, MENU_CHARS = 3, 0.95, 40


@dataclass
class Element:
    """path: number of the tags and classes from the root; text: characters of content in it; kept: whether it is in the container."""

    tag: str
    parent: Element | None
    path: int
    #: Why the text inside is none of the main text: "" (it may be), "part" or "comments".
    out: str = ""
    holder: bool = False
    link: bool = False
    text: int = 0
    kept: bool = False


@dataclass
class Block:
    """The text between two limits of blocks, within one element."""

    element: Element
    runs: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def _names(attributes: str) -> tuple[set[str], bool, str]:
    """The words of class, id and role, whether the element is hidden, and class as it stands."""
    words, hidden, kind = set(), False, ""
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id", "role"):
            words.update(w.lower() for w in SPLIT_NAME.split(value) if w)
            kind = value if name == "class" else kind
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            hidden = True
    return words, hidden, kind


def _open(tag: str, attributes: str, parent: Element, paths: dict[tuple[int, str, str], int]) -> Element:
    words, hidden, kind = _names(attributes) if attributes.strip(" /") else (set(), False, "")
    out = parent.out
    if tag == "main" or tag == "article" and out == "part":
        out = ""  # a sidebar that was never closed does not hold the text
    if tag not in ("html", "body", "main"):
        named = frozenset() if words & OF_PAGE else words
        if named & COMMENTS:
            out = "comments"
        elif tag != "article" and not out and (tag in NOT_TEXT or hidden or named & NAMES or "header" in words and not words & OF_TEXT or tag == "header" and not parent.holder):
            out = "part"
    path = paths.setdefault((parent.path, tag, kind), len(paths) + 1)
    return Element(tag, parent, path, out, parent.holder or tag in TEXT_HOLDERS or "main" in words and tag == "div", parent.link or tag == "a")


def read(page: str) -> tuple[list[Element], list[Block]]:
    """All elements of a page, each after its parent, and all blocks of text in order, without scripts, styles, comments and the head's title."""
    at, last = 0, page.rfind(">")
    here = Element("", None, 0)
    elements, paths, opened = [here], {}, Counter()
    found: list[Block] = []
    new = True

    def text(value: str) -> None:
        nonlocal new
        if not value:
            return
        if "&" in value:
            value = html.unescape(value)
        if new and value.isspace():
            return
        if new:
            holder = here
            while holder.parent is not None and holder.tag not in BLOCKS:
                holder = holder.parent
            # Text within an inline element that is out (a button, a label) is a block of its own.
            found.append(Block(here if here.out != holder.out else holder))
            new = False
        found[-1].runs.append(value)
        if here.link:
            found[-1].linked += len(value.strip())

    def close(to: Element) -> None:
        nonlocal here
        while here is not to:
            opened[here.tag] -= 1
            here = here.parent

    while m := TAG.search(page, at, last + 1):
        text(page[at : m.start()])
        at = m.end()
        if m["comment"] is not None:
            end = page.find("-->", at)
            at = len(page) if end < 0 else end + 3
        elif m["name"]:
            tag = m["name"].lower()
            if m["end"]:
                e = here if opened[tag] else elements[0]
                while e.parent is not None and e.tag != tag and (tag in BLOCKS or e.tag not in BLOCKS):
                    e = e.parent
                if e.parent is not None and e.tag == tag:
                    new = new or tag in BLOCKS or e.out != e.parent.out
                    close(e.parent)
                elif tag == "p":
                    new = True
            elif tag in RAW:
                end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(page, at)
                at = len(page) if end is None else end.start()
                if end is not None:
                    after = page.find(">", at)
                    at = len(page) if after < 0 else after + 1
            elif tag == "br":
                text("\n" if not new else "")
            elif tag in VOID:
                new = new or tag == "hr"
            else:
                if tag in BLOCKS:
                    new = True
                    e = here  # a block ends the paragraph it stands in
                    while e.parent is not None and e.tag not in BLOCKS:
                        e = e.parent
                    if e.tag == "p" or e.tag in HEADINGS and tag in HEADINGS:
                        close(e.parent)
                    if tag in IMPLIED:
                        ends, stops = IMPLIED[tag]
                        e = here
                        while e.parent is not None and e.tag not in ends and e.tag not in stops:
                            e = e.parent
                        if e.tag in ends:
                            close(e.parent)
                e = _open(tag, m["rest"], here, paths)
                new = new or e.out != here.out
                here = e
                elements.append(e)
                opened[tag] += 1
    tail = CUT.search(page, at)
    text(page[at : tail.start() if tail else len(page)])
    for b in found:
        b.text = " ".join("".join(b.runs).split())
    return elements, [b for b in found if b.text]


def path_ratios(blocks: list[Block]) -> dict[int, tuple[float, float, float, int]]:
    """Of each path: characters, punctuation and share of link text a node, and its nodes."""
    total: dict[int, list[float]] = {}
    for b in blocks:
        t = total.setdefault(b.element.path, [0, 0, 0, 0])
        for k, x in enumerate((len(b.text), len(PUNCTUATION.findall(b.text)), min(b.linked, len(b.text)), 1)):
            t[k] += x
    return {p: (c / n, q / n, l / c, n) for p, (c, q, l, n) in total.items()}


def _content(blocks: list[Block], ratios: dict[int, tuple[float, float, float, int]]) -> set[int]:
    """Paths whose fused value passes the threshold."""
    fused = np.array([ratios[b.element.path][0] * (1 + ratios[b.element.path][1]) * (1 - ratios[b.element.path][2]) for b in blocks])
    near = np.arange(-2, 3)
    kernel = np.exp(-(near**2) / (2 * SIGMA**2))
    smooth = np.convolve(fused, kernel / kernel.sum())[2:-2] if len(fused) else fused
    values: dict[int, list[float]] = {}
    for b, raw, spread in zip(blocks, fused, smooth):
        values.setdefault(b.element.path, []).append(0.0 if b.element.out else float(np.sqrt(raw * spread)) * (HELD if b.element.holder else 1.0))
    mean = {p: sum(v) / len(v) for p, v in values.items()}
    best = max(mean.values(), default=0.0)
    return {p for p, v in mean.items() if v > 0 and v >= THRESHOLD * best}


def main_text(page: str | None) -> str:
    """The main text: blocks in order of the page, white space made one space each, joined by line feeds."""
    elements, blocks = read(page or "")
    ratios = path_ratios(blocks)
    content = _content(blocks, ratios)
    chosen = [b for b in blocks if b.element.path in content and not b.element.out]
    if not chosen:
        return ""
    # The smallest element with nearly all of the content's text, but not a part of an article or a single paragraph.
    for b in chosen:
        b.element.text += len(b.text)
    for e in reversed(elements[1:]):
        e.parent.text += e.text
    container = next(e for e in reversed(elements) if e.text >= WHOLE * elements[0].text)
    while container.parent is not None and (container.tag in SMALL or container.tag not in BLOCKS or container.parent.holder):
        container = container.parent
    container.kept = True
    for e in elements[1:]:
        e.kept = e.kept or e.parent.kept
    loose, beside = container.tag in ("", "html", "body"), {id(b.element.parent) for b in chosen}

    def menu(b: Block) -> bool:
        chars, _, links, n = ratios[b.element.path]
        return n >= MENU_NODES and links >= MENU_LINKS and chars < MENU_CHARS

    kept = [b for b in blocks if b.element.kept and not b.element.out and not menu(b) and (not loose or b.element.path in content or id(b.element.parent) in beside)]
    return "\n".join(b.text for b in kept)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """pages with text and n_chars (its code points) beside their columns but the html; columns of those names are replaced.

    Null and empty pages, and pages without main text, have the empty text. Repeated rows are judged each for itself, and
    null ids stay. A page may end anywhere: open elements end with it."""
    names = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x.as_py()) for x in b.column(0)]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=pa.schema([*[b.schema.field(k + 1) for k in range(len(names))], pa.field("text", pa.string()), pa.field("n_chars", pa.int64())]))

    rows = pages.select(F.col(f"`{html_col}`").cast("string").alias("__html"), *[f"`{c}`" for c in names])
    schema = rows.drop("__html").schema.add("text", "string").add("n_chars", "long")
    return rows.mapInArrow(run, schema)
