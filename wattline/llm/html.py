"""Main-text extraction by line-block distribution.

Markup is stripped to a list of block lines, one for each piece of text between
block-level tags; what stands in menus, page headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments leaves empty lines,
bare tags leave none.  A line weighs its text without the text of links.  Weights
are summed over a sliding window of lines; a text block starts where the sum
surges to a level and ends where it dives below it.  The level is ``SURGE``
characters, or the highest sum of a page that never reaches it.  Article
containers multiply the weight of their lines: they win over the text outside
unless that is far longer.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wattline.llm import shipped

WINDOW = 3      # lines in a window
SURGE = 80      # characters that a window must reach in a text block
CONTAINER = 4   # weight of a character in an article container, against one of a block outside

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S)
ATTR = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style noscript template svg math iframe object canvas audio video map head title nav header footer "
                    "aside form button select textarea dialog menu noembed noframes xmp fieldset".split())
APART = frozenset("head nav header footer form menu dialog".split())  # dropped elements that part the text around them
CONTAINERS = frozenset(("article", "main"))
BARE = frozenset("div section center".split())  # elements whose own short text may be a menu or a notice
SENTENCE = (".", "!", "?", "…", "。", ":", ".”", '."', ".)")
#: Words of class and id names that mark page furniture.
FURNITURE = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar
navigation breadcrumb breadcrumbs sidebar footer header masthead notice notices cookie cookies consent gdpr popup modal overlay
newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments
disqus reply replies respond responses pagination pager toolbar widget widgets disclaimer alert skip""".split())
#: Words that may stand beside them in such a name.
NEUTRAL = frozenset("""site page top bottom left right box bar list slot wrapper wrap container block section inner outer post posts
links items item area unit global primary secondary form policy message links thread module panel zone group row col""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())


def furniture(attributes: str) -> bool:
    for name, value in ATTR.findall(attributes):
        value = value.strip("\"'").lower()
        if name.lower() == "role":
            if value in ROLES:
                return True
        elif any(map(names_furniture, value.split())):
            return True
    return False


def names_furniture(name: str) -> bool:
    """Whether a class or id names furniture as a whole: ``cookie-notice`` does, ``no-sidebar`` does not."""
    words = [w for w in re.split(r"[_\d-]+", name) if w]
    return not FURNITURE.isdisjoint(words) and all(w in FURNITURE or w in NEUTRAL for w in words)


class Lines:
    """The block lines of a page: text, weight (characters outside links), container (0: none, else the
    number of the outermost one) and whether the line, by its element or its end, is running text."""

    def __init__(self):
        self.text: list[str] = []
        self.weight: list[int] = []
        self.container: list[int] = []
        self.running: list[bool] = []

    def add(self, text: str, weight: int, container: int, running: bool):
        self.text.append(text)
        self.weight.append(weight)
        self.container.append(container)
        self.running.append(running)


def squeeze(parts: list[str]) -> str:
    return " ".join(html.unescape("".join(parts)).split())


def strip(page: str, by_name: bool = True, sections: bool = True) -> Lines:
    """The lines of a page; dropped elements leave empty lines.

    ``by_name``: class and id names count; ``sections``: section elements such as nav or footer count."""
    lines, line, links = Lines(), [], []
    depth, containers, skip, nested, apart, block, linked, at, end = 0, 0, "", 0, False, "", False, 0, len(page)

    def put(text):
        line.append(text)
        if linked:
            links.append(text)

    def flush():
        text = squeeze(line)
        if text:
            running = (block not in BARE or text.endswith(SENTENCE)) and not text.lower().startswith(("©", "copyright"))
            lines.add(text, max(0, len(text) - len(squeeze(links))), containers if depth else 0, running)
        line.clear()
        links.clear()

    while at < end:
        m = TAG.search(page, at)
        if not m:
            if not skip:
                put(page[at:])
            break
        if not skip and m.start() > at:
            put(page[at:m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            if m[0].startswith("<![CDATA[") and not skip:
                put(html.escape(m[0][9:-3]))
            continue
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if name in RAW and not closing:  # raw text up to its end tag
            close = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
            if name not in INLINE and not skip:
                flush()
            continue
        if skip:
            if name == skip:
                nested += -1 if closing else name not in VOID
            ended = nested == 0 or (skip == "p" and name != "p" and name not in INLINE)
            if name not in INLINE and apart:
                lines.add("", 0, containers if depth else 0, False)
            if not ended:
                continue
            skip = ""
            if closing:
                continue
        if name not in INLINE:
            flush()
            if name not in VOID:
                block = "" if closing else name
        if name == "a":
            linked = not closing
        if closing:
            if name in CONTAINERS:
                depth = max(0, depth - 1)
            continue
        if name in VOID:
            continue
        if name in CONTAINERS:
            containers += not depth
            depth += 1
        elif name not in ("html", "body") and ((sections and name in DROPPED) or name == "head"
                                               or (by_name and furniture(attributes))):
            skip, nested, apart = name, 1, name in APART
            for _ in range(WINDOW if apart else 1):
                lines.add("", 0, containers if depth else 0, False)
    flush()
    return lines


def blocks(weights: np.ndarray, level: int = 1, window: int = WINDOW) -> list[tuple[int, int, int]]:
    """(surge, dive, peak) of every text block: the lines of the windows whose sum reaches ``level``, from
    the first that weighs anything to the last (exclusive), and the highest sum among them."""
    total = np.convolve(weights, np.ones(window, np.int64))  # total[i] covers lines i-window+1 .. i
    on = np.concatenate([[0], (total >= level).astype(np.int8), [0]])
    surge, dive = np.flatnonzero(np.diff(on) == 1), np.flatnonzero(np.diff(on) == -1)
    heavy = np.flatnonzero(weights)
    out = []
    for a, b in zip(surge, dive, strict=True):
        inside = heavy[np.searchsorted(heavy, a - window + 1):np.searchsorted(heavy, b)]
        out.append((int(inside[0]), int(inside[-1]) + 1, int(total[a:b].max())))
    return out


def choose(lines: Lines) -> list[int]:
    """The numbers of the main text's lines.

    Containers whose lines surge (else the longest) are kept whole, if their characters, ``CONTAINER`` fold, are
    at least those of the blocks outside.  Else, all from the first to the last block: the edge lines that are
    no running text go, and running text that adjoins the edges comes along, up to a menu, page header, footer
    or form."""
    weight, container = np.array(lines.weight, np.int64), np.array(lines.container, np.int64)
    length = np.fromiter(map(len, lines.text), np.int64, len(lines.text))
    outside = np.where(container == 0, weight, 0)
    held = {}
    for c in np.unique(container[(container > 0) & (length > 0)]).tolist():
        own = np.where(container == c, weight, 0)
        held[c] = (int(length[container == c].sum()), bool(blocks(own, SURGE)))
    if held:
        far = np.zeros(len(weight), bool)
        for a, b, _ in blocks(outside, SURGE):
            far[a:b] = True
        longest = max(held, key=lambda c: (held[c][0], -c))
        kept = [c for c in held if held[c][1] or c == longest]
        if CONTAINER * sum(held[c][0] for c in kept) >= int(outside[far].sum()):
            return np.flatnonzero(np.isin(container, kept) & (length > 0)).tolist()
        weight = np.where((container > 0) & ~np.isin(container, [c for c in held if held[c][1]]), 0, weight)
    if not weight.any():
        weight = length  # links alone
    if not weight.any():
        return []
    peak = int(np.convolve(weight, np.ones(WINDOW, np.int64)).max())
    found = blocks(weight, min(SURGE, peak))
    a, b = found[0][0], found[-1][1]
    plain = np.array(lines.running, bool)
    edge = ~plain & (weight < SURGE)
    core = np.flatnonzero(~edge[a:b])
    if len(core):
        a, b = a + int(core[0]), a + int(core[-1]) + 1
    runs = np.concatenate([plain & (weight > 0), [False, False]])
    gap = np.concatenate([length == 0, [False, False]])
    while a > 0 and (runs[a - 1] or (gap[a - 1] and runs[a - 2])):  # over one dropped aside or advert
        a -= 1
    while runs[b] or (gap[b] and runs[b + 1]):
        b += 1
    return [i for i in range(a, b) if length[i]]


def main_text(page: str | None) -> str:
    """The main text of a page; empty for null, for pages without text and for pages whose text is all scripts and the like.

    A page of furniture only gives the text of its furniture."""
    if not page:
        return ""
    for by_name, sections in ((True, True), (False, True), (False, False)):
        lines = strip(page, by_name, sections)
        found = choose(lines)
        if found:
            return " ".join(lines.text[i] for i in found)
    return ""


def extract(pages: DataFrame, column: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep``, text and n_chars (code points) of every page; one pass, no shuffle.

    Null, empty or textless pages: empty text, 0.  Null keys and repeated
    rows stay; further columns are ignored; an empty table gives an empty
    result."""
    names = list(keep)

    def run(batches):
        for batch in batches:
            col = batch.column(len(names))
            for a in range(0, batch.num_rows, 256):
                texts = [main_text(x) for x in col.slice(a, 256).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(a, 256) for i in range(len(names))]
                    + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=[*names, "text", "n_chars"])

    fields = [T.StructField(c, pages.schema[c].dataType, True) for c in names]
    schema = T.StructType([*fields, *T.StructType.fromDDL("text string, n_chars long").fields])
    return shipped(pages).select(*names, pages[column].alias("_html")).mapInArrow(run, schema)
