"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass decides blocks by length, link density, stop-word density
and by the region they stand in (menus, forms, adverts and the like are boilerplate, whatever their words). Blocks too
short or too mixed to tell stay open, and where no listed language fits a page its own frequent short words are its stop words; in the second pass an open block takes the label of its
nearest decided neighbour, and between two equally near ones of different labels goes with the one in the same element, else stands by its
own region.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilelake.llm.common import column, free_names

#: Limits of the first pass: characters of a short and of a long block, densities of links and stop words.
SHORT, LONG, MAX_LINKS, FEW_STOPS, MANY_STOPS = 70, 200, 0.33, 0.06, 0.15
#: In an article a block is a list of links only beyond this density.
ALL_LINKS = 0.8
#: Scripts that write without spaces: such a character counts as so many of others.
_DENSE, DENSE_CHARS = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\uf900-\ufaff]"), 2.5
#: A page of a language not listed gives its own stop words: this share of its most frequent words of at most so many letters.
OWN_STOPS, OWN_LETTERS = 0.02, 4
#: Common function words of the four languages of the tables.
STOP_WORDS = frozenset(
    """
    a an and are as at be by for from has have he in is it not of on or that the this to was were with
    als auch auf aus bei das dem den der des die ein eine für im in ist mit nicht sich sie und von wie zu
    au aux avec ce dans de des du elle en est et il la le les ne par pas pour que qui se sur un une
    al como con de del el en es la las lo los no para por que se su sus un una y
    """.split()
)
_SKIPPED = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "textarea", "select", "head", "title", "canvas", "video", "audio"}
#: Of these, an element without an end tag reaches to the end of the page; any other is then read as if it were not there.
_RAW = {"script", "style", "textarea", "title"}
_BOILERPLATE = {"nav", "footer", "aside", "form", "menu", "dialog"}
_CONTAINERS = _BOILERPLATE | {"header", "article", "main", "div", "section", "ul", "ol", "dl", "table", "details", "figure", "blockquote"}
_BLOCKS = _CONTAINERS | set(
    "p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption pre hr address fieldset legend summary figcaption body html button label".split()
)
_NAMES = set(
    """
    ad ads adv advert adverts advertisement advertising banner promo promotion sponsor sponsored cookie cookies consent notice
    gdpr popup modal newsletter subscribe subscription social share sharing sidebar nav navbar navigation menu breadcrumb
    breadcrumbs footer masthead toolbar widget related recommended comment comments disqus login signin signup search pagination
    pager skip hidden copyright disclaimer
    """.split()
)
#: What may follow one of the names in a class that says how a page is laid out, not what an element is.
_STATES = set("open opened closed enabled disabled active inactive on off left right fixed collapsed expanded visible layout page".split())
_NAMED = re.compile(r"([a-z]+)(?:[^a-z]+(.*))?", re.S)
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|</?[a-zA-Z!?][^>]*+>""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""", re.I)
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    linked: int
    heading: bool
    boilerplate: bool
    inside: bool
    holder: Element | None = None
    size: float = 0.0


@dataclass
class Element:
    """An open container: boilerplate for sure, or by its name unless it is or holds the page's article."""

    name: str
    parent: Element | None
    bad: bool
    named: bool
    inside: bool
    holds: bool = False


def _names(token: str) -> bool:
    """Whether a class, id or role is one of the names, or starts with one that its end does not make a state of the page."""
    parts = _NAMED.fullmatch(token)
    return bool(parts) and parts[1] in _NAMES and (parts[2] or "") not in _STATES


def _marks(attributes: str) -> tuple[bool, bool]:
    """Whether hidden or style say that an element is not shown, and whether class, id or role say that it is not main text."""
    hidden = named = False
    for name, value in _ATTRIBUTE.findall(attributes) if attributes.strip("/ ") else ():
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            hidden = True
        elif name == "style":
            hidden = hidden or "display:none" in value.replace(" ", "")
        elif name in ("class", "id", "role"):
            named = named or any(map(_names, value.split()))
    return hidden, named


def _set_holders(elements: list[Element]) -> None:
    """Names do not count for a page's main element, its first article (in main, if there is one) and what these stand in."""
    chosen, within, articles = [], set(), []
    for e in elements:  # parents first
        if e.name == "main":
            chosen.append(e)
        if e.name == "main" or id(e.parent) in within:
            within.add(id(e))
        if e.name == "article":
            articles.append(e)
    chosen += [e for e in articles if not within or id(e) in within][:1]
    for e in chosen:
        while e and not e.holds:
            e.holds, e = True, e.parent


def blocks_of(html: str) -> list[Block]:
    """The page's blocks in order, with white space made single and character references decoded."""
    found: list[Block] = []
    pieces: list[str] = []
    stack: list[Element] = []
    elements: list[Element] = []
    holders: list[Element | None] = []  # of each block
    linked = links = 0
    heading = own = False
    place, length = 0, len(html)

    def close() -> None:
        nonlocal pieces, linked
        text = " ".join("".join(pieces).split())
        if text:
            found.append(Block(text, linked, heading, own, bool(stack) and stack[-1].inside))
            holders.append(stack[-1] if stack else None)
        pieces, linked = [], 0

    while place < length:
        match = _TOKEN.search(html, place)
        start = match.start() if match else length
        if start > place:
            text = entities.unescape(html[place:start])
            pieces.append(text)
            if links:
                linked += len(" ".join(text.split()))
        if not match:
            break
        place = match.end()
        if not match[2]:
            continue
        name, ends = match[2].lower(), bool(match[1])
        if name in _SKIPPED:
            if not ends and not match[3].endswith("/"):
                shut = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(html, place)
                place = shut.end() if shut else length if name in _RAW else place
        elif name == "a":
            links = max(0, links - 1) if ends else links + 1
        elif name == "br":
            pieces.append(" ")
        elif name in _BLOCKS:
            close()
            links, own = 0, False
            heading = not ends and len(name) == 2 and name[0] == "h" and name[1].isdigit()
            if name in _CONTAINERS:
                if ends:
                    for i in range(len(stack) - 1, -1, -1):
                        if stack[i].name == name:
                            del stack[i:]
                            break
                else:
                    parent = stack[-1] if stack else None
                    inside = parent is not None and parent.inside
                    hidden, named = _marks(match[3])
                    bad = hidden or name in _BOILERPLATE or name == "header" and not inside
                    stack.append(Element(name, parent, bad, named, inside or name in ("article", "main")))
                    elements.append(stack[-1])
            elif not ends:
                hidden, named = _marks(match[3])
                # the page's own names say how it is laid out
                own = name in ("button", "label", "legend") or hidden or named and name not in ("body", "html")
    close()
    for block, holder in zip(found, holders):
        block.holder, block.size = holder, len(block.text) + (DENSE_CHARS - 1) * len(_DENSE.findall(block.text))
    _set_holders(elements)
    if not any(e.holds for e in elements):
        _spare_main_block(elements, found)
    for e in elements:  # parents first
        e.bad = e.bad or e.named and not e.holds or e.parent is not None and e.parent.bad
    for block in found:
        block.boilerplate = block.boilerplate or block.holder is not None and block.holder.bad
    return found


def _spare_main_block(elements: list[Element], found: list[Block]) -> None:
    """On a page without main and article, names do not count for an element that holds most of the page's unlinked text, and around it."""
    shown: dict[int, bool] = {}
    held: dict[int, float] = {}
    for e in elements:  # parents first
        shown[id(e)] = not e.bad and (e.parent is None or shown[id(e.parent)])
    total = 0.0
    for block in found:
        if block.boilerplate or block.holder is not None and not shown[id(block.holder)] or block.linked > MAX_LINKS * len(block.text):
            continue
        total += block.size
        e = block.holder
        while e is not None:
            held[id(e)] = held.get(id(e), 0.0) + block.size
            e = e.parent
    for e in elements:
        if e.named and held.get(id(e), 0.0) > total / 2 and held[id(e)] >= LONG:
            while e is not None and not e.holds:
                e.holds, e = True, e.parent


def _stop_words(blocks: list[Block]) -> frozenset | None:
    """The stop words to judge a page by: the listed ones where they are common on the page, else its own most
    frequent short words; None where it has none, as in scripts without spaces."""
    counts: Counter = Counter()
    for block in blocks:
        if not block.boilerplate and block.linked <= MAX_LINKS * len(block.text):
            counts.update(_WORD.findall(block.text.lower()))
    total = sum(counts.values())
    if sum(n for w, n in counts.items() if w in STOP_WORDS) >= MANY_STOPS * total:
        return STOP_WORDS
    own = {w for w, n in counts.items() if len(w) <= OWN_LETTERS and n >= max(2, OWN_STOPS * total)}
    if sum(counts[w] for w in own | STOP_WORDS) >= MANY_STOPS * total:
        return frozenset(own | STOP_WORDS)
    return None


def _decide(block: Block, stop_words: frozenset | None) -> str:
    """First pass: good, bad, or open. Without stop words length and links decide."""
    links = block.linked / len(block.text)
    if block.boilerplate or links > (ALL_LINKS if block.inside and block.size >= SHORT else MAX_LINKS):
        return "bad"
    if block.heading or block.size < SHORT:
        return "bad" if block.linked and not block.inside or "©" in block.text and not block.heading else "open"
    if "©" in block.text and not block.inside and block.size < LONG:
        return "bad"
    if stop_words is None:
        return "good" if block.inside or block.size >= LONG else "open"
    words = _WORD.findall(block.text.lower())
    stops = sum(w in stop_words for w in words) / max(1, len(words))
    if stops >= MANY_STOPS and block.size >= LONG:
        return "good"
    if stops >= FEW_STOPS:
        return "good" if block.inside else "open"
    return "open" if block.inside else "bad"


def _rescue(blocks: list[Block], labels: list[str]) -> None:
    """On a page without any good block, the blocks of the element with most shown, unlinked text are its article."""
    held: dict[int, float] = {}
    for block in blocks:
        if not block.boilerplate and block.linked <= MAX_LINKS * len(block.text):
            held[id(block.holder)] = held.get(id(block.holder), 0.0) + block.size
    most = max(held, key=held.get, default=None)
    if most is None or held[most] < LONG:
        return
    for i, block in enumerate(blocks):
        if id(block.holder) == most and not block.boilerplate and block.linked <= MAX_LINKS * len(block.text):
            labels[i] = "open" if block.size < SHORT else "good"


def main_text(html: str | None) -> str:
    """The main text of a page, its blocks joined by empty lines."""
    blocks = blocks_of(html or "")
    stop_words = _stop_words(blocks)
    labels = [_decide(b, stop_words) for b in blocks]
    if "good" not in labels and not any(b.inside for b in blocks):
        _rescue(blocks, labels)
    before: list[tuple[int, str]] = []
    last = (-1, "")
    for i, label in enumerate(labels):
        if label != "open":
            last = (i, label)
        before.append(last)
    after, last = [(-1, "")] * len(labels), (-1, "")
    for i in range(len(labels) - 1, -1, -1):
        if labels[i] != "open":
            last = (i, labels[i])
        after[i] = last
    kept = []
    for i, (block, label) in enumerate(zip(blocks, labels)):
        if label == "open":
            own = "good" if block.inside else "bad"
            (left, a), (right, b) = before[i], after[i]
            if a and b and a != b:
                # of two equally near ones, the one in the same element
                same = [blocks[x].holder is block.holder for x in (left, right)]
                tie = own if same[0] == same[1] else a if same[0] else b
                label = a if i - left < right - i else b if right - i < i - left else tie
                # a heading belongs to what follows it
                label = b if block.heading else label
                label = own if block.inside else label
            else:
                label = own if block.inside else a or b or own
        if label == "good":
            kept.append(block.text)
    return "\n\n".join(kept)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` without the html, with text and n_chars (code points).

    Null and empty pages, and pages without main text, give an empty text. Broken markup is read as far as tags can
    be told. Every row is read by itself; other columns are passed on, and result columns replace those of the same name.
    """
    kept = [f for f in pages.schema.fields if f.name != html_col and f.name.lower() not in ("text", "n_chars")]
    plain = free_names(pages, *(f"_c{i}" for i in range(len(kept))), "_html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(len(kept))]
            columns = [*batch.columns[: len(kept)], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*plain[:-1], "text", "n_chars"])

    schema = T.StructType([*(T.StructField(a, f.dataType) for f, a in zip(kept, plain)), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    rows = pages.select(*(column(f.name).alias(a) for f, a in zip(kept, plain)), column(html_col).alias(plain[-1]))
    return rows.mapInArrow(run, schema).select(*(F.col(a).alias(f.name) for f, a in zip(kept, plain)), "text", "n_chars")


def op9(spark, sf_dir) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
