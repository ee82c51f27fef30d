"""Main text of web pages by minimum-cut labelling.

A page becomes a row of text blocks. What speaks for content and what speaks
against it, from a linear classifier over tags, class words, links and length,
are a block's capacities to the two terminals. Neighbours on the page, and
blocks with one parent or close by in the element tree, are tied by edges whose
capacity is the price of labelling them differently. The minimum cut is the
cheapest labelling; blocks left with the source are the main text.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from dumpflow.llm.stages import arrow_ready

# Names of elements and of the words in class, id and role attributes.
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
HIDDEN = frozenset("head script style noscript template title textarea select option button svg math iframe object audio video canvas map datalist".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p blockquote pre".split())
TEXT = HEADINGS | PARAGRAPHS
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}, "button": {"button"}, "select": {"select"}}
# Start tags that do not end a head whose end tag is left out.
HEAD = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
SCOPES = frozenset("article aside body div dl fieldset footer form header html main nav ol section table ul".split())
AGAINST = frozenset("ad ads adbox advert adverts advertisement advertising alert banner breadcrumb breadcrumbs byline comment comments commentlist consent cookie cookies copyright discussion disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification outbrain pager pagination popup promo promotion promoted related reply replies respond responses search share sharing sidebar signup skip social sponsor sponsored subscribe subscription taboola toc toolbar topbar tracking widget widgets".split())
ROLES = frozenset("banner navigation complementary contentinfo search dialog alert menu menubar toolbar".split())
FOR = frozenset("article articlebody content entry main mainbody post story".split())
UNSURE = frozenset("has no with without".split())
# Words that say nothing about the block they name.
PLAIN = frozenset("area block body box container content copy inner item label line message outer section text unit wrap wrapper".split())

#: Classifier: weights of evidence against (positive) and for content, in units of 1/100.
TAG_WEIGHT = {"nav": 900, "footer": 900, "aside": 900, "form": 900, "menu": 900, "dialog": 900, "fieldset": 500, "header": 500, "article": -400, "main": -400}
CLASS_AGAINST, CLASS_FOR = 800, -250
LINKED, PROSE, SENTENCE, SHORT, HEADING, PARAGRAPH, BASE = 350, -150, -60, 50, -40, -60, -20
#: Price of a border: between neighbours, and between blocks of one parent, by their distance in the tree.
ADJACENT, RELATED = 40, 160

# A quote opens a value only after an equals sign; anywhere else it is a character like others.
VALUE = r"(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*+|)"
ATTRS = rf"(?:[^>=]|=\s*+{VALUE})*+"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # A self-closed svg or math has no content; <svg-icon> is another element.
    rf"|(?!<(?:svg|math)(?=[\s/>]){ATTRS}(?<=/)>)<(?P<raw>script|style|textarea|title|noscript|template|svg|math|iframe)(?=[\s/>]){ATTRS}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>{ATTRS})(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"'][^\s>]*)))?")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SENTENCE_END = re.compile(r"[.!?…][\"'»”)]?$")


class Element:
    """An open element: evidence and hidden elements so far, and the way up."""

    __slots__ = ("against", "depth", "hidden", "parent", "tag")

    def __init__(self, tag: str, parent: Element | None, against: int, hidden: int):
        self.tag, self.parent, self.against, self.hidden = tag, parent, against, hidden
        self.depth = parent.depth + 1 if parent else 0


class Open:
    """Stack of open elements that knows how many of each tag it holds."""

    def __init__(self):
        self.stack = [Element("", None, 0, 0)]
        self.tags: Counter[str] = Counter()

    @property
    def top(self) -> Element:
        return self.stack[-1]

    def push(self, tag: str, against: int, hidden: int) -> None:
        self.stack.append(Element(tag, self.top, against, hidden))
        self.tags[tag] += 1

    def pop(self) -> Element:
        self.tags[self.top.tag] -= 1
        return self.stack.pop()

    def close(self, tag: str) -> None:
        """End tag: its element ends with all that is open inside, hidden or not."""
        if self.tags[tag]:
            while self.pop().tag != tag:
                pass

    def make_way(self, tag: str) -> None:
        """Start tag: ends the element whose end tag may be left out before it."""
        ends = CLOSES.get(tag, ())
        if not any(self.tags[t] for t in ends):
            return
        for e in reversed(self.stack):
            if e.tag in ends:
                self.close(e.tag)
                break
            if e.tag in SCOPES or e.tag in HIDDEN:
                break


class Block:
    __slots__ = ("against", "element", "linked", "pieces", "tag", "text")

    def __init__(self, element: Element):
        self.element, self.against, self.tag = element, element.against, element.tag
        self.pieces: list[str] = []
        self.linked, self.text = 0, ""


def attributes(attrs: str) -> dict[str, str]:
    """Values by lower-cased name; of a repeated name the first counts."""
    found: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(attrs):
        found.setdefault(name.lower(), html.unescape(a or b or c))
    return found


def _cues(tag: str, attrs: str, above: int) -> int:
    """Evidence for all below an element, given that from above it.

    A cue against outweighs what the elements around it say for content; cues
    for content do not add up.
    """
    against, good = max(0, TAG_WEIGHT.get(tag, 0)), min(0, TAG_WEIGHT.get(tag, 0))
    if attrs and tag not in ("html", "body"):
        own = attributes(attrs)
        if "hidden" in own or own.get("aria-hidden", "").lower() == "true":
            against += CLASS_AGAINST
        for name in ("class", "id", "role"):
            for value in own.get(name, "").split():
                words = {w.lower() for w in WORDS.findall(value)}
                if words & UNSURE:
                    continue
                role = value.lower() if name == "role" else ""
                # A paragraph named for its subject, such as "social-history", is no box of that kind.
                if (words & AGAINST and (tag not in TEXT or words <= AGAINST | PLAIN)) or role in ROLES:
                    against = max(against, CLASS_AGAINST)
                elif words & FOR or role in ("main", "article"):
                    good = min(good, CLASS_FOR)
    if against:
        return max(above, 0) + against
    return above + good if above > 0 else min(above, good)


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order, white space made single and references decoded."""
    inside = Open()
    out: list[Block] = []
    links = 0
    now: Block | None = None
    for m in TOKEN.finditer(page):
        kind = m.lastgroup
        if kind == "text":
            if inside.top.tag == "head" and m["text"].strip():
                inside.pop()
            if inside.top.hidden:
                continue
            if now is None:
                now = Block(inside.top)
                out.append(now)
            now.pieces.append(m["text"])
            if links:
                now.linked += len(m["text"])
            continue
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        end = bool(m["end"])
        if inside.top.tag == "head" and not end and tag not in HEAD:
            inside.pop()
        if tag in HIDDEN:
            now = None if tag == "head" else now
            if m["attrs"].endswith("/"):
                continue
            if end:
                inside.close(tag)
            else:
                inside.make_way(tag)
                inside.push(tag, inside.top.against, inside.top.hidden + 1)
        elif tag == "a":
            links = max(0, links - 1) if end else 1
        elif tag == "br" and now is not None:
            now.pieces.append(" ")
        elif tag in BLOCK:
            now, links = None, 0
            if tag == "body":
                while inside.top.hidden:  # hidden elements that were never closed
                    inside.pop()
            if end:
                inside.close(tag)
            elif tag not in VOID:
                inside.make_way(tag)
                inside.push(tag, _cues(tag, m["attrs"], inside.top.against), inside.top.hidden)
    for b in out:
        b.text = " ".join(html.unescape("".join(b.pieces)).split())
    return [b for b in out if b.text]


def evidence(b: Block) -> int:
    """Classifier: positive if the block looks like boilerplate."""
    n = len(b.text)
    score = BASE + b.against
    if 2 * b.linked > n:
        score += LINKED
    elif n > 120:
        score += PROSE
    if SENTENCE_END.search(b.text):
        score += SENTENCE
    if b.tag in PARAGRAPHS:
        score += PARAGRAPH
    if b.tag in HEADINGS:
        score += HEADING
    elif n < 25:
        score += SHORT
    return score


def _apart(a: Element, b: Element) -> int:
    """Steps between two elements in the tree."""
    steps = 0
    while a is not b:
        if a.depth < b.depth:
            a, b = b, a
        a, steps = a.parent, steps + 1
    return steps


def edges_of(blocks: list[Block]) -> list[tuple[int, int, int]]:
    """(block, block, capacity): each with the one before it, and with the last of the same parent."""
    out, last = [], {}
    for i, b in enumerate(blocks):
        parent = b.element.parent
        for j in {i - 1, last.get(parent, -1)} - {-1}:
            out.append((j, i, (ADJACENT if j == i - 1 else 0) + RELATED // max(1, _apart(b.element, blocks[j].element))))
        last[parent] = i
    return out


def minimum_cut(excess: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay with the source.

    `excess` is capacity from the source less capacity to the sink; edges hold
    both ways. Paths are augmented shortest first. Nodes from which the search
    finds no way to the sink are the source's side, and are not searched again.
    """
    near: list[list[int]] = [[] for _ in excess]
    to, room = [], []
    for a, b, c in edges:
        near[a].append(len(to))
        near[b].append(len(to) + 1)
        to += (b, a)
        room += (c, c)
    left, kept = list(excess), [False] * len(excess)
    for start in range(len(left)):
        while left[start] > 0 and not kept[start]:
            came, line, found = {start: -1}, deque([start]), -1
            while line and found < 0:
                v = line.popleft()
                for e in near[v]:
                    w = to[e]
                    if room[e] > 0 and w not in came and not kept[w]:
                        came[w] = e
                        if left[w] < 0:
                            found = w
                            break
                        line.append(w)
            if found < 0:
                for v in came:
                    kept[v] = True
                break
            path, v = [], found
            while came[v] >= 0:
                path.append(came[v])
                v = to[came[v] ^ 1]
            flow = min(left[start], -left[found], *(room[e] for e in path))
            for e in path:
                room[e] -= flow
                room[e ^ 1] += flow
            left[start] -= flow
            left[found] += flow
    return kept


def main_text(page: str | None) -> tuple[str, int, int]:
    """Main text, number of blocks and of those kept; '' for no page or none with text."""
    blocks = blocks_of(page or "")
    kept = minimum_cut([-evidence(b) for b in blocks], edges_of(blocks))
    chosen = [b.text for b, k in zip(blocks, kept, strict=True) if k]
    return "\n".join(chosen), len(blocks), len(chosen)


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """`pages` without the HTML, with text, n_chars, n_blocks and n_kept from each whole page.

    A NULL or empty page, and one that is all boilerplate, gives an empty text.
    Columns of these names are replaced, others stay.
    """
    added = {"text": "string", "n_chars": "bigint", "n_blocks": "int", "n_kept": "int"}
    stay = [c for c in pages.columns if c != column and c not in added]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(p) for p in batch.column(len(stay)).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:-1], pa.array([f[0] for f in found], pa.string()), pa.array([len(f[0]) for f in found], pa.int64()),
                pa.array([f[1] for f in found], pa.int32()), pa.array([f[2] for f in found], pa.int32()),
            ], [*stay, *added])

    arrow_ready(pages.sparkSession)
    types = dict(pages.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in stay] + [f"{n} {t}" for n, t in added.items()])
    return pages.select(*stay, column).mapInArrow(of, schema)
