"""Main text of web pages by two-pass block rules.

The first pass judges each block by itself: where it stands, its link density,
its length and its stop-word density.  Blocks that stay open take, in the
second pass, the label of the nearest decided blocks of their section.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape as decode

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts_of

# Element names of the HTML standard, by what they mean here.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
#: Never part of the main text, with all they contain.
BOILERPLATE = frozenset(
    "aside button dialog fieldset footer form head header menu nav option select title".split()
)
RAW = "script|style|noscript|template|textarea|iframe|object|svg|math|xmp"
VOID = frozenset("br hr img input meta link wbr area base col embed source track".split())
SECTIONS = frozenset(("article", "main"))
#: Words in class, id or role that name boilerplate.
NAMED = frozenset(
    "ad ads advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment "
    "comments complementary contentinfo cookie cookies disclaimer disqus footer header masthead menu "
    "nav navbar navigation newsletter notice notices pagination popup promo promoted related replies "
    "reply respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: Words beside them in such names that only say where or how a block stands.
LAYOUT = frozenset(
    "area bar block body bottom box btn column container content fixed global group inner item items left "
    "link links list main outer page panel primary right row secondary section site slot sticky thread top "
    "unit wrap wrapper zone".split()
)
#: Frequent function words of the languages at hand.
STOP_WORDS = frozenset(
    "a and are as at be been but by for from had has have he her his i in is it its not of on or she "
    "that the their they this to was we were which with you "
    "au aux avec ce cette dans de des du elle en est et il la le les leur mais ne nous on ou par pas "
    "pour qu que qui sa se ses son sur un une vous "
    "als am auch auf aus bei das dem den der die ein eine einen er es für haben hat ich im ist mit "
    "nach nicht sich sie sind um und von war wie wir zu zum zur "
    "al como con del el ella esta este fue ha las los más no para pero por sin su sus también una y".split()
)

#: First pass: share of characters inside links from which a block is boilerplate,
#: outside and inside an article; lengths; shares of stop words.
LINKS, LINKS_INSIDE = 0.33, 0.8
SHORT, LONG = 70, 200
FEW_STOPS, MANY_STOPS = 0.12, 0.25

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({RAW})\b(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(
    r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE
)
NAME_PARTS = re.compile(r"[A-Za-z][a-z]*")


class Block:
    """Text between two block borders, and where it stood."""

    __slots__ = ("parts", "links", "dropped", "section", "tag", "text", "label")

    def __init__(self, dropped: bool, section: int, tag: str):
        self.parts: list[str] = []
        self.links = 0
        self.dropped, self.section, self.tag = dropped, section, tag
        self.text, self.label = "", None


def _named_boilerplate(attributes: str) -> bool:
    """Whether a whole name says boilerplate: ``ad-box`` does, ``share-price`` does not."""
    for _, *values in ATTRIBUTE.findall(attributes):
        for name in "".join(values).split():
            parts = {x.lower() for x in NAME_PARTS.findall(name)}
            if not parts.isdisjoint(NAMED) and parts <= NAMED | LAYOUT:
                return True
    return False


def blocks_of(html: str) -> list[Block]:
    """Blocks with text, in page order.

    Tags may be missing or crossed: an end tag closes everything inside the
    nearest open element of its name, an unknown one only ends the block, and a
    paragraph ends where another block begins.  A menu left open ends where an
    article begins.  Unfinished markup at the end of
    a cut page is markup still.
    """
    found: list[Block] = []
    stack: list[tuple[str, bool, int]] = []  # name, dropped, section
    still_open: Counter[str] = Counter()
    sections, in_link = 0, 0
    block = Block(False, 0, "body")

    def close() -> None:
        block.text = " ".join(decode("".join(block.parts)).split())
        if block.text:
            found.append(block)

    def top() -> tuple[str, bool, int]:
        return stack[-1] if stack else ("body", False, 0)

    def put(text: str) -> None:
        block.parts.append(text)
        if in_link:
            block.links += len(text.strip())

    at = 0
    for m in TOKEN.finditer(html):
        if m.start() > at:
            put(html[at : m.start()])
        at = m.end()
        name = m[3] or m[6]
        if name is None:
            continue
        name = name.lower()
        ending = bool(m[2] or m[5])
        if name == "a":
            in_link = 0 if ending else 1
        if name not in BLOCKS and not (name == "button"):
            if name == "br":
                block.parts.append(" ")
            continue
        close()
        in_link = 0
        if ending:
            while still_open[name]:
                shut = stack.pop()[0]
                still_open[shut] -= 1
                if shut == name:
                    break
        else:
            repeats = name in ("li", "dt", "dd", "option", "tr", "td", "th")
            for implied in ("p", name) if repeats else ("p",):
                if top()[0] == implied:
                    stack.pop()
                    still_open[implied] -= 1
            while name in SECTIONS and still_open["nav"]:
                still_open[stack.pop()[0]] -= 1
            if name not in VOID:
                _, dropped, section = top()
                if name in SECTIONS and not section:
                    sections += 1
                    section = sections
                dropped = dropped or name in BOILERPLATE
                if name not in ("html", "body") and name not in SECTIONS:
                    dropped = dropped or _named_boilerplate(m[4] or m[7] or "")
                stack.append((name, dropped, section))
                still_open[name] += 1
        tag, dropped, section = top()
        block = Block(dropped, section, tag)
    rest = html[at:]
    if rest:
        put(rest)
    close()
    return found


def judge(block: Block) -> bool | None:
    """First pass: main text, boilerplate, or open."""
    if block.dropped:
        return False
    length = len(block.text)
    density = block.links / length
    if density >= (LINKS_INSIDE if block.section else LINKS):
        return None if block.section and block.tag[0] in "ph" else False
    if length < SHORT:
        return None
    words = block.text.lower().split()
    stops = sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words) / len(words)
    if stops >= MANY_STOPS and length >= LONG:
        return True
    if stops < FEW_STOPS and not block.section:
        return False
    return True if stops >= MANY_STOPS else None


def main_text(html: str | None) -> str:
    """The blocks of main text, one per line; empty if there are none."""
    if not html:
        return ""
    blocks = blocks_of(html)
    for b in blocks:
        b.label = judge(b)
    # an article counts as such unless more text outside is main text by itself
    inside = sum(len(b.text) for b in blocks if b.section and not b.dropped)
    has_section = inside > sum(len(b.text) for b in blocks if not b.section and b.label)
    by_section: dict[int, list[Block]] = {}
    for b in blocks:
        if has_section and not b.section:
            b.label = False
        if not b.dropped:
            by_section.setdefault(b.section, []).append(b)
    for section, own in by_section.items():
        _inherit(own, bool(section) or not has_section)
    return "\n".join(b.text for b in blocks if b.label)


def _inherit(blocks: list[Block], default: bool) -> None:
    """Second pass: open blocks follow the nearest decided ones of their section.

    Where both neighbours disagree the nearer one counts.  Inside an article
    only main text is followed: a list of links says nothing about the heading
    above it.  ``default`` holds where there is nothing to follow.
    """
    labels = [b.label for b in blocks]
    before: list[tuple[int, bool] | None] = []
    last = None
    for i, label in enumerate(labels):
        if label is not None:
            last = (i, label)
        before.append(last)
    last = None
    for i in range(len(blocks) - 1, -1, -1):
        if labels[i] is not None:
            last = (i, labels[i])
            continue
        near = [
            (abs(i - j), not label)
            for j, label in filter(None, (before[i], last))
            if label or not blocks[i].section
        ]
        blocks[i].label = not min(near)[1] if near else default


def extract_main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``; null and empty pages give empty text.

    Nothing is cut: pages and blocks of any length are read whole.  Rows that
    repeat are extracted one by one, an empty table gives no rows, other columns
    are ignored.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    )
    types = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches):
        for batch in batches:
            texts = [main_text(x) for x in texts_of(batch, 2)]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string())]
            columns.append(pa.array([len(t) for t in texts], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    schema = f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long"
    return rows.mapInArrow(run, schema)
