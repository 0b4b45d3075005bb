"""The main text of web pages: blocks labelled content or boilerplate by a minimum cut.

Method: minimum-cut labelling. A page is cut into blocks of text. A classifier gives each block a gain for being
content, from its place in the document tree, its words, links and punctuation, and how many pages of its host
repeat it; gains and losses are the capacities to the two terminals. Blocks that follow each other, and blocks of one
parent, are linked with capacities that fall with their distance in the tree. The cheapest cut separates content
from boilerplate.

At scale: a page is one row and needs no other page but for one thing, how often its host repeats a block. That is
counted over hashes: one row per page and distinct block, added up per task before the shuffle, and only blocks of
``repeats`` pages or more go back to their pages. A host with a third of all pages spreads over its blocks; the one
line on all its pages is a single row on one side of a join that adaptive execution splits. Blocks of the rest of the
page hold its text once; scanning is one pass forward, whatever is left unclosed, and trees are read as browsers do,
up to 512 elements deep.

Null html counts as empty and gives the empty text. A null url has no host, and such pages share no evidence. Repeated
rows give a row each and count as one page for their host. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from slotwise.llm.mincut import cheapest_labels
from slotwise.session import materialise

DEEPEST = 512
REPEATS = 3

# Gains of a block, in hundredths.
CONTENT, NEVER, SELDOM = 400, -800, -350
WORD, MOST_WORDS_GAIN = 8, 200
SENTENCE, LINKS, SHORT, RIGHTS, REPEATED, HEADING = 60, -400, -150, -250, -150, 140
NEXT, SIBLING = 240, 60

_BREAKS = frozenset(
    """address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3
    h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul""".split()
)
_RAW = frozenset("script style title textarea iframe noembed noframes noscript xmp".split())
_UNSEEN = frozenset("svg select button object template canvas audio video datalist math".split())
_LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr figcaption blockquote pre summary".split())
_ENDS = {  # a start tag that ends an open element of these names, unless one of the others lies between
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("table",)),
}
_NEVER_TAGS = frozenset("nav aside footer menu dialog".split())
_NEVER_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert alertdialog toolbar form".split())
_NEVER_NAMES = frozenset(
    """ad ads advert advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus
    footer gdpr login masthead menu menus modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted
    related recommended reply replies respond share sharing sidebar signup social sponsor sponsored subscribe subscription tagcloud
    toolbar widget widgets""".split()
)
_CONTENT_NAMES = frozenset("article articlebody content entry main post story hentry".split())

_TAG = re.compile(r"<(?:(/?)([A-Za-z][^\s/>]*)|(!--)|[!?/])")
_ATTRIBUTE = re.compile(r"""(?<![^\s/"'])(class|id|role|hidden|style|aria-hidden)(?![^\s=/>"'])(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_CLOSER = {t: re.compile(f"</{t}(?=[\\s/>])", re.I) for t in _RAW | _UNSEEN}
_TAG_END = re.compile(r"""=\s*+["']|>""")
_NAME_CUT = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_RIGHTS = re.compile(r"©|\ball rights reserved\b", re.I)
_SENTENCE = re.compile(r"[.!?。！？…][\"'”’»)\]]*$")
_HOST = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")


@dataclass(slots=True)
class Block:
    text: str
    linked: int  # code points inside links
    standing: int  # gain of its place in the tree
    heading: bool
    parent: int  # number of the element that holds it, paragraphs and the like left out
    far: int  # steps in the tree from the block before it


@dataclass(slots=True)
class _Element:
    tag: str
    standing: int
    settled: bool  # nothing below changes the standing
    number: int


class _Ends:
    """Looks for marks further on; where one is not found once it is not looked for again."""

    def __init__(self, html: str):
        self.html, self.gone = html, set()

    def find(self, mark: str, at: int) -> int:
        if mark in self.gone:
            return -1
        found = self.html.find(mark, at)
        if found < 0:
            self.gone.add(mark)
        return found

    def closer(self, tag: str, at: int) -> int:
        if tag in self.gone:
            return -1
        found = _CLOSER[tag].search(self.html, at)
        if not found:
            self.gone.add(tag)
            return -1
        return found.start()

    def tag_end(self, at: int) -> int:
        """Where the tag that begins before ``at`` ends: at a > outside of quoted values; -1 if nowhere."""
        while True:
            mark = _TAG_END.search(self.html, at)
            if not mark:
                return -1
            if mark[0] == ">":
                return mark.start()
            quoted = self.find(mark[0][-1], mark.end())
            at = quoted + 1 if quoted >= 0 else mark.end()


def _element(tag: str, attributes: str, above: _Element, number: int) -> _Element:
    """What a start tag says about all below it."""
    if above.settled:
        return _Element(tag, above.standing, True, number)
    names: set[str] = set()
    role, hidden = "", False
    if tag not in ("html", "body"):
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id"):
                names |= {w.lower() for w in _NAME_CUT.split(value)}
            elif name == "role":
                role = value.lower()
            elif name == "style":
                hidden = hidden or bool(_HIDDEN.search(value))
            else:
                hidden = hidden or name == "hidden" or value.lower() == "true"
    within = above.standing > 0
    if hidden or tag in _NEVER_TAGS or role in _NEVER_ROLES or (tag == "header" and not within):
        return _Element(tag, NEVER, True, number)
    if names & _NEVER_NAMES and tag not in ("article", "main") or names & {"comment", "comments"}:
        return _Element(tag, NEVER, True, number)
    if tag in ("article", "main") or role in ("article", "main") or (names & _CONTENT_NAMES and tag in ("div", "section")):
        return _Element(tag, CONTENT, False, number)
    if tag in ("form", "fieldset"):
        return _Element(tag, SELDOM, False, number)
    return _Element(tag, above.standing, False, number)


def blocks(html: str) -> list[Block]:
    """The blocks of a page in its order, white space turned into single spaces, references decoded."""
    ends, out = _Ends(html), []
    stack, open_tags, made = [_Element("", 0, False, 0)], {}, 1
    run, linked, link_depth, lowest = [], 0, None, 1

    def flush() -> None:
        nonlocal run, linked, lowest
        raw = "".join(run)
        text = " ".join(unescape(raw).split()) if raw else ""
        if text:
            depth = len(stack)
            holder = next(e for e in reversed(stack) if e.tag not in _LEAVES)
            far = depth - lowest + (out_depth[0] - lowest) if out else 0
            out.append(Block(text, min(linked, len(text)), stack[-1].standing, stack[-1].tag[:1] == "h" and stack[-1].tag[1:].isdigit(), holder.number, far))
            out_depth[0], lowest = depth, depth
        run, linked = [], 0

    out_depth = [1]

    def pop_to(size: int) -> None:
        nonlocal lowest, link_depth
        while len(stack) > size:
            open_tags[stack.pop().tag] -= 1
        lowest = min(lowest, size)
        if link_depth is not None and size < link_depth:
            link_depth = None

    def say(text: str) -> None:
        nonlocal linked
        if text:
            run.append(text)
            if link_depth is not None:
                linked += len(text)

    at, size = 0, len(html)
    while at < size:
        mark = _TAG.search(html, at)
        if not mark:
            say(html[at:])
            break
        say(html[at : mark.start()])
        closing, tag, comment = mark[1], (mark[2] or "").lower(), mark[3]
        if comment:
            end = ends.find("-->", mark.end() - 2)
            at = size if end < 0 else end + 3
            continue
        end = ends.tag_end(mark.end()) if tag else ends.find(">", mark.end())
        if end < 0:
            break
        attributes, at = html[mark.end() : end], end + 1
        if closing:
            if tag == "a":
                link_depth = None
            elif tag in _BREAKS:
                flush()
                if open_tags.get(tag):
                    pop_to(max(i for i, e in enumerate(stack) if e.tag == tag))
            continue
        if tag in _RAW or tag in _UNSEEN:
            if attributes.endswith("/") and tag in _UNSEEN:
                continue
            closer = ends.closer(tag, at)
            if closer >= 0:
                at = closer
            elif tag in ("script", "style"):
                break
            say(" ")
        elif tag == "a":
            link_depth = len(stack)
        elif tag == "br":
            say(" ")
        elif tag in _BREAKS:
            flush()
            if open_tags.get("p") and stack[-1].tag == "p":
                pop_to(len(stack) - 1)
            if tag in _ENDS and any(open_tags.get(t) for t in _ENDS[tag][0]):
                ended, stops = _ENDS[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in ended:
                        pop_to(i)
                        break
                    if stack[i].tag in stops:
                        break
            if tag != "hr" and len(stack) < DEEPEST:
                stack.append(_element(tag, attributes, stack[-1], made))
                open_tags[tag] = open_tags.get(tag, 0) + 1
                made += 1
    flush()
    return out


def gain(block: Block, repeated: bool) -> int:
    """What taking the block as content is worth."""
    words = block.text.count(" ") + 1
    share = block.linked / len(block.text)
    out = block.standing + min(words * WORD, MOST_WORDS_GAIN) + round(LINKS * share)
    if _SENTENCE.search(block.text[-8:]):
        out += SENTENCE
    if block.standing <= 0 and words < 6:
        out += SHORT
    if block.standing <= 0 and _RIGHTS.search(block.text):
        out += RIGHTS
    if block.heading:
        out += HEADING
    return out + REPEATED * repeated


def links(found: list[Block]) -> list[tuple[int, int, int]]:
    """Blocks that follow each other, and blocks of one parent, with what it costs to part them."""
    out, last = [], {}
    for i, block in enumerate(found):
        if i:
            out.append((i - 1, i, NEXT // (1 + block.far * block.far)))
        before = last.get(block.parent)
        if before is not None and before < i - 1:
            out.append((before, i, SIBLING))
        last[block.parent] = i
    return out


def main_text(html: str | None, repeated: set[int] = frozenset()) -> str:
    """The content blocks of a page, joined by an empty line; ``repeated`` are hashes of blocks its host repeats."""
    found = blocks(html or "")
    taken = cheapest_labels([gain(b, block_hash(b.text) in repeated) for b in found], links(found))
    return "\n\n".join(b.text for b, t in zip(found, taken) if t)


def block_hash(text: str) -> int:
    h = xxhash.xxh64_intdigest(text)
    return h - (1 << 64) if h >> 63 else h


def host_of(url: str | None) -> str | None:
    found = _HOST.match(url or "")
    return found[1].lower() if found else None


def _hashes(batches):
    for batch in batches:
        page = [list({block_hash(b.text) for b in blocks(h.as_py() or "")}) for h in batch.column("html")]
        host = [host_of(u.as_py()) for u in batch.column("url")]
        yield pa.RecordBatch.from_arrays([batch.column("page"), pa.array(host, pa.string()), pa.array(page, pa.list_(pa.int64()))], ["page", "host", "hashes"])


def _texts(batches):
    for batch in batches:
        text = [main_text(h.as_py(), set(r.as_py() or ())) for h, r in zip(batch.column("html"), batch.column("repeated"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())], ["page_id", "url", "text", "n_chars"]
        )


def repeated_blocks(pages: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """``page, repeated``: per page the hashes of its blocks that stand on ``repeats`` or more pages of its host."""
    seen = pages.mapInArrow(_hashes, "page long, host string, hashes array<long>").where("host IS NOT NULL")
    seen = materialise(seen.dropDuplicates(["page", "host"]).select("page", "host", F.explode("hashes").alias("hash")), "page-blocks")
    often = seen.groupBy("host", "hash").agg(F.count("*").alias("n")).where(F.col("n") >= repeats).select("host", "hash")
    return seen.join(often, ["host", "hash"]).groupBy("page").agg(F.collect_set("hash").alias("repeated"))


def main_texts(pages: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``: the article without menus, headers, footers,
    sidebars, notices, adverts, forms, scripts, styles and comments; empty if there is none."""
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = rows.withColumn("page", F.xxhash64("url", "html"))
    known = repeated_blocks(rows.select("page", "url", "html"), repeats)
    kind = dict(rows.dtypes)["page_id"]
    joined = rows.join(known, "page", "left").select("page_id", "url", "html", "repeated")
    return joined.mapInArrow(_texts, f"page_id {kind}, url string, text string, n_chars long")
