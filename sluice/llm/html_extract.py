"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks. A logistic classifier on a block's text, fitted on a bounded sample of
pages that mark their article, and what the block's place in the page says become a terminal
capacity towards "content" or "boilerplate"; neighbours, and blocks under one parent, are tied by
smoothness edges. The maximum flow between the terminals labels all blocks of the page together.
"""

from __future__ import annotations

import html
import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .token_counts import chunks

# Element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe".split())
UNSEEN = frozenset("svg select datalist audio video canvas".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math object q rp rt ruby s samp "
    "small span strike strong sub sup svg time tt u var wbr "
    "mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot munder mover munderover mstyle mspace semantics".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN = frozenset("article main".split())
ASIDE = frozenset("nav footer aside menu dialog button head".split())
CONTROLS = frozenset("form fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
HINTED = frozenset("div section ul ol dl nav aside header footer form article main table td body".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split())
SIBLINGS = frozenset("li dt dd tr td th option".split())
# Words in class and id that mark boilerplate wherever they stand in a name; that mark it as a name's head word;
# that hint at it; that mark notices as whole names; that mark readers' comments; and that mark the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsored promo cookie cookies consent gdpr "
    "newsletter sidebar navbar breadcrumb breadcrumbs masthead topbar toolbar pagination".split())
HEAD_MARKS = frozenset(
    "sponsor promotion popup modal overlay subscribe subscription signup login menu nav navigation footer share sharing social".split())
HINTS = frozenset(
    "banner notice notices alert side rail header related recommended recommendations trending discussion replies reply "
    "respond widget widgets pager skip copyright legal search".split())
NOTICES = frozenset("notice notices alert".split())
REMARKS = frozenset("comment comments commentlist disqus".split())
# Words that say what kind of box a name's head word stands in.
BOXES = frozenset(
    "area bar block body box button buttons col column container content form group icon icons inner item items left link links list "
    "outer panel right row section slot text title top bottom unit widget widgets wrap wrapper zone".split())
STAYING = frozenset("sidebar footer".split()) | REMARKS  # whole names that hold for the largest part of a page too
CONTENT_HINTS = frozenset("article post entry content story main".split())
ARTICLE_HINTS = CONTENT_HINTS | frozenset("body text".split())
MODIFIERS = frozenset("no has with without is hide show open closed".split())  # "no-sidebar" says how a page is laid out

SAMPLE_PAGES, SAMPLE_BLOCKS = 400, 60  # pages the classifier is fitted on at most, and blocks of each
#: What the weights are drawn to where the sample says nothing: intercept, length, link share, a sentence's end, heading.
PRIOR = (0.0, 0.8, -3.0, 0.4, 0.8)
RIDGE, STEPS = 4.0, 30
TIE, PARENT_TIE = 0.5, 0.7
READS = 200  # characters from which an element of an article with few links reads like text, whatever its name
CHUNK_CHARS = 4_000_000

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_STOP = re.compile(r"[.!?…:;]")
_COPYRIGHT = re.compile(r"(?:copyright\b|©|\(c\))[\s©]*(?:\(c\)\s*)?\d{4}\b(?:[^.!?]{0,80}|.{0,80}\breserved\b.{0,20})\Z", re.I | re.S)


@dataclass
class Frame:
    """An element, and what its place says about text in it."""

    name: str
    above: "Frame | None"
    number: int
    words: frozenset = frozenset()
    kinds: frozenset = frozenset()  # what its names say: mark, head, notice, remarks, staying
    role: str = ""
    hidden: bool = False
    link: bool = False
    heading: bool = False
    chars: int = 0  # of text in it
    links: int = 0  # of those in links
    mains: int = 0  # article and main elements in it
    main: int = 0  # 2: in an article or main element, 1: in one whose class or id says so
    boilerplate: bool = False
    firm: bool = False  # even for an article in it
    hinted: bool = False


@dataclass
class Block:
    frame: Frame
    pieces: list[str] = field(default_factory=list)
    link_chars: int = 0
    chars: int = 0

    def text(self) -> str:
        return " ".join(html.unescape("".join(self.pieces)).split())


def _attributes(raw: str) -> dict[str, str]:
    found = {}
    for m in _ATTRIBUTE.finditer(raw):
        found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return found


def _names(value: str) -> list[list[str]]:
    """Lower-cased parts of each name in a class or id; names that say how a page is laid out are left out."""
    names = [[w.lower() for w in _NAME_PARTS.findall(name)] for name in value.split()]
    return [parts for parts in names if parts and parts[0] not in MODIFIERS]


def _kinds(names: list[list[str]]) -> frozenset:
    """What an element's names say by marks: in "share-price" the head word is price, in "share-buttons" share."""
    kinds, words = set(), {w for parts in names for w in parts}
    for parts in names:
        named = [w for w in parts if not w.isdigit()]
        while len(named) > 1 and named[-1] in BOXES:
            named.pop()
        head = named[-1] if named else ""
        whole = len(parts) == 1
        if MARKS & set(parts):
            kinds.add("mark")
        if head in HEAD_MARKS:
            kinds.add("head")
        if whole and head in NOTICES:
            kinds.add("notice")
        if head in REMARKS or (len(named) > 1 and named[0] in REMARKS and head not in CONTENT_HINTS):
            kinds.add("remarks")
        if whole and head in STAYING and not words & ARTICLE_HINTS:
            kinds.add("staying")
    return frozenset(kinds)


def _open(name: str, raw: str, above: Frame, number: int) -> Frame:
    frame = Frame(name, above, number, hidden=above.hidden or name in UNSEEN, link=above.link or name == "a", heading=above.heading or name in HEADINGS)
    attributes = _attributes(raw) if "=" in raw or "hidden" in raw else {}
    frame.role = attributes.get("role", "").lower()
    if name in HINTED:
        names = _names(attributes.get("class", "")) + _names(attributes.get("id", ""))
        if names:
            frame.words, frame.kinds = frozenset(w for parts in names for w in parts), _kinds(names)
    style = attributes.get("style", "").replace(" ", "").lower()
    frame.hidden |= "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style
    return frame


def _place(frames: list[Frame]) -> None:
    """Settle what each element's place says; ``frames`` has parents before their children.

    What holds all article and main elements, or most of the page's text, is no boilerplate for
    what it is called, unless it is called a sidebar, a footer or comments and nothing else. In an
    article a name that may be a subject too (a menu, a social history) counts only for what is
    short or mostly links.
    """
    for frame in reversed(frames):
        if frame.above:
            frame.above.chars += frame.chars
            frame.above.links += frame.links
            frame.above.mains += frame.mains + (frame.name in MAIN or frame.role in MAIN)
    whole = frames[0]
    for frame in frames[1:]:
        above, words, kinds = frame.above, frame.words, frame.kinds
        is_main = frame.name in MAIN or frame.role in MAIN
        mains = frame.mains == whole.mains > 0
        most = mains or (2 * frame.chars > whole.chars and (frame.mains > 0 or not whole.mains))
        lifted = most and "staying" not in kinds
        frame.main, frame.boilerplate, frame.firm, frame.hinted = above.main, above.boilerplate, above.firm, above.hinted
        remarks = "remarks" in kinds and not lifted
        if is_main:
            frame.main = 2
            if not frame.firm:
                frame.boilerplate = frame.hinted = False
        elif frame.name not in ("html", "body") and not lifted:
            reads = above.main and frame.chars >= READS and 10 * frame.links < 3 * frame.chars
            marked = "mark" in kinds or "notice" in kinds or ("head" in kinds and not reads)
            hints = words & HINTS
            if hints == {"header"} and (words & ARTICLE_HINTS or above.main):
                hints = set()
            frame.boilerplate |= marked or frame.name in CONTROLS
            frame.firm |= marked
            frame.hinted |= bool(hints)
            if not marked and not hints and not remarks and words & CONTENT_HINTS:
                frame.main = max(frame.main, 1)
        elif frame.name not in ("html", "body") and words & CONTENT_HINTS and not remarks:
            frame.main = max(frame.main, 1)
        aside = frame.name in ASIDE or frame.role in ROLES or (frame.name == "header" and not above.main)
        if remarks or (aside and not (mains if frame.name == "footer" else lifted)):
            frame.boilerplate = frame.firm = True


def blocks_of(page: str) -> list[Block]:
    """Text blocks of a page in order; scripts, styles, comments and hidden parts have none."""
    root = Frame("", None, 0)
    stack, blocks, at, frames, opened = [root], [Block(root)], 0, [root], {}

    def add(text: str) -> None:
        top = stack[-1]
        if text and not top.hidden:
            block = blocks[-1]
            block.pieces.append(text)
            n = len(text.strip())
            top.chars += n
            top.links += n * top.link
            block.chars += n
            block.link_chars += n * top.link
            block.frame = block.frame if block.chars > n else top  # the place of the first text

    def new_block() -> None:
        if blocks[-1].pieces:
            blocks.append(Block(stack[-1]))

    def close(name: str) -> None:
        """Close the innermost open element of this name, if any; an inline one only if no block stands in it."""
        if opened.get(name):
            depth = len(stack) - 1
            while stack[depth].name != name:
                if name in INLINE and stack[depth].name not in INLINE:
                    return
                depth -= 1
            for frame in stack[depth:]:
                opened[frame.name] -= 1
            del stack[depth:]

    while True:
        m = _TAG.search(page, at)
        add(page[at : m.start()] if m else page[at:])
        if not m:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, raw = m[1] or m[4], m[3] or m[6] or ""
        if name == "br":
            add(" ")
            continue
        if name not in INLINE:
            new_block()
        if closing:
            close(name)
            continue
        if name in CLOSES_P:
            close("p")
        elif name in SIBLINGS and stack[-1].name == name:
            close(name)
        if name in RAW and not raw.rstrip().endswith("/"):
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            if end or name in ("script", "style", "title", "textarea"):
                at = end.end() if end else len(page)
            continue
        if name in VOID or raw.rstrip().endswith("/"):
            continue
        frame = _open(name, raw, stack[-1], len(frames))
        frames.append(frame)
        stack.append(frame)
        opened[name] = opened.get(name, 0) + 1
    _place(frames)
    return [b for b in blocks if b.pieces and b.text()]


def features(block: Block, text: str) -> list[float]:
    """What the classifier sees of a block's text."""
    length = max(-1.0, min(2.0, math.log(len(text) / 60)))
    return [1.0, length, block.link_chars / max(1, block.chars), float(bool(_STOP.search(text))), float(block.frame.heading)]


def fit(rows: list[tuple[list[float], int]]) -> tuple[float, ...]:
    """Weights of a logistic model of content, drawn to ``PRIOR``; by Newton steps."""
    w = np.array(PRIOR)
    if not rows:
        return PRIOR
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    scale = 200 / max(200, len(y))  # the prior holds its own against a sample of any size
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = scale * (x.T @ (p - y)) + RIDGE * (w - PRIOR)
        bend = scale * (x.T * (p * (1 - p))) @ x + RIDGE * np.eye(len(w))
        w = w - np.linalg.solve(bend, slope)
    return tuple(w.tolist())


def leaning(block: Block, text: str, level: int, model: tuple[float, ...] = PRIOR) -> float:
    """Terminal capacity of a block: towards content (above 0) or boilerplate."""
    frame = block.frame
    main = frame.main >= level > 0
    odds = sum(a * b for a, b in zip(model, features(block, text)))
    # In an article the text alone decides little; outside one, or on a page that marks none, it decides.
    score = 3.0 + max(-1.0, min(1.0, 0.3 * odds)) if main else (-2.0 if level else 1.0) + max(-3.0, min(3.0, odds))
    return score - 12.0 * (frame.boilerplate or bool(_COPYRIGHT.match(text))) - 2.5 * frame.hinted


def minimum_cut(lean: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay on the content side of a minimum cut; maximum flow along layered shortest paths."""
    ends: list[int] = []
    spare: list[float] = []
    beside: list[list[int]] = [[] for _ in lean]
    for a, b, c in edges:  # an edge and its reverse stand next to each other
        beside[a].append(len(ends))
        beside[b].append(len(ends) + 1)
        ends += [b, a]
        spare += [c, c]
    left, least = list(lean), 1e-9  # what a node can still send from (above 0) or to (below 0) its terminal
    while True:
        layer = [-1] * len(left)
        queue = [k for k, x in enumerate(left) if x > least]
        for k in queue:
            layer[k] = 0
        reached = False
        for k in queue:  # grows while it is read
            reached |= left[k] < -least
            for e in beside[k]:
                if spare[e] > least and layer[ends[e]] < 0:
                    layer[ends[e]] = layer[k] + 1
                    queue.append(ends[e])
        if not reached:
            return [x >= 0 for x in layer]
        turn = [0] * len(left)
        for source in [k for k in queue if layer[k] == 0]:
            path, k = [], source
            while left[source] > least:
                if left[k] < -least:
                    flow = min(left[source], -left[k], *(spare[e] for e in path))
                    left[source] -= flow
                    left[k] += flow
                    for e in path:
                        spare[e] -= flow
                        spare[e ^ 1] += flow
                    path, k = [], source
                    continue
                while turn[k] < len(beside[k]):
                    e = beside[k][turn[k]]
                    if spare[e] > least and layer[ends[e]] == layer[k] + 1:
                        break
                    turn[k] += 1
                if turn[k] < len(beside[k]):
                    path.append(e)
                    k = ends[e]
                elif path:
                    k = ends[path.pop() ^ 1]
                    turn[k] += 1
                else:
                    break


def main_text(page: str | None, model: tuple[float, ...] = PRIOR) -> str:
    """Main text of a whole page: its content blocks, joined by line ends."""
    blocks = blocks_of(page) if page else []
    texts = [b.text() for b in blocks]
    level = max((b.frame.main for b in blocks if not b.frame.boilerplate), default=0)  # the surest mark the page has
    lean = [leaning(b, t, level, model) for b, t in zip(blocks, texts)]
    edges, before = [], {}
    for k, block in enumerate(blocks):
        if k:
            edges.append((k - 1, k, TIE))
        parent = block.frame.number
        if parent in before:
            edges.append((before[parent], k, PARENT_TIE))
        before[parent] = k
    content = minimum_cut(lean, edges)
    return "\n".join(t for t, keep in zip(texts, content) if keep)


def train(pages: DataFrame) -> tuple[float, ...]:
    """The classifier of block texts, from ``SAMPLE_PAGES`` pages at most that mark their article.

    Blocks in an article count as content, others as boilerplate. Pages are drawn by a hash of
    their id; only figures of up to ``SAMPLE_BLOCKS`` blocks a page reach the driver.
    """
    marked = pages.where(F.col("html").rlike(r"(?i)<(article|main)\b")).where("page_id is not null").select("page_id", F.xxhash64("page_id", F.lit(3)).alias("draw"))
    chosen = marked.distinct().orderBy("draw", "page_id").limit(SAMPLE_PAGES).select("page_id")

    def run(batches):
        for batch in batches:
            rows = []
            for page in batch.column(0).to_pylist():
                blocks = blocks_of(page or "")
                for block in blocks[:: max(1, -(-len(blocks) // SAMPLE_BLOCKS))]:
                    rows.append((features(block, block.text()), int(block.frame.main == 2 and not block.frame.boilerplate)))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.list_(pa.float64())), pa.array([r[1] for r in rows], pa.int32())], names=["x", "y"])

    sample = pages.join(F.broadcast(chosen), "page_id", "left_semi").dropDuplicates(["page_id"]).select("html")
    return fit(sorted((list(r["x"]), r["y"]) for r in sample.mapInArrow(run, "x array<double>, y int").collect()))


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    Null html counts as empty and gives an empty text; null ids and urls stay null; other columns
    are ignored; repeated rows give repeated results; an empty table gives no rows.
    """
    pages = pages.selectExpr("cast(page_id as long) page_id", "cast(url as string) url", "cast(html as string) html")
    model = train(pages)

    def run(batches):
        for batch in batches:
            done = 0
            for some in chunks([x or "" for x in batch.column(2).to_pylist()], CHUNK_CHARS):
                texts = [main_text(x, model) for x in some]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(some)), batch.column(1).slice(done, len(some)), pa.array(texts, pa.string()),
                                                  pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
                done += len(some)

    return pages.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
