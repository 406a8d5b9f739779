"""Main text of web pages by two-pass block rules.

Markup is cut into blocks at block-level tags. In the first pass each block is judged alone: by what its
containers say (navigation, header, footer, aside, form, adverts, notices, comments), by link density, by
length and by stop-word density. Short blocks and those with few stop words stay undecided. In the second
pass they take the label of the nearest decided neighbours, first within the same container. Good blocks
in page order, joined by line breaks, are the text.

Defined results: null or empty html has empty text; a page whose markup is cut off is read as far as it
goes, a cut tag at the end is dropped; a page without any decided block keeps what an article or main
element holds, else nothing; null and repeated ids keep their rows; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafmill.llm.common import arrow_type, as_bytes, id_type, map_rows

#: Links may make up so much of a good block.
LINKS = 0.33
#: Shorter blocks are undecided; longer ones need LOW stop words to be near good, HIGH to be good.
SHORT, LONG = 70, 200
LOW, HIGH = 0.15, 0.30

STOP_WORDS = frozenset(
    """the and of to in is that for it with as was on be by at this are from or an not have but they which
    der die das und ist ein eine nicht den von zu mit für auf dem des sich im als auch es wird bei aus sind
    le la les de des et un une est que pour dans qui sur pas au avec ne du ce par plus sont il elle
    el los las y en una es con por se del al su para como lo más pero sus""".split()
)
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table
    tbody td tfoot th thead tr ul""".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Read to their end tag without markup, as in the HTML standard.
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp".split())
APART = frozenset("nav header footer aside form menu dialog head template".split())
#: No text of the page inside; a block that begins before their end tag ends them.
CONTROLS = frozenset("svg select button object canvas".split())
HINTS = frozenset(
    """ad ads advert advertisement adverts sponsor sponsored promo banner cookie cookies consent gdpr notice
    notices popup modal overlay newsletter subscribe sidebar nav navbar navigation menu breadcrumb breadcrumbs
    footer header masthead comment comments disqus reply replies share sharing social related widget pagination
    pager toolbar login signup search alert complementary contentinfo""".split()
)
#: First or last parts of class names that tell a state of the page rather than what an element is.
STATES = frozenset("has no with without hide show is not open closed enabled disabled on off".split())
CONTENT = frozenset("article post entry content story".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
#: Blocks of running text; a compound name such as social-science says little about them.
RUNNING = frozenset(("p", "blockquote", "pre", "li", "figcaption", "caption", "td", "dd", "dt", *HEADINGS))
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_PART, _WORD = re.compile(r"[a-z]+"), re.compile(r"[^\W\d_]+")


def hints(names: list[str]) -> tuple[set[str], set[str]]:
    """Hints that class names, ids and roles give: those that are a whole name, and those that begin or end
    a compound one which does not tell a state (no-sidebar, comments-open)."""
    whole, compound = set(), set()
    for name in names:
        parts = _PART.findall(name)
        if len(parts) == 1:
            whole.update(parts)
        elif parts and not STATES.intersection((parts[0], parts[-1])):
            compound.update((parts[0], parts[-1]))
    return whole & HINTS, compound & HINTS


@dataclass
class Block:
    apart: bool
    inside: int  # number of the article or main element, 0 outside
    heading: bool
    doubtful: bool = False  # only its length and stop words can make it good
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""
    label: str = ""


def blocks(page: str) -> list[Block]:
    """Non-empty blocks in page order."""
    made: list[Block] = []
    # tag, apart, inside, link, loose (apart only by a compound name), doubtful (running text with such a name)
    stack: list[tuple[str, bool, int, bool, bool, bool]] = []
    opened: Counter = Counter()  # how often each tag is on the stack
    current, containers, at = None, 0, 0

    def add(raw: str) -> None:
        nonlocal current
        _, apart, inside, link, _, doubtful = stack[-1] if stack else _OUTSIDE
        if apart and opened["button"] + opened["select"] + opened["svg"] + opened["object"] + opened["canvas"]:
            return  # a control inside a sentence does not end its block
        if current is None:
            current = Block(apart, inside, any(opened[t] for t in HEADINGS), doubtful)
            made.append(current)
        text = html.unescape(raw)
        current.parts.append(text)
        if link:
            current.linked += len("".join(text.split()))

    def close(tags: frozenset, within: frozenset = frozenset()) -> None:
        """End the innermost open element of `tags` with all inside it, unless one of `within` stands between."""
        if not any(opened[t] for t in tags):
            return
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] in tags:
                opened.subtract(t for t, *_ in stack[depth:])
                del stack[depth:]
                return
            if stack[depth][0] in within:
                return

    while at < len(page):
        match = _TOKEN.search(page, at)
        if match is None:
            add(page[at:])
            break
        if match.start() > at:
            add(page[at : match.start()])
        at = match.end()
        tag = (match["tag"] or "").lower()
        if not tag:
            continue
        if tag in BLOCKS:
            current = None
        elif tag in ("br", "wbr"):
            if current is not None:
                current.parts.append(" " if tag == "br" else "")
            continue
        if match["end"]:
            close(frozenset((tag,)))
            continue
        if tag in RAW:
            if not match["rest"].endswith("/"):
                ended = re.compile(rf"</{tag}\s*[^>]*(?:>|\Z)", re.I).search(page, at)
                at = ended.end() if ended else len(page)
            continue
        if tag in VOID or (tag in CONTROLS and match["rest"].endswith("/")):
            continue
        if tag in BLOCKS:
            for _ in range(min(8, sum(opened[t] for t in CONTROLS))):
                close(CONTROLS, BLOCKS)
            close(_PARAGRAPH, BLOCKS)  # an open paragraph ends here
        _, apart, inside, link, loose, doubtful = stack[-1] if stack else _OUTSIDE
        rest = match["rest"]
        names, hidden = [], False
        if rest and tag not in ("html", "body"):
            for found in _NAMED.finditer(rest):
                names += (found[2] or found[3] or found[4] or "").lower().split()
            hidden = bool(_HIDDEN.search(rest))
        named = {part for name in names for part in _PART.findall(name)}
        article = tag in ("article", "main") or (bool(named & CONTENT) and tag in ("div", "section", "td"))
        whole, compound = hints(names)
        if inside or article:  # an article's own head holds its title
            whole, compound = whole - _HEAD, compound - _HEAD
        if article and not whole and not hidden:  # an article is not apart for what its state or its holder is called
            compound = set()
            apart = apart and not loose
        if hidden or whole or tag in CONTROLS or (tag in APART and not (tag == "header" and inside)):
            apart, loose = True, False
        elif compound and tag in RUNNING:
            doubtful = True
        elif compound and not apart:
            apart = loose = True
        if article and not inside and not apart:
            containers += 1
            inside = containers
        stack.append((tag, apart, inside, link or tag == "a", loose, doubtful))
        opened[tag] += 1
    for block in made:
        block.text = " ".join("".join(block.parts).split())
    return [b for b in made if b.text]


_OUTSIDE = ("", False, 0, False, False, False)
_PARAGRAPH, _HEAD = frozenset(("p",)), {"header", "banner", "search"}


def judge(block: Block) -> str:
    """good, near, bad, or short where the block alone does not tell."""
    if block.apart:
        return "bad"
    size = len(block.text)
    if block.linked > LINKS * size:
        return "bad"
    if size < SHORT:
        return "bad" if block.doubtful or (block.linked and not block.inside) else "short"
    words = _WORD.findall(block.text.lower())
    density = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if block.doubtful:
        return "good" if density >= (LOW if block.inside else HIGH) else "bad"
    if density >= HIGH:
        return "good" if block.inside or size > LONG else "near"
    if density >= LOW:
        return "good" if block.inside else "near"
    return "short" if block.inside else "bad"


def settle(found: list[Block]) -> list[Block]:
    """The second pass: labels for all blocks; returns the good ones."""
    labels = [judge(b) for b in found]
    decided = {"good", "bad"}

    def nearest(order: range, own: bool) -> list[str]:
        """The label of the nearest decided block before each in the given order; with `own`, of its container."""
        seen: dict[int, str] = {}
        out = [""] * len(found)
        for i in order:
            place = found[i].inside if own else 0
            out[i] = seen.get(place, "")
            if labels[i] in decided and not (own and found[i].apart):
                seen[place] = labels[i]
        return out

    ways = range(len(found)), range(len(found) - 1, -1, -1)
    sides_of = {own: [nearest(way, own) for way in ways] for own in (False, True)}
    first = list(labels)
    for i, block in enumerate(found):
        if first[i] in decided:
            continue
        own = bool(block.inside)
        sides = {side[i] for side in sides_of[own]} - {""}
        if own:
            labels[i] = "bad" if sides == {"bad"} else "good"
        elif first[i] == "near":
            labels[i] = "bad" if sides == {"bad"} else "good"
        elif block.heading and sides_of[False][1][i] == "good":
            labels[i] = "good"
        else:
            labels[i] = "good" if sides == {"good"} else "bad"
    for block, label in zip(found, labels):
        block.label = label
    return [b for b, label in zip(found, labels) if label == "good"]


def main_text(page: str) -> str:
    return "\n".join(b.text for b in settle(blocks(page)))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars per page."""
    kind = id_type(pages, id_col)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            made = [main_text(t.decode("utf-8", "replace")) for t in as_bytes(batch.column(2))]
            return pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow_type(kind)), batch.column(1), pa.array(made, pa.string()),
                 pa.array([len(t) for t in made], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

        return step

    source = pages.select(
        pages[id_col].alias("page_id"), pages["url"].cast("string").alias("url"),
        F.coalesce(pages[html_col].cast("string"), F.lit("")).alias("html"),
    )
    return map_rows(source, f"page_id {kind}, url string, text string, n_chars long", make)
