"""Main text of web pages by two passes of block rules."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Elements by what they mean for the text around them.
RAW = frozenset("script style noscript iframe title textarea xmp noembed noframes".split())
EMBEDDED = frozenset("template object svg math canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head button select datalist map".split())
#: Elements around text that is not the article's, as a rule; those that may just as well hold the whole page.
AROUND = frozenset("nav footer aside dialog menu".split())
WRAPPERS = frozenset("form fieldset header".split())
PARAGRAPHS = frozenset("p blockquote pre".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike"
    " strong sub sup time tt u var wbr".split()
)
# Elements that svg and math cannot hold, so that they end these, and those in them that hold HTML again.
HTML_ONLY = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s"
    " small span strong strike sub sup table tt u ul var".split()
)
HTML_AGAIN = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
# Parts of class and id names, and roles, that mark what is not the article: adverts and notices, layout,
# reader comments.
STRICT = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert"
    " popup modal newsletter subscribe signup login share sharing breadcrumb breadcrumbs related recommended recommendations pagination pager"
    " adsbygoogle disclaimer copyright paywall toast subscription feedback trending popular outbrain taboola".split()
)
LAYOUT = frozenset(
    "banner overlay social sidebar rail menu nav navbar navigation footer header masthead topbar toolbar widget skip hidden".split()
)
COMMENTS = frozenset("comment comments disqus replies commentlist commentform respond reply".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Such names belong to the article even beside a mark, as in "post-header", but not beside a mark of comments.
OWN = frozenset("article post entry content story main body".split())
# Frequent words of English, German, French and Spanish.
STOP = frozenset(
    "the of and to a in is that for it as was with be by on not he his but at are this have from or had an they which one you were all her"
    " der die und das von zu den mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei"
    " de la le et les des en un du une que est pour qui dans par plus pas au sur se ce il sont avec aux ne son"
    " el y los del las por con para no su al lo como más pero sus o este sí porque esta entre".split()
)
# Class and id names and roles of an element that holds the article where no article or main element does.
HOLDERS = frozenset(
    "article article-body articlebody article-content article-text post-body post-content post-text entry-content entry-body story-body"
    " story-content main-content maincontent body-content page-content content".split()
)
HOLDER_ROLES = frozenset(("main", "article"))
#: Least share of stop words and most share of linked characters of a text block, least characters of a decided one.
STOP_SHARE, LINK_SHARE, SHORT = 0.2, 0.4, 80
#: Most characters of a line that names the owner of the rights.
RIGHTS_LENGTH = 400

_TAG = re.compile(r"""<!--|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>|<[a-zA-Z/!?][^>]*\Z""")
_NAME = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?(?=[\s/]|$)""", re.I)
_COMMENT_END = re.compile(r"--!?>")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}
_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in EMBEDDED}
_SELF_CLOSED = re.compile(r"(?<!=)(?:^|[\s\"'/]|(?:^|[\s\"'/])[^\s\"'=/]+)/\Z")
_PARTS = re.compile(r"[^a-zA-Z0-9]+|(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"\w+")
_RIGHTS = re.compile(r"©|\(c\) |copyright\b", re.I)

GOOD, BAD, UNSURE, LONG = "good", "bad", "unsure", "long"


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    inside: int  # 2 if an article or main element holds it, 1 if an element named like one does
    heading: bool
    paragraph: bool = False
    region: int = -1  # the innermost marked element around it
    holder: int = -1  # the innermost article or main element around it


@dataclass
class Region:
    """A marked element: a mark speaks against all blocks in it, unless it turns out to hold the article."""

    around: int  # the marked element around it, -1: none
    kind: str
    closed: bool = False  # by its own end tag


@dataclass
class Holder:
    """An article or main element."""

    around: int  # the one around it, -1: none
    region: int


def _holds(name: str, attributes: str) -> int:
    """Whether an element holds the article: 2 if its name says so, 1 if an attribute does."""
    if name in ("article", "main"):
        return 2
    if not attributes or name in ("html", "body"):
        return 0
    for m in _NAME.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id") and HOLDERS & set(value.split()) or key == "role" and value in HOLDER_ROLES or key == "itemprop" and value == "articlebody":
            return 1
    return 0


def _mark(name: str, attributes: str, inside: int) -> str:
    """What marks an element as no part of the article: "around", "wrapper", "strict", "layout", "comments"; or ""."""
    found = ""
    if name in AROUND:
        found = "around"
    elif name in WRAPPERS and not (name == "header" and inside):
        found = "wrapper"
    if not attributes or name in ("html", "body", "main"):
        return found
    for m in _NAME.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return "strict"
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return "strict"
        if key == "role" and value.lower() in ROLES:
            found = found or "around"
        if key in ("class", "id"):
            for one in value.split():
                parts = {p.lower().rstrip("0123456789") for p in (*_PARTS.split(one), *_PARTS.split(one.lower()))}
                if parts & COMMENTS:
                    return "comments"
                if parts & OWN:
                    continue
                if parts & STRICT:
                    found = "strict"
                elif parts & LAYOUT:
                    found = found or "layout"
    return found


def blocks(html: str) -> list[Block]:
    """The blocks of `parse`."""
    return parse(html)[0]


def parse(html: str) -> tuple[list[Block], list[Region], list[Holder]]:
    """Text between block-level tags, in page order, without elements that nobody sees as text; marked elements; holders. Broken markup is read as far as it goes:
    an end tag closes the nearest open element of its name, and all left open inside it; an embedded element that no later
    tag of the page ends holds nothing."""
    out: list[Block] = []
    regions: list[Region] = []
    holders: list[Holder] = []
    text: list[str] = []
    linked = 0
    # Name, whether it is dropped, how surely it is or lies in an article, whether it is a link, a heading, of svg or math, its region
    # and holder, whether it is a paragraph.
    stack: list[tuple[str, bool, int, bool, bool, bool, int, int, bool]] = [("", False, 0, False, False, False, -1, -1, False)]
    last_end: dict[str, int] = {}

    def close() -> None:
        nonlocal linked
        joined = " ".join("".join(text).split())
        if joined:
            _, _, inside, _, heading, _, region, holder, paragraph = stack[-1]
            out.append(Block(joined, linked, inside, heading, paragraph, region, holder))
        text.clear()
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        if piece and not stack[-1][1]:
            plain = unescape(piece) if "&" in piece else piece
            text.append(plain)
            if stack[-1][3]:
                linked += len(plain.strip())

    at = 0
    while m := _TAG.search(html, at):
        add(html[at : m.start()])
        at = m.end()
        if m[0] == "<!--":
            end = _COMMENT_END.search(html, at)
            at = end.end() if end else len(html)
            continue
        closing, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        if name not in INLINE:
            close()
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    if stack[i][6] != stack[i - 1][6]:
                        regions[stack[i][6]].closed = True
                    del stack[i:]
                    break
                if stack[i][0] == "template":  # what it holds ends nothing outside
                    break
            continue
        foreign = stack[-1][5] and stack[-1][0] not in HTML_AGAIN
        if foreign and name in HTML_ONLY:
            while stack[-1][5]:
                stack.pop()
            foreign = False
        if (foreign or name in ("svg", "math")) and _SELF_CLOSED.search(attributes):
            continue
        if name in EMBEDDED:
            if name not in last_end:
                last_end[name] = max((e.start() for e in _END[name].finditer(html, at)), default=-1)
            if last_end[name] < at:
                continue
        if name in RAW and not foreign:
            end = _RAW_END[name].search(html, at)
            at = end.end() if end else len(html)
            continue
        if name in VOID:
            continue
        if name in ("p", "li") and stack[-1][0] == name:  # a new one ends the last one of its kind
            stack.pop()
        _, gone, inside, link, heading, _, region, holder, paragraph = stack[-1]
        gone = gone or name in EMBEDDED or name in UNSEEN
        kind = "" if gone else _mark(name, attributes, inside)
        if kind:
            regions.append(Region(region, kind))
            region = len(regions) - 1
        if name in ("article", "main") and not gone:
            holders.append(Holder(holder, region))
            holder = len(holders) - 1
        stack.append(
            (name, gone, max(inside, _holds(name, attributes)), link or name == "a", heading or re.fullmatch("h[1-6]", name) is not None, foreign or name in ("svg", "math"), region, holder, paragraph or name in PARAGRAPHS)
        )
    add(html[at:])
    close()
    return out, regions, holders


def _stop_share(text: str) -> float:
    words = _WORD.findall(text.lower())
    return sum(w in STOP for w in words) / max(1, len(words))


def judge(block: Block) -> str:
    """First pass. Link density, then length and stop words; inside an article only links speak against a block.

    Elsewhere few stop words do not: another language, names, tables and code have few. But no word, or one over and over, is no text.
    """
    length = len(block.text)
    words = _WORD.findall(block.text.lower())
    share = sum(w in STOP for w in words) / max(1, len(words))
    if length <= RIGHTS_LENGTH and _RIGHTS.match(block.text) and not block.paragraph:
        return BAD
    if block.linked > LINK_SHARE * length:
        return UNSURE if block.inside else BAD
    if block.inside:
        return GOOD if length >= SHORT or share >= STOP_SHARE else UNSURE
    if length < SHORT or block.heading:
        return UNSURE
    if share >= STOP_SHARE:
        return GOOD
    return LONG if len(words) == 1 or len(set(words)) > 1 else BAD


def _settle(found: list[Block], labels: list[str]) -> list[str]:
    """The labels with long blocks of few stop words made good or bad."""
    size = {kind: sum(len(b.text) for b, x in zip(found, labels, strict=True) if x == kind) for kind in (GOOD, LONG)}
    if size[LONG] >= size[GOOD]:
        return [GOOD if x == LONG else x for x in labels]
    sides: list[set[str]] = [set() for _ in labels]
    for order in (range(len(labels)), range(len(labels) - 1, -1, -1)):
        last = None
        for i in order:
            if labels[i] in (GOOD, BAD):
                last = labels[i]
            elif last:
                sides[i].add(last)
    return [(BAD if sides[i] == {BAD} else GOOD) if x == LONG else x for i, x in enumerate(labels)]


def _nested(found: list[Block], good: list[int], holders: list[Holder]) -> set[int]:
    """Article elements inside another one or main whose own good text is no less than that of any of them: what readers
    or related pages say. `good` tells each block's characters of good text."""
    total, own = [0] * len(holders), [0] * len(holders)
    for block, size in zip(found, good, strict=True):
        if block.holder >= 0:
            own[block.holder] += size
    for i in range(len(holders) - 1, -1, -1):  # an outer one stands before those in it
        total[i] += own[i]
        if holders[i].around >= 0:
            total[holders[i].around] += total[i]
    largest = [0] * len(holders)
    for i, h in enumerate(holders):
        if h.around >= 0:
            largest[h.around] = max(largest[h.around], total[i])
    gone: set[int] = set()
    for i, h in enumerate(holders):
        if h.around >= 0 and (h.around in gone or own[h.around] > 0 and own[h.around] >= largest[h.around]):
            gone.add(i)
    return gone


def _standing(found: list[Block], good: list[int], regions: list[Region], holders: list[Holder]) -> list[bool]:
    """Whether each block is free of marks that count; `good` tells each block's characters of good text.

    A mark does not count for an element that holds the article: the article or main element with most good text outside
    of comments and adverts; or, if the mark is one of layout, more than half of the good text in a run of two blocks or
    more; or all text there is. A menu, footer or the like that its own end tag closes counts even then.
    """
    sure = [False] * len(regions)  # comments, adverts, notices: here or around
    for i, r in enumerate(regions):
        sure[i] = r.kind in ("strict", "comments") or r.around >= 0 and sure[r.around]
    size, total = [0] * len(holders), [0] * len(holders)
    for b, g in zip(found, good, strict=True):
        if b.holder >= 0:
            size[b.holder] += g
            total[b.holder] += len(b.text)
    for i in range(len(holders) - 1, -1, -1):
        if holders[i].around >= 0:
            size[holders[i].around] += size[i]
            total[holders[i].around] += total[i]
    holding: set[int] = set()
    if any(total):
        outer = [i for i, h in enumerate(holders) if h.around < 0]
        best = max(outer, key=lambda i: (holders[i].region < 0 or not sure[holders[i].region], size[i], total[i], -i))
        at = holders[best].region
        while at >= 0:
            holding.add(at)
            at = regions[at].around
    mass, run, blocks_in = [0] * len(regions), [0] * len(regions), [0] * len(regions)
    least = max((b.inside for b in found), default=0)
    for b, g in zip(found, good, strict=True):
        if b.region >= 0 and b.inside == least:
            mass[b.region] += g
            run[b.region] += g > 0
            blocks_in[b.region] += 1
    for i in range(len(regions) - 1, -1, -1):
        if regions[i].around >= 0:
            up = regions[i].around
            mass[up], run[up], blocks_in[up] = mass[up] + mass[i], run[up] + run[i], blocks_in[up] + blocks_in[i]
    whole = sum(g for b, g in zip(found, good, strict=True) if b.inside == least)
    count = sum(b.inside == least for b in found)
    clear = [False] * len(regions)
    for i, r in enumerate(regions):
        free = i in holding or (r.kind != "around" or not r.closed) and (
            r.kind in ("layout", "wrapper", "around") and run[i] > 1 and 2 * mass[i] > whole or mass[i] > 0 and blocks_in[i] == count
        )
        clear[i] = free and (r.around < 0 or clear[r.around])
    return [b.region < 0 or clear[b.region] for b in found]


def _in_good_runs(found: list[Block], labels: list[str]) -> list[str]:
    """The labels with paragraphs left open made good where the run of paragraphs they stand in has good ones and no bad one."""
    out, i = list(labels), 0
    while i < len(found):
        j = i + 1
        if found[i].paragraph:
            while j < len(found) and found[j].paragraph and found[j].region == found[i].region:
                j += 1
            said = set(labels[i:j])
            if GOOD in said and BAD not in said:
                out[i:j] = [GOOD] * (j - i)
        i = j
    return out


def decide(found: list[Block], regions: list[Region] = (), holders: list[Holder] = ()) -> list[Block]:
    """Second pass: a paragraph left open is good in a run of paragraphs of which some are good and none is bad. Any other
    open block takes the label of the nearest decided one, of two equally near ones the good one inside an article;
    elsewhere a paragraph with stop words takes the good one, other blocks the bad one. A heading goes with what follows. Inside an article all are good where none is decided; elsewhere a page's ends count as bad.

    Before, long blocks of few stop words: all are good if they outweigh the page's blocks that stop words speak for. Else
    such a run of blocks is bad only if links or emptiness speak against it on every side where anything is decided.

    Blocks whose marks count are bad. A page that marks its article says itself that text outside is something else.
    """
    best = max((b.inside for b in found), default=0)
    first = [judge(b) for b in found]
    good = [len(b.text) if x in (GOOD, LONG) else 0 for b, x in zip(found, first, strict=True)]
    free = _standing(found, good, regions, holders) if regions else [True] * len(found)
    if holders:
        gone = _nested(found, [g if f else 0 for g, f in zip(good, free, strict=True)], holders)
        free = [f and b.holder not in gone for f, b in zip(free, found, strict=True)]
    if best:
        stay = [i for i, (b, f) in enumerate(zip(found, free, strict=True)) if f and b.inside == best]
        found, first, free = [found[i] for i in stay], [first[i] for i in stay], [True] * len(stay)
    # What a marked element holds is bad, whatever it says, and does not weigh on what long blocks are.
    settled = iter(_settle([b for b, f in zip(found, free, strict=True) if f], [x for x, f in zip(first, free, strict=True) if f]))
    labels = _in_good_runs(found, [next(settled) if f else BAD for f in free])
    ahead: list[tuple[int, str] | None] = [None] * len(found)
    nearest = None if best else (len(found), BAD)
    for i in range(len(found) - 1, -1, -1):
        ahead[i] = nearest
        if labels[i] != UNSURE:
            nearest = (i, labels[i])
    kept, behind = [], None if best else (-1, BAD)
    for i, (block, label) in enumerate(zip(found, labels, strict=True)):
        if label == UNSURE:
            near = [x for x in (behind, ahead[i]) if x]
            if block.heading and ahead[i]:
                near = [ahead[i]]
            least = min((abs(x[0] - i) for x in near), default=0)
            said = {x[1] for x in near if abs(x[0] - i) == least}
            open_ = block.inside or block.paragraph and _stop_share(block.text) >= STOP_SHARE
            label = said.pop() if len(said) == 1 else GOOD if open_ else BAD
        else:
            behind = (i, label)
        if label == GOOD:
            kept.append(block)
    return kept


def extract(html: str | None) -> str:
    """The main text: white space inside a block becomes one space, blocks are joined by one space."""
    return " ".join(b.text for b in decide(*parse(html))) if html else ""


def main_text(html: Column) -> Column:
    """`extract` of a column. Null or empty html, and a page without main text: an empty string."""

    @F.arrow_udf("string")
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([extract(x) for x in pages.to_pylist()], pa.string())

    return run(F.coalesce(html, F.lit("")))


def pages_text(pages: DataFrame) -> DataFrame:
    """Per row of pages (page_id, url, html): page_id, url, text, n_chars.

    Rows stay rows, repeated ones and such with nulls, too; null or empty html: an empty text. A page is read whole in one
    task, whatever its length, in time in proportion to it. Other columns take no part. No rows: no rows.
    """
    out = pages.select("page_id", "url", main_text(F.col("html")).alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
