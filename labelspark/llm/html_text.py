"""The main text of web pages, by a minimum cut between content and boilerplate.

A page is cut into blocks of text. A classifier weighs each block: what speaks for content is the capacity of its edge from the
source, what speaks against it that of its edge to the sink. Blocks that follow each other, and blocks of one parent, are
joined by edges whose capacity is the price of labelling them apart. The minimum cut parts content from the rest.

An element whose class or id speaks against it is a node of its own: its blocks are content only if it is, and that costs
more the more text the page has outside of it. So such a name on a wrapper of the whole article does not decide alone.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelspark.llm.common import slices
from labelspark.llm.mincut import content_side

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
DROPPED = frozenset(
    "script style title template noscript svg math iframe object canvas audio video select textarea button head".split()
)
HEAD = frozenset("base link meta noscript script style template title".split())
RAW = frozenset("script style title textarea iframe noscript".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
#: Elements that end when one of the others opens, and what bounds the search for them.
IMPLIED = {
    "li": (frozenset({"li"}), frozenset("ul ol menu".split())),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
}

# What names and roles tell.
MAIN = frozenset({"article", "main"})
AROUND = frozenset({"nav", "footer", "aside", "menu"})
ROLES = frozenset("navigation banner contentinfo complementary search alert menu menubar".split())
#: Elements and roles that surround the main text mostly, but are put around whole pages, too, as hidden elements are.
MAY_HOLD = frozenset({"form", "dialog"})
MAY_HOLD_ROLES = frozenset({"form", "dialog", "alertdialog"})
MARKED = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion sidebar aside nav navbar navigation "
    "menu breadcrumb breadcrumbs masthead footer cookie cookies consent gdpr popup modal overlay comment comments respond disqus "
    "replies share sharing social related recommended newsletter subscribe signup login pagination pager widget toolbar copyright "
    "skip notice notices alert banner disclaimer".split()
)
#: Beginnings of further names of that kind, such as commentlist.
MARKED_STARTS = ("comment", "advert", "sidebar", "cookie", "newsletter", "breadcrumb", "sponsor", "footer", "navig", "popup")
#: Names that only tell outside an article, and names that speak for one.
MARKED_OUTSIDE = frozenset("header search form top bottom legal".split())
OWN = frozenset("article content post entry story main".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+|[^>]*)(?:>|\Z)", re.DOTALL
)
ATTRIBUTES = re.compile(r"""([^\s=/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"']+))?""")
NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SPACE = re.compile(r"\s+")
ENDS = re.compile(r"[.!?…:;。！？][\"'”’»)\]]*$")
NOTICES = re.compile(
    r"©|\(c\)|\bcopyright\b|\bcookies?\b|\bsubscribe\b|\bnewsletter\b|\ball rights reserved\b|\bprivacy policy\b"
    r"|\balle rechte vorbehalten\b|\bimpressum\b|\bdatenschutz(?:erklärung|hinweise?)?\b|\btous droits réservés\b|\bmentions légales\b"
    r"|\bpolitique de confidentialité\b|\btodos los derechos reservados\b|\baviso legal\b|\bpolítica de privacidad\b",
    re.IGNORECASE,
)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)

# Weights of the classifier and prices of the cut.
HARD = 200
IN_MAIN = 14
LONG_TEXT, SOME_TEXT, SENTENCE, HEADING = 10, 4, 4, 3
LINKS, SOME_LINKS, SHORT, NOTHING, NOTICE = 12, 5, 1, 1, 12
SAME_PARENT, NEAR_PARENT, OTHER_PARENT, ACROSS = 6, 4, 2, 1
#: What an element costs whose name speaks against it, beside twice what the page has elsewhere; less if its name also speaks for it or it has the page's head.
NAMED, NAMED_OWN = 20, 6
NO, BY_NAME, SURELY = range(3)


@dataclass
class Block:
    text: str
    parent: int
    above: int
    tag: str
    in_main: bool
    around: bool
    linked: int
    #: The innermost element marked by its name alone and the outermost article within it, 0 without.
    mark: int = 0
    article: int = 0


@dataclass
class Mark:
    """An element marked by its name alone."""

    above: int
    own: bool


def attributes(text: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in ATTRIBUTES.findall(text)}


def named(found: dict[str, str]) -> set[str]:
    """The words of an element's classes and id."""
    return {n.lower() for key in ("class", "id") for n in NAMES.findall(found.get(key, ""))}


def tells(names: set[str]) -> bool:
    """Whether a name is one of what surrounds the main text."""
    return bool(names & MARKED) or any(n.startswith(MARKED_STARTS) for n in names)


def marked(tag: str, given: str, in_main: bool) -> int:
    """Whether an element's tag or role say that it surrounds the main text (SURELY), or its classes, or a tag, role or style that whole pages are wrapped in as well
    (BY_NAME): these have a price that what they hold can outweigh."""
    if tag in AROUND or (tag == "header" and not in_main):
        return SURELY
    if tag in MAY_HOLD:
        return BY_NAME
    if "=" not in given and "hidden" not in given or tag in ("html", "body", "article", "main"):
        return NO
    found = attributes(given)
    if found.get("role", "") in ROLES:
        return SURELY
    if "hidden" in found or found.get("aria-hidden") == "true" or HIDDEN.search(found.get("style", "")) or found.get("role", "") in MAY_HOLD_ROLES:
        return BY_NAME
    names = named(found)
    if tells(names) or names & MARKED_OUTSIDE and not in_main and not names & OWN:
        return BY_NAME
    return NO


def blocks_of(page: str) -> tuple[list[Block], dict[int, Mark]]:
    """The blocks with text, in page order, and the elements marked by name; white space within a block is one space."""
    found: list[Block] = []
    marks: dict[int, Mark] = {}
    # Open elements: name, number, in the main element, marked, within a link, element marked by name, article in it.
    stack: list[tuple[str, int, bool, bool, bool, int, int]] = [("", 0, False, False, False, 0, 0)]
    parts: list[str] = []
    number, linked, dropped, at = 0, 0, 0, 0

    def close() -> None:
        nonlocal linked
        if parts:
            text = SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                holding = [s for s in stack if s[0] in BLOCKS or not s[0]]
                own, parent, above = [*reversed(holding), stack[0], stack[0]][:3]
                found.append(Block(text, parent[1], above[1], own[0], own[2], own[3] or stack[-1][3], linked, *stack[-1][5:]))
            parts.clear()
        linked = 0

    def pop(names: frozenset, bounds: frozenset) -> None:
        """Ends the innermost of the named elements, with all within, unless a bound comes first."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                close()
                del stack[i:]
                return
            if stack[i][0] in bounds:
                return

    position = 0
    while match := TOKEN.search(page, position):
        if match.start() > at and not dropped:
            text = page[at : match.start()]
            parts.append(text)
            if stack[-1][4]:
                linked += len(text)
        at = position = match.end()
        ends, tag = match[1], (match[2] or "").lower()
        if not tag:
            continue
        if ends:
            if tag in BLOCKS and not dropped:
                close()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    dropped -= sum(s[0] in DROPPED for s in stack[i:])
                    del stack[i:]
                    break
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}[^>]*>", re.IGNORECASE).search(page, at)
            at = position = end.end() if end else len(page)
            continue
        if tag == "br":
            parts.append(" ")
        if tag in VOID:
            if tag == "hr" and not dropped:
                close()
            continue
        if dropped and tag not in HEAD and any(s[0] == "head" for s in stack):
            del stack[next(i for i, s in enumerate(stack) if s[0] == "head") :]  # a head that was not closed
            dropped = 0
        if tag in BLOCKS and not dropped:
            close()
            if any(s[0] == "p" for s in stack[-4:]):
                pop(frozenset({"p"}), frozenset({"td", "th", "li", "button"}))
        if tag in IMPLIED and not dropped:
            pop(*IMPLIED[tag])
        if match[3].endswith("/") and tag not in BLOCKS and tag not in DROPPED:
            continue
        _, _, in_main, around, in_link, mark, article = stack[-1]
        number += 1
        dropped += tag in DROPPED
        kind = marked(tag, match[3], in_main)
        if kind == BY_NAME:
            marks[number] = Mark(mark, bool(named(attributes(match[3])) & OWN))
            mark, article = number, 0
        elif mark and tag in MAIN:
            names = named(attributes(match[3]))
            if not tells(names) or names & OWN:
                mark, article = (0, 0) if tag == "main" else (mark, article or number)
        stack.append((tag, number, in_main or tag in MAIN, around or kind == SURELY, in_link or tag == "a", mark, article))
    if at < len(page) and not dropped:
        parts.append(page[at:])
    close()
    # A single article ends the mark of the element around it; several may be a list of teasers.
    articles: dict[int, set[int]] = {}
    for block in found:
        if block.mark and block.article:
            articles.setdefault(block.mark, set()).add(block.article)
    for block in found:
        if block.article and len(articles[block.mark]) == 1:
            block.mark = 0
    return found, marks


def costs(blocks: list[Block], gains: list[int], marks: dict[int, Mark]) -> dict[int, int]:
    """What each element marked by name costs as content: more, the more speaks for the text outside of it.

    That is the text without a mark or that of one other marked element which is not within it, whichever is greater.
    """
    held = dict.fromkeys([0, *marks], 0)
    for block, g in zip(blocks, gains, strict=True):
        if not block.around and g > 0:
            held[block.mark] += g
    order = list(marks)  # elements within one follow it at once
    place = {m: i for i, m in enumerate(order)}
    last = list(range(len(order)))
    for i in range(len(order) - 1, -1, -1):
        above = marks[order[i]].above
        if above:
            last[place[above]] = max(last[place[above]], last[i])
    before = [0, *accumulate((held[m] for m in order), max)]
    after = [0, *accumulate((held[m] for m in reversed(order)), max)][::-1]
    headed = {b.mark for b in blocks if b.tag == "h1" and not b.around}
    found = {}
    for i, m in enumerate(order):
        rest = max(held[0], before[i], after[last[i] + 1])
        found[m] = NAMED_OWN + rest // 2 if marks[m].own or m in headed else NAMED + 2 * rest
    return found


def gain(block: Block) -> int:
    """What speaks for content less what speaks against it."""
    words = block.text.count(" ") + 1
    links = min(1.0, block.linked / len(block.text))
    score = -NOTHING - (HARD if block.around else 0) + (IN_MAIN if block.in_main else 0)
    score -= LINKS if links > 0.6 else SOME_LINKS if links > 0.3 else 0
    if links <= 0.3:
        score += LONG_TEXT if words >= 10 else SOME_TEXT if words >= 6 else 0
    if ENDS.search(block.text):
        score += SENTENCE
    if words < 40 and not block.in_main and NOTICES.search(block.text):
        score -= NOTICE
    if block.tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
        score += HEADING
    elif words < 4:
        score -= SHORT
    return score


def smoothness(blocks: list[Block]) -> list[tuple[int, int, int]]:
    """Edges from each block to the next one, and to the next one of the same parent; the nearer in the tree, the dearer.

    A marked element is a boundary already: blocks within are joined to each other, blocks around it to the next one outside, and
    across the boundary at a low price if it is marked by its name alone.
    """
    edges = []
    last: dict[tuple[tuple[bool, int], int], int] = {}
    before: dict[tuple[bool, int], int] = {}
    for i, block in enumerate(blocks):
        side = (block.around, block.mark)
        if (j := before.get(side)) is not None:
            other = blocks[j]
            near = block.parent in (other.above, other.parent) or other.parent == block.above or block.above == other.above
            edges.append((j, i, SAME_PARENT if other.parent == block.parent else NEAR_PARENT if near else OTHER_PARENT))
        if last.get((side, block.parent), j) != j:
            edges.append((last[side, block.parent], i, NEAR_PARENT))
        if i and blocks[i - 1].mark != block.mark and not block.around and not blocks[i - 1].around:
            edges.append((i - 1, i, ACROSS))
        last[side, block.parent] = before[side] = i
    return edges


def main_text(page: str) -> str:
    """The blocks on the content side, joined by empty lines."""
    blocks, marks = blocks_of(page)
    gains = [gain(b) for b in blocks]
    price = costs(blocks, gains, marks)
    node = {m: len(blocks) + i for i, m in enumerate(price)}
    needs = [(i, node[b.mark], HARD) for i, b in enumerate(blocks) if b.mark]
    kept = content_side(gains + [-c for c in price.values()], smoothness(blocks), needs)
    return "\n\n".join(b.text for b, keep in zip(blocks, kept[: len(blocks)], strict=True) if keep)


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of each row, from the whole HTML.

    A null or empty page, and one without main text, has an empty text. Repeated rows give repeated results. Broken mark-up
    is read as far as it goes: open comments and tags reach to the end.
    """
    named = pages.select(
        F.col(f"`{id_col}`").alias("page_id"),
        F.col(f"`{url_col}`").alias("url"),
        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"),
    )

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                texts = [main_text(page) for page in part.column(2).to_pylist()]
                sizes = pa.array([len(t) for t in texts], pa.int64())
                columns = [part.column(0), part.column(1), pa.array(texts, pa.string()), sizes]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    kinds = dict(named.dtypes)
    return named.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
