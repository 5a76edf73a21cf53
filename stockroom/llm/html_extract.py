"""Main text of web pages by tag-path ratios.

Each block of text belongs to a root-to-leaf path of block tags (with their
class, id and role). Per path the text length and the punctuation are summed
and divided by the number of its blocks; link text counts against it. Both
ratios are smoothed along the page, fused into one score, and paths whose score
reaches the threshold give the content blocks. A path inside a boilerplate
element (menus, headers and footers of the page, sidebars, notices, adverts,
forms) has score zero; a path inside ``article`` or ``main`` always passes, so
that headings and one-word paragraphs of the article stay. Text outside them is
selected by the scores on every page, with or without them.

Words in class and id (comments, related, sidebar) are a penalty on the score:
such a path has to be worth far more than the best of the others. They do not
count on ``main`` and what is around it, after has-, with- and no-, and on an
element with most of the page's text, unless an article lies outside of it.

Defined results: null and empty pages give the empty text; unclosed and stray
tags are closed as browsers do for paragraphs and lists; a tag cut off by the
end of the page is no text; unknown character references stay as they are; time
and memory are linear in the page. Repeated pages are treated each on its own.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stockroom.llm.textbytes import column

#: Attributes of a tag. Quotes count after "=" only; nothing is tried twice, so
#: that time stays linear on broken markup.
ATTRS = r"(?>[^>\"'=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|[\"'=])*+"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(script|style|noscript|template|svg|math|iframe|object|textarea|select|title)(?=[\s/>]){ATTRS}(?<!/)>"
    r".*?(?:</\1\b[^>]*(?:>|\Z)|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*+)({ATTRS})(?:>|\Z)",
    re.S | re.I)
ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s>]*))?""")
#: Deeper elements stand beside one another, as in browsers.
MAX_DEPTH = 512
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby "
                   "s samp small span strike strong sub sup time tt u var wbr br img".split())
#: Elements that hold no main text.
BOILERPLATE = frozenset("nav footer aside form button input select menu dialog label fieldset legend".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar "
                  "form advertisement note".split())
#: Words in class and id that mark boilerplate.
MARKS = re.compile(
    r"(?:^|[\s_\-])(?:ads?|advert\w*|adsense|adslot|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alerts?|"
    r"nav|navbar|navigation|menus?|breadcrumbs?|sidebar|sidenav|aside|widgets?|footer|foot|masthead|topbar|comments?|commentlist|disqus|respond|replies|reply|share|sharing|social|related|recommend\w*|newsletter|"
    r"subscribe|signup|login|popup|modal|overlay|toolbar|pagination|pager|skip|hidden|copyright|disclaimer|search)"
    r"(?=$|[\s_\-\d])", re.I)
#: Words that tell of another element: has-footer, with-sidebar, no-comments.
STATES = re.compile(r"(?:^|(?<=[\s_\-]))(?:has|have|with|without|no|not|is[_\-]not)[_\-][^\s]*", re.I)
HEADER_MARKS = re.compile(r"(?:^|\s)(?:(?:site|page|top|main|global)[\-_]?)?header(?=$|\s)", re.I)
PUNCTUATION = re.compile("[.,;:!?…。、，！？；：·¿¡]")
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table tbody div article section main body td th".split())
#: Factor for marked paths, on what is smoothed and on the score.
PENALTY = 1 / 3


class Block:
    __slots__ = ("path", "text", "link", "bad", "main", "mark", "soft")

    def __init__(self, path, text, link, bad, main, mark):
        self.path, self.text, self.link, self.bad, self.main, self.mark = path, text, link, bad, main, mark
        self.soft = False   # penalty


def _marks(tag: str, attrs: str, in_main: bool) -> tuple[str, bool, bool, bool]:
    """Path name of an element; is it boilerplate; is it the main element; do
    words in class or id mark it."""
    name, bad, main, soft = tag, tag in BOILERPLATE, tag in ("article", "main"), False
    if tag == "header" and not in_main:
        bad = True
    if attrs:
        for key, value in ATTR.findall(attrs):
            key, value = key.lower(), value.strip("\"'")
            if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                bad = True
            elif key == "style":
                bad = bad or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) is not None
            elif key == "role":
                main = main or value.lower() == "main"
                bad = bad or value.lower() in ROLES
                name += "@" + value
            elif key in ("class", "id"):
                words = STATES.sub("", value)
                if tag not in ("body", "html") and (
                        MARKS.search(words) or not in_main and HEADER_MARKS.search(words)):
                    soft = True
                name += "." + value
    return name, bad, main and not bad, soft


def blocks(page: str) -> list[Block]:
    """Text blocks in page order with their tag paths."""
    out: list[Block] = []
    stack: list[tuple[str, int, bool, bool, int]] = [("", 0, False, False, 0)]   # tag, path, boilerplate, main, mark
    marked = [0]   # elements that words mark: the marked element around each; 0 is none
    lone: list[int] = []   # mark of each outermost article
    paths: dict[tuple[int, str], int] = {}   # (path of the parent, element) -> path
    opened: Counter[str] = Counter()   # elements on the stack
    plain: dict[str, list[int]] = defaultdict(list)   # unmarked inline elements in each marked one on the stack
    held: list[str] = []
    links, linked = 0, 0   # open links, characters in links

    def flush():
        nonlocal linked
        if held:
            text = " ".join(html_lib.unescape("".join(held)).split())
            held.clear()
            if text:
                _, path, bad, main, mark = stack[-1]
                out.append(Block(path, text, min(linked, len(text)), bad, main, mark))
        linked = 0

    def close(at: int):
        for e in stack[at:]:
            opened[e[0]] -= 1
            if e[0] in INLINE:
                plain[e[0]].pop()
        del stack[at:]

    def enter(tag: str, name: str, bad: bool, main: bool, mark: int, soft: bool):
        path = paths.setdefault((stack[-1][1], name), len(paths) + 1)
        if len(stack) >= MAX_DEPTH:
            close(MAX_DEPTH - 1)
        if soft:
            marked.append(mark)
            mark = len(marked) - 1
        opened[tag] += 1
        if tag in INLINE:
            plain[tag].append(0)
        stack.append((tag, path, bad, main, mark))

    pos = 0
    for m in TOKEN.finditer(page):
        if m.start() > pos:
            piece = page[pos:m.start()]
            held.append(piece)
            if links:
                linked += len(piece.strip())
        pos = m.end()
        tag = m.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(2):
            if tag in INLINE:
                links -= links > 0 and tag == "a"
                if not opened[tag]:
                    continue
                if plain[tag][-1]:
                    plain[tag][-1] -= 1
                    continue
            for at in range(len(stack) - 1 if opened[tag] else 0, 0, -1):
                if stack[at][0] == tag:
                    flush()
                    close(at)
                    break
            else:
                if tag == "p":
                    flush()
            continue
        if tag in INLINE:
            if tag == "a":
                links += 1
            elif tag == "br":
                held.append(" ")
            elif tag not in ("img", "wbr"):
                _, _, bad, main, mark = stack[-1]
                name, own_bad, _, soft = _marks(tag, m.group(4), main) if m.group(4) else (tag, False, False, False)
                if own_bad or soft:   # counts as a block of its own
                    flush()
                    enter(tag, name, bad or own_bad, main and not own_bad, mark, soft)
                elif opened[tag]:
                    plain[tag][-1] += 1
            continue
        flush()
        links = 0
        if tag in VOID or tag in ("svg", "math"):   # closed in itself
            continue
        if stack[-1][0] == "p":
            close(len(stack) - 1)
        ends = CLOSED_BY.get(tag)
        if ends:
            for at in range(len(stack) - 1, 0, -1):
                if stack[at][0] in ends:
                    close(at)
                    break
                if stack[at][0] in SCOPES:
                    break
        _, _, bad, main, mark = stack[-1]
        name, own_bad, own_main, soft = _marks(tag, m.group(4) or "", main)
        bad = bad or own_bad
        if own_main and not bad and tag != "article":   # words on main and around it say nothing of it
            mark, soft = 0, False
        enter(tag, name, bad, (main or own_main) and not bad, mark, soft)
        if tag == "article" and not main and not bad:
            lone.append(stack[-1][4])
    held.append(page[pos:])
    flush()
    _weigh(out, marked, lone)
    return out


def _weigh(found: list[Block], marked: list[int], lone: list[int]) -> None:
    """Which blocks the words of class and id penalise; their articles do not
    pass by name. An element with more than half of the text, or a quarter and
    the only article, is no side matter, unless another article lies outside."""
    n = len(marked)
    if n == 1:
        return
    size = [0] * n
    for b in found:
        if not b.bad:
            size[b.mark] += len(b.text) - b.link
    holds = [False] * n
    if len(lone) == 1:
        holds[lone[0]] = True
    for k in range(n - 1, 0, -1):
        size[marked[k]] += size[k]
        holds[marked[k]] |= holds[k]
    whole = size[0]
    wide = [k > 0 and size[k] > whole * (0.25 if holds[k] else 0.5) for k in range(n)]
    # Articles with no mark but wide ones around them, in all and in each element.
    free = [True] * n
    for k in range(1, n):
        free[k] = free[marked[k]] and wide[k]
    inside = [0] * n
    for b in found:
        inside[b.mark] += b.main and not b.bad and free[b.mark]
    for k in range(n - 1, 0, -1):
        inside[marked[k]] += inside[k]
    soft = [False] * n
    for k in range(1, n):
        soft[k] = soft[marked[k]] or not (wide[k] and inside[k] == inside[0])
    for b in found:
        b.soft = soft[b.mark]
        b.main = b.main and not b.soft


def smooth(values: list[float], radius: int = 1) -> list[float]:
    """Gaussian mean over neighbours in page order."""
    weights = [math.exp(-k * k / 2) for k in range(radius + 1)]
    out = []
    for i in range(len(values)):
        total = weight = 0.0
        for k in range(-radius, radius + 1):
            if 0 <= i + k < len(values):
                total += weights[abs(k)] * values[i + k]
                weight += weights[abs(k)]
        out.append(total / weight)
    return out


def select(found: list[Block], share: float = 0.5) -> list[bool]:
    """Which blocks are content."""
    if not found:
        return []
    sums: dict[int, list[float]] = {}
    for b in found:
        s = sums.setdefault(b.path, [0.0, 0.0, 0.0])
        s[0] += len(b.text) - b.link
        s[1] += len(PUNCTUATION.findall(b.text)) * (1 - b.link / len(b.text))
        s[2] += 1
    part = [0.0 if b.bad else PENALTY if b.soft else 1.0 for b in found]
    text = smooth([w * sums[b.path][0] / sums[b.path][2] for w, b in zip(part, found)])
    marks = smooth([w * sums[b.path][1] / sums[b.path][2] for w, b in zip(part, found)])
    fused = [math.sqrt(t * (1 + p)) for t, p in zip(text, marks)]
    score: dict[int, list[float]] = {}
    for b, f in zip(found, fused):
        s = score.setdefault(b.path, [0.0, 0.0])
        s[0] += f
        s[1] += 1
    mean = {p: a / n for p, (a, n) in score.items()}
    worth = [w * mean[b.path] for w, b in zip(part, found)]
    good = [x for x, b in zip(worth, found) if not b.bad]
    if not good:
        return [False] * len(found)
    centre = sum(good) / len(good)
    spread = math.sqrt(sum((g - centre) ** 2 for g in good) / len(good))
    # The deviation as threshold, but never above a share of the best path,
    # which penalised paths have to reach.
    most = share * max(good)
    limit = min(spread, most)
    return [not b.bad and (b.main or x >= (most if b.soft else limit) and b.link < 0.5 * len(b.text))
            for x, b in zip(worth, found)]


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found = blocks(page)
    return "\n".join(b.text for b, keep in zip(found, select(found)) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in column(batch, "html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "page_id"), column(batch, "url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
