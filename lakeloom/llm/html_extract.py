"""Main text of web pages by tag-path ratios.

A page is cut into block texts, each with its root-to-leaf path of tags.
Blocks in menus, headers and footers by tag, and hidden ones, are out. Names
of sidebars, adverts, forms, reader comments and the like (by tag, role, or
whole words of class or id) are votes: they put an element out unless it
holds the article or most of the page's text, or nothing would be left. Over
the rest, text length and punctuation are aggregated per path: a path's ratio
is the mean length of its blocks, fused with its mean punctuation and the
share of its text outside links (tag-path ratios, Wu et al. 2013). The article
and main elements are the content if they hold at least half of the text on
paths above a threshold; else the lowest element around all such paths is.
Of an article or main all blocks are the text, but for those on paths made of
links that no heading leads to. Elsewhere scores are smoothed along the
content, headings left aside; its blocks on paths above the threshold are the
text, a list or table as a whole if one of its blocks is, and its headings and
those that lead to it. So a short paragraph stays as its path is that of the
long ones. Comments and sidebars by name are out however long they are.
Elements are nodes with a parent, and a path is its last tag after the
parent's path, so a page takes time by its length, however deep it nests.

Edge cases: null, empty and text-free pages give an empty text; unclosed
comments, scripts and tags end with the page; mismatched end tags are
ignored; repeated rows are extracted each; null ids are kept; an empty table
gives an empty table; only the id, url and html columns are read, so other
columns may have any name.
"""

from __future__ import annotations

import html as entities
import math
import re
import string
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Share of the best score that a path needs.
LEAST = 0.05
#: Best score that counts there, about that of a plain paragraph: a far longer block does not outdo others.
PARAGRAPH = 1000.0
_KERNEL = [math.exp(-(d**2) / 2) for d in range(3)]

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe textarea title xmp svg annotation object select button".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_WHOLE = frozenset("ul ol dl table menu".split())
#: Text outside links beside comments or a sidebar, over theirs, below which these are taken for the content.
BESIDE = 0.05
#: Share of a path's text outside links below which it is made of links.
OWN = 0.3
_CONTAINERS = frozenset(["", *"html body div center article main section".split()])
_OUTSIDE = frozenset("head nav footer menu".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_VOTED = frozenset("aside form dialog fieldset".split())
#: Of the names below those that are no content however long they are.
_NEVER = re.compile(r"comments?|disqus|replies|respond|sidebar")
#: Whole words of a class or id that name what is no content: as its first word or its last.
_NAMES = re.compile(
    r"ads?|advert(?:s|isement|ising)?|sponsor(?:s|ed)?|cookies?|consent|gdpr|comments?|disqus|replies|respond|sidebar|menus?|nav|navbar|navigation|"
    r"breadcrumbs?|footer|masthead|siteheader|pageheader|topbar|share|sharing|social|newsletter|subscribe|signup|login|popup|toolbar|pagination|pager"
)
#: Words that content may have as well; they count where most of the text is in links.
_MAYBE = re.compile(r"promos?|banner|notices?|discuss(?:ion|ions)?|aside|related|recommend(?:ed|ations?)|modal|overlay|widgets?|tags|skip")
#: With such a word the element only has, or lacks, what is named.
_HAVING = frozenset("has have with without no not hide show layout page content contains".split())
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*+)>")
#: An opening tag ends the open elements named here, up to the nearest of the others.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
_PUNCTUATION = frozenset(string.punctuation) - frozenset("#$%&*+/<=>@\\^_`|~") | frozenset("…«»“”„¿¡。，、！？；：·")


@dataclass
class Block:
    """A text, the element that holds it, and the characters in links."""

    element: int
    text: str
    linked: int


@dataclass
class Page:
    """Elements by number (0 is the page, parents come before their children) and block texts in order.

    ``path`` numbers the root-to-leaf tag paths, ``inside`` tells elements
    of an article or main, ``vote`` is a name's vote to put an element out,
    ``whole`` is the outermost list or table around an element, or 0.
    """

    blocks: list[Block] = field(default_factory=list)
    tag: list[str] = field(default_factory=lambda: [""])
    parent: list[int] = field(default_factory=lambda: [0])
    path: list[int] = field(default_factory=lambda: [0])
    out: list[bool] = field(default_factory=lambda: [False])
    inside: list[bool] = field(default_factory=lambda: [False])
    vote: list[int] = field(default_factory=lambda: [0])
    whole: list[int] = field(default_factory=lambda: [0])

    def summed(self, values: dict[int, int]) -> list[int]:
        """Each element's values with those of all elements in it."""
        total = [values.get(e, 0) for e in range(len(self.tag))]
        for e in range(len(total) - 1, 0, -1):
            total[self.parent[e]] += total[e]
        return total

    def heading(self, block: Block) -> bool:
        return self.tag[block.element] in _HEADINGS


def _named(value: str) -> int:
    """2 if a class or id names what is no content, 3 if that holds for any length, 1 if it may."""
    vote = 0
    for token in value.lower().replace("side-bar", "sidebar").replace("pop-up", "popup").replace("top-bar", "topbar").split():
        if token in ("site-header", "page-header"):
            return max(vote, 2)
        words = [w for w in re.split(r"[-_]+|\d+", token) if w]
        if len(words) > 1 and not _HAVING.isdisjoint(words):
            continue
        for w in words[:1] + words[-1:]:
            vote = max(vote, 3 if _NEVER.fullmatch(w) else 2 if _NAMES.fullmatch(w) else 1 if _MAYBE.fullmatch(w) else 0)
    return vote


def _is_out(tag: str, attributes: str, inside: bool) -> tuple[bool, int]:
    """Whether an element is out by itself, and else its vote: 3 or 2, or 1 where links have to agree."""
    if tag in _OUTSIDE or tag == "header" and not inside:
        return True, 0
    if tag in ("html", "body", "main"):
        return False, 0
    vote = 2 if tag in _VOTED else 0
    for name, a, b, c in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), a or b or c
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True, 0
        if name == "role" and value.lower() in _ROLES:
            vote = max(vote, 2)
        elif name in ("class", "id"):
            vote = max(vote, _named(value))
    return False, vote


def _shown(page: Page) -> list[Block]:
    """Blocks that no element around them puts out.

    An element voted out stays if the article is in it. It also stays if it
    holds most of the article's text, or of the page's without an article;
    comments and sidebars only if there is next to no other text. All blocks
    stay if none would be left.
    """
    open_ = [b for b in page.blocks if not page.out[b.element]]
    if not any(page.vote):
        return open_
    length, links, article = Counter(), Counter(), Counter()
    for b in open_:
        length[b.element] += len(b.text)
        links[b.element] += min(b.linked, len(b.text))
        article[b.element] += page.inside[b.element]
    total, linked, holds = page.summed(length), page.summed(links), page.summed(article)
    plain = lambda e: total[e] - linked[e]
    away, top = [False] * len(page.tag), [0] * len(page.tag)  # top: the article around
    for e in range(1, len(away)):
        vote, up = page.vote[e], page.parent[e]
        top[e] = (top[up] or e) if page.inside[e] else 0
        around = holds[e] and not page.inside[e]  # the article is in it
        most = total[top[e]] if page.inside[e] else 0 if holds[0] else total[0]
        alone = not holds[0] and plain(0) - plain(e) < BESIDE * plain(e)  # without an article, next to nothing lies beside it
        own = vote and not around and (vote > 1 or 2 * linked[e] > total[e]) and (not alone if vote == 3 else not most or 2 * total[e] <= most)
        away[e] = bool(own) or away[page.parent[e]]
    return [b for b in open_ if not away[b.element]] or open_


def parse(html: str) -> Page:
    """The page's elements and block texts; white space is one space."""
    page = Page()
    paths: dict[tuple[int, str], int] = {}
    stack, opened = [0], Counter()
    buffer: list[str] = []
    pos, links, linked, loose, last = 0, 0, 0, False, html.rfind(">")
    low = None

    def take(text: str) -> None:
        nonlocal linked
        buffer.append(text)
        if links:
            linked += len(text)

    def flush() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(buffer)).split()) if buffer else ""
        if text:
            page.blocks.append(Block(stack[-1], text, linked))
        buffer.clear()
        linked = 0

    def close(tag: str) -> None:
        """Close the open elements up to the nearest of this tag, if any."""
        while opened[tag]:
            top = page.tag[stack.pop()]
            opened[top] -= 1
            if top == tag:
                break

    while True:
        lt = html.find("<", pos)
        if lt < 0 or lt > last:
            take(html[pos:])
            break
        if lt > pos:
            take(html[pos:lt])
        if html.startswith("<!--", lt):
            end = html.find("-->", lt + 4)
            if end < 0:
                break
            pos = end + 3
            continue
        if html[lt + 1 : lt + 2] in ("!", "?"):
            pos = html.find(">", lt) + 1
            continue
        m = None if loose else _TAG.match(html, lt)
        if m is None and (m := _LOOSE.match(html, lt)) is not None:
            loose = True  # an unclosed quote: from here on tags end at the next >
        if m is None:
            take("<")
            pos = lt + 1
            continue
        pos, tag = m.end(), m[2].lower()
        if m[1]:
            if tag in _BLOCK:
                flush()
                close(tag)
            elif tag == "a":
                links = max(0, links - 1)
            continue
        if tag in _RAW and not m[3].endswith("/"):
            if low is None:
                low = html.lower() if len(html.lower()) == len(html) else html
            end = low.find("</" + tag, pos)
            pos = len(html) if end < 0 else (html.find(">", end) + 1 or len(html))
            take(" ")
        elif tag == "br" or tag == "img":
            take(" ")
        elif tag == "a":
            links = 1
        elif tag in _BLOCK:
            flush()
            links = 0
            if tag == "hr":
                continue
            ends, stop = _ENDS.get(tag, ({"p"}, {"td", "th", "li", "div", "article", "section", "body", "blockquote"}))
            if any(opened[t] for t in ends):
                for k in range(len(stack) - 1, 0, -1):
                    if page.tag[stack[k]] in ends:
                        for e in stack[k:]:
                            opened[page.tag[e]] -= 1
                        del stack[k:]
                    elif page.tag[stack[k]] in stop:
                        break
            up = stack[-1]
            inside = page.inside[up] or tag in ("article", "main")
            out, vote = _is_out(tag, m[3], inside)
            stack.append(len(page.tag))
            opened[tag] += 1
            page.tag.append(tag)
            page.parent.append(up)
            page.path.append(paths.setdefault((page.path[up], tag), len(paths) + 1))
            page.out.append(out or page.out[up])
            page.inside.append(inside)
            page.vote.append(0 if page.out[-1] else vote)
            page.whole.append(page.whole[up] or (len(page.tag) - 1 if tag in _WHOLE else 0))
    flush()
    return page


def _scores(page: Page, kept: list[Block]) -> tuple[list[float], list[float]]:
    """Each block's path: its fused ratio of length, punctuation and text outside links, and the last by itself."""
    total: dict[int, list[float]] = defaultdict(lambda: [0, 0, 0, 0])
    for b in kept:
        t = total[page.path[b.element]]
        t[0] += 1
        t[1] += len(b.text)
        t[2] += sum(map(b.text.count, _PUNCTUATION)) if len(b.text) < 400 else sum(c in _PUNCTUATION for c in b.text)
        t[3] += min(b.linked, len(b.text))
    own = {p: 1 - a / c for p, (n, c, s, a) in total.items()}
    fused = {p: (c / n) * math.log1p(1 + s / n) * own[p] for p, (n, c, s, a) in total.items()}
    paths = [page.path[b.element] for b in kept]
    return [fused[p] for p in paths], [own[p] for p in paths]


def _smooth(x: list[float]) -> list[float]:
    out = []
    for i in range(len(x)):
        near = [(x[j], _KERNEL[abs(i - j)]) for j in range(max(0, i - 2), min(len(x), i + 3))]
        out.append(sum(v * w for v, w in near) / sum(w for _, w in near))
    return out


def _inside(page: Page, kept: list[Block], score: list[float]) -> tuple[list[int], bool]:
    """The blocks of the content, and whether it is named: the blocks of the article or main elements, or else of the lowest element around all paths over the threshold."""
    bound = LEAST * min(max(score), PARAGRAPH)
    body = [k for k, s in enumerate(score) if s >= bound]
    named = [k for k, b in enumerate(kept) if page.inside[b.element]]
    if 2 * sum(len(kept[k].text) for k in body if page.inside[kept[k].element]) >= sum(len(kept[k].text) for k in body):
        return named, True
    holds = page.summed(Counter(kept[k].element for k in body))
    content = kept[body[0]].element
    # The lowest around all; a lone long paragraph, list or table is no container.
    while holds[content] < len(body) or page.tag[content] not in _CONTAINERS:
        content = page.parent[content]
    within = [e == content for e in range(len(page.tag))]
    for e in range(content + 1, len(within)):
        within[e] = within[page.parent[e]]
    inside = [k for k, b in enumerate(kept) if within[b.element]]
    # Blocks that are all links and lie before or after everything else are the page's, not the content's.
    own = [i for i, k in enumerate(inside) if kept[k].linked < len(kept[k].text) or page.heading(kept[k])]
    own = own or range(len(inside))
    return inside[own[0] : own[-1] + 1], False


def _led(page: Page, kept: list[Block], inside: list[int], own: list[float]) -> list[int]:
    """An article's blocks: all but those on paths made of links that no heading leads to."""
    out, led = [], False
    for k in inside:
        plain = own[k] >= OWN
        if page.heading(kept[k]) or plain or led:
            out.append(k)
        led = page.heading(kept[k]) or led and not plain
    return out


def _chosen(page: Page, kept: list[Block], inside: list[int], score: list[float], own: list[float]) -> list[int]:
    """The blocks inside that belong to the text, where no element says so."""
    text = [k for k in inside if not page.heading(kept[k])]
    if not text:
        return inside
    # What lies beside content is likely content, but not where a path is made of links.
    smooth = [s * own[k] for k, s in zip(text, _smooth([score[k] for k in text]))]
    bound = LEAST * min(max(smooth), PARAGRAPH)
    over = [kept[k].element for k, s in zip(text, smooth) if s >= bound]
    paths, wholes = {page.path[e] for e in over}, {page.whole[e] for e in over} - {0}
    in_whole = lambda k: page.whole[kept[k].element] in wholes and own[k] >= OWN
    return [k for k in inside if page.path[kept[k].element] in paths or page.heading(kept[k]) or in_whole(k)]


def _title(page: Page, kept: list[Block], inside: list[int]) -> list[int]:
    """Headings just before the content, and the last h1 before it if it has none."""
    near = inside[0]
    while near and page.heading(kept[near - 1]):
        near -= 1
    title = list(range(near, inside[0]))
    h1 = lambda k: page.tag[kept[k].element] == "h1"
    if not any(map(h1, title + inside)):
        title = [k for k in range(near) if h1(k)][-1:] + title
    return title


def main_text(html: str | None) -> str:
    page = parse(html or "")
    kept = _shown(page)
    if not kept:
        return ""
    score, own = _scores(page, kept)
    if not any(score):
        score, own = [float(len(b.text)) for b in kept], [1.0] * len(kept)
    inside, named = _inside(page, kept, score)
    chosen = _led(page, kept, inside, own) if named else _chosen(page, kept, inside, score, own)
    return "\n".join(kept[k].text for k in _title(page, kept, inside) + chosen)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (id, url, text), one per row of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pa.array((main_text(x.as_py()) for x in b.column(2)), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), texts], ["id", "url", "text"])

    picked = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return picked.mapInArrow(run, T.StructType(picked.schema.fields[:2]).add("text", "string"))


def op5_tag_path_ratios(spark, sf_dir: str) -> DataFrame:
    found = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))
