"""Main text of HTML pages by text-to-tag ratios.

The events of the standard library's streaming parser cut a page into lines,
one per block of text, each with the number of tags met since the line before
and the containers around it. Elements that never hold article text (menus,
page headers and footers, sidebars, notices, adverts, forms, reader comments,
scripts, styles) are left out on the way. The text-to-tag ratios of the other
lines are smoothed by a Gaussian and clustered by a threshold, their standard
deviation. The content region is all the outermost articles with lines above it (or
``main`` elements) if they hold nearly all text of these lines, and otherwise the
innermost container that holds all of it; every line of the region is kept, short
ones too, but for lists of links before and behind the text whose ratios are below the
threshold, where no ``article`` or ``main`` bounds it. A form, dialog or an element with
the name of a menu or notice may also be a wrapper of the page: on a page without an
article beside it, it stays if it holds most of the text of the lines above the threshold.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from acctflow.llm.common import with_columns_of_text

# Fixed by the HTML standard: elements without an end tag, elements that end a
# line of text, and elements whose content is no article text.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table "
    "tbody td tfoot th thead title tr ul".split()
)
CONTAINERS = frozenset("article aside body div html main section table tbody td tr blockquote".split())
# Containers that are parts of an article, never all of it.
PARTS = frozenset("table tbody td tr blockquote".split())
NEARLY_ALL = 0.9
SKIPPED = frozenset(
    "annotation annotation-xml aside audio button canvas datalist footer head iframe input menu nav object option script "
    "select style svg template textarea title video".split()
)
# Left out too, unless they hold the page's text; a form may also be around its article.
HELD = frozenset("dialog form noscript".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words of class, id and role values that name the parts left out.
NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|"
    r"newsletter|subscribe|sidebar|side|aside|complementary|widget|nav|navbar|navigation|menu|breadcrumbs?|toc|footer|foot|"
    r"contentinfo|masthead|header|topbar|toolbar|comments?|commentlist|disqus|replies|respond|discussion|share|sharing|social|"
    r"related|recommend\w*|pagination|pager|login|signup|search|form|copyright|hidden)(?=$|[\s_-])",
    re.I,
)
# Inside an article a heading or a section may be about most of these.
NAMED_INSIDE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|comments?|cookies?[_-]\w+|promo\w*)(?=$|[\s_-])", re.I
)
# Reader comments are articles at times, or hold some.
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|replies|respond)(?=$|[\s_-])", re.I)
COMMENT = re.compile(r"(?<!\S)(?:div-)?(?:comments?|reply|replies)(?:-(?:body|item|content|\d+))?(?!\S)", re.I)
# Names that say what a page has or lacks, not what an element is.
STATE = re.compile(r"(?<!\S)(?:(?:has|no|with|without)[_-]\S+|\S+[_-](?:open|closed))(?!\S)", re.I)
# Heads of an article, not of a page.
ARTICLE_HEAD = re.compile(r"(?<!\S)(?:article|entry|post|story)[_-]+(?:head|header)(?!\S)", re.I)
RIGHTS = re.compile(r"(?:©|\(c\)|copyright\b).*\d{4}", re.I)
NEVER_NAMED = frozenset("html body main".split())
SPACE = re.compile(r"\s+")


class Lines(HTMLParser):
    """Lines of a page: (text, tags before it, innermost container, all of it a link's and no heading).

    An element left out for its name may turn out to be a wrapper of the article,
    so its text is held back until the page's end: ``finish`` notes blocks, ``close``
    makes lines of those that stay."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool]] = []
        self.containers: list[tuple[int, str]] = [(-1, "")]  # (parent, tag)
        # (parent, holds comments, may hold the page's text) of each element left out for its name; 0 is none.
        self._named: list[tuple[int, bool, bool]] = [(0, False, True)]
        self._dialogs: set[int] = set()  # of these, the dialogs and noscripts
        self._wraps: list[int] = [0]  # of each: 1 if an article is in it, 2 if a page's body or main is
        # Parts (text, named element, in a link), tags before, container, inside an article or main, in a heading.
        self._blocks: list[tuple[list[tuple[str, int, bool]], int, int, bool, bool]] = []
        # Tag, named element it is left out with (-1: left out for its tag), container, inside main (1) or an article (2).
        self._open: list[tuple[str, int, int, int]] = [("", 0, 0, 0)]
        self._count: Counter = Counter()  # open elements per tag
        self._parts: list[tuple[str, int, bool]] = []
        self._tags = 0
        self._endless = False

    def read(self, html: str) -> None:
        """A whole page. What stands behind its last ``>`` holds no whole tag and
        is text, so the parser needn't look for the end of each ``<`` in it."""
        cut = html.rfind(">") + 1
        self.feed(html[:cut])
        if self.rawdata or self.cdata_elem:
            self.feed(html[cut:])
        else:
            self.handle_data(unescape(html[cut:]))
        self.close()
        self.finish()
        self._make_lines()

    def _make_lines(self) -> None:
        stays = [True]  # of each named element
        for (parent, comments, _), wraps in zip(self._named[1:], self._wraps[1:]):
            stays.append(stays[parent] and wraps > comments)
        beside = (parts for parts, _, _, inside, _ in self._blocks if inside)
        if not all(stays) and not any(stays[k] and not data.isspace() for parts in beside for data, k, _ in parts):
            mass = self._held_content()
            for k, (parent, _, page) in enumerate(self._named[1:], 1):
                stays[k] = stays[parent] and (self._wraps[k] > self._named[k][1] or page and 2 * mass[k] > mass[0])
        tags = 0
        for parts, n, container, _, heading in self._blocks:
            tags += n
            kept = [(data, linked) for data, named, linked in parts if stays[named]]
            text = SPACE.sub(" ", "".join([data for data, _ in kept])).strip()
            if text:
                link = not heading and all(linked or data.isspace() for data, linked in kept)
                self.lines.append((text, tags, container, link))
                tags = 0

    def _held_content(self) -> list[int]:
        """Characters of content lines in each element left out for its name; 0 is the page."""
        sizes = [[len(SPACE.sub(" ", data).strip()) for data, _, _ in block[0]] for block in self._blocks]
        content, _ = clustered([sum(n) for n in sizes], [block[1] for block in self._blocks])
        mass = [0] * len(self._named)
        for (parts, *_), lengths, chosen in zip(self._blocks, sizes, content):
            for (_, named, _), n in zip(parts, lengths):
                mass[named] += n * bool(chosen)
        for k in range(len(mass) - 1, 0, -1):
            mass[self._named[k][0]] += mass[k]
        return mass

    def parse_comment(self, i, report=True):
        # Behind a comment without an end there is none with one.
        end = -1 if self._endless else super().parse_comment(i, report)
        self._endless = end < 0
        return end

    def finish(self) -> None:
        """The text so far is a block, if there is any."""
        if self._parts:
            top = self._open[-1]
            heading = any(self._count[h] for h in HEADINGS)
            self._blocks.append((self._parts, self._tags, top[2], top[3] > 0, heading))
            self._parts, self._tags = [], 0

    def _left_out(self, tag: str, attrs, out: int, inside: int) -> int:
        """The named element that an element is left out with, 0 if it stays,
        -1 if its tag or an outer one's says so."""
        if out < 0 or tag in SKIPPED or tag == "header" and not inside:
            return -1
        if tag in NEVER_NAMED:
            return out
        if tag in HELD:
            k = self._held(out, False, True)
            if tag != "form":
                self._dialogs.add(k)
            return k
        named = " ".join(v for k, v in attrs if v and k in ("class", "id", "role"))
        named = ARTICLE_HEAD.sub("", STATE.sub("", named))
        if tag == "article":
            return -1 if COMMENT.search(named) else out
        short = inside == 2 or tag in HEADINGS or inside and tag in ("header", "p", "span")
        if not (NAMED_INSIDE if short else NAMED).search(named):
            return out
        comments = COMMENTS.search(named) is not None
        return self._held(out, comments, not comments and not NAMED_INSIDE.search(named))

    def _held(self, out: int, comments: bool, page: bool) -> int:
        self._named.append((out, comments, page))
        self._wraps.append(0)
        return len(self._named) - 1

    def _wrapped(self, named: int, by: int) -> None:
        """The named elements around an article (or a body or main) stay, but not
        dialogs and what stands around them."""
        while named > 0 and self._wraps[named] < by and named not in self._dialogs:
            self._wraps[named] = by
            named = self._named[named][0]

    def handle_starttag(self, tag, attrs):
        self._tags += 1
        if tag == "br":
            self._parts.append(("\n", 0, False))
            return
        if tag in BLOCKS:
            self.finish()
            if tag not in ("article", "main"):
                self._close("p", ("div", "article", "section", "td", "body", "li", "main", "blockquote"))
        if tag in VOID:
            return
        if tag == "body":
            self._close("head", ())
        elif tag in ("article", "main"):
            self._close("nav", ("article", "main"))
        elif tag in ("li", "option", "tr", "td", "th", "dd", "dt"):
            self._close(tag, ("ul", "ol", "select", "table", "dl", "div", "article"))
        _, out, container, inside = self._open[-1]
        out = self._left_out(tag, attrs, out, inside)
        if tag == "article" or tag in NEVER_NAMED:
            self._wrapped(out, 1 if tag == "article" else 2)
        if tag in CONTAINERS:
            self.containers.append((container, tag))
            container = len(self.containers) - 1
        self._open.append((tag, out, container, max(inside, 2 if tag == "article" else tag == "main")))
        self._count[tag] += 1

    def handle_startendtag(self, tag, attrs):
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        else:
            self.handle_starttag(tag, attrs)
            self.handle_endtag(tag)

    def _close(self, tag: str, within: tuple[str, ...]) -> None:
        """End the innermost open ``tag``, unless one of ``within`` is nearer."""
        if not self._count[tag]:
            return
        for k in range(len(self._open) - 1, 0, -1):
            if self._open[k][0] == tag:
                if any(t in BLOCKS for t, *_ in self._open[k:]):
                    self.finish()  # the end of an inline element goes on in its line
                self._count.subtract(t for t, *_ in self._open[k:])
                del self._open[k:]
                return
            if self._open[k][0] in within:
                return

    def handle_endtag(self, tag):
        self._tags += 1
        if tag in BLOCKS:
            self.finish()
        if tag not in VOID:
            inline = tag not in BLOCKS and tag not in SKIPPED
            self._close(tag, tuple(BLOCKS) if inline else ())

    def handle_data(self, data):
        if self._open[-1][1] >= 0:
            self._parts.append((data, self._open[-1][1], self._count["a"] > 0))


def smoothed(ratios: np.ndarray, radius: int = 2, sigma: float = 1.0) -> np.ndarray:
    """Gaussian smoothing; at the ends the weights inside are scaled to one."""
    kernel = np.array([math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-radius, radius + 1)])
    weight = np.convolve(np.ones(len(ratios)), kernel, "full")[radius : radius + len(ratios)]
    return np.convolve(ratios, kernel, "full")[radius : radius + len(ratios)] / weight


def clustered(sizes: list[int], tags: list[int]) -> tuple[np.ndarray, float]:
    """Which lines are content by their smoothed text-to-tag ratios, and the threshold."""
    ratios = smoothed(np.array(sizes, dtype=float) / np.maximum(1, np.array(tags)))
    limit = float(ratios.std())
    return ratios >= limit, limit


def without_link_lists(lines: list[tuple[str, int, int, bool]], content: np.ndarray, limit: float) -> list[bool]:
    """False for the lines of link lists (two links or more in a row) and rights notes,
    of a ratio below ``limit``, that stand before or behind the other content lines."""
    low = [len(text) < limit * max(1, n) for text, n, *_ in lines]
    links = [line[3] and thin for line, thin in zip(lines, low)]
    rights = [thin and RIGHTS.match(line[0]) is not None for line, thin in zip(lines, low)]
    text = [k for k in range(len(lines)) if content[k] and not links[k] and not rights[k]]
    if not text:
        return [True] * len(lines)
    out = []
    for k in range(len(lines)):
        listed = links[k] and (k > 0 and links[k - 1] or k + 1 < len(lines) and links[k + 1])
        out.append(text[0] < k < text[-1] or not (listed or rights[k]))
    return out


def main_text(html: str) -> str:
    """The article's blocks, joined by an empty line."""
    page = Lines()
    page.read(html)
    lines, containers = page.lines, page.containers
    if not lines:
        return ""
    content, limit = clustered([len(t) for t, *_ in lines], [n for _, n, *_ in lines])
    mass = [0] * len(containers)
    for (text, _, c, _), chosen in zip(lines, content):
        mass[c] += len(text) * bool(chosen)
    for c in range(len(containers) - 1, 0, -1):  # a container's parent has a smaller number
        mass[containers[c][0]] += mass[c]
    total = mass[0]
    wide: set[int] = set()
    stays = [True] * len(lines)
    for tag in ("article", "main"):
        inner = [False] * len(containers)
        for k, (parent, _) in enumerate(containers):
            inner[k] = k > 0 and (inner[parent] or containers[parent][1] == tag)
        found = [k for k, (_, t) in enumerate(containers) if t == tag and not inner[k] and mass[k]]
        if sum(mass[k] for k in found) >= NEARLY_ALL * total:
            wide.update(found)
            break
    else:
        stays = without_link_lists(lines, content, limit)
        # The innermost container with all of the content; later ones are deeper.
        wide.add(max(k for k in range(len(mass)) if mass[k] == total and containers[k][1] not in PARTS))
    within = [k in wide for k in range(len(containers))]
    for k, (parent, _) in enumerate(containers):
        within[k] = within[k] or k > 0 and within[parent]
    kept = [line[0] for line, stay in zip(lines, stays) if stay and within[line[2]]]
    return "\n\n".join(kept)


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns in ``keep``, ``text`` (the main text, empty if there is none)
    and ``n_chars``, its code points.

    No shuffle; a null page counts as empty; broken markup is read as far as
    the parser gets; repeated rows give repeated results.
    """

    def arrays(htmls: list[str]) -> list[pa.Array]:
        found = list(map(main_text, htmls))
        return [pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())]

    return with_columns_of_text(pages, html_col, keep, "text string, n_chars long", lambda: arrays)
