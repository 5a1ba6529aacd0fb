"""Main text of web pages by tag-path ratios.

A page becomes blocks of text, each under the path of block elements from the root to its
leaf.  The paths are a tree.  The method has four steps, all in time linear in the page:

1. Aggregate: for every path the characters (link text does not count) and the punctuation
   marks of its blocks are summed.
2. Smooth: a path p receives from every path q the share (common / length) ** 2 of q's sums,
   where length is q's and common the number of leading elements that p shares with q, both
   counted below the innermost element that holds all text.  So the paths of one container
   support each other, and a stray block beside the container gets next to nothing.
3. Fuse: both sums are divided by their largest, L and P; the ratio of a path is
   L * (1 + P) / 2, between 0 and 1.
4. Threshold: what elements say of themselves enters as one bounded factor, ``aside`` for
   paths through menus, notices, adverts, forms and the like, ``content`` for paths within
   article or main.  Paths with ratio * factor of at least ``threshold``, or of that share
   of the best where no path reaches 1, give the text, in page order.

The factor can neither choose nor reject a path alone: a page whose only long text lies in
an element named like an advert gives that text, and a path of next to no weight inside of
an article goes.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import plain, text_chunks

_MARKUP = re.compile(
    r"<!--(?:.*?-->|.*\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)(?:>|\Z)"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)|<\Z",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I
)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_PUNCTUATION = re.compile(r"[.,;:!?\u2026\u3002\uff0c\uff01\uff1f\u060c]")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
#: Elements whose text is no text of the page.
DROPPED = frozenset("head button select option datalist svg math object canvas audio video map dialog".split())
BLOCKS = frozenset(
    "html head body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr caption ul".split()
)
ENDS_P = BLOCKS - frozenset("html head body tbody td tfoot th thead tr caption".split())
#: A start tag of the key ends an open element of the value, up to an element of the scope.
ENDS = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr", "table"),
    "td": ("td th", "tr"), "th": ("td th", "tr"), "body": ("head", "html")
}
CONTENT = frozenset("article main".split())
ASIDE_TAGS = frozenset("nav footer aside form menu search fieldset".split())
ASIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split()
)
ASIDE_TOKENS = frozenset(
    "ad ads advert adverts advertisement adsense banner sponsor sponsored promo promotion nav navbar navigation menu footer sidebar breadcrumb breadcrumbs comment comments disqus respond replies share sharing social cookie cookies consent gdpr notice notices alert popup modal newsletter subscribe subscription related recommended recommendations widget pagination pager login signup toolbar skip".split()
)
HEADER_TOKENS = frozenset("header masthead topbar".split())


@dataclass(frozen=True)
class Settings:
    """``aside`` and ``content`` are the factors of step 4; both 1 leave the choice to the ratios alone."""

    aside: float = 1 / 32
    content: float = 8.0
    threshold: float = 0.125


@dataclass
class Path:
    """A node of the tree of paths, with the sums of its own blocks."""

    parent: int
    label: str
    depth: int
    aside: bool
    content: bool
    chars: int = 0
    punctuation: int = 0
    blocks: int = 0


@dataclass
class _Element:
    name: str
    path: int


class _Page:
    """The blocks of a page and its tree of paths, parents before children."""

    def __init__(self) -> None:
        self.paths = [Path(-1, "", 0, False, False)]
        self.blocks: list[tuple[int, str]] = []
        self._known: dict[tuple[int, str], int] = {}
        self._stack: list[_Element] = []
        self._open: Counter[str] = Counter()
        self._dropped = 0
        self._parts: list[str] = []
        self._linked = 0

    def _top(self) -> int:
        return self._stack[-1].path if self._stack else 0

    def _push(self, name: str, attributes: str) -> None:
        at = self._top()
        if name in BLOCKS:
            label, aside, content = _described(name, attributes, self.paths[at].content)
            if (at, label) not in self._known:
                up = self.paths[at]
                self._known[at, label] = len(self.paths)
                self.paths.append(Path(at, label, up.depth + 1, up.aside or aside, up.content or content))
            at = self._known[at, label]
        self._stack.append(_Element(name, at))
        self._open[name] += 1
        self._dropped += name in DROPPED

    def _remove(self, first: int, last: int) -> None:
        for e in self._stack[first:last]:
            self._open[e.name] -= 1
            self._dropped -= e.name in DROPPED
        del self._stack[first:last]

    def flush(self) -> None:
        """End the running block."""
        text = " ".join("".join(self._parts).split())
        linked, self._parts, self._linked = self._linked, [], 0
        if text:
            path = self.paths[self._top()]
            path.blocks += 1
            path.chars += max(0, len(text) - linked)
            path.punctuation += len(_PUNCTUATION.findall(text))
            self.blocks.append((self._top(), text))

    def text(self, raw: str) -> None:
        if raw and not self._dropped:
            said = html.unescape(raw)
            self._parts.append(said)
            if self._open["a"]:
                self._linked += len(said.strip())

    def _end_open(self, names: str, scope: str) -> None:
        """End the innermost open element among ``names`` unless one of ``scope`` stands inside of it."""
        if not any(self._open[n] for n in names.split()):
            return
        for i in range(len(self._stack) - 1, -1, -1):
            if self._stack[i].name in names.split():
                self.flush()
                self._remove(i, len(self._stack))
                return
            if self._stack[i].name in scope.split():
                return

    def start(self, name: str, attributes: str) -> None:
        if name == "br":
            self._parts.append(" ")
            return
        if name in BLOCKS:
            self.flush()
        if name in ENDS_P:
            self._end_open("p", "table td th button")
        if name in ENDS:
            self._end_open(*ENDS[name])
        if name not in VOID:
            self._push(name, attributes)

    def end(self, name: str) -> None:
        if name in BLOCKS:
            self.flush()
        if not self._open[name]:
            return
        for i in range(len(self._stack) - 1, -1, -1):
            if self._stack[i].name == name:
                # an inline element may end inside of a later block, which stays open
                self._remove(i, len(self._stack) if name in BLOCKS else i + 1)
                return
            if name not in BLOCKS and self._stack[i].name in ("td", "th", "table"):
                return


def _described(name: str, attributes: str, inside: bool) -> tuple[str, bool, bool]:
    """Label of an element in paths, and whether it calls itself an aside or content; ``inside`` of content, headers are content."""
    classes, tokens, aside = set(), set(), name in ASIDE_TAGS or (name == "header" and not inside)
    if attributes.strip("/ \t\n\r\f"):
        for key, *values in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), "".join(values)
            if key in ("class", "id"):
                found = {t.lower() for t in _TOKEN.findall(value)}
                tokens |= found
                classes |= found if key == "class" else set()
            elif key == "role":
                aside |= value.lower() in ASIDE_ROLES
            elif key == "style":
                aside |= "display:none" in value.replace(" ", "").lower()
            else:
                aside |= value.lower() != "false"
    if name not in ("html", "body") and name not in CONTENT:
        aside |= bool(tokens & ASIDE_TOKENS) or (not inside and bool(tokens & HEADER_TOKENS))
    # the factor belongs to the path, so an aside is a path of its own
    return ".".join([name, *sorted(classes), *["aside"] * aside]), aside, name in CONTENT


def parsed(source: str) -> _Page:
    """Blocks and paths of a page."""
    page, at = _Page(), 0
    while True:
        m = _MARKUP.search(source, at)
        if m is None:
            page.text(source[at:])
            page.flush()
            return page
        page.text(source[at : m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if m["end"]:
            page.end(name)
        elif name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(source, at)
            at = close.end() if close else len(source)
        else:
            page.start(name, m["attributes"] or "")


def smoothed(paths: list[Path], sums: list[int]) -> list[float]:
    """Step 2 for the sums of one kind, one for each path.

    With length of a path q in the denominator taken out first, the sum over all q of
    (common / length) ** 2 goes up the tree once and down once: an element at depth d adds
    d ** 2 - (d - 1) ** 2 times what lies under it.
    """
    held = [p.blocks for p in paths]
    for i in range(len(paths) - 1, 0, -1):
        held[paths[i].parent] += held[i]
    base = max((p.depth for i, p in enumerate(paths) if held[i] == held[0]), default=0)
    depth = [max(0, p.depth - base) for p in paths]
    under = [s / d**2 if d else 0.0 for s, d in zip(sums, depth)]
    for i in range(len(paths) - 1, 0, -1):
        under[paths[i].parent] += under[i]
    out = [0.0] * len(paths)
    for i, p in enumerate(paths):
        if depth[i]:
            out[i] = out[p.parent] + (2 * depth[i] - 1) * under[i]
    # of all paths only those at the common element itself share nothing but themselves
    return [float(s) if d == 0 else x for s, d, x in zip(sums, depth, out)]


def chosen(paths: list[Path], settings: Settings = Settings()) -> set[int]:
    """The paths that give the text: steps 2 to 4."""
    own = [i for i, p in enumerate(paths) if p.blocks]
    length = smoothed(paths, [p.chars for p in paths])
    marks = smoothed(paths, [p.punctuation for p in paths])
    longest, most = (max((x[i] for i in own), default=0.0) for x in (length, marks))
    score = {}
    for i in own:
        ratio = length[i] / longest * (1 + (marks[i] / most if most else 1)) / 2 if longest else 0.0
        score[i] = ratio * (settings.aside if paths[i].aside else 1) * (settings.content if paths[i].content else 1)
    least = settings.threshold * min(1.0, max(score.values(), default=0.0))
    return {i for i, s in score.items() if s > 0 and s >= least}


def main_text(source: str | None, settings: Settings = Settings()) -> str:
    """The main text of a page, a line for each block; empty if there is none."""
    page = parsed(source or "")
    kept = chosen(page.paths, settings)
    return "\n".join(text for path, text in page.blocks if path in kept)


def extract(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html", settings: Settings = Settings()
) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row.

    Null html and pages without text give an empty text.  Rows stay rows: repeated and null
    page_ids are kept apart, an empty table gives an empty result, and other columns of the
    input, whatever their names, take no part.  Time and memory of a page grow with its
    length alone, however deep its elements are nested.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, sources in text_chunks(batch, "html"):
                texts = [main_text(s, settings) for s in sources]
                lengths = pa.array(map(len, texts), pa.int64())
                columns = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), lengths]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = plain(pages, page_id=F.col(page_id).cast("bigint"), url=F.col(url).cast("string"), html=F.col(source))
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
