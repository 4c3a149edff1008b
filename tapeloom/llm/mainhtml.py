"""Main text of web pages by tag-path ratios.

A page is read once into blocks: runs of text between the boundaries of
block-level elements, each with the path of such elements from the root down to
it, an element being its tag and its class and id names without digits. All
blocks of one path are judged together:

- ratios: code points, and punctuation marks, outside links for each block of the path;
- smoothing: a path's ratios are averaged with those of all that its parents
  hold (body and html aside), which weigh half as much with each step up, so
  that a short heading goes with the paragraphs beside it;
- fusing: the logarithms of both ratios are multiplied, and by a weight for what
  the names on the path say: an article counts fully, a main region beside
  articles half, anything else on a page with either a fifth, and menus,
  headers, footers, sidebars, notices, adverts, forms and comments nothing;
- threshold: paths that reach ``share`` of the page's best are content.

The text is the blocks of all these paths in page order. Nothing in a block is
dropped but markup, comments, and scripts and the like. Links count as text of
their block. A ``br`` is white space. Elements whose closing tags are left out
end where HTML says they do; a comment or script that never ends takes the rest
of the page, and so does a tag.

Every page is judged by itself, so one pass over the table without a shuffle is
all, whatever host it is from. Null and empty pages, and pages without content,
give an empty text. Rows with a null id and repeated rows are pages like any
other; only page_id, url and html are read.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from math import log1p

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_map

SHARE, LOWEST_HINT, MIDDLE_HINT = 0.25, 0.2, 0.5

_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"']+)))?""")
_MARKS = re.compile(r"[.,;:!?…。、，；：！？؟،]")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup html "
    "legend li main menu nav noscript ol option p pre search section select summary table tbody td template tfoot th thead tr ul".split()
)
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
SKIPPED = frozenset("audio canvas math object svg video".split())
#: An open element that these begin anew, and the elements that end the look for it.
ENDS = {"li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr", "table tbody thead tfoot"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select"),
        "tbody": ("tbody thead tfoot", "table"), "thead": ("tbody thead tfoot", "table"), "tfoot": ("tbody thead tfoot", "table")}
ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}
BESIDE_TAGS = frozenset("aside button dialog footer form head menu nav noscript option search select template".split())
BESIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
BESIDE = frozenset(
    "ad ads adsbygoogle adslot advert advertisement advertisements advertising adverts adv alert alerts banner billboard breadcrumb breadcrumbs colophon comment commentary commentlist comments consent cookie cookies copyright crumbs dfp disclaimer discussion disqus "
    "feedback footer gdpr guestbook hidden legal login masthead menu menubar menus modal nav navbar navigation navlinks newsletter notice notices notification outbrain overlay pager pagination popular popup promo promoted promotion promotions "
    "recommendations recommended related replies reply respond responses share sharebar sharing sidebar sidebars signin signup skip skiplink social sponsor sponsored sponsors subscribe subscription taboola tagcloud toolbar topbar trending widget widgets".split()
)
INSIDE = frozenset("article articlebody articlecontent entry post story".split())
REGION = frozenset("body content main maincontent prose text".split())
TALK = frozenset("comment comments commentlist discussion disqus feedback guestbook replies reply respond responses".split())
HEADERS = frozenset("header headers".split())
AROUND = frozenset("has no with without".split())


@lru_cache(100_000)
def _kind(tag: str, attributes: str) -> tuple[str, int]:
    """An element's label on the path, and what its names say: -1 beside the text, 0 nothing, 1 a main region, 2 an article, 3 a header."""
    found = {}
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), entities.unescape(a or b or c))
    names = f"{found.get('class', '')} {found.get('id', '')}".split()
    label = ".".join([tag, *sorted({re.sub(r"\d+", "", n.lower()) for n in names} - {""})])
    role, item = found.get("role", "").lower(), found.get("itemprop", "").lower()
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in found.get("style", "").lower().replace(" ", ""):
        return label, -1
    if tag in ("html", "body"):
        return label, 0
    if tag in BESIDE_TAGS or role in BESIDE_ROLES or item == "comment":
        return label, -1
    kind = 2 if tag == "article" or role == "article" or item == "articlebody" else 1 if tag == "main" or role == "main" else 3 if tag == "header" else 0
    for name in names:
        parts = [p.lower() for p in _WORDS.findall(name)]
        if not parts or AROUND & set(parts):
            continue
        inside = parts[-1] in INSIDE or parts[-1] in REGION
        if BESIDE & set(parts) and not (inside and not TALK & set(parts)):
            return label, -1
        if HEADERS & set(parts) and not (INSIDE | REGION) & set(parts):
            kind = kind or 3
        elif parts[-1] in INSIDE or "".join(parts) in INSIDE:
            kind = 2 if kind != 3 else kind
        elif parts[-1] in REGION or "".join(parts) in REGION:
            kind = kind or (2 if INSIDE & set(parts) else 1)
    return label, kind


class _Reader:
    """Blocks of one page: ``(path, text, code points in links)``; a path is a tuple of (label, kind)."""

    def __init__(self, page: str):
        self.blocks: list[tuple[tuple, str, str]] = []
        self.stack: list[tuple[str, tuple[str, int]]] = []
        self.text: list[str] = []
        self.plain: list[str] = []
        self.links, self.skipped = 0, 0
        self._read(page)
        self._end()

    def _end(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                self.blocks.append((tuple(e for _, e in self.stack), text, "".join(self.plain)))
            self.text, self.plain = [], []

    def _say(self, raw: str) -> None:
        if raw and not self.skipped:
            text = entities.unescape(raw) if "&" in raw else raw
            self.text.append(text)
            if not self.links:
                self.plain.append(text)

    def _pop_to(self, names: frozenset, until: frozenset = frozenset()) -> None:
        """Close the nearest open element of ``names`` and all in it, unless one of ``until`` is nearer."""
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] in names:
                del self.stack[k:]
                return
            if self.stack[k][0] in until:
                return

    def _read(self, page: str) -> None:
        at = 0
        while True:
            lt = page.find("<", at)
            if lt < 0:
                self._say(page[at:])
                return
            self._say(page[at:lt])
            if page.startswith("<!--", lt):
                end = page.find("-->", lt + 2)
                at = end + 3
                if end < 0:
                    return
            elif page[lt + 1 : lt + 2] in ("!", "?"):
                at = page.find(">", lt) + 1
                if not at:
                    return
            elif (m := _TAG.match(page, lt)) or (m := _LOOSE.match(page, lt)):
                at = m.end()
                if self._tag(bool(m[1]), m[2].lower(), m[3]):
                    close = re.compile(rf"</{re.escape(m[2])}(?=[\s/>])", re.I).search(page, at)
                    if not close:
                        return
                    at = page.find(">", close.end()) + 1
                    if not at:
                        return
            elif page[lt + 1 : lt + 2].isalpha() or (page[lt + 1 : lt + 2] == "/" and page[lt + 2 : lt + 3].isalpha()):
                return  # a tag that never ends
            else:
                self._say("<")
                at = lt + 1

    def _tag(self, closing: bool, name: str, attributes: str) -> bool:
        """Take note of a tag; whether what follows is raw up to its end."""
        if name == "br" or name == "hr":
            self._say(" ")
            if name == "hr":
                self._end()
        elif name == "a":
            self.links = 0 if closing else 1
        elif name in SKIPPED:
            self.skipped = max(0, self.skipped + (-1 if closing else 0 if attributes.endswith("/") else 1))
        elif name in RAW:
            return not closing
        elif name in BLOCKS:
            self._end()
            self.links = 0
            if closing:
                self._pop_to(frozenset((name,)))
                return False
            if name not in ("option", "html", "body", "head"):
                self._pop_to(frozenset(("p",)), frozenset(("td", "th", "button", "caption")))
            if name in ENDS:
                self._pop_to(*ENDS[name])
            if name == "body":
                self._pop_to(frozenset(("head",)))
            self.stack.append((name, _kind(name, attributes)))
        return False


def _hints(paths: dict[tuple, list[float]]) -> dict[tuple, float]:
    """The weight of every path by the names on it."""
    level = {}
    for path in paths:
        best = 0
        for label, kind in path:
            if kind == -1 or (kind == 3 and not best):  # a header outside the text
                best = -1
                break
            best = max(best, kind if kind < 3 else 0)
        level[path] = best
    said = lambda k: sum(paths[p][0] for p, v in level.items() if v >= k)
    article, region = said(2), said(1)
    top = 2 if article and 4 * article >= region else 1 if region else 0
    weight = {-1: 0.0, 0: LOWEST_HINT if top else 1.0, 1: 1.0 if top < 2 else MIDDLE_HINT, 2: 1.0}
    return {p: weight[v] for p, v in level.items()}


def content(page: str | None, share: float = SHARE) -> str:
    """The main text of one page."""
    blocks = _Reader(page or "").blocks
    own: dict[tuple, list[float]] = defaultdict(lambda: [0.0, 0.0, 0.0])
    for path, _, plain in blocks:
        s = own[path]
        s[0] += len(plain.strip())
        s[1] += len(_MARKS.findall(plain))
        s[2] += 1
    hints = _hints(own)
    below: dict[tuple, list[float]] = defaultdict(lambda: [0.0, 0.0, 0.0])
    for path, s in own.items():
        if hints[path]:
            for k in range(1, len(path) + 1):
                total = below[path[:k]]
                for i in range(3):
                    total[i] += s[i]
    score = {}
    for path, s in own.items():
        if not hints[path]:
            continue
        weight, length, marks, all_weights = 1.0, s[0] / s[2], s[1] / s[2], 1.0
        for k in range(len(path) - 1, 0, -1):
            if path[k - 1][0].split(".")[0] in ("html", "body"):
                break
            weight /= 2
            total = below[path[:k]]
            length, marks, all_weights = length + weight * total[0] / total[2], marks + weight * total[1] / total[2], all_weights + weight
        score[path] = hints[path] * log1p(length / all_weights) * (1 + log1p(marks / all_weights))
    least = share * max(score.values(), default=0.0)
    return "\n".join(text for path, text, _ in blocks if 0 < score.get(path, 0.0) >= least)


def extract(pages: DataFrame, share: float = SHARE) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages(page_id, url, html)``."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            texts = [content(h, share) for h in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kept = pages.select("page_id", "url", "html")
    schema = f"page_id {kept.schema['page_id'].dataType.simpleString()}, url {kept.schema['url'].dataType.simpleString()}, text string, n_chars long"
    return arrow_map(kept, run, schema)
