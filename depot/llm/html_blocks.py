"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags.  Pass 1 looks at each block
alone: what stands in page furniture (by element, role, class or id) or is
mostly links is boilerplate; what is long or has the stop-word density of
prose is content (where no block of a page without article or main has it,
as in other languages than those of the stop words, what is long); the rest is
ambiguous.  Pass 2 gives ambiguous blocks the
label of the nearest decided block of the same section (ties: content), or of
the section itself (inside article or main: content).
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depot.llm.common import map_arrow

#: Common function words; the density of these tells prose from labels.
STOP_WORDS = {
    "en": "the of and to in a is that for it as was with be by on not he his are this at from or have an they which you had we but were their one all has there been if more when will would who so no",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über so zum war haben nur oder aber",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec son cette ou comme mais on sa ses aux nous vous été leur",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta ser son dos también fue",
}
_STOP = frozenset(" ".join(STOP_WORDS.values()).split())

_RAW = "script|style|noscript|template|textarea|select|button|iframe|object|svg|math|title"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({_RAW})\b(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*+)>"
    r"|<[!?][^>]*+>"
    r"|</?[a-zA-Z!?][^>]*+\Z", re.S | re.I)
_ATTR = re.compile(r"[\s/]*+([^\s/=>]++|=[^\s/=>]*+)(?:\s*+=\s*+(\"[^\"]*+\"?|'[^']*+'?|[^\s>]++))?")     # one attribute, from where the last one ended

_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
                   "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
_FURNITURE = frozenset("nav footer aside form menu dialog fieldset head".split())
_ROOM = frozenset("article main".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_VOID = frozenset("hr".split())
# Names of page furniture in classes and ids.  A name counts as a whole: all its
# pieces must be such words or words of place, so that the state of a wrapper
# (has-sidebar, comments-open) or a name that merely begins so (search-result) does not.
_HINTS = frozenset(
    "ad ads advert adverts advertisement advertisements adsense sponsored sponsor sponsors promo promos promotion promotions cookie cookies "
    "consent gdpr notice notices popup popups modal modals newsletter newsletters subscribe signup login sidebar sidebars menu menus nav navbar "
    "navigation breadcrumb breadcrumbs masthead footer footers comment comments commentlist respond replies disqus related pagination pager".split())
#: Inside an article such a block keeps long prose without many links.
_WEAK = frozenset("alert alerts banner banners overlay search share sharing social toolbar widget widgets".split())
_PLACE = frozenset(
    "site page main top bottom left right upper lower area bar box block list item section container wrapper wrap inner outer primary secondary global "
    "post posts article articles entry stories user reader form link links button buttons icons media slot unit".split())
_PAGE_HEAD = frozenset("header topbar".split())
_PAGE_PLACE = frozenset("site page main top global".split())
_PIECES = re.compile(r"[-_]+")
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())

LONG, PROSE, LINKS = 70, 0.2, 0.5


def _attributes(attrs: str) -> Iterator[tuple[str, str]]:
    """Names (lower case) and values of a tag's attributes, the first of each name."""
    at, seen = 0, set()
    while m := _ATTR.match(attrs, at):
        at, name, value = m.end(), m[1].lower(), m[2] or ""
        if name not in seen:
            seen.add(name)
            yield name, html.unescape(value.strip(value[0]) if value[:1] in ("\"", "'") else value)


def _named(value: str, words: frozenset, places: frozenset) -> bool:
    """Is one of the names made of ``words`` (one at least) and ``places``?"""
    for name in value.lower().split():
        pieces = [p for p in _PIECES.split(name) if p and not p.isdigit()]
        if any(p in words for p in pieces) and all(p in words or p in places for p in pieces):
            return True
    return False


def _furniture(tag: str, attrs: str, in_room: bool) -> int:
    """0: no furniture; 1: only by a weak name inside an article; 2: furniture."""
    if tag in _ROOM or tag in ("html", "body"):
        return 0
    if tag in _FURNITURE or tag == "header" and not in_room:
        return 2
    weak = 0
    for name, value in _attributes(attrs) if attrs else ():
        if name in ("class", "id"):
            if _named(value, _HINTS, _PLACE | _WEAK) or not in_room and _named(value, _PAGE_HEAD, _PAGE_PLACE):
                return 2
            if _named(value, _WEAK, _PLACE):
                weak = 1 if in_room else 2
        if name == "role" and value.lower() in _ROLES or name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return 2
    return weak


class _Page:
    def __init__(self) -> None:
        self.blocks: list[tuple[str, int, int, int, bool]] = []    # text, characters in links, furniture, section, heading
        self.stack: list[tuple[str, int, int]] = []                # open block elements: tag, furniture, section
        self.parts: list[str] = []
        self.linked, self.in_link, self.rooms = 0, False, 0

    def text(self, raw: str) -> None:
        if raw:
            s = html.unescape(raw) if "&" in raw else raw
            self.parts.append(s)
            if self.in_link:
                self.linked += len("".join(s.split()))

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                tag, bad, room = self.stack[-1] if self.stack else ("", 0, 0)
                self.blocks.append((text, self.linked, bad, room, tag in _HEADING))
            self.parts.clear()
        self.linked = 0

    def open(self, tag: str, attrs: str) -> None:
        if tag in _BLOCK:
            self.flush()
            self.in_link = False
            while self.stack and (self.stack[-1][0] == "p" or self.stack[-1][0] in _HEADING or tag == "li" and self.stack[-1][0] == "li"):
                self.stack.pop()
            if tag in _VOID:
                return
            _, bad, room = self.stack[-1] if self.stack else ("", 0, 0)
            if tag in _ROOM and not (bad and any(t == tag for t, _, _ in self.stack)):
                self.rooms += 1
                bad, room = 0, self.rooms
            self.stack.append((tag, max(bad, _furniture(tag, attrs, room > 0)), room))
        elif tag == "a":
            self.in_link = True
        elif tag == "br":
            self.parts.append(" ")

    def close(self, tag: str) -> None:
        if tag in _BLOCK:
            self.flush()
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] == tag:
                    del self.stack[i:]
                    break
        elif tag == "a":
            self.in_link = False


def blocks(page: str) -> list[tuple[str, int, int, int, bool]]:
    p, at = _Page(), 0
    for m in _TOKEN.finditer(page):
        p.text(page[at:m.start()])
        at = m.end()
        tag = m[3] or m[6]
        if tag:
            tag = tag.lower()
            if m[2] or m[5]:
                p.close(tag)
            else:
                p.open(tag, m[4] or m[7] or "")
    p.text(page[at:])
    p.flush()
    return p.blocks


def _prose(text: str) -> float:
    words = text.lower().split()
    return sum(w.strip(".,;:!?()[]\"'#*$%&|<>") in _STOP for w in words) / len(words)


def main_text(page: str | None) -> str:
    """Content blocks of a page in order, joined by an empty line."""
    found = blocks(page or "")
    # long prose without many links in a weakly named block of an article is the article's
    found = [(text, linked, 0 if bad == 1 and len(text) >= LONG and linked <= LINKS * len(text) and _prose(text) >= PROSE else bad, room, heading)
             for text, linked, bad, room, heading in found]
    aside = [bad > 0 or linked > LINKS * len(text) and not heading for text, linked, bad, _, heading in found]
    long = [not out and len(b[0]) >= LONG for b, out in zip(found, aside)]
    prose = [own and (b[3] > 0 or _prose(b[0]) >= PROSE) for b, own in zip(found, long)]
    if not any(prose) and not any(b[3] for b in found):
        prose = long
    labels: list[bool | None] = [False if out else own if far else None for out, far, own in zip(aside, long, prose)]
    # pass 2: nearest decided block of the section, furniture aside
    final = list(labels)
    by_room: dict[int, list[int]] = {}
    for i, b in enumerate(found):
        if not b[2] and not (b[3] and labels[i] is False):      # a list of links in an article stands for itself
            by_room.setdefault(b[3], []).append(i)
    for room, at in by_room.items():
        left: list[tuple[int, bool] | None] = []
        last = None
        for k, i in enumerate(at):
            last = (k, labels[i]) if labels[i] is not None else last
            left.append(last)
        after = None
        for k in range(len(at) - 1, -1, -1):
            i = at[k]
            if labels[i] is not None:
                after = (k, labels[i])
                continue
            near = [(abs(k - x[0]), not x[1]) for x in (left[k], after) if x is not None]
            final[i] = not min(near)[1] if near else bool(room)
    return "\n\n".join(b[0] for b, keep in zip(found, final) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page.

    Null or empty html, or none but boilerplate: empty text.  The whole html
    is read, page by page, whatever its length; unclosed or cut-off tags end
    with the page; repeated rows and null ids are a row each; further columns
    are ignored; an empty table gives an empty result."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                s = b.slice(at, 256)
                texts = [main_text(h) for h in s.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([s.column("page_id").cast(pa.int64()), s.column("url"), pa.array(texts, pa.string()),
                                                  pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return map_arrow(pages.select("page_id", F.col("url").cast("string").alias("url"), "html"), run, "page_id long, url string, text string, n_chars long")
