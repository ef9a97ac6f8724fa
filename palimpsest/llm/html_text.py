"""Main text of HTML pages by composite text density.

Every block element of a page is a node. Its density is its characters per tag, adjusted by
the share of its characters and tags that are links against the whole body's share; its
score is the sum of its children's densities. The node with the largest score is the core
of the article. The smallest density on the path from it to the body is the threshold that
a further part (an element outside the core) must reach, along with a quarter of the core's
score. Where the core lies in an ``article`` or ``main`` element, that whole element counts.
Elements that are never article text by their tag, role, class or id (menus, headers,
footers, sidebars, notices, adverts, forms, reader comments, scripts, styles) are left out
before densities are computed. A word counts where it is a whole class or id or the last part
of one (digits after it aside) without a modifier (``no-sidebar``, ``has-comments``); an
element with such a word, and a form, dialog or object, that holds most of the body's unlinked
characters is left to the density, unless there is text in an ``article`` or ``main`` element
outside it. Labels, buttons and fields of a form are never text.

The text: character references decoded, white space inside a block turned into one space,
blocks trimmed and joined by one space in page order. Defined results: null or empty html
and pages without text give an empty text; unclosed, misnested and cut-off markup is read
as browsers do in the main; markup is never text. Repeated rows are returned each."""

from __future__ import annotations

import html as htmllib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import plain_columns, steps

# Names of HTML elements, and words of role, class and id that tell what is not the article.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea xmp iframe noembed noframes".split())
BLOCK = set("""address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section summary table tbody td
tfoot th thead tr ul video""".split())
NOT_TEXT = set("""script style title textarea xmp iframe noembed noframes noscript template head nav header footer aside
menu select button svg canvas audio video datalist label legend""".split())
NOT_TEXT_UNLESS_MOST = set("form dialog object".split())
NOT_TEXT_WORDS = set("""nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside ad ads advert
adverts advertisement advertising banner promo promotion promoted sponsor sponsored notice notices cookie cookies consent gdpr
popup modal overlay newsletter subscribe subscription signup login comment comments commentlist disqus reply replies respond
share sharing social related recommended pagination pager widget toolbar search form""".split())
NOT_ARTICLE_WORDS = {"comment", "comments", "ad", "ads", "advert"}
MODIFIERS = set("no not non has have with without hide hides".split())
NOT_TEXT_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
KEEP_WHOLE = {"article", "main", "body", "html"}
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
             "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tbody", "thead", "tr", "td", "th"}}
SCOPE = set("article aside blockquote body button details dialog div dl fieldset figure footer form header html li main nav ol section table td th ul".split())

_TAG = re.compile(
    r"""<(?:!--(?:>|->|.*?(?:--!?>|\Z))|(?P<close>/)?(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|/?[a-zA-Z][^>]*+(?:>|\Z)|[!?][^>]*+(?:>|\Z)|/[^>]*+(?:>|\Z))""", re.S)
_MARKS = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s"'/]|$)""", re.I)
_WORDS = re.compile(r"[^a-z0-9]+")


def _told(value: str, words: set[str]) -> bool:
    """Whether a class or id tells of ``words``: as a whole token or its last part, without a modifier."""
    for token in value.split():
        if token in words:
            return True
        parts = [x for x in _WORDS.split(token) if x]
        while parts and parts[-1].isdigit():
            parts.pop()
        if parts and parts[-1] in words and MODIFIERS.isdisjoint(parts[:-1]):
            return True
    return False


def _left_out(name: str, attrs: str) -> int:
    """0: no; 1: by a word of its class or id, or a tag that may hold the whole page; 2: by
    another tag, its role, or hidden."""
    if name in NOT_TEXT:
        return 2
    left = int(name in NOT_TEXT_UNLESS_MOST)
    if not attrs or name in ("body", "html"):
        return left
    for key, value in _MARKS.findall(attrs):
        key, value = key.lower(), value.strip("\"' ").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return 2
        if key == "role" and value in NOT_TEXT_ROLES:
            return 2
        if key in ("class", "id") and name not in ("article", "main"):
            left = left or int(_told(value, NOT_TEXT_WORDS))
        elif key == "class":
            left = left or int(_told(value, NOT_ARTICLE_WORDS))
    return left


class _Page:
    """Block elements in page order: tag, parent, and characters, link characters, tags and
    link tags of the whole subtree; ``blocks``: (element, text)."""

    def __init__(self, source: str):
        most = self._read(source, set())
        if most:
            self._read(source, most)
        for i in range(len(self.tag) - 1, 0, -1):
            up = self.parent[i]
            self.chars[up] += self.chars[i]
            self.links[up] += self.links[i]
            self.tags[up] += self.tags[i] + 1
            self.link_tags[up] += self.link_tags[i]

    def _read(self, source: str, spared: set[int]) -> set[int]:
        """Read the page; returns where elements start that a word leaves out although they
        hold most of the unlinked characters, and no article or main element outside them has
        text (those of ``spared`` are not left out)."""
        self.tag, self.parent = ["body"], [-1]
        self.chars, self.links, self.tags, self.link_tags = [0], [0], [0], [0]
        self.blocks: list[tuple[int, str]] = []
        open_: list[tuple[str, int, int, int | None]] = []  # name, block element, inside what is left out, number in ``worded``
        where: dict[str, list[int]] = {}  # places of each name in ``open_``: no tag has to walk over the others
        blocks_at: list[int] = []  # places of block elements in ``open_``
        worded: list[list[int]] = []  # start of an element left out by a word, unlinked characters before and up to its end, element around it
        held: list[str] = []
        node, out, links, free = 0, 0, 0, 0

        def flush():
            if held:
                text = " ".join("".join(held).split())
                held.clear()
                if text:
                    self.blocks.append((node, text))
                    self.chars[node] += len(text)

        def shut(to: int):
            nonlocal node, out, links
            while len(open_) > to:
                name, _, _, number = open_.pop()
                where[name].pop()
                if number is not None:
                    worded[number][2] = free
                if name == "a":
                    links -= 1
                if name in BLOCK:
                    blocks_at.pop()
                    flush()
                _, node, out, _ = open_[-1] if open_ else ("", 0, 0, None)

        def last(names) -> int:
            return max((where[x][-1] for x in names if where.get(x)), default=-1)

        at, end = 0, len(source)
        while at < end:
            m = _TAG.search(source, at)
            text = source[at:m.start() if m else end]
            if text and out < 2:
                text = htmllib.unescape(text) if "&" in text else text
                if not links:
                    free += len(text.strip())
                if not out:
                    held.append(text)
                    if links:
                        self.links[node] += len(text.strip())
            if not m:
                break
            at = m.end()
            name = m.group("name")
            if not name:
                continue
            name = name.lower()
            if m.group("close"):
                k = last([name])
                if k >= 0 and (name in BLOCK or not blocks_at or blocks_at[-1] < k):
                    shut(k)
                elif name in BLOCK:
                    flush()
                continue
            closes = CLOSED_BY.get(name) or ({"p"} if name in BLOCK and name != "br" else None)
            if closes:
                k = last(closes)
                if k >= 0 and k > last(SCOPE - closes):
                    shut(k)
            own = 0 if out == 2 else _left_out(name, m.group("attrs"))
            left = max(out, 0 if own == 1 and m.start() in spared else own)
            if name in BLOCK:
                flush()
            if name in RAW:
                stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*+>?", re.I).search(source, at)
                at = stop.end() if stop else end
                continue
            if name in VOID or m.group("attrs").endswith("/") and name not in BLOCK:
                if not left:
                    self.tags[node] += 1
                continue
            if name in BLOCK and not left:
                self.tag.append(name)
                self.parent.append(node)
                for column in (self.chars, self.links, self.tags, self.link_tags):
                    column.append(0)
                node = len(self.tag) - 1
            elif not left:
                self.tags[node] += 1
                if name == "a":
                    self.link_tags[node] += 1
            if name == "a":
                links += 1
            out = left
            where.setdefault(name, []).append(len(open_))
            if name in BLOCK:
                blocks_at.append(len(open_))
            open_.append((name, node, out, len(worded) if own == 1 else None))
            if own == 1:
                worded.append([m.start(), free, -1, node])
        flush()
        most = [(start, at) for start, before, upto, at in worded if 2 * ((free if upto < 0 else upto) - before) > free]
        if not most:
            return set()
        home = [0] * len(self.tag)  # the outermost article or main element around each
        for i in range(1, len(home)):
            home[i] = home[self.parent[i]] or (i if self.tag[i] in ("article", "main") else 0)
        articles = {home[i] for i, _ in self.blocks} - {0}
        return {start for start, at in most if articles <= {home[at]}}

    def main(self) -> str:
        if not self.blocks:
            return ""
        n = len(self.tag)
        total = max(self.chars[0], 1)
        body_links = self.links[0] / total
        density = [0.0] * n
        score = [0.0] * n
        for i in range(n):
            c = self.chars[i]
            if c:
                t, lc, lt = max(self.tags[i], 1), max(min(self.links[i], c), 1), max(self.link_tags[i], 1)
                base = math.log(c / max(c - self.links[i], 1) * lc + body_links * c + math.e)
                density[i] = c / t * math.log(max(c / lc * t / lt, 1.0)) / max(math.log(base), 1e-9)
            if i:
                score[self.parent[i]] += density[i]
        core = max(range(n), key=lambda i: (score[i], i)) if max(score) else self.blocks[0][0]
        path = [core]
        while path[-1]:
            path.append(self.parent[path[-1]])
        threshold = min(density[i] for i in path)
        whole = [i for i in path if self.tag[i] in ("article", "main")]
        chosen = {whole[-1] if whole else core}
        inside = [False] * n
        ancestors = set(path)
        for i in range(n):
            if i in chosen or i and inside[self.parent[i]]:
                inside[i] = True
            elif i not in ancestors and density[i] >= threshold and score[i] >= score[core] / 4:
                inside[i] = True
            elif not whole and self.tag[i] in ("h1", "h2") and self.parent[i] in ancestors:
                inside[i] = True
        return " ".join([text for i, text in self.blocks if inside[i]])


def main_text(source: str | None) -> str:
    return _Page(source).main() if source else ""


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) -> (page_id, url, text, n_chars)."""

    def run(batches):
        for part in steps(batches, "html"):
            texts = [main_text(h) for h in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    frame = plain_columns(pages, "page_id", "url", "html")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema.fields[:2])
    return frame.mapInArrow(run, f"{kinds}, text string, n_chars long")
