"""Main text of a page: flat text blocks and a decision tree.

The page is cut into text blocks at block-level tags. A block is described by
its word count and link density and those of its neighbours, by the kind of the
nearest enclosing element that says anything (and of the next one above it), by
the share of the page's words that it holds if it may be furniture (1 if it is
not, 0 if it plainly is), and by how much of the page other elements claim as
its content. A decision tree over these
numbers keeps or drops the block. It is grown on the driver from the labelled
pages of ``labelled_pages`` and sent to the tasks.
"""

from __future__ import annotations

import functools
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements by their role in HTML.
SILENT = {"script", "style", "template", "iframe", "svg", "title", "select", "button", "textarea", "option", "datalist"}
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
HEAD = {"base", "link", "meta", "noscript", "script", "style", "template", "title"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "br"}
FURNITURE = {"nav", "footer", "aside", "menu", "dialog", "noscript", "object", "video", "audio", "canvas"}
CONTROLS = {"form", "fieldset", "legend", "label"}
CONTENT = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Words of class, id and role attributes that name furniture, content, or nothing by themselves.
FURNITURE_WORDS = set("ad ads adv advert adverts advertisement advertising adbox banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs footer header masthead topbar sidebar aside related recommended recommendations cookie cookies consent gdpr notice notices notification alert popup modal overlay share sharing social subscribe newsletter signup login form search pagination pager tags toolbar skip contentinfo complementary".split())
HEADER_WORDS = {"header", "masthead"}
COMMENT_WORDS = set("comment comments commentlist disqus respond reply replies".split())
CONTENT_WORDS = set("article articlebody content main post entry story".split())
HEADS = set("area bar block body box container content group holder inner item left line link links list outer panel right row section slot text unit widget wide wrap wrapper".split())
NEGATED = set("has is js no not with without".split())
CLOSED_BY = {"p": BLOCK - {"br", "body", "html"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
COLUMNS = ["words", "link_density", "before_words", "before_links", "after_words", "after_links", "enclosure", "above", "share", "elsewhere", "comments", "heading"]
#: What an enclosing element says: content by element or name, nothing, furniture by part of a name, by a whole name, by element.
IS_CONTENT, NAMED_CONTENT, SILENCE, PART_NAMED, NAMED, IS_FURNITURE = 2, 1, 0, -1, -2, -3

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_TELLING = {"class", "id", "role", "itemprop", "hidden", "style"}
_MAY_TELL = re.compile("|".join(sorted(_TELLING)), re.I).search
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_CLOSED = re.compile(r"(^|[\s\"'])/\s*$").search


@functools.lru_cache(4096)
def _name_kind(name: str) -> tuple[int, int]:
    """What one name says, and whether it names reader comments (1) or a header (2).

    ``cookie-notice`` is a notice and ``ad-box`` an ad; ``notice-board`` and
    ``has-sidebar`` are neither.
    """
    parts = [p.lower() for p in _PART.findall(name)]
    if not parts or parts[0] in NEGATED:
        return SILENCE, 0
    whole, last = len(parts) == 1, parts[-1]
    while len(parts) > 1 and parts[-1] in HEADS:
        parts.pop()
    head = parts[-1]
    if head in COMMENT_WORDS:
        return NAMED, 1
    if head in FURNITURE_WORDS:
        return (NAMED if whole else PART_NAMED), 2 * (head in HEADER_WORDS)
    return (NAMED_CONTENT if head in CONTENT_WORDS or last in CONTENT_WORDS else SILENCE), 0


@functools.lru_cache(4096)
def _names(attrs: str) -> tuple[int, int, int]:
    """What an element's attributes say, whether they name comments (1) or no furniture but a header (2), and whether they hide it."""
    kinds, hidden = set(), 0
    for key, value in _ATTR.findall(attrs) if _MAY_TELL(attrs) else ():
        key = key.lower()
        if key not in _TELLING:  # not aria-hidden, nor a word inside another attribute's value
            continue
        value = html.unescape(value.strip("\"'"))
        if key == "hidden" or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            hidden = 1
        elif key != "style":
            for name in value.split():
                kinds.add(_name_kind(name))
    low = min(kinds, default=(SILENCE, 0))
    comments = 1 if any(c == 1 for _, c in kinds) else 2 if low[1] == 2 and all(c == 2 or k >= SILENCE for k, c in kinds) else 0
    return NAMED_CONTENT if (NAMED_CONTENT, 0) in kinds and comments != 1 else low[0], comments, hidden


class _Block:
    __slots__ = ("parts", "linked", "mark", "comments", "heading", "label", "free")

    def __init__(self, mark: int, comments: int, heading: int, label: int | None):
        self.parts: list[str] = []
        self.linked = self.free = 0
        self.mark, self.comments, self.heading, self.label = mark, comments, heading, label


#: name, mark, comments, heading, silent, link, label
_OUTSIDE = ("", 0, 0, 0, 0, 0, None)


def blocks(page: str) -> list[tuple[str, list[float], int | None]]:
    """``(text, COLUMNS, label)`` of the text blocks; label only from ``data-y`` (labelled pages)."""
    out: list[_Block] = []
    marks: list[list] = [[-1, SILENCE, 0]]  # parent, kind, unlinked words
    stack: list[tuple] = []
    top = _OUTSIDE
    now: _Block | None = None
    at, n = 0, len(page)

    def put(text: str) -> None:
        nonlocal now, top
        if not text or text.isspace() and now is None:
            return
        if stack and stack[-1][0] == "head" and not text.isspace():  # text ends an open head
            stack.pop()
            top = stack[-1] if stack else _OUTSIDE
        if top[4]:
            return
        if now is None:
            now = _Block(top[1], top[2], top[3], top[6])
            out.append(now)
        text = html.unescape(text)
        now.parts.append(text)
        if top[5]:
            now.linked += len(text.split())

    while at < n:
        m = _TAG.search(page, at)
        put(page[at : m.start()] if m else page[at:])
        if not m:
            break
        at = m.end()
        close, name, attrs = (m[1], m[2], m[3] or "") if m[2] else (m[4], m[5], "")
        if not name:
            if m[0].startswith("<![CDATA["):
                put(m[0][9:-3])
            continue
        name = name.lower()
        if name in BLOCK:
            now = None
        if close:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    top = stack[-1] if stack else _OUTSIDE
                    break
            continue
        while stack and (stack[-1][0] in CLOSED_BY and name in CLOSED_BY[stack[-1][0]] or stack[-1][0] == "head" and name not in HEAD):
            stack.pop()
        if name in BLOCK and name != "br":  # inline elements left open do not leak over a new paragraph
            i = len(stack)
            while i and stack[i - 1][0] not in BLOCK and stack[i - 1][0] not in SILENT and stack[i - 1][0] not in FURNITURE and stack[i - 1][0] != "head":
                i -= 1
            if i < len(stack) and i and stack[i - 1][0] == "p" and name in CLOSED_BY["p"]:
                i -= 1
            if i < len(stack):
                del stack[i:]
        top = stack[-1] if stack else _OUTSIDE
        if name in VOID:
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if name not in BLOCK and _CLOSED(attrs):
            continue
        kind, comments, hidden = _names(attrs) if attrs.strip() else (SILENCE, 0, 0)
        if name in ("body", "html") or comments == 2 and marks[top[1]][1] > SILENCE:  # the header of an article
            kind = comments = 0
        comments %= 2
        if name in ("body", "html"):
            pass
        elif name in CONTENT:
            kind = kind if comments else IS_CONTENT
        elif name in FURNITURE or name == "header" and marks[top[1]][1] <= SILENCE:
            kind = IS_FURNITURE
        elif name in CONTROLS and kind > PART_NAMED:
            kind = PART_NAMED
        mark = top[1]
        if kind != SILENCE:
            marks.append([mark, kind, 0])
            mark = len(marks) - 1
        own = re.search(r"data-y=\"?([01])", attrs) if "data-y" in attrs else None
        top = (name, mark, int(comments or top[2]), int(name in HEADINGS or top[3]), int(top[4] or name in SILENT or name == "head" or hidden), int(name == "a" or top[5]), int(own[1]) if own else top[6])
        stack.append(top)
    found = []
    for b in out:
        text = " ".join("".join(b.parts).split())
        if text:
            k = len(text.split())
            links = min(1.0, b.linked / k)
            b.free = k - min(k, b.linked)
            i = b.mark
            while i >= 0:
                marks[i][2] += b.free
                i = marks[i][0]
            found.append((text, k, links, b))
    whole = max(1, marks[0][2])
    content = sum(m[2] for m in marks if m[1] > SILENCE and not _within_content(marks, m[0])) / whole
    nothing = ("", 0, 0.0)
    done = []
    for i, (text, k, links, b) in enumerate(found):
        before, after = found[i - 1] if i else nothing, found[i + 1] if i + 1 < len(found) else nothing
        mark = marks[b.mark]
        above = marks[mark[0]][1] if mark[0] >= 0 else SILENCE
        elsewhere = 0.0 if mark[1] > SILENCE or _within_content(marks, b.mark) else content
        done.append((text, [float(k), links, float(before[1]), before[2], float(after[1]), after[2], float(mark[1]), float(above), 1.0 if mark[1] >= SILENCE else mark[2] / whole if mark[1] == PART_NAMED else 0.0, elsewhere, float(b.comments), float(b.heading)], b.label))
    return done


def _within_content(marks: list[list], i: int) -> bool:
    while i >= 0:
        if marks[i][1] > SILENCE:
            return True
        i = marks[i][0]
    return False


#: The words that labelled pages are filled with.
_FILL = "the river rose by two metres on monday and ran through streets of old town nobody was hurt but more rain is expected in hills so people carry what they can to dry rooms while boats wait at north gate for those who live near water".split()


def _say(n: int, at: int) -> str:
    return " ".join(_FILL[(at * 7 + i * (at % 5 + 1)) % len(_FILL)] for i in range(n)).capitalize() + "."


def labelled_pages(first: int = 0, last: int = 240) -> list[str]:
    """Small pages of many layouts; ``data-y`` says whether an element's text is main text.

    Page ``i`` combines a way to hold the main text, a wrapper around the whole
    page, a mix of paragraph lengths, and furniture before, inside and after,
    each in a turn of its own by a rule on ``i``.
    """
    holders = ["<article{y}>{x}</article>", "<main{y}>{x}</main>", "<div{y}>{x}</div>", '<div class="post-content"{y}>{x}</div>', "<section{y}>{x}</section>", "<table><tr><td{y}>{x}</td></tr></table>", "<div{y}><div>{x}</div></div>", '<main{y}><section class="notice-board">{x}</section></main>', '<div id="content"{y}>{x}</div>', '<main><article{y}>{x}</article></main>', "<center{y}>{x}</center>"]
    wrappers = ["<body>{x}</body>", '<body class="home has-sidebar">{x}</body>', '<div class="layout has-sidebar">{x}</div>', '<form id="aspnetForm">{x}</form>', '<div class="wrapper"><div class="header-fixed">{x}</div></div>', "<table><tr><td>{x}</td></tr></table>", '<form action="/"><div id="page">{x}</div></form>']
    menus = ['<nav data-y=0><ul><li><a href=1>{a}</a></li><li><a href=2>{b}</a></li></ul></nav>', "<div data-y=0><a href=1>{a}</a> <a href=2>{b}</a> <a href=3>{a}</a></div>", '<header data-y=0><div>{b}</div><p>{s}</p></header>', '<ul data-y=0><li><a href=1>{a}</a></li><li><a href=2>{b}</a></li><li><a href=3>{b}</a></li></ul>', '<div class="site-header" data-y=0><p>{b}</p></div><nav data-y=0><p>{l}</p></nav>', '<p data-y=0><a href=1>{a}</a> | <a href=2>{b}</a></p>', ""]
    notices = ['<div class="ad" data-y=0>{m}</div>', '<div class="cookie-notice" data-y=0><p>{m}</p><button>OK</button></div>', "", '<div id="ad-box" data-y=0><p>{s}</p></div>', '<aside data-y=0><h3>{b}</h3><p>{l}</p></aside>', '<noscript data-y=0>{m}</noscript>', '<div class="sidebar" data-y=0><p>{l}</p><p>{s}</p></div>', '<div role="alert" data-y=0>{l}</div>', ""]
    inner = ["", "", '<div class="ad-slot" data-y=0>{m}</div>', '<aside data-y=0><p>{s}</p></aside>', '<div class="entry-header"><h2>{b}</h2></div>', "<header><h2>{b}</h2></header>", '<div class="share-links" data-y=0><a href=5>{a}</a> {b}</div>', '<form data-y=0><p>{s}</p><input></form>', '<figure><figcaption>{s}</figcaption></figure>', "<pre>{s}</pre>"]
    ends = ['<footer data-y=0><p>{m}</p></footer>', '<div class="comments" data-y=0><p>{l}</p><p>{s}</p></div><footer data-y=0><p>{l}</p><a href=6>{a}</a></footer>', "<div data-y=0><a href=4>{a}</a></div>", "<div data-y=0><p><a href=4>{m}</a></p><p><a href=5>{s}</a></p><p><a href=6>{l}</a></p></div>", '<section id="comments" data-y=0><article><p>{l}</p></article><article><p>{m}</p></article></section>', '<div class="related" data-y=0><article><p><a href=5>{a}</a></p><p>{s}</p></article></div>', '<div id="footer" data-y=0>{m}</div>', '<form data-y=0><p>{s}</p><label>{b}</label><input name=q></form><div class="site-footer" data-y=0><p>{l}</p></div>', '<div data-y=0><p><a href=7>{a}</a></p><p>{b}</p><p><a href=8>{b}</a></p></div>', '<aside data-y=0><article><h4><a href=9>{a}</a></h4><p>{m}</p></article></aside>', '<ul data-y=0><li><a href=4>{a}</a></li><li><a href=5>{b}</a></li></ul>', ""]
    pages = []
    for i in range(first, last):
        fill = lambda t, k: t.format(a=_say(1 + (i + k) % 3, i + k), b=_say(1 + (i + 2 * k) % 4, i + 2 * k + 1), s=_say(4 + (i + k) % 6, i + k + 2), m=_say(9 + (i + k) % 8, 3 * i + k), l=_say(20 + (i * 5 + k) % 30, i + k + 4))  # noqa: B023, E731
        mixes = [[30, 6, 24], [3], [1], [], [5, 4, 8], [40, 22, 18, 9], [12, 14, 16], [2, 2, 30, 2, 2], [60], [7, 25, 4, 33]]
        turn = lambda xs, k: xs[(i + i // k) % len(xs)]  # noqa: B023, E731
        holder = turn(holders, 97)
        claimed = any(w in holder for w in ("article", "main", "content"))
        sizes = turn(mixes, 13)
        body = f"<h1>{_say(2 + i % 4, i)}</h1>" if i % 4 and sizes else ""
        for k, size in enumerate(sizes):
            text = _say(size, i + k)
            if (i + k) % 5 == 3 and size > 12:
                words = text.split()
                text = f"{' '.join(words[:6])} <a href=3>{' '.join(words[6:10])}</a> {' '.join(words[10:])}"
            elif (i + k) % 3 == 1 and size > 3:  # half of a short one may be a link
                words = text.split()
                text = f"{' '.join(words[: size // 4])} <a href=3>{' '.join(words[size // 4 : size - size // 4])}</a> {' '.join(words[size - size // 4 :])}" if size < 13 else text
            body += text + "<br>" if i % 11 == 10 else f"<p>{text}</p>"
            if k == 0:
                extra = turn(inner, 4)
                body += fill(extra, k) if claimed or "header" not in extra else ""
        if i % 6 == 2 and sizes:
            body += f"<ul><li>{_say(2, i)}</li><li>{_say(5, i + 1)}</li></ul>"
        if i % 9 == 4 and sizes:
            body += f"<table><tr><td>{_say(1, i)}</td><td>{_say(3, i + 3)}</td></tr></table>"
        if claimed and sizes and i % 7 == 5:  # a paragraph that is all link is text only where an element says so
            body += f"<p><a href=3>{_say(9, i)}</a></p>"
        end = turn(ends, 5)
        if claimed and sizes and i % 3 == 0:  # text beside what claims to be the content
            end = f"<p data-y=0>{_say(6 + i % 20, i + 9)}</p>" + end
        main = holder.format(y=" data-y=1", x=body)
        inside = fill(turn(menus, 3), 1) + fill(turn(notices, 6), 2) + main + fill(end, 3)
        pages.append(turn(wrappers, 2).format(x=inside))
    return pages


def grow(x: list[list[float]], y: list[int], depth: int = 9, least: int = 3):
    """A CART tree by Gini impurity: ``(column, cut, left, right)`` or the kept share as leaf.

    Sides hold ``least`` rows; of equal gains the first column of ``COLUMNS`` is taken.
    """
    import numpy as np

    def split(a, t, left: int):
        n, ones = len(t), int(t.sum())
        if left == 0 or ones in (0, n) or n < 2 * least:
            return ones / n
        best = (1e-9, None, None)
        whole = 2 * ones * (n - ones) / n
        for c in range(a.shape[1]):
            order = np.argsort(a[:, c], kind="stable")
            v, s = a[order, c], np.cumsum(t[order])
            k = np.arange(1, n)
            ok = (v[1:] > v[:-1]) & (k >= least) & (n - k >= least)
            if not ok.any():
                continue
            l1 = s[:-1]
            r1 = ones - l1
            gain = np.where(ok, whole - 2 * l1 * (k - l1) / k - 2 * r1 * (n - k - r1) / (n - k), -1)
            i = int(gain.argmax())
            if gain[i] > best[0] + 1e-9:
                best = (float(gain[i]), c, float((v[i] + v[i + 1]) / 2))
        if best[1] is None:
            return ones / n
        _, c, cut = best
        side = a[:, c] <= cut
        return c, cut, split(a[side], t[side], left - 1), split(a[~side], t[~side], left - 1)

    return split(np.array(x, dtype=float), np.array(y, dtype=np.int64), depth)


@functools.cache
def tree():
    rows = [(f, y) for page in labelled_pages() for _, f, y in blocks(page) if y is not None]
    return grow([f for f, _ in rows], [y for _, y in rows])


def main_text(page: str | None, grown=None) -> str:
    """The kept blocks of a page, joined by line feeds."""
    root, out = grown or tree(), []
    for text, f, _ in blocks(page or ""):
        node = root
        while isinstance(node, tuple):
            node = node[2] if f[node[0]] <= node[1] else node[3]
        if node >= 0.5:
            out.append(text)
    return "\n".join(out)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row.

    Null or empty html, and pages without main text, give an empty text.
    Repeated rows are extracted one by one, null ids and urls stay null; extra
    columns are ignored; an empty table gives an empty result.
    """
    grown = tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 500):
                part = b.slice(i, 500)
                texts = [main_text(t.as_py(), grown) for t in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = pages.schema[id_col].dataType.simpleString(), pages.schema[url_col].dataType.simpleString()
    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html")).mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")
