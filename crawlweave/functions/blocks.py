"""Blocks of an HTML page: a one-pass tag tokenizer with an open-element stack.

``page_of(html)`` reads the page once from front to end and cuts its text at
block-level tags.  Every block knows its markdown, its depth, how much of its
text is link text, the elements around it and whether the page's structure
marks them as boilerplate; ``keep`` then chooses the main content by text and
link density.  Plain Python on one page; the Spark side is ``markdown.py``.

- ``<`` opens a tag only before a letter, ``/``, ``!`` or ``?``.
- End tags that are left out are implied (p, li, dt, dd, td, tr, headings);
  an end tag without its start, and one across a table cell, is passed over.
- A nav, footer, aside or advertisement block counts as such where it is
  closed, by its own end tag or that of an element around it; text behind it
  is content again.
- Emphasis, code and links count where they are closed inside their block.
- Elements nested deeper than MAX_DEPTH stay open at that depth.
"""

from __future__ import annotations

import re
from collections import Counter
from html.entities import html5

MAX_DEPTH = 512

# What HTML says about its elements.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section
    summary table tbody td tfoot th thead tr ul""".split())
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
LISTS = frozenset(["ul", "ol", "menu", "dir"])
CELLS = frozenset(["td", "th"])
TABLE_PARTS = frozenset(["caption", "table", "tbody", "td", "tfoot", "th", "thead", "tr"])
#: A start tag ends the open element of the first set, looked for down to one of the second.
IMPLIED_ENDS = {
    "li": (frozenset(["li"]), LISTS),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "td": (CELLS, frozenset(["tr", "table"])),
    "th": (CELLS, frozenset(["tr", "table"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "thead": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])),
    "tbody": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])),
    "tfoot": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])),
}
MARKS = {"b": "**", "strong": "**", "i": "*", "em": "*", "code": "`"}
#: Elements whose inside is no text of the page; the first two swallow the rest where they are not closed.
UNSEEN = frozenset(["script", "style", "template", "svg", "iframe", "canvas", "noembed", "object"])
BOILERPLATE = frozenset(["nav", "footer", "aside"])
AD_NAMES = frozenset(["ad", "ads", "advert", "advertisement"])

# Thresholds of the block scores.
LONG_TEXT = 80          # characters of a block that speaks for itself
LOW_LINKS = 0.33        # link density below which such a block is content
HIGH_LINKS = 0.5        # link density from which a block is a list of links
DENSE_TEXT = 20.0       # characters per tag of a block that speaks for itself
ARTICLE_SHARE = 0.5     # share of the page's text from which an article is all of its content

TOKEN = re.compile(r"""<!--(?:.*?-->|.*)
    |<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]{0,65536}+"|'[^']{0,65536}+'){0,1000}+)>
    |<(/?)([A-Za-z][^\s/>]*)([^>]*)>
    |<[!?/][^>]*>""", re.S | re.X)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
ENTITY = re.compile(r"&(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]*);")
_ENDS = {name: re.compile(f"</{name}", re.I) for name in [*UNSEEN, "title"]}
_SPACES, _LINE_ENDS, _EMPTY_LINES = re.compile("[ \t\r\f]+"), re.compile(" *\n *"), re.compile("\n\n\n+")


def _character(m: re.Match) -> str:
    name = m[1]
    if name[0] != "#":
        found = html5.get(name + ";")
        return " " if name == "nbsp" else m[0] if found is None else found
    code = int(name[2:], 16) if name[1] in "xX" else int(name[1:])
    return chr(code) if 1 <= code <= 0xD7FF or 0xE000 <= code <= 0x10FFFF else m[0]


def decoded(text: str) -> str:
    return ENTITY.sub(_character, text) if "&" in text else text


def tidy(text: str) -> str:
    """Single spaces, no spaces at line ends, at most one empty line, none at the ends."""
    if "  " in text or "\t" in text or "\r" in text or "\f" in text:
        text = _SPACES.sub(" ", text)
    if "\n" in text:
        text = _EMPTY_LINES.sub("\n\n", _LINE_ENDS.sub("\n", text))
    return text.strip(" \n")


def attributes(source: str) -> dict[str, str]:
    """Attributes by lower-case name, the first of a name."""
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(source):
        out.setdefault(m[1].lower(), decoded(m[2] or m[3] or m[4] or ""))
    return out


class Block:
    """A run of text between block-level tags."""

    __slots__ = ("tag", "kind", "depth", "markdown", "text_chars", "link_chars", "tags", "around", "in_article",
                 "indent", "marker", "quoted", "group", "header", "kept")

    def __init__(self, tag, kind, depth, markdown, text_chars, link_chars, tags):
        self.tag, self.kind, self.depth, self.markdown = tag, kind, depth, markdown
        self.text_chars, self.link_chars, self.tags = text_chars, link_chars, tags
        self.around, self.in_article, self.kept = None, False, False
        self.indent, self.marker, self.quoted, self.group, self.header = 0, "", 0, 0, False

    @property
    def text_density(self) -> float:
        """Characters per tag, the block's own included."""
        return self.text_chars / (self.tags + 1)

    @property
    def link_density(self) -> float:
        return self.link_chars / self.text_chars if self.text_chars else 0.0

    def boilerplate(self) -> bool:
        at = self.around
        while at is not None:
            if at.closed:
                return True
            at = at.outer
        return False


class _Around:
    """A boilerplate element and the one around it."""

    __slots__ = ("outer", "closed")

    def __init__(self, outer):
        self.outer, self.closed = outer, False


class _Open:
    """An open element: blocks, and the inline elements that leave marks."""

    __slots__ = ("name", "block", "around", "place", "serial", "href", "parts", "marked", "number")

    def __init__(self, name, block):
        self.name, self.block = name, block
        self.around = self.href = self.parts = None
        self.place = self.serial = self.number = 0
        self.marked = False


class _Reader:
    def __init__(self):
        self.stack: list[_Open] = []
        self.open: Counter = Counter()
        self.blocks: list[Block] = []
        self.head: dict[str, str] = {}
        self.around: _Around | None = None
        self.pieces: list[str] = []   # markdown of the block at hand
        self.plain: list[str] = []    # its text alone
        self.links = self.tags = 0
        self.serial = 0               # number of the block at hand
        self.groups = 0

    # -------------------------------------------------------------- text

    def text(self, raw: str) -> None:
        if self.open["head"] and not self.open["body"] and not raw.isspace():
            self.close_to("head")     # text ends a head that was left open
        text = decoded(raw)
        self.pieces.append(text)
        self.plain.append(text)
        if self.open["a"]:
            self.links += len(tidy(text))

    def flush(self) -> None:
        """End the block at hand."""
        if not self.pieces:
            self.tags = self.links = 0
            return
        top = next((e for e in reversed(self.stack) if e.block), None)
        whole, plain = "".join(self.pieces), "".join(self.plain)
        if self.open["pre"]:
            code = whole.replace("\r\n", "\n").removeprefix("\n").rstrip()
            fence = "```"
            while fence in code:
                fence += "`"
            markdown, kind = f"{fence}\n{code}\n{fence}" if code else "", "pre"
            chars = len(code)
        else:
            markdown, kind = tidy(whole), "text"
            chars = len(markdown if whole == plain else tidy(plain))
        if markdown:
            tag = top.name if top else ""
            depth = sum(e.block for e in self.stack)
            block = Block(tag, kind, depth, markdown, chars, min(self.links, chars), self.tags)
            if kind == "text" and tag in HEADINGS:
                block.kind, block.markdown = "heading", f"{'#' * int(tag[1])} {markdown}"
            self.emit(block)
        self.pieces, self.plain = [], []
        self.links = self.tags = 0
        self.serial += 1

    def emit(self, block: Block) -> None:
        block.around = self.around
        block.in_article = self.open["article"] + self.open["main"] > 0
        cell = next((e for e in reversed(self.stack) if e.parts is not None and e.name in CELLS), None)
        if cell is not None:
            cell.parts.append(block)
            return
        block.quoted = self.open["blockquote"]
        self._as_item(block)
        self.blocks.append(block)

    def _as_item(self, block: Block) -> None:
        """Indent and marker of a block inside list items."""
        item, widths = None, 0
        for e in reversed(self.stack):
            if e.name in LISTS:
                if item is None:
                    break             # text of a list outside its items
                if block.group == 0 or e.number:
                    block.group = block.group or e.number
            if e.name == "li" and item is None:
                item = e
        if item is None:
            return
        lists = [e for e in self.stack[:self.stack.index(item)] if e.name in LISTS]
        widths = sum(3 if e.name == "ol" else 2 for e in lists[:-1])
        marker = "1. " if lists and lists[-1].name == "ol" else "- "
        if lists:
            block.group = lists[0].number
        if item.marked:
            block.indent = widths + len(marker)
        else:
            block.indent, block.marker, item.marked = widths, marker, True

    # -------------------------------------------------------------- elements

    def push(self, name: str, block: bool) -> _Open | None:
        if len(self.stack) >= MAX_DEPTH:
            return None
        e = _Open(name, block)
        self.stack.append(e)
        self.open[name] += 1
        return e

    def pop(self, closed: bool) -> _Open:
        e = self.stack.pop()
        self.open[e.name] -= 1
        if e.around is not None:
            e.around.closed = closed
            self.around = e.around.outer
        if e.name == "tr" and e.parts is not None:
            self.row(e)
        return e

    def close_to(self, name: str, closed: bool = True) -> None:
        self.flush()
        while self.stack:
            if self.pop(closed).name == name:
                return

    def row(self, tr: _Open) -> None:
        """A row of cells with one text each is a line of a table; any other is layout."""
        cells = [c for c in tr.parts if c.parts]
        if not cells:
            return
        if any(len(c.parts) > 1 or c.parts[0].kind != "text" for c in cells):
            for c in cells:
                for block in c.parts:
                    self.emit(block)
            return
        texts = [c.parts[0].markdown.replace("\n", " ").replace("|", "\\|") if c.parts else "" for c in tr.parts]
        parts = [c.parts[0] for c in cells]
        line = Block("tr", "row", parts[0].depth - 1, f"| {' | '.join(texts)} |", sum(p.text_chars for p in parts),
                     sum(p.link_chars for p in parts), sum(p.tags + 1 for p in parts))
        line.group = -tr.number
        line.header = len(texts) if self.open["thead"] or all(c.name == "th" for c in tr.parts) else 0
        if line.header and self.open["thead"]:
            line.header = -line.header    # stated as the head
        self.emit(line)

    def start(self, name: str, source: str) -> None:
        if name in BLOCKS:
            self.start_block(name, source)
        elif name == "br":
            self.tags += 1
            self.pieces.append("\n")
            self.plain.append("\n")
        elif name == "img":
            self.tags += 1
            a = attributes(source)
            if "src" in a and "alt" in a:
                self.pieces.append(f"![{tidy(a['alt'])}]({a['src'].strip()})")
        elif name == "meta":
            a = attributes(source)
            key = a.get("name", "").strip().lower()
            if key in ("author", "description"):
                self.head.setdefault(key, tidy(a.get("content", "")))
        else:
            self.tags += 1
            if name == "a":
                self.end_inline("a")
            if name == "a" or name in MARKS:
                self.start_inline(name, source)

    def start_block(self, name: str, source: str) -> None:
        self.flush()
        if name == "hr":
            return
        while self.stack and not self.stack[-1].block:
            self.pop(True)
        top = self.stack[-1].name if self.stack else ""
        if top == "p" or (top in HEADINGS and name in HEADINGS):
            self.pop(True)
        if name in IMPLIED_ENDS:
            ended, within = IMPLIED_ENDS[name]
            if any(self.open[x] for x in ended):
                for e in reversed(self.stack):
                    if e.name in within:
                        break
                    if e.name in ended:
                        while self.pop(True) is not e:
                            pass
                        break
        row = self.stack[-1] if self.stack and self.stack[-1].name == "tr" else None
        e = self.push(name, True)
        if e is None:
            return
        if name in LISTS or name == "table":
            self.groups += 1
            e.number = self.groups
        elif name == "tr":
            e.parts = []
            e.number = next((t.number for t in reversed(self.stack) if t.name == "table"), 0)
        elif name in CELLS and row is not None and row.parts is not None:
            e.parts = []
            row.parts.append(e)
        if name in BOILERPLATE or ("class" in source and not AD_NAMES.isdisjoint(
                attributes(source).get("class", "").lower().split())):
            e.around = self.around = _Around(self.around)

    def start_inline(self, name: str, source: str) -> None:
        kind = MARKS.get(name, name)
        if self.open["pre"] or any(not e.block and MARKS.get(e.name, e.name) in (kind, "`") for e in self.stack[-4:]):
            return
        e = self.push(name, False)
        if e is not None:
            e.place, e.serial = len(self.pieces), self.serial
            if name == "a":
                e.href = attributes(source).get("href")

    def end_inline(self, name: str) -> None:
        """Mark what lies since the start tag, if that is in the same block."""
        if not self.open[name]:
            return
        found = None
        for e in reversed(self.stack):
            if e.block:
                break
            if e.name == name:
                found = e
                break
        if found is None:
            return
        while self.pop(True) is not found:
            pass
        if found.serial != self.serial or (name == "a" and found.href is None):
            return
        inner = "".join(self.pieces[found.place:])
        core = inner.strip(" \t\r\f\n")
        if not core:
            return
        lead = inner[:len(inner) - len(inner.lstrip(" \t\r\f\n"))]
        trail = inner[len(inner.rstrip(" \t\r\f\n")):]
        marked = f"[{core}]({found.href.strip()})" if name == "a" else f"{MARKS[name]}{core}{MARKS[name]}"
        self.pieces[found.place:] = [lead + marked + trail]

    def end(self, name: str) -> None:
        if name in MARKS or name == "a":
            self.end_inline(name)
            return
        if name not in BLOCKS or name in ("html", "body"):
            return
        if name in HEADINGS:
            name = next((e.name for e in reversed(self.stack) if e.name in HEADINGS), name)
        if not self.open[name]:
            if name == "p":
                self.flush()
            return
        if name not in TABLE_PARTS:
            for e in reversed(self.stack):
                if e.name == name:
                    break
                if e.name in CELLS or e.name == "table":
                    return
        self.close_to(name)


def read(html: str) -> tuple[list[Block], dict[str, str]]:
    """Blocks in order, and the page's title, author and description."""
    r = _Reader()
    at, gone, last = 0, set(), html.rfind(">")
    while True:
        # behind the last ">" nothing but a comment can begin
        m = TOKEN.search(html, at) if at <= last or html.find("<!--", at) >= 0 else None
        stop = m.start() if m else len(html)
        if stop > at:
            r.text(html[at:stop])
        if m is None:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            r.end(name)
            continue
        if name in _ENDS and name not in gone:
            end = _ENDS[name].search(html, at)
            if end is None:
                gone.add(name)
                if name in ("script", "style"):
                    at = len(html)
            else:
                if name == "title" and "title" not in r.head:
                    r.head["title"] = tidy(decoded(re.sub("<[^>]*>", "", html[at:end.start()])))
                closing = html.find(">", end.end())
                at = len(html) if closing < 0 else closing + 1
            continue
        r.start(name, m[3] or m[6] or "")
    r.flush()
    while r.stack:
        r.pop(False)
    return r.blocks, r.head


def keep(blocks: list[Block]) -> list[Block]:
    """Set ``kept``: the main content.

    Blocks inside closed boilerplate elements never are.  An article (or main)
    with at least ARTICLE_SHARE of the other blocks' text outside links is all of
    the content.  Else a block is good (in the article, or long, dense and with
    few links), a list of links, or neither; the latter go with the nearest good
    block or list of links on either side, and headings with what follows.  A
    page without any good block keeps all but lists of links, or those too where
    there is nothing else.
    """
    left = [b for b in blocks if not b.boilerplate()]
    inside = [b for b in left if b.in_article]

    def weight(of: list[Block]) -> int:
        return sum(b.text_chars - b.link_chars for b in of)

    if inside and weight(inside) >= ARTICLE_SHARE * weight(left):
        chosen = inside
    else:
        def score(b: Block) -> int:
            if b.in_article or (b.text_chars >= LONG_TEXT and b.link_density < LOW_LINKS
                                and b.text_density >= DENSE_TEXT):
                return 1
            return -1 if b.link_density >= HIGH_LINKS else 0

        scores = [score(b) for b in left]
        if 1 in scores:
            before, after, seen = [], [], 0
            for s in scores:
                before.append(seen)
                seen = s or seen
            seen = 0
            for s in reversed(scores):
                after.append(seen)
                seen = s or seen
            after.reverse()
            chosen = [b for b, s, x, y in zip(left, scores, before, after, strict=True)
                      if s > 0 or (s == 0 and (y > 0 or (x > 0 and b.kind != "heading")))]
        else:
            chosen = [b for b, s in zip(left, scores, strict=True) if s == 0] or left
    for b in chosen:
        b.kept = True
    return blocks


def joined(blocks: list[Block], th_headers: bool = False) -> str:
    """The blocks' markdown: items of a list and rows of a table line by line, others with an empty line between."""
    out, last = [], None
    for b in blocks:
        text = b.markdown
        if b.indent or b.marker:
            rest = "\n" + " " * (b.indent + len(b.marker))
            text = " " * b.indent + b.marker + text.replace("\n", rest)
        if b.quoted:
            text = "\n".join("> " + x for x in text.split("\n"))
        together = last is not None and b.group and b.group == last.group and (b.kind == "row" or b.marker)
        if b.header and not together and (b.header < 0 or th_headers):
            text += "\n|" + "---|" * abs(b.header)
        if out:
            out.append("\n" if together else "\n\n")
        out.append(text)
        last = b
    return "".join(out)


def page_of(html: str) -> tuple[list[Block], dict[str, str]]:
    blocks, head = read(html)
    return keep(blocks), head


def markdown_of(html: str | None, th_headers: bool = False) -> str | None:
    """The page's main content as markdown with its header; None where there is no text."""
    if not html:
        return None
    blocks, head = page_of(html)
    text = joined([b for b in blocks if b.kept], th_headers)
    if not text:
        return None
    lines = [f"{k}: {head[k]}\n" for k in ("title", "author", "description") if head.get(k)]
    return f"---\n{''.join(lines)}---\n\n{text}" if lines else text
