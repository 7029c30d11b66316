"""One pass over an HTML page: tokens, a stack of open elements, and a writer of Markdown lines.

``functions/html.py`` runs this over Arrow batches; nothing here knows Spark.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

# Element names by what they do to a page.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes", "noscript"}
DROPPED = {"head", "nav", "footer", "aside", "template", "svg", "math", "object", "canvas", "audio", "video", "select", "button", "dialog"} | RAW
BLOCKS = {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "dir", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "li", "main", "menu", "ol", "p", "pre",
    "search", "section", "summary", "table", "ul",
}
LISTS = {"ul", "ol", "menu", "dir"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
MARKS = {"b": "**", "strong": "**", "i": "*", "em": "*", "cite": "*", "dfn": "*", "var": "*", "del": "~~", "s": "~~", "strike": "~~"}
CODE = {"code", "kbd", "samp", "tt"}
# Words of a class or an id that name what is not the page's content.
ASIDE = {
    "ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "cookie", "footer", "menu", "modal", "nav", "navbar",
    "navigation", "newsletter", "popup", "promo", "share", "sidebar", "social", "sponsored",
}
#: An element that stands for a level of its own closes open ones of the first set above the nearest of the second.
CLOSES = {
    "li": ({"li"}, LISTS),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr"}, {"table"}),
}
#: Levels of lists and quotes that show; what is nested deeper is written at the last of them.
LEVELS = 32

#: Possessive parts: a token is read or refused without trying its start twice. A tag may hold ``>`` in quotes.
TOKEN = re.compile(
    r"(?P<skipped><!--(?:[^-]|-(?!->))*+(?:-->|\Z)|<[!?][^>]*+>?)"
    r"|(?P<tag></?[a-zA-Z][^\s/>\"'<]*+(?:\"[^\"<]*+\"|'[^'<]*+'|[^\"'<>])*+>)"
    r"|(?P<text><?[^<]*+)"
)
NAME = re.compile(r"</?([a-zA-Z][^\s/>\"'<]*)")
ATTRIBUTE = re.compile(r"([^\s=/>\"']++)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]++))?+")
BLANKS = re.compile(r"[ \t\n\r\f]+")
SPECIAL = re.compile(r"([\\`*_\[\]]|<(?=[a-zA-Z/!?]))")
LINE_START = re.compile(r"(#{1,6}(?=\s|$)|>|[-+](?=\s|$)|=+(?=\s|$)|\d{1,9}(?=[.)](?:\s|$)))")
TICKS = re.compile(r"`+")
LANGUAGE_CLASS = re.compile(r"\b(?:language|lang|highlight-source)-([\w+#.-]+)")


def attributes(tag: str) -> dict[str, str]:
    """Attributes of a start tag, names in small letters, the first of each name."""
    found: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(tag, NAME.match(tag).end(), len(tag) - 1):
        found.setdefault(name.lower(), unescape(value[1:-1] if value[:1] in ("'", '"') else value))
    return found


def fence(text: str, least: int) -> str:
    """More backticks in a row than ``text`` has."""
    return "`" * max(least, 1 + max((len(t) for t in TICKS.findall(text)), default=0))


class Writer:
    """Lines of Markdown, written from left to right.

    Blank space, list markers and the openings of inline marks wait until text follows, so
    that none is written for nothing and marks hug their words.
    """

    def __init__(self):
        self.out: list[str] = []
        self.levels: list[list] = []  # the prefix of a level's first line, of those after it, and if it has a line
        self.marks: list[tuple[str, str]] = []  # opening and closing
        self.dead, self.opened = 0, 0  # marks that ended with their block, then those open in the text, then waiting ones
        self.lines, self.space, self.flat = 0, False, False

    def block(self, lines: int = 2) -> None:
        """End the line; ``lines`` of 2 leave a blank one before what follows."""
        self.space = self.flat
        if self.flat:
            return
        self.out += [closing for _, closing in reversed(self.marks[self.dead : self.opened])]
        self.dead = self.opened
        # A level that waits for its first line starts with it.
        if self.out and (not self.levels or self.levels[-1][2]):
            self.lines = max(self.lines, lines)

    def _margin(self, first: bool) -> str:
        parts = []
        for level in self.levels[:LEVELS]:
            parts.append(level[1] if level[2] or not first else level[0])
            level[2] |= first
        return "".join(parts)

    def _begin(self) -> bool:
        """Write what waits; true at the start of a line."""
        fresh = not self.out or self.lines > 0
        if fresh and not self.flat:
            if self.out:
                if self.lines > 1:
                    self.out.append("\n" + "".join(level[1] for level in self.levels[:LEVELS] if level[2]).rstrip())
                self.out.append("\n")
            self.out.append(self._margin(True))
        elif self.space and self.out:
            self.out.append(" ")
        self.lines, self.space = 0, False
        self.out += [opening for opening, _ in self.marks[self.opened :]]
        self.opened = len(self.marks)
        return fresh

    def text(self, text: str) -> None:
        words = BLANKS.sub(" ", text)
        inner = words.strip(" ")
        if words[:1] == " ":
            self.space = True
        if inner:
            inner = SPECIAL.sub(r"\\\1", inner)
            if self._begin() and (at := LINE_START.match(inner)):
                # A number keeps its digits; the mark behind it is escaped.
                cut = at.end() if inner[0].isdigit() else 0
                inner = f"{inner[:cut]}\\{inner[cut:]}"
            self.out.append(inner.replace("|", "\\|") if self.flat else inner)
            self.space = words[-1] == " "

    def literal(self, text: str) -> None:
        """Inline Markdown as it is."""
        self._begin()
        self.out.append(text.replace("|", "\\|") if self.flat else text)

    def hard_break(self) -> None:
        if self.flat:
            self.space = True
        elif self.out and not self.lines:
            self.space, self.lines = False, 1

    def open(self, opening: str, closing: str) -> None:
        self.marks.append((opening, closing))

    def close(self) -> None:
        _, closing = self.marks.pop()
        if self.dead <= len(self.marks) < self.opened:
            self.out.append(closing)
        self.opened = min(self.opened, len(self.marks))
        self.dead = min(self.dead, len(self.marks))

    def verbatim(self, lines: list[str]) -> None:
        """A block whose lines are kept."""
        self.block()
        self._begin()
        self.out.append(lines[0])
        for line in lines[1:]:
            self.out.append(f"\n{self._margin(False)}{line}".rstrip())
        self.block()


class Page:
    """The open elements of one page, and what is known of it so far."""

    def __init__(self):
        self.writer = Writer()
        self.stack: list[tuple] = []  # name, what closes it
        self.where: dict[str, list[int]] = {}  # places of each name in the stack
        self.mute = 0
        self.lists: list[int | None] = []
        self.table: list[list[str]] | None = None
        self.tables = 0
        self.kept: list[str] | None = None  # text of a pre or code element
        self.title: str | None = None
        self.description: str | None = None
        self.language: str | None = None

    def nearest(self, names) -> int:
        return max((self.where[n][-1] for n in names if self.where.get(n)), default=-1)

    def push(self, name: str, on_close=None) -> None:
        self.where.setdefault(name, []).append(len(self.stack))
        self.stack.append((name, on_close))

    def pop_to(self, place: int) -> None:
        while len(self.stack) > place:
            name, on_close = self.stack.pop()
            self.where[name].pop()
            if on_close:
                on_close()

    def text(self, text: str) -> None:
        if self.mute:
            return
        text = (unescape(text) if "&" in text else text).replace("\xa0", " ")
        if self.kept is not None:
            self.kept.append(text)
        elif self.table is None or self.writer.flat or not text.isspace():
            self.writer.text(text)  # text between cells goes before their table, which is written when it ends

    def end(self, name: str) -> None:
        if self.where.get(name):
            place = self.where[name][-1]
            # What is open inside a table stays there when an element around the table ends in it.
            if name == "table" or place > self.nearest(("table",)):
                self.pop_to(place)
        elif name == "p":
            self.block()

    def block(self) -> None:
        if not self.mute and self.kept is None:
            self.writer.block()

    def start(self, name: str, tag: str) -> None:
        if name in BLOCKS or name in CLOSES:
            bound = self.nearest(("table", "td", "th", "caption"))
            if self.where.get("p") and self.where["p"][-1] > bound:
                self.pop_to(self.where["p"][-1])
        if name in CLOSES:
            own, around = CLOSES[name]
            places = [p for n in own for p in self.where.get(n, ())[-1:] if p > self.nearest(around)]
            if places:
                self.pop_to(min(places))
        if name in BLOCKS and self.kept is not None and not self.where.get("pre"):
            self.pop_to(min(self.where[n][0] for n in CODE if self.where.get(n)))  # code that was never ended
        if name == "a" and self.where.get("a") and self.where["a"][-1] > self.nearest(("td", "th")):
            self.pop_to(self.where["a"][-1])
        if name == "table" and self.table is not None and not self.writer.flat:
            self.pop_to(self.where["table"][-1])
        if name == "body" and self.where.get("head"):
            self.pop_to(self.where["head"][-1])
        if name in ("html", "meta"):
            self.about(name, tag)
        named = attributes(tag) if self.mute == 0 and (" class" in tag or " id" in tag or "hidden" in tag or name in ("a", "img", "ol")) else {}
        if name in VOID:
            self.void(name, named)
        elif self.mute or name in DROPPED or self.aside(name, named):
            self.mute += 1
            self.push(name, self.unmute)
        elif self.kept is not None:
            self.push(name)
        else:
            self.push(name, self.shown(name, named))

    def unmute(self) -> None:
        self.mute -= 1

    def aside(self, name: str, named: dict[str, str]) -> bool:
        if name in ("html", "body", "main", "article"):
            return False
        if "hidden" in named or named.get("aria-hidden") == "true":
            return True
        return bool(ASIDE.intersection(f"{named.get('class', '')} {named.get('id', '')}".lower().split()))

    def about(self, name: str, tag: str) -> None:
        named = attributes(tag)
        if name == "html" and self.language is None:
            self.language = named.get("lang")
        elif named.get("name", "").lower() == "description" and self.description is None:
            self.description = named.get("content")

    def void(self, name: str, named: dict[str, str]) -> None:
        if self.mute:
            return
        if self.kept is not None:
            if name == "br":
                self.kept.append("\n")
        elif name == "br":
            if self.nearest(HEADINGS) < 0:
                self.writer.hard_break()
            else:
                self.writer.space = True
        elif name == "hr" and not self.writer.flat:
            self.writer.verbatim(["---"])
        elif name == "img" and (source := address(named.get("src"))):
            self.writer.literal(f"![{SPECIAL.sub(r'\\\1', BLANKS.sub(' ', named.get('alt', '')).strip())}]({source})")

    def shown(self, name: str, named: dict[str, str]):
        """Write the start of an element that shows; returns what its end calls."""
        writer = self.writer
        if name in MARKS:
            # Inside a mark of its kind it says nothing more, so few marks are open at a time.
            if any(self.where.get(n) for n, mark in MARKS.items() if mark == MARKS[name]):
                return None
            writer.open(MARKS[name], MARKS[name])
            return writer.close
        if name == "a":
            if not (target := address(named.get("href"))):
                return None
            writer.open("[", f"]({target})")
            return writer.close
        if name in CODE:
            self.kept = []
            return self.inline_code
        if name == "q":
            writer.literal('"')
            return lambda: writer.out.append('"')
        if writer.flat:  # the blocks of a cell run together
            if name == "table":
                self.tables += 1
                return self.inner_table
            if name in BLOCKS or name in ("tr", "td", "th"):
                writer.block()
                return writer.block if name not in ("td", "th") or self.tables > 1 else None
            return None
        if name in ("td", "th") and self.table:
            return self.cell()
        if name == "tr" and self.table is not None:
            self.table.append([])
            return None
        if name == "caption":
            held, self.table = self.table, None
            writer.block()
            return lambda: self.captioned(held)
        if name == "table":
            writer.block()
            self.table, self.tables = [], 1
            return self.whole_table
        if name == "pre":
            self.kept = []
            marked = LANGUAGE_CLASS.search(named.get("class", ""))
            return lambda: self.fenced(marked[1] if marked else "")
        if name in HEADINGS:
            writer.block()
            writer.levels.append(["#" * int(name[1]) + " ", "", False])
            return self.level
        if name == "blockquote":
            writer.block()
            writer.levels.append(["> ", "> ", False])
            return self.level
        if name in LISTS:
            writer.block(1 if self.lists else 2)
            start = named.get("start", "1")
            self.lists.append((int(start) if start.isdecimal() and len(start) < 10 else 1) if name == "ol" else None)
            return self.whole_list
        if name == "li":
            writer.block(1)
            marker = "- "
            if self.lists and self.lists[-1] is not None:
                marker = f"{self.lists[-1]}. "
                self.lists[-1] += 1
            writer.levels.append([marker, " " * len(marker), False])
            return self.item
        if name in BLOCKS:
            writer.block()
            return writer.block
        return None

    def level(self) -> None:
        self.writer.block()
        self.writer.levels.pop()

    def item(self) -> None:
        self.writer.block(1)
        self.writer.levels.pop()

    def whole_list(self) -> None:
        self.lists.pop()
        self.writer.block(1 if self.lists else 2)

    def inline_code(self) -> None:
        text, self.kept = BLANKS.sub(" ", "".join(self.kept or ())).strip(), None
        if text:
            ticks = fence(text, 1)
            pad = " " if text[0] == "`" or text[-1] == "`" else ""
            self.writer.literal(f"{ticks}{pad}{text}{pad}{ticks}")

    def fenced(self, language: str) -> None:
        text, self.kept = "".join(self.kept or ()), None
        lines = text.replace("\r\n", "\n").removeprefix("\n").rstrip().split("\n")
        if lines != [""]:
            ticks = fence(text, 3)
            self.writer.verbatim([ticks + language, *lines, ticks])

    def captioned(self, table) -> None:
        self.writer.block()
        self.table = table

    def inner_table(self) -> None:
        self.tables -= 1
        self.writer.block()

    def cell(self):
        """Text up to the cell's end goes to a line of its own."""
        outer = self.writer
        self.writer = Writer()
        self.writer.flat = True

        def done() -> None:
            self.table[-1].append("".join(self.writer.out))
            self.writer = outer

        return done

    def whole_table(self) -> None:
        rows, self.table, self.tables = [r for r in self.table if any(r)], None, 0
        if rows:
            width = max(map(len, rows))
            lines = [f"| {' | '.join(r + [''] * (width - len(r)))} |" for r in rows]
            self.writer.verbatim([lines[0], "|" + " --- |" * width, *lines[1:]])


def address(url: str | None) -> str:
    """A link's target as Markdown takes it; nothing for scripts and inline data."""
    url = BLANKS.sub("%20", (url or "").strip())
    if url[:11].lower() == "javascript:" or url[:5].lower() == "data:":
        return ""
    return url.replace("(", "%28").replace(")", "%29").replace("<", "%3C").replace(">", "%3E")


def convert(html: str) -> tuple[str, str, str, str | None]:
    """Markdown, title, description and language of a page.

    Headings, paragraphs, nested lists, quotes, tables, code, links, images and emphasis
    keep their form; all character references are decoded; Markdown's own marks in text are
    escaped. What is dropped: scripts, styles, forms, navigation, footers, hidden elements
    and those whose class or id says that they are not content. An inline mark ends with
    its block. Every character is looked at a bounded number of times, however broken the page.
    """
    page, at, absent = Page(), 0, Counter()
    while at < len(html):
        token = TOKEN.match(html, at)
        text, at = token[0], token.end()
        if token.lastgroup == "text":
            page.text(text)
        elif token.lastgroup == "tag":
            name = NAME.match(text)[1].lower()
            if text[1] == "/":
                page.end(name)
                continue
            page.start(name, text)
            if name in RAW:
                # Up to its end tag nothing is markup. A search that failed once isn't made again.
                end = None if absent[name] else re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(html, at)
                absent[name] += end is None
                if name == "title" and page.title is None:
                    page.title = BLANKS.sub(" ", unescape(html[at : end.start() if end else at])).strip()
                at = end.start() if end else len(html) if name in ("script", "style") else at
    page.pop_to(0)
    return "".join(page.writer.out), page.title or "", page.description or "", page.language
