"""HTML to text as a page lays it out: a tree builder with implied tags, visibility rules, and a block renderer.

The builder closes what HTML leaves open (list items, paragraphs, cells, rows, the
head) and nests at most ``DEEPEST`` levels, as browsers do.  The renderer walks the
tree without recursion.  It leaves out what is not shown: head, scripts, templates,
what noscript, iframe, object, audio, video, canvas, datalist, noembed and noframes
hold in place of their content, of svg all but its text elements, the annotations of
math, the options of a select that are not shown at first, closed details, and what ``hidden``, ``display`` or ``visibility`` take away,
from style attributes and from rules of the page's own styles for tags, classes, ids and several of them on one element;
important values come before others, a style attribute before rules, ids before classes before tags, and later rules before
earlier ones.  Rules for an element's place in the tree (as ``nav .ad``) are passed over.
Blocks begin on lines of their own, paragraphs and the like stand apart by an empty
line, list items have markers and indents, and table cells are padded to columns; a cell with others to its right is
wrapped between words at ``COLUMN`` characters.
"""

from __future__ import annotations

import html
import re
from collections import Counter

from pyspark.sql import DataFrame

from tidepool.llm.common import map_slices

DEEPEST, COLUMN = 512, 40  # nesting; characters after which a cell is wrapped
MOST_SPAN = {"colspan": 1000, "rowspan": 65534}  # as in the standard of HTML

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript iframe object audio video canvas datalist noembed noframes title".split())
DRAWN_UNSEEN = frozenset("title desc defs metadata symbol clippath mask pattern marker style script".split())  # in svg
HEAD = frozenset("title meta link base script style noscript template".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset hr".split())  # set off by an empty line
BLOCK = APART | frozenset("html body div section article aside header footer nav main address li dt dd tr td th caption thead tbody tfoot "
                          "form details summary figcaption legend center dir menu option optgroup".split())
ENDS_P = APART | frozenset("div section article aside header footer nav main address form details summary center dir menu figcaption".split())
# what a start tag closes, and at which open tag the search for it ends
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "td", "th", "table"}), "dt": ({"dt", "dd"}, {"dl", "td", "th", "table"}),
    "dd": ({"dt", "dd"}, {"dl", "td", "th", "table"}), "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}), "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
}
_TABLE_PARTS = frozenset("table thead tbody tfoot tr td th caption".split())

_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>""")
_OTHER = re.compile(r"<!--(?:-?>|(?s:.*?)--!?>|(?s:.*)\Z)|<[!?/][^>]*>")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_DECLARED = re.compile(r"(?:^|(?<=[;\s]))(display|visibility)\s*:\s*([\w-]+)[^;!]*(!\s*important)?", re.I)
_SELECTOR = re.compile(r"(?:\*|[a-z][\w-]*)?((?:[.#][\w-]+)*)", re.I)


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []

    def get(self, name: str) -> str | None:
        """An attribute's value ('' for one without), or None."""
        if name not in self.attributes.lower():
            return None
        for key, a, b, c in _ATTRIBUTE.findall(self.attributes):
            if key.lower() == name:
                return html.unescape(a or b or c)
        return None


def parse(source: str) -> Node:
    """The tree of a page; text is a string child, spaces as in the source."""
    root = Node("html")
    stack, depth = [root], Counter()

    def pop():
        depth[stack.pop().tag] -= 1

    def close(names, stops) -> bool:
        """Close the innermost open tag of ``names`` and all within, unless one of ``stops`` is further in."""
        for name in names:
            if depth.get(name):
                break
        else:
            return False
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                while len(stack) > i:
                    pop()
                return True
            if stack[i].tag in stops:
                return False
        return False

    def add(text: str):
        if text:
            if stack[-1].tag == "head" and not text.isspace():
                pop()
            stack[-1].children.append(html.unescape(text) if "&" in text else text)

    def start(tag: str, attributes: str):
        if tag in ("html", "body"):
            if stack[-1].tag == "head":
                pop()
            if tag == "html" or depth["body"]:
                return
        if stack[-1].tag == "head" and tag not in HEAD:
            pop()
        if tag in ENDS_P:
            close({"p"}, {"td", "th", "table", "button"})
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag in ("td", "th") and stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
            start("tr", "")
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        if (depth["svg"] or depth["math"] or tag in ("svg", "math")) and attributes.endswith("/"):
            return
        if tag not in VOID and len(stack) < DEEPEST:
            stack.append(node)
            depth[tag] += 1

    at, last = 0, source.rfind(">")
    while True:
        i = source.find("<", at)
        if i < 0 or i > last:
            cut = source.find("<!--", at)  # a comment that nothing closes
            add(source[at:cut] if cut >= 0 else source[at:])
            return root
        found = _TAG.match(source, i)
        if not found:
            other = _OTHER.match(source, i)
            add(source[at:i] if other else source[at:i + 1])
            at = other.end() if other else i + 1
            continue
        add(source[at:i])
        at = found.end()
        slash, name, attributes = found.groups()[:3] if found.group(2) else found.groups()[3:]
        tag = name.lower()
        if slash:
            if tag == "br":
                start("br", "")
            elif tag not in VOID:
                close({tag}, () if tag in _TABLE_PARTS else {"td", "th", "table"})
            continue
        start(tag, attributes)
        if tag in RAW and stack[-1].tag == tag:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(source, at)
            stop = end.start() if end else len(source)
            if tag != "script":
                stack[-1].children.append(source[at:stop] if tag == "style" else html.unescape(source[at:stop]))
            at = stop
            pop()


class Flow:
    """Lines of one block context (the page, or a table cell)."""

    def __init__(self):
        self.lines, self.line, self.gap, self.marker, self.indent = [], [], 0, "", 0

    def _open(self):
        if not self.line:
            if self.gap > 1 and self.lines:
                self.lines.append("")
            self.gap = 0
            self.line.append("  " * self.indent + self.marker)
            if self.marker:
                self.marker = " " * len(self.marker)

    def text(self, text: str):
        if "\n" in text or "  " in text or "\t" in text or "\r" in text or "\f" in text:
            text = _SPACE.sub(" ", text)
        if not self.line or self.line[-1].endswith(" "):
            text = text[1:] if text[:1] == " " else text
        if text:
            self._open()
            self.line.append(text)

    def kept(self, text: str):
        """Preformatted text."""
        for i, part in enumerate(text.split("\n")):
            if i:
                self.turn(1, True)
            if part:
                self._open()
                self.line.append(part)

    def turn(self, gap: int = 1, empty: bool = False):
        """End the line; ``gap`` 2 asks for an empty line before the next; ``empty`` ends an empty line too."""
        if self.line:
            self.lines.append("".join(self.line).rstrip(" "))
            self.line = []
        elif empty:
            self.lines.append("")
        self.gap = max(self.gap, gap)

    def block(self, lines: list[str]):
        for line in lines:
            self._open()
            self.line.append(line)
            self.turn()

    def end(self) -> list[str]:
        self.turn()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def _number(text: str | None, least: int, most: int, otherwise: int) -> int:
    """A whole number held between two bounds, whatever its number of digits."""
    found = re.match(r"\s*([+-]?)0*([0-9]+)", text or "")
    if not found:
        return otherwise
    value = int(found[2]) if len(found[2]) < 10 else 10 ** 10
    return min(max(-value if found[1] == "-" else value, least), most)


def _span(node: Node, name: str) -> int:
    return _number(node.get(name), 1, MOST_SPAN[name], 1)


def _wrapped(lines: list[str]) -> list[str]:
    """Lines cut between words so that they have at most ``COLUMN`` characters, or one word."""
    out = []
    for line in lines:
        while len(line) > COLUMN:
            cut = line.rfind(" ", 1, COLUMN + 1)
            if cut < 0 or not line[:cut].strip(" "):
                cut = line.find(" ", len(line) - len(line.lstrip(" ")))
                if cut < 0:
                    break
            out.append(line[:cut].rstrip(" "))
            line = line[cut + 1:]
        out.append(line)
    return out


def draw_table(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Lines of a table given as rows of cells (lines, columns spanned, rows spanned)."""
    placed, busy = [], {}  # busy: columns still taken by a cell of an earlier row
    for row in rows:
        out, col = [], 0
        for nth, (lines, wide, high) in enumerate(row, 1):
            while busy.get(col, 0) > 0:
                col += 1
            out.append((col, wide, _wrapped(lines) if nth < len(row) else lines))
            for c in range(col, col + wide):
                busy[c] = busy.get(c, 0) + high
            col += wide
        placed.append(out)
        busy = {c: n - 1 for c, n in busy.items() if n > 1}
    widths: dict[int, int] = {}
    for row in placed:
        for nth, (col, wide, lines) in enumerate(row, 1):
            size = max(map(len, lines), default=0)
            widths.setdefault(col, 0)
            # a last cell needs no width; a longer word than the column pushes only its own row
            if wide == 1 and (nth < len(row) or size <= COLUMN):
                widths[col] = max(widths[col], min(size, COLUMN))
    starts, at = {}, 0
    for col in range(max(widths, default=-1) + 1):
        starts[col] = at
        at += widths.get(col, 0) + (2 if widths.get(col) else 0)
    out = []
    for row in placed:
        for i in range(max((len(lines) for _, _, lines in row), default=0)):
            line = ""
            for col, _, lines in row:
                if i < len(lines) and lines[i]:
                    line = line.ljust(starts[col]) if len(line) < starts[col] or not line else line + "  "
                    line += lines[i]
            out.append(line.rstrip(" "))
    return out


def _keep_shown(node: Node) -> None:
    """Of a drawing keep the text elements, of a formula all but its annotations, of a choice the option shown."""
    if node.tag == "select":
        options, todo = [], list(reversed(node.children))
        while todo:
            child = todo.pop()
            if isinstance(child, Node):
                if child.tag == "option":
                    options.append(child)
                else:
                    todo.extend(reversed(child.children))
        size = node.get("size") or ""
        if node.get("multiple") is not None or size.isascii() and size.isdigit() and size.strip("0") not in ("", "1"):
            node.children = options
        else:
            chosen = [o for o in options if o.get("selected") is not None][-1:] or options[:1]
            node.children = [c for o in chosen for c in o.children]
        return
    todo = [node]
    while todo:
        at = todo.pop()
        if at.tag in ("annotation", "annotation-xml") or node.tag == "svg" and at.tag in DRAWN_UNSEEN:
            at.children = []
        elif node.tag == "svg" and at.tag in ("text", "foreignobject"):
            at.children = [" ", *(c for c in at.children if isinstance(c, str) or c.tag not in DRAWN_UNSEEN), " "]
        else:
            if node.tag == "svg":
                at.children = [c for c in at.children if isinstance(c, Node)]
            todo.extend(c for c in at.children if isinstance(c, Node))


def _on_screen(media: str) -> bool:
    """Whether a media list surely holds for a screen: it names one or all, or is empty; conditions do not count."""
    return not media.strip() or any(re.fullmatch(r"\s*(?:only\s+)?(?:screen|all)\s*", m, re.I) for m in media.split(","))


def _rules(css: str):
    """(selectors, declarations) of the rules that hold without a condition, in order; blocks are found by brace depth."""
    css = re.sub(r"/\*.*?(?:\*/|\Z)", " ", css, flags=re.S)
    held, at = [], 0  # of each open block: whether rules within it hold, its selectors if it is a rule itself, its declarations
    for brace in re.finditer(r"[{};]", css):
        text, sign = css[at:brace.start()], brace.group()
        at = brace.end()
        if sign == "{":
            head = text.strip()
            rule = re.match(r"@([\w-]+)(.*)", head, re.S)
            inner = rule and (rule[1].lower() == "layer" or rule[1].lower() == "media" and _on_screen(rule[2]))
            around = not held or held[-1][0] and held[-1][1] is None  # a rule within a rule is one for a place in the tree
            held.append((around and (not rule or bool(inner)), None if rule else head, []))
        elif held:
            held[-1][2].append(text)
            if sign == "}":
                holds, head, declared = held.pop()
                if holds and head is not None:
                    yield head, ";".join(declared)


class Styles:
    """What a page's own rules say of display and visibility, found by the last name of a selector."""

    def __init__(self, root: Node):
        self.by_name: dict[str, list[tuple]] = {}
        nodes: list = [root]
        count = 0
        while nodes:
            node = nodes.pop()
            if isinstance(node, str):
                continue
            if node.tag == "style" and _on_screen(node.get("media") or ""):
                for selectors, body in _rules("".join(c for c in node.children if isinstance(c, str))):
                    declared = _DECLARED.findall(body)
                    for selector in selectors.split(",") if declared else ():
                        names = self._names(selector.strip())
                        for name, value, important in declared if names else ():
                            count += 1
                            weight = (bool(important), sum(n[0] == "#" for n in names), sum(n[0] == "." for n in names), sum(n[0] not in ".#*" for n in names), count)
                            self.by_name.setdefault(names[-1], []).append((frozenset(names), name.lower(), value.lower(), weight))
            nodes.extend(reversed(node.children))

    @staticmethod
    def _names(selector: str) -> list[str]:
        """Tag, classes and ids that a selector asks of one element; none for selectors of other kinds."""
        found = _SELECTOR.fullmatch(selector) if selector else None
        if not found:
            return []
        tag = selector[:found.start(1)].lower()
        return ([tag] if tag else []) + re.findall(r"[.#][\w-]+", found[1])

    def of(self, node: Node) -> dict[str, str]:
        """display and visibility of an element, where its rules, its style attribute or ``hidden`` give them."""
        best: dict[str, tuple] = {}

        def say(name, value, weight):
            if name not in best or weight > best[name][0]:
                best[name] = (weight, value)

        if node.attributes and node.get("hidden") is not None:
            say("display", "none", (False, -1, 0, 0, 0))
        if self.by_name:
            names = {node.tag, "*"}
            if node.attributes:
                names.update("." + c for c in (node.get("class") or "").split())
                if node.get("id"):
                    names.add("#" + node.get("id"))
            for last in names & self.by_name.keys():
                for needed, name, value, weight in self.by_name[last]:
                    if needed <= names:
                        say(name, value, weight)
        if node.attributes and (style := node.get("style")):
            for nth, (name, value, important) in enumerate(_DECLARED.findall(style)):
                say(name.lower(), value.lower(), (bool(important), 1 << 20, 0, 0, nth))
        return {name: value for name, (_, value) in best.items()}


_FAR = 10 ** 9


def _numbering(node: Node) -> tuple[int, int]:
    """First number and step of a numbered list; a reversed one counts down to 1."""
    down = node.get("reversed") is not None
    items = sum(isinstance(c, Node) and c.tag == "li" for c in node.children)
    return _number(node.get("start"), -_FAR, _FAR, items if down else 1), -1 if down else 1


def render(source: str | None) -> str:
    """The visible text of a page; '' for none."""
    return render_tree(parse(source)) if source else ""


def render_tree(root: Node) -> str:
    """The visible text of a parsed page; takes what is not shown out of the tree."""
    styles = Styles(root)
    flow = Flow()
    flows, tables, lists = [], [], []
    todo: list = [(root, False, False, True)]  # node, hidden, preformatted, entering
    while todo:
        node, unseen, fixed, entering = todo.pop()
        if isinstance(node, str):
            if not unseen:
                flow.kept(node) if fixed else flow.text(node)
            continue
        tag = node.tag
        if entering:
            if tag in UNSEEN:
                continue
            if node.attributes or styles.by_name:
                said = styles.of(node)
                if said.get("display") == "none":
                    continue
                if "visibility" in said and said["visibility"] != "inherit":
                    unseen = said["visibility"] in ("hidden", "collapse")
            if tag == "br":
                flow.turn(1, not flow.line)
                continue
            if tag in BLOCK and tag not in ("td", "th"):
                flow.turn(2 if tag in APART and not (tag in ("ul", "ol") and lists) else 1)
            if tag in ("svg", "math", "select"):
                _keep_shown(node)
            children = node.children
            if tag == "details" and node.get("open") is None:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
            if tag in ("ul", "ol", "menu", "dir"):
                lists.append(_numbering(node) if tag == "ol" else None)
            elif tag == "li":
                flow.indent = max(len(lists) - 1, 0)
                flow.marker = "- "
                if lists and lists[-1]:
                    number, step = lists[-1]
                    number = _number(node.get("value"), -_FAR, _FAR, number) if node.attributes else number
                    flow.marker = f"{number}. "
                    lists[-1] = (number + step, step)
            elif tag == "table":
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in ("td", "th", "caption") and tables:
                flows.append((flow, lists))
                flow, lists = Flow(), []
            elif tag in ("td", "th"):
                flow.turn()
            todo.append((node, unseen, fixed, False))
            fixed = fixed or tag in ("pre", "xmp", "textarea")
            todo.extend((c, unseen, fixed, True) for c in reversed(children))
            continue
        if tag in ("ul", "ol", "menu", "dir"):
            lists.pop()
            flow.turn(1 if lists else 2)
            flow.indent, flow.marker = max(len(lists) - 1, 0), ""
        elif tag == "li":
            flow.turn()
            flow.marker = ""
            flow.indent = 0 if not lists else max(len(lists) - 1, 0)
        elif tag in ("td", "th", "caption") and tables:
            lines = flow.end()
            flow, lists = flows.pop()
            if tag == "caption":
                flow.block(lines)
            else:
                if not tables[-1]:
                    tables[-1].append([])
                tables[-1][-1].append((lines, _span(node, "colspan"), _span(node, "rowspan")))
        elif tag == "table":
            flow.block(draw_table(tables.pop()))
            flow.turn(2)
        elif tag in BLOCK:
            flow.turn(2 if tag in APART else 1)
    return "\n".join(flow.end()).strip("\n")


def _rendering():
    def step(cols):
        texts = [render(h) for h in cols["html"]]
        return {"page_id": cols["page_id"], "text": texts, "n_chars": [len(t) for t in texts]}
    return step


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, text, n_chars) of every row of ``pages`` (page_id, html; other columns are not read).

    A null or empty page, and one without visible text, gives an empty text; null ids
    and repeated rows are rendered like any other; an empty table gives an empty result.
    """
    return map_slices(pages.select("page_id", "html"), lambda: _rendering(), "page_id long, text string, n_chars long")
