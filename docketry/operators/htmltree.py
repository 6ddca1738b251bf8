"""A small HTML tree on the standard library's tokenizer.

Documents in the wild leave end tags out, and what is whose sibling decides section text, so end tags are
implied as browsers do: a block start ends an open paragraph and the inline elements in it, list items, cells,
rows and options end their kind. Comments, scripts and styles give no text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote center dir div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: A start tag ends the nearest open element of these names, unless one of the fences stands between.
ENDS = {"li": ({"li"}, {"ul", "ol"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "tr": ({"tr"}, {"table"}), "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}), "option": ({"option"}, {"select"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "body": ({"head"}, set())}
SILENT = frozenset(("script", "style", "template"))
#: What an end tag of an inline element, and what a start tag that ends a paragraph, does not reach over.
TABLE, AROUND_P, P = frozenset(("table",)), frozenset(("table", "td", "th", "div", "li", "blockquote")), frozenset(("p",))
ANYWHERE, FREE = frozenset(), BLOCK | {"table", "body", "html"}
#: Tags that are no more than a name; those whose content is no markup are left to the tokenizer.
PLAIN_START, PLAIN_END = re.compile(r"<([a-zA-Z][a-zA-Z0-9]*)>"), re.compile(r"</([a-zA-Z][a-zA-Z0-9]*)>")
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript plaintext".split())
NO_ATTRS: dict = {}


class Node:
    """An element, or a text if `tag` is None. `order` numbers nodes as their start stands in the document."""

    __slots__ = ("tag", "attrs", "text", "parent", "kids", "at", "order")

    def __init__(self, tag: str | None, attrs: dict = NO_ATTRS, text: str = ""):
        self.tag, self.attrs, self.text, self.parent, self.at, self.order = tag, attrs, text, None, 0, 0
        self.kids: list[Node] | tuple = () if tag is None else []

    def texts(self) -> Iterator[str]:
        """Text below, in document order."""
        stack = [self]
        while stack:
            node = stack.pop()
            if node.tag is None:
                yield node.text
            elif node is self or node.tag not in SILENT:
                stack.extend(reversed(node.kids))

    def get_text(self, between: str = "") -> str:
        """Stripped pieces joined."""
        kids = self.kids
        if len(kids) == 1 and kids[0].tag is None:
            return kids[0].text.strip()
        return between.join(t for t in map(str.strip, self.texts()) if t)

    def last(self) -> int:
        """The order of the last node below, or its own."""
        node = self
        while node.kids:
            node = node.kids[-1]
        return node.order

    def after(self) -> list["Node"]:
        return self.parent.kids[self.at + 1 :] if self.parent else []

    def before(self, most: int) -> list["Node"]:
        """Earlier siblings, nearest first, and not more than `most`."""
        return self.parent.kids[max(0, self.at - most) : self.at][::-1] if self.parent else []


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open = [Node("[document]")]
        self.nodes: list[Node] = []

    def _place(self, node: Node) -> None:
        """As the last child of the innermost open element, so nodes are made in document order."""
        self.nodes.append(node)
        node.order = len(self.nodes)
        node.parent = self.open[-1]
        kids = node.parent.kids
        node.at = len(kids)
        kids.append(node)

    def _close(self, names, fences=ANYWHERE) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.open[k].tag
            if tag in names:
                del self.open[k:]
                return
            if tag in fences:
                return

    def updatepos(self, i: int, j: int) -> int:
        """Lines and columns are not counted, as nothing here asks for them."""
        return j

    def parse_starttag(self, i: int) -> int:
        plain = PLAIN_START.match(self.rawdata, i)
        if plain is None or (tag := plain[1].lower()) in RAW:
            return super().parse_starttag(i)
        self.handle_starttag(tag, ())
        return plain.end()

    def parse_endtag(self, i: int) -> int:
        plain = None if self.cdata_elem else PLAIN_END.match(self.rawdata, i)
        if plain is None or (tag := plain[1].lower()) in RAW:
            return super().parse_endtag(i)
        self.handle_endtag(tag)
        return plain.end()

    def handle_starttag(self, tag, attrs) -> None:
        if tag in BLOCK:
            self._close(P, AROUND_P)
        if tag in ENDS:
            self._close(*ENDS[tag])
        node = Node(tag, dict(attrs) if attrs else NO_ATTRS)
        self._place(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag) -> None:
        if self.open[-1].tag == tag and len(self.open) > 1:
            self.open.pop()
        else:
            self._close((tag,), ANYWHERE if tag in FREE else TABLE)

    def handle_data(self, data) -> None:
        kids = self.open[-1].kids
        if kids and kids[-1].tag is None:
            kids[-1].text += data
        else:
            self._place(Node(None, text=data))


def parse(html: str) -> list[Node]:
    """Every element and text in document order; those at the top have the document as their parent."""
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.nodes
