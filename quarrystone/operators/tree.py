"""A page as a small tree of elements: parents, siblings, rows and columns of tables."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

SKIPPED = {"script", "style", "noscript", "template", "title"}
VOID = {"br", "img", "meta", "link", "input", "hr", "area", "base", "col", "embed", "source", "track", "wbr"}
#: An element of these kinds ends one of the same kind that is still open in the same list, table or description.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "p": {"p"}}
HOLDS = {"ul", "ol", "dl", "table", "div", "section", "article", "body"}
BREAKS = {"p", "div", "li", "br", "tr", "h1", "h2", "h3", "h4", "section", "article", "td", "th", "dt", "dd"}


class Node:
    """An element: tag, attributes, parent, and children, which are elements and strings."""

    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self) -> Iterator[Node]:
        """This element and all below, in the order of the page, whatever their depth."""
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def lines(self) -> str:
        """The text, with line breaks where blocks begin."""
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node)
            elif node.tag not in SKIPPED:
                out.append("\n" if node.tag in BREAKS else "")
                stack.extend(reversed(node.children))
        return "".join(out)

    def text(self) -> str:
        return re.sub(r"\s+", " ", self.lines()).strip()

    def elements(self) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node)]

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def up(self, *tags: str) -> Node | None:
        """The nearest element of a kind around this one, or it."""
        node = self
        while node is not None and node.tag not in tags:
            node = node.parent
        return node

    def after(self) -> list[Node]:
        """Elements behind this one under the same parent."""
        if self.parent is None:
            return []
        beside = self.parent.elements()
        return beside[next(i for i, x in enumerate(beside) if x is self) + 1 :]


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        node = self.at
        while node.parent is not None and tag in CLOSES and node.tag not in HOLDS:
            if node.tag in CLOSES[tag]:
                self.at = node.parent
                if tag != "tr" or node.tag == "tr":
                    break
            node = node.parent
        child = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(child)
        if tag not in VOID:
            self.at = child

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:  # else no such element is open
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parsed(html: str) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root
