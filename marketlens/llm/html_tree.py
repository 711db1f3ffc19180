"""A small tolerant HTML reader: elements as a tree, whatever is left open."""

from __future__ import annotations

import hashlib
import re
from html import unescape

#: Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements that a start tag closes first, and the elements that stop the search.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)), "tbody": (("tbody", "thead", "tr", "td", "th"), ("table",)), "tfoot": (("tbody", "thead", "tr", "td", "th"), ("table",)),
    "body": (("head",), ()),
}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


class Element:
    __slots__ = ("tag", "attributes", "children", "digest", "holds_article")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children, self.digest, self.holds_article = tag, attributes, [], 0, False

    def attribute_map(self) -> dict[str, str]:
        """Attributes by lower-case name; the first of a name counts."""
        found: dict[str, str] = {}
        for name, *values in _ATTRIBUTE.findall(self.attributes):
            found.setdefault(name.lower(), unescape("".join(values)))
        return found


def parse(html: str) -> Element:
    """The tree under an unnamed root; text nodes are undecoded strings."""
    root = Element("")
    stack, at = [root], 0
    search = _TAG.search
    while match := search(html, at):
        if match.start() > at:
            stack[-1].children.append(html[at : match.start()])
        at = match.end()
        tag = match[2]
        if tag is None:
            continue
        tag = tag.lower()
        if match[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        if tag in BLOCK:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag in BLOCK or stack[i].tag == "button":
                    break
        if tag in CLOSES:
            closed, stops = CLOSES[tag]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in stops:
                    break
                if stack[i].tag in closed:
                    del stack[i:]
        element = Element(tag, match[3])
        stack[-1].children.append(element)
        if tag == "article" and not any(outer.tag == "article" for outer in stack):
            for outer in stack:
                outer.holds_article = True
        if tag in RAW:
            end = re.compile(rf"</{tag}\b", re.I).search(html, at)
            stop = end.start() if end else len(html)
            element.children.append(html[at:stop])
            close = html.find(">", stop)
            at = close + 1 if end and close >= 0 else len(html)
        elif tag not in VOID and not match[3].endswith("/"):
            stack.append(element)
    if at < len(html):
        stack[-1].children.append(html[at:])
    return root


def hash_subtrees(root: Element) -> None:
    """Set ``digest`` of every element: tag, class and id, and what is inside, blanks folded."""
    todo = [(root, False)]
    while todo:
        element, inside_done = todo.pop()
        if not inside_done:
            todo.append((element, True))
            todo.extend((c, False) for c in element.children if type(c) is Element)
            continue
        named = element.attribute_map() if element.attributes.strip() else {}
        state = hashlib.blake2b(f"{element.tag}\0{named.get('class', '')}\0{named.get('id', '')}\0{named.get('href', '')}".encode(errors="replace"), digest_size=8)
        for child in element.children:
            if type(child) is Element:
                state.update(b"\1" + child.digest.to_bytes(8, "little", signed=True))
            elif text := " ".join(child.split()):
                state.update(b"\2" + text.encode(errors="replace"))
        element.digest = int.from_bytes(state.digest(), "little", signed=True)
