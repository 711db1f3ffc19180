"""Text, blocks and attributes of a piece of markup, on plain strings.

For passes over whole pages: a page's cells are read where its tables are found, in one go. ``text_of``,
``decode_entities`` and ``normalize_text`` give what the column functions of the same names give
(``operators.pages``, ``functions.text``).
"""

from __future__ import annotations

import re
from functools import cache

# Named character references; the ampersand comes last.
ENTITIES = {
    "&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&yen;": "¥", "&copy;": "©", "&reg;": "®", "&middot;": "·",
    "&laquo;": "«", "&raquo;": "»", "&ldquo;": "“", "&rdquo;": "”", "&lsquo;": "‘", "&rsquo;": "’", "&hellip;": "…", "&mdash;": "—", "&ndash;": "–",
    "&times;": "×", "&deg;": "°", "&euro;": "€", "&pound;": "£", "&amp;": "&",
}
BLANKS = " \t\r\n\u3000\u00a0"
#: An attribute value with its quotes.
VALUE = r"""("[^"]*"|'[^']*'|[^\s"'>]+)"""
_TAGS = re.compile(r"<[^>]*>")
_DECIMAL, _HEX = re.compile("&#[0-9]{1,7};"), re.compile("&#[xX][0-9a-fA-F]{1,6};")
# What normalising leaves as it is: no quotes, blanks, controls, commas or backslashes; and what is no markup besides.
_TOUCHED = r"\x00-\x20\x7f-\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\"',\\"
_PLAIN, _PLAIN_MARKUP = re.compile(f"[^{_TOUCHED}]*"), re.compile(f"[^{_TOUCHED}<&]*")
_QUOTES, _BREAKS = re.compile("[\"']"), re.compile(r"[\n\r\t]|\\n|\\r")
_CONTROLS, _SPACES = re.compile("[\x00-\x1f\x7f-\x9f]"), re.compile(r"\s+")


def strip(text: str) -> str:
    return text.strip(BLANKS)


def _numbered(text: str, pattern: re.Pattern, digits_at: int, base: int) -> str:
    done = text
    for reference in dict.fromkeys(pattern.findall(text)):
        number = int(reference[digits_at:-1], base)
        valid = 0 < number < 0x110000 and not 0xD800 <= number <= 0xDFFF
        done = done.replace(reference, chr(number) if valid else "\ufffd")
    return done


def decode_entities(text: str) -> str:
    if "&" not in text:
        return text
    if "&#" in text:
        text = _numbered(_numbered(text, _DECIMAL, 2, 10), _HEX, 3, 16)
    for entity, char in ENTITIES.items():
        text = text.replace(entity, char)
    return text


def text_of(markup: str) -> str:
    return decode_entities(_TAGS.sub("", markup) if "<" in markup else markup)


def normalize_text(text: str) -> str:
    text = strip(text)
    if _PLAIN.fullmatch(text):
        return text
    text = _CONTROLS.sub("", _BREAKS.sub(" ", _QUOTES.sub("", text)))
    return strip(_SPACES.sub(" ", text)).replace(",", "，")


def normal_text_of(markup: str) -> str:
    return markup if _PLAIN_MARKUP.fullmatch(markup) else normalize_text(text_of(markup))


@cache
def _block_tags(tag: str) -> re.Pattern:
    letters = "".join(f"[{c.lower()}{c.upper()}]" for c in tag)
    return re.compile(rf"<(?:({letters})(?=[\s>])|/{letters}\s*>)", re.A)


def blocks(markup: str, tag: str) -> list[str]:
    """Markup of every ``tag`` element, opening tag text included, cut at the next opening or the closing tag."""
    if "<" not in markup:
        return []
    parts = _block_tags(tag).split(markup)
    return [text for opened, text in zip(parts[1::2], parts[2::2], strict=True) if opened]


def inner(block: str) -> str:
    """A block without the rest of its opening tag."""
    return block[block.find(">") + 1 :]


def open_tag(block: str) -> str:
    end = block.find(">")
    return block if end < 0 else block[:end]


@cache
def _attribute_of(name: str) -> re.Pattern:
    return re.compile(rf"(?i)(?<![\w-]){name}\s*=\s*{VALUE}", re.A)


def attribute(opening: str, name: str) -> str:
    """The value of the first attribute of that name, without its quotes, decoded; empty where there is none."""
    found = _attribute_of(name).search(opening)
    if not found:
        return ""
    value = found[1]
    return decode_entities(value[1:-1] if value[0] in "\"'" else value)


def extract(pattern: re.Pattern, text: str) -> str:
    """The first group of the first match, empty where there is none."""
    found = pattern.search(text)
    return found[1] if found else ""
