"""The links of an HTML page, found in one pass over its text.

A page is read left to right as the HTML standard's tokenizer does: comments, declarations and
the text of raw elements hold no tags, quoted attribute values may hold anything, a tag
that the page does not end is no tag. Every step matches one simple class of characters from where
the last one ended, so time grows with the page's length whatever the markup.
"""

from __future__ import annotations

import html
import re

# Elements whose content is text up to their end tag.
RAW_TEXT = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")

_SPACE = "\t\n\r\f "
_OPEN = re.compile(rf"<(?:([a-zA-Z][^{_SPACE}/>]*)|(/[a-zA-Z]|!--|[!?/]))")
_GAP = re.compile(rf"[{_SPACE}/]*")
_NAME = re.compile(rf"[^{_SPACE}/>][^{_SPACE}/>=]*")
_EQUALS = re.compile(rf"[{_SPACE}]*=[{_SPACE}]*")
_BARE = re.compile(rf"[^{_SPACE}>]*")
_COMMENT_END = re.compile("--!?>")
_RAW_END = {name: re.compile(rf"</{name}(?=[{_SPACE}/>])", re.IGNORECASE) for name in RAW_TEXT}


def _tag(page: str, at: int, wanted: str | None) -> tuple[int, str | None]:
    """The end of the tag whose attributes begin at ``at``, and the raw value of its last attribute
    named ``wanted``; -1 if the page does not end the tag."""
    value = None
    while True:
        at = _GAP.match(page, at).end()
        name = _NAME.match(page, at)
        if not name:  # the tag or the page ends here
            return (at + 1 if at < len(page) else -1), value
        at, held = name.end(), None
        equals = _EQUALS.match(page, at)
        if equals:
            at = equals.end()
            quote = page[at:at + 1]
            if quote in ("'", '"'):
                close = page.find(quote, at + 1)
                if close < 0:
                    return -1, None
                held, at = page[at + 1:close], close + 1
            else:
                bare = _BARE.match(page, at)
                held, at = bare.group(), bare.end()
        if wanted and name.group().lower() == wanted:
            value = held


def hrefs(page: str | None) -> list[str]:
    """The href of every ``<a>`` in document order, character references decoded; of
    repeated attributes the last counts, an href without a value is none."""
    found, at = [], 0
    page = page or ""
    while True:
        opened = _OPEN.search(page, at)
        if not opened:
            return found
        at = opened.end()
        name, other = opened.groups()
        if name is None and other in ("!", "?", "/"):
            at = page.find(">", at) + 1
        elif other == "!--":
            if page.startswith((">", "->"), at):
                at = page.find(">", at) + 1
            else:
                end = _COMMENT_END.search(page, at)
                at = end.end() if end else 0
        else:
            name = (name or "").lower()
            at, value = _tag(page, at, "href" if name == "a" else None)
            if value is not None and at > 0:
                found.append(html.unescape(value))
            if name in _RAW_END and at > 0:
                end = _RAW_END[name].search(page, at)
                at = end.start() if end else 0
        if at <= 0:  # it lasts to the end of the page
            return found
