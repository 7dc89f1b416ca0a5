"""What a reader sees of an HTML page, as lines."""

from __future__ import annotations

import re
from html.parser import HTMLParser

# Element names of HTML.
_UNSEEN = frozenset({"script", "style", "head", "template", "svg", "select", "textarea"})
_CHROME = frozenset({"nav", "header", "footer", "aside"})
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr b bdi bdo cite code em i kbd label mark q s small span strong sub sup time u var".split())
_none = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, str]] = []
        self.text: dict[str, list[str]] = {"main": [], "chrome": [], "noscript": []}

    def _state(self) -> str:
        return self.stack[-1][1] if self.stack else "main"

    def _put(self, s: str) -> None:
        if (state := self._state()) in self.text:
            self.text[state].append(s)

    def handle_starttag(self, tag, attrs):
        if tag not in _INLINE:
            self._put("\n")
        if tag in _VOID:
            return
        a, state = dict(attrs), self._state()
        if state == "unseen" or tag in _UNSEEN or "hidden" in a or a.get("aria-hidden") == "true" or _none.search(a.get("style") or ""):
            state = "unseen"
        elif tag == "noscript":
            state = "noscript"
        elif tag in _CHROME and state == "main":
            state = "chrome"
        self.stack.append((tag, state))

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                break
        if tag not in _INLINE:
            self._put("\n")

    def handle_data(self, data):
        self._put(data)


def visible(html: str) -> str:
    """The text outside menus and footers that is shown; if there is none, what readers without scripts are shown. Line breaks stand between blocks."""
    reader = _Reader()
    reader.feed(html)
    reader.close()
    shown = "".join(reader.text["main"])
    shown = shown if shown.strip() else "".join(reader.text["noscript"])
    return "\n".join(s for line in shown.split("\n") if (s := " ".join(line.split())))
