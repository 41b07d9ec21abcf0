"""Main text of an HTML page as markdown, with the standard library's parser."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd

from pageatlas.functions.arrow import arrow_function

#: Elements whose text is no content, elements that hold none, and those that break lines.
DROPPED = frozenset("script style nav footer header aside form noscript template svg button select iframe head".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BREAKING = frozenset("p div section article main ul ol li table tr h1 h2 h3 h4 h5 h6 blockquote pre figure dl dt dd address".split())


class _Reader(HTMLParser):
    def __init__(self, fragment: str | None):
        super().__init__(convert_charrefs=True)
        self.fragment, self.depth, self.inside = fragment, 0, fragment is None
        self.start = -1
        self.open: list[str] = []
        self.dropped = 0
        self.out: list[str] = []
        self.found = False

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag == "br" and self.inside and not self.dropped:
                self.out.append("\n")
            return
        self.open.append(tag)
        if self.fragment is not None and not self.found and dict(attrs).get("id") == self.fragment:
            self.inside = self.found = True
            self.start = len(self.open)
        if tag in DROPPED and self.inside and len(self.open) != self.start:
            self.dropped += 1
        if self.inside and not self.dropped and tag in BREAKING:
            self.out.append("\n\n" if tag not in ("li", "tr") else "\n")
            self.out.append({"li": "- ", "blockquote": "> "}.get(tag, "#" * int(tag[1]) + " " if tag[0] == "h" and tag[1:].isdigit() else ""))
        elif self.inside and not self.dropped and tag in ("td", "th"):
            self.out.append(" | ")

    def handle_endtag(self, tag):
        if tag not in self.open:
            return
        while self.open:  # what was left open ends with it
            t = self.open.pop()
            if t in DROPPED and self.inside and len(self.open) + 1 != self.start:
                self.dropped -= 1
            if self.inside and self.start > len(self.open):
                self.inside = False
            if self.inside and not self.dropped and t in BREAKING:
                self.out.append("\n")
            if t == tag:
                return

    def handle_data(self, data):
        if self.inside and not self.dropped:
            pre = "pre" in self.open
            self.out.append(data if pre else " ".join(data.split()).join((" " if data[:1].isspace() else "", " " if data[-1:].isspace() else "")))


def main_text_of(url: str, html: str | bytes) -> str:
    """The page's text as markdown without navigation and frame. A fragment of the url selects the
    element of that id where there is one."""
    if isinstance(html, bytes):
        html = html.decode("utf-8", "replace")
    fragment = url.partition("#")[2] or None
    for f in ([fragment, None] if fragment else [None]):
        r = _Reader(f)
        r.feed(html)
        r.close()
        if f is None or r.found:
            break
    lines = [" ".join(x.split()) for x in "".join(r.out).split("\n")]
    kept, blank = [], True
    for x in lines:
        if x in ("", "-", ">", "|") or not x.strip("# "):
            blank = True
            continue
        if blank and kept:
            kept.append("")
        kept.append(x.lstrip("| ") if x.startswith("|") else x)
        blank = False
    return "\n".join(kept)


@arrow_function("string")
def main_text(url: pd.Series, html: pd.Series) -> pd.Series:
    """``main_text_of`` per row; null html stays null."""
    return pd.Series([None if h is None else main_text_of(u or "", h) for u, h in zip(url, html)])
