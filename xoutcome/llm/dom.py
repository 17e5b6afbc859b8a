"""Text blocks of raw HTML with the path of the elements around them."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.parser import HTMLParser

# Fixed values of the HTML standard and of common page markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
SPACE = frozenset("br hr".split())
NOISE_TAGS = frozenset("head nav header footer aside form script style noscript template iframe object embed svg canvas button select "
                       "option textarea input dialog menu audio video map frameset title".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert form".split())
NOISE_WORDS = frozenset("ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies "
                        "consent gdpr notice notices popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs pagination "
                        "pager header masthead footer sidebar aside widget widgets related recommended comment comments commentlist "
                        "respond disqus replies reply share sharing social newsletter subscribe signup login form search toolbar".split())
MAIN_TAGS = frozenset("article main".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
           "option": {"option"}, "body": {"head"}}
_SCOPE = frozenset("ul ol dl table article section div main aside nav header footer form body html blockquote fieldset".split())
_CLOSE_P = frozenset("address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 "
                     "h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul".split())
_DIGITS = re.compile(r"\d+")
_TOKENS = re.compile(r"[^a-z0-9]+")


@dataclass
class Block:
    path: str  # elements from the root, inline ones left out, as tag.class
    noise: bool  # inside an element whose markup says that it is no article text
    main: bool  # inside an article or main element
    text: str


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, str, bool, bool]] = []  # tag, path, noise, main
        self.blocks: list[Block] = []
        self.children: dict[str, list[str]] = {}
        self.held: list[str] = []

    def flush(self) -> None:
        text = " ".join("".join(self.held).split())
        self.held.clear()
        if text:
            _, path, noise, main = next((e for e in reversed(self.stack) if e[0] not in INLINE), ("", "", False, False))
            self.blocks.append(Block(path, any(e[2] for e in self.stack[-1:]) or noise, main, text))

    def handle_starttag(self, tag, attrs):
        if tag in SPACE:
            self.held.append(" ")
        if tag in INLINE and tag not in NOISE_TAGS:
            if tag not in VOID:
                own = self.stack[-1] if self.stack else ("", "", False, False)
                noisy = own[2] or self._noisy(tag, attrs)
                if noisy and not own[2]:
                    self.flush()
                self.stack.append((tag, own[1], noisy, own[3]))
            return
        if tag == "br":
            return
        self.flush()
        if tag in _CLOSE_P:
            self._close({"p"})
        if tag in _CLOSES:
            self._close(_CLOSES[tag])
        if tag in VOID:
            return
        outer = next((e for e in reversed(self.stack) if e[0] not in INLINE), ("", "", False, False))
        name = self._name(tag, attrs)
        self.children.setdefault(outer[1], []).append(name)
        self.stack.append((tag, f"{outer[1]}/{name}", outer[2] or self._noisy(tag, attrs), outer[3] or tag in MAIN_TAGS
                           or dict(attrs).get("role") == "main"))

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        k = next((k for k in range(len(self.stack) - 1, -1, -1) if self.stack[k][0] == tag), None)
        if k is None:
            return
        if tag in INLINE:
            noisy = self.stack[k][2] and not (k and self.stack[k - 1][2])
            if any(e[0] not in INLINE for e in self.stack[k + 1:]):
                return
            if noisy:
                self.flush()
        else:
            self.flush()
        del self.stack[k:]

    def handle_data(self, data):
        self.held.append(data)

    def _close(self, tags) -> None:
        """Close the innermost open element of ``tags``, unless a container lies between."""
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] in tags:
                del self.stack[k:]
                return
            if self.stack[k][0] in _SCOPE:
                return

    @staticmethod
    def _name(tag, attrs) -> str:
        own = {k: v or "" for k, v in attrs}
        mark = " ".join(sorted(own.get("class", "").split())) or own.get("id", "")
        return tag + ("." + _DIGITS.sub("0", mark.replace("/", "_")) if mark else "")

    @staticmethod
    def _noisy(tag, attrs) -> bool:
        if tag in NOISE_TAGS:
            return True
        if tag in MAIN_TAGS or tag in ("body", "html"):
            return False
        own = {k: (v or "").lower() for k, v in attrs}
        if own.get("role") in NOISE_ROLES or "hidden" in own or own.get("aria-hidden") == "true":
            return True
        words = set(_TOKENS.split(own.get("class", "") + " " + own.get("id", "")))
        return bool(words & NOISE_WORDS) and not words & {"with", "has", "no", "without"}  # "content with-sidebar" is no sidebar


def read(html: str) -> tuple[list[Block], dict[str, list[str]]]:
    """The text blocks in page order, and under each path the elements that follow in turn."""
    reader = _Reader()
    reader.feed(html)
    reader.close()
    reader.flush()
    return reader.blocks, reader.children
