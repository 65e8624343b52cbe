"""Per-page helper: find product cards in search-result HTML.

Small on purpose: one regex tokenizer walks a page's markup and returns the raw
text of the few tags the extraction reads. No typing, trimming of numbers or
validation happens here; those are native Spark expressions afterwards.

Tag text follows the usual "strip every text node, join with nothing" rule;
character references are decoded in text and attribute values; tag and
attribute names are case-insensitive; an end tag closes any unclosed tags
opened after its start tag; a stray end tag is ignored; comments hold nothing.
A card inside a card is a card of its own, and part of the outer one too.
Tag choice:
  * card: ``div`` whose ``data-component-type`` is ``s-search-result``
  * class match: a class string matches a tag when it equals the tag's class
    attribute (runs of blanks count as one), or is one of its class tokens
  * names: first ``span.a-size-medium``, first ``span.a-size-base-plus``,
    first ``h2`` (each reported separately; NULL = absent)
  * brand: first span with class ``a-size-base-plus a-color-base``
  * price: ``span.a-price-whole``; MRP: ``span.a-offscreen`` inside the first
    ``span`` with class ``a-price a-text-price``
  * rating: ``span.a-icon-alt``; reviews: ``span.a-size-base`` with dir=auto
  * sponsored: a span whose own string holds "sponsored": its only child is
    that text, or a tag whose own string it is
"""

from __future__ import annotations

import html as _html
import re

# Markup contract of a search-result card.
CARD_ATTR = ("data-component-type", "s-search-result")
NAME_CLASSES = ("a-size-medium", "a-size-base-plus")
BRAND_CLASS = "a-size-base-plus a-color-base"
PRICE_CLASS = "a-price-whole"
MRP_BLOCK_CLASS = "a-price a-text-price"
MRP_CLASS = "a-offscreen"
RATING_CLASS = "a-icon-alt"
REVIEWS_CLASS = "a-size-base"
SPONSORED_WORD = "sponsored"

VOID = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
                  "param", "source", "track", "wbr"})

FIELDS = ("asin_attr", "name_medium", "name_base_plus", "name_h2", "brand_text",
          "price_text", "mrp_text", "rating_text", "reviews_text")

# One token per match; the groups say which kind:
#   1 raw  - script/style element with its body (an element child, no text)
#   2 skip - comment, doctype or processing instruction
#   3 name and 4 attribute text of a start tag; 5 leaf - its text, if nothing
#     else stands before its own end tag, which is then part of the match
#   6 name of an end tag
#   7 text - character data (a stray "<" counts as text)
_TOKEN = re.compile(
    r"(<(?:script|style)\b(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?:script|style)\s*>|\Z))"
    r"|(<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>)"
    r"|<([A-Za-z][A-Za-z0-9:_-]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>(?:([^<]++)</\3>)?"
    r"|</([A-Za-z][A-Za-z0-9:_-]*)(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>"
    r"|([^<]+|<)", re.S | re.I)
# Attributes from left to right: name, then a double-quoted, quoted or bare value.
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


def _attributes(text: str) -> dict[str, str]:
    """Attributes of a start tag; of a repeated one the first counts."""
    out: dict[str, str] = {}
    for m in _ATTR.finditer(text):
        value = next((v for v in m.groups()[1:] if v is not None), None)
        if value is not None:
            out.setdefault(m[1].lower(), _html.unescape(value) if "&" in value else value)
    return out


# Roles of a tag besides the fields it may fill: the tag that an MRP is read in.
_MRP_BLOCK = "mrp_block"


def _roles(tag: str, attr_text: str) -> tuple[str, ...]:
    """What a span or h2 with these attributes may be to a card, in order of
    capture."""
    if tag == "h2":
        return ("name_h2",)
    attrs = _attributes(attr_text)
    if "class" not in attrs:
        return ()
    tokens = attrs["class"].split()
    whole = " ".join(tokens)
    roles = (("name_medium", NAME_CLASSES[0] in tokens),
             ("name_base_plus", NAME_CLASSES[1] in tokens),
             ("brand_text", whole == BRAND_CLASS),
             ("price_text", PRICE_CLASS in tokens),
             ("rating_text", RATING_CLASS in tokens),
             ("reviews_text", REVIEWS_CLASS in tokens and attrs.get("dir") == "auto"),
             (_MRP_BLOCK, whole == MRP_BLOCK_CLASS),
             ("mrp_text", MRP_CLASS in tokens))
    return tuple(role for role, holds in roles if holds)


class _Card:
    """Field capture for one open card; ``depth`` is that of its div, ``texts``
    the page's texts so far: a capture is the texts from its start to its end."""

    def __init__(self, asin: str | None, depth: int, texts: list[str]):
        self.fields = dict.fromkeys(FIELDS)
        self.fields.update(asin_attr=asin, sponsored=False, broken=False)
        self.depth, self.texts = depth, texts
        # captures under way: first text by field, and the fields that end at each depth
        self.captures: dict[str, int] = {}
        self.ends: dict[int, list[str]] = {}
        self.mrp_depth, self.mrp_seen = -1, False

    def _capture(self, field: str, depth: int) -> None:
        if self.fields[field] is None and field not in self.captures:
            self.captures[field] = len(self.texts)
            self.ends.setdefault(depth, []).append(field)

    def start(self, tag: str, roles: tuple[str, ...], depth: int) -> None:
        for role in roles:
            if role == _MRP_BLOCK:
                if not self.mrp_seen:
                    self.mrp_seen, self.mrp_depth = True, depth
                    self.ends.setdefault(depth, [])
            elif role != "mrp_text" or self.mrp_depth >= 0:
                self._capture(role, depth)

    def end(self, depth: int) -> None:
        if self.mrp_depth == depth:
            self.mrp_depth = -1
        for field in self.ends.pop(depth, ()):
            self.fields[field] = "".join(self.texts[self.captures.pop(field):])


class _Page:
    """The open elements and the open cards of one page.

    A token costs the same however many elements are open: ``tags`` counts the
    open elements of each tag, so an end tag without a start is known at once,
    and ``ending`` names the cards that wait for the end of a depth. Only cards
    inside cards are visited one by one."""

    def __init__(self):
        self.cards: list[_Card] = []      # all, in page order
        self.open: list[_Card] = []       # a stack: an inner card is deeper
        self.texts: list[str] = []        # stripped, since the outermost open card began
        # per element: tag, children, own string, last child is text. The string
        # is a list of text parts, or, from an only child, whether it holds the word
        self.stack: list[list] = []
        self.tags: dict[str, int] = {}
        self.ending: dict[int, list[_Card]] = {}
        self.flagged = 0                  # open cards, from the outermost, known as sponsored
        # cards of a page repeat the same few start tags: each is read once
        self.roles: dict[tuple[str, str], tuple[str, ...]] = {}

    def _step(self, card: _Card, step: str, *args) -> None:
        """One event for one card; a card that fails is marked broken."""
        try:
            getattr(card, step)(*args)
        except Exception:  # noqa: BLE001 - one card must not cost the others
            card.fields["broken"] = True

    def _child(self, string=None) -> None:
        if self.stack:
            top = self.stack[-1]
            top[1] += 1
            top[2], top[3] = string, False

    def text(self, data: str) -> None:
        if not self.open:
            return
        data = _html.unescape(data) if "&" in data else data
        top = self.stack[-1]
        if top[3]:
            top[2].append(data)
        else:
            self._child([data])
            top[3] = True
        if data.strip():
            self.texts.append(data.strip())

    def _look(self, tag: str, attr_text: str, depth: int) -> None:
        """Shows a start tag at this depth to the open cards."""
        roles = self.roles.get((tag, attr_text))
        if roles is None:
            roles = self.roles[tag, attr_text] = _roles(tag, attr_text)
        if roles:
            for card in self.open:
                self._step(card, "start", tag, roles, depth)
                if depth in card.ends:
                    self.ending.setdefault(depth, []).append(card)

    def start(self, tag: str, attr_text: str) -> None:
        if tag in VOID or attr_text.endswith("/"):
            self._child()
            return
        depth = len(self.stack)
        if self.open and (tag == "span" or tag == "h2"):
            self._look(tag, attr_text, depth)
        self._child()
        self.stack.append([tag, 0, None, False])
        self.tags[tag] = self.tags.get(tag, 0) + 1
        attrs = _attributes(attr_text) if tag == "div" and CARD_ATTR[1] in attr_text else {}
        if attrs.get(CARD_ATTR[0]) == CARD_ATTR[1]:
            if not self.open:
                self.texts = []
            card = _Card(attrs.get("data-asin"), depth, self.texts)
            self.cards.append(card)
            self.open.append(card)

    def leaf(self, tag: str, attr_text: str, data: str) -> None:
        """Start, text and end of an element that holds one text, in one step."""
        if tag in VOID or attr_text.endswith("/") or tag == "div":
            self.start(tag, attr_text)
            self.text(data)
            if tag not in VOID:
                self.end(tag)
            return
        self._child()
        if not self.open:
            return
        depth = len(self.stack)
        if tag == "span" or tag == "h2":
            self._look(tag, attr_text, depth)
        data = _html.unescape(data) if "&" in data else data
        if text := data.strip():
            self.texts.append(text)
        self._ended(tag, depth, SPONSORED_WORD in data.lower())

    def _ended(self, tag: str, depth: int, word: bool | None) -> None:
        """An element ends whose own string holds the word, does not, or is none."""
        if tag == "span" and word:
            for card in self.open[self.flagged:]:
                card.fields["sponsored"] = True
            self.flagged = len(self.open)
        if self.stack and self.stack[-1][1] == 1:
            self.stack[-1][2] = word      # an only child's string is its parent's
        if depth in self.ending:
            for card in self.ending.pop(depth):
                self._step(card, "end", depth)

    def _close(self) -> str:
        depth = len(self.stack) - 1
        tag, children, string, _ = self.stack.pop()
        self.tags[tag] -= 1
        if children != 1 or string is None:
            word = None
        elif isinstance(string, list):
            word = SPONSORED_WORD in "".join(string).lower()
        else:
            word = string
        self._ended(tag, depth, word)
        if self.open and self.open[-1].depth == depth:
            self.open.pop()
            self.flagged = min(self.flagged, len(self.open))
        return tag

    def end(self, tag: str) -> None:
        if self.tags.get(tag):
            while self._close() != tag:
                pass

    def finish(self) -> list[dict]:
        while self.stack:
            self._close()
        return [c.fields for c in self.cards]


def parse_cards(page: str | None) -> list[dict]:
    """All cards of one page, in page order."""
    if not page or CARD_ATTR[1] not in page:
        return []
    state = _Page()
    last = page.rfind(">")
    for m in _TOKEN.finditer(page):
        raw, skip, tag, attr_text, leaf, closing, text = m.groups()
        if tag:
            if leaf:
                state.leaf(tag.lower(), attr_text, leaf)
            else:
                state.start(tag.lower(), attr_text)
        elif text:
            if text == "<" and m.start() > last:   # no tag ends any more: text up to a comment
                rest, comment, _ = page[m.start():].partition("<!--")
                for piece in re.findall(r"[^<]+|<", rest):
                    state.text(piece)
                if comment:
                    state._child()
                break
            state.text(text)
        elif closing:
            if closing.lower() not in VOID:
                state.end(closing.lower())
        else:
            state._child()
    return state.finish()
