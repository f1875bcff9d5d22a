"""A web page as a sequence of leaf blocks: stretches of text with the open elements around them.

One pass over the page, linear in its length for any input: every scan either consumes what it has read
or ends the page, as an unclosed tag, comment or script does in a browser.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

# Elements of the HTML standard by what they do to the text.
RAW = frozenset("script style iframe noembed noframes template xmp".split())
PLAIN = frozenset("title textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BREAKING = frozenset(
    """address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup
    option p pre section select summary table tbody td textarea tfoot th thead title tr ul""".split()
)
ENDS_P = BREAKING - frozenset("body button caption head html legend noscript optgroup option select tbody td textarea tfoot th thead title tr".split())
#: An item ends an earlier open item of its kind, unless one of the barriers stands between them.
IMPLIED = {
    "p": ("p", "td th caption button"),
    "li": ("li", "ul ol menu"),
    "dd": ("dd dt", "dl"),
    "cell": ("td th", "tr table"),
    "row": ("tr", "thead tbody tfoot table"),
    "rows": ("thead tbody tfoot", "table"),
    "option": ("option", "select optgroup"),
}
KIND_OF_ITEM = {tag: kind for kind, (items, _) in IMPLIED.items() for tag in items.split()}
KINDS = {}
for _kind, (_items, _barriers) in IMPLIED.items():
    for _tag in f"{_items} {_barriers}".split():
        KINDS.setdefault(_tag, []).append(_kind)

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""")
_BEGIN = re.compile(r"</?[a-zA-Z]")
_NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.IGNORECASE)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_LONG = re.compile(r"&#([0-9]{8,})")


@dataclass
class Paths:
    """Paths of open elements as a tree: node i stands below parents[i] and adds the names of one element."""

    parents: list[int] = field(default_factory=lambda: [-1])
    names: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    _known: dict = field(default_factory=dict)

    def below(self, node: int, names: tuple[str, ...]) -> int:
        found = self._known.setdefault((node, names), len(self.parents))
        if found == len(self.parents):
            self.parents.append(node)
            self.names.append(names)
        return found

    def chain(self, node: int) -> list[str]:
        """All names from the root to the node."""
        steps = []
        while node > 0:
            steps.append(self.names[node])
            node = self.parents[node]
        return [name for step in reversed(steps) for name in step]


@dataclass(frozen=True)
class Leaf:
    node: int
    text: str
    linked: int


def decoded(text: str) -> str:
    """Character references replaced; numbers beyond Unicode, however long, give U+FFFD as shorter ones do."""
    if "&" not in text:
        return text
    shorter = lambda m: f"&#{(m[1].lstrip('0') or '0')[:8]}"
    return unescape(_LONG.sub(shorter, text))


def element_names(tag: str, attributes: str) -> tuple[str, ...]:
    """The tag, and the words of class, id and role."""
    names = [tag]
    for match in _NAMED.finditer(attributes):
        names += [f".{part.lower()}" for part in _PART.findall(match[2] or match[3] or match[4] or "")]
    return tuple(dict.fromkeys(names))


class _Page:
    def __init__(self, paths: Paths):
        self.paths, self.leaves = paths, []
        self.stack: list[tuple[str, int]] = [("", 0)]
        self.open: dict[str, int] = {}
        self.marks: dict[str, list[int]] = {kind: [] for kind in IMPLIED}
        self.parts: list[str] = []
        self.linked = 0
        self.link_depth = 0

    def text(self, text: str) -> None:
        if text:
            text = decoded(text)
            self.parts.append(text)
            if self.link_depth:
                self.linked += len(text)

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.leaves.append(Leaf(self.stack[-1][1], text, min(self.linked, len(text))))
            self.parts, self.linked = [], 0

    def close(self, depth: int) -> None:
        """Ends the open elements down to that depth."""
        while len(self.stack) > depth:
            tag, _ = self.stack.pop()
            self.open[tag] -= 1
            for kind in KINDS.get(tag, ()):
                self.marks[kind].pop()
        if self.link_depth > len(self.stack):
            self.link_depth = 0

    def start(self, tag: str, attributes: str) -> None:
        if tag == "a":
            self.link_depth = len(self.stack)
        if tag == "br":
            self.parts.append(" ")
        if tag not in BREAKING:
            return
        self.flush()
        for kind in ["p"] * (tag in ENDS_P) + [KIND_OF_ITEM.get(tag)]:
            marks = self.marks.get(kind)
            if marks and KIND_OF_ITEM.get(self.stack[marks[-1]][0]) == kind:
                self.close(marks[-1])
        if tag in VOID:
            return
        for kind in KINDS.get(tag, ()):
            self.marks[kind].append(len(self.stack))
        self.open[tag] = self.open.get(tag, 0) + 1
        self.stack.append((tag, self.paths.below(self.stack[-1][1], element_names(tag, attributes))))

    def end(self, tag: str) -> None:
        if tag == "a":
            self.link_depth = 0
        if tag not in BREAKING:
            return
        self.flush()
        if self.open.get(tag):
            depth = len(self.stack) - 1
            while self.stack[depth][0] != tag:
                depth -= 1
            self.close(depth)


def leaves(html: str, paths: Paths) -> list[Leaf]:
    """The leaf blocks of a page in page order, without scripts, styles, comments and markup.

    References are decoded, white space (Python's notion, the no-break space included) becomes one space,
    ends are trimmed, empty blocks left out. Elements within a line do not break a block; ``br`` is white space.
    """
    page, at, size = _Page(paths), 0, len(html)
    while at < size:
        begin = html.find("<", at)
        if begin < 0:
            page.text(html[at:])
            break
        page.text(html[at:begin])
        match = _TAG.match(html, begin)
        if match:
            at, tag = match.end(), match[2].lower()
            if match[1]:
                page.end(tag)
                continue
            page.start(tag, match[3])
            if tag in RAW or tag in PLAIN:
                closing = re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE).search(html, at)
                stop = closing.start() if closing else size
                if tag in PLAIN:
                    page.text(html[at:stop])
                at = stop
        elif html.startswith("<!--", begin):
            stop = html.find("-->", begin + 2)
            at = size if stop < 0 else stop + 3
        elif html.startswith(("<!", "<?"), begin) or (html.startswith("</", begin) and not _BEGIN.match(html, begin)):
            stop = html.find(">", begin)
            at = size if stop < 0 else stop + 1
        elif _BEGIN.match(html, begin):
            at = size
        else:
            page.text("<")
            at = begin + 1
    page.flush()
    return page.leaves
