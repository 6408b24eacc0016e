"""Pages as sequences of leaf blocks: runs of text between block-level tags, with the path of tags above them."""

from __future__ import annotations

import functools
import html
import re
from dataclasses import dataclass

# Elements whose content is no text of the page, and elements that end a run of text.
UNSEEN = "script style noscript template svg math iframe textarea"
BLOCKS = (
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td "
    "tfoot th thead tr ul"
).split()
#: An open element of the key ends where one of these begins.
CELLS = {"td", "th", "tr", "tbody", "thead", "tfoot"}
ENDED_BY = {
    "p": set(BLOCKS) - {"option", "optgroup"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "td": CELLS,
    "th": CELLS,
    "tr": CELLS - {"td", "th"},
    "tbody": CELLS - {"td", "th", "tr"},
    "thead": CELLS - {"td", "th", "tr"},
    "option": {"option", "optgroup"},
}
#: Elements through which a beginning tag still ends what is open above them.
PASSED = {"div", "address"}
VOID = {"hr"}
#: What stands in a tag after its name: quotes hold a value only after `=`.
REST = r"(?:[^>=]+|=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*)?)*+"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?:svg|math)(?=[\s/>]){REST}(?<=/)>"
    rf"|<(?P<unseen>{'|'.join(UNSEEN.split())})(?=[\s/>]){REST}>.*?(?:</(?P=unseen)(?=[\s/>])[^>]*>|\Z)"
    rf"|<title(?=[\s/>]){REST}>.*?(?:</title(?=[\s/>])[^>]*>|(?=</head[\s>]|<body[\s/>])|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>{REST})>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s=/>][^\s=/>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NAMING = {"class", "id", "role"}
IS_BLOCK = frozenset(BLOCKS)


@dataclass
class Block:
    text: str
    path: tuple[str, ...]  # tags from the outermost on, each followed by its class and id words as `.word`
    linked: int  # characters inside links


@functools.lru_cache(20_000)
def names_of(attributes: str) -> tuple[str, ...]:
    """The words of an element's class, id and role, as `.word`."""
    found = " ".join(a or b or c for name, a, b, c in ATTRIBUTE.findall(attributes) if name.lower() in NAMING)
    found = re.sub(r"([a-z])([A-Z])", r"\1 \2", html.unescape(found)).lower()
    return tuple("." + w for w in re.findall(r"[a-z]+", found))


def blocks(page: str) -> list[Block]:
    """The non-empty blocks of a page in order. Character references are decoded and white space is one space."""
    found: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, link_from = 0, None
    size = at = 0

    def flush():
        nonlocal parts, size, linked, link_from
        if link_from is not None:
            linked, link_from = linked + size - link_from, 0
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            found.append(Block(text, tuple(w for _, names in stack for w in names), min(linked, len(text))))
        parts, size, linked = [], 0, 0

    def add(text):
        nonlocal size
        parts.append(text)
        size += len(text)

    for m in TOKEN.finditer(page):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            if m[0].startswith("<![CDATA["):
                add(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        tag = tag.lower()
        if tag in IS_BLOCK:
            flush()
            if m["end"]:
                depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
                if depth is not None:
                    del stack[depth:]
                continue
            for i in range(len(stack) - 1, -1, -1):
                if tag in ENDED_BY.get(stack[i][0], ()):
                    del stack[i:]
                elif stack[i][0] not in PASSED:
                    break
            if tag not in VOID:
                stack.append((tag, (tag, *names_of(m["rest"]))))
        elif tag == "br":
            add(" ")
        elif tag == "a":
            if m["end"] and link_from is not None:
                linked, link_from = linked + size - link_from, None
            elif not m["end"]:
                link_from = size
    if at < len(page):
        add(page[at:])
    flush()
    return found
