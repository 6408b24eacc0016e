"""Table rows and list items of HTML pages, read in one pass over each page's tags.

End tags that HTML lets authors leave out, nesting, comments and character references are handled. The pass
runs in Arrow batches; a page is a small document, and nothing is kept from one page to the next.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from grainmill.functions.columns import col

#: Text, and the tag after it: whether it ends an element, and its name; a `<` that begins no tag is text.
PIECE = re.compile(
    r"([^<]*)(?:<(/?)([a-zA-Z][^\s/>]*)(?:[^>\"']+|\"[^\"]*\"|'[^']*')*+>|<!--.*?(?:-->|\Z)|<[!?][^>]*>|(<)|\Z)", re.S
)
#: Comments, and elements whose content is no markup.
RAW = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
# Elements without content, and the lists that hold items.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
LISTS = frozenset(("ul", "ol", "menu"))
ABSENT = "N/A"


def events(page: str) -> Iterator[tuple[str, str]]:
    """`("text", …)`, `("open", tag)` and `("close", tag)` in order."""
    if "<s" in page or "<S" in page:
        page = RAW.sub("", page)
    for text, end, tag, sign in PIECE.findall(page):
        if text:
            yield "text", unescape(text) if "&" in text else text
        if tag:
            tag = tag.lower()
            if end:
                yield "close", tag
            elif tag not in VOID:
                yield "open", tag
        elif sign:
            yield "text", "<"


@dataclass
class Item:
    whole: list[str] = field(default_factory=list)  # without the items of lists inside it
    own: str | None = None  # its first text that is in no element of its own


def items(page: str) -> list[Item]:
    """All `<li>` in the order of their beginnings."""
    found: list[Item] = []
    stack: list[tuple[str, Item | None]] = []
    for kind, value in events(page):
        if kind == "text":
            item = next((i for _, i in reversed(stack) if i), None)
            if item:
                item.whole.append(value)
                if item.own is None and stack[-1][1] is item and value.strip():
                    item.own = value.strip()
            continue
        if kind == "open":
            if value == "li":
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] in LISTS:
                        break
                    if stack[depth][0] == "li":
                        del stack[depth:]
                        break
                found.append(Item())
            stack.append((value, found[-1] if value == "li" else None))
        else:
            depth = next((d for d in range(len(stack) - 1, -1, -1) if stack[d][0] == value), None)
            if depth is not None:
                del stack[depth:]
    return found


@dataclass
class Table:
    captions: list[str] = field(default_factory=list)
    rows: list[tuple[str, list[str]]] = field(default_factory=list)
    heading: bool = False  # inside <thead>
    row: tuple[list[str], list[str]] | None = None  # first texts of its <th> and <td>
    cell: list[str] | None = None
    inner: int = 0  # elements open inside the cell

    def end_cell(self):
        self.cell, self.inner = None, 0

    def end_row(self):
        self.end_cell()
        if self.row is not None and not self.heading:
            heads, cells = self.row
            self.rows.append((heads[0] or ABSENT if heads else ABSENT, [c or ABSENT for c in cells]))
        self.row = None


def tables(page: str) -> list[Table]:
    """All tables in the order of their beginnings, with the rows outside their heads."""
    found: list[Table] = []
    open_: list[Table] = []
    for kind, value in events(page):
        table = open_[-1] if open_ else None
        if kind == "open" and value == "table":
            found.append(Table())
            open_.append(found[-1])
        elif table is None:
            continue
        elif kind == "text":
            if table.cell is not None and not table.inner and not table.cell[-1]:
                table.cell[-1] = value.strip()
        elif value in ("thead", "tbody", "tfoot"):
            table.end_row()
            table.heading = kind == "open" and value == "thead"
        elif value == "tr":
            table.end_row()
            if kind == "open":
                table.row = ([], [])
        elif value in ("td", "th", "caption"):
            if kind == "open" and value == "caption":
                table.cell, table.inner = table.captions, 0
                table.captions.append("")
            elif kind == "open":
                if table.row is None:
                    table.row = ([], [])
                side = table.row[value == "td"]
                side.append("")
                table.cell, table.inner = side, 0
            else:
                table.end_cell()
        elif kind == "close" and value == "table":
            table.end_row()
            open_.pop()
        elif table.cell is not None:
            table.inner = max(0, table.inner + (1 if kind == "open" else -1))
    for table in open_:
        table.end_row()
    return found


def read_pages(df: DataFrame, key: str, html: str, names: str, read: Callable[[str], list[tuple]]) -> DataFrame:
    """`(key, …)`: the rows that `read` finds on each page, in columns declared by `names`; a null page has none."""
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, {names}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, rows = [], []
            for place, page in enumerate(batch.column(1).to_pylist()):
                found = read(page) if page else []
                places += [place] * len(found)
                rows += found
            if rows:
                keys = batch.column(0).take(pa.array(places, pa.int64()))
                columns = [pa.array(c) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays([keys, *columns], names=[key, *(n.split()[0] for n in names.split(", "))])

    pages = df.select(col(key), col(html))
    threads = df.sparkSession.sparkContext.defaultParallelism
    if pages.rdd.getNumPartitions() < threads:  # few files: the reading is worth spreading their pages
        pages = pages.repartition(threads)
    return pages.mapInArrow(run, schema)
