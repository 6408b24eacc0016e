"""Helpers for work on Arrow batches of texts."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import pyarrow as pa

#: Characters of text that are worked on together, so that memory does not follow the length of a batch.
CHUNK = 2_000_000


def in_chunks(texts: list[str], size: int = CHUNK) -> Iterator[slice]:
    """Slices of `texts` with about `size` characters each; a longer text has a slice of its own."""
    start = held = 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= size:
            yield slice(start, i + 1)
            start, held = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


class Words(dict):
    """Words to running numbers; what is new since the last look waits in `fresh`."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        self.fresh.append(word)
        return at


def unused(df, name: str) -> str:
    """A column name that `df` does not have, whatever the case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def field_list(schema) -> str:
    """A schema as the text that `mapInArrow` takes."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def by_row(batches) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples."""
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns])


def as_batches(rows, fields: dict[str, pa.DataType], size: int = 2_000) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches of up to `size` rows."""
    rows = iter(rows)
    while held := list(islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held), fields.values())], names=list(fields))
