"""Packs documents into training sequences along a space-filling curve.

Each document's token counts, hashed into a vector, are projected to a few dimensions; the Hilbert key of
the point puts documents with like words next to each other. A range sort by the key gives every task a
stretch of the curve, which it cuts into sequences by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.batches import in_chunks
from grainmill.llm.staging import stored
from grainmill.llm.word_ids import word_encoder

DIMS = 3
BUCKETS = 1024
#: Bits of each dimension in the key.
DEPTH = 16


def hilbert_key(points: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Positions on the Hilbert curve of integer points (rows) with `depth` bits in each dimension.

    Skilling's transform: undo the turns of the sub-cubes from the coarsest bit on, Gray-decode, interleave.
    """
    x = points.astype(np.int64).T.copy()
    for bit in range(depth - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(len(x)):
            high = (x[i] >> bit) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(depth - 1, 0, -1):
        turn ^= np.where((x[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(depth - 1, -1, -1):
        for row in x:
            key = key << 1 | (row >> bit) & 1
    return key


def projection(seed: int = 5) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((BUCKETS, DIMS))


def points(ids: np.ndarray, sizes: np.ndarray, onto: np.ndarray) -> np.ndarray:
    """A point of the key's grid for each document."""
    buckets = ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(54)).astype(np.int64)
    found = np.zeros((len(sizes), DIMS))
    start = 0
    for i, n in enumerate(sizes.tolist()):
        counts = np.sqrt(np.bincount(buckets[start : start + n], minlength=BUCKETS))
        found[i] = counts @ onto / max(1.0, np.sqrt(n))
        start += n
    return ((1 << DEPTH) / (1 + np.exp(-1.702 * found))).astype(np.int64).clip(0, (1 << DEPTH) - 1)


def tokenized(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """`(id, curve, ids)`: the key on the curve and the ids as little-endian unsigned 32-bit numbers, `end_id` last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, onto = word_encoder(tokenizer), projection()
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for part in in_chunks(texts):
                ids, sizes = encoder.encode(texts[part])
                curve = hilbert_key(points(ids, sizes, onto))
                ends = np.cumsum(sizes)
                whole = np.insert(ids, ends, end_id).astype("<u4")
                cuts = (np.append(0, ends + np.arange(1, len(ends) + 1)) * 4).tolist()
                raw = whole.tobytes()
                packed = pa.array([raw[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.start, part.stop - part.start), pa.array(curve), packed], names=["id", "curve", "ids"]
                )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, curve long, ids binary")


def _tail_lengths(rest: int) -> list[int]:
    """Powers of two, largest first, that add up to `rest`."""
    return [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _cut(length: int):
    """Documents in curve order to pieces in sequences of `length` ids; what is left at the end goes to sequences of powers of two."""

    def run(batches):
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 32
        names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        done, room, open_pieces = 0, length, []

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            rows = []
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n, start = len(raw) // 4, 0
                while start < n:
                    take = min(room, n - start)
                    open_pieces.append((doc, start, take, raw[4 * start : 4 * (start + take)], n, base + done, length - room))
                    start, room = start + take, room - take
                    if not room:
                        rows += open_pieces
                        done, room, open_pieces = done + 1, length, []
            if rows:
                yield out(rows)
        rows = []
        sizes = _tail_lengths(length - room)
        left, used = (sizes[0] if sizes else 0), 0
        for doc, start, n, raw, total, _, _ in open_pieces:
            at = 0
            while at < n:
                take = min(left - used, n - at)
                rows.append((doc, start + at, take, raw[4 * at : 4 * (at + take)], total, base + done, used))
                at, used = at + take, used + take
                if used == left:
                    sizes, done, used = sizes[1:], done + 1, 0
                    left = sizes[0] if sizes else 0
        if rows:
            yield out(rows)

    return run


def pack(
    docs: DataFrame, tokenizer: str, length: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces `(id, start, length, ids, doc_tokens, sequence_id, offset)` of all rows of `docs`.

    A document is its ids without special tokens and then `end_id`; a null or empty text is that id alone. The
    ids (little-endian unsigned 32-bit) of a sequence are those of its pieces by `offset`, which has no gaps.
    Sequences have `length` ids, but for the end of each task's stretch, which is cut into sequences whose
    lengths are powers of two, so that nothing is padded. Every id lies in one piece. Equal rows are packed as
    often as they occur; null ids are kept; rows with equal keys are ordered by id and then by their ids.
    Which stretch a task has depends on the number of shuffle partitions. Other columns are ignored; an empty
    table gives no pieces.
    """
    made = stored(tokenized(docs, tokenizer, end_id, id_col, text_col), "tokens")  # the range sort reads it twice
    ordered = made.repartitionByRange("curve", "id").sortWithinPartitions("curve", "id", "ids").select("id", "ids")
    schema = "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return ordered.mapInArrow(_cut(length), schema)
