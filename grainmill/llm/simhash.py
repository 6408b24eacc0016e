"""Near-duplicate documents by 64-bit fingerprints and multi-index hashing.

Fingerprints are made in Arrow batches. Equal ones are merged first, so a group of exact copies of any
size goes on as one row. Two fingerprints within the distance agree, in at least one of two halves, up to
half the distance; each half is therefore entered into its table under every value of a small Hamming
ball, and fingerprints that meet under a value are compared in full.

Buckets with up to `crowd` fingerprints are compared pair by pair. Beyond it (thousands of near copies of
one text) pairs would grow with the square of the bucket, so each member of such a bucket writes itself
under every 64-bit word within half the distance instead: two fingerprints share such a word if and only if
they are within the distance, and linking the members of a word in a star keeps every connection with a
fixed number of rows for each member.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.components import components, join_dealt
from grainmill.llm.staging import stored

SEED = 42
BITS = 64
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Hashes whose bits are summed at once.
SLICE = 1 << 16


def fingerprint(text: str | None, width: int = 4) -> int:
    """The fingerprint of one text, as an unsigned number.

    A-Z are lower-cased; words are what ASCII white space separates; each run of `width` words, repeats
    included, is hashed; a bit is set if it is set in over half the hashes. Fewer words than `width` count
    as one run; a null text and a text without words have fingerprint zero.
    """
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends[width - 1 :].tolist()
    n = len(ends)
    digests = map(xxhash.xxh64_intdigest, (joined[a:b] for a, b in zip(starts, ends)), repeat(SEED))
    hashes = np.fromiter(digests, np.uint64, n).astype("<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, SLICE):
        part = hashes[at : at + SLICE]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """`(id, fp)` for every row of `docs`; `fp` holds the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(x.as_py(), width) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], names=["id", "fp"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, fp long")


def ball(width: int, radius: int) -> list[int]:
    """Masks of `width` bits with at most `radius` bits set."""
    return [sum(1 << i for i in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _near(word, masks: list[int]):
    """`word` with each mask applied, as rows."""
    return F.explode(F.transform(F.lit([_signed(m) for m in masks]), lambda m: word.bitwiseXOR(m)))


def _halves(fps: DataFrame, distance: int) -> DataFrame:
    """`(half, key, fp)`: both halves under every value of their ball."""
    masks = ball(BITS // 2, -(-(distance // 2) // 2))
    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32)
    sides = [fps.select(F.lit(i).alias("half"), _near(side, masks).alias("key"), "fp") for i, side in enumerate((low, high))]
    return sides[0].union(sides[1])


def _canonical(x: np.ndarray, y: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether `key` is the one value, of those that halves `x` and `y` both reach, under which their pair is told."""
    diff = x ^ y
    bit = diff & (~diff + np.uint64(1))
    near = diff & (diff - np.uint64(1))  # without its lowest bit
    bits = np.bitwise_count(diff)
    least = np.where(bits == 1, np.minimum(x, y), np.minimum(x ^ bit, x ^ near))
    return (bits > 2) | (key == np.where(bits == 0, x, least))


def _bucket_links(distance: int, crowd: int):
    """Rows sorted by (half, key, fp) to `(a, b)`: linked pairs of small buckets, and `(a, null)` for members of large ones."""

    def compare(half, key, fp):
        a, b = [], []
        for lag in range(1, crowd):
            if lag >= len(key):
                break
            at = np.flatnonzero((key[lag:] == key[:-lag]) & (half[lag:] == half[:-lag]))
            if not len(at):
                break
            x, y = fp[at], fp[at + lag]
            close = np.bitwise_count(x ^ y) <= distance
            at, x, y = at[close], x[close], y[close]
            shift = (half[at] * 32).astype(np.uint64)
            mask = np.uint64(0xFFFFFFFF)
            told = _canonical((x >> shift) & mask, (y >> shift) & mask, key[at])
            a.append(x[told])
            b.append(y[told])
        return (np.concatenate(a), np.concatenate(b)) if a else (fp[:0], fp[:0])

    def out(a, b=None):
        b = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b.view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), b], names=["a", "b"])

    def run(batches):
        held = (np.zeros(0, np.int32), np.zeros(0, np.uint64), np.zeros(0, np.uint64))  # the last bucket so far, if small
        large = None  # the bucket that is known to be large and may go on
        for batch in batches:
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            rows = [np.concatenate((h, r.view(h.dtype))) for h, r in zip(held, rows)]
            held = tuple(r[:0] for r in rows)
            if large is not None:
                same = (rows[0] == large[0]) & (rows[1] == large[1])
                n = int(same.sum())
                if n:
                    yield out(rows[2][:n])
                rows = [r[n:] for r in rows]
                if not len(rows[0]):
                    continue
            half, key, fp = rows
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (half[1:] != half[:-1])) + 1
            starts = np.concatenate(([0], cuts))
            sizes = np.diff(np.append(starts, len(key)))
            crowded = np.repeat(sizes > crowd, sizes)
            if crowded.any():
                yield out(np.unique(fp[crowded]))
            large = (half[-1], key[-1]) if crowded[-1] else None
            rest = len(key) if crowded[-1] else starts[-1]
            if not crowded[-1]:
                held = tuple(r[starts[-1] :] for r in rows)
            keep = ~crowded[:rest] & np.repeat(sizes > 1, sizes)[:rest]
            if keep.any():
                a, b = compare(half[:rest][keep], key[:rest][keep], fp[:rest][keep])
                if len(a):
                    yield out(a, b)
        if len(held[0]) > 1:
            a, b = compare(*held)
            if len(a):
                yield out(a, b)

    return run


def _first_of_run(batches):
    """Rows sorted by (word, fp) to links from each fingerprint to the first of its word."""
    word, first = None, None
    for batch in batches:
        words, fps = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        starts = np.concatenate(([True], words[1:] != words[:-1]))
        starts[0] = word is None or words[0] != word
        heads = np.where(starts, fps, 0)
        at = np.maximum.accumulate(np.where(starts, np.arange(len(words)), -1))
        heads = np.where(at >= 0, fps[np.maximum(at, 0)], 0 if first is None else first)
        word, first = words[-1], heads[-1]
        links = np.unique(np.stack((heads, fps))[:, heads != fps], axis=1)
        if links.size:
            yield pa.RecordBatch.from_arrays([pa.array(links[1]), pa.array(links[0])], names=["a", "b"])


def links(fps: DataFrame, distance: int = 4, crowd: int = 64) -> DataFrame:
    """`(a, b)` of distinct fingerprints `fps(fp)`: links whose components are those of all pairs within `distance` bits.

    `distance` is 0, 2 or 4: up to there a ball of radius one serves either half, and an even distance has a
    word midway. `crowd` only decides how a bucket is worked on; no bucket is cut.
    """
    if distance not in (0, 2, 4):
        raise ValueError("distance must be 0, 2 or 4")
    entered = _halves(fps, distance).repartition("half", "key").sortWithinPartitions("half", "key", "fp")
    met = stored(entered.mapInArrow(_bucket_links(distance, crowd), "a long, b long"), "met")
    pairs = met.where("b IS NOT NULL")
    crowds = met.where("b IS NULL").select(F.col("a").alias("fp")).distinct()
    near = crowds.select(_near(F.col("fp"), ball(BITS, distance // 2)).alias("word"), "fp")
    stars = near.repartition("word").sortWithinPartitions("word", "fp").mapInArrow(_first_of_run, "a long, b long")
    return pairs.union(stars)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, distance: int = 4, crowd: int = 64
) -> DataFrame:
    """`(id, fp, component_id)` for every row of `docs`.

    component_id is the smallest id among the rows whose fingerprints can be reached over links of at most
    `distance` bits, the row itself included. Null and empty texts have fingerprint zero and link like any
    other; a repeated id keeps its rows; a null id takes part but never becomes a component_id unless the
    component has no other (then it is null). Other columns of `docs` are ignored. An empty table gives none.
    """
    made = stored(fingerprints(docs, id_col, text_col, width), "fingerprints")
    least = stored(made.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    roots = components(links(least.select("fp"), distance, crowd))
    linked = stored(roots.join(least, roots["node"] == least["fp"]).select("root", "fp", "least"), "linked")
    smallest = linked.groupBy("root").agg(F.min("least").alias("smallest"))
    named = join_dealt(linked, smallest, "root", linked.count()).select("fp", "smallest")
    classes = least.join(named, "fp", "left").select("fp", F.coalesce("smallest", "least").alias("component_id"))
    classes = stored(classes, "classes")  # with plain shuffles below the join, adaptive execution can split a hot fingerprint
    return made.join(classes, "fp").select("id", "fp", "component_id")
