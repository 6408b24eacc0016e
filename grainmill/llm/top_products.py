"""Exact largest inner products of whole-number vectors.

Vectors are sorted by length, longest first, and packed into blocks. Every query first meets the longest
block, which gives it a score to beat; by Cauchy-Schwarz it then goes only to blocks long enough to beat it.
In a block, products are summed along the axes of a singular value decomposition, the strongest first, and a
vector leaves once its sum so far and the lengths of both rests can't reach the score. What is left is summed
in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grainmill.llm.staging import stored

#: Vectors of a block, queries that are worked on together, queries of a task's part, bands of block lengths.
BLOCK, TOGETHER, PART, BANDS = 4096, 256, 1024, 64
#: Axes after which vectors may leave, as shares of all.
STOPS = (0.25, 0.5, 1.0)
#: Rounding of sums against the lengths of both vectors.
SLACK = 1e-9


def whole_vectors(df: DataFrame, scale: float = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """`(id, v, norm)` with every component x turned into floor(scale * x).

    Rows with a null id, a null vector, or a null or non-finite component take no part; of repeated ids the
    least vector counts.
    """
    # A predicate that meets null gives null, so `forall` is true only if all components are there and finite.
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite)
    v = F.transform(vector_col, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    one = rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).groupBy("id").agg(F.min("v").alias("v"))
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return one.withColumn("norm", F.sqrt(squares))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows, filled up with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _axes(vectors: DataFrame, width: int) -> np.ndarray:
    """The axes of greatest weight first: eigenvectors of the sum of outer products over all vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            rows = _matrix(batch.column(0), width).astype(float)
            total += rows.T @ rows
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "x"])

    summed = vectors.select("v").mapInArrow(run, "i long, j long, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).collect()
    gram = np.zeros((width, width))
    for r in summed:  # at most width squared, whatever the number of vectors
        gram[r["i"], r["j"]] = r["x"]
    return np.linalg.eigh((gram + gram.T) / 2)[1][:, ::-1].copy()


def _packed(vectors: DataFrame, width: int, size: int) -> DataFrame:
    """Blocks of up to `size` vectors, longest vectors first; `norm` is the length of the longest."""

    def run(batches):
        from pyspark import TaskContext

        block, ids, rows, norms = TaskContext.get().partitionId() << 32, [], [], []
        for batch in [*batches, None]:
            if batch is not None:
                ids.append(batch.column("id").to_numpy().astype("<i8"))
                rows.append(_matrix(batch.column("v"), width).astype("<i8"))
                norms.append(batch.column("norm").to_numpy())
            while ids and (sum(map(len, ids)) >= size or batch is None and sum(map(len, ids))):
                i, r, n = np.concatenate(ids), np.concatenate(rows), np.concatenate(norms)
                columns = [pa.array([block]), pa.array([float(n[0])]), *(pa.array([x[:size].tobytes()], pa.binary()) for x in (i, r))]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "norm", "ids", "data"])
                ids, rows, norms, block = [i[size:]], [r[size:]], [n[size:]], block + 1

    ordered = vectors.repartitionByRange(F.desc("norm"), F.asc("id")).sortWithinPartitions(F.desc("norm"), "id")
    return ordered.select("id", "v", "norm").mapInArrow(run, "block long, norm double, ids binary, data binary")


def _best(queries, floors, own, ids, rows, axes, k):
    """For each query its `k` best rows `(query, row, score)`: those not below its floor, ties to smaller ids; not itself."""
    width = axes.shape[0]
    q, x = queries @ axes, rows @ axes
    stops = sorted({max(1, round(s * width)) for s in STOPS})
    q_norm, x_norm = np.linalg.norm(q, axis=1), np.linalg.norm(x, axis=1)
    slack = SLACK * q_norm[:, None] * x_norm[None] + SLACK
    sums, start = np.zeros((len(q), len(x))), 0
    alive = own[:, None] != ids[None]
    for stop in stops:
        sums += q[:, start:stop] @ x[:, start:stop].T
        q_rest, x_rest = np.linalg.norm(q[:, stop:], axis=1), np.linalg.norm(x[:, stop:], axis=1)
        alive &= sums + q_rest[:, None] * x_rest[None] + slack >= floors[:, None]
        if not alive.any():
            return np.zeros((0, 3), np.int64)
        some = np.flatnonzero(alive.any(axis=0))
        if len(some) < len(x):
            x, sums, alive, slack, ids, rows = x[some], sums[:, some], alive[:, some], slack[:, some], ids[some], rows[some]
        start = stop
    sums[~alive] = -np.inf
    if sums.shape[1] > k:
        least = -np.partition(-sums, k - 1, axis=1)[:, k - 1]
        alive &= sums >= least[:, None] - 2 * slack.max(axis=1)[:, None]
    a, b = np.nonzero(alive)
    scores = np.einsum("ij,ij->i", queries[a], rows[b])
    keep = scores >= floors[a]
    a, b, scores = a[keep], b[keep], scores[keep]
    order = np.lexsort((ids[b], -scores, a))
    a, b, scores = a[order], b[order], scores[order]
    first = np.searchsorted(a, a)
    top = np.arange(len(a)) - first < k
    return np.stack((own[a], ids[b], scores), axis=1)[top]


def _meet(width: int, axes: np.ndarray, k: int):
    """Rows sorted by (block, part, kind), a block's vectors (kind 0) before a part's queries (kind 1), to the best of each query there."""

    def run(batches):
        at = ids = rows = None
        held: list[tuple] = []

        def work():
            nonlocal held
            if held:
                own, data, floors = zip(*held)
                queries = np.stack([np.frombuffer(d, "<i8") for d in data]).astype(np.int64)
                found = _best(queries, np.array(floors), np.array(own), ids, rows, axes, k)
                held = []
                if len(found):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found.T], names=["query_id", "vec_id", "score"])

        for batch in batches:
            for block, part, _, own, floor, members, data in zip(*(c.to_pylist() for c in batch.columns)):
                if (block, part) != at:
                    yield from work()
                    at = block, part
                if own is None:
                    ids, rows = np.frombuffer(members, "<i8"), np.frombuffer(data, "<i8").reshape(-1, width).astype(np.int64)
                else:
                    held.append((own, data, floor))
                    if len(held) == TOGETHER:
                        yield from work()
        yield from work()

    return run


def top_products(vectors: DataFrame, is_query: str, k: int = 5, block: int = BLOCK) -> DataFrame:
    """`(query_id, rank, vec_id, score)`: for each vector with `is_query` its `k` largest inner products with others.

    `vectors(id, v, norm)` as `whole_vectors` gives them; shorter vectors count as filled up with zeros. Equal
    scores go to smaller ids; with fewer than `k` others all are returned, and a query without others has no
    row. Exact while a product fits a long. The queries are a set of stated rows; each goes to a block of
    vectors at most once. Queries are dealt over parts of about `PART` of them, and a block is copied to the parts
    that ask for it, so no task has more than a part's queries for a block.
    """
    vectors = stored(vectors, "vectors")
    width = max(1, vectors.agg(F.max(F.size("v")).alias("width")).first()["width"] or 1)
    axes = _axes(vectors, width)
    blocks = stored(_packed(vectors, width, block), "blocks")
    lengths = blocks.select("block", "norm")
    longest = lengths.agg(F.max_by("block", "norm").alias("block"), F.percentile_approx("norm", [i / BANDS for i in range(1, BANDS)]).alias("cuts")).first()
    if longest["block"] is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    cuts = F.lit(sorted(set(longest["cuts"])))
    banded = lengths.withColumn("band", F.size(F.filter(cuts, lambda c: c < F.col("norm"))))
    bands = banded.groupBy("band").agg(F.max("norm").alias("norm")).collect()  # at most BANDS rows

    def as_bytes(batches):
        for batch in batches:
            data = _matrix(batch.column("v"), width).astype("<i8")
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("norm"), pa.array([r.tobytes() for r in data], pa.binary())], names=["id", "norm", "data"])

    queries = stored(vectors.where(is_query).select("id", "norm", "v").mapInArrow(as_bytes, "id long, norm double, data binary"), "queries")

    parts = 1 + queries.count() // PART

    def meet(asked, among):
        asked = asked.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)))
        wanted = asked.groupBy("block", "part").agg(F.lit(0).alias("kind"))  # a pair for each task
        of_queries = asked.select("block", "part", F.lit(1).alias("kind"), "id", "floor", F.lit(None).cast("binary").alias("ids"), "data")
        of_blocks = among.join(wanted, "block").select("block", "part", "kind", F.lit(None).cast("long"), F.lit(None).cast("double"), "ids", "data")
        ordered = of_queries.union(of_blocks).repartition("block", "part").sortWithinPartitions("block", "part", "kind", "id")
        return ordered.mapInArrow(_meet(width, axes, k), "query_id long, vec_id long, score long")

    lowest, top = F.lit(float("-inf")), F.lit(longest["block"])
    first = stored(meet(queries.withColumns({"block": top, "floor": lowest}), blocks.where(F.col("block") == top)), "first")
    floors = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score").cast("double")).alias("floor"))
    known = queries.join(floors.withColumnRenamed("query_id", "id"), "id", "left").withColumn("floor", F.coalesce("floor", lowest))
    every = F.array(*[F.struct(F.lit(r["band"]).alias("band"), F.lit(r["norm"]).alias("most")) for r in bands])
    able = F.filter(every, lambda b: F.col("norm") * b["most"] * (1 + SLACK) + SLACK >= F.col("floor"))
    asked = known.withColumn("band", F.explode(F.transform(able, lambda b: b["band"]))).join(banded.select("band", "block"), "band")
    rest = meet(asked.where(F.col("block") != top), blocks.where(F.col("block") != top))
    ranked = first.union(rest).withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
