import math
import random

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from grainmill.llm import neighbour_graph as module
from grainmill.llm.catalog import QUERIES
from grainmill.llm.neighbour_graph import Shape, _backward, _blocks, _edges, _graph_row, _nodes, _top, distinct_vectors, nearest, neighbour_graph
from grainmill.llm.staging import stored

SCHEMA = "vec_id long, embedding array<float>, score string, a int"


def plain(rows, step, k):
    kept = {}
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        v = [float(np.float32(x)) for x in v]
        kept[i] = min(kept.get(i, v), v)
    return {i: sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in kept.items() if j != i)[:k] for i, q in kept.items() if i % step == 0}


def check(got, want, least):
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    hits = total = 0
    for query, best in want.items():
        mine = found.pop(query, [])
        assert len(mine) == len(best) and mine == sorted(mine) and len({j for _, j in mine}) == len(mine)
        hits += len({j for _, j in mine} & {j for _, j in best})
        total += len(best)
    assert not found and hits >= least * total


def test_ties_copies_and_odd_rows(frame):
    rng = random.Random(6)
    rows = [(i, [float(rng.randint(-3, 3)) for _ in range(4)], "x", 1) for i in range(120)]
    rows += [(i, [2.0, 1.0, 0.0, 3.0], "copy", 1) for i in range(200, 290)] + [(300, [1.0, 2.0], "short", 1)]
    rows += [(400, None, "", 1), (410, [1.0, None], "", 1), (420, [math.nan] * 4, "", 1), (430, [math.inf] * 4, "", 1), (440, [0.0] * 4, "", 1), (450, [], "", 1)]
    rows += [(None, [1.0] * 4, "", 1), (10, [3.0] * 4, "again", 2)]
    got = nearest(frame(rows, SCHEMA), "id % 10 = 0").collect()
    want = plain(rows, 10, 20)
    check(got, want, 0.97)
    for query in (200, 210):  # copies of one vector: the smallest ids, without the query's own
        assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == query] == [j for _, j in want[query]]


def test_best_of_each():
    a, b = np.array([1, 1, 0, 1, 1, 0]), np.array([5, 7, 2, 5, 6, 3])
    score, mark = np.array([0.5, 0.9, 0.1, 0.6, 0.5, 0.2]), np.arange(6)
    assert [x.tolist() for x in _top(a, b, score, 2, mark)] == [[0, 0, 1, 1], [3, 2, 7, 5], [0.2, 0.1, 0.9, 0.5], [5, 2, 1, 0]]
    assert [len(x) for x in _top(a[:0], b[:0], score[:0], 2)] == [0, 0, 0]


def test_small_blocks_and_double_precision(frame):
    """Many blocks, a hub that is a neighbour of most, and the same with eight bytes a component."""
    rng = np.random.default_rng(2)
    rows = rng.standard_normal((700, 8))
    rows[3] *= 50
    made = [(i, v, "x", 1) for i, v in enumerate(rows.astype(np.float32).astype(float).tolist())]
    for kind in ("float", "double"):
        df = frame(made, SCHEMA.replace("float", kind))
        check(nearest(df, "id % 20 = 0", block=64).collect(), plain(made, 20, 20), 0.97)


def test_a_query_goes_once_to_a_block(frame, monkeypatch):
    """However many blocks have nodes that led there; before, each of them sent the query's vector."""
    rng = np.random.default_rng(5)
    made = [(i, v, "x", 1) for i, v in enumerate(rng.standard_normal((400, 8)).astype(np.float32).astype(float).tolist())]
    want, scoring = plain(made, 20, 20), module._scoring

    def counted(shape):
        score, most = scoring(shape), len(want)

        def run(key, blocks, wanted):
            sent = sum(len(c) for c in wanted.column("vec").to_pylist() if c is not None) // (4 * shape.width)
            if sent > most:
                raise ValueError(f"{sent} vectors of {most} queries came to a block")
            return score(key, blocks, wanted)

        return run

    monkeypatch.setattr(module, "_scoring", counted)
    check(nearest(frame(made, SCHEMA), "id % 20 = 0", block=50).collect(), want, 0.97)


def test_slices_of_wanted_and_found_pairs(monkeypatch):
    """Pairs that go out and come back in many slices are the same pairs, and none is in the pool already."""
    rng = np.random.default_rng(6)
    shape, pool, key = Shape(4, "<f4", 50, 8), 12, [pa.scalar(0)]
    a, b = np.repeat(np.arange(0, 40, 2), 9), np.concatenate([np.sort(rng.choice(300, 9, replace=False)) for _ in range(20)])
    state = module._state_row(0, *_top(a, b, rng.random(180), pool, rng.random(180) < 0.5))
    own = state.append_column("vecs", pa.array([rng.standard_normal((50, 4)).astype("<f4").tobytes()]))
    lists = {of: [np.sort(rng.choice(300, rng.integers(0, 9), replace=False)) for _ in range(50)] for of in range(6)}
    told = [(np.concatenate((np.arange(50) + 50 * of, [len(x) for x in near])), np.concatenate(near)) for of, near in lists.items()]
    answers = module._table([module._message(0, 1, *cells) for cells in told])
    row, asked, want = state.to_pylist()[0], {}, set()
    for q, node, was in zip(*(np.frombuffer(row[c], t).tolist() for c, t in (("a", "<i8"), ("b", "<i8"), ("asked", "?")))):
        asked.setdefault(q, set()).add(node)
        if not was:
            want |= {(q, int(x)) for x in lists[node // 50][node % 50]}
    for most in (10, 10**6):
        monkeypatch.setattr(module, "WANTED", most)
        monkeypatch.setattr(module, "HELD", most)
        pairs = []
        for r in module._wanting(shape, pool, 100)(key, own, answers).to_pylist():
            queries, counts = np.split(np.frombuffer(r["a"], "<i8"), 2)
            pairs += zip(np.repeat(queries, counts).tolist(), (np.frombuffer(r["b"], "<i4") + r["block"] * 50).tolist())
        assert len(set(pairs)) == len(pairs) and set(pairs) == {(q, x) for q, x in want if x not in asked[q]}
        parts = [[(q, x, (q * 7 + x * 13) % 101 / 101) for q, x in sorted(pairs)[k::20]] for k in range(20)]
        found = module._table([module._message(0, 0, *zip(*part)) for part in parts])
        turned = module._pooled(pool, 100)(key, state, found).to_pylist()
        assert most == 10 or turned == before
        before = turned


def test_edges_to_a_hub():
    """A block tells a node's block of the best edges to it only, however many lead there."""
    a = np.arange(1, 101)
    rows = _graph_row(0, a, np.zeros(100), a / 100, np.arange(100) < 40, 0).to_batches()
    told = [r for batch in _backward(Shape(4, "<f4", 200, 32), 24)(rows) for r in batch.to_pylist()]
    assert [np.frombuffer(r["a"], "<i8").tolist() for r in told] == [[*range(100, 76, -1), *range(40, 24, -1)]]


def test_few_and_no_vectors(frame):
    few = [(0, [1.0, 2.0], "", 1), (3, [2.0, 1.0], "", 1), (10, [-1.0, 0.5], "", 1)]
    check(nearest(frame(few, SCHEMA), "id % 10 = 0").collect(), plain(few, 10, 20), 1)
    assert nearest(frame([], SCHEMA), "id % 10 = 0").count() == 0
    assert nearest(frame(few[:1], SCHEMA), "id % 10 = 0").count() == 0


def vectors_of(spark, rows):
    """A frame of single precision vectors with their places as ids, and the true neighbours of every twentieth."""
    rows = rows.astype(np.float32)
    table = pa.table({"vec_id": np.arange(len(rows)), "embedding": pa.array(list(rows), pa.list_(pa.float32()))})
    exact, want = rows.astype(float), {}
    for q in range(0, len(rows), 20):
        score = exact @ exact[q]
        score[q] = -np.inf
        near = np.argsort(-score, kind="stable")[:20]
        want[q] = [(-score[j], j) for j in near.tolist()]
    return spark.createDataFrame(table).repartition(8), want


def test_a_third_are_near_copies(spark):
    rng = np.random.default_rng(8)
    rows = rng.standard_normal((6000, 64))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    near = rng.permutation(6000)[:2000]
    rows[near] = rows[near[0]] + 0.0003 * rng.standard_normal((2000, 64))
    df, want = vectors_of(spark, rows)
    group = {q: best for q, best in want.items() if q in set(near.tolist())}
    got = nearest(df, "id % 20 = 0").where(F.col("query_id").isin(list(group))).collect()
    check(got, group, 0.9)


def test_graph_settles_on_many_vectors(spark):
    rng = np.random.default_rng(4)
    rows = rng.standard_normal((20000, 32))
    df, _ = vectors_of(spark, rows / np.linalg.norm(rows, axis=1, keepdims=True))
    shape = Shape(32, "<f4", 3000, 32)
    nodes = stored(_nodes(stored(distinct_vectors(df, 21), "exact"), shape, 4), "nodes")
    exact, found, hits = rows / np.linalg.norm(rows, axis=1, keepdims=True), {}, 0
    node = {r["place"]: r["node"] for r in nodes.select("place", "node").collect()}
    assert sorted(node) == list(range(20000))
    for row in neighbour_graph(nodes, stored(_blocks(nodes, shape), "blocks"), shape).collect():
        a, b, score, _ = _edges(row.asDict())
        assert (a // 3000 == row["block"]).all() and (a != b).all() and row["edges"] == len(a)
        for x, y in zip(a.tolist(), b.tolist()):
            found.setdefault(node[x], set()).add(node[y])
    assert {len(x) for x in found.values()} == {32}
    for a in range(0, 20000, 100):
        score = exact @ exact[a]
        score[a] = -np.inf
        hits += len(found[a] & set(np.argsort(-score)[:20].tolist()))
    assert hits >= 0.9 * 200 * 20


def test_query_recall(spark):
    folder = "/root/testdata/sf0.01"
    rows = duckdb.sql(f"select vec_id, embedding from '{folder}/embeddings.parquet'").fetchall()
    check(QUERIES["op2_neighbours"](spark, folder).collect(), plain(rows, 20, 20), 0.9)
