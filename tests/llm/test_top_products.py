import math
import random

import numpy as np
import oracle
import pytest

from grainmill.llm.catalog import QUERIES, SQL
from grainmill.llm.top_products import top_products, whole_vectors

SCHEMA = "vec_id long, embedding array<float>, score string, rank int"


def plain(rows, step, k, scale=256):
    kept = {}
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(scale * float(np.float32(x))) for x in v]
        kept[i] = min(kept.get(i, whole), whole)
    out = []
    for i, q in kept.items():
        if i % step == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in kept.items() if j != i)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("block,spread,part", [(4096, 0.0, 1024), (7, 0.0, 2), (7, 2.0, 1024), (1, 1.0, 3)])
def test_like_all_pairs(frame, block, spread, part, monkeypatch):
    monkeypatch.setattr("grainmill.llm.top_products.PART", part)
    rng = random.Random(block)
    rows = [(i, [rng.gauss(0, 1) * math.exp(spread * rng.gauss(0, 1)) for _ in range(9)], "x", 1) for i in range(90)]
    rows += [(i, rows[3][1], "copy", 1) for i in range(200, 260)]  # ties
    rows += [(i, [rng.gauss(0, 0.01) for _ in range(5)], "short", 1) for i in range(300, 310)] + [(400, [], "", 1), (420, [0.0] * 9, "", 1)]
    rows += [(500, None, "", 1), (510, [1.0, None], "", 1), (520, [math.nan], "", 1), (530, [math.inf, 1.0], "", 1), (None, [1.0], "", 1)]
    rows += [(10, [9.0] * 9, "again", 2), (10, [-9.0] * 9, "again", 2)]
    got = top_products(whole_vectors(frame(rows, SCHEMA)), "id % 10 = 0", 5, block)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect())) == plain(rows, 10, 5)


def test_few_and_no_vectors(frame):
    few = [(0, [1.0, 2.0], "", 1), (3, [2.0, 1.0], "", 1)]
    assert sorted(map(tuple, top_products(whole_vectors(frame(few, SCHEMA)), "id % 10 = 0").collect())) == plain(few, 10, 5)
    for rows in ([], few[:1], [(0, [], "", 1)]):
        assert top_products(whole_vectors(frame(rows, SCHEMA)), "id % 10 = 0").count() == 0


def test_query_and_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert oracle.compare(QUERIES["op9_top_products"](spark, folder), oracle.connect(folder), SQL["op9_top_products"]) == []
