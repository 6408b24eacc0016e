import random
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from grainmill.llm.catalog import QUERIES, SQL
from grainmill.llm.merkle import Tree, digest, fold, height, leaf_digest, proof_steps, prove, suffixes

import oracle


def levels_of(leaves, fan):
    levels = [leaves]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([digest("".join(low[i : i + fan])) for i in range(0, len(low), fan)])
    return levels


def siblings_of(levels, at, fan):
    found = []
    for low in levels[:-1]:
        start = at // fan * fan
        found.append((at - start, "".join(low[start:at] + low[at + 1 : start + fan])))
        at //= fan
    return found


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 70), st.integers(2, 5))
def test_sweeps_like_whole_levels(n, fan):
    leaves = [digest(str(i)) for i in range(n)]
    levels = levels_of(leaves, fan)
    assert height(n, fan) == len(levels) - 1
    tree = Tree(n, height(n, fan), fan)
    for i, leaf in enumerate(leaves):
        tree.add(i, leaf)
        assert len(tree.queue) <= fan * (len(levels) + 1)
    assert tree.top == levels[-1][0]
    found = dict(suffixes(leaves, height(n, fan), fan, ""))
    for i, leaf in enumerate(leaves):
        steps = proof_steps(found[i])
        assert steps == siblings_of(levels, i, fan)
        assert fold(leaf, steps) == levels[-1][0]


def plain(rows, fan):
    """The result by whole levels in memory."""
    trees = {}
    for i, tree, leaf, claim in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2] or "", r[3] is not None, r[3] or "")):
        trees.setdefault(tree, []).append((i, leaf or "", claim))
    order = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    levels = {t: levels_of([leaf for _, leaf, _ in trees[t]], fan) for t in order}
    upper = levels_of([levels[t][-1][0] for t in order], fan)
    root = upper[-1][0]
    found = []
    for at, t in enumerate(order):
        for i, (key, leaf, claim) in enumerate(trees[t]):
            steps = siblings_of(levels[t], i, fan) + siblings_of(upper, at, fan)
            folded = fold(leaf if claim is None else claim, steps)
            found.append((key, leaf, levels[t][-1][0], root, digest("".join(s for _, s in steps)), folded, folded == root))
    return sorted(map(repr, found))


@pytest.mark.parametrize("fan, depth", [(2, 1), (2, 3), (2, 10), (3, 2)])
def test_proofs_like_whole_levels(frame, fan, depth):
    draw = random.Random(fan * depth)
    names = [None, "", "en", "é", "z" * 300, "=", "e"]
    rows = [(draw.choice([None, *range(60)]), "en" if draw.random() < 0.5 else draw.choice(names), digest(str(i)), digest(f"x{i}") if i % 7 == 0 else None) for i in range(150)]
    rows += [(5, "one", digest("1"), None), (6, "two", None, None), (6, "two", None, None)] + [(7, "en", digest("same"), None)] * 9
    got = prove(frame([(*r, "x", 1) for r in rows], "id long, tree string, leaf string, claim string, place string, size int"), fan, depth)
    assert sorted(repr((r.id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified)) for r in got.collect()) == plain(rows, fan)


def test_one_row_and_none(frame):
    schema = "id long, tree string, leaf string, claim string"
    [row] = prove(frame([(1, None, "a", None)], schema)).collect()
    assert (row.subroot, row.root, row.proof, row.proof_sha256, row.verified) == ("a", "a", "", sha256(b"").hexdigest(), True)
    assert prove(frame([], schema)).count() == 0


def test_leaf_digest(frame):
    from pyspark.sql import functions as F

    rows = [(1, "é", None), (None, "", 2**62)]
    got = {r[0] for r in frame(rows, "a long, b string, c long").select(leaf_digest([F.col("a"), F.col("b"), F.col("c")])).collect()}
    assert got == {sha256("1:12:é-".encode()).hexdigest(), sha256(f"-0:19:{2**62}".encode()).hexdigest()}


def test_query_and_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert oracle.compare(QUERIES["op12_manifest"](spark, folder), oracle.connect(folder), SQL["op12_manifest"]) == []
