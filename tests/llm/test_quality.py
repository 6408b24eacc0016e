import numpy as np
import pytest

from grainmill.llm.catalog import GOOD, QUERIES
from grainmill.llm.quality import Reader, describe, estimate, fit_quality, score_quality, votes

PROSE = "The quick brown fox, it seems, was not so quick as they had said of it. "


def junk(i):
    words = [f"{w}{'abcdefgh'[i % 8]}" for w in "some other words that stand here now".split()]
    kinds = [" ".join(w.upper() + "!!" for w in words), " ".join(w + "%%%" for w in words), " | ".join(words), " ".join(w for w in words for _ in range(9))]
    return " ".join([kinds[i % 4]] * 8)


def test_words_are_described():
    found, shapes = describe(["Thou12***", "a", "ABC,", "|", "é!!", "don't", "x."])
    assert found.astype(int).tolist() == [
        [4, 1, 9, 3, 1, 0, 0, 0, 0],
        [1, 0, 1, 0, 0, 0, 0, 1, 1],
        [3, 3, 4, 0, 0, 0, 1, 1, 0],
        [0, 0, 1, 1, 0, 1, 0, 0, 0],
        [1, 0, 3, 0, 1, 0, 0, 1, 0],
        [4, 0, 5, 0, 0, 0, 0, 0, 0],
        [1, 0, 2, 0, 0, 0, 1, 1, 1],
    ]
    same = describe(["abcd", "zzzéz", "ab", "Abcd", "ab1", "abc22", "abc2222"])[1]
    assert same[0] == same[1] == same[2] != same[3] and same[4] != same[5] == same[6]


def test_counts_do_not_depend_on_the_batch():
    texts = ["", "one", PROSE * 3, junk(0), "a a b a", "  ", junk(3), "x\n\nx\nx"]
    together = Reader().count(texts)
    for i, text in enumerate(texts):
        own = Reader().count([text])
        assert (together.sums[i] == own.sums[0]).all() and together.words[i] == own.words[0]
        assert (together.echoes[i], together.fluent[i], together.repeated_lines[i]) == (own.echoes[0], own.fluent[0], own.repeated_lines[0])
        ends = np.cumsum(together.lengths)
        assert (together.features[ends[i] - together.lengths[i] : ends[i]] == own.features).all()
    assert (votes(Reader().count([""])) == 2).all()


def test_expectation_maximisation_finds_the_rates():
    rng = np.random.default_rng(4)
    good = rng.random(40_000) < 0.8
    right = np.array([0.95, 0.9, 0.8, 0.7, 0.6])
    table = np.where(rng.random((len(good), 5)) < right, good[:, None], ~good[:, None]).astype(int)
    table[rng.random(table.shape) < 0.3] = 2  # no vote
    patterns, counts = np.unique(table, axis=0, return_counts=True)
    posterior, rates = estimate(patterns, counts.astype(float))
    voted = rates[:, :, :2] / rates[:, :, :2].sum(axis=2, keepdims=True)
    assert voted[1, :, 1] == pytest.approx(right, abs=0.03) and voted[0, :, 0] == pytest.approx(right, abs=0.05)
    lookup = {tuple(p): x for p, x in zip(patterns.tolist(), posterior)}
    assert np.mean([(lookup[tuple(r)] > 0.5) == g for r, g in zip(table.tolist(), good)]) > 0.93


def test_documents(frame):
    rows = [(i, PROSE * (2 + i % 5) + f"and so on for {i} more days.", "x") for i in range(120)] + [(200 + i, junk(i), "x") for i in range(24)]
    odd = [(300, None, "x"), (301, "", "x"), (302, " \n ", None), (None, PROSE * 4, "x"), (5, rows[5][1], "x"), (303, PROSE * 3000, "x")]
    docs = frame(rows + odd, "doc_id long, text string, quality_score string")
    got = score_quality(docs, fit_quality(docs, fit_docs=80))
    assert got.columns == ["doc_id", "text", "quality_score"]
    score = {r["doc_id"]: r["quality_score"] for r in got.collect()}
    assert got.count() == len(rows + odd)
    assert all(score[i] >= GOOD for i in [*range(120), None, 303]) and all(score[200 + i] < GOOD for i in range(24))
    assert score[300] == score[301] == score[302] == 0


def test_no_documents(frame):
    empty = frame([], "doc_id long, text string")
    model = fit_quality(empty)
    assert score_quality(empty, model).count() == 0
    assert [r["quality_score"] for r in score_quality(frame([(1, "a b c")], "doc_id long, text string"), model).collect()] == [0.5]


def test_query_agrees_with_the_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = QUERIES["op1_quality"](spark, folder).join(labels, "doc_id").collect()
    bad = [r["predicted"] for r in rows if r["quality"] == 0]
    good = [r["predicted"] for r in rows if r["quality"] == 1]
    assert sum(bad) <= 0.05 * len(bad) and sum(good) >= 0.98 * len(good)
