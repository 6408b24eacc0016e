import itertools
import random

import numpy as np
import pytest

from grainmill.llm.catalog import QUERIES, TOXIC
from grainmill.llm.chain import ChainField, Tagger, emissions, fit, odds
from grainmill.llm.toxicity import fit_toxicity, score_toxicity

PLAIN = [a + b for a, b in itertools.product("ba ke lo mi nu ra se ti vo wu".split(), "den ler mit nos pa rin sul tam ver zo".split())]
RUDE = [f"{a}{b}" for a in ("grox", "vlim") for b in ("ak", "ed", "ish", "or", "un", "y")]


def made(rng, n, rude):
    words = rng.choices(PLAIN, k=n)
    for _ in range(rude):
        words[rng.randrange(n)] = rng.choice(RUDE) + rng.choice(["", ",", "."])
    return " ".join(words)


def corpus(n=400):
    rng = random.Random(8)
    return [(i, made(rng, rng.randint(20, 80), rng.randint(3, 6) if i % 4 == 0 else 0), int(i % 4 == 0)) for i in range(n)]


def test_marginals_are_those_of_all_taggings():
    rng = np.random.default_rng(0)
    model = ChainField(moves=rng.normal(size=(2, 2)), first=0.4)
    lengths = np.array([3, 0, 5, 1, 2])
    logits = rng.normal(size=lengths.sum()) * 2
    ahead, back = odds(logits, lengths, model)
    at = 0
    for n in lengths.tolist():
        own, weight = logits[at : at + n], np.zeros((n, 2))
        for tags in itertools.product((0, 1), repeat=n):
            score = sum(own[i] for i in range(n) if tags[i]) + sum(model.moves[a, b] for a, b in zip(tags, tags[1:])) + model.first * (n > 0 and tags[0])
            for i, t in enumerate(tags):
                weight[i, t] += np.exp(score)
        assert (ahead * back)[at : at + n] == pytest.approx(weight[:, 1] / weight[:, 0])
        at += n


def test_neighbours_count_within_a_sequence_only():
    got = emissions(np.array([0, 1, 1]), np.array([2, 0, 1]), np.array([1.0, 2.0]), np.array([10.0, 20.0]), np.array([100.0, 200.0]))
    assert got.tolist() == pytest.approx([1 + 200, 2 + 10, 2]) or got.max() <= 30


def test_field_learns_tags():
    rng = random.Random(1)
    sequences = [rng.choices(PLAIN, k=12) for _ in range(200)]
    tags = []
    for s in sequences:
        own = [0] * 12
        if rng.random() < 0.5:
            at = rng.randrange(12)
            s[at], own[at] = rng.choice(RUDE[:9]), 1
        tags += own
    found, lengths = Tagger(fit(sequences, np.array(tags))).marginals([" ".join(PLAIN[:30]), "baden groxun, keler vlimy", ""])
    assert (found[:30] < 0.1).all() and (found[30:] > 1).tolist() == [False, True, False, True] and lengths.tolist() == [30, 4, 0]


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame([(i, t) for i, t, _ in corpus()], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in corpus()] + [(0, 1), (None, 1), (9, None), (11, 7)], "id long, label int")
    return fit_toxicity(docs, labels)


def test_scores_and_spans(frame, model):
    rng = random.Random(77)
    rows = [(i, made(rng, 40, 4 if i % 2 else 0), "x") for i in range(60)]
    rows += [(100, None, "x"), (101, "", "x"), (102, "  groxy\n GROXED, baden", "x"), (103, "baden keler " * 8000 + "vlimor", "x"), (None, "groxak groxed vlimy", "x")]
    got = {r["doc_id"]: r for r in score_toxicity(frame(rows + rows[:2], "doc_id long, text string, score string"), model).collect()}
    assert all((got[i]["score"] >= TOXIC) == bool(i % 2) for i in range(60))
    assert got[100]["score"] == got[101]["score"] < 0.5 and got[100]["toxic_spans"] == [] == got[101]["toxic_spans"]
    assert got[102]["score"] >= TOXIC and [(s["start"], s["end"]) for s in got[102]["toxic_spans"]] == [(2, 16)]
    assert [(s["start"], s["end"]) for s in got[103]["toxic_spans"]] == [(96000, 96006)]
    assert got[None]["score"] >= TOXIC
    for i in range(1, 60, 2):
        text = rows[i][1]
        assert all(w.strip(",.") in RUDE for s in got[i]["toxic_spans"] for w in text[s["start"] : s["end"]].split())


def test_nothing_to_learn(frame):
    docs = frame([(1, "a b"), (2, None)], "doc_id long, text string")
    for labels in ([], [(1, 0)], [(1, 0), (2, 1)], [(None, 1), (1, None)]):
        flat = fit_toxicity(docs, frame(labels, "id long, label int"))
        assert flat.chain is None
        scores = [r["score"] for r in score_toxicity(docs, flat, spans=False).collect()]
        assert len(set(scores)) == 1 and 0 <= scores[0] <= 1
    empty = frame([], "doc_id long, text string")
    assert score_toxicity(empty, fit_toxicity(empty, frame([(1, 1), (2, 0)], "id long, label int"))).count() == 0


def test_query_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = QUERIES["op7_toxicity"](spark, folder).join(labels, "doc_id").where("held_out").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"] == 1]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert sum(toxic) >= 0.6 * len(toxic) and sum(clean) <= 0.02 * len(clean)
