"""Trained operators against plain loops over single rows: the same models, written without vectors or batches."""

import math
from zlib import crc32

import duckdb
import pytest
from test_quality import PROSE, junk

from grainmill.llm.catalog import QUERIES, toxicity_labels
from grainmill.llm.chain import word_features
from grainmill.llm.html_blocks import blocks
from grainmill.llm.page_text import fit_labeller
from grainmill.llm.quality import BAD, GAIN, GOOD, LABELLERS, NONE, NOTHING, SLACK, Reader, fit_quality, score_quality, votes
from grainmill.llm.recurrent import HIDDEN, PATHS, WORDS
from grainmill.llm.toxicity import SATURATION, fit_toxicity

FOLDER = "/root/testdata/sf0.001"


def sigmoid(x):
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


# --- main text: a bidirectional LSTM, one block and one number at a time -------------------------


def block_input(block, i, n, weights):
    names = [x for x in block.path if x not in ("html", "body")]
    names = [*names, "/".join(names[-3:])]
    words = block.text.lower().split()
    paths = [weights["paths"][crc32(x.encode()) % PATHS].tolist() for x in names]
    vectors = [weights["words"][crc32(w.encode()) % WORDS].tolist() for w in words]
    mean = lambda rows, width: [sum(r[k] for r in rows) / len(rows) if rows else 0.0 for k in range(width)]
    size, place = len(block.text), i / max(1, n - 1)
    marks = sum(block.text.count(c) for c in ".,;:!?")
    numbers = [math.log1p(size) / 5, block.linked / max(size, 1), marks / max(len(words), 1), place, 1 - place, float(size < 30), float(size > 120)]
    return mean(paths, weights["paths"].shape[1]) + mean(vectors, weights["words"].shape[1]) + numbers


def states(rows, way, weights):
    into, state, bias = (weights[f"{way}_{n}"].tolist() for n in ("in", "state", "bias"))
    h, c, out = [0.0] * HIDDEN, [0.0] * HIDDEN, []
    for x in rows if way == "ahead" else reversed(rows):
        gates = list(bias)
        for value, row in [*zip(x, into), *zip(h, state)]:
            if value:
                gates = [g + value * w for g, w in zip(gates, row)]
        i, f, o = ([sigmoid(g) for g in gates[k * HIDDEN : (k + 1) * HIDDEN]] for k in range(3))
        g = [math.tanh(v) for v in gates[3 * HIDDEN :]]
        c = [b * d + a * e for a, b, d, e in zip(i, f, c, g)]
        h = [a * math.tanh(b) for a, b in zip(o, c)]
        out.append(h)
    return out if way == "ahead" else out[::-1]


def plain_text(page, weights):
    found = blocks(page or "")
    rows = [block_input(b, i, len(found), weights) for i, b in enumerate(found)]
    out = [w[0] for w in weights["out"].tolist()]
    kept = []
    for b, x, ahead, back in zip(found, rows, states(rows, "ahead", weights), states(rows, "back", weights)):
        if sum(v * w for v, w in zip(ahead + back + x, out)) + float(weights["out_bias"][0]) > 0:
            kept.append(b.text)
    return "\n".join(kept)


def test_page_texts_like_plain_loops(spark):
    weights = fit_labeller(spark.read.parquet(f"{FOLDER}/pages.parquet"))
    got = {r["page_id"]: r["text"] for r in QUERIES["op8_page_text"](spark, FOLDER).collect()}
    pages = duckdb.sql(f"select page_id, html from '{FOLDER}/pages.parquet'").fetchall()
    assert got == {page: plain_text(text, weights) for page, text in pages}


# --- toxicity: forward and backward sums over one text -------------------------------------------


def plain_score(text, model):
    chain = model.chain
    words = (text or "").lower().split()
    tables = [w.tolist() for w in (chain.own, chain.before, chain.after)]
    weight = {w: [sum(t[f] for f in word_features(w, chain.size)) for t in tables] for w in set(words)}
    own = []
    for i, w in enumerate(words):
        x = weight[w][0] + (weight[words[i - 1]][1] if i else 0.0) + (weight[words[i + 1]][2] if i + 1 < len(words) else 0.0)
        own.append(max(-30.0, min(30.0, x)))
    move = [[math.exp(x) for x in row] for row in chain.moves.tolist()]
    ahead, back = [], [(0.5, 0.5)] * len(words)
    for i, x in enumerate(own):
        if i == 0:
            pair = 1.0, math.exp(float(chain.first))
        else:
            a, b = ahead[-1]
            pair = a * move[0][0] + b * move[1][0], a * move[0][1] + b * move[1][1]
        pair = pair[0], pair[1] * math.exp(x)
        total = sum(pair)
        ahead.append((pair[0] / total, pair[1] / total))
    for i in range(len(words) - 2, -1, -1):
        a, b = back[i + 1][0], back[i + 1][1] * math.exp(own[i + 1])
        pair = move[0][0] * a + move[0][1] * b, move[1][0] * a + move[1][1] * b
        back[i] = pair[0] / sum(pair), pair[1] / sum(pair)
    odds = [f[1] * b[1] / (f[0] * b[0]) for f, b in zip(ahead, back)]
    total, expected = sum(math.log1p(o) for o in odds), sum(o / (1 + o) for o in odds)
    largest = max((o / (1 + o) for o in odds), default=0.0)
    evidence = [1.0, min(total, SATURATION) ** 0.5, math.log1p(expected), largest]
    return sigmoid(sum(x * w for x, w in zip(evidence, model.weights.tolist())))


def test_toxicity_like_plain_loops(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = fit_toxicity(docs.select("doc_id", "text"), toxicity_labels(spark, FOLDER))
    assert model.chain is not None
    got = {r["doc_id"]: (r["score"], r["predicted"]) for r in QUERIES["op7_toxicity"](spark, FOLDER).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        score = plain_score(r["text"], model)
        assert got[r["doc_id"]][0] == pytest.approx(score, abs=1e-5)
        assert got[r["doc_id"]][1] == int(score >= 0.7) or abs(score - 0.7) < 1e-5


# --- quality: expectation-maximisation over documents, and a scorer with a dictionary of weights --


def plain_posteriors(rows, rounds=200):
    """The chance that each document is good, from its votes; `rows` are lists of votes."""
    start = {BAD: [0.4, 0.4, 0.2], GOOD: [0.05, 0.75, 0.2]}
    rates = {c: [list(start[c]) for _ in range(LABELLERS)] for c in (BAD, GOOD)}
    good, posterior = 0.8, [0.8] * len(rows)
    for _ in range(rounds):
        turned = []
        for row in rows:
            logs = {c: math.log(p) + sum(math.log(rates[c][k][v]) for k, v in enumerate(row)) for c, p in ((BAD, 1 - good), (GOOD, good))}
            turned.append(1 / (1 + math.exp(logs[BAD] - logs[GOOD])))
        done = max(abs(a - b) for a, b in zip(turned, posterior)) < 1e-9
        posterior = turned
        for c in (BAD, GOOD):
            share = [p if c == GOOD else 1 - p for p in posterior]
            for k in range(LABELLERS):
                for v in (BAD, GOOD, NONE):
                    hits = sum(s for s, row in zip(share, rows) if row[k] == v)
                    rates[c][k][v] = (hits + 2 * start[c][v]) / (sum(share) + 2)
        good = min(0.95, max(0.05, (sum(posterior) + 8) / (len(rows) + 10)))
        if done:
            break
    return posterior


def plain_shares(text):
    c = Reader().count([text])
    shares = {}
    for f in c.features.tolist():
        shares[f] = shares.get(f, 0.0) + GAIN / (c.words[0] + SLACK)
    return shares


def plain_scorer(texts, labels, rounds=150):
    weights, steps = {}, {}
    rows = [plain_shares(t) for t in texts]
    good = min(0.99, max(0.01, sum(labels) / len(labels)))
    bias = math.log(good / (1 - good))
    for _ in range(rounds):
        gradient = {f: -1e-4 * w for f, w in weights.items()}
        for row, y in zip(rows, labels):
            rest = (y - sigmoid(bias + sum(weights.get(f, 0.0) * s for f, s in row.items()))) / len(rows)
            for f, s in row.items():
                gradient[f] = gradient.get(f, 0.0) + rest * s
        gradient.pop(NOTHING, None)
        for f, g in gradient.items():
            steps[f] = steps.get(f, 0.0) + g * g
            weights[f] = weights.get(f, 0.0) + 0.3 * g / (math.sqrt(steps[f]) + 1e-8)
    return weights, bias


def test_quality_like_plain_loops(frame):
    texts = [PROSE * (2 + i % 3) + f"and so on for {i} more days." for i in range(24)] + [junk(i) for i in range(8)] + ["a few words only"]
    docs = frame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["quality_score"] for r in score_quality(docs, fit_quality(docs)).collect()}
    posterior = plain_posteriors([votes(Reader().count([t]))[0].tolist() for t in texts])
    weights, bias = plain_scorer(texts, posterior)
    for i, text in enumerate(texts):
        assert got[i] == pytest.approx(sigmoid(bias + sum(weights.get(f, 0.0) * s for f, s in plain_shares(text).items())), abs=1e-4)
