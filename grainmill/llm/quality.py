"""Document quality from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document. Expectation-maximisation over
the counts of vote patterns of all documents estimates how each labeller votes on good and on bad ones; the
posterior of a document's pattern is its label. These labels train a linear scorer over hashed word shapes
of the whole text, which also judges documents on which no labeller votes.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.batches import Words, field_list, in_chunks
from grainmill.llm.staging import by_hash, forget, stored

BAD, GOOD, NONE = 0, 1, 2
#: Hash space of word shapes and their runs.
DIMS = 1 << 14
#: The feature of a run that would begin before the text; its weight is zero.
NOTHING = DIMS
#: Shares of features are small numbers; this brings them near one.
GAIN = 10.0
#: Words added to the length of a text in its shares, so that a few words decide little.
SLACK = 20


#: What is known of a word.
ATTRIBUTES = ("letters", "capitals", "chars", "symbols", "doubled_mark", "only_symbols", "clause_end", "short", "natural")
LOWER, UPPER, DIGIT, MARK, CLAUSE, SYMBOL = range(6)


@functools.cache
def _classes() -> np.ndarray:
    """The class of each code point."""
    out = np.full(0x110000, SYMBOL, np.uint8)
    for i in range(0x110000):
        c = chr(i)
        if c.isalnum():
            out[i] = UPPER if c.isupper() else LOWER if c.isalpha() else DIGIT
    out[[ord(c) for c in "'\"()-"]] = MARK
    out[[ord(c) for c in ".,;:!?"]] = CLAUSE
    return out


def describe(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The attributes of words, and a hash of their shapes: letters as a or A, digits as 0, runs of one kind cut to two.

    `Thou12***` has the shape `Aaa00**`.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    kinds = _classes()[points]
    ends = np.cumsum(lengths)
    starts, final = ends - lengths, ends - 1

    def total(where):
        return np.add.reduceat(where.astype(np.int64), starts)

    capitals, symbols = total(kinds == UPPER), total(kinds == SYMBOL)
    letters = total(kinds == LOWER) + capitals
    doubled = (lengths > 2) & (kinds[final] > DIGIT) & (points[final] == points[final - 1])
    stem = lengths - (kinds[final] == CLAUSE)
    attributes = [
        letters,
        capitals,
        lengths,
        symbols,
        doubled,
        symbols == lengths,
        (kinds[final] == CLAUSE) & ~doubled,
        (letters > 0) & (letters <= 3),
        (letters == stem) & (stem > 0) & ((capitals <= 1) | (stem == 1)),
    ]
    own = np.where(kinds <= DIGIT, kinds, points + 8).astype(np.uint64)
    same = np.append(False, own[1:] == own[:-1])
    same[starts] = False
    kept = ~(same & np.append(False, same[:-1]))
    kept[starts] = True
    upto = np.append(0, np.cumsum(kept))
    place = upto[:-1] - np.repeat(upto[starts], lengths)
    powers = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))
    parts = np.where(kept, (own + np.uint64(1)) * powers[place & 63], np.uint64(0))
    shapes = np.add.reduceat(parts, starts)
    return np.stack(attributes, axis=1).astype(np.float32), (shapes >> np.uint64(33)).astype(np.int64)


@dataclass
class Counted:
    """Sums over the words of each text of a batch, and the hashed features of the words, end to end."""

    sums: np.ndarray
    words: np.ndarray
    echoes: np.ndarray  # words equal to one of the two before
    fluent: np.ndarray  # natural words that differ from the one before
    repeated_lines: np.ndarray  # share of lines seen before in the text
    features: np.ndarray
    lengths: np.ndarray  # features of each text


class Reader:
    """Counts texts; keeps what it knows of up to `keep` words."""

    def __init__(self, keep: int = 200_000):
        self.keep = keep
        self._forget()

    def _forget(self):
        self.known, self.attributes, self.shapes = Words(), np.zeros((0, len(ATTRIBUTES)), np.float32), np.zeros(0, np.int64)

    def count(self, texts: list[str]) -> Counted:
        if len(self.known) > self.keep:
            self._forget()
        parts, lines = [], []
        for text in texts:
            words = text.split()
            parts.append(np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)))
            rows = [r for r in text.split("\n") if r.strip()]
            lines.append(1 - len(set(rows)) / len(rows) if rows else 0.0)
        if self.known.fresh:
            attributes, shapes = describe(self.known.fresh)
            self.attributes = np.concatenate((self.attributes, attributes))
            self.shapes = np.concatenate((self.shapes, shapes))
            self.known.fresh = []
        n = np.fromiter(map(len, parts), np.int64, len(parts))
        codes = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        full = n > 0
        starts = (np.cumsum(n) - n)[full]
        sums = np.zeros((len(texts), len(ATTRIBUTES)))
        if len(starts):
            sums[full] = np.add.reduceat(self.attributes[codes], starts, axis=0)
        inside = np.ones(len(codes), bool)  # has a word before it
        inside[starts] = False
        after = np.roll(inside, 1) & inside  # has two
        same = inside & (codes == np.roll(codes, 1))
        marks = np.stack((same | (after & (codes == np.roll(codes, 2))), (self.attributes[codes, -1] > 0) & ~same), axis=1)
        both = np.zeros((len(texts), 2))
        if len(starts):
            both[full] = np.add.reduceat(marks, starts, axis=0, dtype=np.int64)
        one = self.shapes[codes]
        two = np.where(inside, (one * 31 + np.roll(one, 1) * 7 + 3) % DIMS, NOTHING)
        three = np.where(after, (one * 17 + np.roll(one, 1) * 13 + np.roll(one, 2) * 5 + 11) % DIMS, NOTHING)
        features = np.stack((one % DIMS, two, three, np.where(same, 1, NOTHING)), axis=1).ravel()
        return Counted(sums, n, *both.T, np.array(lines), features, 4 * n)


def votes(c: Counted) -> np.ndarray:
    """A vote of each labeller (columns) on each text: 0 bad, 1 good, 2 none. Texts under eight words get none."""
    n = np.maximum(c.words, 1)
    letters, capitals, chars, symbols, doubled, bare, ends, short, _ = c.sums.T
    odd = (symbols + np.maximum(capitals - 0.1 * letters, 0)) / np.maximum(chars, 1)

    def vote(value, good, bad, least=8):
        """Good up to `good`, bad from `bad` on."""
        return np.where(c.words < least, NONE, np.where(value <= good, GOOD, np.where(value >= bad, BAD, NONE)))

    return np.stack(
        [
            vote(1 - c.fluent / n, 0.15, 0.40),
            vote(np.abs(ends / n - 0.20), 0.16, 0.18, 40),
            vote(odd, 0.02, 0.06),
            vote(c.echoes / n, 0.08, 0.30),
            vote(np.abs(short / n - 0.40), 0.25, 0.37, 20),
            vote(doubled / n, 0.02, 0.20),
            vote(capitals / np.maximum(letters, 1), 0.15, 0.50),
            vote(bare / n, 0.05, 0.20),
            vote(c.repeated_lines, 0.05, 0.40),
        ],
        axis=1,
    )


LABELLERS = 9


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of good for each vote pattern, and `rates[class, labeller, vote]`, by expectation-maximisation.

    Starts from labellers that find 40 % of the bad and blame 5 % of the good; a few pseudo-counts keep
    rates off zero. Patterns without a vote get the share of good documents.
    """
    rates = np.tile(np.array([[[0.4, 0.4, 0.2]], [[0.05, 0.75, 0.2]]]), (1, patterns.shape[1], 1))
    good = 0.8
    seen = np.stack([patterns == v for v in (BAD, GOOD, NONE)], axis=2).astype(float)
    total = max(1.0, float(counts.sum()))
    posterior = np.full(len(patterns), good)
    for _ in range(rounds):
        logs = np.einsum("plv,clv->cp", seen, np.log(rates)) + np.log([[1 - good], [good]])
        turned = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
        done = np.abs(turned - posterior).max(initial=0) < 1e-9
        posterior = turned
        weights = np.stack((1 - posterior, posterior)) * counts
        start = np.array([[[0.4, 0.4, 0.2]], [[0.05, 0.75, 0.2]]])
        rates = (np.einsum("cp,plv->clv", weights, seen) + 2 * start) / (weights.sum(axis=1)[:, None, None] + 2)
        good = float(np.clip((weights[1].sum() + 8) / (total + 10), 0.05, 0.95))
        if done:
            break
    return posterior, rates


@dataclass
class QualityModel:
    weights: np.ndarray  # of the hashed features
    bias: float
    rates: np.ndarray  # how each labeller votes: [class, labeller, vote]

    def accuracies(self) -> np.ndarray:
        """The share of right votes of each labeller among its votes, both classes counted alike."""
        bad, good = self.rates
        right = bad[:, BAD] / (bad[:, BAD] + bad[:, GOOD]) + good[:, GOOD] / (good[:, BAD] + good[:, GOOD])
        return right / 2


def _pattern(table: np.ndarray) -> np.ndarray:
    return table @ 3 ** np.arange(table.shape[1])


def weak_labels(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`(id, pattern)`: the votes on every document as one number in base 3, stored. Null and empty texts get no vote."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            found = [_pattern(votes(reader.count(texts[part]))) for part in in_chunks(texts)]
            found = pa.array(np.concatenate(found) if found else [], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["id", "pattern"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return stored(rows.mapInArrow(run, "id long, pattern long"), "votes")


def _features(docs: DataFrame) -> DataFrame:
    """Distinct hashed features of each text with their shares."""

    def run(batches):
        reader = Reader()
        for batch in batches:
            found, shares = [], []
            for text in batch.column("text").to_pylist():
                c = reader.count([text or ""])
                ids, n = np.unique(c.features, return_counts=True)
                found.append(ids)
                shares.append(GAIN * n / (c.words[0] + SLACK))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.int64())), pa.array(shares, pa.list_(pa.float64())), batch.column("label")],
                names=["found", "shares", "label"],
            )

    return docs.mapInArrow(run, "found array<long>, shares array<double>, label double")


def _train(rows: list, rounds: int = 150, rate: float = 0.3, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights of the logistic scorer for soft labels. Its bias is the share of good documents, so short texts lean to that."""
    weights = np.zeros(DIMS + 1)
    if not rows:
        return weights, 0.0
    found = np.concatenate([np.asarray(r["found"], np.int64) for r in rows])
    shares = np.concatenate([np.asarray(r["shares"], float) for r in rows])
    doc = np.repeat(np.arange(len(rows)), [len(r["found"]) for r in rows])
    labels = np.array([r["label"] for r in rows])
    good = np.clip(labels.mean(), 0.01, 0.99)
    bias, steps = float(np.log(good / (1 - good))), np.zeros(DIMS + 1)
    for _ in range(rounds):
        logits = bias + np.bincount(doc, weights[found] * shares, minlength=len(rows))
        rest = (labels - 1 / (1 + np.exp(-np.clip(logits, -30, 30)))) / len(rows)
        gradient = np.bincount(found, rest[doc] * shares, minlength=DIMS + 1) - ridge * weights
        gradient[NOTHING] = 0
        steps += gradient**2
        weights += rate * gradient / (np.sqrt(steps) + 1e-8)
    return weights, bias


def fit_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_docs: int = 6000) -> QualityModel:
    """Labeller rates from the votes on all documents, and a scorer trained on `fit_docs` of them at most.

    The sample is picked by a hash of the id; a null id, text or an empty text is not picked, of a repeated
    id the least text. The driver sees the counts of vote patterns (at most 3 to the power of the number of
    labellers, whatever the size of the corpus) and the hashed features of the sample. Without documents
    every score is that of the bias, one half.
    """
    voted = weak_labels(docs, id_col, text_col)
    counts = voted.groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").collect()
    codes = np.array([r["pattern"] for r in counts], np.int64)
    patterns = codes[:, None] // 3 ** np.arange(LABELLERS) % 3
    posterior, rates = estimate(patterns, np.array([r["n"] for r in counts], float))
    known = docs.sparkSession.createDataFrame(list(zip(codes.tolist(), posterior.tolist())), "pattern long, label double")
    picked = voted.where("id IS NOT NULL").groupBy("id").agg(F.min("pattern").alias("pattern"))
    picked = by_hash(picked, "id", fit_docs, sum(r["n"] for r in counts), 11).join(F.broadcast(known), "pattern")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("trim(text) <> ''")
    texts = texts.join(F.broadcast(picked), "id").groupBy("id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    weights, bias = _train(_features(texts.select("text", "label")).collect())
    forget(voted)
    return QualityModel(weights.astype(np.float32), bias, rates)


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", into: str = "quality_score") -> DataFrame:
    """Every column of `docs` but one named so before, with the probability that the document is good.

    Whole texts are read. A text that is null or has no words scores 0.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop(into)

    def run(batches):
        reader, model = Reader(), held.value
        for batch in batches:
            texts = [x or "" for x in batch.column(text_col).to_pylist()]
            scores = []
            for part in in_chunks(texts):
                c = reader.count(texts[part])
                full = c.words > 0
                logits = np.zeros(len(full))
                if full.any():
                    starts = (np.cumsum(c.lengths) - c.lengths)[full]
                    logits[full] = np.add.reduceat(model.weights[c.features], starts, dtype=float) * GAIN / (c.words[full] + SLACK)
                scores.append(np.where(full, 1 / (1 + np.exp(-np.clip(logits + model.bias, -30, 30))), 0.0))
            yield batch.append_column(into, pa.array(np.concatenate(scores) if scores else np.zeros(0)))

    return kept.mapInArrow(run, f"{field_list(kept.schema)}, `{into}` double")
