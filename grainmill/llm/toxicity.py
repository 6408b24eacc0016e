"""Toxic spans and document scores by a linear-chain conditional random field.

Only documents are labelled, so token labels come first: in a bounded sample of labelled documents a word,
or the beginning of words, that occurs in many different contexts of toxic documents and hardly in clean
ones marks its tokens. The field is fitted to the sample's passages with these tags; its features (the
word, its beginnings, ends and shape, the words around it) carry over to words that were never marked.
Forward-backward marginals over each whole text give spans with their offsets, and their sums a score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.batches import field_list, in_chunks
from grainmill.llm.chain import ChainField, Tagger, core, fit
from grainmill.llm.staging import by_hash, forget, stored

#: Lengths of word beginnings that may mark a token.
BEGINNINGS = range(3, 7)
#: Tokens of a passage that the field is fitted to.
PASSAGE = 32
#: Summed log odds beyond which a document can't look more toxic by them: some ten certain tokens.
SATURATION = 50.0
SPANS = "array<struct<start:int,end:int,marginal:double>>"


@dataclass
class ToxicityModel:
    chain: ChainField | None  # None: there was nothing to learn from
    weights: np.ndarray  # of [1, log(1 + summed odds), expected tokens, largest marginal]


def evidence(total: np.ndarray, largest: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """What a document's score is made of, from the marginals of its tokens; summed odds count up to `SATURATION`."""
    return np.stack((np.ones(len(total)), np.minimum(total, SATURATION) ** 0.5, np.log1p(expected), largest), axis=1)


def _document_sums(tagger: Tagger, texts: list[str]):
    """Sum of log(1 + odds), largest marginal and sum of marginals of each text; then the odds and token counts."""
    odds, lengths = tagger.marginals(texts)
    full = lengths > 0
    sums = np.zeros((3, len(texts)))
    if full.any():
        at = (np.cumsum(lengths) - lengths)[full]
        marginal = odds / (1 + odds)
        sums[0, full] = np.add.reduceat(np.log1p(odds), at)
        sums[1, full] = np.maximum.reduceat(marginal, at)
        sums[2, full] = np.add.reduceat(marginal, at)
    return sums, odds, lengths


def toxic_spans(text: str, odds: np.ndarray) -> list[dict]:
    """Runs of tokens that are toxic rather than not, as character offsets with their largest marginal."""
    spans: list[dict] = []
    last = -2
    for i, (token, x) in enumerate(zip(re.finditer(r"\S+", text), odds.tolist())):
        if x >= 1:
            marginal = x / (1 + x)
            if last == i - 1:
                spans[-1] |= {"end": token.end(), "marginal": max(spans[-1]["marginal"], marginal)}
            else:
                spans.append({"start": token.start(), "end": token.end(), "marginal": marginal})
            last = i
    return spans


def _sample(docs: DataFrame, labels: DataFrame, counts: dict[int, int], id_col: str, text_col: str, fit_docs: int) -> DataFrame:
    """`(text, label)` of up to `fit_docs` documents of each label, picked by a hash of the id, without most copies of each other."""
    one = labels.where("label IN (0, 1) AND id IS NOT NULL").groupBy("id").agg(F.max("label").alias("label"))
    picked = [by_hash(one.where(F.col("label") == x), "id", fit_docs, counts[x], 7) for x in (0, 1)]
    picked = F.broadcast(picked[0].union(picked[1]))  # at most 2 * fit_docs pairs of numbers
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(picked, "id")
    texts = texts.groupBy("id").agg(F.min("text").alias("text"), F.first("label").alias("label")).where("text IS NOT NULL")

    def marks(batches):
        for batch in batches:
            least = []
            for text in batch.column("text").to_pylist():
                words = text.split()
                runs = [" ".join(words[i : i + 5]).encode("utf-8", "surrogatepass") for i in range(max(1, len(words) - 4))]
                least.append([min(crc32(r, seed) for r in runs) for seed in (0, 1)])
            for seed in (0, 1):
                batch = batch.append_column(f"least{seed}", pa.array([x[seed] for x in least], pa.int64()))
            yield batch

    marked = texts.mapInArrow(marks, "id long, text string, label int, least0 long, least1 long")
    for name in ("least0", "least1"):  # copies share the least hash of their word runs
        first = F.min_by(F.struct("text", "label", "least1"), F.struct("label", "id")).alias("x")
        marked = marked.groupBy(name).agg(F.min("id").alias("id"), first).select("id", "x.text", "x.label", F.col("x.least1").alias("least1"))
    return marked.select("text", "label")


def _marking(sample: DataFrame, least_gain: float = 16.0, least_ratio: float = 20.0) -> set[str]:
    """Words and word beginnings (`ab*`) found in many contexts of toxic documents and hardly any of clean ones.

    They come from the bounded sample, so their number is bounded by its words.
    """

    def contexts(batches):
        for batch in batches:
            rows = set()
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                words = ["", *map(core, text.lower().split()), ""]
                for a, w, b in zip(words, words[1:], words[2:]):
                    rows.add((w, crc32(f"{a} {b}".encode("utf-8", "surrogatepass")), label))
            words, around, labels = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(around, pa.int64()), pa.array(labels, pa.int32())], names=["word", "around", "label"]
            )

    seen = sample.mapInArrow(contexts, "word string, around long, label int").distinct()
    sides = [F.sum(F.col("label")).alias("bad"), F.sum(1 - F.col("label")).alias("good")]
    words = stored(seen.groupBy("word").agg(*sides), "words")
    totals = words.agg(F.sum("bad"), F.sum("good")).first()
    if not totals[0] or not totals[1]:
        return set()
    share = totals[0] / (totals[0] + totals[1])
    starts = [F.concat(F.substring("word", 1, n), F.lit("*")) for n in BEGINNINGS]
    starts = F.array(*[F.when(F.length("word") > n, s) for n, s in zip(BEGINNINGS, starts)])
    begun = words.select(F.explode(starts).alias("word"), "bad", "good").where("word IS NOT NULL")
    begun = begun.groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    both = words.union(begun)
    n = F.col("bad") + F.col("good")
    part = F.col("bad") / n
    other = F.when(part < 1, (1 - part) * F.log((1 - part) / (1 - share))).otherwise(0.0)
    gain = n * (part * F.log(part / share) + other)
    ratio = (F.col("bad") + 0.5) / totals[0] / ((F.col("good") + 0.5) / totals[1])
    found = both.where("bad > 0").where((gain >= least_gain) & (ratio >= least_ratio))
    marked = {r["word"] for r in found.select("word").collect()}
    forget(words)
    return marked


def _marked(word: str, marking: set[str]) -> bool:
    inner = core(word)
    return inner in marking or any(f"{inner[:n]}*" in marking for n in BEGINNINGS if len(inner) > n)


def _passages(sample: DataFrame, marking: set[str], most: int) -> list[tuple[str, str]]:
    """Up to `most` passages with the tags of their words; those with marked words first, then by hash."""
    known = sample.sparkSession.sparkContext.broadcast(marking)

    def cut(batches):
        for batch in batches:
            rows = []
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                words = text.lower().split()
                for i in range(0, len(words), PASSAGE):
                    part = words[i : i + PASSAGE]
                    tags = "".join("1" if label and _marked(w, known.value) else "0" for w in part)
                    rows.append((" ".join(part), tags, "1" in tags))
            parts, tags, hits = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.string()), pa.array(tags, pa.string()), pa.array(hits, pa.bool_())], names=["part", "tags", "hit"]
            )

    rows = sample.mapInArrow(cut, "part string, tags string, hit boolean")
    halves = [rows.where("hit" if hit else "NOT hit").orderBy(F.xxhash64("part"), "part", "tags").limit(most // 2) for hit in (True, False)]
    return [(r["part"], r["tags"]) for r in halves[0].union(halves[1]).collect()]


#: Logits beyond this are cut.
LOGIT = 30.0


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 30) -> np.ndarray:
    weights, penalty = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -LOGIT, LOGIT)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ weights)
        weights = weights + np.clip(step, -5, 5)
    return weights


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_docs: int = 2500, fit_passages: int = 30_000
) -> ToxicityModel:
    """A model from `labels(id, label)`, label 1 for toxic.

    It is fitted to at most `fit_docs` documents of each label and `fit_passages` passages of them, picked by
    hash over all labelled documents; only these bounded samples and the marking words come to the driver.
    Labels other than 0 and 1, null ids and null texts take no part; of repeated labels the largest counts.
    Without documents of both labels, or with no marking word, there is no field and every score is the
    share of label 1 (0 without labels).
    """
    counts = {r["label"]: r["n"] for r in labels.where("label IN (0, 1)").groupBy("label").agg(F.count("*").alias("n")).collect()}
    base = counts.get(1, 0) / max(1, sum(counts.values()))
    flat = ToxicityModel(None, np.array([np.log((base + 1e-9) / (1 - base + 1e-9)), 0, 0, 0]))
    if len(counts) < 2:
        return flat
    sample = stored(_sample(docs, labels, counts, id_col, text_col, fit_docs), "toxicity")
    marking = _marking(sample)
    passages = _passages(sample, marking, fit_passages) if marking else []
    if not passages:
        forget(sample)
        return flat
    tags = np.frombuffer("".join(t for _, t in passages).encode(), np.uint8).astype(np.int64) - ord("0")
    chain = fit([p.split(" ") for p, _ in passages], tags)
    held = sample.sparkSession.sparkContext.broadcast(chain)

    def sums(batches):
        tagger = Tagger(held.value)
        for batch in batches:
            found = _document_sums(tagger, batch.column("text").to_pylist())[0]
            yield pa.RecordBatch.from_arrays([*map(pa.array, found), batch.column("label")], names=["total", "largest", "expected", "label"])

    rows = sample.mapInArrow(sums, "total double, largest double, expected double, label int").collect()
    forget(sample)
    x = np.array([list(r) for r in rows])
    weights = _logistic(evidence(*x[:, :3].T), x[:, 3])
    kept = [max(1, int((x[:, 3] == v).sum())) for v in (0, 1)]
    weights[0] += np.log(counts[1] / counts[0]) - np.log(kept[1] / kept[0])  # the sample holds label 1 more often
    return ToxicityModel(chain, weights)


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", into: str = "score", spans: bool = True) -> DataFrame:
    """Every column of `docs` but those named so before, with the score and (if `spans`) the offending `toxic_spans`.

    Whole texts are tagged. A null or empty text has no spans and the score of a text without toxic tokens.
    Offsets count characters (code points) of the text; each span has the largest marginal of its tokens.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop(into, *["toxic_spans"] * spans)
    schema = f"{field_list(kept.schema)}, `{into}` double" + f", toxic_spans {SPANS}" * spans

    def run(batches):
        chain, weights = held.value.chain, held.value.weights
        tagger = Tagger(chain) if chain is not None else None
        for batch in batches:
            texts = [x or "" for x in batch.column(text_col).to_pylist()]
            scores, found = [], []
            for part in in_chunks(texts):
                sums, odds, lengths = np.zeros((3, part.stop - part.start)), np.zeros(0), np.zeros(part.stop - part.start, int)
                if tagger is not None:
                    sums, odds, lengths = _document_sums(tagger, texts[part])
                logits = np.clip(evidence(*sums) @ weights, -LOGIT, LOGIT)
                scores.append(1 / (1 + np.exp(-logits)))
                if spans:
                    at = np.cumsum(np.append(0, lengths))
                    for i, text in enumerate(texts[part]):
                        found.append(toxic_spans(text, odds[at[i] : at[i + 1]]) if sums[1, i] >= 0.5 else [])
            batch = batch.append_column(into, pa.array(np.concatenate(scores) if scores else np.zeros(0)))
            if spans:
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))
                batch = batch.append_column("toxic_spans", pa.array(found, kind))
            yield batch

    return kept.mapInArrow(run, schema)
