"""A linear-chain conditional random field with two tags, over many sequences at once.

A tag pair has one free number at each position, the log odds of tag 1 against tag 0, so the forward and
backward recursions are carried as odds: a sequence of any length needs one number for each token, and all
sequences of a batch take a step together.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from zlib import crc32

import numpy as np

from grainmill.llm.batches import Words

#: Log odds beyond this are cut, which keeps products of odds finite.
LIMIT = 30.0
PUNCTUATION = ".,;:!?\"'()[]{}<>«»„“”‘’…-–—*#%&$|/\\_"


def core(word: str) -> str:
    """A lower-cased word without punctuation at its ends; the word itself if nothing else is in it."""
    return word.strip(PUNCTUATION) or word


def word_features(word: str, size: int) -> list[int]:
    """Hashed features of a word: itself, its beginnings and ends, its length and the kinds of its characters."""
    inner = core(word)
    kinds = f"{min(len(inner), 12)}{inner.isalpha():d}{inner.isdigit():d}{inner == word:d}"
    names = [f"w{inner}", f"k{kinds}"]
    names += [f"b{inner[:n]}" for n in range(2, min(7, len(inner)))] + [f"e{inner[-n:]}" for n in range(2, min(5, len(inner)))]
    return [crc32(x.encode("utf-8", "surrogatepass")) % size for x in names]


@dataclass
class ChainField:
    """Weights: of a token's own features, of the words before and after it, of the tag pairs and of the first tag."""

    size: int = 1 << 16
    own: np.ndarray = field(default=None)
    before: np.ndarray = field(default=None)
    after: np.ndarray = field(default=None)
    moves: np.ndarray = field(default=None)  # log weights [[0→0, 0→1], [1→0, 1→1]]
    first: float = 0.0

    def __post_init__(self):
        for name in ("own", "before", "after"):
            if getattr(self, name) is None:
                setattr(self, name, np.zeros(self.size, np.float32))
        if self.moves is None:
            self.moves = np.zeros((2, 2))


def feature_table(words: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The features of `words`, flat, and the number of each word's features."""
    lists = [word_features(w, size) for w in words]
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter((f for x in lists for f in x), np.int64, int(counts.sum())), counts


def summed(weights: np.ndarray, flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The weight of each word."""
    if not len(counts):
        return np.zeros(0)
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    return np.add.reduceat(weights[flat].astype(float), starts)


def emissions(codes: np.ndarray, lengths: np.ndarray, own: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Log odds of tag 1 at each token, from the words' weights; a neighbour counts within its sequence only."""
    if not len(codes):
        return np.zeros(0)
    out = own[codes]
    ends = np.cumsum(lengths[lengths > 0])
    inside = np.ones(len(codes), bool)
    inside[np.concatenate(([0], ends[:-1]))] = False
    out[1:] += np.where(inside[1:], before[codes[:-1]], 0)
    out[:-1] += np.where(inside[1:], after[codes[1:]], 0)
    return np.clip(out, -LIMIT, LIMIT)


def odds(logits: np.ndarray, lengths: np.ndarray, model: ChainField) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward odds of tag 1 at each token of sequences that lie end to end in `logits`."""
    e = np.exp(logits)
    (oo, ot), (to, tt) = np.exp(model.moves)
    offsets = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = offsets[order], lengths[order]
    going = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), side="left")  # longer than t
    ahead, back = np.empty_like(e), np.empty_like(e)
    carry = None
    for t, k in enumerate(going):
        at = starts[:k] + t
        carry = e[at] * (np.exp(model.first) if t == 0 else (carry[:k] * tt + ot) / (carry[:k] * to + oo))
        ahead[at] = carry
    carry = np.zeros(0)
    for t in range(len(going) - 1, -1, -1):
        at = starts[: going[t]] + t
        new = np.ones(going[t])
        n = len(carry)
        if n:
            new[:n] = (carry * tt + to) / (carry * ot + oo)
        back[at] = new
        carry = new * e[at]
    return ahead, back


def fit(sequences: list[list[str]], tags: np.ndarray, size: int = 1 << 16, rounds: int = 60, rate: float = 0.2, ridge: float = 1e-6) -> ChainField:
    """Weights of greatest likelihood (with a ridge) for tagged sequences, by full gradients with adaptive steps.

    `tags` holds the tags of all tokens end to end. Sequences without words are left out by the caller.
    """
    model, words = ChainField(size), Words()
    codes = np.fromiter((words[w] for s in sequences for w in s), np.int64, len(tags))
    lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
    flat, counts = feature_table(words.fresh, size)
    firsts = np.cumsum(lengths) - lengths
    linked = np.ones(len(codes), bool)  # has a token before it
    linked[firsts] = False
    pair = np.flatnonzero(linked)
    seen = np.bincount(2 * tags[pair - 1] + tags[pair], minlength=4).reshape(2, 2)
    steps = {n: np.zeros(size) for n in ("own", "before", "after")} | {"moves": np.zeros((2, 2)), "first": 0.0}

    def move(name, gradient):
        steps[name] = steps[name] + gradient * gradient
        setattr(model, name, getattr(model, name) + rate * gradient / (np.sqrt(steps[name]) + 1e-8))

    def to_features(per_word):
        return np.bincount(flat, np.repeat(per_word, counts), minlength=size)

    n_words, total = len(counts), max(1, len(sequences))
    for _ in range(rounds):
        logits = emissions(codes, lengths, *(summed(getattr(model, n), flat, counts) for n in ("own", "before", "after")))
        ahead, back = odds(logits, lengths, model)
        both = ahead * back
        rest = tags - both / (1 + both)
        weight = np.exp(model.moves)[None] * np.stack((np.ones(len(pair)), ahead[pair - 1]), 1)[:, :, None]
        weight = weight * np.stack((np.ones(len(pair)), np.exp(logits[pair]) * back[pair]), 1)[:, None, :]
        expected = (weight / weight.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        move("moves", (seen - expected) / total - ridge * model.moves)
        move("first", float(rest[firsts].sum()) / total - ridge * model.first)
        move("own", to_features(np.bincount(codes, rest, minlength=n_words)) / total - ridge * model.own)
        move("before", to_features(np.bincount(codes[pair - 1], rest[pair], minlength=n_words)) / total - ridge * model.before)
        move("after", to_features(np.bincount(codes[pair], rest[pair - 1], minlength=n_words)) / total - ridge * model.after)
    for name in ("own", "before", "after"):
        setattr(model, name, getattr(model, name).astype(np.float32))
    return model


class Tagger:
    """Marginals of whole texts; keeps the weights of words it has seen, up to `keep` of them."""

    def __init__(self, model: ChainField, keep: int = 200_000):
        self.model, self.keep = model, keep
        self.forget()

    def forget(self) -> None:
        self.words, self.weights = Words(), np.zeros((3, 0))

    def marginals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The odds of tag 1 for all tokens of `texts`, end to end, and the number of tokens of each text."""
        if len(self.words) > self.keep:
            self.forget()
        parts = []
        for text in texts:
            tokens = text.lower().split()
            parts.append(np.fromiter(map(self.words.__getitem__, tokens), np.int32, len(tokens)))
        if self.words.fresh:
            flat, counts = feature_table(self.words.fresh, self.model.size)
            new = np.stack([summed(w, flat, counts) for w in (self.model.own, self.model.before, self.model.after)])
            self.weights = np.concatenate((self.weights, new), axis=1)
            self.words.fresh = []
        codes = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        ahead, back = odds(emissions(codes, lengths, *self.weights), lengths, self.model)
        return ahead * back, lengths
