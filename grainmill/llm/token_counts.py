"""Numbers of word pieces by greedy longest match, without building the pieces.

The vocabulary is a trie. Where a word can't go on from a node, the node's failure link leads to the node of
what is left after the longest pieces have been taken off its string, and a number precomputed for the link
says how many those were. A word so costs time in proportion to its length, whatever the vocabulary; all
distinct words of a batch take their steps together.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from grainmill.llm.batches import Words, field_list, in_chunks
from grainmill.llm.word_ids import byte_alphabet

#: Symbols: the bytes inside a word, and from 256 on the last byte of a word.
SYMBOLS = 512
WORD = re.compile(r"[^\W_]+|[^\w\s]+|_+")


def split_words(text: str) -> list[str]:
    """Lower-cased words in normal form C: runs of letters and digits, and runs of other characters that are no space."""
    return WORD.findall(unicodedata.normalize("NFC", text).lower())


@dataclass
class Automaton:
    keys: np.ndarray  # node * SYMBOLS + symbol, sorted
    children: np.ndarray
    link: np.ndarray  # failure link of each node; the root's is itself
    popped: np.ndarray  # pieces taken off by following the link
    flushed: np.ndarray  # pieces of the node's whole string

    def count(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The number of pieces of each word; the words' symbols lie end to end."""
        order = np.argsort(-lengths, kind="stable")
        sizes = lengths[order]
        starts = (np.cumsum(lengths) - lengths)[order]
        going = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), side="left")
        node, counts = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for t, k in enumerate(going):
            symbol = symbols[starts[:k] + t]
            todo = np.arange(k)
            while len(todo):
                keys = node[todo] * SYMBOLS + symbol[todo]
                at = np.searchsorted(self.keys, keys)
                found = self.keys[at] == keys
                node[todo[found]] = self.children[at[found]]
                todo = todo[~found]
                counts[todo] += self.popped[node[todo]]
                node[todo] = self.link[node[todo]]
        out = np.empty(len(lengths), np.int64)
        out[order] = counts + self.flushed[node]
        return out


def build(pieces: Iterable[tuple[bytes, bool]]) -> Automaton:
    """The automaton of pieces `(bytes, ends a word)`. Every byte becomes a piece in either place, so that every word has pieces."""
    tree: list[dict[int, int]] = [{}]
    is_piece = [False]
    single = ((bytes([b]), last) for b in range(256) for last in (False, True))
    for raw, last in (*pieces, *single):
        if not raw:
            continue
        node = 0
        for symbol in (*raw[:-1], raw[-1] + 256 * last):
            if symbol not in tree[node]:
                tree[node][symbol] = len(tree)
                tree.append({})
                is_piece.append(False)
            node = tree[node][symbol]
        is_piece[node] = True
    n = len(tree)
    link, popped, flushed = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    todo = deque([0])
    while todo:  # parents before children, shorter strings before longer ones
        parent = todo.popleft()
        for symbol, node in tree[parent].items():
            todo.append(node)
            if is_piece[node]:
                popped[node] = flushed[node] = 1
                continue
            z, pops = link[parent], popped[parent]
            while symbol not in tree[z]:
                z, pops = link[z], pops + popped[z]
            link[node], popped[node] = tree[z][symbol], pops
            flushed[node] = pops + flushed[link[node]]
    keys = np.array([p * SYMBOLS + s for p in range(n) for s in tree[p]], np.int64)
    children = np.array([c for p in range(n) for c in tree[p].values()], np.int64)
    order = np.argsort(keys)
    return Automaton(np.append(keys[order], np.iinfo(np.int64).max), np.append(children[order], 0), link, popped, flushed)


def read_pieces(path: str) -> list[tuple[bytes, bool]]:
    """The pieces of a byte-level vocabulary file with word ends."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    end, byte_of = model["end_of_word_suffix"], {c: b for b, c in enumerate(byte_alphabet())}
    found = []
    for piece in model["vocab"]:
        last = piece.endswith(end)
        found.append((bytes(byte_of[c] for c in (piece[: -len(end)] if last else piece)), last))
    return found


class Counter:
    """Counts texts; keeps the numbers of up to `keep` space-separated words."""

    def __init__(self, automaton: Automaton, keep: int = 200_000):
        self.automaton, self.keep = automaton, keep
        self._forget()

    def _forget(self):
        self.known, self.numbers = Words(), np.zeros((0, 2), np.int64)

    def _learn(self):
        parts, owners = Words(), []
        codes: list[int] = []
        for i, word in enumerate(self.known.fresh):
            found = split_words(word)
            codes.extend(map(parts.__getitem__, found))
            owners.extend([i] * len(found))
        raw = [p.encode("utf-8", "surrogatepass") for p in parts.fresh]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        symbols = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
        symbols[np.cumsum(lengths) - 1] += 256
        pieces = self.automaton.count(symbols, lengths)
        n = len(self.known.fresh)
        codes = np.array(codes, np.int64)
        words, tokens = np.bincount(owners, minlength=n), np.bincount(owners, pieces[codes], minlength=n)
        self.numbers = np.concatenate((self.numbers, np.stack((words, tokens), axis=1).astype(np.int64)))
        self.known.fresh = []

    def count(self, texts: list[str]) -> np.ndarray:
        """The numbers of words and of pieces of each text."""
        if len(self.known) > self.keep:
            self._forget()
        codes = []
        for text in texts:
            words = text.split()
            codes.append(np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)))
        if self.known.fresh:
            self._learn()
        lengths = np.fromiter(map(len, codes), np.int64, len(codes))
        out, full = np.zeros((len(texts), 2), np.int64), lengths > 0
        if full.any():
            starts = (np.cumsum(lengths) - lengths)[full]
            out[full] = np.add.reduceat(self.numbers[np.concatenate(codes)], starts, axis=0)
        return out


def count_tokens(docs: DataFrame, pieces: Iterable[tuple[bytes, bool]], text_col: str = "text") -> DataFrame:
    """Every column of `docs` (but ones so named before) with `n_words` and `n_tokens` of the whole text.

    Words are those of `split_words`; `n_tokens` counts their pieces by greedy longest match from the left. A
    null or empty text has none. The automaton is built once and sent to the tasks; its size follows the
    vocabulary, not the documents.
    """
    held = docs.sparkSession.sparkContext.broadcast(build(pieces))
    kept = docs.drop("n_words", "n_tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(held.value)
        for batch in batches:
            texts = [x or "" for x in batch.column(text_col).to_pylist()]
            parts = [counter.count(texts[part]) for part in in_chunks(texts)]
            numbers = np.concatenate(parts) if parts else np.zeros((0, 2), np.int64)
            yield batch.append_column("n_words", pa.array(numbers[:, 0])).append_column("n_tokens", pa.array(numbers[:, 1]))

    return kept.mapInArrow(run, field_list(kept.schema) + ", n_words long, n_tokens long")
