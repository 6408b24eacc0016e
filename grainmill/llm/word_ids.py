"""Token ids of whole texts for a word tokenizer file, each distinct word merged once."""

from __future__ import annotations

import functools
import json
import re

import numpy as np

from grainmill.llm.batches import Words
from grainmill.llm.merges import MergeTable, ranges

#: Python separates words at these, the tokenizer does not.
SEPARATORS = "[\x1c-\x1f]"
LETTERS = "a-zªµºß-öø-ÿāăąćĉċčďđēĕėęěĝğġģĥħĩīĭįıĵķĸĺļľŀłńņňŋōŏőœŕŗřśŝşšţťŧũūŭůűųŵŷźżžſ"
DIGITS = "0-9²³¹¼½¾"
#: Words of these characters are in normal form C, and their classes are known without Unicode tables.
PLAIN = re.compile("[!-~¡-¬®-ÿĀ-įıĲĳĴ-ňŊ-ž]+")
#: How the tokenizer splits a lower-cased word of such characters.
PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}ĳ]+|[{DIGITS}]|[^\\s{LETTERS}ĳ{DIGITS}]+")


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1 itself, others from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    return [hidden.get(b, chr(b)) for b in range(256)]


class WordEncoder:
    """Ids of texts for a byte-level tokenizer with word ends that never merges across white space; knows up to `keep` words.

    The ids are those of the tokenizer on the whole text, without special tokens. Words of plain characters
    are split and merged here, all new words of a batch at once; other words go to the tokenizer itself.
    """

    def __init__(self, path: str, keep: int = 450_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.keep = Tokenizer.from_file(path), keep
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        special = [re.escape(t["content"]) for t in content["added_tokens"]]
        self.odd = re.compile("|".join([SEPARATORS, *special]))  # texts with these go to the tokenizer as a whole
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        sides = np.array([[vocab[a], vocab[b], vocab[a + b]] for a, b in pairs], np.int64)
        self.table = MergeTable(*sides.T, np.arange(len(pairs)), len(vocab))
        self.inner = np.array([vocab[c] for c in byte_alphabet()], np.int32)
        self.final = np.array([vocab[c + end] for c in byte_alphabet()], np.int32)
        self._forget()

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _forget(self) -> None:
        self.words = Words()
        self.ids, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self) -> None:
        """The ids of the new words."""
        fresh, self.words.fresh = self.words.fresh, []
        parts, counts, apart = Words(), np.ones(len(fresh), np.int64), {}
        codes: list[int] = []
        for i, word in enumerate(fresh):
            if PLAIN.fullmatch(word):
                found = PARTS.findall(word.lower())
                counts[i] = len(found)
                codes.extend(map(parts.__getitem__, found))
            else:
                codes.append(parts[f" {i}"])  # a place of its own
                apart[len(parts) - 1] = self._whole(word)
        raw = [p.encode() for p in parts.fresh]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[flat]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.final[flat[ends]]
        merged, sizes = self.table.merge(symbols, lengths)
        if apart:
            pieces = np.split(merged, np.cumsum(sizes)[:-1])
            for at, own in apart.items():
                pieces[at], sizes[at] = np.array(own, np.int32), len(own)
            merged = np.concatenate(pieces)
        at = np.cumsum(sizes) - sizes
        codes = np.array(codes, np.int64)
        ids = merged[ranges(at[codes], sizes[codes])].astype(np.uint32)
        upto = np.append(0, np.cumsum(sizes[codes]))
        last = np.cumsum(counts)
        sizes = upto[last] - upto[last - counts]
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(sizes) - sizes))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.ids = np.concatenate((self.ids, ids))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of `texts`, end to end, and the number of ids of each."""
        if len(self.words) > self.keep:
            self._forget()
        odd = {i: self._whole(t) for i, t in enumerate(texts) if self.odd.search(t)}
        codes = []
        for i, text in enumerate(texts):
            words = [] if i in odd else text.split()
            codes.append(np.fromiter(map(self.words.__getitem__, words), np.int64, len(words)))
        if self.words.fresh:
            self._learn()
        n_words = np.fromiter(map(len, codes), np.int64, len(codes))
        flat = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        ids = self.ids[ranges(self.starts[flat], self.sizes[flat])]
        upto = np.append(0, np.cumsum(self.sizes[flat]))
        ends = np.cumsum(n_words)
        sizes = upto[ends] - upto[ends - n_words]
        if odd:
            parts = np.split(ids, np.cumsum(sizes)[:-1])
            for i, own in odd.items():
                parts[i], sizes[i] = np.array(own, np.uint32), len(own)
            ids = np.concatenate(parts)
        return ids, sizes


@functools.lru_cache(2)
def word_encoder(path: str) -> WordEncoder:
    """The encoder of this process: what one task has learnt, the next one of the same worker knows."""
    return WordEncoder(path)
