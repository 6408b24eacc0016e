import collections
import random
import struct
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from grainmill.llm.catalog import QUERIES
from grainmill.llm.merges import MergeTable
from grainmill.llm.packing import _tail_lengths, hilbert_key, pack
from grainmill.llm.word_ids import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("dims,depth", [(2, 4), (3, 3), (4, 2)])
def test_neighbours_on_the_curve_are_neighbours_in_space(dims, depth):
    cells = np.stack(np.meshgrid(*[np.arange(1 << depth)] * dims), axis=-1).reshape(-1, dims)
    keys = hilbert_key(cells, depth)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_merges_are_those_of_one_pair_at_a_time():
    rng = random.Random(5)

    def slow(word, pairs):
        word = list(word)
        while True:
            best = min(((pairs[p][0], i) for i, p in enumerate(zip(word, word[1:])) if p in pairs), default=None)
            if best is None:
                return word
            i = best[1]
            word[i : i + 2] = [pairs[word[i], word[i + 1]][1]]

    for _ in range(80):
        pairs, symbols = {}, list(range(3))
        for _ in range(rng.randint(1, 12)):
            pair = (rng.choice(symbols), rng.choice(symbols))
            if pair not in pairs:
                merged = rng.choice([len(symbols), rng.randrange(len(symbols))])
                if merged == len(symbols):
                    symbols.append(merged)
                pairs[pair] = (rng.randint(0, 8), merged)
        rows = np.array([(a, b, m, r) for (a, b), (r, m) in pairs.items()])
        words = [rng.choices(range(3), k=rng.randint(1, 20)) for _ in range(50)] + [[0] * 41]
        table = MergeTable(*rows.T, len(symbols))
        got, sizes = table.merge(np.array([s for w in words for s in w]), np.array(list(map(len, words))))
        assert [x.tolist() for x in np.split(got, np.cumsum(sizes)[:-1])] == [slow(w, pairs) for w in words]


def test_word_ids_are_those_of_the_tokenizer(tokenizer):
    rng = random.Random(3)
    pool = [chr(c) for c in [*range(33, 127), *range(0xA1, 0x180), 0x300, 0x301, 0x1E9E, 0x2019, 0x4F60, 0x1F600, 0x130]]
    texts = ["", "  ", "a\x1cb c", "\x00 x\x00y", "Don't É’s we'LL", "Ⅷ ǅ Σας ΟΔΟΣ.", "x́ é é", " a b\x85c", "<|startoftext|> hi <|endoftext|>", "a​b", "﻿"]
    texts += ["".join(rng.choices(pool, k=rng.randint(1, 14))) for _ in range(3000)]
    texts += [" ".join("".join(rng.choices("aAbBsS'tTdrevlm01.ĳĲŉİ", k=rng.randint(1, 12))) for _ in range(9)) for _ in range(500)]
    texts.append("a" * 5000 + "the" * 3000)
    encoder = WordEncoder(PATH, keep=2000)
    for part in (texts[:200], texts[200:2000], texts[2000:], texts[:50]):
        ids, sizes = encoder.encode(part)
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in part]
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want


def check_pieces(rows, docs, length):
    """`rows` of (id, start, length, bytes or checksum, doc_tokens, sequence, offset) cover `docs` (a multiset of id lists) without padding."""
    sequences, starts = collections.defaultdict(list), collections.defaultdict(list)
    for doc, start, n, _, total, sequence, offset in rows:
        sequences[sequence].append((offset, n))
        starts[doc].append((start, n, total))
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at and n > 0
            at += n
        assert at == length or at & (at - 1) == 0 and at < length
    assert sum(n for _, _, n, *_ in rows) == sum(map(len, docs))


def test_pack(frame, tokenizer):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choices("some words are here and there again".split(), k=rng.randint(0, 400))), 7) for i in range(60)]
    rows += [(70, None, 1), (71, "", 1), (None, "no id", 1), (None, "no id", 1), (72, "long text " * 5000, 1), (3, rows[3][1], 2)]
    pieces = pack(frame(rows, "doc_id long, text string, length int"), PATH, length=256).collect()
    ids = [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for _, t, _ in rows]
    check_pieces([tuple(p) for p in pieces], ids, 256)
    got = collections.defaultdict(dict)
    for p in pieces:
        if p["id"] not in (None, 3):
            assert p["length"] * 4 == len(p["ids"])
            got[p["id"]][p["start"]] = struct.unpack(f"<{p['length']}I", p["ids"])
    for (doc, _, _), want in zip(rows, ids):
        if doc not in (None, 3):
            assert [x for s in sorted(got[doc]) for x in got[doc][s]] == want
    assert pack(frame([], "doc_id long, text string"), PATH).count() == 0


def test_tail_lengths():
    assert _tail_lengths(0) == [] and _tail_lengths(11) == [8, 2, 1] and sum(_tail_lengths(4095)) == 4095


def test_query(spark, tokenizer):
    folder = "/root/testdata/sf0.001"
    docs = {d: tokenizer.encode(t, add_special_tokens=False).ids + [2] for d, t in duckdb.sql(f"select doc_id, text from '{folder}/documents.parquet'").fetchall()}
    rows = QUERIES["op4_packing"](spark, folder).collect()
    check_pieces([tuple(r) for r in rows], docs.values(), 4096)
    for r in rows:
        part = docs[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert (zlib.crc32(struct.pack(f"<{len(part)}I", *part)), len(docs[r["doc_id"]])) == (r["ids_crc32"], r["doc_tokens"])
