import random

import duckdb
import numpy as np
import public_tokenizers

from grainmill.llm.catalog import QUERIES
from grainmill.llm.token_counts import build, count_tokens, read_pieces, split_words


def greedy(word: bytes, pieces: set) -> int:
    at = n = 0
    while at < len(word):
        size = next((k for k in range(len(word) - at, 1, -1) if (word[at : at + k], at + k == len(word)) in pieces), 1)
        at, n = at + size, n + 1
    return n


def test_automaton_is_greedy_for_random_vocabularies():
    rng = random.Random(2)
    for _ in range(60):
        pieces = {(bytes(rng.choices(b"abc", k=rng.randint(1, 6))), rng.random() < 0.5) for _ in range(rng.randint(0, 25))}
        words = [bytes(rng.choices(b"abcd", k=rng.randint(1, 14))) for _ in range(80)] + [b"a" * 100, b"abc" * 40]
        symbols = [s for w in words for s in (*w[:-1], w[-1] + 256)]
        got = build(pieces).count(np.array(symbols), np.array(list(map(len, words))))
        assert got.tolist() == [greedy(w, pieces) for w in words]


def test_documents(frame):
    pieces = {(b"ab", False), (b"abc", False), (b"bcd", True), (b"cd", False), (b"d", True), (b"!!", True)}
    texts = [None, "", "  \n", "abcd", "ABcd abcd!! _x_", "é é abc\x1cabcd", "abcd " * 3000, "ab" * 300]
    rows = [(i, t, "old") for i, t in enumerate(texts + texts[3:4])]
    got = count_tokens(frame(rows, "doc_id int, text string, n_words string"), pieces).collect()
    want = {i: (len(split_words(t or "")), sum(greedy(w.encode(), pieces) for w in split_words(t or ""))) for i, t, _ in rows}
    assert {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in got} == want
    assert count_tokens(frame([], "doc_id int, text string"), pieces).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    pieces = set(read_pieces(public_tokenizers.path("word_bpe_49k.json")))
    docs = duckdb.sql(f"select doc_id, text from '{folder}/documents.parquet'").fetchall()
    want = sorted((d, len(split_words(t)), sum(greedy(w.encode(), pieces) for w in split_words(t))) for d, t in docs)
    assert sorted(map(tuple, QUERIES["op3_token_counts"](spark, folder).collect())) == want
