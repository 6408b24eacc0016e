import hashlib
import random
import struct

import duckdb
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from grainmill.llm.catalog import QUERIES
from grainmill.llm.piece_ids import decode_pieces, encode_pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


def texts():
    rng = random.Random(1)
    pool = [chr(c) for c in [*range(256), *range(0x370, 0x460), 0x2581, 0x4F60, 0x1F600, 0x300, 0xFFFD, 0x10FFFF, 0xFEFF]]
    fixed = [None, "", "  ", " ", "▁", "▁▁a", "a▁b", "\n\n  x ", "你好 😀", "<s> </s> <unk> <0x41>", "a" * 300, "the" * 400, " " * 77 + "x" + " " * 33]
    fixed += ["=-" * 200, "-" * 999, "aaaa bbb" * 50, "\x00", "word " * 20000, "x" * 20000]
    loose = ["".join(rng.choices(pool, k=rng.randint(1, 60))) for _ in range(400)]
    return fixed + loose + ["".join(rng.choices("the ainor  se▁-=", k=rng.randint(1, 80))) for _ in range(400)]


def test_ids_and_texts_are_those_of_the_library(frame, library):
    rows = [(i, t, "old", 1) for i, t in enumerate(texts())]
    coded = encode_pieces(frame(rows + rows[:5], "doc_id int, text string, decoded string, n int"), PATH, decoded=True)
    assert coded.columns == ["doc_id", "n", "ids", "decoded"]
    got = coded.collect()
    assert len(got) == len(rows) + 5
    for r in got:
        want = library.encode(rows[r["doc_id"]][1] or "", add_bos=True, add_eos=True)
        assert list(struct.unpack(f"<{len(r['ids']) // 4}I", r["ids"])) == want
        assert r["decoded"] == library.decode(want)
    assert encode_pieces(frame([], "doc_id int, text string"), PATH).count() == 0


def test_decoding_any_ids(frame, library):
    rng = random.Random(4)
    some = [[rng.choice([rng.randrange(32000), rng.randrange(3, 259), 1, 0]) for _ in range(rng.randint(0, 12))] for _ in range(500)]
    rows = [(i, struct.pack(f"<{len(x)}I", *x)) for i, x in enumerate(some)] + [(-1, None)]
    got = {r["i"]: r["decoded"] for r in decode_pieces(frame(rows, "i int, ids binary"), PATH).collect()}
    assert got.pop(-1) == ""
    assert got == {i: library.decode(x) for i, x in enumerate(some)}


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    want = []
    for doc, text in duckdb.sql(f"select doc_id, text from '{folder}/documents.parquet'").fetchall():
        ids = library.encode(text, add_bos=True, add_eos=True)
        digests = [hashlib.sha256(x).hexdigest() for x in (struct.pack(f"<{len(ids)}I", *ids), library.decode(ids).encode())]
        want.append((doc, len(ids), *digests))
    assert sorted(map(tuple, QUERIES["op6_pieces"](spark, folder).collect())) == sorted(want)


def test_clashing_columns(frame):
    docs = frame([(1, "two words", "x", {"k": 1})], "doc_id int, text string, text_ string, m map<string,int>")
    got = encode_pieces(docs, PATH, decoded=True)
    assert got.columns == ["doc_id", "text_", "m", "ids", "decoded"]
    assert got.first()["text_"] == "x" and got.first()["decoded"] == "two words"
