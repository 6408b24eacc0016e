import corpus_pipeline
import pytest
from corpus_pipeline import STAGES, drop_near_copies, run
from test_packing import PATH, check_pieces
from test_simhash import plain_fingerprint, roots
from tokenizers import Tokenizer

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """The input and the result of each stage."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in STAGES:
        made = corpus_pipeline.stored(stage(spark, docs, FOLDER), "test")
        out[name] = (docs, made)
        docs = made
    return out


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("name", ["toxicity", "quality", "near copies"])
def test_filters_keep_rows_as_they_are(stages, name):
    before, after = stages[name]
    assert after.columns == before.columns
    assert after.count() and set(rows_of(after)) <= set(rows_of(before))


def test_clean_documents_stay_and_marked_ones_go(stages, spark):
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    for name, column, wrong in (("toxicity", "toxic", 1), ("quality", "quality", 0)):
        before, after = ([r["doc_id"] for r in df.select("doc_id").collect() if r["doc_id"] in labels] for df in stages[name])
        clean = [d for d in before if labels[d][column] != wrong]
        assert len(set(clean) & set(after)) >= 0.97 * len(clean)
        marked = [d for d in before if labels[d][column] == wrong]
        assert len(set(marked) & set(after)) <= 0.2 * len(marked)


def test_one_of_each_group_stays(stages):
    before, after = stages["near copies"]
    docs = sorted((r["doc_id"], r["text"]) for r in before.collect())
    prints = [plain_fingerprint(t) for _, t in docs]
    pairs = [(i, j) for i in range(len(docs)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    assert sorted(r["doc_id"] for r in after.collect()) == sorted({docs[i][0] for i in roots(len(docs), pairs)})


def test_all_that_is_left_is_packed(stages):
    before, after = stages["packing"]
    tokenizer = Tokenizer.from_file(PATH)
    ids = [tokenizer.encode(r["text"], add_special_tokens=False).ids + [2] for r in before.collect()]
    check_pieces([tuple(r) for r in after.collect()], ids, 4096)


def test_run_gives_the_last_stage(stages, spark):
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sum(r["length"] for r in run(spark, FOLDER).collect()) == sum(r["length"] for r in stages["packing"][1].select(key).collect())


def test_odd_rows(frame, spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(5, text, "a", "s", 1), (3, text, "b", "s", 2), (None, text, None, "s", 3), (3, text, "a", "s", 2), (9, None, "a", None, 0), (8, "", "a", "t", 0)]
    kept = drop_near_copies(spark, frame(rows, schema), FOLDER).collect()
    assert len(kept) == 2  # the texts with words, and those without
    assert sorted(r["doc_id"] for r in kept) == [3, 8]
    frame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    frame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert run(spark, str(tmp_path)).count() == 0


def test_every_group_keeps_one_row(frame, spark):
    """Rows of one doc_id with different texts, rows without one, and columns with the stages' own names."""
    text = {n: " ".join(f"{n}{i}" for i in range(50)) for n in "abcd"}
    rows = [(7, text["b"]), (5, text["b"]), (5, text["a"]), (3, text["a"]), (5, text["c"]), (None, text["d"]), (None, text["d"]), (None, text["a"])]
    schema = "doc_id long, text string, row string, score double, ROW_ map<string,int>, __score int"
    docs = frame([(i, t, "r", 0.5, {"k": 1}, 1) for i, t in rows], schema)
    kept = drop_near_copies(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"][0], r["row"]) for r in kept.collect()), key=repr) == [(3, "a", "r"), (5, "b", "r"), (5, "c", "r"), (None, "d", "r")]
    for _, stage in STAGES[:2]:
        assert stage(spark, docs, FOLDER).columns == docs.columns
        assert {r["score"] for r in stage(spark, docs, FOLDER).collect()} <= {0.5}
