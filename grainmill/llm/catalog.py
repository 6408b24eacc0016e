"""The operators of this subpackage as queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.llm.conversations import repair
from grainmill.llm.merkle import leaf_digest, prove
from grainmill.llm.neighbour_graph import nearest
from grainmill.llm.packing import pack
from grainmill.llm.page_text import extract_text, fit_labeller
from grainmill.llm.piece_ids import encode_pieces
from grainmill.llm.quality import fit_quality, score_quality
from grainmill.llm.simhash import near_duplicates
from grainmill.llm.staging import table
from grainmill.llm.token_counts import count_tokens, read_pieces
from grainmill.llm.top_products import top_products, whole_vectors
from grainmill.llm.toxicity import fit_toxicity, score_toxicity
from grainmill.llm.url_rules import judge
from grainmill.llm.warc import normalise, page_records, read_records, write_archives
from grainmill.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(func):
    QUERIES[func.__name__] = func
    return func


@query
def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents"), width=4, distance=4)
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


#: A document counts as toxic from this score on.
TOXIC = 0.7


def toxicity_labels(spark: SparkSession, folder: str) -> DataFrame:
    """The labels that may be learnt from, as `(id, label)`."""
    labels = table(spark, folder, "labels").where(~_held_out())
    return labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("label"))


def _held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


@query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, toxicity_labels(spark, folder))
    scored = score_toxicity(docs, model)
    return scored.select(
        "doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"), "toxic_spans"
    )


#: A document counts as good from this score on.
GOOD = 0.5


@query
def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = score_quality(docs, fit_quality(docs))
    return scored.select(
        "doc_id", F.col("quality_score").alias("score"), (F.col("quality_score") >= GOOD).cast("int").alias("predicted")
    )


def pieces_of(docs: DataFrame) -> DataFrame:
    """The pieces of `docs` in sequences of 4096 ids, with a checksum of each piece's ids."""
    pieces = pack(docs, public_tokenizers.path("word_bpe_49k.json"), length=4096, end_id=2)
    return pieces.select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pieces_of(table(spark, folder, "documents"))


@query
def op6_pieces(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), decoded=True)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


#: The rules of the query: action, host, path.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


@query
def op5_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    pages = table(spark, folder, "pages").select("page_id", "url")
    return judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


SQL["op5_url_rules"] = r"""
WITH parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
rules(action, rhost, rpath) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
numbered AS (SELECT row_number() OVER () AS i, * FROM parts),
fitting AS (
  SELECT i, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(action, length(rhost || rpath)) AS action
  FROM numbered JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY i)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM numbered LEFT JOIN fitting USING (i)
"""


@query
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = count_tokens(docs, read_pieces(public_tokenizers.path("word_bpe_49k.json")))
    return counted.select("doc_id", "n_words", "n_tokens")


@query
def op8_page_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    texts = extract_text(pages, fit_labeller(pages))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op9_top_products(spark: SparkSession, folder: str) -> DataFrame:
    vectors = whole_vectors(table(spark, folder, "embeddings"), scale=256)
    return top_products(vectors, "id % 50 = 0", k=5)


SQL["op9_top_products"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op2_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), "id % 20 = 0", k=20)


@query
def op11_archives(spark: SparkSession, folder: str) -> DataFrame:
    raw, members = scratch_path(spark, "warc-raw"), scratch_path(spark, "warc")
    archives = write_archives(page_records(table(spark, folder, "pages"), least=0), raw)
    index = normalise(archives, raw, members)
    return read_records(index, members, payloads=False).drop("url", "payload")


SQL["op11_archives"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
firsts AS (SELECT payload, max(page_id) AS head FROM p GROUP BY payload),
d AS (
  SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS hexed, head FROM p JOIN firsts USING (payload)),
bits AS (
  SELECT *, list_transform(range(0, 32), lambda g: list_reduce(list_transform(range(0, 5), lambda b:
    CAST((instr('0123456789abcdef', hexed[(5 * g + b) // 4 + 1]) - 1) >> (3 - (5 * g + b) % 4) & 1 AS BIGINT)), lambda x, y: 2 * x + y)) AS fives FROM d)
SELECT page_id, payload_bytes,
  list_reduce(list_transform(fives, lambda v: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[v + 1]), lambda x, y: x || y) AS payload_digest,
  CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> head THEN head END AS refers_to
FROM bits
"""

#: CRC-32 of an ASCII text, in SQL.
CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({0}) + 1), lambda i: ascii({0}[i])::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""


@query
def op12_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    name = F.col("doc_id").cast("string")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    more = [x if i != 3 else x.cast("decimal(20,0)") + 1 for i, x in enumerate(fields)]
    rows = docs.select(
        F.col("doc_id").alias("id"),
        F.col("lang").alias("tree"),
        leaf_digest(fields).alias("leaf"),
        F.when(F.crc32(name.cast("binary")) % 7 == 0, leaf_digest(more)).alias("claim"),
    )
    return prove(rows).select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


SQL["op12_manifest"] = f"""
WITH RECURSIVE shown AS (
  SELECT doc_id, lang, crc.n % 7 = 0 AS hit, n_chars,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS a,
    coalesce(strlen(text) || ':' || text, '-') AS z
  FROM (SELECT *, doc_id::VARCHAR AS name FROM documents), LATERAL (SELECT {CRC32.format('name')} AS n) AS crc),
leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY lang) AS size,
    sha256(a || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || z) AS digest,
    CASE WHEN hit THEN sha256(a || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || z) END AS claim
  FROM shown),
nodes AS (
  SELECT tree, 0 AS level, place, size, digest FROM leaves
  UNION ALL
  SELECT tree, level + 1, place // 2, (max(size) + 1) // 2, sha256(string_agg(digest, '' ORDER BY place)) FROM nodes WHERE size > 1 GROUP BY tree, level, place // 2),
heights AS (SELECT tree, max(level) AS height FROM nodes GROUP BY tree),
tops AS (
  SELECT tree, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS size, digest FROM nodes WHERE size = 1),
upper AS (
  SELECT 0 AS level, place, size, digest FROM tops
  UNION ALL
  SELECT level + 1, place // 2, (max(size) + 1) // 2, sha256(string_agg(digest, '' ORDER BY place)) FROM upper WHERE size > 1 GROUP BY level, place // 2),
steps AS (
  SELECT l.tree, l.place, h.level, (l.place >> h.level) & 1 AS side, n.digest AS sibling
  FROM leaves AS l JOIN (SELECT DISTINCT nodes.tree, level FROM nodes JOIN heights ON nodes.tree = heights.tree AND level < height) AS h ON h.tree = l.tree
  LEFT JOIN nodes AS n ON n.tree = l.tree AND n.level = h.level AND n.place = xor(l.place >> h.level, 1)
  UNION ALL
  SELECT l.tree, l.place, height + u.level, (t.place >> u.level) & 1, n.digest
  FROM leaves AS l JOIN heights USING (tree) JOIN tops AS t USING (tree)
  JOIN (SELECT DISTINCT level FROM upper WHERE size > 1) AS u ON true
  LEFT JOIN upper AS n ON n.level = u.level AND n.place = xor(t.place >> u.level, 1)),
proofs AS (
  SELECT tree, place, list(side ORDER BY level) AS sides, list(sibling ORDER BY level) AS siblings, string_agg(coalesce(sibling, ''), '' ORDER BY level) AS joined
  FROM steps GROUP BY tree, place),
folded AS (
  SELECT tree, place, 0 AS done, coalesce(claim, digest) AS value FROM leaves
  UNION ALL
  SELECT f.tree, f.place, done + 1, sha256(CASE WHEN siblings[done + 1] IS NULL THEN value WHEN sides[done + 1] = 1 THEN siblings[done + 1] || value ELSE value || siblings[done + 1] END)
  FROM folded AS f JOIN proofs AS p ON p.tree = f.tree AND p.place = f.place AND done < len(sides)),
ends AS (SELECT tree, place, arg_max(value, done) AS value FROM folded GROUP BY tree, place)
SELECT doc_id, l.digest AS leaf, t.digest AS subroot, r.digest AS root, sha256(coalesce(joined, '')) AS proof_sha256, e.value AS folded_root, e.value = r.digest AS verified
FROM leaves AS l JOIN tops AS t USING (tree) JOIN ends AS e ON e.tree = l.tree AND e.place = l.place
JOIN (SELECT digest FROM upper WHERE size = 1) AS r ON true LEFT JOIN proofs AS p ON p.tree = l.tree AND p.place = l.place
"""


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of conversations, damaged by a hash of conversation and turn; nulls count as one space."""
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    fault = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    kept = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault")).where("fault <> 0")
    text = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    role = F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role"))
    return kept.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("time")).drop("time")


@query
def op13_conversations(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    every = rows.select("conv_id").distinct()
    found = repair(damaged(rows)).withColumnRenamed("conv_id", "found_id")
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"),
    )


def _step(state: str, cost: str, sign: str) -> str:
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{sign}'}} END"


def _least(*options: str) -> str:
    return f"list_min(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))"


SQL["op13_conversations"] = f"""
WITH RECURSIVE hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, crc.n % 20 AS fault
  FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
    LATERAL (SELECT {CRC32.format('name')} AS n) AS crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hashed, LATERAL (SELECT unnest(CASE fault WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END)) AS t),
trimmed AS (SELECT *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core FROM damaged),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM trimmed),
ranked AS (
  SELECT *, core = '' AS blank, core <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS repeated FROM placed),
marked AS (
  SELECT *, left(role, 1) AS initial, blank OR repeated AS gone, NOT (blank OR repeated) AND right(core, 1) NOT IN ('.', '!', '?') AS cut,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM ranked),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (repeated) AS duplicate,
    count(*) FILTER (cut) AS truncated, count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM marked GROUP BY conv_id),
moves AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': ''}} AS s0, NULL::STRUCT(c BIGINT, a VARCHAR) AS s1, {{'c': 5::BIGINT, 'a': 'I'}} AS s2, {{'c': 10::BIGINT, 'a': 'II'}} AS s3
  FROM counts
  UNION ALL
  SELECT conv_id, i, n0, n1, m2, {_least('n3', _step('m2', '5', 'I'))}
  FROM (
    SELECT *, {_least('n2', _step('n0', '5', 'I'), _step('n1', '5', 'I'), _step('n3', '5', 'I'))} AS m2
    FROM (
      SELECT d.conv_id, r.i, {_step('s0', '2', 'D')} AS n0,
        {_least(_step('s1', '2', 'D'), f"CASE WHEN NOT gone AND initial = 's' THEN {_step('s0', 'if(cut, 5, 0)', 'K')} END")} AS n1,
        {_least(_step('s2', '2', 'D'), *[f"CASE WHEN NOT gone AND initial = 'u' THEN {_step(s, 'if(cut, 5, 0)', 'K')} END" for s in ('s0', 's1', 's3')],
                *[f"CASE WHEN NOT gone THEN {_step(s, 'if(cut, 6, 1)', 'R')} END" for s in ('s0', 's1', 's3')])} AS n2,
        {_least(_step('s3', '2', 'D'), f"CASE WHEN NOT gone AND initial = 'a' THEN {_step('s2', 'if(cut, 5, 0)', 'K')} END",
                f"CASE WHEN NOT gone THEN {_step('s2', 'if(cut, 6, 1)', 'R')} END")} AS n3
      FROM moves AS d JOIN marked AS r ON r.conv_id IS NOT DISTINCT FROM d.conv_id AND r.i = d.i + 1))),
best AS (
  SELECT c.*, {_least('s0', 's3')} AS b FROM moves AS m JOIN counts AS c ON c.conv_id IS NOT DISTINCT FROM m.conv_id AND c.n = m.i),
signs AS (
  SELECT conv_id, p, b.a[p] AS sign,
    count(*) FILTER (b.a[p] <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS i, count(*) FILTER (b.a[p] <> 'D') OVER (PARTITION BY conv_id ORDER BY p) AS k
  FROM best, LATERAL (SELECT unnest(range(1, length(b.a) + 1)) AS p) AS t),
kept AS (
  SELECT s.conv_id, s.p, s.sign, s.k, m.role, m.text,
    max(CASE WHEN s.k = 1 AND s.sign = 'K' AND m.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY s.conv_id) AS system
  FROM signs AS s LEFT JOIN marked AS m ON m.conv_id IS NOT DISTINCT FROM s.conv_id AND m.i = s.i AND s.sign <> 'I'
  WHERE s.sign <> 'D'),
repaired AS (
  SELECT conv_id, sha256(string_agg(
    CASE WHEN sign = 'K' THEN role WHEN (k - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN sign = 'I' THEN '' ELSE text END, chr(10) ORDER BY p)) AS repaired_sha256
  FROM kept GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost, coalesce(b.a, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS e LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN repaired AS r ON r.conv_id IS NOT DISTINCT FROM e.conv_id
"""
