"""Scans, sinks and table stages (S, K): the test tables are written in each form and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from grainmill.catalog.registry import query, table
from grainmill.functions.text import lines, word_counts
from grainmill.models.evaluate import confusion, metrics_report
from grainmill.operators.aggregates import group_mean
from grainmill.operators.clean import fill_median
from grainmill.operators.rows import union_all
from grainmill.plans.cars import transform
from grainmill.session import scratch_path
from grainmill.sources import readers, writers
from grainmill.sources.stages import run_stages, table_stage

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def unique(name: str) -> str:
    return f"grainmill_{name}_{uuid.uuid4().hex[:10]}"


@query("S1", CUSTOMER_SQL)
def fixed_schema_csv(spark, folder):
    path = scratch_path(spark, "s1")
    df = table(spark, folder, "customer")
    padded = df.select(*[F.concat(F.lit(" "), F.col(c).cast("string"), F.lit(" ")).alias(c) for c in df.columns])
    padded.write.option("header", False).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return readers.read_csv(spark, f"{path}/*.csv", CUSTOMER, header=False, trim=True)


@query("S2", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def inferred_csv(spark, folder):
    path = scratch_path(spark, "s2")
    writers.write_csv(table(spark, folder, "customer"), path)
    return readers.read_csv(spark, path, infer=True).select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", "c_acctbal")


@query("S3", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer")
def text_csv(spark, folder):
    path = scratch_path(spark, "s3")
    writers.write_csv(table(spark, folder, "customer").drop("c_acctbal"), path)
    return readers.read_csv(spark, path)


@query("S4", "SELECT o_totalprice, o_orderkey, o_orderstatus FROM orders")
def csv_columns(spark, folder):
    path = scratch_path(spark, "s4")
    writers.write_csv(table(spark, folder, "orders"), path)
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    return readers.read_csv_columns(spark, path, ["o_totalprice", "o_orderkey", "o_orderstatus"], schema)


@query("S5", CUSTOMER_SQL)
def json_lines(spark, folder):
    path = scratch_path(spark, "s5")
    table(spark, folder, "customer").write.json(path)
    return readers.read_json(spark, path, CUSTOMER)


@query("S6", CUSTOMER_SQL)
def xml_records(spark, folder):
    path = scratch_path(spark, "s6")
    table(spark, folder, "customer").write.format("xml").option("rootTag", "data").option("rowTag", "row").save(path)
    return readers.read_xml(spark, path, CUSTOMER)


def _mixed_folder(spark, folder, name):
    """Customers by nation in three formats, side by side in one folder of files."""
    path = scratch_path(spark, name)
    df = table(spark, folder, "customer")
    part = [df.filter(F.col("c_nationkey") % 3 == i) for i in range(3)]
    part[0].write.option("header", True).csv(f"{path}/a.csv")
    part[1].write.json(f"{path}/b.json")
    part[2].write.format("xml").option("rootTag", "data").option("rowTag", "row").save(f"{path}/c.xml")
    return path


@query(
    "S7",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, c_nationkey % 3 AS source_rank FROM customer",
)
def folder_extract(spark, folder):
    rows = readers.read_folder(spark, _mixed_folder(spark, folder, "s7"), CUSTOMER)
    return rows.drop("file_path", "file_block", "position")


@query("S8", "SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate) FROM orders")
def parquet_scan(spark, folder):
    return readers.read_parquet(spark, f"{folder}/orders.parquet").withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


@query("S9", "SELECT line AS value FROM (SELECT unnest(string_split(replace(text, chr(13), ''), chr(10))) AS line FROM documents)")
def text_scan(spark, folder):
    path = scratch_path(spark, "s9")
    lines(table(spark, folder, "documents").withColumn("text", F.replace("text", F.lit("\r"), F.lit(""))), "text").write.text(path)
    return readers.read_text(spark, path)


@query("S10", "SELECT s_nationkey, CAST(count(*) AS BIGINT) AS n FROM supplier GROUP BY s_nationkey")
def table_scan(spark, folder):
    name = unique("s10")
    writers.write_table(table(spark, folder, "supplier"), name, scratch_path(spark, "s10"))
    return readers.read_table(spark, name).groupBy("s_nationkey").agg(F.count("*").alias("n"))


# Invented shares per market segment; one does not occur in the data.
SEGMENT_SHARES = (("BUILDING", 47.35, 41.81), ("MACHINERY", 3.58, 11.61), ("SHIPYARD", 10.82, 15.09))
SHARE_COLUMNS = ("segment", "male", "female")
SHARES_SQL = "(VALUES " + ", ".join(f"('{s}', {m}, {f})" for s, m, f in SEGMENT_SHARES) + ") AS s(segment, male, female)"


@query("S11", f"SELECT c_custkey, CAST(male AS DOUBLE) AS male, CAST(female AS DOUBLE) AS female FROM customer JOIN {SHARES_SQL} ON c_mktsegment = segment")
def literal_rows(spark, folder):
    shares = readers.literal_table(spark, SEGMENT_SHARES, SHARE_COLUMNS)
    customer = table(spark, folder, "customer")
    return customer.join(F.broadcast(shares), F.col("c_mktsegment") == F.col("segment")).select("c_custkey", "male", "female")


@query("S12", "SELECT p_partkey, p_size FROM part")
def uri_scan(spark, folder):
    uri = folder if "://" in folder else f"file://{folder}"
    return readers.read_parquet(spark, f"{uri}/part.parquet").select("p_partkey", "p_size")


@query(
    "S13",
    "SELECT 'orders_copy' AS table_name, CAST(count(*) AS BIGINT) AS n_rows FROM orders UNION ALL "
    "SELECT 'part_copy', CAST(count(*) AS BIGINT) FROM part",
)
def table_listing(spark, folder):
    database = unique("s13")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 's13')}'")
    for name in ("orders", "part"):
        writers.write_table(table(spark, folder, name), f"{database}.{name}_copy")
    counts = union_all(
        *[spark.table(f"{database}.{n}_copy").agg(F.lit(f"{n}_copy").alias("table_name"), F.count("*").alias("n_rows")) for n in ("orders", "part")]
    )
    return readers.list_tables(spark, database).join(counts, "table_name", "left")


@query("K1", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def csv_sink(spark, folder):
    path = scratch_path(spark, "k1")
    df = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    writers.write_csv(df, path)
    return readers.read_csv(spark, path, df.schema)


@query("K2", "SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY o_orderpriority")
def single_csv_sink(spark, folder):
    path = scratch_path(spark, "k2")
    writers.write_csv_single(table(spark, folder, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n")), path, 1000)
    return readers.read_csv(spark, path, "o_orderpriority string, n bigint")


@query("K3", "SELECT * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate) FROM lineitem")
def parquet_sink(spark, folder):
    path = scratch_path(spark, "k3")
    writers.write_parquet(table(spark, folder, "lineitem"), path)
    return readers.read_parquet(spark, path).withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


@query("K4", "SELECT p_partkey, p_type, p_size + 100 AS p_size FROM part")
def table_sink(spark, folder):
    name, path = unique("k4"), scratch_path(spark, "k4")
    part = table(spark, folder, "part").select("p_partkey", "p_type", "p_size")
    writers.write_table(part, name, path)
    writers.write_table(part.withColumn("p_size", F.col("p_size") + 100), name, path)
    return spark.table(name)


QUOTED = "replace(replace(replace(replace(word, '\\', '\\\\'), chr(9), '\\t'), chr(13), '\\r'), chr(10), '\\n')"


@query(
    "K5",
    f"""SELECT '(' || CASE WHEN contains(word, '''') AND NOT contains(word, '"') THEN '"' || {QUOTED} || '"'
               ELSE '''' || replace({QUOTED}, '''', '\\''') || '''' END || ', ' || n || ')' AS value
        FROM (SELECT word, count(*) AS n FROM (
          SELECT unnest(string_split(line, ' ')) AS word FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents))
          GROUP BY word HAVING count(*) >= 3)""",
)
def text_sink(spark, folder):
    path = scratch_path(spark, "k5")
    writers.write_text(word_counts(lines(table(spark, folder, "documents"), "text")), path, writers.pair_line())
    return readers.read_text(spark, path)


RULE_SQL = """ruled AS (
  SELECT l.doc_id, l.quality, CASE WHEN d.n_chars > 400 THEN 1 ELSE 0 END AS guess
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def ruled(spark, folder):
    """Labelled documents with a guess by a length rule."""
    documents = table(spark, folder, "documents").select("doc_id", "n_chars")
    return table(spark, folder, "labels").join(documents, "doc_id").select("doc_id", "quality", F.when(F.col("n_chars") > 400, 1).otherwise(0).alias("guess"))


REPORT_CTES = """cls AS (SELECT c, count(*) FILTER (WHERE quality = c) AS support, count(*) FILTER (WHERE guess = c) AS predicted,
    count(*) FILTER (WHERE quality = c AND guess = c) AS hits FROM ruled, (VALUES (0), (1)) AS v(c) GROUP BY c),
  pr AS (SELECT c, support, hits, coalesce(hits / nullif(predicted, 0), 0) AS p, coalesce(hits / nullif(support, 0), 0) AS r FROM cls),
  f AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM pr),
  rep AS (SELECT c || '.0' AS "class", p AS "precision", r AS recall, f AS f1, support FROM f
    UNION ALL SELECT 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support), sum(hits) / sum(support), sum(support) FROM f
    UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM f
    UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support), sum(f * support) / sum(support), sum(support) FROM f)"""


@query(
    "K6",
    f"""WITH {RULE_SQL}, {REPORT_CTES}
    SELECT 'accuracy' AS metric, round(f1, 6) AS value FROM rep WHERE "class" = 'accuracy'
    UNION ALL SELECT 'confusion[' || quality || '.0,' || guess || '.0]', CAST(count(*) AS DOUBLE) FROM ruled GROUP BY quality, guess
    UNION ALL SELECT m || '[' || "class" || ']', round(CAST(v AS DOUBLE), 6) FROM (SELECT "class", unnest(['precision', 'recall', 'f1', 'support']) AS m,
      unnest(["precision", recall, f1, support]) AS v FROM rep WHERE "class" <> 'accuracy')""",
)
def report_sink(spark, folder):
    path = scratch_path(spark, "k6")
    writers.write_report(metrics_report(confusion(ruled(spark, folder), "quality", "guess"), "length rule", {"limit": 400}), path)
    back = readers.read_json(spark, path, "model string, feature_set string, metric string, value double, params map<string,string>")
    return back.select("metric", F.round("value", 6).alias("value"))


@query("K8", "SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY o_orderstatus")
def driver_result(spark, folder):
    small = writers.to_driver(table(spark, folder, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n")), 1000)
    return spark.createDataFrame(small, "o_orderstatus string, n bigint")


@query(
    "K9",
    "SELECT o_orderkey, o_totalprice * 2 + 1 AS o_totalprice, o_orderpriority FROM orders",
)
def replaced_input(spark, folder):
    """A stage that replaces the table it reads, twice: a plain table at first, then its own view."""
    name = unique("k9")
    table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority").write.saveAsTable(name)

    @table_stage(name, name)
    def change(frame, times, plus):
        return {"tables": {name: frame.withColumn("o_totalprice", F.col("o_totalprice") * times + plus)}}

    change(spark, times=2, plus=0)
    change(spark, times=1, plus=1)
    return spark.table(name)


@query(
    "K10",
    """WITH base AS (SELECT o_orderkey, o_orderpriority, CASE WHEN o_custkey % 7 <> 0 THEN o_totalprice END AS price FROM orders),
    m AS (SELECT median(price) AS mid FROM base)
    SELECT o_orderpriority, round(avg(coalesce(price, mid)), 4) AS average_price FROM base, m GROUP BY o_orderpriority""",
)
def stage_flow(spark, folder):
    """Three stages that hand over through tables: gaps filled, averaged, rounded."""
    raw, clean, means = (unique(f"k10_{n}") for n in ("raw", "clean", "means"))
    price = F.when(F.col("o_custkey") % 7 != 0, F.col("o_totalprice")).alias("price")
    table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", price).write.saveAsTable(raw)

    @table_stage(raw, clean)
    def fill(frame):
        return {"tables": {clean: fill_median(frame, "price")}}

    @table_stage(clean, means)
    def average(frame):
        return {"tables": {means: group_mean(frame, "o_orderpriority", "price", "average_price")}}

    run_stages(spark, [fill, average])
    return spark.table(means).select("o_orderpriority", F.round("average_price", 4).alias("average_price"))


@query(
    "etl",
    """SELECT c_mktsegment, c_custkey, round(c_acctbal / 3, 2) AS price FROM (
      SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_nationkey % 3, c_custkey) AS rn FROM customer) WHERE rn = 1""",
)
def car_flow(spark, folder):
    """Three formats, rounding, first row per key in reading order, parquet staging, table."""
    path, staging, name = scratch_path(spark, "etl"), scratch_path(spark, "etl_staging"), unique("etl")
    df = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", (F.col("c_acctbal") / 3).alias("price"))
    part = [df.filter(F.col("c_nationkey") % 3 == i).drop("c_nationkey").orderBy("c_custkey") for i in range(3)]
    part[0].write.option("header", True).csv(f"{path}/a.csv")
    part[1].write.json(f"{path}/b.json")
    part[2].write.format("xml").option("rootTag", "data").option("rowTag", "row").save(f"{path}/c.xml")
    rows = readers.read_folder(spark, path, "c_custkey bigint, c_mktsegment string, price double")
    writers.write_parquet(transform(rows, "c_mktsegment"), staging)
    writers.write_table(readers.read_parquet(spark, staging), name, scratch_path(spark, "etl_table"))
    return spark.table(name)
