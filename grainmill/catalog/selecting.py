"""Row and column selection, union, order, joins, sampling (P, U, O, J, M)."""

from __future__ import annotations

from pyspark.sql import functions as F

from grainmill.catalog.frames import GAPPED, KEY, KEY_SQL, PEOPLE, SEVEN_RATES, gapped, people, rates_sql
from grainmill.catalog.registry import query, table
from grainmill.catalog.storing import SEGMENT_SHARES, SHARE_COLUMNS, SHARES_SQL
from grainmill.functions import columns as C
from grainmill.operators import bands, joins, rows, sample
from grainmill.sources.readers import literal_table


@query("P1", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def keep(spark, folder):
    return rows.keep_columns(table(spark, folder, "lineitem"), "l_orderkey", "l_partkey", "l_quantity")


@query("P2", "SELECT p_partkey, p_name, p_brand, p_size FROM part")
def drop(spark, folder):
    return rows.drop_columns(table(spark, folder, "part"), "p_type", "p_retailprice", "no_such_column")


@query("P3", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 899")
def first(spark, folder):
    return rows.first_rows(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), 899, "o_orderkey")


@query("P4", f"SELECT {KEY_SQL}, l_quantity FROM lineitem WHERE l_quantity BETWEEN 30 AND 50")
def between(spark, folder):
    return rows.keep_range(table(spark, folder, "lineitem").select(*KEY, "l_quantity"), "l_quantity", 30, 50, include_high=True)


@query("P5", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority = '5-LOW'")
def equal(spark, folder):
    return rows.keep_equal(table(spark, folder, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", "5-LOW")


@query(
    "P6",
    f"""WITH {GAPPED} SELECT CAST(count(*) FILTER (WHERE quantity < 18) AS BIGINT) AS low,
    CAST(count(*) FILTER (WHERE quantity >= 45) AS BIGINT) AS high, CAST(count(*) FILTER (WHERE price IS NULL) AS BIGINT) AS no_price FROM base""",
)
def counts(spark, folder):
    return rows.count_where(
        gapped(spark, folder), {"low": F.col("quantity") < 18, "high": F.col("quantity") >= 45, "no_price": F.col("price").isNull()}
    )


@query("P7", f"SELECT {KEY_SQL}, CAST(trunc(l_extendedprice) AS INTEGER) AS l_extendedprice FROM lineitem")
def cast(spark, folder):
    return rows.cast_columns(table(spark, folder, "lineitem").select(*KEY, "l_extendedprice"), {"l_extendedprice": "int"})


@query(
    "P8",
    "SELECT c_custkey, TRY_CAST(CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE substr(c_name, 10) END AS DOUBLE) AS number FROM customer",
)
def lenient(spark, folder):
    text = F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).otherwise(F.substring("c_name", 10, 100))
    return rows.lenient_numeric(table(spark, folder, "customer").select("c_custkey", text.alias("number")), "number")


@query("P9", "SELECT p_size, p_retailprice FROM part")
def numeric_only(spark, folder):
    part = table(spark, folder, "part")
    return part.select(*C.numeric_columns(part, exclude=["p_partkey"]))


@query("P10", f"WITH {GAPPED} SELECT * FROM base WHERE quantity IS NOT NULL AND price IS NOT NULL AND flag IS NOT NULL")
def complete(spark, folder):
    return rows.drop_incomplete(gapped(spark, folder))


@query(
    "P11",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
    FROM orders) WHERE rn = 1""",
)
def first_per_key(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return rows.keep_first_per_key(orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).drop("o_orderdate")


@query("P12", "SELECT p_partkey, p_type, p_size, p_retailprice FROM part")
def numeric_and_label(spark, folder):
    return rows.drop_non_numeric(table(spark, folder, "part"), "p_type")


@query("P13", "SELECT s_suppkey AS supplier, s_acctbal AS balance FROM supplier")
def renamed(spark, folder):
    return rows.rename(table(spark, folder, "supplier").select("s_suppkey", "s_acctbal"), {"s_suppkey": "supplier", "s_acctbal": "balance"})


@query("P14", "SELECT p_partkey, p_size, p_retailprice FROM part")
def features(spark, folder):
    return rows.split_label(table(spark, folder, "part"), "p_type", exclude=["p_name", "p_brand"])[0]


@query("P15", "SELECT o_orderkey, o_custkey FROM orders")
def required(spark, folder):
    return rows.require_columns(table(spark, folder, "orders"), "o_orderkey", "o_custkey").select("o_orderkey", "o_custkey")


@query(
    "U1",
    """SELECT 'c' AS kind, c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT 's', s_suppkey, s_acctbal, NULL FROM supplier""",
)
def union(spark, folder):
    customers = table(spark, folder, "customer").select(F.lit("c").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    suppliers = table(spark, folder, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"), F.lit("s").alias("kind"))
    return rows.union_all(customers, suppliers)


@query("U2", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct(spark, folder):
    return rows.distinct_values(table(spark, folder, "part"), "p_brand", "p_type")


@query("O1", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top(spark, folder):
    return rows.top_rows(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), 10, "o_totalprice", "o_orderkey")


@query("O2", "SELECT p_type, CAST(count(*) AS BIGINT) AS n FROM part GROUP BY p_type ORDER BY n DESC, p_type LIMIT 1")
def top_group(spark, folder):
    return rows.top_rows(table(spark, folder, "part").groupBy("p_type").agg(F.count("*").alias("n")), 1, "n", "p_type")


@query("O3", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def descending(spark, folder):
    return rows.sort_descending(table(spark, folder, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", "c_custkey")


@query("O4", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 1")
def tail(spark, folder):
    return rows.last_rows(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), 1, "o_orderkey")


@query(
    "J1",
    f"""SELECT c_custkey, c_mktsegment, segment, CAST(male AS DOUBLE) AS male, CAST(female AS DOUBLE) AS female
    FROM customer FULL OUTER JOIN {SHARES_SQL} ON c_mktsegment = segment""",
)
def outer(spark, folder):
    shares = literal_table(spark, SEGMENT_SHARES, SHARE_COLUMNS)
    return joins.outer_with_lookup(table(spark, folder, "customer").select("c_custkey", "c_mktsegment"), shares, "c_mktsegment", "segment")


@query(
    "J2_many",
    f"""WITH bands AS (SELECT p_partkey % 7 AS grp, p_partkey * 40.0 AS lo, p_partkey * 40.0 + 30 AS hi, p_size FROM part)
    SELECT o_orderkey, o_custkey % 8 AS grp, o_totalprice, p_size FROM orders LEFT JOIN bands ON bands.grp = o_custkey % 8 AND o_totalprice >= lo AND o_totalprice <= hi""",
)
def many_bands(spark, folder):
    """A price band for each part, in seven groups, and orders in eight."""
    cut = table(spark, folder, "part").select((F.col("p_partkey") % 7).alias("group"), (F.col("p_partkey") * F.lit(40.0)).alias("lo"), "p_size")
    cut = cut.withColumn("hi", F.col("lo") + 30)
    orders = table(spark, folder, "orders").select("o_orderkey", (F.col("o_custkey") % 8).alias("grp"), "o_totalprice")
    return joins.band_join(orders, cut, F.col("o_totalprice"), F.col("grp"))


@query(
    "J2",
    f"""WITH {PEOPLE} SELECT c_custkey, age, sex, rate FROM people
    LEFT JOIN {rates_sql(bands.SEVEN_BANDS, SEVEN_RATES)} ON age >= lo AND (hi IS NULL OR age <= hi) AND grp = CASE WHEN sex = 1 THEN 1 ELSE 0 END""",
)
def band(spark, folder):
    rates = bands.rate_table(spark, bands.SEVEN_BANDS, SEVEN_RATES)
    return bands.add_rate(people(spark, folder), rates, "age", "sex", "rate")


@query("J3", f"SELECT {KEY_SQL}, l_quantity * l_discount AS product, greatest(l_quantity, l_extendedprice) AS larger FROM lineitem")
def side_by_side(spark, folder):
    """Two feature frames of all rows, lined up by the place of each row in its file."""
    rows = table(spark, folder, "lineitem").select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    left = rows.select("file", "row", *KEY, (F.col("l_quantity") * F.col("l_discount")).alias("product"))
    right = rows.select("file", "row", F.greatest("l_quantity", "l_extendedprice").alias("larger"))
    return joins.concat_columns(left, right, "file", "row").select(*KEY, "product", "larger")


# Random operators: the SQL states what must hold whatever rows are drawn.


@query("M1", f"SELECT {KEY_SQL}, l_quantity FROM lineitem WHERE (l_orderkey * 7 + l_linenumber * 3) % 10 < 2")
def bernoulli(spark, folder):
    """A fifth of the rows, by a share that SQL knows too; that the hash keeps a fifth as well is tested."""
    lineitem = table(spark, folder, "lineitem").select(*KEY, "l_quantity")
    share = F.pmod(F.col("l_orderkey") * 7 + F.col("l_linenumber") * 3, F.lit(10)) / F.lit(10.0)
    return sample.bernoulli_sample(lineitem, 0.2, KEY, share=share)


@query("M1_hash", "SELECT CAST(count(*) AS BIGINT) AS n_rows, true AS within FROM lineitem")
def bernoulli_by_hash(spark, folder):
    """The number of rows that the hash keeps lies within six deviations of a fifth."""
    lineitem = table(spark, folder, "lineitem").select(*KEY)
    drawn = sample.bernoulli_sample(lineitem, 0.2, KEY).agg(F.count("*").alias("drawn"))
    counted = lineitem.agg(F.count("*").alias("n_rows")).crossJoin(F.broadcast(drawn))  # one row each
    spread = 6 * F.sqrt(F.col("n_rows") * 0.16)
    return counted.select("n_rows", (F.abs(F.col("drawn") - F.col("n_rows") * 0.2) <= spread).alias("within"))


@query("M2", "SELECT CAST(least(count(*), 1000) AS BIGINT) AS n_rows, CAST(least(count(*), 1000) AS BIGINT) AS n_distinct FROM orders")
def fixed_size(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return sample.sample_rows(orders, 1000, ["o_orderkey"]).agg(F.count("*").alias("n_rows"), F.countDistinct("o_orderkey").alias("n_distinct"))


@query("M3", "SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 10 = 9 THEN 'test' ELSE 'train' END AS part FROM orders")
def random_split(spark, folder):
    """Both parts of a split together are the input again, each row once and in its part."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    train, test = sample.split_rows(orders, [0.9, 0.1], ["o_orderkey"], share=F.pmod("o_orderkey", F.lit(10)) / F.lit(10.0))
    return train.withColumn("part", F.lit("train")).unionAll(test.withColumn("part", F.lit("test")))


@query(
    "M4",
    """SELECT o_orderpriority, CAST(count(*) - round_even(count(*) * 0.1, 0) AS BIGINT) AS n_train, CAST(round_even(count(*) * 0.1, 0) AS BIGINT) AS n_test
    FROM orders GROUP BY o_orderpriority""",
)
def stratified(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    train, test = sample.stratified_split(orders, "o_orderpriority", 0.1, ["o_orderkey"])
    marked = train.select("o_orderpriority", F.lit("train").alias("part")).unionAll(test.select("o_orderpriority", F.lit("test").alias("part")))
    return marked.groupBy("o_orderpriority").agg(
        F.count_if(F.col("part") == "train").alias("n_train"), F.count_if(F.col("part") == "test").alias("n_test")
    )
