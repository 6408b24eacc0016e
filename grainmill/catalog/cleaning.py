"""Cleaning and imputation (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from grainmill.catalog.frames import FOUR_RATES, GAPPED, KEY, KEY_SQL, PEOPLE, SEVEN_RATES, gapped, people, rates_sql
from grainmill.catalog.registry import query, table
from grainmill.functions.columns import binary_encode, col, mean_of_available
from grainmill.models.feature_stages import frequency_indexer, mean_imputer
from grainmill.models.table_index import MODE, FrequencyIndexer
from grainmill.operators import bands, clean, profile
from grainmill.plans.clinical import clean_clinical


@query(
    "C1",
    f"WITH {GAPPED} SELECT " + ", ".join(f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS {c}" for c in (*KEY, "quantity", "price", "discount", "flag")) + " FROM base",
)
def null_counts(spark, folder):
    return profile.null_counts(gapped(spark, folder))


PROFILE = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS missing, round((count(*) - count({c})) * 100.0 / count(*), 6) AS percent FROM base"
    for c in ("quantity", "price", "discount", "flag")
)


@query("C2", f"WITH {GAPPED} {PROFILE}")
def null_percent(spark, folder):
    return profile.null_profile(gapped(spark, folder).drop(*KEY)).withColumn("percent", F.round("percent", 6))


@query("C3", f"WITH {GAPPED} SELECT \"column\", missing FROM ({PROFILE}) WHERE missing > 0")
def null_ranking(spark, folder):
    return profile.null_ranking(gapped(spark, folder))


@query(
    "C4",
    f"""WITH {GAPPED},
    mq AS (SELECT quantity AS v FROM base WHERE quantity IS NOT NULL GROUP BY quantity ORDER BY count(*) DESC, quantity LIMIT 1),
    mf AS (SELECT flag AS v FROM base WHERE flag IS NOT NULL GROUP BY flag ORDER BY count(*) DESC, flag LIMIT 1)
    SELECT {KEY_SQL}, coalesce(quantity, mq.v) AS quantity, coalesce(flag, mf.v) AS flag FROM base, mq, mf""",
)
def mode_fill(spark, folder):
    return clean.fill_mode(gapped(spark, folder).drop("price", "discount"), "quantity", "flag")


@query(
    "C5",
    f"WITH {GAPPED}, m AS (SELECT median(price) AS p FROM base) SELECT {KEY_SQL}, round(coalesce(price, p), 4) AS price FROM base, m",
)
def median_fill(spark, folder):
    return clean.fill_median(gapped(spark, folder).select(*KEY, "price"), "price").withColumn("price", F.round("price", 4))


@query(
    "C6",
    f"""WITH {GAPPED}, m AS (SELECT median(price) AS p, median(quantity) AS q FROM base)
    SELECT flag, round(coalesce(quantity, q), 4) AS quantity, round(coalesce(price, p), 4) AS price, discount FROM base, m""",
)
def all_medians(spark, folder):
    df = clean.fill_median(gapped(spark, folder).drop(*KEY))
    return df.withColumns({"price": F.round("price", 4), "quantity": F.round("quantity", 4)})


@query("C7", f"WITH {GAPPED} SELECT {KEY_SQL}, coalesce(quantity, 0) AS quantity, coalesce(flag, '?') AS flag FROM base")
def constant_fill(spark, folder):
    return clean.fill_constant(gapped(spark, folder).drop("price", "discount"), {"quantity": 0, "flag": "?"})


RANGE_SQL = f"""WITH {GAPPED},
    m1 AS (SELECT median(quantity) AS q, median(discount) AS d FROM base),
    r AS (SELECT {KEY_SQL}, CASE WHEN quantity < 10 THEN m1.q ELSE quantity END AS quantity,
      CASE WHEN discount < 0.02 OR discount > 0.07 THEN m1.d ELSE discount END AS discount FROM base, m1)"""


@query(
    "C8",
    f"""{RANGE_SQL}, m2 AS (SELECT median(quantity) AS q, median(discount) AS d FROM r)
    SELECT {KEY_SQL}, coalesce(quantity, m2.q) AS quantity, coalesce(discount, m2.d) AS discount FROM r, m2""",
)
def range_repair(spark, folder):
    return clean.replace_out_of_range(gapped(spark, folder).drop("price", "flag"), {"quantity": (10, None), "discount": (0.02, 0.07)})


@query(
    "C8_one_median",
    f"{RANGE_SQL} SELECT {KEY_SQL}, coalesce(quantity, m1.q) AS quantity, coalesce(discount, m1.d) AS discount FROM r, m1",
)
def range_repair_once(spark, folder):
    return clean.replace_out_of_range(gapped(spark, folder).drop("price", "flag"), {"quantity": (10, None), "discount": (0.02, 0.07)}, refit=False)


@query("C9", f"WITH {GAPPED} SELECT {KEY_SQL}, CASE WHEN quantity > 40 THEN 40 ELSE quantity END AS quantity FROM base")
def upper_cap(spark, folder):
    return clean.cap_columns(gapped(spark, folder).select(*KEY, "quantity"), 40, "quantity")


@query("C10", f"WITH {PEOPLE} SELECT c_custkey, CASE WHEN sex = 0 THEN 0 ELSE 1 END AS sex FROM people")
def binary(spark, folder):
    return people(spark, folder).select("c_custkey", binary_encode(F.col("sex")).alias("sex"))


MEASURES = {"quantity": "l_quantity * l_quantity * l_quantity", "price": "l_extendedprice", "rate": "l_tax * l_tax"}


def measures(spark, folder):
    """Three numeric columns of lineitem, two of them skewed."""
    return table(spark, folder, "lineitem").select(
        (F.col("l_quantity") * F.col("l_quantity") * F.col("l_quantity")).alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_tax") * F.col("l_tax")).alias("rate"),
    )


MEASURED = "measured AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in MEASURES.items()) + " FROM lineitem)"
QUARTILE_CTE = "q AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.25) AS {c}1, quantile_cont({c}, 0.75) AS {c}3" for c in MEASURES) + " FROM measured)"


def _outside(c: str, factor: float = 1.5) -> str:
    return f"({c} < {c}1 - {factor} * ({c}3 - {c}1) OR {c} > {c}3 + {factor} * ({c}3 - {c}1))"


@query(
    "C11",
    f"WITH {MEASURED}, {QUARTILE_CTE} "
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {_outside(c, 0.4)}) AS BIGINT) AS outliers FROM measured, q" for c in MEASURES),
)
def outliers(spark, folder):
    return profile.outlier_counts(measures(spark, folder), factor=0.4)


@query(
    "C12",
    f"""WITH {GAPPED}, q AS (SELECT quantile_cont(quantity, 0.25) AS a1, quantile_cont(quantity, 0.75) AS a3,
      quantile_cont(price, 0.25) AS b1, quantile_cont(price, 0.75) AS b3 FROM base)
    SELECT {KEY_SQL},
      round(CASE WHEN quantity < a1 - 0.3 * (a3 - a1) THEN a1 - 0.3 * (a3 - a1) WHEN quantity > a3 + 0.3 * (a3 - a1) THEN a3 + 0.3 * (a3 - a1) ELSE quantity END, 4) AS quantity,
      round(CASE WHEN price < b1 - 0.3 * (b3 - b1) THEN b1 - 0.3 * (b3 - b1) WHEN price > b3 + 0.3 * (b3 - b1) THEN b3 + 0.3 * (b3 - b1) ELSE price END, 4) AS price
    FROM base, q""",
)
def iqr_clamp(spark, folder):
    df = clean.clamp_iqr(gapped(spark, folder).select(*KEY, "quantity", "price"), "quantity", "price", factor=0.3)
    return df.withColumns({c: F.round(c, 4) for c in ("quantity", "price")})


@query(
    "C13",
    """WITH s1 AS (SELECT avg(p_size) AS m, stddev_samp(p_size) AS s FROM part),
    r1 AS (SELECT part.* FROM part, s1 WHERE abs(p_size - m) / s - 1.0 < 0.01),
    s2 AS (SELECT avg(p_retailprice) AS m, stddev_samp(p_retailprice) AS s FROM r1)
    SELECT p_partkey, p_size, p_retailprice FROM r1, s2 WHERE abs(p_retailprice - m) / s - 1.0 < 0.01""",
)
def z_filter(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice")
    return clean.drop_z_outliers(part, "p_size", "p_retailprice", factor=1.0)


@query("C14", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def trimmed(spark, folder):
    padded = table(spark, folder, "customer").select(
        "c_custkey", F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"), F.concat(F.lit(" "), "c_mktsegment").alias("c_mktsegment")
    )
    return clean.trim_text(padded)


@query(
    "C15",
    f"WITH {MEASURED}, {QUARTILE_CTE}, labelled AS (SELECT measured.*, q.* FROM measured, q) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, CAST(count(*) - count({c}) AS BIGINT) AS missing_values, CAST(count(*) FILTER (WHERE {_outside(c)}) AS BIGINT) AS outliers,
        CASE WHEN count(*) FILTER (WHERE {_outside(c)}) > 0 THEN 'Yes' ELSE 'No' END AS prone_to_outliers,
        round(avg(power({c} - m, 3)) / power(avg(power({c} - m, 2)), 1.5), 6) AS skewness,
        CASE WHEN abs(avg(power({c} - m, 3)) / power(avg(power({c} - m, 2)), 1.5)) > 0.5 THEN 'Yes' ELSE 'No' END AS skewness_label
        FROM labelled, (SELECT avg({c}) AS m FROM measured)"""
        for c in MEASURES
    )
    + " UNION ALL SELECT 'flag', 0, NULL, 'No', NULL, 'N/A'",
)
def variable_profile(spark, folder):
    flag = table(spark, folder, "lineitem").select(
        (F.col("l_quantity") * F.col("l_quantity") * F.col("l_quantity")).alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_tax") * F.col("l_tax")).alias("rate"),
        F.col("l_returnflag").alias("flag"),
    )
    return profile.column_profile(flag).withColumn("skewness", F.round("skewness", 6))


def _label_sql(table_bands) -> str:
    tests = " ".join(f"WHEN age >= {lo}{'' if hi is None else f' AND age <= {hi}'} THEN '{label}'" for lo, hi, label in table_bands)
    return f"CASE {tests} END"


@query("C16", f"WITH {PEOPLE} SELECT c_custkey, {_label_sql(bands.SEVEN_BANDS)} AS seven, {_label_sql(bands.FOUR_BANDS)} AS four FROM people")
def labels(spark, folder):
    df = bands.add_band_label(people(spark, folder), "age", bands.SEVEN_BANDS, "seven")
    return bands.add_band_label(df, "age", bands.FOUR_BANDS, "four").drop("age", "sex")


IN_BAND = "{r}.lo <= age AND ({r}.hi IS NULL OR age <= {r}.hi) AND {r}.grp = CASE WHEN sex = 1 THEN 1 ELSE 0 END"
RATED = f"""{PEOPLE}, rated AS (SELECT people.*, a.rate AS seven_rate, b.rate AS four_rate FROM people
    LEFT JOIN {rates_sql(bands.SEVEN_BANDS, SEVEN_RATES).replace(' AS r(', ' AS a(')} ON {IN_BAND.format(r='a')}
    LEFT JOIN {rates_sql(bands.FOUR_BANDS, FOUR_RATES).replace(' AS r(', ' AS b(')} ON {IN_BAND.format(r='b')})"""


def rated(spark, folder):
    tables = {"seven_rate": bands.rate_table(spark, bands.SEVEN_BANDS, SEVEN_RATES), "four_rate": bands.rate_table(spark, bands.FOUR_BANDS, FOUR_RATES)}
    return bands.add_rates(people(spark, folder), tables, "age", "sex")


@query("C17", f"WITH {RATED} SELECT c_custkey, age, sex, seven_rate, four_rate FROM rated")
def reference_rates(spark, folder):
    return rated(spark, folder)


MEAN_SQL = "round(coalesce((seven_rate + four_rate) / 2, seven_rate, four_rate), 9)"


@query("C18", f"WITH {RATED} SELECT c_custkey, {MEAN_SQL} AS rate FROM rated")
def mean_rate(spark, folder):
    return rated(spark, folder).select("c_custkey", F.round(mean_of_available(col("seven_rate"), col("four_rate")), 9).alias("rate"))


@query("C19", f"WITH {GAPPED} SELECT {KEY_SQL}, coalesce(price, quantity * 1000) AS price FROM base")
def filled_from(spark, folder):
    df = clean.fill_from(gapped(spark, folder), "price", F.col("quantity") * 1000)
    return df.select(*KEY, "price")


@query("C20", f"SELECT {KEY_SQL}, round(l_extendedprice / 3, 3) AS third FROM lineitem")
def rounded(spark, folder):
    df = table(spark, folder, "lineitem").select(*KEY, (F.col("l_extendedprice") / 3).alias("third"))
    return clean.round_columns(df, 3, "third")


@query(
    "C21",
    f"WITH {GAPPED}, m AS (SELECT avg(quantity) AS q, avg(price) AS p FROM base) "
    f"SELECT {KEY_SQL}, round(coalesce(quantity, q), 4) AS quantity, round(coalesce(price, p), 4) AS price FROM base, m",
)
def mean_imputed(spark, folder):
    df = gapped(spark, folder).select(*KEY, "quantity", "price")
    filled = mean_imputer(["quantity", "price"]).fit(df).transform(df)
    return filled.select(*KEY, F.round("Imputedquantity", 4).alias("quantity"), F.round("Imputedprice", 4).alias("price"))


PRIORITIES = """base AS (SELECT o_orderkey, CASE WHEN o_custkey % 4 <> 0 THEN o_orderpriority END AS priority FROM orders),
    codes AS (SELECT priority, row_number() OVER (ORDER BY count(*) DESC, priority) - 1 AS code FROM base WHERE priority IS NOT NULL GROUP BY priority)"""


def priorities(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 4 != 0, F.col("o_orderpriority")).alias("priority"))


@query("C22", f"WITH {PRIORITIES} SELECT o_orderkey, CAST(coalesce(code, 0) AS DOUBLE) AS code FROM base LEFT JOIN codes USING (priority)")
def imputed_index(spark, folder):
    df = priorities(spark, folder)
    return FrequencyIndexer(inputCols=["priority"], outputCols=["code"], unknown=MODE).fit(df).transform(df).select("o_orderkey", "code")


@query(
    "C23",
    """SELECT p_partkey, p_type, p_brand, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS BIGINT) AS p_type_encoded,
    CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS BIGINT) AS p_brand_encoded FROM part""",
)
def label_codes(spark, folder):
    return clean.label_encode(table(spark, folder, "part").select("p_partkey", "p_type", "p_brand"))


@query(
    "C24",
    f"WITH {PRIORITIES} SELECT o_orderkey, CAST(coalesce(code, (SELECT count(*) FROM codes)) AS DOUBLE) AS \"priorityIndex\" FROM base LEFT JOIN codes USING (priority)",
)
def frequency_index(spark, folder):
    df = priorities(spark, folder)
    return frequency_indexer(["priority"]).fit(df).transform(df).select("o_orderkey", "priorityIndex")


@query("C24_codes", f"WITH {PRIORITIES} SELECT o_orderkey, priority, CAST(code AS BIGINT) AS priority_encoded FROM base LEFT JOIN codes USING (priority)")
def frequency_codes(spark, folder):
    df = priorities(spark, folder)
    return clean.encode(df, "priority", clean.frequency_codes(df, "priority"))


def clinical(spark, folder):
    """Lineitem in the shape of the clinical table, with gaps, odd values and text ages."""
    line, part, supp, q = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_quantity")
    price, order = F.col("l_extendedprice"), F.col("l_orderkey")
    columns = {
        "age": F.when(part % 50 == 0, "abc").otherwise((q + part % 40).cast("string")),
        "sex": F.when(supp % 9 != 0, line % 2),
        "painloc": F.when(line != 3, part % 2),
        "painexer": F.when(line != 4, part % 3),
        "cp": line,
        "trestbps": F.when(line != 5, q * 4),
        "smoke": F.when(line != 6, (part % 10) / 10.0),
        "fbs": F.when(line != 2, (part % 4).cast("double")),
        "prop": F.when(line != 1, (supp % 3).cast("double")),
        "nitr": (supp % 2).cast("double"),
        "pro": F.when(line != 7, (order % 3).cast("double")),
        "diuretic": (order % 2).cast("double"),
        "thaldur": F.when(line != 4, price / 1000),
        "thalach": F.when(line != 5, q * 3 + 60),
        "exang": F.when(line != 6, order % 2),
        "oldpeak": F.when(line != 7, q / 10 - 0.5),
        "slope": F.when(line != 2, part % 4),
        "target": order % 2,
    }
    return table(spark, folder, "lineitem").select(*[c.alias(n) for n, c in columns.items()])


CLINICAL_SQL = f"""WITH raw AS (SELECT
    CASE WHEN l_partkey % 50 = 0 THEN 'abc' ELSE CAST(l_quantity + l_partkey % 40 AS VARCHAR) END AS age,
    CASE WHEN l_suppkey % 9 <> 0 THEN l_linenumber % 2 END AS sex,
    CASE WHEN l_linenumber <> 3 THEN l_partkey % 2 END AS painloc, CASE WHEN l_linenumber <> 4 THEN l_partkey % 3 END AS painexer,
    l_linenumber AS cp, CASE WHEN l_linenumber <> 5 THEN l_quantity * 4 END AS trestbps,
    CASE WHEN l_linenumber <> 6 THEN (l_partkey % 10) / 10.0::DOUBLE END AS smoke,
    CASE WHEN l_linenumber <> 2 THEN CAST(l_partkey % 4 AS DOUBLE) END AS fbs, CASE WHEN l_linenumber <> 1 THEN CAST(l_suppkey % 3 AS DOUBLE) END AS prop,
    CAST(l_suppkey % 2 AS DOUBLE) AS nitr, CASE WHEN l_linenumber <> 7 THEN CAST(l_orderkey % 3 AS DOUBLE) END AS pro, CAST(l_orderkey % 2 AS DOUBLE) AS diuretic,
    CASE WHEN l_linenumber <> 4 THEN l_extendedprice / 1000 END AS thaldur, CASE WHEN l_linenumber <> 5 THEN l_quantity * 3 + 60 END AS thalach,
    CASE WHEN l_linenumber <> 6 THEN l_orderkey % 2 END AS exang, CASE WHEN l_linenumber <> 7 THEN l_quantity / 10 - 0.5 END AS oldpeak,
    CASE WHEN l_linenumber <> 2 THEN l_partkey % 4 END AS slope, l_orderkey % 2 AS target FROM lineitem),
  modes AS (SELECT
    (SELECT painloc FROM raw WHERE painloc IS NOT NULL GROUP BY painloc ORDER BY count(*) DESC, painloc LIMIT 1) AS m1,
    (SELECT painexer FROM raw WHERE painexer IS NOT NULL GROUP BY painexer ORDER BY count(*) DESC, painexer LIMIT 1) AS m2,
    (SELECT exang FROM raw WHERE exang IS NOT NULL GROUP BY exang ORDER BY count(*) DESC, exang LIMIT 1) AS m3,
    (SELECT slope FROM raw WHERE slope IS NOT NULL GROUP BY slope ORDER BY count(*) DESC, slope LIMIT 1) AS m4),
  med AS (SELECT median(trestbps) AS t, median(oldpeak) AS o, median(thaldur) AS d, median(thalach) AS h FROM raw),
  ranged AS (SELECT raw.* REPLACE (CASE WHEN trestbps < 100 THEN t ELSE trestbps END AS trestbps,
    CASE WHEN oldpeak < 0 OR oldpeak > 4 THEN o ELSE oldpeak END AS oldpeak) FROM raw, med),
  med2 AS (SELECT median(trestbps) AS t2, median(oldpeak) AS o2 FROM ranged),
  filled AS (SELECT TRY_CAST(age AS DOUBLE) AS age, sex, coalesce(painloc, m1) AS painloc, coalesce(painexer, m2) AS painexer, cp,
    coalesce(trestbps, t2) AS trestbps, smoke, fbs, prop, nitr, pro, diuretic, coalesce(thaldur, d) AS thaldur,
    coalesce(thalach, h) AS thalach, coalesce(exang, m3) AS exang, coalesce(oldpeak, o2) AS oldpeak, coalesce(slope, m4) AS slope, target
    FROM ranged, modes, med, med2),
  people AS (SELECT * FROM filled WHERE age >= 18 AND age < 75),
  rated AS (SELECT people.*, a.rate AS seven_rate, b.rate AS four_rate FROM people
    LEFT JOIN {rates_sql(bands.SEVEN_BANDS, SEVEN_RATES).replace(' AS r(', ' AS a(')} ON {IN_BAND.format(r='a')}
    LEFT JOIN {rates_sql(bands.FOUR_BANDS, FOUR_RATES).replace(' AS r(', ' AS b(')} ON {IN_BAND.format(r='b')})
  SELECT age, sex, painloc, painexer, cp, trestbps, round(coalesce(smoke, (seven_rate + four_rate) / 2, seven_rate, four_rate), 3) AS smoke,
    coalesce(CASE WHEN fbs > 1 THEN 1 ELSE fbs END, 0) AS fbs, coalesce(CASE WHEN prop > 1 THEN 1 ELSE prop END, 0) AS prop,
    coalesce(CASE WHEN nitr > 1 THEN 1 ELSE nitr END, 0) AS nitr, coalesce(CASE WHEN pro > 1 THEN 1 ELSE pro END, 0) AS pro,
    coalesce(CASE WHEN diuretic > 1 THEN 1 ELSE diuretic END, 0) AS diuretic, thaldur, thalach, exang, oldpeak, slope,
    round(seven_rate, 3) AS abs_smoke_rate, round(four_rate, 3) AS cdc_smoke_rate, target FROM rated"""


@query("C25", CLINICAL_SQL)
def clinical_flow(spark, folder):
    return clean_clinical(
        clinical(spark, folder),
        bands.rate_table(spark, bands.SEVEN_BANDS, SEVEN_RATES),
        bands.rate_table(spark, bands.FOUR_BANDS, FOUR_RATES),
    )
