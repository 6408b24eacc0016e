import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from grainmill.functions import columns as C
from grainmill.operators import bands, clean, joins, order_statistics, rows
from grainmill.plans.clinical import KEPT_COLUMNS, clean_clinical


def values(df, name):
    return [r[0] for r in df.select(name).collect()]


def test_median_fill_of_integers_may_be_fractional(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (4,), (3,)], "n int")
    assert values(clean.fill_median(df), "n") == [1.0, 2.0, 2.5, 4.0, 3.0]


def test_range_repair_refits_the_median(spark):
    df = spark.createDataFrame([(80.0,), (120.0,), (130.0,), (140.0,), (None,), (150.0,)], "x double")
    assert values(clean.replace_out_of_range(df, {"x": (100.0, None)}), "x") == [130.0, 120.0, 130.0, 140.0, 130.0, 150.0]
    df = spark.createDataFrame([(10.0,), (20.0,), (120.0,), (None,), (150.0,)], "x double")
    assert values(clean.replace_out_of_range(df, {"x": (100.0, None)}), "x") == [70.0, 70.0, 120.0, 95.0, 150.0]
    assert values(clean.replace_out_of_range(df, {"x": (100.0, None)}, refit=False), "x") == [70.0, 70.0, 120.0, 70.0, 150.0]


def test_clamp_keeps_null_and_is_idempotent(spark):
    df = spark.createDataFrame([(float(i),) for i in range(20)] + [(1000.0,), (None,)], "x double")
    once = clean.clamp_iqr(df, "x")
    assert values(once, "x")[-1] is None
    assert max(v for v in values(once, "x") if v is not None) < 1000
    assert sorted(v for v in values(clean.clamp_iqr(once, "x"), "x") if v is not None) == sorted(v for v in values(once, "x") if v is not None)


def test_z_filter_without_deviation_keeps_nothing(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert clean.drop_z_outliers(df, "x").count() == 0


def test_cap_and_constant(spark):
    df = spark.createDataFrame([(2.0,), (0.0,), (None,)], "x double")
    assert values(clean.fill_constant(clean.cap_columns(df, 1, "x"), {"x": 0}), "x") == [1.0, 0.0, 0.0]


def test_binary_encode_sends_null_to_one(spark):
    df = spark.createDataFrame([(0,), (1,), (None,)], "sex int")
    assert values(df.select(C.binary_encode(F.col("sex")).alias("sex")), "sex") == [0, 1, 1]


def test_products_do_not_overflow(spark):
    df = spark.createDataFrame([(50_000, 2)], "a int, b int")
    assert C.with_self_products(df).first().asDict() == {"a": 50_000, "b": 2, "a_x_a": 2_500_000_000, "a_x_b": 100_000, "b_x_b": 4}


def test_lenient_numeric_and_range(spark):
    df = spark.createDataFrame([("17",), ("18",), (" 24.5 ",), ("abc",), (None,), ("75",)], "age string")
    assert values(rows.keep_range(rows.lenient_numeric(df, "age"), "age", 18, 75), "age") == [18.0, 24.5]


def test_bands_are_closed_and_the_last_is_open(spark):
    df = spark.createDataFrame([(17.0,), (18.0,), (24.5,), (74.0,), (75.0,), (120.0,), (None,)], "age double")
    assert values(df.select(bands.band_label(F.col("age"), bands.SEVEN_BANDS).alias("b")), "b") == [
        None, "18–24", None, "65–74", "75 years and over", "75 years and over", None,
    ]


@pytest.mark.parametrize("limit", [100_000, 3])
def test_band_join_small_and_large_lookup(spark, monkeypatch, limit):
    """The cell join gives the same rows as the broadcast join."""
    table = bands.rate_table(spark, bands.SEVEN_BANDS, {label: (i + 0.5, i + 0.25) for i, (_, _, label) in enumerate(bands.SEVEN_BANDS)})
    monkeypatch.setattr(joins, "LOOPED_BANDS", limit)
    monkeypatch.setattr(bands, "SEARCHED", 0)
    ages = [None, float("nan"), -1e9, 10.0, 18.0, 24.0, 24.5, 25.0, 50.0, 64.0, 74.9, 75.0, 1e9]
    df = spark.createDataFrame([(a, s) for a in ages for s in (0, 1, None)], "age double, sex int")
    found = bands.add_rate(df, table, "age", "sex", "rate").collect()
    assert len(found) == len(ages) * 3
    assert all(r["rate"] is None for r in found if r["age"] != r["age"])
    got = {(r["age"], r["sex"]): r["rate"] for r in found}
    assert got[(18.0, 1)] == 0.5 and got[(18.0, 0)] == 0.25 and got[(18.0, None)] == 0.25
    assert got[(1e9, 1)] == 6.5 and got[(24.5, 1)] is None and got[(10.0, 1)] is None and got[(None, 1)] is None
    assert got[(50.0, 0)] == 3.25 and got[(64.0, 1)] == 4.5


@pytest.mark.parametrize("limit", [100_000, 1])
def test_outer_join_with_lookup(spark, monkeypatch, limit):
    monkeypatch.setattr(joins, "fits_broadcast", lambda df, rows=limit: df.limit(rows + 1).count() <= rows)
    df = spark.createDataFrame([("a", 1), ("a", 2), ("x", 3), (None, 4)], "k string, v int")
    small = spark.createDataFrame([("a", 0.5), ("b", 0.25)], "w string, share double")
    got = sorted((tuple(r) for r in joins.outer_with_lookup(df, small, "k", "w").collect()), key=str)
    assert got == sorted(
        [("a", 1, "a", 0.5), ("a", 2, "a", 0.5), ("x", 3, None, None), (None, 4, None, None), (None, None, "b", 0.25)], key=str
    )


def test_many_groups_of_one_open_band_stay_small(spark):
    """Cells are cut per group: a band of a group makes a row, however far the groups lie apart."""
    table = spark.range(2000).select(F.col("id").alias("group"), (F.col("id") * 10.0).alias("lo"), F.lit(None).cast("double").alias("hi"), F.col("id").alias("rate"))
    df = spark.range(2000).select("id", (F.col("id") * 10.0 + 5).alias("x"))
    joined = joins.band_join(df, table, F.col("x"), F.col("id"))
    assert joined.filter("rate = id").count() == 2000 == joined.count()
    plan = joined._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan


def test_concat_columns_keeps_all_rows_and_refuses_repeated_ids(spark):
    left = spark.createDataFrame([(1, 10), (2, 20)], "id int, x int")
    right = spark.createDataFrame([(1, 5), (3, 7)], "id int, y int")
    assert sorted(map(tuple, joins.concat_columns(left, right, "id").collect())) == [(1, 10, 5), (2, 20, None), (3, None, 7)]
    with pytest.raises(Exception, match="occurs twice"):
        joins.concat_columns(left, right.unionAll(right), "id").collect()


def test_concat_columns_refuses_shared_names(spark):
    df = spark.createDataFrame([(1, 2)], "id int, x int")
    assert joins.is_unique(df, "id")
    with pytest.raises(ValueError):
        joins.concat_columns(df, df, "id")


@pytest.mark.parametrize("bounded", [True, False])
def test_label_codes_small_and_large(spark, bounded):
    names = [f"v{i:03d}" for i in range(200)]
    df = spark.createDataFrame([(n,) for n in names[::-1] + names[:50] + [None]], "s string").repartition(7)
    got = {r["value"]: r["code"] for r in clean.label_codes(df, "s", bounded).collect()}
    assert got == {n: i for i, n in enumerate(names)}
    counted = clean.frequency_codes(df, "s", bounded).collect()
    assert {r["value"]: r["code"] for r in counted} == {n: i for i, n in enumerate(names)}


def test_label_encode_keeps_null(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "s string")
    got = sorted(((r["s"], r["s_encoded"]) for r in clean.label_encode(df).collect()), key=str)
    assert got == sorted([("b", 1), ("a", 0), (None, None), ("b", 1)], key=str)


def test_keep_first_per_key_and_required_columns(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, "z")], "k string, o int, v string")
    assert sorted(values(rows.keep_first_per_key(df, ["k"], [F.col("o")]), "v")) == ["y", "z"]
    with pytest.raises(ValueError, match="absent"):
        rows.require_columns(df, "k", "absent")
    with pytest.raises(ValueError):
        rows.first_rows(df, 3)


def test_clinical_flow_edge_rows(spark):
    base = dict(
        age="50", sex=1, painloc=1.0, painexer=0.0, cp=2, trestbps=120.0, smoke=None, fbs=0.0, prop=0.0, nitr=0.0, pro=0.0, diuretic=0.0,
        thaldur=5.0, thalach=140.0, exang=0.0, oldpeak=1.0, slope=2.0, target=1,
    )
    changes = [{}, {"age": "17"}, {"age": "75"}, {"age": "abc"}, {"trestbps": 80.0}, {"oldpeak": -1.0, "sex": None}, {"fbs": 2.0, "sex": 0},
               {"painloc": None, "slope": None, "thaldur": None, "diuretic": None}, {"age": "24.5"}]
    schema = ", ".join(f"{c} {'string' if c == 'age' else 'int' if c in ('sex', 'cp', 'target') else 'double'}" for c in KEPT_COLUMNS)
    df = spark.createDataFrame([tuple((base | change)[c] for c in KEPT_COLUMNS) for change in changes], schema)
    seven = bands.rate_table(spark, bands.SEVEN_BANDS, {"45–54": (0.2, 0.1)})
    four = bands.rate_table(spark, bands.FOUR_BANDS, {"45–64 years": (0.3, 0.2)})
    got = clean_clinical(df, seven, four).collect()
    assert len(got) == 6
    assert got[0]["smoke"] == 0.25 and got[2]["smoke"] == 0.15  # unknown sex takes the female rate
    assert got[1]["trestbps"] == 120.0 and got[2]["oldpeak"] == 1.0 and got[3]["fbs"] == 1.0
    assert got[4]["painloc"] == 1.0 and got[4]["slope"] == 2.0 and got[4]["thaldur"] == 5.0 and got[4]["diuretic"] == 0.0
    assert got[5]["smoke"] is None  # 24.5 lies between the bands


def plain_repair(x, low, high):
    """The median, the values outside the range as it, and the median of that, by sorting."""
    x = np.array([v for v in x if v is not None and not np.isnan(v)])
    if not len(x):
        return None, None
    first = float(np.median(x))
    out = np.zeros(len(x), bool)
    out |= (x < low) if low is not None else False
    out |= (x > high) if high is not None else False
    return first, float(np.median(np.where(out, first, x)))


RANGES = [(None, None), (0.0, None), (None, 1.0), (-0.5, 0.5), (0.2, 0.3), (5.0, 9.0), (-9.0, -5.0), (2.0, 1.0)]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 2500, 30001])
def test_both_medians_of_one_scan(spark, n):
    rng = np.random.default_rng(n)
    columns = {}
    for i, _ in enumerate(RANGES):
        x = rng.normal(size=n)
        x[rng.random(n) < 0.3] = 0.25
        x[rng.random(n) < 0.1] = np.nan
        columns[f"c{i}"] = x
    schema = ", ".join(f"c{i} double" for i in range(len(RANGES)))
    df = spark.createDataFrame(pd.DataFrame(columns), schema) if n else spark.createDataFrame([], schema)
    found = order_statistics.repaired_medians(df.repartition(3), {f"c{i}": r for i, r in enumerate(RANGES)})
    for i, (low, high) in enumerate(RANGES):
        first, last = plain_repair(columns[f"c{i}"], low, high)
        assert found[f"c{i}"] == (first if first is None else pytest.approx(first, abs=1e-15), last if last is None else pytest.approx(last, abs=1e-15)), (low, high)


def test_clinical_flow_runs_few_jobs(spark):
    from grainmill.catalog import REGISTRY
    from grainmill.catalog.cleaning import FOUR_RATES, SEVEN_RATES, clinical
    from grainmill.plans.clinical import clean_clinical

    raw = clinical(spark, "/root/testdata/sf0.001")
    rates = bands.rate_table(spark, bands.SEVEN_BANDS, SEVEN_RATES), bands.rate_table(spark, bands.FOUR_BANDS, FOUR_RATES)
    found = clean_clinical(raw, *rates)
    assert len(found.collect()) == REGISTRY["C25"].run(spark, "/root/testdata/sf0.001").count()
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    spark.sparkContext.setJobGroup("alone", "alone")
    clean_clinical(raw, *rates).collect()
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("alone")) <= 8
    spark.sparkContext.setJobGroup("other", "other")


TABLES = {
    "a": [(0.0, 10.0, 1, 0.5), (10.5, 20.0, 1, 0.6), (20.5, None, 1, None), (0.0, 5.0, 0, 0.1)],
    "b": [(5.0, 12.0, 1, 1.0), (12.0 + 1e-9, 12.5, 1, 2.0), (30.0, 30.0, 1, 3.0), (3.0, None, 0, 4.0), (None, 9.0, 0, 9.0), (7.0, 6.0, 0, 8.0)],
    "none": [],
}
AGES = [None, float("nan"), float("-inf"), -1.0, 0.0, 2.9, 3.0, 5.0, 5.1, 10.0, 10.2, 10.5, 11.0, 12.0, 12.0 + 1e-10, 12.2, 12.5, 13.0, 20.0, 20.4, 20.5, 29.0, 30.0, 30.0001, 1e9, float("inf")]


@pytest.mark.parametrize("limit", [500, 0])
def test_rates_of_several_tables_in_one_lookup(spark, monkeypatch, limit):
    monkeypatch.setattr(bands, "SEARCHED", limit)
    tables = {n: spark.createDataFrame(rows, "lo double, hi double, `group` int, rate double") for n, rows in TABLES.items()}
    rows = [(i, x, s) for i, (x, s) in enumerate((x, s) for x in AGES for s in (1, 0, None))]
    df = spark.createDataFrame(rows, "id int, age double, sex int")
    got = bands.add_rates(df, tables, "age", "sex")
    assert got.columns == ["id", "age", "sex", "a", "b", "none"]

    def rate(name, x, group):
        if x is None or x != x:
            return None
        return next((r for lo, hi, g, r in TABLES[name] if lo is not None and g == group and lo <= x and (hi is None or x <= hi)), None)

    found = {r["id"]: (r["a"], r["b"], r["none"]) for r in got.collect()}
    assert found == {i: tuple(rate(n, x, 1 if s == 1 else 0) for n in TABLES) for i, x, s in rows}


def test_overlapping_bands_are_joined(spark):
    assert bands.refined({"a": [(0.0, 5.0, 1, 1.0), (5.0, 9.0, 1, 2.0)]}) is None
    table = spark.createDataFrame([(0.0, 5.0, 1, 1.0), (5.0, 9.0, 1, 2.0)], "lo double, hi double, `group` int, rate double")
    df = spark.createDataFrame([(5.0, 1)], "age double, sex int")
    assert sorted(r["r"] for r in bands.add_rates(df, {"r": table}, "age", "sex").collect()) == [1.0, 2.0]
