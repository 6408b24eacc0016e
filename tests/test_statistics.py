import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from grainmill.operators import aggregates, comoments, eda, order_statistics, profile


@pytest.fixture(scope="module")
def hot():
    """Hot values at both ends of an interval, many values between, and extreme ones."""
    rng = np.random.default_rng(1)
    x = np.concatenate([np.full(6000, 3.0), np.full(6000, 4.0), 3 + rng.random(600), rng.lognormal(0, 4, 4000), [-1e300, 1e300]])
    rng.shuffle(x)
    pdf = pd.DataFrame({"x": x, "y": rng.integers(0, 5, len(x)).astype(float)})
    pdf.loc[::7, "y"] = np.nan
    return pdf


@pytest.mark.parametrize("values, accuracy", [(100_000, 10_000), (50, 100)])
def test_quantiles_are_exact_however_little_may_be_read(spark, hot, monkeypatch, values, accuracy):
    monkeypatch.setattr(order_statistics, "MAX_VALUES", values)
    monkeypatch.setattr(order_statistics, "SMALL", 50)
    monkeypatch.setattr(order_statistics, "SKETCH_ACCURACY", accuracy)
    shares = [0, 0.1, 0.333, 0.5, 0.51, 0.9, 0.999, 1]
    found = order_statistics.quantiles(spark.createDataFrame(hot), ["x", "y"], shares)
    for c in ("x", "y"):
        np.testing.assert_allclose(found[c], hot[c].quantile(shares), rtol=1e-12)


def test_one_sketch_narrows_any_number_of_parts(spark, hot, monkeypatch):
    """Many ranks leave many parts of a column, which a row must not be compared with one by one."""
    asked, sketch = [], F.percentile_approx
    monkeypatch.setattr(F, "percentile_approx", lambda *args: asked.append(args) or sketch(*args))
    monkeypatch.setattr(order_statistics, "MAX_VALUES", 50)
    monkeypatch.setattr(order_statistics, "SMALL", 5)
    monkeypatch.setattr(order_statistics, "SKETCH_ACCURACY", 100)
    monkeypatch.setattr(order_statistics, "SPLITTERS", 20)
    pdf = hot.assign(z=hot["x"] % 97)
    shares = [(i - 0.5) / 99 for i in range(1, 100)]
    found = order_statistics.quantiles(spark.createDataFrame(pdf), ["x", "z"], shares)
    for c in ("x", "z"):
        np.testing.assert_allclose(found[c], pdf[c].quantile(shares), rtol=1e-12)
    assert 2 < len(asked) < 20


def test_quantiles_of_empty_and_tiny_columns(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (4.0, None)], "a double, b double")
    assert order_statistics.medians(df, ["a", "b"]) == {"a": 2.5, "b": None}
    assert order_statistics.medians(df, ["a"], approx=True) == {"a": 2.0}
    assert order_statistics.quantiles(df.limit(0), ["a"], [0.5]) == {"a": [None]}


def test_ranked_values(spark):
    df = spark.range(1000).select((F.col("id") % 10).cast("double").alias("x"))
    found = order_statistics.ranked_values(df, {"x": (F.col("x"), [0, 99, 100, 999, 1000])})
    assert found["x"] == {0: 0.0, 99: 0.0, 100: 1.0, 999: 9.0}


def test_mode_ignores_nulls_and_takes_the_lowest_on_a_tie(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (1, None), (2, None), (3, None), (None, None), (None, None)], "n int, s string")
    assert order_statistics.modes(df, ["n", "s"]) == {"n": 1, "s": "a"}


def test_corrected_moments_match_pandas(spark, hot):
    pdf = hot[["y"]].assign(z=hot["y"] ** 3)
    rows = {r["column"]: r for r in aggregates.skew_kurtosis(spark.createDataFrame(pdf), ["y", "z"]).collect()}
    for c in ("y", "z"):
        assert math.isclose(rows[c]["skewness"], pdf[c].skew(), rel_tol=1e-9)
        assert math.isclose(rows[c]["kurtosis"], pdf[c].kurt(), rel_tol=1e-9)


def test_few_rows_and_constant_columns_give_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "a double, b double")
    rows = {r["column"]: r for r in aggregates.skew_kurtosis(df, ["a", "b"]).collect()}
    assert rows["a"]["skewness"] is None and rows["a"]["kurtosis"] is None
    assert aggregates.correlations(df).first()["correlation"] is None


def test_correlations_are_pairwise_complete(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.normal(size=(200, 4)), columns=list("abcd"))
    pdf.loc[::5, "b"] = np.nan
    wanted = pdf.corr()
    rows = aggregates.correlations(spark.createDataFrame(pdf)).collect()
    assert len(rows) == 6
    for r in rows:
        assert math.isclose(r["correlation"], wanted.loc[r["f1"], r["f2"]], rel_tol=1e-9)


def test_hundred_columns_in_one_scan_like_sql(spark, tmp_path):
    import duckdb

    rng = np.random.default_rng(3)
    base = rng.normal(size=(3_000, 100)) + rng.normal(size=(3_000, 1))
    base[rng.random(base.shape) < 0.1] = np.nan
    base[:, 7] = 5.25  # constant
    base[:, 8] = base[:, 8] * 1e-2 + 1e6  # far from zero
    base[1:, 9] = np.nan  # one row
    base[:, 10] = np.where(np.isnan(base[:, 11]), base[:, 10], 3.0)  # constant only where 11 is there
    base[:, 12] = np.where(rng.random(3_000) < 0.001, 1e12, base[:, 12])
    pdf = pd.DataFrame(base, columns=[f"c{i}" for i in range(100)])
    path = str(tmp_path / "wide.parquet")
    pdf.to_parquet(path, row_group_size=500)
    df = spark.read.parquet(path).repartition(7)
    found = aggregates.correlations(df)
    assert found._jdf.queryExecution().executedPlan().toString().count("Scan parquet") == 1
    got = {(r["f1"], r["f2"]): r["correlation"] for r in found.collect()}
    assert len(got) == 4950
    pairs = [(7, 1), (9, 2), (10, 11), *[(i, j) for i in range(100) for j in range(i + 1, 100) if {i, j} & {0, 8, 12, 99}]]
    pairs = [(min(p), max(p)) for p in pairs]
    clean = "SELECT " + ", ".join(f"CASE WHEN isnan(c{i}) THEN NULL ELSE c{i} END AS c{i}" for i in range(100)) + f" FROM '{path}'"
    row = duckdb.sql("SELECT " + ", ".join(f"CASE WHEN count(c{i} + c{j}) > 1 THEN corr(c{i}, c{j}) END" for i, j in pairs) + f" FROM ({clean})").fetchall()[0]
    for (i, j), wanted in zip(pairs, row):
        value = got[f"c{i}", f"c{j}"]
        if wanted is None or math.isnan(wanted):
            assert value is None, (i, j, value)
        else:
            assert value == pytest.approx(wanted, rel=1e-6, abs=1e-8), (i, j)


def test_states_of_any_cut_merge_to_the_same(spark):
    rng = np.random.default_rng(4)
    values = rng.normal(size=(999, 5)) * [1, 1e3, 1e-3, 1, 1] + [0, 1e6, 5, -1e5, 0]
    values[rng.random(values.shape) < 0.3] = np.nan
    values[500, 4] = np.inf
    whole = comoments.batch_state(values)
    for cuts in ([1], [10, 11, 500], [333, 666], list(range(1, 999, 7))):
        total = None
        for part in np.split(values, cuts):
            state = comoments.batch_state(part)
            total = state if total is None else comoments.merged(total, state)
        for name in comoments.FIELDS:
            assert np.allclose(total[name], whole[name], rtol=1e-7, atol=1e-9), name


def test_a_thousand_quantiles_in_one_call(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"x": rng.normal(size=20_000).round(3), "y": np.where(rng.random(20_000) < 0.6, 1.0, rng.exponential(size=20_000)), "z": 4.0})
    shares = [i / 999 for i in range(1000)]
    found = order_statistics.quantiles(spark.createDataFrame(pdf).repartition(3), ["x", "y", "z"], shares)
    for c in pdf.columns:
        assert np.allclose(found[c], np.quantile(pdf[c], shares), rtol=0, atol=1e-12)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 7, 8, 200])
def test_place_among_splitters(spark, n):
    points = [float(2 * i) for i in range(n)]
    values = [-math.inf, *[i / 2 for i in range(-1, 4 * n + 2)], math.inf]
    rows = spark.createDataFrame([(c, x) for c in (0, 1) for x in values], "column int, x double")
    placed = order_statistics._place(rows, [points, [1.0, math.inf]]).collect()
    for r in placed:
        mine = points if r["column"] == 0 else [1.0, math.inf]
        assert r["cell"] == 2 * sum(p < r["x"] for p in mine) + (r["x"] in mine)


def test_null_counts_see_nan_and_text(spark):
    df = spark.createDataFrame([(1.0, "a", None), (float("nan"), None, None), (None, "?", None)], "x double, s string, n int")
    assert profile.null_counts(df).first().asDict() == {"x": 2, "s": 1, "n": 3}
    assert [r["column"] for r in profile.null_ranking(df).collect()] == ["n", "x", "s"]
    assert profile.null_profile(df.limit(0)).first()["percent"] is None


def test_column_names_with_dots(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (4.0, 8.5)], "`malic.acid` double, `color.int` double")
    assert aggregates.min_max(df, ["malic.acid"]).first().asDict() == {"column": "malic.acid", "min": 1.0, "max": 4.0}
    assert order_statistics.modes(df, ["color.int"]) == {"color.int": 2.0}
    assert order_statistics.medians(df, ["malic.acid", "color.int"]) == {"malic.acid": 2.0, "color.int": 4.0}
    assert aggregates.correlations(df).count() == 1


def test_histogram_counts_every_row_once(spark):
    df = spark.createDataFrame([(float(i % 11), 7.0) for i in range(110)] + [(None, 7.0)], "x double, k double")
    rows = eda.histogram(df, ["x", "k"], bins=5).collect()
    assert sum(r["n"] for r in rows if r["column"] == "x") == 110
    assert sum(r["n"] for r in rows if r["column"] == "k") == 111
    assert max(r["high"] for r in rows if r["column"] == "x") == 10.0
    assert len(rows) == 10


def test_suggestions_and_terms(spark):
    moments = spark.createDataFrame([("a", 1.5), ("b", -1.2), ("c", 0.9)], "column string, skewness double")
    assert {r["column"]: r["suggestion"] for r in eda.suggested_transformations(moments).collect()} == {
        "a": "Consider log transformation",
        "b": "Consider square root transformation",
    }
    pairs = spark.createDataFrame([("a", "b", -0.934), ("a", "c", 0.2)], "f1 string, f2 string, correlation double")
    assert [r["term"] for r in eda.interaction_terms(eda.strong_pairs(pairs)).collect()] == ["a * b (Correlation: 0.93)"]


def test_stratified_split_of_many_classes(spark):
    from pyspark.sql import functions as F

    from grainmill.operators.sample import stratified_split

    df = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 3 == 1, F.col("id") % 400).alias("c"))
    train, test = stratified_split(df, "c", 0.25, ["id"])
    sizes, taken = ({r["c"]: r["count"] for r in x.groupBy("c").count().collect()} for x in (df, test))
    assert taken == {c: round(0.25 * n) for c, n in sizes.items() if round(0.25 * n)} and len(sizes) > 130
    assert train.count() + test.count() == 6000 == train.unionAll(test).distinct().count()
