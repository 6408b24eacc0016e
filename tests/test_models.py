from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from grainmill.models import evaluate, feature_stages, neighbours, oversample, search, table_index
from grainmill.operators import sample
from grainmill.plans.comparison import compare_prepared


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(240, 2))
    pdf = pd.DataFrame({"id": range(240), "a": x[:, 0], "b": x[:, 1], "s": np.where(x[:, 0] > 0.5, "high", "low")})
    pdf["label"] = ((x[:, 0] + x[:, 1]) > 1.0).astype(int)
    return spark.createDataFrame(pdf).cache()


def test_split_parts_are_disjoint_and_whole(spark):
    df = spark.range(5000)
    parts = sample.split_rows(df, [0.8, 0.1, 0.1], ["id"])
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 5000 and parts[0].unionAll(parts[1]).unionAll(parts[2]).distinct().count() == 5000
    assert abs(sizes[0] - 4000) < 200
    again = sample.split_rows(df.repartition(11), [0.8, 0.1, 0.1], ["id"])
    assert again[1].exceptAll(parts[1]).count() == 0


def test_bernoulli_sample_does_not_depend_on_the_layout(spark):
    df = spark.range(20_000)
    drawn = sample.bernoulli_sample(df, 0.3, ["id"])
    assert abs(drawn.count() - 6000) < 400
    assert sample.bernoulli_sample(df.repartition(13), 0.3, ["id"]).exceptAll(drawn).count() == 0
    assert sample.bernoulli_sample(df, 0.0, ["id"]).count() == 0 and sample.bernoulli_sample(df, 1.0, ["id"]).count() == 20_000


@pytest.mark.parametrize("n", [0, 1, 777, 5000, 6000])
def test_sample_has_the_exact_size(spark, n):
    assert sample.sample_rows(spark.range(5000), n, ["id"]).distinct().count() == min(n, 5000)


def test_sample_of_repeated_keys_is_still_exact(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    assert sample.sample_rows(df, 500, ["k"]).distinct().count() == 500


def test_stratified_split_with_a_hot_class(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") < 2900, "hot").when(F.col("id") < 2990, "warm").alias("c"))
    train, test = sample.stratified_split(df, "c", 0.1, ["id"])
    assert {r[0]: r[1] for r in test.groupBy("c").count().collect()} == {"hot": 290, "warm": 9, None: 1}
    assert train.join(test, "id").count() == 0 and train.count() + test.count() == 3000


def test_stratified_split_of_repeated_keys_is_still_exact(spark):
    df = spark.range(900).select((F.col("id") % 4).alias("k"), (F.col("id") % 3).alias("c"), "id")
    train, test = sample.stratified_split(df, "c", 0.3, ["k"])
    assert {r[0]: r[1] for r in test.groupBy("c").count().collect()} == {0: 90, 1: 90, 2: 90}
    none, every = (sample.stratified_split(df, "c", share, ["id"])[1].count() for share in (0.0, 1.0))
    assert (none, every) == (0, 900)
    assert train.unionAll(test).distinct().count() == 900
    assert sample.stratified_split(df.limit(0), "c", 0.3, ["id"])[0].count() == 0


def test_parts_of_a_stratified_split_are_one_scan_without_a_shuffle(spark):
    df = spark.range(3000).select("id", (F.col("id") % 3).alias("c"))
    for part in sample.stratified_split(df, "c", 0.1, ["id"]):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Range (") == 1 and "hashpartitioning" not in plan and "Window" not in plan


@pytest.mark.parametrize("options,least", [({}, 1.0), ({"leaf": 60, "trees": 6}, 0.95)])
def test_neighbours_within_the_leaves_of_trees(spark, options, least):
    """One leaf is exact; several trees of smaller leaves find nearly all of the five nearest."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3))
    x[:100] *= 0.01
    df = spark.createDataFrame([("a", p.tolist(), 1) for p in x], "kind string, vec array<double>, copies bigint").cache()
    got = {tuple(r["vec"]): [n["distance"] for n in r["near"]] for r in neighbours.nearest_distinct(df, 5, **options).collect()}
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    far.sort(1)
    assert len(got) == 300
    hits = [np.isclose(d, true[1:6], rtol=1e-12).all() if least == 1.0 else np.mean([np.isclose(d, t).any() for t in true[1:6]]) for d, true in ((got[tuple(p)], f) for p, f in zip(x, far))]
    assert np.mean(hits) >= least


def test_each_vector_goes_to_one_leaf_of_each_tree(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select(F.lit("k").alias("kind"), F.col("embedding").cast("array<double>").alias("vec"), F.lit(1).cast("bigint").alias("copies"))
    assert {r["count"] for r in neighbours.planted(df, 5, leaf=10).groupBy("vec").count().collect()} == {5}
    assert {r["count"] for r in neighbours.planted(df, 5).groupBy("vec").count().collect()} == {1}


def test_classes_of_every_size_keep_to_themselves(spark):
    """Many small classes beside one beyond a leaf: exact in the small ones, and never a vector of another class."""
    rng = np.random.default_rng(1)
    rows = [(f"k{c}", p.tolist(), 1) for c in range(80) for p in rng.normal(size=(int(rng.integers(1, 30)), 3))]
    rows += [("big", p.tolist(), 1) for p in rng.normal(size=(400, 3))]
    df = spark.createDataFrame(rows, "kind string, vec array<double>, copies bigint").cache()
    points = {}
    for kind, vec, _ in rows:
        points.setdefault(kind, []).append(vec)
    got = neighbours.nearest_distinct(df, 5, leaf=60).collect()
    assert len(got) == len(rows)
    for r in got:
        mine = np.array(points[r["kind"]])
        assert all(n["vec"] in points[r["kind"]] for n in r["near"])
        if r["kind"] != "big":
            far = np.sort(np.sqrt(((mine - np.array(r["vec"])) ** 2).sum(1)))[1:6]
            assert np.allclose([n["distance"] for n in r["near"]], far)


def test_smote_of_a_thousand_classes_is_one_plan(spark):
    def plan(n):
        df = spark.range(n * 12).select("id", (F.col("id") % n).alias("y"), F.rand(3).alias("a"), F.rand(4).alias("b"))
        df = df.unionAll(spark.range(40).select((F.col("id") + 10**6).alias("id"), F.lit(None).cast("bigint").alias("y"), F.rand(5).alias("a"), F.rand(6).alias("b")))
        return oversample.smote(df, "y", ["a", "b"], ["id"])

    few, many = plan(3), plan(1000)
    lengths = [len(d._jdf.queryExecution().optimizedPlan().toString().splitlines()) for d in (few, many)]
    assert lengths[0] == lengths[1]
    counts = many.groupBy("y").agg(F.count("*").alias("n"), F.count_if("synthetic").alias("new")).collect()
    assert len(counts) == 1001 and {r["n"] for r in counts} == {40} and {r["new"] for r in counts if r["y"] is not None} == {28}


def test_smote_balances_on_segments(spark, points):
    grown = oversample.smote(points, "label", ["a", "b"], ["id"]).toPandas()
    counts = grown["label"].value_counts()
    assert counts[0] == counts[1]
    minority = grown[(grown["label"] == 1) & ~grown["synthetic"]][["a", "b"]].to_numpy()
    for p in grown[grown["synthetic"]][["a", "b"]].to_numpy()[:25]:
        d = minority[None, :, :] - minority[:, None, :]
        t = ((p - minority[:, None, :]) * d).sum(-1) / np.maximum((d**2).sum(-1), 1e-300)
        off = np.abs(minority[:, None, :] + np.clip(t, 0, 1)[..., None] * d - p).max(-1)
        assert off.min() < 1e-9


def test_smote_of_identical_rows_copies_them(spark):
    df = spark.createDataFrame([(i, 1.0, 0) for i in range(30)] + [(100 + i, 5.0, 1) for i in range(8)], "id int, x double, y int")
    new = oversample.smote(df, "y", ["x"], ["id"]).filter("synthetic")
    assert new.count() == 22 and new.filter("x = 5.0").count() == 22
    with pytest.raises(ValueError):
        oversample.smote(df.filter("id < 104"), "y", ["x"], ["id"])


def test_stages_persist_and_impute_inside_the_fit(spark, points, tmp_path):
    stages = search.pipeline(*feature_stages.preparation_stages(["a", "b"], ["s"]), search.decision_tree("label"))
    gaps = points.withColumns({"a": F.when(F.col("id") % 5 != 0, F.col("a")), "s": F.when(F.col("id") % 7 != 0, F.col("s"))})
    model = stages.fit(gaps)
    scored = search.score(model, gaps)
    assert scored.filter("ImputedIndexs = 0").count() >= scored.filter("s = 'low' or s is null").count()
    assert "Imputeda_Imputedb" in scored.columns
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(gaps)
    assert [r[0] for r in again.orderBy("id").select("prediction").collect()] == [r[0] for r in scored.orderBy("id").select("prediction").collect()]


@pytest.mark.parametrize("rows", [table_index.BROADCAST_ROWS, 50])
def test_index_table_like_a_count_by_value(spark, tmp_path, monkeypatch, rows):
    """A third of the values distinct, a hot value, nulls, unseen values; beyond the broadcast limit too."""
    monkeypatch.setattr(table_index, "BROADCAST_ROWS", rows)
    monkeypatch.setattr(table_index.frequency_table, "__defaults__", (rows,))
    rng = np.random.default_rng(8)
    texts = [None if i % 17 == 0 else "hot" if i % 3 == 1 else f"é{rng.integers(0, 700)}" for i in range(3000)]
    pdf = pd.DataFrame({"id": range(3000), "t": texts, "n": rng.integers(0, 3, 3000)})
    train = spark.createDataFrame(pdf).repartition(5)
    test = train.unionAll(spark.createDataFrame([(9000, "never", 77), (9001, None, 1)], "id long, t string, n long"))
    for unknown in (table_index.EXTRA, table_index.MODE):
        model = table_index.FrequencyIndexer(inputCols=["t", "n"], outputCols=["ti", "ni"], unknown=unknown).fit(train)
        model.write().overwrite().save(str(tmp_path / unknown))
        again = table_index.FrequencyIndexerModel.load(str(tmp_path / unknown))
        for fitted in (model, again):
            got = fitted.transform(test)
            assert got.columns == ["id", "t", "n", "ti", "ni"]
            found = {r["id"]: (r["ti"], r["ni"]) for r in got.collect()}
            assert len(found) == 3002
            for at, (name, values) in enumerate((("t", texts), ("n", [str(v) for v in pdf["n"]]))):
                counts = Counter(v for v in values if v is not None)
                codes = {v: float(i) for i, (v, _) in enumerate(sorted(counts.items(), key=lambda c: (-c[1], c[0].encode())))}
                other = float(len(codes)) if unknown == table_index.EXTRA else 0.0
                assert all(found[i][at] == codes.get(v, other) for i, v in enumerate(values))
                assert found[9000][at] == other
    assert got.schema["ti"].metadata == {}
    if rows == 50:  # rows that are done are dealt over parts by a second key
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "_spread" in plan and "(_spread#" in next(x for x in plan.splitlines() if "Join LeftOuter" in x and "_text" in x)


def test_index_of_no_rows(spark):
    empty = spark.createDataFrame([], "t string")
    model = table_index.FrequencyIndexer(inputCols=["t"], outputCols=["i"]).fit(empty)
    assert [tuple(r) for r in model.transform(spark.createDataFrame([("a",), (None,)], "t string")).collect()] == [("a", 0.0), (None, 0.0)]


def test_min_max_uses_the_training_range(spark):
    train = spark.createDataFrame([(0.0, 5.0), (10.0, 5.0)], "x double, k double")
    test = spark.createDataFrame([(20.0, 6.0)], "x double, k double")
    table = feature_stages.min_max_table(train, ["x", "k"])
    assert {r["name"]: r["scale"] for r in table.collect()} == {"x": 0.1, "k": 1.0}
    assert tuple(feature_stages.apply_min_max(test, table).first()) == (2.0, 1.0)


def test_report_of_a_known_confusion(spark):
    counts = spark.createDataFrame([(0.0, 0.0, 30), (0.0, 1.0, 10), (1.0, 0.0, 5), (1.0, 1.0, 55)], "label double, prediction double, n bigint")
    rows = {r["class"]: r for r in evaluate.classification_report(counts).collect()}
    assert rows["0.0"]["precision"] == pytest.approx(30 / 35) and rows["0.0"]["recall"] == 0.75 and rows["0.0"]["support"] == 40
    assert rows["accuracy"]["f1"] == 0.85 and rows["macro avg"]["recall"] == pytest.approx((0.75 + 55 / 60) / 2)
    assert rows["weighted avg"]["support"] == 100
    metrics = {r["metric"]: r["value"] for r in evaluate.metrics_report(counts, "m", {"depth": 3}, 0.9).collect()}
    assert metrics["accuracy"] == 0.85 and metrics["confusion[0.0,1.0]"] == 10.0 and metrics["best_cv_score"] == 0.9


def test_search_finds_the_better_grid_point(spark, points):
    classifier = search.decision_tree("label")
    stages = search.pipeline(feature_stages.assembler(["a", "b"]), classifier)
    train, test = sample.split_rows(points, [0.8, 0.2], ["id"])
    found = search.train_and_evaluate("tree", stages, search.grid(depth=(classifier.maxDepth, [0, 4])), train, test, "label", ["id"], folds=2)
    assert found.best_params == {"maxDepth": 4} and found.best_score == max(found.scores)
    assert sum(r["n"] for r in found.counts.collect()) == test.count()


class CountedScaler(StandardScaler):
    fits = []

    def _fit(self, dataset):
        CountedScaler.fits.append(self.uid)
        return super()._fit(dataset)


def test_stages_before_the_grid_are_fitted_once_a_fold(spark, points):
    classifier = search.logistic_regression("label", max_iter=20)
    stages = search.pipeline(feature_stages.assembler(["a", "b"], "raw_features"), CountedScaler(inputCol="raw_features", outputCol="features"), classifier)
    grid = search.grid(reg=(classifier.regParam, [0.001, 0.1, 10.0]), net=(classifier.elasticNetParam, [0.0, 1.0]))
    CountedScaler.fits.clear()
    found = search.k_fold_search(stages, grid, points, "label", ["id"], folds=3, parallelism=3)
    assert len(CountedScaler.fits) == 4  # three folds and the whole table, not one for each of six points
    folded = sample.with_fold(points, 3, ["id"])
    plain = CrossValidator(estimator=stages, estimatorParamMaps=grid, evaluator=MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy"), numFolds=3, foldCol="fold").fit(folded)
    assert found.scores == pytest.approx(plain.avgMetrics, abs=1e-12)
    assert [s.uid for s in found.model.stages] == [s.uid for s in plain.bestModel.stages]
    both = [[r[0] for r in m.transform(points).orderBy("id").select("prediction").collect()] for m in (found.model, plain.bestModel)]
    assert both[0] == both[1]


def test_many_training_rows_are_dealt_evenly(spark, points, monkeypatch):
    """Rows that lie in one part of four, with copies and a missing key, all reach the fits in parts of one size."""
    monkeypatch.setattr(search, "DEALT_FROM", 400)
    monkeypatch.setattr(search, "PART_ROWS", 40)
    rows = points.unionAll(points).select(F.when(F.col("id") > 0, F.col("id")).alias("id"), "a", "b", "label").coalesce(1)
    skewed = rows.unionAll(spark.createDataFrame(rows.limit(0).rdd, rows.schema))
    seen, needed = [], search._needed
    monkeypatch.setattr(search, "_needed", lambda df, *args: seen.append(df) or needed(df, *args))
    stages = search.pipeline(feature_stages.assembler(["a", "b"]), search.decision_tree("label", maxDepth=2))
    found = search.k_fold_search(stages, [{}], skewed, "label", ["id"], folds=2)
    assert len(seen) == 3 and found.scores[0] > 0.7
    for df in seen:
        sizes = [len(part) for part in df.select("a").rdd.glom().collect()]
        assert len(sizes) == 16 and sum(sizes) == 480 and max(sizes) - min(sizes) <= 4
    monkeypatch.setattr(search, "DEALT_FROM", 481)
    assert search.evenly(skewed) is skewed


def test_search_over_a_prepared_stage_and_a_single_classifier(spark, points):
    scaler, classifier = feature_stages.scaler(), search.decision_tree("label", maxDepth=2)
    stages = search.pipeline(feature_stages.assembler(["a", "b"], "raw_features"), scaler, classifier)
    shared, rest = search.shared_stages(stages, search.grid(mean=(scaler.withMean, [True, False])))
    assert len(shared) == 1 and rest == [scaler, classifier]
    assert len(search.k_fold_search(stages, search.grid(mean=(scaler.withMean, [True, False])), points, "label", ["id"], folds=2).scores) == 2
    assert search.shared_stages(stages, [{}]) == (stages.getStages()[:2], [classifier])
    vectors = feature_stages.assembler(["a", "b"]).transform(points)
    assert search.k_fold_search(classifier, search.grid(depth=(classifier.maxDepth, [1, 3])), vectors, "label", ["id"], folds=2).best_params == {"maxDepth": 3}


def test_comparison_flow_keeps_the_winner(spark, tmp_path):
    rows = [(i, float(i % 2), float(i % 3) if i % 7 else None, None if i % 10 == 9 else i % 2) for i in range(300)]
    spark.createDataFrame(rows, "id int, a double, b double, y int").write.saveAsTable("flow_raw")

    def tree(names):
        classifier = search.decision_tree("y", maxDepth=2)
        return search.pipeline(feature_stages.assembler(names), classifier), [{}]

    def flat(names):
        classifier = search.decision_tree("y", maxDepth=0)
        return search.pipeline(feature_stages.assembler(names), classifier), [{}]

    sets = [search.FeatureSet("sum", {"a_and_b": F.col("a") + F.col("b")})]
    path = str(tmp_path / "model")
    tables = compare_prepared(spark, "flow_raw", "flow", "y", ["a", "b"], ["id"], {"tree": tree, "flat": flat}, sets, test_share=0.2, stratify=True, model_path=path, folds=2)
    prepared = spark.table(tables["prepared"])
    labels = {0: 150, 1: 120}  # rows without a label are the odd ones that end in 9
    assert {(r["part"], r["y"]): r["count"] for r in prepared.groupBy("part", "y").count().collect()} == {
        (part, y): (round(n * 0.2) if part == "test" else n - round(n * 0.2)) for y, n in labels.items() for part in ("train", "test")
    }
    assert prepared.filter("b IS NULL").count() == 0 and spark.table(tables["pairs"]).count() == 1
    assert {r["model"]: (r["feature_set"], r["wins"]) for r in spark.table(tables["best"]).collect()} == {"tree": ("sum", True), "flat": ("sum", False)}
    assert {r["model"]: r["accuracy"] for r in spark.table(tables["results"]).collect()}["tree"] == 1.0
    test = sets[0].apply(prepared.filter("part = 'test'"))
    assert PipelineModel.load(path).transform(test).filter("prediction <> y").count() == 0
    with pytest.raises(ValueError, match="stratified"):
        compare_prepared(spark, "flow_raw", "flow", "y", ["a"], ["id"], {}, [], share=F.lit(0.5), stratify=True)


def test_choice_rules(spark):
    def choose(p, a, b):
        results = spark.createDataFrame([("production", p), ("max", a), ("product", b)], "model string, accuracy double")
        return search.choose_challenger(results, "production", "max", "product", 0.01).first()[0]

    assert choose(0.9, 0.8, 0.85) == "production"
    assert choose(0.9, 0.895, 0.85) == "max"
    assert choose(0.8, 0.85, 0.85) == "product"
    results = evaluate.results_table(points_of(spark), [("b", "x", 0.9), ("a", "y", 0.9), ("a", "x", 0.1)])
    assert tuple(search.best_result(results).first()) == ("a", "y", 0.9)
    assert {r["model"]: r["feature_set"] for r in search.best_per_model(results).collect()} == {"a": "y", "b": "x"}


def points_of(spark):
    return spark.range(1)


def test_noise_is_normal_and_repeatable(spark):
    noisy = search.perturbed(spark.range(4000).withColumn("x", F.lit(0.0)), ["x"], ["id"], 2, 1.2)
    row = noisy.filter("round > 0").agg(F.avg("x"), F.stddev("x")).first()
    assert abs(row[0]) < 0.06 and abs(row[1] - 1.2) < 0.06
    assert noisy.filter("round = 0 and x <> 0").count() == 0
    again = search.perturbed(spark.range(4000).repartition(5).withColumn("x", F.lit(0.0)), ["x"], ["id"], 2, 1.2)
    assert again.exceptAll(noisy).count() == 0
