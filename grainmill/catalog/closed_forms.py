"""Models whose results SQL can compute: one feature with few values, so a split or a probability has a closed form (L)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from grainmill.catalog.frames import gapped
from grainmill.catalog.registry import query, table
from grainmill.catalog.storing import unique
from grainmill.models import feature_stages, search
from grainmill.operators.sample import split_rows
from grainmill.plans.challenge import challenge
from grainmill.plans.comparison import compare_prepared
from grainmill.plans.preparation import prepare
from grainmill.session import scratch_path
from grainmill.sources import writers

KEY = ["p_partkey"]
LABEL = "CASE WHEN p_size % 10 * 7 + p_partkey % 20 > 40 THEN 1 ELSE 0 END"
POINTS_SQL = f"points AS (SELECT p_partkey, p_size % 10 AS x, {LABEL} AS y, p_partkey % 5 AS fold FROM part)"

#: The split `x <= t` of least Gini impurity for each set of training rows `trained(part, x, y)`, and both sides' majorities.
SPLIT_SQL = """cuts AS (SELECT part, t, count(*) AS n, sum(y) AS ones, (x <= t) AS low
      FROM trained, (SELECT unnest(range(9)) AS t) GROUP BY part, t, low),
    splits AS (SELECT part, t, sum(n - ones * ones / n - (n - ones) * (n - ones) / n) AS impurity,
      max(CASE WHEN low THEN CAST(ones * 2 > n AS INTEGER) END) AS below, max(CASE WHEN NOT low THEN CAST(ones * 2 > n AS INTEGER) END) AS above
      FROM cuts GROUP BY part, t HAVING count(*) = 2),
    best AS (SELECT * FROM splits QUALIFY row_number() OVER (PARTITION BY part ORDER BY round(impurity, 6), t) = 1)"""
ONE_SQL = f"WITH {POINTS_SQL}, trained AS (SELECT 0 AS part, x, y FROM points WHERE fold <> 4), {SPLIT_SQL}, guessed AS (SELECT p_partkey, y, CASE WHEN x <= t THEN below ELSE above END AS guess FROM points, best WHERE fold = 4)"
GUESS_SQL = f"{ONE_SQL} SELECT p_partkey, y, CAST(guess AS DOUBLE) AS prediction FROM guessed"
FOLDS_SQL = f"""WITH {POINTS_SQL}, rest AS (SELECT * FROM points WHERE fold <> 4), folds AS (SELECT unnest(range(4)) AS part),
    trained AS (SELECT part, x, y FROM rest, folds WHERE fold <> part), {SPLIT_SQL},
    most AS (SELECT part, CAST(avg(y) > 0.5 AS INTEGER) AS guess FROM trained GROUP BY part),
    flat AS (SELECT part, avg(CAST(y = guess AS INTEGER)) AS a FROM rest JOIN most ON fold = part GROUP BY part),
    cut AS (SELECT part, avg(CAST(y = CASE WHEN x <= t THEN below ELSE above END AS INTEGER)) AS a FROM rest JOIN best ON fold = part GROUP BY part),
    scores AS (SELECT 0 AS point, '0' AS depth, round(avg(a), 6) AS score FROM flat UNION ALL SELECT 1, '1', round(avg(a), 6) FROM cut)"""


def points(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", (F.col("p_size") % 10).cast("double").alias("x"), F.expr(LABEL).alias("y"), (F.col("p_partkey") % 5).cast("int").alias("fold")
    )


def halves(spark, folder):
    return split_rows(points(spark, folder), [0.8, 0.2], KEY, share=F.col("fold") / F.lit(5.0))


def guessed(spark, folder, classifier):
    train, test = halves(spark, folder)
    model = search.pipeline(feature_stages.assembler(["x"]), classifier).fit(train)
    return search.score(model, test).select("p_partkey", "y", "prediction")


@query("L7_shares", "WITH d AS (SELECT CAST(lang = 'en' AS INTEGER) AS en, quality FROM documents JOIN labels USING (doc_id)) SELECT en, round(avg(quality), 4) AS share FROM d GROUP BY en")
def probabilities_are_shares(spark, folder):
    """A logistic regression without penalty on one 0/1 feature gives each value's share of label 1."""
    docs = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id").select((F.col("lang") == "en").cast("int").alias("en"), "quality")
    stages = search.pipeline(feature_stages.assembler(["en"]), search.logistic_regression("quality", max_iter=200, tol=1e-12))
    scored = search.score(stages.fit(docs), docs)
    return scored.groupBy("en").agg(F.round(F.avg(vector_to_array("probability")[1]), 4).alias("share"))


@query(
    "L7_classes",
    """WITH g AS (SELECT vec_id % 2 AS odd, label FROM embeddings), n AS (SELECT odd, count(*) AS n FROM g GROUP BY odd)
    SELECT odd, label, round(count(g.label) / any_value(n), 3) AS share FROM n CROSS JOIN (SELECT DISTINCT label FROM g) LEFT JOIN g USING (odd, label) GROUP BY odd, label""",
)
def class_probabilities_are_shares(spark, folder):
    """The same with all classes of the embeddings: each group's share of each class."""
    odd = (F.col("vec_id") % 2).alias("odd")
    df = table(spark, folder, "embeddings").select("vec_id", odd, "label")
    stages = search.pipeline(feature_stages.assembler(["odd"]), search.logistic_regression("label", max_iter=300, tol=1e-12))
    scored = search.score(stages.fit(df), df).select("odd", F.posexplode(vector_to_array("probability")).alias("class", "share"))
    shares = scored.groupBy("odd", "class").agg(F.round(F.avg("share"), 3).alias("share"))
    labels = df.select("label").distinct()
    return shares.join(labels, F.col("class") == F.col("label")).select("odd", "label", "share")


@query(
    "L11_tree",
    """WITH d AS (SELECT doc_id, CASE WHEN (coalesce(lang, '') = 'en') = (doc_id % 4 <> 0) THEN 1 ELSE 0 END AS y, CASE WHEN doc_id % 9 <> 2 THEN lang || '/' || (doc_id % 3) END AS place, CASE WHEN doc_id % 6 <> 1 THEN n_chars % 8 END AS x
      FROM documents),
    train AS (SELECT * FROM d WHERE doc_id % 5 <> 4), mean AS (SELECT avg(x) AS m FROM train),
    codes AS (SELECT place, row_number() OVER (ORDER BY count(*) DESC, place) - 1 AS code FROM train WHERE place IS NOT NULL GROUP BY place),
    f AS (SELECT doc_id, y, unnest([0, 1]) AS feature, unnest([coalesce(x, m), coalesce(code, 0)::DOUBLE]) AS v FROM d CROSS JOIN mean LEFT JOIN codes USING (place)),
    seen AS (SELECT * FROM f WHERE doc_id % 5 <> 4),
    counts AS (SELECT feature, v, count(*) AS n, sum(y)::BIGINT AS ones FROM seen GROUP BY feature, v),
    cuts AS (SELECT c.feature, t.v AS t, c.v <= t.v AS low, sum(n)::DOUBLE AS n, sum(ones)::DOUBLE AS ones FROM counts AS c JOIN (SELECT feature, v FROM counts) AS t USING (feature) GROUP BY ALL),
    splits AS (SELECT feature, t, sum(n - ones * ones / n - (n - ones) * (n - ones) / n) AS impurity,
      max(CASE WHEN low THEN (ones * 2 > n)::INTEGER END) AS below, max(CASE WHEN NOT low THEN (ones * 2 > n)::INTEGER END) AS above FROM cuts GROUP BY feature, t HAVING count(*) = 2),
    best AS (SELECT * FROM splits ORDER BY round(impurity, 6), feature, t LIMIT 1)
    SELECT doc_id, y, (CASE WHEN v <= t THEN below ELSE above END)::DOUBLE AS prediction FROM f JOIN best USING (feature) WHERE doc_id % 5 = 4""",
)
def prepared_split(spark, folder):
    """Text indexed and imputed, a number imputed, and the best split of both: one pipeline, fitted on the training rows."""
    docs = table(spark, folder, "documents")
    label = ((F.coalesce("lang", F.lit("")) == "en") == (F.col("doc_id") % 4 != 0)).cast("int")
    place = F.when(F.col("doc_id") % 9 != 2, F.concat("lang", F.lit("/"), (F.col("doc_id") % 3).cast("string")))
    number = F.when(F.col("doc_id") % 6 != 1, (F.col("n_chars") % 8).cast("double"))
    docs = docs.select("doc_id", label.alias("y"), place.alias("place"), number.alias("x"))
    train, test = split_rows(docs, [0.8, 0.2], ["doc_id"], share=F.pmod("doc_id", F.lit(5)) / F.lit(5.0))
    stages = search.pipeline(*feature_stages.preparation_stages(["x"], ["place"]), search.decision_tree("y", maxDepth=1, maxBins=64))
    return search.score(stages.fit(train), test).select("doc_id", "y", "prediction")


@query("L24", "WITH d AS (SELECT doc_id, lang, quality FROM documents JOIN labels USING (doc_id)) SELECT doc_id, round(avg(quality) OVER (PARTITION BY lang = 'en'), 4) AS share FROM d")
def scored(spark, folder):
    """Every labelled document once, with the probability that its language group's share gives."""
    docs = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id").select("doc_id", (F.col("lang") == "en").cast("int").alias("en"), "quality")
    model = search.pipeline(feature_stages.assembler(["en"]), search.logistic_regression("quality", max_iter=200, tol=1e-12)).fit(docs)
    return search.score(model, docs).select("doc_id", F.round(vector_to_array("probability")[1], 4).alias("share"))


@query("L9_split", GUESS_SQL)
def best_split(spark, folder):
    """A tree of depth one takes the split of least Gini impurity."""
    return guessed(spark, folder, search.decision_tree("y", maxDepth=1))


@query("L8_split", GUESS_SQL)
def forest_of_one(spark, folder):
    """One tree on all rows and features is that tree."""
    return guessed(spark, folder, search.random_forest("y", numTrees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all"))


@query("L10_split", GUESS_SQL)
def one_round(spark, folder):
    """The first round of boosting cuts where the variance, and so the impurity, is least."""
    return guessed(spark, folder, search.boosted_trees("y", maxIter=1, maxDepth=1))


@query("K7", GUESS_SQL)
def model_sink(spark, folder):
    """Predictions of a model that was saved and loaded again."""
    train, test = halves(spark, folder)
    path = scratch_path(spark, "k7")
    writers.save_model(search.pipeline(feature_stages.assembler(["x"]), search.decision_tree("y", maxDepth=1)).fit(train), path)
    return PipelineModel.load(path).transform(test).select("p_partkey", "y", "prediction")


def searched(spark, folder):
    """Depth 0 against depth 1, with folds that SQL knows."""
    train, test = halves(spark, folder)
    classifier = search.decision_tree("y")
    stages = search.pipeline(feature_stages.assembler(["x"]), classifier)
    points_ = search.grid(depth=(classifier.maxDepth, [0, 1]))
    return search.train_and_evaluate("Decision Tree", stages, points_, train, test, "y", KEY, folds=4, fold="fold", parallelism=2), train


@query("L13", f"{FOLDS_SQL} SELECT CAST(point AS INTEGER) AS point, depth, score FROM scores")
def k_fold(spark, folder):
    found, train = searched(spark, folder)
    return search.scores_table(train, found).select("point", F.col("params")["maxDepth"].alias("depth"), F.round("score", 6).alias("score"))


@query("L19", f"{FOLDS_SQL} SELECT depth, score FROM scores ORDER BY score DESC, point LIMIT 1")
def best_parameters(spark, folder):
    found, _ = searched(spark, folder)
    return spark.createDataFrame([(str(found.best_params["maxDepth"]), round(found.best_score, 6))], "depth string, score double")


@query(
    "L18",
    f"""{ONE_SQL} SELECT 'accuracy' AS metric, round(avg(CAST(y = guess AS INTEGER)), 6) AS value FROM guessed
    UNION ALL SELECT 'confusion[' || y || '.0,' || guess || '.0]', CAST(count(*) AS DOUBLE) FROM guessed GROUP BY y, guess""",
)
def trained_and_evaluated(spark, folder):
    """The best model's accuracy and confusion on the test rows."""
    report = searched(spark, folder)[0].report
    return report.filter("metric = 'accuracy' OR metric LIKE 'confusion%'").select("metric", F.round("value", 6).alias("value"))


@query(
    "L20_split",
    f"""{ONE_SQL} SELECT model, feature_set, round(avg(CAST(y = guess AS INTEGER)), 6) AS accuracy
    FROM guessed, (VALUES ('tree'), ('forest'), ('rounds')) AS m(model), (VALUES ('mirrored'), ('squared')) AS f(feature_set) GROUP BY model, feature_set""",
)
def comparison_of_splits(spark, folder):
    """Columns that order the rows like `x` leave the best split as it is, for three kinds of model."""

    def built(make):
        def build(names):
            classifier = make()
            return search.pipeline(feature_stages.assembler(names), classifier), search.grid(depth=(classifier.maxDepth, [1]))

        return build

    models = {
        "tree": built(lambda: search.decision_tree("y")),
        "forest": built(lambda: search.random_forest("y", numTrees=1, bootstrap=False, featureSubsetStrategy="all")),
        "rounds": built(lambda: search.boosted_trees("y", maxIter=1)),
    }
    sets = [search.FeatureSet("mirrored", {"m": 9 - F.col("x")}), search.FeatureSet("squared", {"s": F.col("x") * F.col("x")})]
    train, test = halves(spark, folder)
    results = search.compare(models, sets, train, test, "y", KEY, ["x"], folds=4, fold="fold", parallelism=2)
    return results.withColumn("accuracy", F.round("accuracy", 6))


@query("L23_still", f"{ONE_SQL}, a AS (SELECT round(avg(CAST(y = guess AS INTEGER)), 6) AS a FROM guessed) SELECT a AS accuracy, CAST(5 AS BIGINT) AS rounds, a AS mean_accuracy, a AS low, a AS high FROM a")
def no_noise(spark, folder):
    """Without noise every round has the accuracy of the test rows."""
    train, test = halves(spark, folder)
    model = search.pipeline(feature_stages.assembler(["x"]), search.decision_tree("y", maxDepth=1)).fit(train)
    found = search.robustness(model, test, ["x"], "y", KEY, rounds=5, std=0.0)
    return found.withColumns({c: F.round(c, 6) for c in ("accuracy", "mean_accuracy", "low", "high")})


@query(
    "K10_models",
    f"""WITH {POINTS_SQL}, s AS (SELECT avg(x) AS m, stddev_samp(x) AS d FROM points), kept AS (SELECT points.* FROM points, s WHERE abs(x - m) / d - 3 < 0.01),
    trained AS (SELECT 0 AS part, x, y FROM kept WHERE fold <> 4), {SPLIT_SQL},
    a AS (SELECT avg(CAST(y = CASE WHEN x <= t THEN below ELSE above END AS INTEGER)) AS a FROM kept, best WHERE fold = 4)
    SELECT model, round(a, 6) AS accuracy, 'product' AS choice FROM a, (VALUES ('production'), ('max'), ('product')) AS m(model)""",
)
def challenged(spark, folder):
    """The whole flow through tables. The second column is twice the first, so all three models cut alike and the last wins the tie."""
    raw = unique("k10_models")
    points(spark, folder).withColumn("w", F.col("x") * 2.0).write.saveAsTable(raw)
    tables = challenge(
        spark, raw, raw, "y", ["x", "w"], ["p_partkey", "fold"],
        lambda names: search.pipeline(feature_stages.assembler(names), search.decision_tree("y", maxDepth=1)), share=F.col("fold") / F.lit(5.0), rounds=3,
    )
    found = spark.table(tables["results"]).crossJoin(F.broadcast(spark.table(tables["choice"])))  # one row
    return found.select("model", F.round("accuracy", 6).alias("accuracy"), "choice")


@query(
    "prepared",
    """WITH base AS (SELECT CASE WHEN l_linenumber <> 3 THEN l_quantity END AS q, CASE WHEN l_linenumber <> 5 THEN l_extendedprice END AS p, l_discount AS d FROM lineitem),
    m AS (SELECT median(q) AS mq, median(p) AS mp, median(d) AS md FROM base),
    f AS (SELECT coalesce(q, mq) AS q, coalesce(p, mp) AS p, coalesce(d, md) AS d FROM base, m),
    b AS (SELECT quantile_cont(q, 0.25) AS q1, quantile_cont(q, 0.75) AS q3, quantile_cont(p, 0.25) AS p1, quantile_cont(p, 0.75) AS p3, quantile_cont(d, 0.25) AS d1, quantile_cont(d, 0.75) AS d3 FROM f),
    c AS (SELECT greatest(least(q, q3 + 1.5 * (q3 - q1)), q1 - 1.5 * (q3 - q1)) AS q, greatest(least(p, p3 + 1.5 * (p3 - p1)), p1 - 1.5 * (p3 - p1)) AS p,
      greatest(least(d, d3 + 1.5 * (d3 - d1)), d1 - 1.5 * (d3 - d1)) AS d FROM f, b)
    SELECT 'quantity' AS feature1, 'price' AS feature2, round(corr(q, p), 6) AS correlation FROM c
    UNION ALL SELECT 'quantity', 'discount', round(corr(q, d), 6) FROM c UNION ALL SELECT 'price', 'discount', round(corr(p, d), 6) FROM c""",
)
def prepared(spark, folder):
    """Gaps filled, outliers clamped, the most correlated pairs."""
    _, pairs = prepare(gapped(spark, folder).select("quantity", "price", "discount"), n=3)
    return pairs.select("feature1", "feature2", F.round("correlation", 6).alias("correlation"))


# Models at full size on cells whose majority is clear: a row's label is the rule's, but for a tenth of the rows, so
# any sound model says of a cell what most of its training rows say.
CELLS_SQL = """base AS (
      SELECT o_orderkey, o_orderkey % 5 AS fold, CASE WHEN o_orderkey % 11 <> 0 THEN CASE WHEN o_orderkey % 13 = 0 THEN 1000.0 ELSE day(o_orderdate) % 2 END END AS x, o_custkey % 2 AS w,
        CASE WHEN (day(o_orderdate) % 2 = 1 OR o_custkey % 2 = 1 OR (o_orderkey % 11 <> 0 AND o_orderkey % 13 = 0)) = (o_orderkey * 3 // 7 % 10 <> 0) THEN 1 ELSE 0 END AS y FROM orders),
    mids AS (SELECT median(x) AS m FROM base), filled AS (SELECT base.* REPLACE (coalesce(x, m) AS x) FROM base, mids),
    ends AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM filled),
    tidy AS (SELECT filled.* REPLACE (greatest(least(x, q3 + 1.5 * (q3 - q1)), q1 - 1.5 * (q3 - q1)) AS x) FROM filled, ends),
    cells AS (SELECT x, w, CAST(avg(y) > 0.5 AS INTEGER) AS guess FROM tidy WHERE fold <> 4 GROUP BY x, w),
    told AS (SELECT o_orderkey, y, guess FROM tidy JOIN cells USING (x, w) WHERE fold = 4)"""


def cells(spark, folder):
    """Two features with gaps and outliers, and a label."""
    key, day = F.col("o_orderkey"), F.dayofmonth("o_orderdate") % 2
    far = (key % 11 != 0) & (key % 13 == 0)
    rule = (day == 1) | (F.col("o_custkey") % 2 == 1) | far
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(key % 11 != 0, F.when(key % 13 == 0, 1000.0).otherwise(day.cast("double"))).alias("x"),
        (F.col("o_custkey") % 2).cast("double").alias("w"),
        (rule == (F.floor(key * 3 / 7) % 10 != 0)).cast("int").alias("y"),
    )


def told(spark, folder, classifier):
    tidy, _ = prepare(cells(spark, folder), ["x", "w"])
    train, test = split_rows(tidy, [0.8, 0.2], ["o_orderkey"], share=F.col("o_orderkey") % 5 / F.lit(5.0))
    stages = search.pipeline(feature_stages.assembler(["x", "w"], "raw_features"), feature_stages.scaler(), classifier)
    return search.score(stages.fit(train), test).select("o_orderkey", "y", "prediction")


TOLD_SQL = f"WITH {CELLS_SQL} SELECT o_orderkey, y, CAST(guess AS DOUBLE) AS prediction FROM told"


@query("L8_cells", TOLD_SQL)
def forest_of_cells(spark, folder):
    """Three hundred trees with their own rows and features."""
    return told(spark, folder, search.random_forest("y", numTrees=300, maxDepth=10))


@query("L9_cells", TOLD_SQL)
def tree_of_cells(spark, folder):
    """A deep tree has a leaf for each cell."""
    return told(spark, folder, search.decision_tree("y", maxDepth=10, minInstancesPerNode=2))


@query("L10_cells", TOLD_SQL)
def rounds_on_cells(spark, folder):
    """A hundred rounds of boosting."""
    return told(spark, folder, search.boosted_trees("y", maxIter=100, maxDepth=3, stepSize=0.1))


def _compared_models():
    """A linear model with five grid points, forests with two, boosted trees with one."""

    def linear(names):
        classifier = search.logistic_regression("y", max_iter=100)
        stages = search.pipeline(feature_stages.assembler(names, "raw_features"), feature_stages.scaler(), classifier)
        return stages, search.grid(reg=(classifier.regParam, [0.01, 0.1, 1.0, 10.0, 100.0]))

    def wooded(names):
        classifier = search.random_forest("y", numTrees=20)
        return search.pipeline(feature_stages.assembler(names), classifier), search.grid(depth=(classifier.maxDepth, [5, 10]))

    def rounds(names):
        classifier = search.boosted_trees("y", maxIter=5, maxDepth=3, stepSize=0.2)
        return search.pipeline(feature_stages.assembler(names), classifier), [{}]

    return {"Gradient Boosting": rounds, "Logistic Regression": linear, "Random Forest": wooded}


@query(
    "L20_flow",
    f"""WITH {CELLS_SQL}, metrics AS (
      SELECT 'accuracy' AS metric, round(avg(CAST(y = guess AS INTEGER)), 6) AS value FROM told
      UNION ALL SELECT 'confusion[' || y || '.0,' || guess || '.0]', CAST(count(*) AS DOUBLE) FROM told GROUP BY y, guess)
    SELECT model, feature_set, metric, value, model = 'Gradient Boosting' AS wins
    FROM metrics, (VALUES ('Gradient Boosting'), ('Logistic Regression'), ('Random Forest')) AS m(model), (VALUES ('combined')) AS f(feature_set)""",
)
def compared_flow(spark, folder):
    """The whole flow through tables: preparation, split, three searches with five folds, reports, the winner.

    Of equally good models the first by name wins.
    """
    raw = unique("l20_flow")
    cells(spark, folder).write.saveAsTable(raw)
    product = search.FeatureSet("product", {"x_by_w": F.col("x") * F.col("w")})
    square = search.FeatureSet("square", {"x_squared": F.col("x") * F.col("x")})
    tables = compare_prepared(
        spark, raw, raw, "y", ["x", "w"], ["o_orderkey"], _compared_models(), [search.combined("combined", product, square)],
        test_share=0.2, share=F.col("o_orderkey") % 5 / F.lit(5.0), parallelism=4,
    )
    wins = spark.table(tables["best"]).select("model", "wins")
    found = spark.table(tables["reports"]).filter("metric = 'accuracy' OR metric LIKE 'confusion%'").join(F.broadcast(wins), "model")  # three rows
    return found.select("model", "feature_set", "metric", F.round("value", 6).alias("value"), "wins")
