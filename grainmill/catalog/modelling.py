"""Feature stages, models, evaluation (L)."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from grainmill.catalog.frames import FEATURES, doc_features
from grainmill.catalog.registry import query, table
from grainmill.catalog.storing import REPORT_CTES, RULE_SQL, ruled
from grainmill.models import evaluate, feature_stages, oversample, search
from grainmill.operators.sample import split_rows, stratified_split

KEY = ["doc_id"]


def _round(df, digits, *names):
    return df.withColumns({c: F.round(c, digits) for c in names})


@query("L1", "SELECT p_partkey, CAST(p_size AS DOUBLE) AS f0, p_retailprice AS f1 FROM part")
def assembled(spark, folder):
    df = feature_stages.assembler(["p_size", "p_retailprice"]).transform(table(spark, folder, "part"))
    vector = vector_to_array("features")
    return df.select("p_partkey", vector[0].alias("f0"), vector[1].alias("f1"))


@query(
    "L2",
    "SELECT p_partkey, round((p_size - avg(p_size) OVER ()) / stddev_samp(p_size) OVER (), 6) AS f0, "
    "round((p_retailprice - avg(p_retailprice) OVER ()) / stddev_samp(p_retailprice) OVER (), 6) AS f1 FROM part",
)
def standardised(spark, folder):
    df = table(spark, folder, "part")
    stages = search.pipeline(feature_stages.assembler(["p_size", "p_retailprice"], "raw_features"), feature_stages.scaler(centre=True))
    vector = vector_to_array("features")
    return stages.fit(df).transform(df).select("p_partkey", F.round(vector[0], 6).alias("f0"), F.round(vector[1], 6).alias("f1"))


@query(
    "L3",
    "WITH s AS (SELECT stddev_samp(p_size) AS a, stddev_samp(p_retailprice) AS b FROM part WHERE p_partkey % 5 <> 0) "
    "SELECT p_partkey, round(p_size / a, 6) AS f0, round(p_retailprice / b, 6) AS f1 FROM part, s WHERE p_partkey % 5 = 0",
)
def train_statistics(spark, folder):
    """Test rows scaled with the deviation of the training rows."""
    df = table(spark, folder, "part")
    stages = search.pipeline(feature_stages.assembler(["p_size", "p_retailprice"], "raw_features"), feature_stages.scaler())
    scaled = stages.fit(df.filter("p_partkey % 5 <> 0")).transform(df.filter("p_partkey % 5 = 0"))
    vector = vector_to_array("features")
    return scaled.select("p_partkey", F.round(vector[0], 6).alias("f0"), F.round(vector[1], 6).alias("f1"))


@query(
    "L4",
    """WITH s AS (SELECT min(p_size) AS a, 1.0 / (max(p_size) - min(p_size)) AS aw, min(p_retailprice) AS b, 1.0 / (max(p_retailprice) - min(p_retailprice)) AS bw
      FROM part WHERE p_partkey % 5 <> 0)
    SELECT p_partkey, round((p_size - a) * aw, 6) AS p_size, round((p_retailprice - b) * bw, 6) AS p_retailprice FROM part, s""",
)
def min_max_scaled(spark, folder):
    """Train and test rows scaled with the training table."""
    df = table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice")
    values = feature_stages.min_max_table(df.filter("p_partkey % 5 <> 0"), ["p_size", "p_retailprice"])
    return _round(feature_stages.apply_min_max(df, values), 6, "p_size", "p_retailprice")


@query(
    "L4_table",
    " UNION ALL ".join(
        f"SELECT '{c}' AS name, CAST(min({c}) AS DOUBLE) AS \"min\", CAST(max({c}) AS DOUBLE) AS \"max\", round(1.0 / (max({c}) - min({c})), 9) AS scale FROM part"
        for c in ("p_size", "p_retailprice")
    ),
)
def min_max_values(spark, folder):
    return _round(feature_stages.min_max_table(table(spark, folder, "part"), ["p_size", "p_retailprice"]), 9, "scale")


@query(
    "L5",
    "WITH c AS (SELECT count(*) FILTER (WHERE quality = 0) / count(*) FILTER (WHERE quality = 1) AS w FROM labels) "
    "SELECT doc_id, round(CASE WHEN quality = 1 THEN w ELSE 1.0 END, 6) AS weight FROM labels, c",
)
def ratio_weight(spark, folder):
    return feature_stages.ratio_weight(table(spark, folder, "labels"), "quality").select("doc_id", F.round("weight", 6).alias("weight"))


@query(
    "L5_balanced",
    "SELECT label, CAST(count(*) AS BIGINT) AS n, round((SELECT count(*) FROM embeddings) / ((SELECT count(DISTINCT label) FROM embeddings) * count(*)), 6) AS weight "
    "FROM embeddings GROUP BY label",
)
def balanced(spark, folder):
    return _round(feature_stages.balanced_weights(table(spark, folder, "embeddings"), "label"), 6, "weight")


@query(
    "L6",
    """WITH f AS (SELECT quality, CAST(n_chars AS DOUBLE) AS n_chars FROM documents JOIN labels USING (doc_id)),
    c AS (SELECT quality, count(*) AS n, min(n_chars) AS low, max(n_chars) AS high FROM f GROUP BY quality)
    SELECT quality, CAST((SELECT max(n) FROM c) AS BIGINT) AS n, CAST((SELECT max(n) FROM c) - n AS BIGINT) AS n_synthetic,
      CAST((SELECT max(n) FROM c) AS BIGINT) AS n_in_range FROM c""",
)
def oversampled(spark, folder):
    """All classes as large as the largest after oversampling, every new row within the range of its class."""
    docs = doc_features(spark, folder)
    grown = oversample.smote(docs, "quality", FEATURES, KEY)
    ends = docs.groupBy("quality").agg(*[f(c).alias(f"{n}_{c}") for c in FEATURES for n, f in (("low", F.min), ("high", F.max))])
    inside = reduce(Column.__and__, [F.col(c).between(F.col(f"low_{c}"), F.col(f"high_{c}")) for c in FEATURES])
    return grown.join(F.broadcast(ends), "quality").groupBy("quality").agg(  # a row per class
        F.count("*").alias("n"), F.count_if("synthetic").alias("n_synthetic"), F.count_if(inside).alias("n_in_range")
    )


# The whole models below have no SQL for their predictions; SQL knows which rows they score, with which labels
# and classes. `closed_forms` holds models whose predictions SQL can compute.
SCORED_SQL = "SELECT doc_id, quality, TRUE AS is_class FROM documents JOIN labels USING (doc_id) WHERE doc_id % 5 = 4"


def _fifths(key):
    """A row's share from its id, so that SQL knows the parts of a split."""
    return F.pmod(F.col(key), F.lit(5)) / F.lit(5.0)


def _docs_split(spark, folder):
    return split_rows(doc_features(spark, folder), [0.8, 0.2], KEY, share=_fifths("doc_id"))


def _judged(scored, label="quality"):
    return scored.select("doc_id", label, F.col("prediction").isin(0.0, 1.0).alias("is_class"))


def _scored(spark, folder, classifier):
    train, test = _docs_split(spark, folder)
    stages = search.pipeline(feature_stages.assembler(FEATURES, "raw_features"), feature_stages.scaler(), classifier)
    return _judged(search.score(stages.fit(train), test))


@query(
    "L7",
    "SELECT vec_id, label, TRUE AS is_class FROM embeddings WHERE vec_id % 5 = 4",
)
def logistic(spark, folder):
    """Ten classes of embeddings, all dimensions."""
    df = table(spark, folder, "embeddings").select("vec_id", "label", array_to_vector("embedding").alias("features"))
    train, test = split_rows(df, [0.8, 0.2], ["vec_id"], share=_fifths("vec_id"))
    model = search.logistic_regression("label", max_iter=100, regParam=0.01).fit(train)
    return search.score(model, test).select("vec_id", "label", F.col("prediction").isin(*map(float, range(10))).alias("is_class"))


@query("L8", SCORED_SQL)
def forest(spark, folder):
    return _scored(spark, folder, search.random_forest("quality", numTrees=300, maxDepth=5))


@query("L9", SCORED_SQL)
def tree(spark, folder):
    return _scored(spark, folder, search.decision_tree("quality", maxDepth=5, minInstancesPerNode=2))


@query("L10", SCORED_SQL)
def boosted(spark, folder):
    return _scored(spark, folder, search.boosted_trees("quality", maxIter=100, maxDepth=3, stepSize=0.1))


@query("L11", SCORED_SQL)
def full_pipeline(spark, folder):
    """Text indexed and imputed, numbers imputed, pair products, forest: fitted as one pipeline."""
    train, test = _docs_split(spark, folder)
    stages = feature_stages.preparation_stages(["n_chars", "n_words", "digit_share"], ["lang", "source"])
    model = search.pipeline(*stages, search.random_forest("quality", numTrees=100, maxDepth=4, maxBins=64)).fit(train)
    return _judged(search.score(model, test))


def _gapped_docs(spark, folder):
    """Documents with gaps in numbers and texts, and their whole address as a text with very many values."""
    docs = doc_features(spark, folder)
    address = F.concat_ws("/", "source", (F.col("doc_id") % 7).cast("string"))
    return docs.withColumns({"n_words": F.when(F.col("doc_id") % 6 != 1, F.col("n_words")), "lang": F.when(F.col("doc_id") % 9 != 2, F.col("lang")), "address": address})


VECTOR = ("chars_words", "chars_digits", "words_digits", "n_chars", "n_words", "digit_share", "lang", "address")


@query(
    "L11_vectors",
    """WITH d AS (
      SELECT doc_id, n_chars::DOUBLE AS n_chars, CASE WHEN doc_id % 6 <> 1 THEN length(text) - length(replace(text, ' ', '')) + 1 END::DOUBLE AS n_words,
        (length(text) - length(regexp_replace(text, '[0-9]', '', 'g'))) / greatest(length(text), 1) AS digit_share,
        CASE WHEN doc_id % 9 <> 2 THEN lang END AS lang, source || '/' || (doc_id % 7) AS address
      FROM documents JOIN labels USING (doc_id)),
    train AS (SELECT * FROM d WHERE doc_id % 5 <> 4),
    means AS (SELECT avg(n_chars) AS c, avg(n_words) AS w, avg(digit_share) AS s FROM train),
    langs AS (SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS code FROM train WHERE lang IS NOT NULL GROUP BY lang),
    addresses AS (SELECT address, row_number() OVER (ORDER BY count(*) DESC, address) - 1 AS code FROM train GROUP BY address),
    filled AS (
      SELECT doc_id, coalesce(n_chars, c) AS c, coalesce(n_words, w) AS w, coalesce(digit_share, s) AS s, coalesce(l.code, 0)::DOUBLE AS l, coalesce(a.code, 0)::DOUBLE AS a
      FROM d CROSS JOIN means LEFT JOIN langs AS l USING (lang) LEFT JOIN addresses AS a USING (address) WHERE doc_id % 5 = 4)
    SELECT doc_id, round(c * w, 4) AS chars_words, round(c * s, 4) AS chars_digits, round(w * s, 4) AS words_digits, round(c, 4) AS n_chars, round(w, 4) AS n_words,
      round(s, 6) AS digit_share, l AS lang, a AS address FROM filled""",
)
def prepared_vectors(spark, folder):
    """The assembled vectors of the test rows, with codes and means of the training rows."""
    train, test = split_rows(_gapped_docs(spark, folder), [0.8, 0.2], KEY, share=_fifths("doc_id"))
    stages = search.pipeline(*feature_stages.preparation_stages(["n_chars", "n_words", "digit_share"], ["lang", "address"]))
    vector = vector_to_array("features")
    found = stages.fit(train).transform(test).select("doc_id", *[vector[i].alias(c) for i, c in enumerate(VECTOR)])
    return _round(_round(found, 4, *VECTOR[:5]), 6, "digit_share")


def _searched(spark, folder):
    train, test = _docs_split(spark, folder)
    classifier = search.logistic_regression("quality", max_iter=100)
    stages = search.pipeline(feature_stages.assembler(FEATURES, "raw_features"), feature_stages.scaler(), classifier)
    points = search.grid(reg=(classifier.regParam, [0.01, 1.0]), net=(classifier.elasticNetParam, [0.0, 1.0]))
    return search.train_and_evaluate("Logistic Regression", stages, points, train, test, "quality", KEY, parallelism=4), train


@query(
    "L12",
    "SELECT CAST(point AS INTEGER) AS point, reg, net, TRUE AS is_share FROM (VALUES (0, '0.01', '0.0'), (1, '0.01', '1.0'), (2, '1.0', '0.0'), (3, '1.0', '1.0')) AS v(point, reg, net)",
)
def grid_scores(spark, folder):
    """Every grid point, with a mean score over five folds that is a share."""
    found, train = _searched(spark, folder)
    scores = search.scores_table(train, found)
    return scores.select("point", F.col("params")["regParam"].alias("reg"), F.col("params")["elasticNetParam"].alias("net"), F.col("score").between(0, 1).alias("is_share"))


@query("L14", f"WITH {RULE_SQL} SELECT round(avg(CASE WHEN quality = guess THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM ruled")
def accuracy(spark, folder):
    return _round(evaluate.accuracy(ruled(spark, folder), "quality", "guess"), 6, "accuracy")


@query(
    "L15",
    """WITH s AS (SELECT quality, n_chars FROM labels JOIN documents USING (doc_id)),
    r AS (SELECT quality, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2 AS rk FROM s)
    SELECT round((sum(rk) FILTER (WHERE quality = 1) - n1 * (n1 + 1) / 2) / (n1 * n0), 6) AS auc
    FROM r, (SELECT count(*) FILTER (WHERE quality = 1) AS n1, count(*) FILTER (WHERE quality = 0) AS n0 FROM s) GROUP BY n1, n0""",
)
def roc_area(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", F.col("n_chars").cast("double").alias("score"))
    scored = table(spark, folder, "labels").join(documents, "doc_id")
    return spark.createDataFrame([(round(evaluate.area_under_roc(scored, "quality", "score", bins=0), 6),)], "auc double")


@query("L16", f"WITH {RULE_SQL} SELECT CAST(quality AS DOUBLE) AS label, CAST(guess AS DOUBLE) AS prediction, CAST(count(*) AS BIGINT) AS n FROM ruled GROUP BY quality, guess")
def confusion(spark, folder):
    return evaluate.confusion(ruled(spark, folder), "quality", "guess")


REPORT_SQL = f"""WITH {RULE_SQL}, {REPORT_CTES}
  SELECT "class", round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM rep"""


@query("L17", REPORT_SQL)
def report(spark, folder):
    return _round(evaluate.classification_report(evaluate.confusion(ruled(spark, folder), "quality", "guess")), 6, "precision", "recall", "f1")


def _builders():
    """A linear model, a tree and a forest on any list of feature columns, with three grid points each."""

    def linear(names):
        classifier = search.logistic_regression("quality", max_iter=100)
        stages = search.pipeline(feature_stages.assembler(names, "raw_features"), feature_stages.scaler(), classifier)
        return stages, search.grid(reg=(classifier.regParam, [0.01, 0.1, 1.0]))

    def branched(names):
        classifier = search.decision_tree("quality")
        return search.pipeline(feature_stages.assembler(names), classifier), search.grid(depth=(classifier.maxDepth, [3, 5, 7]))

    def wooded(names):
        classifier = search.random_forest("quality", numTrees=20)
        return search.pipeline(feature_stages.assembler(names), classifier), search.grid(depth=(classifier.maxDepth, [3, 4, 5]))

    return {"Logistic Regression": linear, "Decision Tree": branched, "Random Forest": wooded}


def feature_sets():
    product = search.FeatureSet("fe_1", {"words_by_digits": F.col("n_words") * F.col("digit_share")})
    square = search.FeatureSet("fe_2", {"lines_squared": F.col("n_lines") * F.col("n_lines")})
    return [product, square, search.combined("combined", product, square)]


@query(
    "L20",
    """SELECT model, feature_set, TRUE AS is_share FROM (VALUES ('Logistic Regression'), ('Decision Tree'), ('Random Forest')) AS m(model),
      (VALUES ('fe_1'), ('fe_2'), ('combined')) AS f(feature_set)""",
)
def comparison(spark, folder):
    """Three models on three feature sets, five folds and three grid points each."""
    train, test = _docs_split(spark, folder)
    results = search.compare(_builders(), feature_sets(), train, test, "quality", KEY, FEATURES, parallelism=4)
    return results.select("model", "feature_set", F.col("accuracy").between(0, 1).alias("is_share"))


@query(
    "L21",
    """SELECT p_partkey, set_name, a, b FROM (
      SELECT p_partkey, 'fe_1' AS set_name, p_size * p_retailprice AS a, CAST(NULL AS DOUBLE) AS b FROM part
      UNION ALL SELECT p_partkey, 'fe_2', NULL, sqrt(p_size) FROM part
      UNION ALL SELECT p_partkey, 'combined', p_size * p_retailprice, sqrt(p_size) FROM part)""",
)
def feature_variants(spark, folder):
    """Each feature set is built from the table itself, not from the one before."""
    part = table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice")
    product = search.FeatureSet("fe_1", {"a": F.col("p_size") * F.col("p_retailprice")})
    root = search.FeatureSet("fe_2", {"b": F.sqrt(F.col("p_size").cast("double"))})
    parts = [s.apply(part).withColumn("set_name", F.lit(s.name)) for s in (product, root, search.combined("combined", product, root))]
    frame = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    return frame.select("p_partkey", "set_name", "a", "b")


RULES = {"production": 400, "max": 300, "product": 600}


def rule_results(spark, folder):
    """Accuracies of three length rules as a results table."""
    documents = table(spark, folder, "documents").select("doc_id", "n_chars")
    docs = table(spark, folder, "labels").join(documents, "doc_id")
    tries = F.array(*[F.struct(F.lit(n).alias("model"), (F.col("n_chars") > v).cast("int").alias("guess")) for n, v in RULES.items()])
    return docs.select("quality", F.inline(tries)).groupBy("model").agg(F.avg((F.col("quality") == F.col("guess")).cast("double")).alias("accuracy"))


RESULTS_SQL = "results AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS model, avg(CASE WHEN (n_chars > {v}) = (quality = 1) THEN 1.0 ELSE 0.0 END) AS accuracy FROM labels JOIN documents USING (doc_id)"
    for n, v in RULES.items()
) + ")"


@query(
    "L22",
    f"""WITH {RESULTS_SQL}, w AS (SELECT max(accuracy) FILTER (WHERE model = 'production') AS p, max(accuracy) FILTER (WHERE model = 'max') AS a,
      max(accuracy) FILTER (WHERE model = 'product') AS b FROM results)
    SELECT CASE WHEN greatest(a, b) - p < -0.01 THEN 'production' WHEN a > b THEN 'max' ELSE 'product' END AS choice FROM w""",
)
def challenger(spark, folder):
    return search.choose_challenger(rule_results(spark, folder), "production", "max", "product", 0.01)


@query("L23", "SELECT CAST(50 AS BIGINT) AS rounds, TRUE AS in_order")
def noise_robustness(spark, folder):
    train, test = stratified_split(doc_features(spark, folder), "quality", 0.2, KEY)
    model = search.pipeline(feature_stages.assembler(FEATURES, "raw_features"), feature_stages.scaler(), search.logistic_regression("quality", max_iter=100, regParam=0.01)).fit(train)
    found = search.robustness(model, test, FEATURES, "quality", KEY, rounds=50, std=1.2)
    return found.select("rounds", (F.col("low") <= F.col("mean_accuracy")).__and__(F.col("mean_accuracy") <= F.col("high")).alias("in_order"))
