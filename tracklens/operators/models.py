"""Distributed regressors and classifier, their reports and persistence."""

import json
from dataclasses import dataclass
from math import ceil, exp, factorial
from multiprocessing.pool import ThreadPool
from uuid import uuid4

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import (
    IDF, CountVectorizerModel, ElementwiseProduct, IndexToString, Normalizer, RegexTokenizer,
    SQLTransformer, StandardScaler, StopWordsRemover, StringIndexer, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import (
    DecisionTreeRegressor, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens.functions.columns import WORD_PATTERN
from tracklens.operators.resolution import label_features
from tracklens.operators.similarity import VOCABULARY_SIZE, terms, vocabulary
from tracklens.operators.triage import triage_features, with_complexity
from tracklens.schema import RESOLUTION_FEATURES, TRIAGE_FEATURES
from tracklens.session import checkpoint_folder, cut_lineage, written

SEED = 42
TREES_TOGETHER = 4   # trees written at once
FITTED_TOGETHER = 8  # trees on cells fitted at once
FITTED_WHOLE = 10_000    # rows up to which one fit makes a whole forest
ROWS_OF_A_TASK = 500_000  # rows one task holds for a part of a forest
APART = 1_000_003    # between the seeds of parts; a partition adds its number to the seed
# Chances that a row is drawn at most 0, 1, 2, ... times into a tree's bag: Poisson of mean 1.
DRAWN = [sum(exp(-1) / factorial(k) for k in range(most + 1)) for most in range(13)]


class NotEnoughRows(ValueError):
    """Too few rows to train on."""


def split_train_test(df: DataFrame, *, key: str = "number", seed: int = SEED,
                     train_percent: int = 80) -> DataFrame:
    """Add ``part`` (train or test) from a hash of the key.

    Unlike ``randomSplit`` the outcome does not depend on partitioning, so a
    recomputed partition lands on the same side.
    """
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
    return df.withColumn("part", F.when(bucket < train_percent, "train").otherwise("test"))


# --- regression --------------------------------------------------------------

@dataclass
class ResolutionModel:
    """A fitted scaler, forest and boosted trees, with their test metrics."""

    pipeline_model: PipelineModel
    metrics: DataFrame
    feature_names: list[str]

    @property
    def forest(self):
        return self.pipeline_model.stages[2]


def regression_report(scored: DataFrame, *, label: str, predictions: dict[str, str]) -> DataFrame:
    """MAE, RMSE and R2 per model, from one aggregation over the scored rows.

    ``predictions`` maps a model's name to its prediction column.
    """
    y = F.col(label)
    figures = [F.count(y).alias("n"), F.var_pop(y).alias("spread")]
    for place, column in enumerate(predictions.values()):
        error = F.col(column) - y
        figures += [F.avg(F.abs(error)).alias(f"mae{place}"),
                    F.avg(error * error).alias(f"mse{place}")]
    rows = F.inline(F.array(*[
        F.struct(F.lit(name).alias("model"), F.col(f"mae{place}").alias("mae_hours"),
                 F.col(f"mse{place}").alias("mse"))
        for place, name in enumerate(predictions)]))
    return scored.agg(*figures).select("n", "spread", rows).select(
        "model", "n", "mae_hours", (F.col("mae_hours") / 24).alias("mae_days"),
        F.sqrt("mse").alias("rmse_hours"),
        F.when(F.col("spread") > 0, 1 - F.col("mse") / F.col("spread")).alias("r2_score"))


def train_resolution_model(features: DataFrame, *, feature_names: list[str] = RESOLUTION_FEATURES,
                           label: str = "resolution_hours", key: str = "number",
                           min_rows: int = 10, seed: int = SEED, forest_trees: int = 100,
                           forest_depth: int = 10, boosting_rounds: int = 100,
                           boosting_depth: int = 5) -> ResolutionModel:
    """Fit a random forest and boosted trees on 80 % of the rows and report on
    the rest, also for their average.

    The features take few distinct values. Squared-error boosting only uses the
    mean and the number of rows of each distinct combination, so it is fitted on
    those, and its hundred rounds do not pass over the full data. So is the forest
    once the rows are more than its trees have combinations in all.
    """
    chosen = features.select(key, *[F.col(c).cast("double").alias(c) for c in feature_names],
                             F.col(label).cast("double").alias("label"))
    rows = cut_lineage(split_train_test(chosen, key=key, seed=seed))
    count = rows.count()
    if count < min_rows:
        raise NotEnoughRows(f"{count} rows; training needs at least {min_rows}")

    assembler = VectorAssembler(inputCols=feature_names, outputCol="raw_features")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True)
    scaler_model = scaler.fit(assembler.transform(rows))
    prepare = PipelineModel([assembler, scaler_model])
    train = rows.filter("part = 'train'")
    cells = cut_lineage(train.groupBy(*feature_names).agg(
        F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("rows")))

    # All features at every split, as the averaged single trees would use.
    forest = RandomForestRegressor(
        numTrees=forest_trees, maxDepth=forest_depth, minInstancesPerNode=2, seed=seed,
        featureSubsetStrategy="all", predictionCol="forest_hours")
    size = cells.agg(F.count(F.lit(1)).alias("cells"), F.sum("rows").alias("rows")).first()
    if size.cells * forest_trees < (size.rows or 0):
        forest = _forest_of_cells(forest, train, feature_names, prepare)
    else:
        forest = forest.fit(prepare.transform(train))
    boosted = GBTRegressor(
        maxIter=boosting_rounds, stepSize=0.1, maxDepth=boosting_depth, seed=seed,
        weightCol="rows", predictionCol="boosted_hours").fit(prepare.transform(cells))
    average = SQLTransformer(
        statement="SELECT *, (forest_hours + boosted_hours) / 2 AS ensemble_hours FROM __THIS__")
    model = PipelineModel([assembler, scaler_model, forest, boosted, average])

    report = regression_report(
        _transformed(model, rows.filter("part = 'test'"), feature_names), label="label",
        predictions={"random_forest": "forest_hours", "gradient_boosting": "boosted_hours",
                     "ensemble": "ensemble_hours"})
    return ResolutionModel(model, _keep(report), list(feature_names))


def _bags(train: DataFrame, feature_names: list[str], trees: int, seed: int) -> DataFrame:
    """Each tree's bootstrap of the rows as the mean and number of its draws per combination.

    A row is drawn into each tree by a Poisson number of mean 1, as the forest does itself.
    """
    times = " + ".join(f"CAST(u >= {most!r}D AS int)" for most in DRAWN)
    drawn = train.select(*feature_names, "label", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    drawn = drawn.withColumn("u", F.rand(seed)).withColumn("times", F.expr(times)).filter("times > 0")
    return drawn.groupBy("tree", *feature_names).agg(
        F.expr("sum(times * label) / sum(times) AS label"), F.expr("CAST(sum(times) AS double) AS rows"))


def _forest_of_cells(forest: RandomForestRegressor, train: DataFrame, feature_names: list[str],
                     prepare: PipelineModel) -> RandomForestRegressionModel:
    """The forest's trees, each fitted on its own bag of weighted combinations.

    Rows of one combination are never split, so a split gains as much on their mean and number
    as on the rows. The least rows of a node are told by weight: half a row less, to be
    safe from rounding. The class has no public way to hold trees fitted alone, so they are
    written in its format and loaded.
    """
    spark = train.sparkSession
    count = forest.getNumTrees()
    bags = prepare.transform(_bags(train, feature_names, count, forest.getSeed())).select(
        "tree", "features", "label", "rows")
    bags = written(bags.repartition("tree"), "bags", by="tree")
    weights = {row.tree: row.weight for row in bags.groupBy("tree").agg(F.sum("rows").alias("weight")).collect()}

    def fit(place: int):
        least = min((forest.getMinInstancesPerNode() - 0.5) / weights[place], 0.499)
        return DecisionTreeRegressor(
            maxDepth=forest.getMaxDepth(), minWeightFractionPerNode=least, seed=forest.getSeed(),
            weightCol="rows").fit(bags.filter(F.col("tree") == place))

    with ThreadPool(FITTED_TOGETHER) as pool:
        trees = pool.map(fit, sorted(weights), chunksize=1)
    path = f"{checkpoint_folder(spark)}/forest-{uuid4().hex}"
    _save_trees(trees, forest, RandomForestRegressionModel, {"numFeatures": len(feature_names)}, spark, path)
    return RandomForestRegressionModel.load(f"{path}/forest")


def _transformed(model: PipelineModel, rows: DataFrame, feature_names: list[str]) -> DataFrame:
    """Rows with the model's estimates, made once for each distinct combination of features."""
    cells = written(rows.select(*feature_names).distinct(), "combinations")
    names = [f"_of_{c}" for c in feature_names]
    scored = model.transform(cells).select(
        *[F.col(c).alias(name) for c, name in zip(feature_names, names)],
        "forest_hours", "boosted_hours", "ensemble_hours")
    same = [F.col(c).eqNullSafe(F.col(name)) for c, name in zip(feature_names, names)]
    return rows.join(scored, same, "left").drop(*names)


def _keep(small: DataFrame) -> DataFrame:
    """A report of a few rows, computed once."""
    return small.sparkSession.createDataFrame(small.collect(), small.schema)


def feature_importance(model: ResolutionModel) -> DataFrame:
    """The forest's importances, largest first."""
    return _importances(model.metrics.sparkSession, model.feature_names,
                        model.forest.featureImportances)


def _importances(spark: SparkSession, names: list[str], vector) -> DataFrame:
    rows = [(name, float(value)) for name, value in zip(names, vector.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature")


def predict_resolution(model: ResolutionModel, issues: DataFrame) -> DataFrame:
    """Estimated hours and days for each issue.

    The range is the estimate plus and minus the ensemble's mean test error,
    never below 0. Titles are cut to 80 characters.
    """
    error = model.metrics.filter("model = 'ensemble'").select("mae_hours").scalar()
    scored = _transformed(model.pipeline_model, label_features(issues), model.feature_names)
    hours = F.col("ensemble_hours")
    return scored.select(
        F.col("number").alias("issue_number"),
        F.substring(F.coalesce("title", F.lit("")), 1, 80).alias("title"),
        "labels", "created_date",
        hours.alias("predicted_hours"), (hours / 24).alias("predicted_days"),
        (F.greatest(hours - error, F.lit(0.0)) / 24).alias("lower_days"),
        ((hours + error) / 24).alias("upper_days"),
        (F.col("forest_hours") / 24).alias("random_forest_days"),
        (F.col("boosted_hours") / 24).alias("gradient_boosting_days"))


def rank_open_predictions(predictions: DataFrame, *, n: int | None = None) -> DataFrame:
    """Soonest first, by days rounded to two places."""
    ranked = predictions.orderBy(F.round("predicted_days", 2), "issue_number")
    return ranked if n is None else ranked.limit(n)


def save_resolution_model(model: ResolutionModel, path: str) -> None:
    model.pipeline_model.write().overwrite().save(f"{path}/model")
    model.metrics.write.mode("overwrite").parquet(f"{path}/metrics")


def load_resolution_model(spark: SparkSession, path: str) -> ResolutionModel:
    pipeline_model = PipelineModel.load(f"{path}/model")
    return ResolutionModel(pipeline_model, spark.read.parquet(f"{path}/metrics"),
                           pipeline_model.stages[0].getInputCols())


# --- classification ------------------------------------------------------------

@dataclass
class PriorityModel:
    """A fitted text and number encoder with its forest, and the test report."""

    encoder: PipelineModel
    classifier: PipelineModel
    report: DataFrame
    feature_names: list[str]


def _encoder(rows: DataFrame, *, size: int, stop_words: list[str]) -> tuple[PipelineModel, list[str]]:
    """Fit text weights (unit length) and scaled numbers over all rows."""
    counted = vocabulary(terms(rows, stop_words=stop_words), size=size)
    words = [row.term for row in counted.collect()]  # at most ``size`` terms
    numbers = VectorAssembler(inputCols=TRIAGE_FEATURES, outputCol="raw_numbers")
    scaler = StandardScaler(inputCol="raw_numbers", outputCol="numbers", withMean=True)
    stages = [numbers, scaler.fit(numbers.transform(rows))]
    if words:
        tokens = RegexTokenizer(inputCol="feature_text", outputCol="tokens", gaps=False,
                                pattern=WORD_PATTERN)
        kept = StopWordsRemover(inputCol="tokens", outputCol="kept_tokens", stopWords=stop_words,
                                caseSensitive=True)
        counts = CountVectorizerModel.from_vocabulary(words, "kept_tokens", "term_counts")
        counts.setMinTF(1.0)
        text = PipelineModel([tokens, kept, counts])
        # IDF here is ln((n+1)/(df+1)); the wanted weight adds 1 to it.
        idf = IDF(inputCol="term_counts", outputCol="unused").fit(text.transform(rows)).idf
        shifted = ElementwiseProduct(inputCol="term_counts", outputCol="term_weights",
                                     scalingVec=Vectors.dense(idf.toArray() + 1.0))
        unit = Normalizer(inputCol="term_weights", outputCol="text_vector", p=2.0)
        stages += [tokens, kept, counts, shifted, unit]
    parts = (["text_vector"] if words else []) + ["numbers"]
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return PipelineModel(stages), words + TRIAGE_FEATURES


def triage_matrix(features: DataFrame, *, stop_words: list[str],
                  size: int = VOCABULARY_SIZE) -> DataFrame:
    """Each issue's combined vector: text weights, then the scaled numbers."""
    encoder, _ = _encoder(features, size=size, stop_words=stop_words)
    return encoder.transform(features).select("number", "text_vector", "numbers", "features")


def classification_report(predicted: DataFrame, *, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy and the macro
    and weighted means; a ratio over nothing is 0.

    Computed from the counts per (label, prediction), of which there are few.
    """
    pairs = predicted.groupBy(F.col(label).alias("truth"), F.col(prediction).alias("guess")).agg(
        F.count(F.lit(1)).alias("n"))
    sides = pairs.select(F.col("n"), F.inline(F.array(
        F.struct(F.col("truth").alias("class"), F.col("n").alias("support"),
                 F.lit(0).cast("bigint").alias("guessed"),
                 F.when(F.col("truth") == F.col("guess"), F.col("n")).otherwise(0).alias("hits")),
        F.struct(F.col("guess").alias("class"), F.lit(0).cast("bigint").alias("support"),
                 F.col("n").alias("guessed"), F.lit(0).cast("bigint").alias("hits")))))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    classes = sides.groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("guessed").alias("guessed"),
        F.sum("hits").alias("hits"),
    ).withColumns({
        "precision": ratio(F.col("hits"), F.col("guessed")),
        "recall": ratio(F.col("hits"), F.col("support")),
    }).withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"),
                              F.col("precision") + F.col("recall")))
    scores = ["precision", "recall", "f1"]
    summary = classes.agg(
        F.sum("support").alias("support"), (F.sum("hits") / F.sum("support")).alias("accuracy"),
        *[F.avg(c).alias(f"macro_{c}") for c in scores],
        *[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(f"weighted_{c}")
          for c in scores])
    accuracy = F.col("accuracy")
    means = summary.select(F.inline(F.array(
        F.struct(F.lit("accuracy").alias("class"), accuracy.alias("precision"),
                 accuracy.alias("recall"), accuracy.alias("f1"), "support"),
        *[F.struct(F.lit(f"{kind} avg").alias("class"),
                   *[F.col(f"{kind}_{c}").alias(c) for c in scores], "support")
          for kind in ("macro", "weighted")])))
    return classes.select("class", *scores, "support").unionByName(means)


def train_priority_model(training: DataFrame, *, stop_words: list[str], label: str = "urgency",
                         size: int = VOCABULARY_SIZE, trees: int = 200, max_depth: int = 15,
                         seed: int = SEED) -> PriorityModel:
    """Fit a forest imitating the urgency rule, classes weighted to equal mass.

    ``training`` is the result of ``triage_features`` over resolved issues with
    their urgency. Text and number encodings are fitted on all its rows, the
    forest on 80 %.
    """
    rows = cut_lineage(split_train_test(
        training.select("number", "feature_text", *TRIAGE_FEATURES, label), seed=seed))
    if rows.isEmpty():
        raise NotEnoughRows("no resolved issue to train on")
    encoder, names = _encoder(rows, size=size, stop_words=stop_words)
    # Read several times by the forest; texts are encoded once.
    encoded = cut_lineage(encoder.transform(rows).select("number", "part", label, "features"))
    indexer = StringIndexer(inputCol=label, outputCol="label_index",
                            stringOrderType="alphabetAsc").fit(encoded)
    indexed = indexer.transform(encoded)
    train = indexed.filter("part = 'train'")
    # One row per class.
    sizes = train.groupBy("label_index").agg(F.count(F.lit(1)).alias("class_rows"))
    classes = sizes.agg(F.count(F.lit(1)).alias("k"), F.sum("class_rows").alias("n")).first()
    weighted = train.join(F.broadcast(sizes), "label_index").withColumn(
        "class_weight", F.lit(float(classes.n)) / (classes.k * F.col("class_rows")))
    forest = RandomForestClassifier(
        labelCol="label_index", weightCol="class_weight", numTrees=trees, maxDepth=max_depth, seed=seed)
    forest = _forest_in_parts(forest, weighted, classes.n or 0)
    names_back = IndexToString(inputCol="prediction", outputCol="predicted_priority",
                               labels=indexer.labels)
    classifier = PipelineModel([forest, names_back])
    # Read more than once by the report; rows are scored once.
    tested = cut_lineage(classifier.transform(indexed.filter("part = 'test'")).select(label, "predicted_priority"))
    report = classification_report(tested, label=label, prediction="predicted_priority")
    return PriorityModel(encoder, classifier, _keep(report), names)


def _forest_in_parts(forest: RandomForestClassifier, train: DataFrame, rows: int) -> RandomForestClassificationModel:
    """The forest, fitted as several smaller ones at the same time once there are many rows.

    For each node every partition passes on figures of all bins and classes, however few of its
    rows are in it. So a part of the trees is fitted on few partitions, bounded by rows, and other
    parts on the same rows beside it keep the cores busy. A tree draws its bag alone and does not
    see the others, so the parts' trees make one forest. They are joined as in ``_forest_of_cells``.
    """
    spark, trees = train.sparkSession, forest.getNumTrees()
    tasks = ceil(rows / ROWS_OF_A_TASK)
    parts = min(trees, spark.sparkContext.defaultParallelism // max(tasks, 1))
    if rows <= FITTED_WHOLE or parts < 2:
        return forest.fit(train)
    few = train.select(forest.getLabelCol(), forest.getWeightCol(), forest.getFeaturesCol()).coalesce(tasks)
    # "auto" would mean another share of the features for a part of one tree.
    share = {"auto": "sqrt"}.get(forest.getFeatureSubsetStrategy(), forest.getFeatureSubsetStrategy())

    def fit(part: int) -> RandomForestClassificationModel:
        return forest.copy({
            forest.numTrees: trees // parts + (part < trees % parts), forest.featureSubsetStrategy: share,
            forest.seed: forest.getSeed() + part * APART}).fit(few)

    with ThreadPool(parts) as pool:
        fitted = pool.map(fit, range(parts), chunksize=1)
    path = f"{checkpoint_folder(spark)}/forest-{uuid4().hex}"
    _save_trees([tree for part in fitted for tree in part.trees], forest, RandomForestClassificationModel,
                {"numFeatures": fitted[0].numFeatures, "numClasses": fitted[0].numClasses}, spark, path)
    return RandomForestClassificationModel.load(f"{path}/forest")


def priority_importance(model: PriorityModel, *, n: int = 10) -> DataFrame:
    """The most important terms and numbers."""
    return _importances(model.report.sparkSession, model.feature_names,
                        model.classifier.stages[0].featureImportances).limit(n)


def predict_priority(model: PriorityModel, timeline: DataFrame) -> DataFrame:
    """Priority, confidence (percent, one place) and complexity for each issue."""
    ready = triage_features(with_complexity(timeline))
    scored = model.classifier.transform(model.encoder.transform(ready))
    surest = F.array_max(vector_to_array("probability"))
    return scored.select(
        "number", "title", "url", "labels", "num_comments", "predicted_priority",
        F.round(surest * 100, 1).alias("priority_confidence"), "complexity_score")


def _save_trees(trees: list, forest, kind: type, figures: dict, spark: SparkSession, path: str) -> None:
    """Write trees as a forest of class ``kind`` with the parameters of ``forest``, a few trees at a time.

    The forest's own writer makes rows of all nodes on the driver and sends them as one task.
    Here each tree is written alone; their files become the forest's by a Spark job.
    """
    def save(place: int) -> None:
        trees[place].write().overwrite().save(f"{path}/trees/{place}")

    with ThreadPool(TREES_TOGETHER) as pool:
        pool.map(save, range(len(trees)), chunksize=1)
    folders = [f"{path}/trees/{place}" for place in range(len(trees))]
    place = F.regexp_extract("_metadata.file_path", r"/trees/(\d+)/(?:data|metadata)/[^/]*$", 1).cast("int")
    spark.read.parquet(*[f"{folder}/data" for folder in folders]).select(
        place.alias("treeID"), F.struct("*").alias("nodeData")
    ).write.mode("overwrite").parquet(f"{path}/forest/data")
    spark.read.text([f"{folder}/metadata" for folder in folders]).select(
        place.alias("treeID"), F.col("value").alias("metadata"), F.lit(1.0).alias("weights")
    ).write.mode("overwrite").parquet(f"{path}/forest/treesMetadata")
    about = {
        "class": f"org.apache.spark.{kind.__module__.removeprefix('pyspark.')}.{kind.__name__}", "timestamp": 0,
        "sparkVersion": spark.version, "uid": forest.uid, "defaultParamMap": {},
        "paramMap": {p.name: forest.getOrDefault(p) for p in forest.params if forest.isDefined(p)},
        **figures, "numTrees": len(trees)}
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode(
        "overwrite").text(f"{path}/forest/metadata")


def save_priority_model(model: PriorityModel, path: str) -> None:
    model.encoder.write().overwrite().save(f"{path}/encoder")
    forest, names_back = model.classifier.stages
    _save_trees(forest.trees, forest, type(forest),
                {"numFeatures": forest.numFeatures, "numClasses": forest.numClasses},
                model.report.sparkSession, f"{path}/classifier")
    names_back.write().overwrite().save(f"{path}/classifier/names")
    model.report.write.mode("overwrite").parquet(f"{path}/report")
    names = model.report.sparkSession.createDataFrame(
        list(enumerate(model.feature_names)), "place int, name string")
    names.write.mode("overwrite").parquet(f"{path}/features")


def load_priority_model(spark: SparkSession, path: str) -> PriorityModel:
    names = [row.name for row in spark.read.parquet(f"{path}/features").orderBy("place").collect()]
    classifier = PipelineModel([RandomForestClassificationModel.load(f"{path}/classifier/forest"),
                                IndexToString.load(f"{path}/classifier/names")])
    return PriorityModel(PipelineModel.load(f"{path}/encoder"), classifier,
                         spark.read.parquet(f"{path}/report"), names)
