import pytest
from pyspark.sql import functions as F

from tests.frames import resolution_case, rows_by
from tracklens.operators import models, resolution, similarity
from tracklens.operators.filters import filter_by_state
from tracklens.schema import TRIAGE_FEATURES

SMALL = {"forest_trees": 10, "boosting_rounds": 5}


@pytest.fixture(scope="module")
def ladder(spark):
    rows = [(i, *[float(i + j) for j in range(1, 6)], 10.0 * (i + 1)) for i in range(10)]
    names = [f"feature{j}" for j in range(1, 6)]
    df = spark.createDataFrame(rows, "number bigint, " + ", ".join(f"{n} double" for n in names)
                               + ", resolution_hours double")
    return df, names


def test_refuses_few_rows(ladder):
    df, names = ladder
    with pytest.raises(models.NotEnoughRows):
        models.train_resolution_model(df.limit(5), feature_names=names)


def test_save_and_load(spark, ladder, tmp_path):
    df, names = ladder
    model = models.train_resolution_model(df, feature_names=names, **SMALL)
    models.save_resolution_model(model, str(tmp_path))
    again = models.load_resolution_model(spark, str(tmp_path))
    assert again.feature_names == names
    score = lambda m: [r.ensemble_hours for r in m.pipeline_model.transform(df).orderBy("number").collect()]
    assert score(model) == score(again)
    assert model.metrics.exceptAll(again.metrics).count() == 0
    weights = models.feature_importance(again).collect()
    assert len(weights) == 5 and sum(r.importance for r in weights) == pytest.approx(1)
    assert weights == sorted(weights, key=lambda r: -r.importance)


def test_open_issues_are_estimated(spark):
    issues, events = resolution_case(spark)
    features = resolution.label_features(resolution.closed_resolutions(issues, events))
    model = models.train_resolution_model(features, **SMALL)
    assert {r.model for r in model.metrics.collect()} == {
        "random_forest", "gradient_boosting", "ensemble"}
    found = models.rank_open_predictions(
        models.predict_resolution(model, filter_by_state(issues, "open"))).collect()
    assert len(found) == 4
    for row in found:
        assert row.predicted_days == pytest.approx(
            (row.random_forest_days + row.gradient_boosting_days) / 2)
        assert 0 <= row.lower_days <= row.predicted_days <= row.upper_days
    ranks = [(round(r.predicted_days, 2), r.issue_number) for r in found]
    assert ranks == sorted(ranks)


def test_boosting_on_cells_equals_boosting_on_rows(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    rows = spark.range(400).selectExpr(
        "id", "CAST(id % 4 AS double) AS a", "CAST(id % 6 AS double) AS b",
        "CAST(id % 4 * 10 + id % 6 * 3 + id % 11 AS double) AS label", "1D AS weight")
    cells = rows.groupBy("a", "b").agg(F.avg("label").alias("label"), F.sum("weight").alias("weight"))
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features")
    boost = GBTRegressor(maxIter=5, stepSize=0.1, maxDepth=3, seed=1, weightCol="weight")
    score = lambda fitted: [r.prediction for r in fitted.transform(
        vectors.transform(rows)).orderBy("id").collect()]
    by_rows, by_cells = (score(boost.fit(vectors.transform(df))) for df in (rows, cells))
    assert by_rows == pytest.approx(by_cells)


def _repeated_rows(spark):
    """2,000 rows of 12 combinations; the label follows them but for some noise."""
    return spark.range(2000).selectExpr(
        "id AS number", "CAST(id % 4 AS double) AS a", "CAST(id % 3 AS double) AS b",
        "CAST(id % 4 * 100 + id % 3 * 30 + id % 7 AS double) AS resolution_hours")


def test_forest_of_many_equal_rows_is_fitted_on_combinations(spark, monkeypatch):
    from pyspark.ml.regression import RandomForestRegressor

    df, names = _repeated_rows(spark), ["a", "b"]
    cells = models.train_resolution_model(df, feature_names=names, **SMALL)
    fit, passed = RandomForestRegressor.fit, []
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda self, rows: passed.append(1) or fit(self, rows))
    models.train_resolution_model(df, feature_names=names, **SMALL)
    assert not passed  # no pass of the forest over all rows
    few = df.limit(40)
    models.train_resolution_model(few, feature_names=names, **SMALL)
    assert passed      # fewer rows than combinations of all trees

    forest = cells.forest
    assert forest.getNumTrees == 10 and forest.getPredictionCol() == "forest_hours"
    assert len({tree.toDebugString.split("\n", 1)[1] for tree in forest.trees}) > 1  # each on a bag of its own
    by_rows = RandomForestRegressor(
        numTrees=10, maxDepth=10, minInstancesPerNode=2, seed=1, featureSubsetStrategy="all", labelCol="label").fit(
        models.PipelineModel(cells.pipeline_model.stages[:2]).transform(
            df.withColumnRenamed("resolution_hours", "label")))
    scored = cells.pipeline_model.transform(df)
    found = by_rows.transform(scored).selectExpr("max(abs(prediction - forest_hours))").first()[0]
    assert found < 1  # between combinations labels differ by 10 at least
    assert forest.featureImportances.toArray() == pytest.approx(by_rows.featureImportances.toArray(), abs=0.02)


def test_bags_draw_each_row_once_on_average(spark):
    df = _repeated_rows(spark).withColumnRenamed("resolution_hours", "label")
    bags = models._bags(df, ["a", "b"], 20, 7)
    sums = [row.n for row in bags.groupBy("tree").agg(F.sum("rows").alias("n")).collect()]
    assert len(sums) == 20 and all(abs(n - 2000) < 5 * 2000 ** 0.5 for n in sums)
    assert bags.exceptAll(models._bags(df, ["a", "b"], 20, 7)).isEmpty()


def test_estimates_by_combination_equal_those_of_rows(spark):
    df, names = _repeated_rows(spark), ["a", "b"]
    model = models.train_resolution_model(df.limit(200), feature_names=names, **SMALL).pipeline_model
    twice = df.unionByName(df.limit(3))
    columns = [*df.columns, "forest_hours", "boosted_hours", "ensemble_hours"]
    by_rows, by_cells = model.transform(twice).select(columns), models._transformed(model, twice, names).select(columns)
    assert by_rows.exceptAll(by_cells).isEmpty() and by_cells.exceptAll(by_rows).isEmpty()


def test_split_is_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "number")
    one = rows_by(models.split_train_test(df.repartition(1)), "number")
    many = rows_by(models.split_train_test(df.repartition(7)), "number")
    assert one == many
    assert 750 < sum(r["part"] == "train" for r in one.values()) < 850


def test_regression_report(spark):
    scored = spark.createDataFrame([(1.0, 1.0, 3.0), (3.0, 3.0, 3.0), (5.0, 5.0, 3.0)],
                                   "y double, good double, flat double")
    rows = rows_by(models.regression_report(
        scored, label="y", predictions={"good": "good", "flat": "flat"}), "model")
    assert (rows["good"]["mae_hours"], rows["good"]["r2_score"]) == (0, 1)
    assert rows["flat"]["mae_hours"] == pytest.approx(4 / 3)
    assert rows["flat"]["rmse_hours"] == pytest.approx((8 / 3) ** 0.5) and rows["flat"]["r2_score"] == 0


def test_classification_report(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "a")] * 2
    df = spark.createDataFrame(pairs, "truth string, guess string")
    rows = rows_by(models.classification_report(df, label="truth", prediction="guess"), "class")
    assert (rows["a"]["precision"], rows["a"]["recall"], rows["a"]["support"]) == (0.6, 0.75, 4)
    assert (rows["c"]["precision"], rows["c"]["recall"], rows["c"]["f1"]) == (0, 0, 0)
    assert rows["accuracy"]["f1"] == 5 / 8
    assert rows["macro avg"]["recall"] == pytest.approx((0.75 + 1 + 0) / 3)
    assert rows["weighted avg"]["recall"] == pytest.approx((0.75 * 4 + 2) / 8)


def triage_rows(spark, n=120):
    words = "CASE id % 3 WHEN 0 THEN 'login crash traceback' WHEN 1 THEN 'dark mode wish' ELSE 'docs typo' END"
    numbers = [f"CAST((id * {i + 3}) % 7 AS double) AS {name}" for i, name in enumerate(TRIAGE_FEATURES)]
    return spark.range(n).selectExpr(
        "id AS number", f"{words} AS feature_text", *numbers,
        "CASE id % 3 WHEN 0 THEN 'Critical' WHEN 1 THEN 'Low' ELSE 'Medium' END AS urgency")


def test_priority_model(spark, tmp_path):
    rows = triage_rows(spark)
    model = models.train_priority_model(rows, stop_words=["the"], trees=20, max_depth=5)
    report = rows_by(model.report, "class")
    assert report["accuracy"]["f1"] > 0.9
    top = models.priority_importance(model).collect()
    assert len(top) == 10 and {"login", "crash", "mode", "typo"} & {r.feature for r in top}
    models.save_priority_model(model, str(tmp_path))
    again = models.load_priority_model(spark, str(tmp_path))
    timeline = spark.createDataFrame(
        [(1, "Login", "crash traceback", "u", ["bug"], 3, 4, 2, 1.0)],
        "number bigint, title string, text string, url string, labels array<string>, "
        "num_comments bigint, num_events bigint, num_participants bigint, first_response_hours double")
    one, two = (models.predict_priority(m, timeline).first() for m in (model, again))
    assert one == two and one.predicted_priority == "Critical"
    assert 0 < one.priority_confidence <= 100 and one.complexity_score == 15
    assert again.feature_names == model.feature_names
    with pytest.raises(models.NotEnoughRows):
        models.train_priority_model(rows.limit(0), stop_words=[])


def test_forest_of_many_rows_is_fitted_in_parts(spark, monkeypatch, tmp_path):
    """Few partitions for each part of the trees, all trees in one forest, and the whole rule as well learnt."""
    from pyspark.ml.classification import RandomForestClassifier

    fit, passed = RandomForestClassifier.fit, []
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, rows: passed.append(
        (self.getNumTrees(), self.getSeed(), rows.rdd.getNumPartitions())) or fit(self, rows))
    rows = triage_rows(spark, 400).repartition(8)
    whole = models.train_priority_model(rows, stop_words=["the"], trees=20, max_depth=5)
    assert [trees for trees, _, _ in passed] == [20]  # few rows: one fit
    passed.clear()
    monkeypatch.setattr(models, "FITTED_WHOLE", 100)
    model = models.train_priority_model(rows, stop_words=["the"], trees=20, max_depth=5)
    assert sorted(trees for trees, _, _ in passed) == [2] * 4 + [3] * 4
    assert len({seed for _, seed, _ in passed}) == 8 and {tasks for _, _, tasks in passed} == {1}
    one, two = whole.classifier.stages[0], model.classifier.stages[0]
    assert two.getNumTrees == 20 and len({tree.toDebugString.split("\n", 1)[1] for tree in two.trees}) > 10
    assert (two.numFeatures, two.numClasses) == (one.numFeatures, one.numClasses)
    params = lambda f: {p.name: f.getOrDefault(p) for p in f.params if f.isDefined(p)}
    assert params(two) == params(one)
    assert rows_by(model.report, "class")["accuracy"]["f1"] > 0.9
    models.save_priority_model(model, str(tmp_path))
    again = models.load_priority_model(spark, str(tmp_path))
    assert again.classifier.stages[0].toDebugString == two.toDebugString


def test_forest_is_saved_tree_by_tree(spark, tmp_path):
    """No job gets all nodes from the driver; the loaded forest is the saved one, also over an older one."""
    for trees in (14, 12):
        model = models.train_priority_model(triage_rows(spark), stop_words=["the"], trees=trees, max_depth=4)
        models.save_priority_model(model, str(tmp_path))
    again = models.load_priority_model(spark, str(tmp_path))
    one, two = (m.classifier.stages[0] for m in (model, again))
    assert sorted(int(x.name) for x in (tmp_path / "classifier/trees").iterdir())[:12] == list(range(12))
    assert two.getNumTrees == 12 and two.treeWeights == one.treeWeights
    assert one.toDebugString == two.toDebugString and one.featureImportances == two.featureImportances
    assert {p.name: two.getOrDefault(p) for p in two.params if two.isDefined(p)} == {
        p.name: one.getOrDefault(p) for p in one.params if one.isDefined(p)}


def test_matrix_agrees_with_long_form(spark):
    rows = triage_rows(spark, 30)
    matrix = rows_by(models.triage_matrix(rows, stop_words=["the"]), "number")
    weights = similarity.tfidf(rows, stop_words=["the"]).collect()
    terms = similarity.vocabulary(similarity.terms(rows, stop_words=["the"])).collect()
    place = {r.term: i for i, r in enumerate(terms)}
    for row in weights:
        assert matrix[row.number]["text_vector"][place[row.term]] == pytest.approx(row.weight)
    width = len(place) + len(TRIAGE_FEATURES)
    assert {r["features"].size for r in matrix.values()} == {width}
    columns = [[r["numbers"][i] for r in matrix.values()] for i in range(len(TRIAGE_FEATURES))]
    assert all(sum(c) == pytest.approx(0, abs=1e-9) for c in columns)


def test_fitted_models_follow_their_tables(spark, tmp_path):
    """A query fits again once a table it reads has changed."""
    from tracklens.plans import queries

    for table in ("orders", "lineitem"):
        spark.range(5).write.parquet(f"{tmp_path}/{table}.parquet")
    calls = []
    fit = lambda: calls.append(1) or len(calls)
    ask = lambda: queries._fitted("test", spark, str(tmp_path), ("orders", "lineitem"), fit)
    assert [ask(), ask()] == [1, 1]
    spark.range(3).write.mode("append").parquet(f"{tmp_path}/lineitem.parquet")
    assert [ask(), ask()] == [2, 2]
