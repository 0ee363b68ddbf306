import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.operators import evaluation, training
from loanloom.operators import quality as q
from loanloom.operators.ranking import ranking_metrics
from loanloom.plans import modelling
from loanloom.session import cut_lineage
from loanloom.sources import stores


@pytest.fixture(scope="module")
def loans(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        risk = rng.gauss(0, 1)
        y = int(risk + rng.gauss(0, 0.7) > 1.0)
        rows.append(
            (i, y, risk, rng.gauss(0, 1), rng.choice("MF"), -rng.randrange(7300, 25000))
        )
    df = spark.createDataFrame(
        rows,
        "SK_ID_CURR int, TARGET int, risk double, noise double, CODE_GENDER string, DAYS_BIRTH int",
    )
    return cut_lineage(df)


@pytest.fixture(scope="module")
def fitted(loans):
    return training.fit_model(loans, training.LOGISTIC, "TARGET", None, ["SK_ID_CURR"])


def test_balanced_weights_sum_to_the_rows(loans):
    counts = training.class_counts(loans, "TARGET")
    weighed = training.balanced_weight(loans, "TARGET", counts)
    sums = {r["TARGET"]: r["w"] for r in weighed.groupBy("TARGET").agg(F.sum("_weight").alias("w")).collect()}
    assert sums[0] == pytest.approx(200.0) and sums[1] == pytest.approx(200.0)


def test_logistic_solves_the_penalised_problem(loans, fitted):
    """At the optimum the gradient of C·Σ w·loss + ½|b|² is zero."""
    counts = training.class_counts(loans, "TARGET")
    model = evaluation._classifier(fitted)
    rows = training.balanced_weight(
        evaluation.prepared(fitted, loans), "TARGET", counts
    ).collect()
    coef = model.coefficients.toArray()
    gradient = coef.copy()
    for r in rows:
        x = r["features"].toArray()
        p = 1 / (1 + 2.718281828459045 ** -(x @ coef + model.intercept))
        gradient += r["_weight"] * (p - r["TARGET"]) * x
    assert abs(gradient).max() < 1e-2


def test_cross_validation_scores_every_row_once(loans):
    found = training.cross_validate(loans, training.LOGISTIC, "SK_ID_CURR", "TARGET", 3)
    assert found.scores.count() == 400
    assert found.scores.select("SK_ID_CURR").distinct().count() == 400
    folds = found.folds.collect()
    assert len(folds) == 3 and sum(r["size"] for r in folds) == 400
    summary = found.summary.first()
    assert summary["auc_pr_mean"] == pytest.approx(sum(r["auc_pr"] for r in folds) / 3)
    assert summary["auc_roc_mean"] > 0.8


def test_one_class_cannot_be_fitted(loans):
    with pytest.raises(ValueError, match="both classes"):
        training.class_counts(loans.where("TARGET = 0"), "TARGET")


def test_draws_are_repeatable_and_in_range():
    a = training.draw_trials(training.BOOSTED, 20, 42)
    assert a == training.draw_trials(training.BOOSTED, 20, 42)
    assert a != training.draw_trials(training.BOOSTED, 20, 43)
    assert all(0.01 <= t["stepSize"] <= 0.3 and 100 <= t["maxIter"] <= 1000 for t in a)
    b = training.draw_trials(training.FOREST, 20, 42)
    assert all(3 <= t["maxDepth"] <= 10 for t in b)


def test_first_family_wins_a_tie():
    one = [training.Trial("boosted", {}, 0.5)]
    two = [training.Trial("forest", {}, 0.5)]
    assert training.pick_champion(one, two).family == "boosted"
    assert training.pick_champion(one, [training.Trial("forest", {}, 0.6)]).family == "forest"


def test_boosted_model_begins_with_the_smaller_one(loans):
    """What lets trials be compared with few trees first."""
    (fold, *_) = training.prepare_folds(loans, "SK_ID_CURR", "TARGET", 2)
    rows = training.positive_weight(fold.train, "TARGET", fold.counts)
    params = {"maxDepth": 3, "stepSize": 0.1, "subsamplingRate": 0.7, "featureSubsetStrategy": "0.6"}
    few, more = (
        training.BOOSTED.build("TARGET", fold.counts, {**params, "maxIter": n}).fit(rows) for n in (3, 6)
    )
    assert [t.toDebugString.split("\n", 1)[1] for t in few.trees] == [
        t.toDebugString.split("\n", 1)[1] for t in more.trees[:3]
    ]


def test_prepared_folds_hold_every_row_once(loans):
    folds = training.prepare_folds(loans, "SK_ID_CURR", "TARGET", 3)
    ids = [r["SK_ID_CURR"] for f in folds for r in f.valid.select("SK_ID_CURR").collect()]
    assert sorted(ids) == list(range(400))
    for f in folds:
        assert f.train.count() == f.counts.rows == 400 - f.valid.count()
        assert f.train.where("TARGET = 1").count() == f.counts.positives


def test_training_rows_of_all_folds_share_one_table(loans):
    """Each row's vector is stored once, in the fold that leaves it out."""
    folds = training.prepare_folds(loans, "SK_ID_CURR", "TARGET", 3)
    (first, *others) = [set(f.train.inputFiles()) for f in folds]
    assert all(files == first for files in others)
    held = [set(f.valid.inputFiles()) for f in folds]
    assert not held[0] & held[1] and not held[0] & first


def test_a_tree_fit_has_no_more_partitions_than_cores(spark, loans):
    """What a level of a tree moves must not grow with the partitions of the input."""
    cores = spark.sparkContext.defaultParallelism
    seen = []

    class Watched:
        def __init__(self, inner):
            self.inner = inner

        def fit(self, rows):
            seen.append(rows.rdd.getNumPartitions())
            return self.inner.fit(rows)

    forest = replace(training.FOREST, build=lambda *a: Watched(training.FOREST.build(*a)))
    split = cut_lineage(loans.repartition(4 * cores))
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))  # a partition a file
    try:
        params = {"numTrees": 2, "maxDepth": 2, "subsamplingRate": 0.8}
        training.fit_model(split, forest, "TARGET", params, ["SK_ID_CURR"])
        folds = training.prepare_folds(split, "SK_ID_CURR", "TARGET", 2)
        training.staged_search(folds, forest, [params], "TARGET", rungs=(2,))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(seen) == 3 and max(seen) <= cores


def test_fits_and_kept_vectors_follow_the_memory(spark, loans, monkeypatch):
    """What fits read at each level of each tree stays in memory, however large the
    input: fewer of them run at a time, and the vectors that they came from make room."""
    running, most, levels = [], [], []

    class Watched:
        def __init__(self, inner):
            self.inner = inner

        def fit(self, rows):
            running.append(self)
            most.append(len(running))
            level = rows.storageLevel
            levels.append((level.useMemory, level.useDisk))
            try:
                return self.inner.fit(rows)
            finally:
                running.remove(self)

    forest = replace(training.FOREST, build=lambda *a: Watched(training.FOREST.build(*a)))
    params = {"numTrees": 3, "maxDepth": 2, "subsamplingRate": 0.8}
    folds = training.prepare_folds(loans, "SK_ID_CURR", "TARGET", 3)
    scores = []
    # a third of the rows and half a kilobyte a row: room for less than one fit, or for all
    for memory in (100_000, 1 << 40):
        monkeypatch.setattr(training, "storage_bytes", lambda spark, m=memory: m, raising=False)
        (trial,) = training.staged_search(folds, forest, [params], "TARGET", rungs=(3,))
        training.fit_model(loans, forest, "TARGET", params, ["SK_ID_CURR"])
        scores.append(trial.folds)
    assert scores[0] == pytest.approx(scores[1])
    assert most[:4] == [1, 1, 1, 1] and max(most[4:]) > 1
    assert levels == [(False, True)] * 4 + [(True, True)] * 4


def test_memory_for_kept_rows_is_known(spark):
    assert 0 < training.storage_bytes(spark) <= spark._jvm.Runtime.getRuntime().maxMemory()


def test_search_goes_on_with_the_better_trials(loans, monkeypatch):
    """Scores by rule, so that the course of the search is known."""
    asked = []

    def scored(folds, family, candidates, label, parallelism):
        asked.append({i: p[family.trees] for i, p in candidates.items()})
        gain = {10: 0.0, 30: 0.1, 100: 0.2, 300: 0.2, 700: 0.3}
        return {i: [i / 100 + gain[p[family.trees]], i / 100 + gain[p[family.trees]]] for i, p in candidates.items()}

    monkeypatch.setattr(training, "fold_scores", scored)
    folds = training.prepare_folds(loans, "SK_ID_CURR", "TARGET", 2)
    drawn = [{"maxIter": n} for n in (700, 700, 700, 700, 700, 700, 700, 30, 700)]
    found = training.staged_search(folds, training.BOOSTED, drawn, "TARGET")
    assert [len(a) for a in asked] == [9, 3, 1, 1]
    # trial 7 has no more trees to try at 30, trial 8 nothing to gain at 300
    assert asked[1] == {6: 30, 7: 30, 8: 30} and asked[3] == {8: 300}
    best = found[0]
    assert best.params == {"maxIter": 100} and best.drawn == 700
    assert best.auc_pr == pytest.approx(0.28) and best.rungs[300] == pytest.approx(0.28)
    assert best.folds == pytest.approx([0.28, 0.28])


def test_scores_of_a_search_are_those_of_single_fits(loans):
    folds = training.prepare_folds(loans, "SK_ID_CURR", "TARGET", 2)
    params = {"maxDepth": 2, "numTrees": 5, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.5"}
    (trial,) = training.staged_search(folds, training.FOREST, [params], "TARGET", rungs=(3, 5))
    assert set(trial.rungs) <= {3, 5} and trial.auc_pr == max(trial.rungs.values())
    for f, score in zip(folds, trial.folds, strict=True):
        rows = training.positive_weight(f.train, "TARGET", f.counts)
        model = training.FOREST.build("TARGET", f.counts, trial.params).fit(rows)
        alone = ranking_metrics(training.PositiveScore().transform(model.transform(f.valid)), "score", "TARGET")
        assert alone.first()["average_precision"] == pytest.approx(score)
    assert trial.auc_pr == pytest.approx(sum(trial.folds) / 2)


def test_champion_is_stored_with_its_preparation(spark, loans, tmp_path):
    run = modelling.train_champion(
        loans,
        trials=1,
        folds=2,
        ranges={"boosted": {"trees": (2, 3)}, "forest": {"trees": (3, 4)}},
        store=str(tmp_path / "store"),
        run_log=str(tmp_path / "runs"),
        name="best-trees",
    )
    assert run.version == 1 and len(run.trials) == 2
    assert run.champion.auc_pr == max(t.auc_pr for t in run.trials)
    loaded = stores.load_registered(spark, str(tmp_path / "store"), "best-trees")
    out = loaded.transform(loans.drop("TARGET"))
    both = out.select("SK_ID_CURR", F.round("score", 9).alias("s")).exceptAll(
        run.model.transform(loans).select("SK_ID_CURR", F.round("score", 9).alias("s"))
    )
    assert both.isEmpty()
    again = stores.register_model(run.model, str(tmp_path / "store"), "best-trees", "x", spark)
    assert again == 2
    log = stores.read_runs(spark, str(tmp_path / "runs"))
    assert log.where("kind = 'metric' and name = 'cv_auc_pr'").count() == 1
    with pytest.raises(FileNotFoundError):
        stores.load_registered(spark, str(tmp_path / "store"), "other")


def test_baseline_run(spark, loans, tmp_path):
    run = modelling.train_baseline(loans, folds=2, run_log=str(tmp_path / "runs"))
    assert set(run.summary) == {
        f"{m}_{s}" for m in ("auc_pr", "auc_roc", "f1", "precision", "recall") for s in ("mean", "std")
    }
    counts = run.confusion.first()
    assert sum(counts) == 400
    assert run.curve.where("threshold is null").count() == 1
    assert stores.read_runs(spark, str(tmp_path / "runs")).where("kind = 'param'").count() == 2


def test_calibration_is_monotone_and_keeps_the_mean(loans, fitted):
    scored = fitted.transform(loans)
    model = evaluation.fit_calibration(scored, "score", "TARGET")
    out = model.transform(scored).orderBy("score").select(evaluation.CALIBRATED, "TARGET").collect()
    values = [r[0] for r in out]
    assert values == sorted(values)
    assert sum(values) == pytest.approx(sum(r["TARGET"] for r in out))


def test_merged_scores_calibrate_like_single_rows(spark):
    from pyspark.ml.regression import IsotonicRegression

    rng = random.Random(4)
    df = spark.createDataFrame(
        [(rng.randrange(8) / 8, int(rng.random() < 0.5)) for _ in range(200)], "p double, y int"
    )
    merged = evaluation.fit_calibration(df, "p", "y")
    plain = IsotonicRegression(featuresCol="p", labelCol="y").fit(df)
    for x in (0.0, 0.2, 0.5, 0.9):
        assert merged.predict(x) == pytest.approx(plain.predict(x))


def test_subgroups(spark):
    # 365.25 days to the year: 29.99, 30, 50 years
    days = [-int(29.99 * 365.25), -int(30 * 365.25) - 1, -int(50 * 365.25) - 1]
    df = spark.createDataFrame(
        [(0.1, 0, days[0], "M"), (0.9, 1, days[1], "F"), (0.4, 0, days[1], "XNA"), (0.3, 1, days[2], "F")],
        "p double, y int, DAYS_BIRTH int, CODE_GENDER string",
    )
    out = {
        (r["group"], r["category"]): r
        for r in evaluation.subgroup_metrics(df, "p", "y", evaluation.default_subgroups(df)).collect()
    }
    assert {k: r["size"] for k, r in out.items()} == {
        ("Gender", "M"): 1,
        ("Gender", "F"): 2,
        ("Age", "Young (<30)"): 1,
        ("Age", "Middle (30-50)"): 2,
        ("Age", "Senior (>=50)"): 1,
    }
    assert out[("Age", "Middle (30-50)")]["roc_auc"] == 1.0
    assert out[("Gender", "F")]["roc_auc"] is None


def test_risk_is_the_top_attribution(loans, fitted):
    top = evaluation.top_attributions(fitted, loans, "SK_ID_CURR", "TARGET", 2)
    assert top.first()["feature"] == "num__risk"
    small = {"maxIter": 3, "maxDepth": 2}
    trees = training.fit_model(loans, training.BOOSTED, "TARGET", small, ["SK_ID_CURR"])
    top = evaluation.top_attributions(trees, loans, "SK_ID_CURR", "TARGET", 2)
    assert top.first()["feature"] == "num__risk"


def test_contributions_add_up_to_the_margin(loans, fitted):
    import numpy as np

    model = evaluation._classifier(fitted)
    parts = evaluation.linear_contributions(fitted, loans, "SK_ID_CURR")
    total = {r[0]: r[1] for r in parts.groupBy("SK_ID_CURR").agg(F.sum("contribution")).collect()}
    rows = fitted.transform(loans).select("SK_ID_CURR", "rawPrediction").collect()
    margins = {r[0]: r[1][1] for r in rows}
    mean = np.mean(list(margins.values()))
    assert all(total[i] == pytest.approx(margins[i] - mean, abs=1e-6) for i in margins)
    assert model.numClasses == 2


def test_permuted_rows_are_scored_once_in_many_tasks(loans, monkeypatch):
    model = training.fit_model(
        loans, training.FOREST, "TARGET", {"numTrees": 3, "maxDepth": 2}, ["SK_ID_CURR"]
    )
    judged = []

    def watched(rows, *rest):
        judged.append(rows)
        return ranking_metrics(rows, *rest)

    monkeypatch.setattr(evaluation, "ranking_metrics", watched)
    evaluation.permutation_importance(model, loans, "SK_ID_CURR", "TARGET")
    (rows,) = judged
    assert "Window" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert len(rows.inputFiles()) > 1


def test_outcome_examples_show_three_rows(loans, fitted):
    out = evaluation.outcome_examples(fitted, loans, "SK_ID_CURR", "TARGET")
    assert {r["outcome"] for r in out.collect()} == {"TP", "TN", "FP"}
    assert out.select("SK_ID_CURR").distinct().count() == 3


def test_evaluation_uses_separate_rows(spark, loans, tmp_path):
    run = modelling.run_evaluation(loans, threshold_path=str(tmp_path / "threshold"))
    assert run.scores.count() == pytest.approx(80, abs=2)
    again = ranking_metrics(run.scores, evaluation.CALIBRATED, "TARGET").first()
    assert run.metrics["auc_pr"] == pytest.approx(again["average_precision"])
    assert run.sweep.count() == 99
    assert {r["kind"] for r in run.reliability.select("kind").distinct().collect()} == {"raw", "calibrated"}
    assert run.subgroups.where("`group` = 'Age'").count() >= 2
    record = spark.read.json(str(tmp_path / "threshold")).first()
    assert (record["fn_cost"], record["fp_cost"]) == (10, 1)
    assert record["optimal_threshold"] == run.metrics["threshold"]


def test_a_stored_model_can_be_evaluated(loans, fitted):
    run = modelling.run_evaluation(loans, model=fitted, shares=(0.5, 0.5, 0.0))
    assert run.scores.count() == 200
    assert run.metrics["auc_roc"] > 0.8
    assert run.subgroups.where("`group` = 'Gender'").count() == 2


def test_batch_scoring(loans, fitted):
    calibrator = evaluation.fit_calibration(fitted.transform(loans), "score", "TARGET")
    model = training.with_calibration(fitted, calibrator)
    contract = [q.ColumnRule("risk", T.DoubleType(), rules=[q.in_range(-2.0, 2.0)])]
    scored, rejected = evaluation.score_batch(model, loans.drop("TARGET"), "SK_ID_CURR", 0.2, contract)
    assert scored.columns == ["SK_ID_CURR", evaluation.CALIBRATED, "decision"]
    assert scored.count() + rejected.count() == 400 and rejected.count() > 0
    wrong = scored.where((F.col(evaluation.CALIBRATED) >= 0.2).cast("int") != F.col("decision"))
    assert wrong.isEmpty()


def test_evaluator_works_with_spark_model_selection(spark, loans):
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    counts = training.class_counts(loans, "TARGET")
    weighed = training.balanced_weight(loans, "TARGET", counts)
    chain = training.unfitted("TARGET", training.LOGISTIC, counts, {"maxIter": 5}, ["SK_ID_CURR"])
    search = CrossValidator(
        estimator=chain,
        estimatorParamMaps=ParamGridBuilder().build(),
        evaluator=training.AveragePrecisionEvaluator(),
        numFolds=2,
        seed=1,
    )
    assert search.fit(weighed).avgMetrics[0] > 0.5


def test_registered_tree_queries_run_with_the_defaults(spark, monkeypatch):
    """No query narrows the folds, trials or trees of its operator."""
    from loanloom.plans.catalog import model_queries

    calls = []

    class Stopped(Exception):
        pass

    def caught(*args, **options):
        calls.append((args, options))
        raise Stopped

    monkeypatch.setattr(model_queries, "applicants", lambda spark, folder: None)
    monkeypatch.setattr(modelling, "train_champion", caught)
    monkeypatch.setattr(training, "fit_model", caught)
    for run in (model_queries.boosted_champion, model_queries.permutation_top10):
        with pytest.raises(Stopped):
            run(spark, "")
    (champion, options), (fitted, more) = calls
    assert champion == (None, "SK_ID_CURR", "TARGET") and options == {"trials": model_queries.TRIALS}
    assert fitted[1] is training.BOOSTED and not fitted[3] and not more


def test_rows_of_an_evaluation_are_not_written_again(loans, monkeypatch):
    written, write = [], modelling.cut_lineage
    monkeypatch.setattr(modelling, "cut_lineage", lambda df: written.append(df.columns) or write(df))
    modelling.run_evaluation(loans)
    assert written and not any("risk" in columns for columns in written)


def test_a_sample_is_looked_for_once(loans, fitted, monkeypatch):
    from tests.conftest import plan_text

    read, explain = [], evaluation.linear_contributions
    monkeypatch.setattr(
        evaluation, "linear_contributions", lambda m, df, i: read.append(plan_text(df)) or explain(m, df, i)
    )
    evaluation.top_attributions(fitted, loans, "SK_ID_CURR", "TARGET", n_sample=50).collect()
    evaluation.outcome_examples(fitted, loans, "SK_ID_CURR", "TARGET", n_sample=50).collect()
    assert len(read) == 2 and not any("md5" in text for text in read)
