"""Trees, comparison and oversampling at a small size; naive Bayes and loads on odd input."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from skylane.operators import bayes, clean, joins, metrics, sampling, smote, trees
from skylane.plans import compare, scoring, training
from skylane.plans import features as feats
from skylane.sources.tables import read_parquet, read_table


def test_search_samples_five_models_as_given(spark):
    cands = trees.sample_grid(5)
    assert len({tuple(sorted(c.items())) for c in cands}) == 5
    for c in cands:
        m = trees.classifier("y", c)
        assert m.getMaxIter() == c["n_estimators"] in (800, 1500, 2000)
        assert m.getMaxDepth() == c["max_depth"] in (10, 15)
        assert m.getStepSize() == c["learning_rate"] and m.getMinInstancesPerNode() == 30
    assert len({(c["n_estimators"], c["max_depth"], c["learning_rate"]) for c in cands}) == 5
    s = trees.classifier("y", compare.SCREENING)
    assert (s.getMaxIter(), s.getMaxDepth(), s.getStepSize()) == (1000, 15, 0.1)


@pytest.fixture(scope="module")
def points(spark):
    rows = [(f"r{i}", float(i % 10), float((i * 7) % 13), int(i % 10 > 6)) for i in range(200)]
    return spark.createDataFrame(rows, "ROW_ID string, a double, b double, y int")


def test_tree_search_runs_and_models_are_stored(spark, points, tmp_path):
    grid = {**trees.TREE_GRID, "n_estimators": [2, 3], "max_depth": [2], "learning_rate": [0.1], "min_child_samples": [1]}
    res, model = trees.tree_search(sampling.kfold(points, 2), ["a", "b"], "y", n_candidates=2, grid=grid)
    rows = res.collect()
    assert sorted(r["max_iter"] for r in rows) == [2, 3] and all(r["cv_f1"] > 0.9 for r in rows)
    trees.save_trees(model, str(tmp_path / "m"))
    back = trees.load_trees(str(tmp_path / "m"))
    a = trees.tree_scores(model, points, ["a", "b"]).select("ROW_ID", "PROBA").collect()
    assert a == trees.tree_scores(back, points, ["a", "b"]).select("ROW_ID", "PROBA").collect()
    report = compare.screening_report(model, points.select("ROW_ID", "a", "b", "y").withColumnRenamed("y", compare.LABEL), ["a", "b"]).first()
    assert report["accuracy"] > 0.9 and report["hard_label_auc"] > 0.9


def test_two_variants_are_compared(spark, tmp_path):
    rep = compare.compare_variants(spark, SF0001, ["all_features", "top15_tree_importance"], {"n_estimators": 2, "max_depth": 2}, str(tmp_path))
    rows = rep.collect()
    assert [r["rank"] for r in rows] == [1, 2] and rows[0]["f1"] >= rows[1]["f1"]
    for r in rows:
        assert abs(r["train_f1"] - r["f1"]) == pytest.approx(r["gap_f1"]) and len(r["features"]) == r["n_features"]
        assert r["sensitivity"] == pytest.approx(r["recall"])
    best = {r["metric"]: r for r in compare.best_of_all(rep).collect()}
    assert set(best) == {"f1", "roc_auc", "recall", "precision", "training_time"}
    assert best["f1"]["best_variant"] == rows[0]["variant"]
    assert best["training_time"]["value"] == min(r["training_time"] for r in rows)
    roc = scoring.read_metrics(spark, f"{tmp_path}/roc", "threshold double, fpr double, tpr double, variant string")
    assert roc.where(F.col("threshold") == math.inf).count() == 2


def test_nb_fold_without_a_class(spark):
    rows = [(0, 1.0 + i / 10, 1) for i in range(5)] + [(1, i / 10, 0) for i in range(10)]
    df = spark.createDataFrame(rows, "FOLD int, x double, y int")
    got = {r["FOLD"]: r for r in bayes.cv_fold_counts(df, ["x"], "y", [1e-9]).collect()}
    # fold 0 trains on class 0 alone and fold 1 on class 1 alone: each predicts what it has seen
    assert (got[0]["fn"], got[0]["tp"]) == (5, 0) and (got[1]["fp"], got[1]["tn"]) == (10, 0)


def test_nb_constant_features_have_no_scores(spark):
    df = spark.createDataFrame([("a", 1.0, 0), ("b", 1.0, 1), ("c", 1.0, 1)], "ROW_ID string, x double, y int")
    m = bayes.fit_gaussian_nb(df, ["x"], "y")
    assert {(r["PROBA"], r["PREDICTION"]) for r in m.transform(df).collect()} == {(None, None)}
    cv = bayes.cv_f1(df.withColumn("FOLD", F.lit(0)).union(df.withColumn("FOLD", F.lit(1))), ["x"], "y").first()
    assert cv["cv_mean"] == 0.0


def test_nb_one_class_is_certain(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1)], "x double, y int")
    m = bayes.fit_gaussian_nb(df, ["x"], "y")
    assert {(r["PROBA"], r["PREDICTION"]) for r in m.transform(df).collect()} == {(1.0, 1)}


def test_nan_is_missing_on_every_load(spark, tmp_path):
    nan = float("nan")
    df = spark.createDataFrame([(i, float(i), float(i)) for i in range(20)] + [(20, nan, nan)], "i int, value double, f double").withColumn("f", F.col("f").cast("float"))
    df.write.parquet(f"{tmp_path}/events.parquet")
    clean_, raw = read_table(spark, str(tmp_path), "events"), read_table(spark, str(tmp_path), "events", raw=True)
    assert clean_.where("value is null and f is null").count() == 1
    assert read_parquet(spark, f"{tmp_path}/events.parquet").where("value is null").count() == 1
    for x in (clean_, raw):
        assert clean.sigma_filter(x, "value", 3.0).count() == 20
        assert clean.quantile_filter(x, "value").count() == 20
        assert clean.zscore_filter(x, "value", 3.0).count() == 20
        assert feats.label_target(x, "value").agg(F.sum("value")).first()[0] == 5


def test_stored_scorer_scores_like_the_fitted_one(spark, tmp_path):
    sfe = training.split_features(spark, SF0001, persist=False)
    model = bayes.fit_gaussian_nb(sfe.train, feats.KEEP_FEATURES, feats.LABEL_COL)
    model.save(spark, f"{tmp_path}/model")
    sfe.fitted.save(spark, f"{tmp_path}/features")
    m, f = scoring.load_scorer(spark, str(tmp_path))
    assert m == model and f.scalers == sfe.fitted.scalers and f.categories == sfe.fitted.categories
    raw = training.cleaned_labelled(spark, SF0001)
    a = scoring.score_batch(raw, m, f).select("ROW_ID", "PROBA")
    b = scoring.score_batch(raw, model, sfe.fitted).select("ROW_ID", "PROBA")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_every_smaller_class_grows(spark):
    rows = [(f"{c}-{i}", float(i), float(i * c % 7), c) for c, n in ((0, 30), (1, 20), (2, 10)) for i in range(n)]
    df = spark.createDataFrame(rows, "ROW_ID string, a double, b double, y int")
    for out in (sampling.random_oversample(df, "y"), smote.smote(df, ["a", "b"], "y", k=3)):
        assert sampling.class_counts(out, "y") == {0: 30, 1: 30, 2: 30}
        assert out.select("ROW_ID").distinct().count() == 90
    with pytest.raises(ValueError):
        sampling.random_oversample(df, "y", ratio=0.5)
    one = df.where("y = 0 or ROW_ID = '1-0'")
    with pytest.raises(ValueError):
        smote.smote(one, ["a", "b"], "y")
    with pytest.raises(ValueError):
        sampling.random_oversample(df.where("y = 0"), "y")


def test_draws_reach_past_32_bits(spark):
    big = spark.range(2000).select(F.pmod(sampling.hash_int(sampling.hash_hex("s", F.col("id"))), F.lit(10**13)).alias("x"))
    assert big.where(F.col("x") > 2**32).count() > 1900


def test_auc_and_curve_do_not_depend_on_buckets(spark):
    rows = [(i * 37 % 101 / 101, int((i * i) % 7 < 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "p double, y int")
    want = metrics.roc_auc(df, "y", "p", ranges=2).first()[0]
    assert metrics.roc_auc(df, "y", "p", ranges=50).first()[0] == pytest.approx(want)
    assert metrics.roc_auc(df, "y", "p").first()[0] == pytest.approx(want)
    curves = [sorted(map(tuple, metrics.roc_curve(df, "y", "p", ranges=b).collect())) for b in (2, 50, None)]
    assert curves[0] == curves[1] == curves[2]


def test_fold_and_split_sizes(spark):
    df = spark.range(1003).select(F.col("id").cast("string").alias("ROW_ID"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    sizes = [r["count"] for r in sampling.kfold(df).groupBy("FOLD").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    s = sampling.stratified_split(df, "y").groupBy("y").agg(F.sum("IS_TEST").alias("t"), F.count("*").alias("n")).collect()
    assert all(r["t"] == math.floor(0.3 * r["n"] + 0.5) for r in s)
    # a cut among copies of one id parts them
    many = df.union(df.where("ROW_ID = '7'").crossJoin(spark.range(900)).select("ROW_ID", "y"))
    sizes = [r["count"] for r in sampling.kfold(many).groupBy("FOLD").count().collect()]
    assert len(sizes) == 5 and sum(sizes) == 1903 and max(sizes) - min(sizes) <= 1


def test_broadcast_limit_counts_bytes(spark):
    dim = spark.range(100).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
    fact = spark.range(1000).select((F.col("id") % 100).alias("k"))
    p = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in p(joins.lookup_join(fact, dim, ["k"]))
    salted = joins.lookup_join(fact, dim, ["k"], max_broadcast_bytes=100)
    assert "broadcast" not in p(salted) and salted.count() == 1000


def test_a_publication_that_breaks_off_leaves_the_former_model(spark, tmp_path):
    from skylane.plans import scoring

    root = str(tmp_path / "models")
    table = lambda x: spark.createDataFrame([(x,)], "x int").coalesce(1).write

    def version(x, broken=False):
        def write(folder):
            table(x).parquet(f"{folder}/model")
            if broken:
                raise RuntimeError("lost")
            table(x).parquet(f"{folder}/features")

        return write

    assert scoring.published(spark, root) == []
    with pytest.raises(FileNotFoundError):
        scoring.load_published(spark, root)
    first = scoring.publish(spark, root, version(1))
    with pytest.raises(RuntimeError):
        scoring.publish(spark, root, version(2, broken=True))
    assert scoring.published(spark, root) == [first]
    # a manifest without its committed file names nothing either
    (tmp_path / "models" / "manifest" / "99999-x" / "_temporary").mkdir(parents=True)
    assert scoring.published(spark, root) == [first]
    second, third = (scoring.publish(spark, root, version(x)) for x in (3, 4))
    assert scoring.published(spark, root) == [second, third]
    assert not (tmp_path / "models" / "versions" / first.rsplit("/", 1)[1]).exists()
    assert spark.read.parquet(f"{third}/model").first().x == 4


def test_ranked_variants_share_one_split(spark, monkeypatch):
    """Both ranked variants come from one split and feature fit, and neither leaves a training table behind."""
    from skylane.plans import catalog, compare

    made, held = [], []
    split, release = training.split_features, compare.FoldedTrain.release
    monkeypatch.setattr(training, "split_features", lambda *a, **k: made.append(1) or split(*a, **k))
    monkeypatch.setattr(compare.FoldedTrain, "release", lambda self: held.append(self) or release(self))
    rows = catalog.REGISTRY["rank_variants"](spark, SF0001).collect()
    assert sorted(r["variant"] for r in rows) == ["all_features", "random_oversample"]
    assert len(made) == 1 and len({id(x) for x in held}) == 2


class Asked(Exception):
    """Ends a query once it has asked for its work."""


def recorder(asked):
    def call(*args, **kwargs):
        asked.append(kwargs)
        raise Asked
    return call


@pytest.mark.parametrize("name", ["tree_search", "tree_importance", "tree_metrics"])
def test_tree_queries_search_the_whole_grid(spark, monkeypatch, points, name):
    """The registered queries search the library's grid, none of their own."""
    from skylane.plans import catalog

    asked = []
    monkeypatch.setattr(catalog, "_nb_inputs", lambda *a, **k: (points, points, ["a", "b"]))
    monkeypatch.setattr(trees, "tree_search", recorder(asked))
    with pytest.raises(Asked):
        catalog.REGISTRY[name](spark, SF0001)
    assert asked[0].get("n_candidates", 5) == 5 and asked[0].get("grid", trees.TREE_GRID) == trees.TREE_GRID
    assert trees.TREE_GRID["n_estimators"] == [800, 1500, 2000] and trees.TREE_GRID["max_depth"] == [10, 15]


@pytest.mark.parametrize("name", ["compare_variants", "best_by_metric"])
def test_comparison_queries_screen_with_the_whole_trees(spark, monkeypatch, points, name):
    """The screening variant is fitted with all its trees at their full depth."""
    from skylane.plans import catalog

    asked = []
    monkeypatch.setattr(compare, "_variant_inputs", lambda *a: (points, points, ["a", "b"]))
    monkeypatch.setattr(compare.compare_variants, "__defaults__", (["top15_tree_importance"], *compare.compare_variants.__defaults__[1:]))
    monkeypatch.setattr(trees, "fit_trees", recorder(asked))
    with pytest.raises(Asked):
        catalog.REGISTRY[name](spark, SF0001)
    assert asked[0]["params"] == {"n_estimators": 1000, "learning_rate": 0.1, "max_depth": 15}
