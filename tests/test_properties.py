
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from skylane.operators import bayes, metrics, sampling, smote
from skylane.plans import features as feats
from skylane.plans import training

LABEL = feats.LABEL_COL


@pytest.fixture(scope="module")
def sfe(spark):
    return training.split_features(spark, SF0001)


def test_split_shares(spark):
    lab = training.cleaned_labelled(spark, SF0001)
    s = sampling.stratified_split(lab, LABEL)
    for r in s.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n"), F.sum("IS_TEST").alias("t")).collect():
        assert abs(r["t"] - 0.3 * r["n"]) <= 1


def test_fold_sizes(sfe):
    sizes = [r["n"] for r in sampling.kfold(sfe.train).groupBy("FOLD").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_split_independent_of_partitioning(spark):
    lab = training.cleaned_labelled(spark, SF0001)
    ref = None
    for n in (1, 4, 16):
        got = sorted(r["ROW_ID"] for r in sampling.stratified_split(lab.repartition(n), LABEL).where("IS_TEST = 1").collect())
        ref = ref or got
        assert got == ref


def test_frequencies_sum_to_one(spark, sfe):
    total = sfe.fitted.frequency.agg(F.sum("FLIGHT_NUMBER_FREQ")).first()[0]
    assert total == pytest.approx(1.0)


def test_nb_matches_mllib_gaussian(spark, sfe):
    """At smoothing 1e-9 our model equals MLlib's gaussian naive Bayes."""
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    feat = list(feats.KEEP_FEATURES)
    ours = bayes.fit_gaussian_nb(sfe.train, feat, LABEL, 1e-9).transform(sfe.test).select("ROW_ID", "PROBA")
    va = VectorAssembler(inputCols=feat, outputCol="v")
    train = va.transform(sfe.train).withColumn("y", F.col(LABEL).cast("double"))
    m = NaiveBayes(modelType="gaussian", featuresCol="v", labelCol="y").fit(train)
    theirs = m.transform(va.transform(sfe.test)).select("ROW_ID", vector_to_array("probability")[1].alias("P"))
    diff = ours.join(theirs, "ROW_ID").select(F.max(F.abs(F.col("PROBA") - F.col("P")))).first()[0]
    assert diff < 1e-6


def test_auc_matches_evaluator(spark, sfe):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    feat = list(feats.KEEP_FEATURES)
    s = bayes.fit_gaussian_nb(sfe.train, feat, LABEL).transform(sfe.test).withColumn("y", F.col(LABEL).cast("double"))
    ours = metrics.roc_auc(s, LABEL, "PROBA").first()["roc_auc"]
    ev = BinaryClassificationEvaluator(rawPredictionCol="PROBA", labelCol="y", metricName="areaUnderROC", numBins=0)
    assert ours == pytest.approx(ev.evaluate(s), abs=1e-9)


def test_cv_merge_equals_direct_refit(spark, sfe):
    """Merged fold moments give the same F1 as refitting each fold directly."""
    feat = list(feats.KEEP_FEATURES)
    folded = sampling.kfold(sfe.train)
    merged = bayes.cv_f1(folded, feat, LABEL, [1e-5]).first()["cv_mean"]
    f1s = []
    for f in range(5):
        m = bayes.fit_gaussian_nb(folded.where(F.col("FOLD") != f), feat, LABEL, 1e-5)
        held = m.transform(folded.where(F.col("FOLD") == f))
        f1s.append(metrics.classification_metrics(held, LABEL, "PREDICTION").first()["f1"])
    assert merged == pytest.approx(float(np.mean(f1s)), abs=1e-12)


def test_random_oversample_balances(sfe):
    out = sampling.random_oversample(sfe.train, LABEL)
    counts = {r[LABEL]: r["n"] for r in out.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts[0] == counts[1]
    assert out.select("ROW_ID").distinct().count() == out.count()


def test_oversample_ratio_too_low_raises(sfe):
    with pytest.raises(ValueError):
        sampling.random_oversample(sfe.train, LABEL, ratio=0.01)


def test_smote_points_lie_between_parents(spark):
    rng = np.random.default_rng(1)
    pts = rng.normal(size=(60, 3))
    rows = [(f"m{i}", 1, *map(float, p)) for i, p in enumerate(pts)] + [(f"n{i}", 0, 0.0, 0.0, 0.0) for i in range(150)]
    df = spark.createDataFrame(rows, "ROW_ID string, y int, a double, b double, c double")
    out = smote.smote(df, ["a", "b", "c"], "y")
    synth = np.array([[r["a"], r["b"], r["c"]] for r in out.where(~F.col("ROW_ID").startswith("m") & (F.col("y") == 1)).collect()])
    assert len(synth) == 90
    # each synthetic point lies on a segment between a minority point and one of its 5 nearest neighbours
    d = ((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1)
    nn = np.argsort(d, axis=1)[:, 1:6]
    for s in synth:
        ok = False
        for i in range(len(pts)):
            for j in nn[i]:
                seg = pts[j] - pts[i]
                u = float(np.dot(s - pts[i], seg) / np.dot(seg, seg))
                if -1e-9 <= u <= 1 + 1e-9 and np.allclose(pts[i] + u * seg, s, atol=1e-9):
                    ok = True
                    break
            if ok:
                break
        assert ok


def test_smote_shared_basis_matches_standalone(spark):
    # the comparison shares one neighbour search between two ratios; rows must not change
    rng = np.random.default_rng(3)
    pts = rng.normal(size=(40, 2)).round(2)
    rows = [(f"m{i}", 1, *map(float, p)) for i, p in enumerate(pts)] + [(f"n{i}", 0, 1.0, 1.0) for i in range(200)]
    df = spark.createDataFrame(rows, "ROW_ID string, y int, a double, b double")
    basis = smote.smote_basis(df, ["a", "b"], "y")
    for ratio in (None, 0.5):
        alone = sorted(tuple(r) for r in smote.smote(df, ["a", "b"], "y", ratio=ratio).collect())
        shared = sorted(tuple(r) for r in smote.smote(df, ["a", "b"], "y", ratio=ratio, basis=basis).collect())
        assert alone == shared and len(alone) == 200 + (200 if ratio is None else 100)
    with pytest.raises(ValueError):
        smote.smote(df, ["a", "b"], "y", ratio=0.1, basis=basis)


def test_knn_exact_against_brute_force(spark):
    rng = np.random.default_rng(2)
    pts = rng.normal(size=(120, 3)).round(1)
    pts[:40] = pts[0]  # a hot duplicate vector
    feats = ["a", "b", "c"]
    df = spark.createDataFrame([(f"k{i}", *map(float, p)) for i, p in enumerate(pts)], "rid string, a double, b double, c double")
    keyed, distinct = smote.distinct_points(df, feats, smote.principal_directions(df, feats, 3))
    nn = smote.knn_table(distinct, feats, 5)
    vecs = {r["key"]: np.array([r["a"], r["b"], r["c"]]) for r in distinct.collect()}
    got = {}
    for r in nn.collect():
        got.setdefault(r["key"], {})[r["slot"]] = float(((vecs[r["key"]] - vecs[r["nkey"]]) ** 2).sum())
    for r in keyed.select("rid", "key").collect():
        i = int(r["rid"][1:])
        dd = sorted(((pts[j] - pts[i]) ** 2).sum() for j in range(len(pts)) if j != i)[:5]
        assert [got[r["key"]][s] for s in range(5)] == pytest.approx(dd)


def test_rank_with_hot_copies(spark):
    """A third of the rows are identical copies: ranks stay a permutation of 0..n-1."""
    from skylane.operators.ranks import bucketed_row_number, hash_bucket
    from skylane.functions.features import hash_hex

    rows = [("dup", 1)] * 300 + [(f"r{i}", i % 2) for i in range(600)]
    df = spark.createDataFrame(rows, "ROW_ID string, y int")
    x = df.withColumn("_h", hash_hex(42, "ROW_ID")).withColumn("_b", hash_bucket(F.col("_h"), 2))
    r = bucketed_row_number(x, "_b", ["_h", "ROW_ID"], out="r")
    got = sorted(v["r"] for v in r.select("r").collect())
    assert got == list(range(900))
    s = sampling.stratified_split(df, "y")
    assert s.count() == 900
    per = {v["y"]: (v["n"], v["t"]) for v in s.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.sum("IS_TEST").alias("t")).collect()}
    assert per[1] == (600, 180) and per[0] == (300, 90)


def clustered(n):
    """Points of which most lie in two tiny clusters, on a line, or at one value of an axis."""
    rng = np.random.default_rng(8)
    pts = rng.normal(size=(n, 3))
    pts[: n // 3] = 1e-4 * pts[: n // 3]
    pts[n // 3 : n // 2] = 5 + 1e-6 * pts[n // 3 : n // 2]
    pts[n // 2 : n // 2 + n // 5, :2] = 0.0
    return pts


@pytest.mark.parametrize("target, fanout", [(16, 4), (50, 16)])
def test_cells_stay_below_their_target(spark, target, fanout):
    from skylane.operators.kdcells import cells_in_reach, kd_cells

    pts = clustered(900)
    pts[700:] = pts[699]  # keys without places of their own
    df = spark.createDataFrame([(f"k{i}", *map(float, p), 0.3) for i, p in enumerate(pts)], "key string, u double, v double, w double, R double").persist()
    cells = kd_cells(df, ["u", "v", "w"], target, fanout)
    at = {r.key: r.cell for r in cells.points.collect()}
    assert len(at) == 900 == cells.points.count()
    sizes = {}
    for c in at.values():
        sizes[c] = sizes.get(c, 0) + 1
    assert max(sizes.values()) == cells.largest <= target
    # every point within the radius lies in a cell that the ball reaches
    reach = {}
    for r in cells_in_reach(df, ["u", "v", "w"], cells).collect():
        reach.setdefault(r.key, []).append(r.cell)
    d = np.sqrt(((pts[:, None] - pts[None]) ** 2).sum(-1))
    for i in range(0, 900, 7):
        mine = reach[f"k{i}"]
        assert len(mine) == len(set(mine))
        assert {at[f"k{j}"] for j in np.flatnonzero(d[i] <= 0.3)} <= set(mine)
    df.unpersist()


def test_knn_in_dense_clusters(spark):
    pts = clustered(400)
    feats = ["a", "b", "c"]
    df = spark.createDataFrame([(f"k{i}", *map(float, p)) for i, p in enumerate(pts)], "rid string, a double, b double, c double")
    keyed, distinct = smote.distinct_points(df, feats, smote.principal_directions(df, feats, 3))
    nn = smote.knn_table(distinct, feats, 5, target=20)
    vec = {r["key"]: np.array([r["a"], r["b"], r["c"]]) for r in distinct.collect()}
    got = {}
    for r in nn.collect():
        got.setdefault(r["key"], []).append(((vec[r["key"]] - vec[r["nkey"]]) ** 2).sum())
    for r in keyed.select("rid", "key").collect():
        i = int(r["rid"][1:])
        want = np.sort(((pts - pts[i]) ** 2).sum(-1))[1:6]
        assert np.allclose(sorted(got[r["key"]]), want, atol=2e-9)


def test_neighbour_search_probes_few_cells(spark, monkeypatch):
    """Distances spread over six directions: a point's ball meets a small part of the cells, and the neighbours are exact."""
    rng = np.random.default_rng(6)
    pts = rng.uniform(size=(2500, 6)) * [30, 20, 20, 15, 15, 10]
    feats = list("abcdef")
    df = spark.createDataFrame([(f"k{i}", *map(float, p)) for i, p in enumerate(pts)], "rid string, " + ", ".join(f"{c} double" for c in feats))
    keyed, distinct = smote.distinct_points(df, feats, smote.principal_directions(df, feats))
    met, search = [], smote.cells_in_reach

    def counted(balls, us, cells, **more):
        out = search(balls, us, cells, **more)
        met.append((out.count(), cells.points.select("cell").distinct().count()))
        return out

    monkeypatch.setattr(smote, "cells_in_reach", counted)
    nn = smote.knn_table(distinct, feats, 5)
    at = {r["key"]: int(r["rid"][1:]) for r in keyed.select("rid", "key").collect()}
    got = {}
    for r in nn.collect():
        got.setdefault(at[r["key"]], set()).add(at[r["nkey"]])
    for i in range(0, 2500, 13):
        assert got[i] == set(np.argsort(((pts - pts[i]) ** 2).sum(-1))[1:6].tolist())
    probes, cells = met[0]
    assert probes < 0.3 * cells * len(pts), (probes, cells)


def rows_with_copies():
    """A minority of which a third is one vector, the rest apart, and a majority."""
    rng = np.random.default_rng(11)
    pts = rng.normal(size=(90, 3)).round(2)
    pts[:30] = pts[0]
    return [(f"m{i}", 1, *map(float, p)) for i, p in enumerate(pts)] + [(f"n{i}", 0, 0.0, 0.0, 0.0) for i in range(400)]


def test_synthetic_rows_meet_vectors_without_copies_of_the_table(spark, monkeypatch):
    """Vectors too many to broadcast meet the draws by one shuffle each, without a copy a salt, and the rows are the same."""
    df = spark.createDataFrame(rows_with_copies(), "ROW_ID string, y int, a double, b double, c double")
    want = sorted(map(tuple, smote.smote(df, ["a", "b", "c"], "y").collect()))

    def salted(*args, **kwargs):
        raise AssertionError("a table was copied")

    monkeypatch.setattr(smote, "MAX_BROADCAST_BYTES", 0, raising=False)
    monkeypatch.setattr(smote, "lookup_join", salted)
    assert sorted(map(tuple, smote.smote(df, ["a", "b", "c"], "y").collect())) == want and len(want) == 800


def test_balls_go_to_groups_of_cells(spark, monkeypatch):
    """A ball is one row a group of sibling cells, every leaf in reach lies in one of them, and a group that
    many balls meet is dealt out with the same neighbours."""
    from skylane.operators.kdcells import cells_in_reach, group_of, kd_cells

    pts = clustered(600)
    feats = ["a", "b", "c"]
    balls = spark.createDataFrame([(f"k{i}", *map(float, p), 0.8) for i, p in enumerate(pts)], "key string, u double, v double, w double, R double").persist()
    cells = kd_cells(balls, ["u", "v", "w"], 8)
    leaves = cells_in_reach(balls, ["u", "v", "w"], cells).withColumn("grp", group_of())
    groups = cells_in_reach(balls, ["u", "v", "w"], cells, groups=True)
    sent = [tuple(r) for r in groups.collect()]
    assert len(sent) == len(set(sent)) < leaves.count() / 2
    assert {(r["key"], r["grp"]) for r in leaves.collect()} <= set(sent)
    balls.unpersist()
    df = spark.createDataFrame([(f"k{i}", *map(float, p)) for i, p in enumerate(pts)], "rid string, a double, b double, c double")
    _, distinct = smote.distinct_points(df, feats, smote.principal_directions(df, feats, 3))
    want = sorted(map(tuple, smote.knn_table(distinct, feats, 5, target=8).collect()))
    monkeypatch.setattr(smote, "PROBES", 20)
    assert sorted(map(tuple, smote.knn_table(distinct, feats, 5, target=8).collect())) == want


def test_search_scores_rows_in_one_pass_without_a_row_a_smoothing(spark):
    """Counts are those of the fitted model, and no row is spelled out for each smoothing value."""
    rng = np.random.default_rng(4)
    rows = [(i % 3, int(a + b > 1.0), float(a), float(b) if i % 17 else None) for i, (a, b) in enumerate(rng.normal(size=(300, 2)))]
    df = spark.createDataFrame(rows, "FOLD int, y int, a double, b double")
    grid = [1e-9, 1e-2]
    moments = bayes.FoldMoments.of(df.where("b IS NOT NULL"), ["a", "b"], "y")
    counts = bayes.cv_fold_counts(df, ["a", "b"], "y", grid, moments=moments)
    assert "Generate" not in counts._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["FOLD"], r["s"]): (r["tp"], r["fp"], r["fn"], r["tn"]) for r in counts.collect()}
    for f in range(3):
        for s, smoothing in enumerate(grid):
            model = bayes.fit_gaussian_nb(df.where((F.col("FOLD") != f) & F.col("b").isNotNull()), ["a", "b"], "y", smoothing)
            seen = model.transform(df.where((F.col("FOLD") == f) & F.col("b").isNotNull())).select("y", "PREDICTION").collect()
            want = [sum(r["y"] == y and r["PREDICTION"] == p for r in seen) for y, p in ((1, 1), (0, 1), (1, 0), (0, 0))]
            assert got[f, s] == tuple(want)


def test_variant_copies_are_written_once(spark, monkeypatch):
    """The copies of the oversampled variant are read from files by the passes that follow, not drawn again."""
    from skylane.plans import compare

    df = spark.createDataFrame([(f"r{i}", float(i), int(i % 7 == 0)) for i in range(70)], f"ROW_ID string, a double, {LABEL} int")
    monkeypatch.setattr(compare, "_variant_inputs", lambda *a: (df, df, ["a"]))
    frames, _ = compare.variant_frames(spark, "", ["random_oversample"])
    dealt, _ = frames["random_oversample"]()
    assert "Join" not in dealt._train._jdf.queryExecution().optimizedPlan().toString()
    assert rows_of(dealt._train) == rows_of(sampling.random_oversample(df, LABEL))


def rows_of(df):
    return sorted(map(tuple, df.collect()))
