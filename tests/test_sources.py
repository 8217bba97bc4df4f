"""CSV by header with a quarantine, and fitted trees as tables."""

import re

import pytest
from pyspark.sql import functions as F

from skylane.operators import metrics, sampling, select, trees
from skylane.sources.csv_tables import ingest_csv, read_csv, resolve_header


def write(path, *files):
    path.mkdir()
    for k, text in enumerate(files):
        (path / f"part-{k}.csv").write_text(text)
    return str(path)


def test_columns_are_found_by_name(spark, tmp_path):
    path = write(tmp_path / "a", "B,more,A\n1,x,one\n2,y,two\n", "B,more,A\n3,,\n")
    got = read_csv(spark, path, "A string, B int")
    assert got.columns == ["A", "B"]
    assert sorted((r.B, r.A) for r in got.collect()) == [(1, "one"), (2, "two"), (3, None)]
    with pytest.raises(ValueError, match="lacks \\['C'\\]"):
        read_csv(spark, path, "A string, C int")
    with pytest.raises(ValueError, match="lacks"):
        resolve_header(spark, write(tmp_path / "twice", "A,A\n1,2\n"), "A int")


def test_files_must_share_their_header(spark, tmp_path):
    path = write(tmp_path / "b", "A,B\n1,2\n", "B,A\n1,2\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv(spark, path, "A int, B int").collect()


def test_bad_rows_are_an_error_or_kept_apart(spark, tmp_path):
    text = 'B,A,d\n1,1.5,2020-01-31\nx,2.5,2020-01-31\n3,NaN,2020-02-30\n4,4.5\n5,5.5,2020-01-01,more\n6,,\n"7",7.5,2020-03-01\n'
    path = write(tmp_path / "c", text)
    schema = "A double, B int, d date"
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, path, schema).collect()
    # a row is bad whichever columns are asked for
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, path, schema).select("A").collect()
    want = {"x,2.5,2020-01-31", "3,NaN,2020-02-30", "4,4.5", "5,5.5,2020-01-01,more"}
    got = ingest_csv(spark, path, schema, str(tmp_path / "out"))
    assert (got.n_rows, got.n_bad) == (3, 4)
    assert got.rows.columns == ["A", "B", "d"]
    assert [(r.B, r.A) for r in got.rows.orderBy("B").collect()] == [(1, 1.5), (6, None), (7, 7.5)]
    rows = got.quarantine.collect()
    assert {r.record for r in rows} == want and all(r.file.endswith("part-0.csv") for r in rows)


def test_ingest_of_odd_files(spark, tmp_path):
    clean = ingest_csv(spark, write(tmp_path / "d", "bad,_record,row\n1,a,b\n"), "bad int, _record string, row string", str(tmp_path / "d_out"))
    assert (clean.n_rows, clean.n_bad) == (1, 0)
    assert [tuple(r) for r in clean.rows.collect()] == [(1, "a", "b")] and clean.quarantine.collect() == []
    none = ingest_csv(spark, write(tmp_path / "e", "A,B\n"), "A int, B int", str(tmp_path / "e_out"))
    assert (none.n_rows, none.n_bad) == (0, 0) and none.rows.collect() == [] and none.rows.columns == ["A", "B"]
    broken = ingest_csv(spark, write(tmp_path / "f", "A,B\nx,1\n"), "A int, B int", str(tmp_path / "f_out"))
    assert (broken.n_rows, broken.n_bad) == (0, 1) and broken.rows.collect() == []
    lines = ingest_csv(spark, write(tmp_path / "g", 'A,B\n1,"two\nlines"\n'), "A int, B string", str(tmp_path / "g_out"), multiLine=True)
    assert [tuple(r) for r in lines.rows.collect()] == [(1, "two\nlines")]


@pytest.fixture(scope="module")
def grown(spark, tmp_path_factory):
    df = spark.range(900).select(
        F.md5(F.col("id").cast("string")).alias("ROW_ID"),
        (F.col("id") % 7).cast("double").alias("a"),
        (F.col("id") % 11).cast("double").alias("b"),
        F.lit(1.0).alias("unused"),
        (((F.col("id") % 7 > 3) & (F.col("id") % 11 < 5)) | (F.col("id") % 13 == 0)).cast("int").alias("y"),
    )
    cols = ["a", "b", "unused"]
    model = trees.fit_trees(df, cols, "y", params={"n_estimators": 9, "max_depth": 4, "min_child_samples": 1})
    path = str(tmp_path_factory.mktemp("trees") / "m")
    trees.save_trees(model, path)
    return df, cols, model, trees.node_table(spark, path)


def test_split_counts_are_those_of_the_trees(spark, grown):
    _, cols, model, nodes = grown
    # each split is printed twice: once a branch
    said = re.findall(r"If \(feature (\d+) ", model.toDebugString)
    got = {r.feature: r.importance for r in trees.split_counts(nodes, cols).collect()}
    assert got == {c: float(said.count(str(k))) for k, c in enumerate(cols)} and got["unused"] == 0
    ranked = select.rank_by_importance(trees.split_counts(nodes, cols), top=2).orderBy("rank").collect()
    assert [r.feature for r in ranked] == sorted(["a", "b"], key=lambda c: (-got[c], c))


def test_stages_are_the_smaller_ensembles(spark, grown):
    df, cols, model, nodes = grown
    data = trees.assemble(df, cols).withColumn("y", F.col("y").cast("double"))
    got = {r.stage: (r.tn, r.fp, r.fn, r.tp) for r in trees.staged_confusion(model, nodes, data, "y", [1, 4, 9]).collect()}
    for n in (1, 4, 9):
        small = trees.fit_trees(df, cols, "y", params={"n_estimators": n, "max_depth": 4, "min_child_samples": 1})
        r = metrics.confusion_counts(trees.tree_scores(small, df, cols), "y", "PREDICTION").first()
        assert got[n] == (r.tn, r.fp, r.fn, r.tp)


def test_search_goes_on_where_it_stopped(spark, grown, tmp_path, monkeypatch):
    df, cols, _, _ = grown
    grid = {**trees.TREE_GRID, "n_estimators": [2, 3, 5], "max_depth": [2, 3], "learning_rate": [0.1], "min_child_samples": [1]}
    folded = sampling.kfold(df, 3).persist()
    fits = []
    fit = trees.GBTClassifier.fit
    monkeypatch.setattr(trees.GBTClassifier, "fit", lambda self, d: fits.append(self.getMaxIter()) or fit(self, d))
    res, _ = trees.tree_search(folded, cols, "y", 6, grid, out_dir=str(tmp_path), parallelism=2)
    # two families of three sizes: one fit a family and fold, and the refit of the best
    assert sorted(fits)[-6:] == [5] * 6 and len(fits) == 7
    first = res.collect()
    lost = next((tmp_path / "trials").iterdir())
    for f in lost.iterdir():
        f.unlink()
    lost.rmdir()
    fits.clear()
    again, _ = trees.tree_search(folded, cols, "y", 6, grid, out_dir=str(tmp_path))
    assert len(fits) == 2 and again.collect() == first
    one = {**grid, "n_estimators": [3], "max_depth": [2]}
    alone, _ = trees.tree_search(folded, cols, "y", 1, one)
    want = next(r for r in first if (r.max_iter, r.max_depth) == (3, 2))
    assert alone.first().cv_f1 == want.cv_f1
    folded.unpersist()
