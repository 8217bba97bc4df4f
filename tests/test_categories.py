"""Categories of any number: index table and sparse vectors."""

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylane.operators import categories, encode


def _vectors(df, *cols):
    return {r[0]: [(v.size, list(v.indices), list(v.values)) for v in r[1:]] for r in df.select("id", *cols).collect()}


def test_vectors_match_the_named_columns(spark):
    rows = [(1, "b", 2), (2, None, 10), (3, "", 2), (4, "b", None), (5, "é", 10), (6, "a", 7), (6, "a", 7)]
    df = spark.createDataFrame(rows, "id int, c string, n int")
    cats = encode.fit_categories(df, ["c", "n"])
    fitted = categories.fit_category_vectors(df, ["c", "n"])
    assert fitted.sizes == {"c": 5, "n": 4}
    index = {(r["column"], r["category"]): r["index"] for r in fitted.index.collect()}
    assert index == {(c, v): i for c, vals in cats.items() for i, v in enumerate(vals)}
    got = fitted.transform(df)
    assert got.columns == ["id", "c_VEC", "n_VEC"] and got.count() == len(rows)
    for i, c, n in rows:
        n = None if n is None else str(n)
        assert _vectors(got, "c_VEC", "n_VEC")[i] == [(5, [index["c", c]], [1.0]), (4, [index["n", n]], [1.0])]


def test_unseen_values_and_empty_tables(spark, tmp_path):
    train = spark.createDataFrame([(1, "x"), (2, "y")], "id int, c string")
    other = spark.createDataFrame([(1, "y"), (2, "z"), (3, None), (4, "")], "id int, c string")
    fitted = categories.fit_category_vectors(train, ["c"])
    want = {1: [(2, [1], [1.0])], 2: [(2, [], [])], 3: [(2, [], [])], 4: [(2, [], [])]}
    assert _vectors(fitted.transform(other), "c_VEC") == want
    fitted.save(str(tmp_path / "index"))
    again = categories.CategoryVectors.load(spark, str(tmp_path / "index"), ["c"])
    assert again.sizes == {"c": 2} and _vectors(again.transform(other), "c_VEC") == want
    none = categories.fit_category_vectors(train.where("false"), ["c"])
    assert none.sizes == {"c": 0}
    assert _vectors(none.transform(train), "c_VEC") == {1: [(1, [], [])], 2: [(1, [], [])]}
    assert categories.fit_category_vectors(train, ["c"]).transform(train.where("false")).count() == 0
    with pytest.raises(ValueError, match="not found"):
        categories.fit_category_vectors(train, ["nope"])


def test_a_million_categories_without_the_driver(spark, monkeypatch):
    n = 1_000_000
    # every value once, and a third of the rows with one of them
    value = F.when(F.col("id") < n, F.col("id")).otherwise(F.lit(7))
    df = spark.range(n * 3 // 2).select("id", F.lpad(value.cast("string"), 7, "0").alias("c"), F.create_map(F.lit("k"), "id").alias("m"))
    with pytest.raises(ValueError, match="fit_category_vectors"):
        encode.fit_categories(df, ["c"])
    collected = []
    real = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: collected.append(real(self)) or collected[-1])
    fitted = categories.fit_category_vectors(df, ["c"])
    out = fitted.transform(df, drop_source=False)
    assert fitted.index.where("rows > 1").count() == 1
    # the place of a value is the number it was padded from
    wrong = out.where(F.col("c_VEC").cast("string") != F.concat(F.lit(f"({n},["), F.col("c").cast("int").cast("string"), F.lit("],[1.0])")))
    assert wrong.count() == 0 and out.count() == n * 3 // 2
    assert sum(map(len, collected)) < 10
