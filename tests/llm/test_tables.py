"""Chats, vectors, the registered queries against their SQL, and the pipeline against brute force."""

import hashlib
import os
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skylane.llm.chat import chat_examples, escape, escape_role, read_turns, trainable, unescape, unescape_role
from skylane.llm.queries import QUERIES, SQL
from skylane.llm.vectors import embedding_dedup, table_shape

SMALL = "/root/testdata/sf0.001"


def test_escapes_are_reversible(spark):
    texts = ["", "<|im_end|>", "<%|", "<%%|x<|", "<|<|", "<<||", "a<n>b\n<%n>\n", "100% <"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", escape("t").alias("e"), unescape(escape("t")).alias("b"), escape_role("t").alias("re"), unescape_role(escape_role("t")).alias("rb")).collect():
        assert r.b == r.t and r.rb == r.t and "<|" not in r.e and "<|" not in r.re and "\n" not in r.re


def test_chat_examples(spark):
    rows = [
        (1, 0, "user", "hi", "x"),
        (1, 1, "assistant", "a<|im_end|>b", "x"),
        (1, 2, "user", None, "x"),
        (1, 3, "assistant", "two", "x"),
        (2, 0, "user", "only", "x"),
        (3, 5, "assistant", "", "x"),
        (3, 5, "assistant", "", "x"),
        (None, 0, None, "n", "x"),
        (4, None, "us\ner", "<|im_start|>assistant\nno", "x"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, example string")
    made = chat_examples(df).withColumns({"turns": read_turns(F.col("text")), "loss": trainable(F.col("text"), F.col("loss_start"), F.col("loss_end"))})
    got = {(r.conv_id, r.example): r for r in made.collect()}
    assert got[1, 0].loss == "a<|im_end|>b" and got[1, 1].loss == "two" and got[1, 1].context_turns == 3
    assert [(t.role, t.text) for t in got[1, 1].turns] == [("user", "hi"), ("assistant", "a<|im_end|>b"), ("user", ""), ("assistant", "two")]
    assert got[2, 0].loss == "" and [t.text for t in got[2, 0].turns] == ["only"]
    assert [len(got[3, k].turns) for k in (0, 1)] == [1, 2]
    assert [(t.role, t.text) for t in got[4, 0].turns] == [("us\ner", "<|im_start|>assistant\nno")]
    assert [(t.role, t.text) for t in got[None, 0].turns] == [("", "n")]
    assert chat_examples(df.limit(0)).collect() == []


def brute_links(rows, threshold):
    unit = {}
    for k, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            a = np.array(v, float)
            unit[k] = a / np.sqrt((a * a).sum())
    return [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold]


@pytest.mark.parametrize("part", [4096, 7])
def test_vectors(spark, part, monkeypatch):
    import skylane.llm.vectors as V

    rng = np.random.default_rng(1)
    base = rng.standard_normal((12, 16))
    rows = [(i, [float(x) for x in base[i % 12] + 0.15 * rng.standard_normal(16)]) for i in range(120)]
    rows += [(200 + i, rows[0][1]) for i in range(5)]
    rows += [(300, None), (301, [0.0] * 16), (302, [float("nan")] * 16), (303, [None] + [1.0] * 15), (304, [1.0, 2.0]), (305, [2.0, 4.0]), (306, []), (307, [float("inf")] * 16), (None, rows[1][1])]
    df = spark.createDataFrame([(i, v, "a", "b") for i, v in rows], "vec_id long, embedding array<double>, label string, kept string")
    if part != 4096:
        real = V.vector_links
        monkeypatch.setattr(V, "vector_links", lambda v, t, r: real(v, t, r, part=part))
    got = embedding_dedup(df, 0.9, 0.9999).collect()
    links = brute_links(rows, 0.9)
    n = Counter(x for ab in links for x in ab)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    want = Counter((i, n[k], least.get(find(k))) for k, (i, _) in enumerate(rows))
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == want
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    assert embedding_dedup(df.limit(0)).collect() == []


def test_table_shape_reaches_the_recall():
    for n in (1, 10**3, 10**6, 10**9):
        bits, tables = table_shape(n, 0.9, 0.99)
        assert 1 - (1 - (1 - np.arccos(0.9) / np.pi) ** bits) ** tables >= 0.99


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    rows = lambda cols, data: Counter(tuple(str(r[cols.index(c)]) for c in sorted(cols)) for r in data)
    df = QUERIES[name](spark, SMALL)
    cur = con.execute(SQL[name])
    cols = [d[0] for d in cur.description]
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(cols, cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_covers_every_document(spark, name):
    got = QUERIES[name](spark, SMALL)
    ids = {r.doc_id for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id").collect()}
    assert {r.doc_id for r in got.select("doc_id").collect()} == ids


def test_recall_on_the_given_vectors(spark):
    """Links found against brute force on the whole small table."""
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    want = len(brute_links(rows, 0.9))
    got = QUERIES["op9_embedding_dedup"](spark, SMALL).agg(F.sum("n_links")).first()[0]
    assert 0.9 * 2 * want <= got <= 2 * want


def test_pipeline_stages(spark, tables, odd_docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for frame in (docs, no_docs.select(docs.columns)):
        d = tables(documents=frame, labels=labels)
        now = spark.read.parquet(f"{d}/documents.parquet")
        kept = {}
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, now, d)
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns
            path = os.path.join(d, f"out-{k}")
            out.write.parquet(path)
            now = spark.read.parquet(path)
            kept[name] = Counter(r.doc_id for r in now.collect())
        if frame is docs:
            assert 12 not in kept["toxicity"] and len(list(kept["toxicity"].elements())) == 17
            # 1 and 2 are one text; 4, 4, null and 5 too
            assert kept["exact_dedup"] == Counter([1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 13, 14, 15])
            assert 1 in kept["simhash_near_dedup"] and not {3, 7} & set(kept["simhash_near_dedup"])  # no words; one word more
            assert kept["substring_dedup"] == kept["simhash_near_dedup"]
            assert set(kept["best_fit_packing"]) == set(kept["substring_dedup"])
        else:
            assert not any(kept.values())


def test_pipeline_run(spark):
    got = corpus_pipeline.run(spark, SMALL)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(got.columns)
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0


def test_digests_of_a_known_text(spark, tables):
    docs = spark.createDataFrame([(1, "A  b\nc"), (2, None)], "doc_id long, text string")
    d = tables(documents=docs)
    got = {r.doc_id: r for r in QUERIES["op6_exact_dedup"](spark, d).collect()}
    assert got[1].text_sha256 == hashlib.sha256(b"A b c").hexdigest() and got[2].text_sha256 == hashlib.sha256(b"").hexdigest()
