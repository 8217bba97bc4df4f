"""Prefix tries, ranked search and language identification against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skylane.llm.common import Stash
from skylane.llm.langid import LETTERS, Lattice, fit_language_id, held_out_third, predict_language, stretches
from skylane.llm.queries import QUERIES
from skylane.llm.search import lexical_search, terms
from skylane.llm.trie import TernaryTree, encode_turns, median_order, prefix_trie, share_heads, shard_nodes

from .conftest import odd_texts

TURNS = "conv_id long, turn long, role string, text string, id string, ts string, key string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute_talks(rows):
    """Rebuilt conversations as lists of (role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, sha(f"{len(role)}:{role}{text}"), (role, text)))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))
        out[c] = own.get(base, [])[:h] + ts[h:]
    return out


def brute_trie(talks):
    members = defaultdict(list)
    for c, ts in talks.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(cs) - 1) * len(p[-1][1]) if p else 0
    return Counter(
        (
            min(cs),
            len(p),
            min(members[p[:-1]]) if p else None,
            len(cs),
            kids[p],
            leaves[p],
            saved[p],
            sha(",".join(str(c) for c in sorted(cs) if len(talks[c]) == len(p))),
        )
        for p, cs in members.items()
    )


def turn_rows():
    rows = []
    for c in range(-130, 460, 7):
        for k in range(abs(c) % 9):
            rows.append((c, k, "user" if k % 2 == 0 else "assistant", f"t{(c // 50) % 3}" if k < 3 else f"own {c % 4} {k}"))
    for c in range(1000, 1400):  # a large group of copies
        rows += [(c, k, "user", f"copy {k}") for k in range(6)]
    rows += [(500, None, None, None), (500, None, "user", "tie"), (500, 1, "user", "same"), (500, 1, "user", "same"), (None, 0, "user", "lost")]
    rows += [(503, k, "user", "x" * 20_000) for k in range(300)]
    rows += [(600, 0, "us\ner", ""), (601, 0, "", "user"), (602, 0, "user", "")]
    return rows


@pytest.mark.parametrize("shard_turns", [20_000, 300, 40])
def test_prefix_trie(spark, shard_turns):
    rows = turn_rows()
    df = spark.createDataFrame([(*r, "i", "t", "k") for r in rows], TURNS).repartition(5)
    stash = Stash(spark)
    got = prefix_trie(share_heads(encode_turns(df, stash)), stash, shard_turns)
    assert Counter(tuple(r) for r in got.collect()) == brute_trie(brute_talks(rows))


def test_prefix_trie_without_turns(spark):
    df = spark.createDataFrame([], TURNS)
    stash = Stash(spark)
    assert prefix_trie(share_heads(encode_turns(df, stash)), stash).collect() == []
    # 101 keeps nothing: its turns are fewer than those it takes from 100, which is absent
    conv = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1)
    df = spark.createDataFrame([(conv, 0, "user", "a", "", "", "")], TURNS)
    assert [tuple(r) for r in prefix_trie(share_heads(encode_turns(df, stash)), stash).collect()] == [(conv, 0, None, 1, 0, 1, 0, sha(str(conv)))]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=5), min_size=1, max_size=30), st.integers(1, 6))
def test_shards_add_up(lists, shards):
    """Parts of boundary nodes sum to the nodes of one shard, wherever the borders lie."""
    rows = sorted((tuple(ids), c) for c, ids in enumerate(lists))
    step = -(-len(rows) // shards)
    cut = [rows[i : i + step] for i in range(0, len(rows), step)]

    def common(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    whole = {}
    for (node, _) in shard_nodes([(list(i), c, [s + 1 for s in i]) for i, c in rows], -1, -1):
        assert node[0] is None
        whole[node[3], node[2], node[5]] = node[6:9]
    parts, final = defaultdict(list), {}
    for k, part in enumerate(cut):
        before = common(cut[k - 1][-1][0], part[0][0]) if k else -1
        after = common(part[-1][0], cut[k + 1][0][0]) if k + 1 < len(cut) else -1
        for node, piece in shard_nodes([(list(i), c, [s + 1 for s in i]) for i, c in part], before, after):
            if node and node[0] is None:
                final[node[3], node[2], node[5]] = node[6:9]
            elif node:
                parts[node[0]].append(node)
    for ns in parts.values():
        final[ns[0][3], min(n[2] for n in ns), sum(n[5] for n in ns)] = tuple(sum(n[i] for n in ns) for i in (6, 7, 8))
    assert final == whole


def test_ternary_tree():
    lists = sorted({tuple(p) for n in range(4) for p in product(range(4), repeat=n)})
    assert sorted(median_order(9)) == list(range(9)) and next(iter(median_order(9))) == 4
    tree, node = TernaryTree(), {}
    for k in median_order(len(lists)):
        node[lists[k]] = tree.insert(list(lists[k]), [1] * len(lists[k]))
    assert [node[p] for p in lists] == tree.walk()


def brute_search(docs, items, k):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    held = [(i, Counter(split(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, length = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(split(t))
    out = Counter()
    for item, ts in asked.items():
        got = []
        for doc, c in held:
            m = 100 - 90 + (90 * c.total() * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in ts if t in c)
            if s > 0:
                got.append((-s, doc is None, doc, s))
        for rank, (_, _, doc, s) in enumerate(sorted(got, key=lambda g: g[:2] + (g[2] or 0,))[:k]):
            out[item, rank + 1, doc, s] += 1
    return out


def search_rows():
    rng = np.random.default_rng(5)
    names = [f"w{k}" for k in range(140)]
    docs = odd_texts() + [(100 + k, " ".join(rng.choice(names, size=rng.integers(1, 120), p=np.arange(140, 0, -1) / 9870))) for k in range(300)]
    docs += [(500 + k, "W1 w2, w3") for k in range(40)] + [(900, " ".join(names * 50))]
    items = [(k, " ".join(rng.choice(names, size=12))) for k in range(15)]
    # more than 64 terms, more than 128 terms, rows of one item, no terms, no match
    items += [(20, " ".join(names[:90])), (21, " ".join(names)), (22, "w5 w6"), (22, "w6 w7"), (23, None), (24, " .. "), (25, "nowhere"), (None, "naïve one two"), (26, "İstanbul ſtraße 漢字")]
    return docs, items


@pytest.mark.parametrize("block, rows", [(16 << 20, 10_000), (600, 7)])
def test_lexical_search(spark, block, rows):
    docs, items = search_rows()
    d = spark.createDataFrame([(*r, "x", "y") for r in docs], "doc_id long, text string, n string, terms string").repartition(4)
    i = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    try:
        got = Counter(tuple(r) for r in lexical_search(d, i, k=10, block=block).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    assert got == brute_search(docs, items, 10)


def test_lexical_search_empty(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    i = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search(d, i).collect() == [] and lexical_search(d, i.limit(0)).collect() == []
    assert lexical_search(spark.createDataFrame([(1, None), (2, "b")], d.schema), i).collect() == []
    assert [tuple(r) for r in spark.createDataFrame([("Ab-ÀB9",)], "t string").select(F.explode(terms(F.col("t")))).collect()] == [("ab",), ("Àb9",)]


def brute_likelihood(word, p):
    """Sum over all segmentations, one by one."""
    total = 0.0
    for cuts in product((0, 1), repeat=len(word) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(word)]
        q = 1.0
        for a, b in zip(at, at[1:]):
            q *= p.get(word[a:b], 0.0)
        total += q
    return total


def test_all_segmentations_count():
    vocabulary = [b" ", b"a", b"b", b"ab", b"ba", b" a", b"aba", b"abab"]
    rng = np.random.default_rng(3)
    p = rng.dirichlet(np.ones(len(vocabulary)), size=2).T
    lattice = Lattice(vocabulary)
    words = [b" a", b" ab", b" abab", b" bababab", b" aaaaaaaa", b" a"]
    got = np.exp(lattice.log_likelihood(words, lattice.weights(p)))
    for k in range(2):
        of = dict(zip(vocabulary, p[:, k]))
        assert np.allclose(got[:, k], [brute_likelihood(w, of) for w in words])
        # expected uses: each segmentation with its share
        want = Counter()
        for w, n in zip(words, range(1, 7)):
            for cuts in product((0, 1), repeat=len(w) - 1):
                at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(w)]
                q = np.prod([of.get(w[a:b], 0.0) for a, b in zip(at, at[1:])]) / brute_likelihood(w, of)
                for a, b in zip(at, at[1:]):
                    want[w[a:b]] += n * q
        made = lattice.expected(words, np.arange(1.0, 7.0), np.ascontiguousarray(lattice.weights(p)[:, k])) / (1 << 16)
        assert np.allclose(made, [want[v] for v in vocabulary], atol=1e-3)


def test_long_words_stay_in_range():
    lattice = Lattice([bytes([b]) for b in range(256)])
    words = [s for s in stretches("ñ" * 5000)]
    assert b"".join(words) == b" " + ("ñ" * 5000).encode() and max(map(len, words)) == 64
    p = np.column_stack([np.full(256, 1e-10), np.full(256, 0.9)])
    got = lattice.log_likelihood(words, lattice.weights(p))
    assert np.allclose(got, [[len(w) * math.log(q) for q in (1e-10, 0.9)] for w in words])
    wide = Lattice([bytes([b]) * n for b in range(256) for n in range(1, 34)])
    got = wide.log_likelihood(words[1:-1], wide.weights(np.full((256 * 33, 1), 1e-10)))
    assert np.allclose(got, 64 * math.log(1e-10), rtol=1e-6)


def test_language_id(spark, odd_docs, no_docs, tmp_path):
    rows = []
    for k in range(60):
        rows += [(3 * k, "the house and the garden are here " * (k % 3 + 1), "en"), (3 * k + 1, "das Haus und der Garten sind hier", "de"), (3 * k + 2, "la maison et le jardin sont là", "fr")]
    rows += [(1000, None, "xx"), (1001, "no language", None), (1002, "", "en"), (1003, "123 !", "de")]
    train = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, lang string, k string")
    model = fit_language_id(train)
    assert model.languages == ["de", "en", "fr"] and np.allclose(model.probabilities.sum(axis=0), 1)
    again = fit_language_id(train.repartition(7))
    assert (again.probabilities == model.probabilities).all()
    new = [(1, "the and HERE"), (2, "der und das"), (3, "le jardin"), (4, None), (5, " 12 ½ ... "), (None, "Das Haus"), (6, "the " * 30_000), (7, "x" * 200_000), (7, "x" * 200_000), (8, "漢字")]
    got = predict_language(spark.createDataFrame([(*r, "s", 9) for r in new], "doc_id long, text string, lang string, score int"), model)
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = {r.doc_id: r for r in got.collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, None, 6)] == ["en", "de", "fr", "de", "en"]
    assert [(got[i].lang_pred, got[i].score) for i in (4, 5)] == [("und", 0.0)] * 2
    assert all(0 <= r.score <= 1 for r in got.values()) and got[7].lang_pred in model.languages
    assert {r.lang_pred for r in predict_language(odd_docs, fit_language_id(no_docs)).collect()} == {"und"}
    assert predict_language(no_docs, model).collect() == []
    assert predict_language(odd_docs, model).count() == len(odd_texts())


def test_language_id_held_out(spark):
    got = QUERIES["op13_language_id"](spark, "/root/testdata/sf0.01").withColumnRenamed("doc_id", "d")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    rows = got.join(docs, F.col("d") == F.col("doc_id")).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert (r.lang_pred == "und") == (not LETTERS.search(r.text or ""))
    out = [r.lang == r.lang_pred for r in rows if r.held_out]
    assert sum(out) / len(out) > 0.99
    assert spark.range(1).select(held_out_third(F.lit(None).cast("long")).alias("h")).first().h is False
