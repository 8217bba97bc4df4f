"""The corpus pipeline over a whole small table against a brute-force chain of its stages."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from skylane.llm.packing import cut
from skylane.llm.toxicity import fit_toxicity

from .test_texts import brute_fingerprint, brute_windows, components, squeeze

SMALL = "/root/testdata/sf0.001"


def one_per_component(docs, distance=4):
    fp = [brute_fingerprint(t, 4) for _, t in docs]
    roots = components(len(docs), [(i, j) for i in range(len(fp)) for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= distance])
    least = {}
    for (i, t), r in zip(docs, roots):
        least[r] = min(least.get(r, (i, t)), (i, t))
    return sorted(least.values())


@pytest.fixture(scope="module")
def expected(spark):
    """(doc_id, text) after each filtering stage; the fitted model is the stage's own, its scores are taken text by text."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = fit_toxicity(docs, spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "toxic"))
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    clean = [(i, t) for i, t in rows if model.scores([t])[0] < 0.3]
    first = {}
    for i, t in clean:
        first.setdefault(squeeze(t), (i, t))
    exact = sorted(first.values())
    near = one_per_component(exact)
    cut_texts = [(i, k if gone else t) for (i, t), (_, gone, k) in zip(near, brute_windows([t for _, t in near], 35))]
    return [clean, exact, near, cut_texts]


def test_stages_against_brute_force(spark, expected, tmp_path):
    now = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = now.columns
    for (name, stage), want in zip(corpus_pipeline.STAGES, expected):
        path = str(tmp_path / name)
        stage(spark, now, SMALL).write.parquet(path)
        now = spark.read.parquet(path)
        assert now.columns == names
        assert sorted((r.doc_id, r.text) for r in now.select("doc_id", "text").collect()) == want, name
    assert len(expected[0]) > len(expected[1]) > len(expected[2]) and expected[2] != expected[3]


def test_run_packs_what_the_stages_left(spark, expected):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, sizes = Counter(), []
    for i, t in expected[-1]:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        for k, (s, n) in enumerate(cut(len(ids), 1024)):
            want[i, k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())] += 1
            sizes.append(n)
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    filled = defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
    for places in filled.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 1024
    assert len(filled) <= -(-sum(sizes) // 1024) + 3
