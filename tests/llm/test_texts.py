"""Operators on texts against brute force: edge rows, empty tables, clashing columns."""

import hashlib
import re
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skylane.llm.automaton import SuffixAutomaton
from skylane.llm.bpe import SpeculativeBPE, bpe_encode
from skylane.llm.common import Stash, keyed
from skylane.llm.exact import CountingQuotientFilter, exact_dedup
from skylane.llm.licenses import PHRASES, TEMPLATES, scan_licenses, template_tokens, template_words
from skylane.llm.lines import line_dedup, recurring_lines
from skylane.llm.packing import cut, pack_documents, packed_sequences, plan_best_fit, token_pieces
from skylane.llm.queries import SQL
from skylane.llm.simhash import simhash_dedup, trie_pairs
from skylane.llm.substring import substring_dedup
from skylane.llm.toxicity import PATTERNS, WORDS, Grammar, ToxicityModel, _fit_logistic, fit_toxicity, score_toxicity

from skylane.llm.vectors import embedding_dedup

from .conftest import odd_texts


def sha(b):
    return hashlib.sha256(b).hexdigest()


def brute_windows(texts, window):
    rows = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in rows for i in range(len(w) - window + 1))
    out = []
    for w in rows:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


@pytest.mark.parametrize("window, hot", [(35, 256), (35, 1), (4, 256), (4, 1)])
def test_substring_dedup(odd_docs, window, hot):
    got = substring_dedup(odd_docs, window=window, hot=hot)
    assert {"lang", "kept", "score", "n_chars"} <= set(got.columns)
    rows = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect())
    texts = odd_texts()
    want = Counter((i, *b) for (i, _), b in zip(texts, brute_windows([t for _, t in texts], window)))
    assert rows == want


def test_substring_dedup_empty(no_docs):
    assert substring_dedup(no_docs).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=14), max_size=6), st.integers(1, 4))
def test_automaton_counts_windows(rows, size):
    a = SuffixAutomaton()
    for r in rows:
        a.add(r)
    a.close()
    seen = Counter(tuple(r[i : i + size]) for r in rows for i in range(len(r) - size + 1))
    for r in rows:
        assert a.repeated(r, size) == [i for i in range(len(r) - size + 1) if seen[tuple(r[i : i + size])] > 1]


def brute_fingerprint(text, shingle):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("distance", [4, 12])
def test_simhash(odd_docs, distance):
    got = simhash_dedup(odd_docs, shingle=4, distance=distance).collect()
    texts = odd_texts()
    fp = [brute_fingerprint(t, 4) for _, t in texts]
    roots = components(len(fp), [(i, j) for i in range(len(fp)) for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= distance])
    least = defaultdict(list)
    for (i, _), r in zip(texts, roots):
        if i is not None:
            least[r].append(i)
    want = Counter((i, f"{f:016x}", min(least[r])) for (i, _), f, r in zip(texts, fp, roots))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    kept = defaultdict(set)
    for r in got:
        if r.kept:
            kept[r.component_id].add((r.doc_id, r.text_hash))
    assert all(len(x) == 1 for x in kept.values()) and len(kept) == len(set(roots))


def test_simhash_empty(no_docs):
    assert simhash_dedup(no_docs).collect() == []


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 2**32), st.integers(2, 60))
def test_trie_pairs_lose_nothing(seed, n):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**64, 4, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for k in rng.integers(0, 5, n)], np.uint64)
    a = np.unique(base[rng.integers(0, 4, n)] ^ flips)
    found = set()
    for i, j in trie_pairs(a, None, 0, np.zeros(0, np.int64), 22, 4, 4, work=50):
        found |= set(zip(i.tolist(), j.tolist()))
    assert found == {(i, j) for i in range(len(a)) for j in range(i + 1, len(a)) if int(a[i] ^ a[j]).bit_count() <= 4}


def test_simhash_crowded_nodes(spark):
    """Many leaves in one node, held in small parts, give the same components."""
    from skylane.llm.common import Stash
    from skylane.llm.components import connected_components
    from skylane.llm.simhash import trie_links

    rng = np.random.default_rng(5)
    fps = np.unique(np.concatenate([np.array([sum(1 << int(b) for b in rng.choice(64, 3, replace=False)) for _ in range(150)], np.uint64), rng.integers(0, 2**64, 50, dtype=np.uint64)]))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    links = trie_links(df, 4, node_size=16, part=20)
    got = {r.node: r.component for r in connected_components(links, Stash(spark)).collect()}
    roots = components(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if int(fps[i] ^ fps[j]).bit_count() <= 4])
    same = defaultdict(set)
    for f, r in zip(fps.view(np.int64).tolist(), roots):
        same[r].add(f)
    for g in same.values():
        assert {got.get(f, f) for f in g} == {min(g)}


def squeeze(t):
    out, space = [], False
    for c in t or "":
        if c in " \t\n\x0b\x0c\r":
            if not space:
                out.append(" ")
            space = True
        else:
            out.append(c)
            space = False
    return "".join(out)


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 0])
def test_exact_dedup(odd_docs, broadcast_bytes):
    got = exact_dedup(odd_docs, broadcast_bytes).collect()
    texts = [(i, squeeze(t)) for i, t in odd_texts()]
    n = Counter(t for _, t in texts)
    keep = {t: min((i for i, u in texts if u == t and i is not None), default=None) for t in n}
    want = Counter((i, keep[t], n[t], i == keep[t], sha(t.encode())) for i, t in texts)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got) == want


def test_exact_dedup_empty(no_docs):
    assert exact_dedup(no_docs).collect() == []


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 5), max_size=20), max_size=5), st.sampled_from([0, 1, 7, 40]))
def test_quotient_filters_merge_without_loss(parts, bits):
    merged = CountingQuotientFilter(bits)
    for p in parts:
        one = CountingQuotientFilter(bits)
        one.add(np.array(p, np.uint64))
        for block in one.blocks():
            merged.add_block(*block)
    assert dict(zip(merged.fp.tolist(), merged.count.tolist())) == Counter(x for p in parts for x in p)


def test_quotient_filter_takes_many_small_runs():
    fps = np.random.default_rng(3).integers(0, 2**20, 300_000, dtype=np.uint64)
    one = CountingQuotientFilter(0)
    began = time.perf_counter()
    for lo in range(0, len(fps), 2):
        one.add(fps[lo : lo + 2])
    values, counts = np.unique(fps, return_counts=True)
    assert np.array_equal(one.fp, values) and np.array_equal(one.count, counts)
    assert time.perf_counter() - began < 20  # merging at each run would take hours


def test_bpe_matches_the_library(odd_docs):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for i, t in odd_texts():
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), np.array(ids, "<u4").tobytes(), tok.decode(ids, skip_special_tokens=False)] += 1
    got = bpe_encode(odd_docs).collect()
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in got) == want


def test_bpe_empty(no_docs):
    assert bpe_encode(no_docs).collect() == []


@settings(max_examples=200, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.text(st.sampled_from("abcdehinorst'019 <|>!éÉ́\xa0\x85\x1cİß漢\n\t") | st.characters(exclude_categories=("Cs",)), max_size=60))
def test_bpe_any_text(text):
    path = public_tokenizers.path("word_bpe_49k.json")
    bpe, tok = SpeculativeBPE.at(path), Tokenizer.from_file(path)
    ids = tok.encode(text, add_special_tokens=False).ids
    raw, decoded = bpe.encode([text])[0]
    assert np.frombuffer(raw, "<u4").tolist() == ids
    assert decoded == tok.decode(ids, skip_special_tokens=False) == bpe.decode(raw)


def test_bpe_long_words():
    path = public_tokenizers.path("word_bpe_49k.json")
    bpe, tok = SpeculativeBPE.at(path), Tokenizer.from_file(path)
    rng = np.random.default_rng(3)
    for w in ("a" * 4001, "".join(rng.choice(list("abcdeinrsto"), 3000))):
        assert np.frombuffer(bpe.encode([w])[0][0], "<u4").tolist() == tok.encode(w, add_special_tokens=False).ids


def test_packing(odd_docs):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, t in odd_texts():
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        want.update((i, k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())) for k, (s, n) in enumerate(cut(len(ids), 1024)))
    places = pack_documents(odd_docs)
    got = places.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 1024
    whole = packed_sequences(odd_docs, places).collect()
    assert sorted(r.sequence_id for r in whole) == sorted(seqs)
    assert all(len(r.ids) == 4 * r.n_tokens == 4 * sum(n for _, n in seqs[r.sequence_id]) for r in whole)


def test_packing_empty(no_docs):
    assert pack_documents(no_docs).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(0, 40), max_size=20))
def test_plan_places_every_piece_once(counts):
    rows = plan_best_fit(counts, 50)
    bins, seen = defaultdict(list), Counter()
    for length, rank, n, seq, offset in rows:
        for k in range(n):
            bins[seq + k].append((offset, length))
            seen[length, rank + k] += 1
    assert seen == Counter({(k, r): 1 for k, c in counts.items() for r in range(c)})
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 50
    # best fit decreasing stays under 11/9 of the least number, plus one
    assert len(bins) <= 11 / 9 * -(-sum(k * c for k, c in counts.items()) // 25) + 1


@settings(max_examples=100, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.text(st.sampled_from("ab 1'sé\n\t\r \xa0　\x85\x1c<|endoftext|>") | st.characters(exclude_categories=("Cs",)), max_size=60))
def test_unit_encoder_any_text(text):
    from skylane.llm.tokens import UnitEncoder

    path = public_tokenizers.path("byte_bpe_50k.json")
    assert np.frombuffer(UnitEncoder.at(path).encode([text])[0], "<u4").tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_token_pieces_cut_only_long_documents():
    assert cut(0, 10) == [(0, 0)] and cut(10, 10) == [(0, 10)] and cut(21, 10) == [(0, 1), (1, 10), (11, 10)] and cut(20, 10) == [(0, 10), (10, 10)]
    assert token_pieces.__doc__


def test_licenses(odd_docs, spark):
    rows = {r.doc_id: r for r in scan_licenses(odd_docs).collect()}
    r = rows[14]
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == (8, 1, 3, 3, "mit", "mit,rights-reserved", 1.0)
    r = rows[1]
    assert (r.n_words, r.n_base, r.first_word, r.base_labels, r.labels, r.score) == (0, 0, None, "", "", 0.0)
    more = spark.createDataFrame(
        [(1, "The MIT-License, the GENERAL public\nlicense"), (2, "w " * 500 + "licensed under CC BY NC 4 0 " + "v " * 500), (3, "license mit"), (4, "All rights"), (5, "mité license K")],
        "doc_id long, text string",
    )
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 3)) for r in scan_licenses(more).collect()}
    assert got[1] == (7, 2, 1, 4, "gpl,mit", "gpl,mit", 1.0)
    assert got[2][1:] == (0, None, None, "", "cc", 0.8)
    assert got[3] == (2, 0, None, None, "", "", 0.0) and got[4][5] == "" and got[5][1] == 0


def test_licenses_wrapped_over_lines(spark):
    """Each template with 1 to 5 words a line behind a comment mark, at several places of a text."""
    rows, want = [], {}
    for label, t in TEMPLATES:
        ws = t.split()
        for n in (1, 2, 3, 5):
            for before in (0, 13, 30, 45):
                notice = "\n".join(" * " + " ".join(ws[i : i + n]) for i in range(0, len(ws), n))
                want[len(rows)] = label
                rows.append((len(rows), "code\n" * before + notice + "\n" + "more code\n" * 30))
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, label in want.items():
        assert label in got[i].labels.split(",") and got[i].score == 1.0, rows[i]


def test_licenses_need_the_words_in_order(spark):
    texts = ["He reserved a table and talked about human rights to all", "the license of MIT under the sea was released", "All rights of way are reserved"]
    got = scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [(r.labels, r.score) for r in got] == [("", 0.0)] * 3


def test_licenses_against_brute_force(spark):
    """Templates with changed, dropped and repeated words, in texts that hold internal names as columns."""
    rng = np.random.default_rng(11)
    rows = []
    for _, t in TEMPLATES:
        for change in (0.02, 0.08, 0.2):
            ws = [w if rng.random() > change else rng.choice(["", "other", w + " " + w]) for w in t.split()]
            lead = ["Kind"] * int(rng.integers(0, 60))
            rows.append((len(rows), " ".join([*lead, *ws, "and", "the", "software", "is", "provided", *ws[:5]]), "r", "h", "b", "l", "t", "w"))
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, hits string, block string, places string, rest string, `more` string")
    got = scan_licenses(df)
    assert got.columns[:7] == ["doc_id", "row", "hits", "block", "places", "rest", "more"]
    for r in got.collect():
        ws = template_words(rows[r.doc_id][1])
        labels, best = set(), 0.0
        for label, t in TEMPLATES:
            size, s = len(template_words(t)), set(template_tokens(t))
            for o in range(0, max(len(ws) - size, 1), size):
                share = len(s & {f"{a} {b}" for a, b in zip(ws[o : o + 2 * size], ws[o + 1 : o + 2 * size])}) / len(s)
                if share >= 0.8 - 1e-9:
                    labels.add(label)
                    best = max(best, share)
        base = {label for p, label in PHRASES.items() if f" {p} " in f" {' '.join(ws)} "}
        assert (r.labels, r.score) == (",".join(sorted(labels | base)), 1.0 if base else best)
        assert (r.row, r.hits, r.rest) == ("r", "h", "t") and r.n_words == len(ws)


def test_licenses_empty(no_docs):
    assert scan_licenses(no_docs).collect() == []


def test_line_dedup(spark, odd_docs, no_docs):
    bodies = {i: f"Unique line number {'abcdefghij'[i]} of text\nVisits today: {i * 7} from host{i}\n\nEnd {'abcdefghij'[i] * 3}" for i in range(5)}
    df = spark.createDataFrame([*bodies.items(), (9, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup(df, min_docs=3, fixed=0.5).collect()}
    for i in bodies:
        # the counter line is one template; the first line is too, as one word of six varies
        assert (got[i].n_lines, got[i].n_dropped) == (4, 2)
        assert got[i].kept_text == f"\nEnd {'abcdefghij'[i] * 3}"
    assert (got[9].n_lines, got[9].n_dropped, got[9].kept_text) == (1, 0, "")
    assert line_dedup(odd_docs).count() == len(odd_texts())
    assert line_dedup(no_docs).collect() == []


def test_line_dedup_in_a_large_leaf(spark):
    """Values of a field stay variable when each recurs often; a second template shares the leaf."""
    names, cities = "Ann Bob Cy Di Ed Flo Gus Hal".split(), "Oslo Rome Paris Bonn Kyiv Lima Cork Riga".split()
    for copies in (1, 5):
        visits = [f"Visits to the site from {a} in {b}" for a in names * copies for b in cities]
        mails = [f"Visits to the page by {a} on {b}" for a in names[:4] for b in cities[:4]]
        rows = [*enumerate(visits + mails), (-1, "Visits to the old pond were quiet once")]
        got = {r.doc_id: r.n_dropped for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got.pop(-1) == 0 and len(got) == 64 * copies + 16 and set(got.values()) == {1}


def test_line_dedup_equals_its_sql(spark):
    """Large leaves, two templates in a leaf, verbatim lines with digits and odd white space, as DuckDB sees them."""
    rng = np.random.default_rng(4)
    names, cities = "Ann Bob Cy Di Ed Flo Gus Hal".split(), "Oslo Rome Paris Bonn Kyiv Lima Cork Riga".split()
    lines = [f"Visits to the site from {a} in {b}" for a in names for b in cities]
    lines += [f"Visits to the page by {a} on {b}" for a in names[:4] for b in cities[:4]]
    lines += ["Page 3 of 10", "Copyright 2024", "12:30", " 555  0199\t12 ", "<*> <*>", "1 2", "", "Visits to the old pond were quiet once", "a<*>b 7"]
    lines += [f"Page {i} of 1{i}" for i in range(5)] + [f"the {a} went {b}" for a in names for b in cities]
    rows = [(i, "\n".join(rng.choice(lines, size=rng.integers(0, 9)))) for i in range(160)] + [(200, None), (201, "\n\n")]
    got = line_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, sha((r.kept_text).encode())) for r in got.collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = con.execute("SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM (" + SQL["op3_line_dedup"] + ")").fetchall()
    assert got == Counter(map(tuple, want))
    assert sum(n for _, _, n, _ in want) > 100


@pytest.mark.parametrize("operator", [substring_dedup, simhash_dedup, line_dedup, exact_dedup, scan_licenses, embedding_dedup])
def test_columns_with_internal_names_come_back(spark, operator):
    names = ["__id", "__tx", "__fp", "__v", "__gone", "__kept", "__spans", "__anchors", "__mine", "__norm", "first", "row", "rest"]
    text = "one two three four five " * 9
    rows = [(i, text, [1.0, float(i % 2)], {"a": i}, *[f"{c} {i}" for c in names]) for i in range(4)]
    extra = ", ".join(f"{c} string" for c in names)
    df = spark.createDataFrame(rows, f"doc_id long, text string, embedding array<double>, notes map<string,int>, {extra}")
    if operator is embedding_dedup:
        df = df.withColumnRenamed("doc_id", "vec_id")
    got = operator(df)
    assert set(names) | {"notes"} <= set(got.columns)
    id_col = got.columns[got.columns.index("vec_id" if operator is embedding_dedup else "doc_id")]
    for r in got.collect():
        assert [r[c] for c in names] == [f"{c} {r[id_col]}" for c in names] and r["notes"] == {"a": r[id_col]}


def test_line_dedup_of_verbatim_lines_with_digits(spark):
    """Lines that are mostly fields go when three documents have them as they stand, not when only the fields match."""
    same = ["Page 3 of 10", "Copyright 2024", "12:30", " 555  0199\t12 "]
    rows = [(i, "\n".join([*same, f"Page {i} of 1{i}", f"1{i}:45", "<*> <*>" if i < 2 else "1 2"])) for i in range(4)]
    got = {r.doc_id: r for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in range(4):
        assert got[i].n_dropped == 4 and got[i].kept_text == "\n".join(rows[i][1].split("\n")[4:])


def test_grammar_tells_patterns_apart():
    g = Grammar({"zorb": 2.0})
    of = lambda t: [p for c in g.clauses(t) for p, _ in c]
    assert of("You are an idiot") == ["insult_at_target"]
    assert of("an idiot") == ["insult"]
    assert of("a total idiot") == ["strong_insult"]
    assert of("You are not an idiot") == ["negated_insult"]
    assert of("the man said such an idiot") == ["reported_insult"]
    assert of("I will kill you") == ["threat"]
    assert of("He wrote: I will kill you. Nice day") == ["threat"]
    assert of("he wrote that I will kill you") == ["reported_threat"]
    assert of("I will not kill you") == ["negated_threat"]
    assert of("kill the process") == [] and of("a nice day") == [] and of("zorb") == ["learned"]
    assert of("you zorb") == ["learned_at_target"] and of("not a zorb") == ["negated_learned"] and of("they say zorb") == ["reported_learned"]


def plain_patterns(text, learned):
    """The patterns of a text by looking back from each word, without states."""
    out = []
    kind = {w: c for c, ws in WORDS.items() for w in ws} | dict.fromkeys(learned, "learned") | dict.fromkeys('"“”«»', "report")
    for clause in re.split(r"[.!?;:\n]+", text.lower()):
        ws = re.findall(r"[^\W\d_]+(?:'[^\W\d_]+)*|[\"“”«»]", clause)
        ks = [kind.get(w, "other") for w in ws]
        if not any(k in ("insult", "harm", "learned") for k in ks):
            continue
        begun = 0  # a threat takes words from here on only
        for i, k in enumerate(ks):
            near = lambda c, n: c in ks[max(0, i - n + 1) : i + 1]
            base = None
            if k in ("insult", "learned"):
                base, form = k, f"{k}_at_target" if near("target", 6) else "strong_insult" if k == "insult" and i and ks[i - 1] == "intensifier" else k
            elif k == "target":
                # intention, then harm within reach of it, then this person within reach of the harm
                for j in range(max(begun, i - 6), i):
                    since = [m for m in range(max(begun, j - 6), j) if ks[m] == "intent"]
                    # the last intention or harm before it decides
                    later = [m for m in range(j + 1, i) if ks[m] == "intent"]
                    if ks[j] == "harm" and since and not later:
                        base = form = "threat"
                if base:
                    begun = i + 1
            if base:
                out.append(f"negated_{base}" if near("negation", 3) else f"reported_{base}" if "report" in ks[: i + 1] else form)
    return out


@settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from("you idiot not so he will said zorb day of the . , kill".split()), max_size=14))
def test_grammar_against_a_reader_without_states(words):
    g = Grammar({"zorb": 2.0})
    text = " ".join(words)
    assert [p for c in g.clauses(text) for p, _ in c] == plain_patterns(text, ["zorb"])


SAID = ["I will kill you", "you are an idiot", "an idiot", "he said an idiot came", "you are not an idiot", "a nice day"]


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_fitted_weights_keep_the_order_of_the_patterns(spark, sf):
    d = f"/root/testdata/sf{sf}"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    for model in (ToxicityModel(), fit_toxicity(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"))):
        threat, at, plain, said, negated, none = model.scores(SAID)
        assert threat >= 0.3 and at >= 0.3 and at >= plain > said >= negated and none >= negated and negated < 0.3 and none < 0.3


def test_toxicity(spark, odd_docs, no_docs):
    base = ToxicityModel()
    rows = score_toxicity(odd_docs, base).collect()
    assert len(rows) == len(odd_texts()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    by = {r.doc_id: r.score for r in rows}
    assert by[12] > 0.3 > by[1] == by[2]
    docs = spark.createDataFrame([(i, f"some words here {i} " + ("blorgh you fool" if i % 3 == 0 else "nice")) for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(400)] + [(5, None), (None, 1)], "doc_id long, toxic int")
    model = fit_toxicity(docs, labels)
    assert "blorgh" in model.learned
    scored = score_toxicity(docs, model).collect()
    assert all(r.predicted == int(r.doc_id % 3 == 0) for r in scored)
    none = labels.limit(0)
    assert fit_toxicity(docs, none).weights == base.weights
    assert score_toxicity(no_docs, base).collect() == [] and fit_toxicity(no_docs, labels).learned == {}


@pytest.mark.parametrize("rows", [40, 2_000, 20_000])
def test_fits_of_cleanly_parted_classes_stay_in_place(rows):
    """However many rows, and however strong their patterns, texts without a pattern score low and insults high."""
    rng = np.random.default_rng(6)
    y = (np.arange(rows) % 8 == 0).astype(float)
    x = np.zeros((rows, len(PATTERNS)))
    for p in ("insult", "insult_at_target", "learned"):
        x[y == 1, PATTERNS.index(p)] = np.log1p(rng.integers(1, 60, int(y.sum())))
    for toxic in (x, np.where(rng.random(x.shape) < 0.01, 1.0, x)):
        weights, bias = _fit_logistic(toxic, y)
        score = 1 / (1 + np.exp(-(toxic @ np.array(weights) + bias)))
        assert np.isfinite(weights).all() and bias < -2
        assert (score[(y == 0) & ~toxic.any(axis=1)] < 0.1).all() and (score[y == 1] > 0.5).all()


def test_held_out_rows_do_not_teach(spark):
    docs = spark.createDataFrame([(i, "bad" if zlib.crc32(str(i).encode()) % 4 == 2 else "good") for i in range(200)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("text") == "bad").cast("int").alias("toxic"))
    assert fit_toxicity(docs, labels).learned == {}


def test_line_dedup_masks_a_line_once(spark, monkeypatch):
    """The first pass over the texts masks in one step alone, and leaves too many to broadcast give the same rows."""
    plans, write = [], Stash.write
    monkeypatch.setattr(Stash, "write", lambda self, df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or write(self, df))
    lines = [f"the {a} went {b} at {k}" for a in ("dog", "cat") for b in ("home", "away", "home") for k in range(4)] + [" \t\x0b", "", "7 8"]
    rows = [(i, "\n".join(lines[i % 5 :: 1 + i % 4])) for i in range(40)] + [(3, None), (3, lines[0]), (4, "\n".join(lines[4:]))]
    src = keyed(spark.createDataFrame(rows, "doc_id long, text string"))
    gone = [{(r[0], r[1]): sorted(r[2]) for r in recurring_lines(src, 3, 0.6, most).collect()} for most in (1 << 26, 0)]
    assert gone[0] == gone[1] and gone[0]
    steps = [x for x in plans[0].splitlines() if "[0-9]" in x]
    assert len(steps) == 1 and "Filter" not in steps[0]
