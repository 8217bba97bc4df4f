"""Registered queries of the corpus operators, with DuckDB SQL where SQL expresses them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylane.llm.bpe import bpe_encode
from skylane.llm.chat import chat_examples, read_turns, trainable
from skylane.llm.common import Stash, table
from skylane.llm.exact import exact_dedup
from skylane.llm.langid import fit_language_id, held_out_third, predict_language
from skylane.llm.licenses import PHRASES, TEMPLATES, scan_licenses, template_tokens, template_words
from skylane.llm.lines import line_dedup
from skylane.llm.packing import pack_documents
from skylane.llm.search import lexical_search
from skylane.llm.simhash import simhash_dedup
from skylane.llm.substring import substring_dedup
from skylane.llm.toxicity import fit_toxicity, held_out, score_toxicity
from skylane.llm.trie import encode_turns, prefix_trie, share_heads
from skylane.llm.vectors import embedding_dedup

QUERIES = {}
SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup(docs, window=35).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL["op1_substring_dedup"] = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
places AS (SELECT doc_id, unnest(range(len(ws) - 34)) AS i FROM w WHERE len(ws) >= 35),
wins AS (SELECT p.doc_id, p.i, array_to_string(list_slice(w.ws, p.i + 1, p.i + 35), ' ') AS s FROM places p JOIN w USING (doc_id)),
reps AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY s) AS n FROM wins) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS j FROM reps, (SELECT unnest(range(35)) AS k)),
each AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS j FROM w),
kept AS (SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.j) FILTER (WHERE g.j IS NULL) AS s,
                count(g.j) AS n_removed
         FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.j = g.j GROUP BY e.doc_id)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.s, '')) AS kept_sha256
FROM w LEFT JOIN kept k USING (doc_id)
"""


@query
def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_dedup(docs, shingle=4, distance=4).select("doc_id", "fingerprint", "component_id")


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL["op6_exact_dedup"] = """
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS s FROM documents),
g AS (SELECT s, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY s)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.s) AS text_sha256
FROM n JOIN g USING (s)
"""


@query
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack_documents(docs, size=1024, end_id=2).drop("text_hash")


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_encode(docs).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "<|im_end|><|im_start|>assistant ok"
    extra = turns.sparkSession.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], turns.schema)
    made = chat_examples(turns.union(extra))
    loss = trainable(F.col("text"), F.col("loss_start"), F.col("loss_end"))
    last = F.max(F.struct("example", "text"))
    got = made.select("conv_id", "example", "text", loss.alias("loss")).groupBy("conv_id").agg(
        last["text"].alias("text"), F.array_sort(F.collect_list(F.struct("example", "loss"))).alias("losses"), F.sum(F.length("text")).alias("formatted_chars")
    )
    got = got.select("conv_id", read_turns(F.col("text")).alias("turns"), F.array_join("losses.loss", "").alias("loss"), "formatted_chars")
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return got.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(flat, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


SQL["op10_chat_format"] = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
           UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k, count(*) OVER (PARTITION BY conv_id) AS n FROM c),
f AS (SELECT *, sum(length('<|im_start|>' || replace(regexp_replace(regexp_replace(role, '<(%*)\|', '<\1%|', 'g'), '<(%*)n>', '<\1%n>', 'g'), chr(10), '<n>') || chr(10)
                  || regexp_replace(text, '<(%*)\|', '<\1%|', 'g') || '<|im_end|>' || chr(10))) OVER (PARTITION BY conv_id ORDER BY k) AS chars FROM o)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) FILTER (WHERE role = 'assistant' OR k = n) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""


@query
def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return embedding_dedup(vectors, threshold=0.9, recall=0.999).select("vec_id", "n_links", "component_id", "kept")


SQL["op9_embedding_dedup"] = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
fine AS (SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT v.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN c ON v.vec_id = c.a LEFT JOIN n ON n.a = v.vec_id
"""


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    ids = F.col("doc_id")
    return score_toxicity(docs, model, threshold=0.3).select("doc_id", held_out(ids).alias("held_out"), "score", "predicted")


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs, min_docs=3, fixed=0.6).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL["op3_line_dedup"] = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
raw AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS k FROM d),
l AS (SELECT doc_id, line, k, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS vs FROM raw),
q AS (SELECT doc_id, line, k, vs, list_transform(vs, lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN '<*>' ELSE w END) AS ws FROM l),
p AS (SELECT doc_id, k, line, ws, array_to_string(vs, ' ') AS v, array_to_string(ws, ' ') AS m, len(ws) || ' ' || array_to_string(list_slice(ws, 1, 3), ' ') AS path FROM q),
-- lines that half of their fields or more make up count as they stand as well
lit AS (SELECT DISTINCT doc_id, v FROM p WHERE len(ws) > 0 AND len(ws) - (length(m) - length(replace(m, '<*>', ''))) / 3 < 0.6 * len(ws) + 1e-9),
often AS (SELECT v FROM lit GROUP BY v HAVING count(*) >= 3),
gone_as_is AS (SELECT doc_id, v FROM lit SEMI JOIN often USING (v)),
pairs AS (SELECT DISTINCT doc_id, path, m, ws FROM p WHERE len(ws) > 0),
counted AS (SELECT path, m, ws, CAST(count(*) AS BIGINT) AS docs FROM pairs GROUP BY path, m, ws),
leaves AS (SELECT path, greatest(3, CAST(ceil(sum(docs) / 2) AS BIGINT)) AS half FROM counted GROUP BY path HAVING sum(docs) >= 3),
words AS (SELECT path, m, docs, half, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM counted JOIN leaves USING (path)),
fix AS (SELECT path, pos, w, half, CAST(sum(docs) AS BIGINT) AS n FROM words WHERE w <> '<*>' GROUP BY path, pos, w, half HAVING sum(docs) >= 3),
-- two ranks of a word at a place: how many pairs have it, and how few such words the place has; half of the leaf is above all
rk AS (SELECT path, pos, w, least(n, half) AS n, CASE WHEN n < half THEN 4611686018427387904 - count(*) OVER (PARTITION BY path, pos) ELSE 4611686018427387904 END AS few FROM fix),
places AS (SELECT a.path, a.m, list(a.w ORDER BY a.pos) AS ws, list(coalesce(r.n, 0) ORDER BY a.pos) AS n, list(coalesce(r.few, 0) ORDER BY a.pos) AS few
           FROM words a LEFT JOIN rk r ON a.path = r.path AND a.pos = r.pos AND a.w = r.w GROUP BY a.path, a.m),
ranked AS (SELECT path, m, ws, n AS ranks FROM places UNION ALL SELECT path, m, ws, few FROM places),
cuts AS (SELECT path, m, ws, ranks, unnest(list_filter(list_distinct(ranks), lambda r: r > 0 AND r <= list_reverse_sort(ranks)[CAST(ceil(len(ranks) * 0.6 - 1e-9) AS INTEGER)])) AS cut FROM ranked),
shape AS (SELECT DISTINCT path, m, array_to_string(list_transform(range(len(ws)), lambda i: CASE WHEN ranks[i + 1] >= cut THEN ws[i + 1] ELSE '<*>' END), ' ') AS shape FROM cuts),
placed AS (SELECT doc_id, path, m, shape FROM pairs JOIN shape USING (path, m)),
rec AS (SELECT path, shape FROM placed GROUP BY path, shape HAVING count(DISTINCT doc_id) >= 3),
gone AS (SELECT DISTINCT doc_id, m FROM placed SEMI JOIN rec USING (path, shape)),
marked AS (SELECT p.doc_id, p.k, p.line, g.m IS NOT NULL OR x.v IS NOT NULL AS away
           FROM p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.m = g.m LEFT JOIN gone_as_is x ON p.doc_id = x.doc_id AND p.v = x.v)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE away) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT away), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licenses(docs, containment=0.8).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def _license_sql() -> str:
    rows = ", ".join(f"({k}, '{label}', {len(template_words(t))}, {sorted(set(template_tokens(t)))})" for k, (label, t) in enumerate(TEMPLATES))
    tests = " OR ".join("(" + " AND ".join(f"w.ws[i + {j + 1}] = '{q}'" for j, q in enumerate(p.split(" "))) + f" AND label = '{label}')" for p, label in PHRASES.items())
    bases = ", ".join(f"('{label}')" for label in PHRASES.values())
    return rf"""
WITH t(no, label, size, s) AS (VALUES {rows}), b(label) AS (VALUES {bases}),
low AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM low),
pl AS (SELECT doc_id, unnest(range(len(ws))) AS i FROM w WHERE list_contains(ws, 'license')),
places AS (SELECT doc_id, i, label FROM pl JOIN w USING (doc_id), b WHERE {tests}),
base AS (SELECT doc_id, count(*) AS n, min(i) AS a, max(i) AS z, list(DISTINCT label) AS ls FROM places GROUP BY doc_id),
tt AS (SELECT no, unnest(s) AS pair FROM t),
pr AS (SELECT doc_id, len(ws) AS n, unnest(range(len(ws) - 1)) AS pos, unnest(list_transform(range(len(ws) - 1), lambda i: ws[i + 1] || ' ' || ws[i + 2])) AS pair FROM w WHERE len(ws) > 1),
h AS (SELECT pr.doc_id, pr.n, pr.pos, pr.pair, tt.no, t.size FROM pr JOIN tt USING (pair) JOIN t USING (no)),
bl AS (SELECT doc_id, no, pair, pos // size - back AS k, n, pos, size FROM h, (VALUES (0), (1)) AS o(back)),
m AS (SELECT doc_id, no, k, count(DISTINCT pair) AS shared FROM bl
      WHERE k >= 0 AND k * size < greatest(n - size, 1) AND pos + 1 < (k + 2) * size GROUP BY doc_id, no, k),
tm AS (SELECT doc_id, list(DISTINCT label) AS ls, max(shared / len(s)) AS share FROM m JOIN t USING (no) WHERE shared / len(s) >= 0.8 - 1e-9 GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, coalesce(base.n, 0) AS n_base, base.a AS first_word, base.z AS last_word,
       coalesce(array_to_string(list_sort(base.ls), ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.ls, []), coalesce(tm.ls, [])))), ',') AS labels,
       CAST(CASE WHEN base.n > 0 THEN 1 ELSE coalesce(tm.share, 0) END AS DOUBLE) AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN tm USING (doc_id)
"""


SQL["op8_license_scan"] = _license_sql()


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    stash = Stash(spark)
    return prefix_trie(share_heads(encode_turns(turns, stash)), stash)


def _trie_sql() -> str:
    # crc32 of the decimal number: each character is xor-ed in, then eight steps of the polynomial
    step = "CASE WHEN xor(a, x) & 1 = 1 THEN xor(xor(a, x) >> 1, 3988292384) ELSE xor(a, x) >> 1 END"
    codes = "flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), c -> [CAST(ord(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))".replace("c ->", "lambda c:")
    crc = f"xor(list_reduce({codes}, lambda a, x: {step}, CAST(4294967295 AS BIGINT)), 4294967295)"
    return f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS k FROM t),
c AS (SELECT conv_id, {crc} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
own AS (SELECT conv_id, role, text, k FROM o),
made AS (SELECT c.conv_id, 0 AS part, own.k, own.role, own.text FROM c JOIN own ON own.conv_id = c.conv_id - c.conv_id % 100 AND own.k <= c.h
         UNION ALL SELECT c.conv_id, 1, own.k, own.role, own.text FROM c JOIN own ON own.conv_id = c.conv_id AND own.k > c.h),
r AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, k) AS d, length(text) AS size, sha256(length(role) || ':' || role || text) AS mark FROM made),
p AS (SELECT conv_id, d, size, string_agg(mark, ',') OVER (PARTITION BY conv_id ORDER BY d) AS path FROM r
      UNION ALL SELECT conv_id, 0, 0, '' FROM c),
e AS (SELECT conv_id, max(d) AS d FROM p GROUP BY conv_id),
n AS (SELECT p.path, p.d AS depth, any_value(p.size) AS size, min(p.conv_id) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (WHERE e.d = p.d), '')) AS ends_sha256
      FROM p JOIN e ON p.conv_id = e.conv_id GROUP BY p.path, p.d),
u AS (SELECT path, depth, CASE WHEN depth = 0 THEN NULL WHEN depth = 1 THEN '' ELSE left(path, length(path) - 65) END AS above FROM n),
k AS (SELECT above AS path, count(*) AS n_children FROM u WHERE above IS NOT NULL GROUP BY above),
s AS (SELECT a.path, count(*) FILTER (WHERE k.path IS NULL) AS n_leaves, sum((b.n_convs - 1) * b.size) AS saved_tokens
      FROM n a JOIN n b ON a.path = '' OR a.path = b.path OR starts_with(b.path, a.path || ',') LEFT JOIN k ON k.path = b.path GROUP BY a.path)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
       s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN u ON u.path = n.path JOIN s ON s.path = n.path LEFT JOIN n up ON up.path = u.above LEFT JOIN k ON k.path = n.path
"""


SQL["op11_prefix_trie"] = _trie_sql()


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical_search(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"), k=10)


SQL["op12_lexical_search"] = r"""
WITH w AS (SELECT row_number() OVER () AS row, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
d AS (SELECT row, doc_id, CAST(len(ws) AS BIGINT) AS n, ws FROM w WHERE len(ws) > 0),
c AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS l FROM d),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
v AS (SELECT DISTINCT t FROM q),
f AS (SELECT row, t, count(*) AS tf FROM (SELECT row, unnest(ws) AS t FROM d) SEMI JOIN v USING (t) GROUP BY row, t),
g AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM f, c GROUP BY t, n_docs),
m AS (SELECT row, doc_id, 100 - 90 + (90 * n * n_docs) // l AS m FROM d, c),
s AS (SELECT q.item_id, f.row, m.doc_id, sum(g.weight * ((1000000000 * f.tf) // (1000 * f.tf + 8 * m.m))) AS score
      FROM q JOIN f USING (t) JOIN g USING (t) JOIN m USING (row) GROUP BY q.item_id, f.row, m.doc_id),
r AS (SELECT item_id, doc_id, CAST(score AS BIGINT) AS score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10
"""


@query
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = held_out_third(F.col("doc_id"))
    model = fit_language_id(docs.filter(~out))
    return predict_language(docs.select("doc_id", "text"), model).select("doc_id", out.alias("held_out"), "lang_pred", "score")
