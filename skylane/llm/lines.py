"""Line dedup with a log-template tree: lines that recur across documents go.

The tree has a fixed depth: a line's path is its number of words and its first
``LEAD`` words, where a word with a digit is a variable field. In a leaf, a word at
a place is variable too if fewer than ``min_docs`` (document, line) pairs of the leaf
have it there. How many pairs a field's value has grows with the leaf, so the words left
are ranked in two ways, by how many pairs have them and by how few such words their
place has, and a line has one template for each cut in either rank: words below it are
variable. Words that half of the leaf's pairs have are below none. A line goes if
``min_docs`` documents have one of its templates; a template must fix at least
``fixed`` of its words, or unrelated lines of one length would count as one. A line that
``min_docs`` documents have word for word goes however many of its words hold a digit.

Equal lines are counted once, by hashes, before anything is compared; only lines of
leaves with ``min_docs`` pairs are spelled out. DataFrame functions only.

Defined results: null text counts as empty; lines end at line feeds; lines
without a word stay; rows equal in id and text are one document and lose the
same lines; other columns are passed on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylane.llm.common import WHITE, Stash, keyed, sheltered, sized
from skylane.operators.joins import MAX_BROADCAST_BYTES

LEAD = 3
MASK = "<*>"
_TOP = 1 << 62
_BLANK = " \t\n\x0b\x0c\r"
_FIELD = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*"


def spaced(line: Column, fields: Column) -> Column:
    """``fields``, which has the white space of ``line``, with one space between words.

    Patterns run only where something is to be replaced.
    """
    # masking leaves white space alone, so the line as it stands shows whether there is any to replace
    odd = reduce(lambda a, b: a | b, [F.contains(line, F.lit(x)) for x in ("\t", "\x0b", "\x0c", "\r", "  ")])
    odd = odd | F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" "))
    return F.when(odd, F.trim(F.regexp_replace(fields, WHITE, " "))).otherwise(fields)


def masked(line: Column) -> Column:
    """The words of a line joined by one space, words with a digit as variable fields."""
    return spaced(line, F.when(F.rlike(line, F.lit("[0-9]")), F.regexp_replace(line, _FIELD, MASK)).otherwise(line))


def verbatim(line: Column) -> Column:
    """Hash of the words of a line as they stand; the literal keeps it apart from hashes of masked lines."""
    return F.xxhash64(spaced(line, line), F.lit(1))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _worded(raw: str) -> Column:
    """Whether a line has a word; tested on the line as it stands, so that masking is left to one step."""
    return F.trim(raw, F.lit(_BLANK)) != ""


def _leaves(lines: DataFrame) -> DataFrame:
    """``lines`` (line: masked, not empty) with n (words), path and hash."""
    spaces = F.octet_length("line") - F.octet_length(F.replace(F.col("line"), F.lit(" "), F.lit("")))
    lines = lines.select("*", spaces.alias("__spaces"))
    path = F.xxhash64("__spaces", F.substring_index("line", " ", LEAD))
    return lines.select("*", (F.col("__spaces") + 1).alias("n"), path.alias("path"), F.xxhash64("line").alias("hash")).drop("__spaces")


def _templates(rank: str, fixed: float) -> Column:
    """Hashes of a line's ``places`` at each cut in ``rank`` that fixes enough words."""
    ranks = F.col(f"places.{rank}")
    # the rank of the last word that must be fixed bounds the cuts
    most = F.get(F.sort_array(ranks, asc=False), (F.ceil(F.size(ranks) * fixed - 1e-9) - 1).cast("int"))
    cuts = F.filter(F.array_distinct(ranks), lambda r: (r > 0) & (r <= most))
    return F.transform(cuts, lambda cut: F.xxhash64("path", F.array_join(F.transform("places", lambda x: F.when(x[rank] >= cut, x["word"]).otherwise(MASK)), " ")))


def recurring_lines(src: DataFrame, min_docs: int, fixed: float, broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """(__id, __tx, __gone): hashes of the lines, masked or verbatim, that ``keyed`` documents lose."""
    key = ["__id", "__tx"]
    stash = Stash(src.sparkSession)
    each = src.select(*key, F.posexplode(_lines(F.col("text"))).alias("at", "raw")).filter(_worded("raw"))
    each = _leaves(each.select(*key, "at", "raw", masked(F.col("raw")).alias("line")))
    fields = (F.octet_length("line") - F.octet_length(F.replace(F.col("line"), F.lit(MASK), F.lit("")))) / len(MASK)
    # other lines that recur verbatim fix enough words; these have a second hash, without a path
    dense = F.col("n") - fields < fixed * F.col("n") + 1e-9
    named = F.struct("path", "hash")
    literal = F.struct(F.lit(None).cast("long").alias("path"), verbatim(F.col("raw")).alias("hash"))
    hashes = each.select(*key, "at", F.explode(F.when(dense, F.array(named, literal)).otherwise(F.array(named))).alias("x"))
    # one line of each document once, with its first place there
    each_once = stash.write(hashes.select(*key, "x.path", "x.hash", "at").groupBy(*key, "path", "hash").agg(F.min("at").alias("at")))
    pairs, dense = each_once.filter("path IS NOT NULL"), each_once.filter("path IS NULL").select(*key, "hash")
    # both written: most lines are alone in their leaf, and the steps below read the few that are left
    leaves = stash.write(pairs.groupBy("path").agg(F.count("*").alias("total")).filter(F.col("total") >= min_docs))
    near = stash.write(pairs.join(sized(leaves, broadcast_bytes).select("path"), "path"))
    # a line's first document spells it for all others
    counted = near.groupBy("path", "hash").agg(F.count("*").alias("docs"), F.min(F.struct(*key, "at")).alias("first"))
    wanted = counted.select("first.*", F.struct("path", "hash", "docs", "first.at").alias("x")).groupBy(*key).agg(F.collect_list("x").alias("__wanted"))
    # reads every column, so that this join and the last one share one exchange of the texts
    every = F.hash(*(c for c, t in src.dtypes if "map<" not in t and "variant" not in t))
    spelled = src.join(wanted, key).select(_lines(F.col("text")).alias("__lines"), F.explode(F.when(every >= -(1 << 31), F.col("__wanted"))).alias("x"))
    spelled = spelled.select("x.path", "x.hash", "x.docs", masked(F.get("__lines", F.col("x.at"))).alias("line"))
    # copies of a document spell it as well
    distinct = spelled.groupBy("path", "hash").agg(F.min("line").alias("line"), F.min("docs").alias("docs"))
    words = distinct.select("path", "hash", "docs", F.posexplode(F.split("line", " ")).alias("at", "word"))
    fix = words.filter(F.col("word") != MASK).groupBy("path", "at", "word").agg(F.sum("docs").alias("n")).filter(F.col("n") >= min_docs)
    many = fix.groupBy("path", "at").agg(F.count("*").alias("many"))
    half = F.greatest(F.lit(min_docs), F.ceil(F.col("total") / 2))
    few = F.when(F.col("n") < half, F.lit(_TOP) - F.col("many")).otherwise(_TOP)
    fix = fix.join(many, ["path", "at"]).join(sized(leaves, broadcast_bytes), "path").select("path", "at", "word", F.least("n", half).alias("n"), few.alias("few"))
    place = F.struct("at", "word", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "few")))
    places = words.join(fix, ["path", "at", "word"], "left").groupBy("path", "hash").agg(F.array_sort(F.collect_list(place)).alias("places"))
    shape = places.select("path", "hash", F.explode(F.array_union(_templates("n", fixed), _templates("few", fixed))).alias("template"))
    placed = near.join(shape, ["path", "hash"])
    recurring = placed.select(*key, "template").distinct().groupBy("template").agg(F.count("*").alias("n")).filter(F.col("n") >= min_docs).select("template")
    often = dense.groupBy("hash").agg(F.count("*").alias("n")).filter(F.col("n") >= min_docs).select("hash")
    gone = placed.join(recurring, "template").select(*key, "hash").unionByName(dense.join(often, "hash").select(*key, "hash"))
    return gone.groupBy(*key).agg(F.collect_set("hash").alias("__gone"))


@sheltered()
def line_dedup(docs: DataFrame, min_docs: int = 3, fixed: float = 0.6, kept: str = "kept_text") -> DataFrame:
    """``docs`` with n_lines, n_dropped and ``kept`` (the kept lines joined by line feeds)."""
    src = keyed(docs.drop("n_lines", "n_dropped", *([kept] if kept != "text" else [])))
    out = src.join(recurring_lines(src, min_docs, fixed), ["__id", "__tx"], "left").drop("__id", "__tx")
    out = out.withColumn("__lines", _lines(F.col("text")))
    stay = F.filter("__lines", lambda x: ~(F.array_contains("__gone", F.xxhash64(masked(x))) | F.array_contains("__gone", verbatim(x))))
    n = F.size("__lines")
    out = out.withColumn("__kept", F.when(F.col("__gone").isNotNull(), stay))
    return out.withColumns(
        {
            "n_lines": n.cast("long"),
            "n_dropped": F.when(F.col("__kept").isNull(), F.lit(0)).otherwise(n - F.size("__kept")).cast("long"),
            kept: F.when(F.col("__kept").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join("__kept", "\n")),
        }
    ).drop("__gone", "__kept", "__lines")
