"""Best-fit packing, planned on the histogram of piece lengths.

Documents become pieces of at most ``size`` tokens (only longer documents are cut; their
first piece takes the remainder). The driver sees one number per length, at
most ``size`` of them, and plans best fit on counts, longest first: a plan row fills equal places of a
range of sequences with pieces of one length. Pieces then take places by their rank
within their length. The rank is a counter of the task that wrote the piece plus the
counts of the tasks before it, so no length, however common, meets in one task.

Defined results: null text counts as empty, and an empty text is one piece with
the end id alone; repeated rows are packed like any other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skylane.llm.common import Stash, pieces, ship
from skylane.llm.tokens import UnitEncoder


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; the first takes the remainder."""
    if n <= size:
        return [(0, n)]
    head = n % size
    return ([(0, head)] if head else []) + [(s, size) for s in range(head, n, size)]


def _piece_batches(path: str, size: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = UnitEncoder.at(path)
        end = np.array([end_id], "<u4").tobytes()
        met = np.zeros(size + 1, np.int64)
        part_id = TaskContext.get().partitionId()
        for batch in batches:
            for part in pieces(batch, "text"):
                ids = enc.encode(part.column("text").to_pylist())
                doc, piece, start, length, crc, rank, raw = [], [], [], [], [], [], []
                for d, x in enumerate(ids):
                    x += end
                    for k, (s, n) in enumerate(cut(len(x) // 4, size)):
                        own = x[4 * s : 4 * (s + n)]
                        doc.append(d)
                        piece.append(k)
                        start.append(s)
                        length.append(n)
                        crc.append(zlib.crc32(own))
                        rank.append(met[n])
                        met[n] += 1
                        raw.append(own)
                take = pa.array(doc, pa.int64())
                cols = [part.column("doc_id").take(take), part.column("text_hash").take(take), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "text_hash", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols, names = [*cols, pa.array(raw, pa.binary())], [*names, "ids"]
                else:
                    cols, names = [*cols, pa.array(np.full(len(doc), part_id)), pa.array(rank, pa.int64())], [*names, "writer", "nth"]
                yield pa.RecordBatch.from_arrays(cols, names)

    return run


def plan_best_fit(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, pieces, first sequence, offset) rows for a histogram of lengths.

    Longest lengths first; each takes the open sequences with the least room
    that still fits, as ranges of equal sequences, then opens new ones.
    """
    open_: dict[int, list[tuple[int, int]]] = {}  # room -> ranges (first sequence, how many)
    rows, used = [], 0
    for length in sorted((k for k, c in counts.items() if c), reverse=True):
        left, rank = counts[length], 0

        def put(first: int, n: int, room: int) -> int:
            """Fill ``n`` sequences with as many pieces as fit or are left; returns pieces placed."""
            nonlocal left, rank
            fits, done = room // length, 0
            full = min(n, left // fits)
            for count, each in ((full, fits), (1 if full < n and left - full * fits else 0, left - full * fits)):
                if not count:
                    continue
                for j in range(each):
                    rows.append((length, rank, count, first, size - room + j * length))
                    rank += count
                left -= count * each
                done += count
                if rest := room - each * length:
                    open_.setdefault(rest, []).append((first, count))
                first += count
            if done < n:
                open_.setdefault(room, []).append((first, n - done))
            return done

        for room in sorted(r for r in open_ if r >= length):
            for first, n in open_.pop(room):
                if left:
                    put(first, n, room)
                else:
                    open_.setdefault(room, []).append((first, n))
            if not left:
                break
        if left:
            fresh = -(-left // (size // length))
            first, used = used, used + fresh
            put(first, fresh, size)
    return rows


def token_pieces(docs: DataFrame, path: str | None = None, size: int = 1024, end_id: int = 2) -> DataFrame:
    """doc_id, text_hash, piece, start, length, ids_crc32 and ids (little-endian 32-bit) of each piece."""
    ship(docs.sparkSession)
    src = docs.select("doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(_piece_batches(path or public_tokenizers.path("byte_bpe_50k.json"), size, end_id, True), f"doc_id {kind}, text_hash long, piece int, start long, length long, ids_crc32 long, ids binary")


def pack_documents(docs: DataFrame, path: str | None = None, size: int = 1024, end_id: int = 2) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset and text_hash.

    text_hash is xxhash64 of the text; with doc_id it names a document.

    ``packed_sequences`` turns these places into token sequences.
    """
    spark = docs.sparkSession
    ship(spark)
    stash = Stash(spark)
    src = docs.select("doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    cuts = src.mapInArrow(_piece_batches(path or public_tokenizers.path("byte_bpe_50k.json"), size, end_id, False), f"doc_id {kind}, text_hash long, piece int, start long, length long, ids_crc32 long, writer long, nth long")
    cuts = stash.write(cuts)
    per_writer = cuts.groupBy("length", "writer").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("writer").rowsBetween(Window.unboundedPreceding, -1))
    base = per_writer.select("length", "writer", F.coalesce(before, F.lit(0)).alias("base"))
    counts = {r["length"]: r["n"] for r in cuts.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``size`` rows
    plan = _plan_table(spark, plan_best_fit(counts, size))
    ranked = cuts.join(base, ["length", "writer"]).withColumn("rank", F.col("base") + F.col("nth"))
    # the plan is bounded by the lengths, not by the data
    ranges = F.broadcast(plan.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("rank_lo", "n", "seq", "offset"))).alias("plan")))
    placed = ranked.join(ranges, "length").withColumn("p", F.filter("plan", lambda p: (p["rank_lo"] <= F.col("rank")) & (F.col("rank") < p["rank_lo"] + p["n"]))[0])
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("p.seq") + F.col("rank") - F.col("p.rank_lo")).alias("sequence_id"), F.col("p.offset").alias("offset"), "text_hash")


def _plan_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "length long, rank_lo long, n long, seq long, offset long")


def packed_sequences(docs: DataFrame, places: DataFrame, path: str | None = None, size: int = 1024, end_id: int = 2) -> DataFrame:
    """sequence_id, n_tokens, ids (binary, little-endian 32-bit) and pieces, gapless from offset 0."""
    cuts = token_pieces(docs, path, size, end_id).select(F.col("doc_id").alias("__doc"), "text_hash", "piece", "ids")
    places = places.withColumnRenamed("text_hash", "__hash").withColumnRenamed("piece", "__piece")
    joined = cuts.join(places, F.col("__doc").eqNullSafe(F.col("doc_id")) & (F.col("__hash") == F.col("text_hash")) & (F.col("__piece") == F.col("piece")))
    joined = joined.dropDuplicates(["sequence_id", "offset"])  # repeated rows have equal tokens and meet each other's places
    rows = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    out = joined.groupBy("sequence_id").agg(rows.alias("rows"), F.sum("length").alias("n_tokens"))
    text = F.aggregate("rows", F.unhex(F.lit("")), lambda a, r: F.concat(a, r["ids"]))
    return out.select("sequence_id", "n_tokens", text.alias("ids"), F.transform("rows", lambda r: F.struct(r["doc_id"], r["piece"], r["offset"])).alias("pieces"))
