"""Exact dedup: counting quotient filters find repeated fingerprints, bytes decide.

Each partition sorts its fingerprints into a counting quotient filter: the
leading bits (quotient) name a block, each block keeps sorted remainders with
their counts. Filters merge block by block without loss: equal remainders meet
and add up, so a group of copies costs one entry each partition. Fingerprints with
a count above one route their rows to the byte check, which groups the texts
themselves. A block is sized from the row count, so a task's share does not grow.

Defined results: null text counts as empty; of rows with one text the smallest
doc_id stays (null last); a repeated row (one id, one text) is one more copy, and
each such row has the same result, so a caller that wants one row drops the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylane.llm.common import WHITE, Stash, sheltered, ship, sized
from skylane.operators.joins import MAX_BROADCAST_BYTES


# Entries that may wait unmerged beside those held.
RUNS = 1 << 16


def _filter_bits(rows: int, block: int) -> int:
    return int(min(max(np.ceil(np.log2(max(rows, 1) / block)), 0), 40))


class CountingQuotientFilter:
    """Sorted remainders with counts, in blocks named by the leading ``bits`` of a fingerprint."""

    def __init__(self, bits: int):
        self.bits = bits
        self._fp, self._count = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._runs: list[tuple[np.ndarray, np.ndarray]] = []
        self._waiting = 0

    def add(self, fp: np.ndarray, count: np.ndarray | None = None) -> None:
        """Take in a run of fingerprints. Runs are merged once as many wait as are held, so many small ones cost no more than one."""
        self._runs.append((fp, np.ones(len(fp), np.int64) if count is None else count))
        self._waiting += len(fp)
        if self._waiting > max(len(self._fp), RUNS):
            self._merge()

    def _merge(self) -> None:
        """Equal fingerprints (one quotient and remainder) sum their counts."""
        if not self._runs:
            return
        every = np.concatenate([self._fp, *(fp for fp, _ in self._runs)])
        times = np.concatenate([self._count, *(count for _, count in self._runs)])
        self._runs, self._waiting = [], 0
        order = np.argsort(every, kind="stable")
        every, times = every[order], times[order]
        head = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.zeros(0, np.int64)
        self._fp, self._count = every[head], np.add.reduceat(times, head) if len(head) else times

    @property
    def fp(self) -> np.ndarray:
        self._merge()
        return self._fp

    @property
    def count(self) -> np.ndarray:
        self._merge()
        return self._count

    def blocks(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(quotient, remainders, counts) of each block that holds something."""
        if not len(self.fp):
            return
        rest = np.uint64(64 - self.bits)
        quotient = (self.fp >> rest if self.bits else np.zeros_like(self.fp)).astype(np.int64)
        remainder = self.fp & np.uint64((1 << (64 - self.bits)) - 1)
        cut = np.append(np.flatnonzero(np.diff(quotient)) + 1, len(quotient))
        lo = 0
        for hi in cut:
            yield int(quotient[lo]), remainder[lo:hi].astype("<u8").tobytes(), self.count[lo:hi].astype("<i8").tobytes()
            lo = hi

    def add_block(self, quotient: int, remainders: bytes, counts: bytes) -> None:
        high = np.uint64((quotient << (64 - self.bits)) & ((1 << 64) - 1)) if self.bits else np.uint64(0)
        self.add(np.frombuffer(remainders, "<u8") | high, np.frombuffer(counts, "<i8"))


def _build(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = CountingQuotientFilter(bits)
        for batch in batches:
            held.add(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
        rows = list(held.blocks())
        for lo in range(0, len(rows), 1000):
            q, r, c = zip(*rows[lo : lo + 1000])
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(r, pa.binary()), pa.array(c, pa.binary())], ["quotient", "remainders", "counts"])

    return run


def _merge(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, CountingQuotientFilter(bits)

        def repeated() -> pa.RecordBatch:
            over = held.count > 1
            return pa.RecordBatch.from_arrays([pa.array(held.fp[over].view(np.int64)), pa.array(held.count[over])], ["fp", "count"])

        for batch in batches:
            for q, r, c in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if q != now:
                    if now is not None:
                        yield repeated()
                    now, held = q, CountingQuotientFilter(bits)
                held.add_block(q, r, c)
        if now is not None:
            yield repeated()

    return run


def repeated_fingerprints(fps: DataFrame, rows: int, block: int = 1 << 16) -> DataFrame:
    """(fp, count) of the fingerprints in ``fps`` (one long column) that occur more than once."""
    ship(fps.sparkSession)
    bits = _filter_bits(rows, block)
    filters = fps.mapInArrow(_build(bits), "quotient long, remainders binary, counts binary")
    return filters.repartition("quotient").sortWithinPartitions("quotient").mapInArrow(_merge(bits), "fp long, count long")


def normalised(text: Column) -> Column:
    """Each run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


@sheltered()
def exact_dedup(docs: DataFrame, broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``docs`` with keep_id, group_size, kept and text_sha256 (of the normalised text).

    Other columns are passed on; columns of these names are replaced. The repeated fingerprints and
    the groups are written; while they fit ``broadcast_bytes``, texts that occur once stay where they are.
    """
    stash = Stash(docs.sparkSession)
    src = docs.drop("keep_id", "group_size", "kept", "text_sha256")
    src = src.withColumns({"__fp": F.xxhash64(normalised(F.col("text")))})
    repeats = stash.write(repeated_fingerprints(src.select("__fp"), docs.count()).select(F.col("fp").alias("__fp")))
    routed = src.select("__fp", "doc_id", "text").join(sized(repeats, broadcast_bytes), "__fp", "left_semi")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id")))
    # grouped by the bytes alone, so that copies are summed up where they are before they meet
    groups = routed.groupBy(normalised(F.col("text")).alias("__norm")).agg(F.min("__fp").alias("__fp"), first.alias("keep"), F.count("*").alias("size"))
    # joined on the digest too, so that texts which share a fingerprint by accident stay apart; where the groups
    # are too many to broadcast, a group of copies is a skewed key of this join alone, which Spark can split
    groups = stash.write(groups.select("__fp", F.sha2("__norm", 256).alias("text_sha256"), F.struct("keep", "size").alias("__mine")))
    out = src.withColumn("text_sha256", F.sha2(normalised(F.col("text")), 256)).join(sized(groups, broadcast_bytes), ["__fp", "text_sha256"], "left")
    return out.withColumns(
        {
            "keep_id": F.when(F.col("__mine").isNull(), F.col("doc_id")).otherwise(F.col("__mine.keep.id")),
            "group_size": F.coalesce("__mine.size", F.lit(1).cast("long")),
            "kept": F.col("__mine").isNull() | F.col("__mine.keep.id").eqNullSafe(F.col("doc_id")),
        }
    ).drop("__mine", "__fp")
