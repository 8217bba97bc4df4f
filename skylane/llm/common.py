"""Helpers shared by the corpus operators: tables, shared storage, word scans and hashes."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylane.operators.joins import row_width

WHITE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="skylane-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


class Stash:
    """Tables written to the shared folder; they cut lineage and survive lost executors.

    ``drop`` deletes one early; the rest goes when the session's file system closes.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{shared_dir(spark).rstrip('/')}/stash-{uuid.uuid4().hex}"
        self.n = 0

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self.n}"
        self.n += 1
        df.write.option("compression", "zstd").parquet(path)
        fs, p = self._fs(path)
        fs.deleteOnExit(p)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.stash_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        if path := getattr(df, "stash_path", None):
            fs, p = self._fs(path)
            fs.delete(p, True)


def sized(small: DataFrame, most: int) -> DataFrame:
    """``small``, a written table, marked for broadcast if it is at most ``most`` bytes; beyond that Spark shuffles both sides."""
    return F.broadcast(small) if small.count() * row_width(small) <= most else small


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_skylane_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    build = tempfile.mkdtemp(prefix="skylane-code-")
    src = os.path.join(build, "src")
    shutil.copytree(os.path.join(top, "skylane"), os.path.join(src, "skylane"), ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(os.path.join(build, "skylane_code"), "zip", src))
    sc._skylane_shipped = True


def sheltered(*names: str):
    """For operators with columns of their own: input columns so called, or with two leading underscores, step aside.

    They come back under their names; tables without such columns are passed on as they are.
    """

    def wrap(operator):
        @wraps(operator)
        def run(docs: DataFrame, *args, **options) -> DataFrame:
            aside = {c: f"aside{k}_{uuid.uuid4().hex}" for k, c in enumerate(docs.columns) if c.startswith("__") or c.lower() in names}
            if not aside:
                return operator(docs, *args, **options)
            out = operator(docs.withColumnsRenamed(aside), *args, **options)
            return out.withColumnsRenamed({new: old for old, new in aside.items()})

        return run

    return wrap


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a null-free join key: the id and a hash of the text.

    Two rows with one id and different texts keep apart; identical rows share
    the key, which every use below allows for.
    """
    return docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 62))), "__tx": F.xxhash64("text")})


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose ``column`` holds about ``limit`` bytes, so memory follows one text at most."""
    col = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
    if not len(col):
        return
    at = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    lo = 0
    while lo < len(col):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (in place)."""
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64 and of its inverse, up to ``n``."""
    if "up" not in _powers or len(_powers["up"]) <= n:
        size = max(n + 1, 1 << 18)
        for name, base in (("up", _ODD), ("down", pow(_ODD, -1, 1 << 64))):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            _powers[name] = np.multiply.accumulate(a)
    return _powers["up"], _powers["down"]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))


@dataclass
class Words:
    """Words of several texts: byte spans in ``buf``, and the first word of each text."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self, block: int = 1 << 18) -> np.ndarray:
        """A 64-bit hash of each word, from prefix sums over blocks of bytes."""
        out = np.empty(len(self.start), np.uint64)
        i = 0
        while i < len(out):
            j = max(i + 1, int(np.searchsorted(self.end, self.start[i] + block, "right")))
            lo, hi = int(self.start[i]), int(self.end[j - 1])
            up, down = powers(hi - lo)
            total = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(_BYTE[self.buf[lo:hi]] * up[: hi - lo], out=total[1:])
            s, e = self.start[i:j] - lo, self.end[i:j] - lo
            out[i:j] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)
            i = j
        return mix(out)

    def text(self, a: int, b: int) -> bytes:
        """Words a..b-1 joined by one space."""
        return b" ".join(self.buf[self.start[a] : self.end[b - 1]].tobytes().split()) if b > a else b""


def words_of(texts: pa.Array) -> Words:
    """Byte spans of the words ``[^\\x20\\x09-\\x0D]+`` of each text; null counts as empty."""
    col = texts.cast(pa.large_binary()).fill_null(b"")
    at = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    raw = col.buffers()[2]
    buf = np.frombuffer(raw, np.uint8)[at[0] : at[-1]] if raw is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    at = at - at[0]
    n = len(buf)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(buf, none, none, np.zeros(len(at), np.int64))
    space = _SPACE[buf]
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    before[at[:-1][at[:-1] < n]] = True
    after[at[1:][at[1:] > 0] - 1] = True
    start = np.flatnonzero(~space & before)
    end = np.flatnonzero(~space & after) + 1
    return Words(buf, start, end, np.searchsorted(start, at))
