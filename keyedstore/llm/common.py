"""Helpers that several corpus operators share."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.folder import fresh_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of an Arrow batch; texts are long, so batches are kept small.
BATCH_ROWS = 1000
#: Words whose hash a Python worker remembers before it starts afresh.
WORD_CACHE = 400_000
MASK = 0xFFFFFFFFFFFFFFFF


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Batches of BATCH_ROWS for this session's Python workers, from now on: the setting is read when a result is computed."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes what `stored` wrote; nothing that is still to be computed may read it."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def named(df: DataFrame, *columns: str, key: str = "doc_id") -> DataFrame:
    """The id without nulls beside `nameless`, and other columns.

    A null among the ids would make floats of a whole batch's ids on their way through pandas.
    """
    return df.select(F.coalesce(F.col(key).cast("long"), F.lit(0)).alias(key), F.col(key).isNull().alias("nameless"), *columns)


def renamed(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """Undoes `named`."""
    return df.withColumn(key, F.when(~F.col("nameless"), F.col(key))).drop("nameless")


def by_arrow(df: DataFrame, column: str, change: Callable[[], Callable[[list], list]]) -> DataFrame:
    """The same rows with `column` changed; `change` makes a worker's function from values to values.

    Other columns never leave Arrow, so they
    come back bit for bit whatever their types and nulls.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        its = change()
        for b in batches:
            at = b.schema.get_field_index(column)
            yield b.set_column(at, b.schema.field(at), pa.array(its(b.column(at).to_pylist()), b.schema.field(at).type))

    return df.mapInArrow(run, df.schema)


def kept_by_arrow(df: DataFrame, column: str, keep: Callable[[], Callable[[list], list[bool]]]) -> DataFrame:
    """The rows that a worker's function of the column's values keeps, with all columns as they were."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        its = keep()
        for b in batches:
            yield b.filter(pa.array(its(b.column(column).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def sampled(df: DataFrame, n: int, *by: str) -> DataFrame:
    """At most n rows that differ in `by`, those of least hash; about n where there are as many.

    A cut from the count of distinct rows lets some n rows through where they are read, so no
    task gathers more whatever the size of the table; equal rows are one before they are dealt.
    """
    h = F.xxhash64(*by)
    total = df.agg(F.approx_count_distinct(h, 0.02)).first()[0]
    part = min(1.0, 1.1 * (n + 4 * math.sqrt(n)) / max(1, total))
    cut = min((1 << 63) - 1, int(part * (1 << 64)) - (1 << 63))
    others = [c for c in df.columns if c not in by]
    some = df.where(h <= F.lit(cut)).groupBy(*by).agg(*(F.min(c).alias(c) for c in others)) if others else df.where(h <= F.lit(cut)).distinct()
    return some.orderBy(F.xxhash64(*by), *by).limit(n).select(*df.columns)


def crc_mod(column: str | Column, n: int) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary") if isinstance(column, str) else column) % n


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit (the finisher of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHashes(dict):
    """word bytes -> 64-bit hash; forgets everything once it holds WORD_CACHE words."""

    def __init__(self):
        super().__init__()
        import xxhash

        self.hash = xxhash.xxh64_intdigest

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = h = self.hash(word)
        return h


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased, then split at ASCII white space (0x20, 0x09-0x0D)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(text: str | None, seen: WordHashes) -> np.ndarray:
    words = words_of(text)
    return np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of `width` words in order; a shorter text is one run; none for no words."""
    n = len(hashes)
    if not n:
        return hashes
    k = min(n, width)
    out = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : n - k + 1 + i] + np.uint64(i + 1))
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
