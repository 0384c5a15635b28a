"""What several text operators share: working tables, batches of text as numpy arrays, word hashes,
and running totals over an ordered corpus without a single-task window."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text bytes handled at once inside a task; numpy work arrays hold about 60 times as much.
SLICE_BYTES = 1 << 20

_local_root: list[str] = []


def working_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``. Only local mode may do without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _local_root:
            _local_root.append(tempfile.mkdtemp(prefix="seqtables-llm-"))
        root = _local_root[0]
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


#: While a table is written, rows reach Python in batches of so many bytes. The usual ten thousand rows of text are tens of
#: megabytes, held several times over on either side.
_SMALL_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": 4 * SLICE_BYTES}
#: While a working table is written, also: shuffle files go as soon as the query that wrote them has ended.
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": True, **_SMALL_BATCHES}


@contextmanager
def _settings(spark: SparkSession, wanted: dict) -> Iterator[None]:
    """The session's settings changed for a while."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def saved(df: DataFrame, purpose: str, codec: str = "zstd") -> DataFrame:
    """The rows written to the shared folder as Parquet and read back, so that nothing above is computed twice."""
    path = working_folder(df.sparkSession, purpose)
    with _settings(df.sparkSession, _SMALL_BATCHES):
        df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Workspace:
    """Working tables of one run below one shared folder, each removed when nothing reads it any more.

    A table is read back once it is written, so the shuffles that made it go at once, not when the driver next collects garbage.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.folder = spark, working_folder(spark, purpose)
        self.names: list[str] = []
        self.used = 0

    def save(self, name: str, df: DataFrame, codec: str = "zstd") -> DataFrame:
        """The rows written as the table of that name and read back."""
        self.names.append(name)
        self.used += 1
        with _settings(self.spark, _WRITING):
            df.write.option("compression", codec).parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def number(self, name: str) -> str:
        """A name not used yet, for tables of which there are several."""
        return f"{name}-{self.used}"

    def remove(self, *names: str) -> None:
        for name in names:
            self._remove(name)

    def remove_others(self, *kept: str) -> None:
        """Removes all tables but those named."""
        self.remove(*(n for n in self.names if n not in kept))

    def _remove(self, name: str) -> None:
        self.names = [n for n in self.names if n != name]
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def buckets_wanted(spark: SparkSession) -> int:
    """How many ordered ranges a corpus is dealt into: a few for each shuffle partition."""
    return min(4096, max(8, 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


# --- memory of a worker ------------------------------------------------------------------------

#: What an operator's tasks leave in a worker for its next ones, by the operator's module.
_caches: dict[str, dict] = {}
#: Free memory is not given back again within so many seconds, as that costs some hundredths of one; when it was last.
SELDOM = 0.5
_given: list[float] = []
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None


def cache(owner: str) -> dict:
    """A dictionary that lasts in a worker until ``lean`` work of others begins there."""
    return _caches.setdefault(owner, {})


def give_back() -> None:
    """Memory that nothing holds goes back to the system. Allocators otherwise keep what the largest batch took, and a worker
    serves every operator of a session."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def _seldom() -> None:
    if not _given or time.monotonic() - _given[0] >= SELDOM:
        give_back()
        _given[:] = [time.monotonic()]


def lean(work: Callable, keeps: str | None = None) -> Callable:
    """The same work on batches, without what other operators left in the worker (but for the cache it keeps), and giving
    memory back between batches and at its end."""
    def run(batches):
        _drop_others(keeps)
        yield from work(_given_back(batches))
        _seldom()

    return run


def _drop_others(keeps: str | None) -> None:
    for owner, held in _caches.items():
        if owner != keeps and held:
            held.clear()
            _given.clear()
    _seldom()


def _given_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch
        del batch
        _seldom()


# --- order ----------------------------------------------------------------------------------

def cut_points(df: DataFrame, column: str, count: int) -> list[int]:
    """At most count - 1 values that cut the column's rows into ranges of like size."""
    shares = [i / count for i in range(1, count)]
    found = df.agg(F.percentile_approx(column, shares, 10 * count).alias("cuts")).first()["cuts"]
    return sorted(set(found or []))


def range_of(values: np.ndarray, cuts: list[int]) -> np.ndarray:
    """The range each value lies in, from 0; nulls must have been replaced by a least value."""
    return np.searchsorted(np.asarray(cuts, dtype=np.int64), values, side="right").astype(np.int32)


def with_range(df: DataFrame, column: str, cuts: list[int], name: str) -> DataFrame:
    """Adds the number of the row's range (nulls in range 0)."""
    @F.pandas_udf(T.IntegerType())
    def place(values):
        return _series(range_of(values.fillna(np.iinfo(np.int64).min).astype("int64").to_numpy(), cuts))

    return df.withColumn(name, place(F.col(column).cast("long")))


def _series(values):
    import pandas as pd

    return pd.Series(values)


# --- batches of text ----------------------------------------------------------------------------

def slices(batch: pa.RecordBatch, column: str | pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about so many text bytes; a longer text makes a run of its own. column: the texts, or their name."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column) if isinstance(column, str) else column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    begin = 0
    while begin < batch.num_rows:
        done = int(ends[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes one after another, and where each begins (one more entry for the end). Null is empty."""
    texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, dtype=wide)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[places[0]:places[-1]], places - places[0]


def lowered(raw: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)


class Words:
    """Words (runs of bytes other than 0x20 and 0x09 to 0x0D) of several texts laid end to end."""

    def __init__(self, raw: np.ndarray, places: np.ndarray):
        self.raw, self.places = raw, places
        spoken = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
        begins, ends = spoken.copy(), spoken.copy()
        begins[1:] &= ~spoken[:-1]
        ends[:-1] &= ~spoken[1:]
        heads = places[:-1][places[:-1] < places[1:]]
        begins[heads] = spoken[heads]
        tails = places[1:][places[:-1] < places[1:]] - 1
        ends[tails] = spoken[tails]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        #: where each text's words begin in starts, with one more entry for the end
        self.first = np.searchsorted(self.starts, places)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.raw, self.starts, self.ends)


_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_LETTERS = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        size = max(SLICE_BYTES + 1, n)
        up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        np.multiply.accumulate(up, out=up)
        np.multiply.accumulate(down, out=down)
        _powers[:] = [up, down] if size <= 4 * SLICE_BYTES else []
        return up[:n], down[:n]
    return _powers[0][:n], _powers[1][:n]


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans: equal bytes have equal hashes wherever they stand."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    up, down = _power_tables(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_LETTERS[raw] * up[:-1], out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts])


def _salt(length: int) -> np.uint64:
    return np.uint64(length * int(_GOLD) & 0xFFFFFFFFFFFFFFFF)


def runs_hashed(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of so many consecutive words from each word on; the last length - 1 entries mean nothing."""
    found = np.zeros(len(words), np.uint64)
    if len(words) < length:
        return found
    whole = len(words) - length + 1
    acc = np.full(whole, _salt(length), np.uint64)
    for j in range(length):
        acc = acc * np.uint64(_BASE) + words[j:j + whole]
    found[:whole] = mixed(acc)
    return found


def windows_hashed(words: np.ndarray, length: int) -> np.ndarray:
    """As runs_hashed, but by prefix sums, for long runs."""
    if len(words) < length:
        return np.zeros(len(words), np.uint64)
    up, down = _power_tables(len(words))
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up, out=total[1:])
    found = np.zeros(len(words), np.uint64)
    whole = len(words) - length + 1
    found[:whole] = mixed((total[length:] - total[:whole]) * down[:whole] + _salt(length))
    return found


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
