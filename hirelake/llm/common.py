"""What the operators of this folder share: session settings, tables, stored stages, words of Arrow text columns."""

import ctypes
import functools
import gc
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hirelake.sources.stages import materialize

#: Rows and bytes a Python task holds at a time; a longer text is a batch of its own.
ROWS_PER_BATCH, BYTES_PER_BATCH = 1000, 8 << 20
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on: small Arrow batches bound the memory of Python tasks."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written as Parquet to the shared folder and read back: computed once, no lineage behind it."""
    return materialize(df, f"llm-{name}")


#: Caches (of `functools`) that hold much of a Python process's memory between tasks. Spark uses the process again for tasks of any kind.
HELD: list = []


def drop_held() -> None:
    """Empties the caches of HELD."""
    if any(cache.cache_info().currsize for cache in HELD):
        for cache in HELD:
            cache.cache_clear()
        gc.collect()


def handing_back(run: Callable, holds: bool = False) -> Callable:
    """A task over Arrow batches that returns freed memory to the system when it ends: Spark keeps its Python process for a minute or more.

    A task that does not itself use what is held between tasks (`holds`) drops it before it begins.
    """

    @functools.wraps(run)
    def task(batches):
        if not holds:
            drop_held()
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
            if trim is not None:
                trim(0)

    return task


def per_batch(df: DataFrame, make: Callable[[pa.RecordBatch], dict], schema: str, keep: tuple[str, ...] = (), holds: bool = False) -> DataFrame:
    """Apply a function from an Arrow batch to columns, batch by batch; `keep` names input columns that stay before them.

    A kept column of the name of a made one is left out. `holds` as in `handing_back`.
    """
    made = StructType.fromDDL(schema)
    kept = [c for c in keep if c not in made.names]
    names = [*kept, *made.names]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                out = make(batch)
                columns = [batch.column(c) for c in kept] + [_array(out[n]) for n in made.names]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(handing_back(run, holds), StructType([*(df.schema[c] for c in kept), *made.fields]))


def _array(values) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        return values.combine_chunks()
    return values if isinstance(values, pa.Array) else pa.array(values)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null ones as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


# ------------------------------------------------------------- words as arrays

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACE)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOW_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a sequence from the hashes of its two parts; the order counts."""
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2^64."""
    steps = np.full(n, base & (2**64 - 1), dtype=np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


class Words:
    """Words (runs without ASCII white space) of an Arrow text column, as positions in its bytes.

    `first[i]:first[i + 1]` are the words of row i; `starts` and `ends` are byte
    positions in `data`. Null texts have no words.
    """

    def __init__(self, column: pa.Array, lower: bool = False):
        column = column.cast(pa.large_string())
        if column.null_count:
            column = column.fill_null("")
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        raw = column.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
        data = data[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]
        self.data = _LOWER[data] if lower else data
        inside = ~_IS_SPACE[data]
        begins = np.zeros(len(data) + 1, dtype=bool)
        begins[self.offsets] = True
        opening = inside.copy()
        opening[1:] &= ~inside[:-1] | begins[1:-1]
        closing = inside
        closing[:-1] &= ~closing[1:] | begins[1:-1]
        self.starts = np.flatnonzero(opening)
        self.ends = np.flatnonzero(closing) + 1
        self.first = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word, eight bytes at a time."""
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        at = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded.data, strides=(1,))
        size = self.ends - self.starts
        out = mix(size.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
        open_, k = np.arange(len(size)), 0
        while len(open_):
            part = at[self.starts[open_] + 8 * k] & _LOW_BYTES[np.minimum(size[open_] - 8 * k, 8)]
            out[open_] = chain(out[open_], part)
            k += 1
            open_ = open_[size[open_] > 8 * k]
        return out

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n hashes from each position on, over all of the batch; entry i spans i .. i + n - 1."""
    out, done, power, size = None, 0, hashes, 1
    while True:
        if n & size:
            if out is None:
                out = power
            else:
                m = max(0, len(hashes) - (done + size) + 1)
                out = chain(out[:m], power[done : done + m])
            done += size
        if done == n:
            return out[: max(0, len(hashes) - n + 1)]
        power = chain(power[:-size], power[size:]) if len(power) > size else power[:0]
        size *= 2


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def text_key(*columns: str):
    """Tells rows of equal id but different text apart."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
