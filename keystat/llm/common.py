"""Shared by the operators: reading tables, cutting lineage in the shared
folder, and vectorised word splitting over Arrow text columns."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from keystat.session import checkpoint_dir

#: Texts are handled in runs of whole rows of about so many bytes; a longer
#: text is a run of its own. Runs of very short texts end after so many rows.
RUN_BYTES = 1 << 20
RUN_ROWS = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows of an Arrow batch, in sessions that keep Spark's default of 10,000: texts
#: are much longer than rows of numbers.
BATCH_ROWS = 1000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once per application, so that
    tasks can import it where it isn't installed; and keep Arrow batches of texts small."""
    if spark.conf.get(_BATCH_CONF) == "10000":
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))
    context = spark.sparkContext
    if getattr(context, "_keystat_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="keystat-"), "keystat.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(path)
    context._keystat_shipped = True


def materialise(df: DataFrame, name: str, *, row_group_bytes: int | None = None) -> DataFrame:
    """``df`` written as Parquet into the folder that ``spark.checkpoint.dir``
    names and read back: the lineage ends there, the rows are fixed, and a lost
    executor costs nothing that was written. The files stay until that folder
    is cleaned, as with checkpoints, since the frame returned reads them. A writing task
    holds one row group in memory: ``row_group_bytes`` bounds it where rows are whole texts."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    options = {"compression": "zstd"}
    if row_group_bytes:
        options["parquet.block.size"] = str(row_group_bytes)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, name: str, flag: Column | None = None) -> tuple[DataFrame, int]:
    """``df`` as :func:`materialise` gives it, and its number of rows (with a true ``flag``), seen as they are written."""
    seen = Observation()
    written = materialise(df.observe(seen, F.count_if(F.lit(True) if flag is None else flag).alias("n")), name)
    return written, seen.get.get("n") or 0


def set_aside(docs: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with columns of these names renamed, and what selects the columns of
    ``docs`` again, under their own names, from a frame made of it."""
    clash = {c: f"__own_{c}" for c in docs.columns if c.lower() in {n.lower() for n in names}}
    back = lambda df: df.select(*[F.col(clash.get(c, c)).alias(c) for c in docs.columns])
    return docs.withColumnsRenamed(clash), back


def hand_back() -> None:
    """Give the memory that Arrow and numpy have freed back to the system: Python workers are kept for
    later tasks, and what they hold meanwhile counts against their executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim:
        trim(0)


def handing_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task, after the last of which memory is handed back."""
    yield from batches
    hand_back()


# -- text columns as bytes -----------------------------------------------------------

def text_runs(column: pa.Array, run_bytes: int = RUN_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of rows; a null is an empty text.

    ``offsets`` has one entry more than the run has rows and starts at 0.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    rows = len(column)
    if not rows:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, rows + 1, column.offset * 8)
    data = (np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None
            else np.zeros(0, np.uint8))
    first = 0
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + run_bytes, "right")) - 1)
        last = min(last, first + RUN_ROWS)
        yield first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def byte_table(member) -> np.ndarray:
    """A table of 256 flags."""
    return np.array([bool(member(b)) for b in range(256)])


#: Words ``[^\x20\x09-\x0D]+``; in UTF-8 every byte of other characters is a word byte.
SPACED_WORD = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (texts are lower-cased before).
LETTER_WORD = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """Byte starts and ends of the words of every text, and each text's first word
    (one entry more than there are texts)."""
    inside = is_word[data]
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


# -- hashes --------------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_GRAM = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, RUN_BYTES + 1)
        with np.errstate(over="ignore"):
            have = np.full(size, base, np.uint64)
            have[0] = 1
            have = np.multiply.accumulate(have)
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (xor-shifts and multiplications)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes: polynomial sums by prefix differences."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power_table(_BASE, len(data)), out=sums[1:])
        value = (sums[ends] - sums[starts]) * _power_table(_INVERSE, len(data))[starts]
        return mix(value ^ ((ends - starts).astype(np.uint64) << np.uint64(48)))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the ``k`` words from each position (positions near a text's end
    run into the next text; callers leave them out)."""
    n = max(0, len(h) - k + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(n, np.uint64)
        for j in range(k):
            total = total * _GRAM + h[j:j + n]
        return mix(total ^ np.uint64(k))


def group_rows(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions from which ``k`` words lie in one text, and their texts."""
    n = np.maximum(np.diff(first) - k + 1, 0)
    text = np.repeat(np.arange(len(n)), n)
    start = np.repeat(first[:-1], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return start, text
