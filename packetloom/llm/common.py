"""Helpers shared by the operators of this folder."""

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.session import run_folder, ship

#: A word is a run of characters other than blank, tab and line ends.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_BLOCK = 1 << 20


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def settled(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again.

    It is computed once, and a lost executor costs no more than a read. With
    ``files``, its partitions are joined to so many at most, without a shuffle.
    """
    folder = run_folder(df.sparkSession, name)
    (df if files is None else df.coalesce(files)).write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


#: Rows of the input that are worth a file of their own in a step's table.
FILE_ROWS = 8192


def file_limit(spark: SparkSession, rows: int) -> int:
    """Files of a step's table: in proportion to the input's rows, whatever the partitions; one a core at least."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(rows / FILE_ROWS))


#: Rows sent to Python at a time: with long texts, Spark's ten thousand are too many.
BATCH_ROWS = 512
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepare(spark: SparkSession) -> None:
    """What operators with Python functions need: the package on the executors, small batches."""
    ship(spark)
    if not 0 < int(spark.conf.get(_BATCH_SETTING, "10000")) <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, BATCH_ROWS)


def words(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for a row."""
    return F.transform(F.array(value), body)[0]


def _powers(n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    x = 1
    for i in range(n):
        out[i] = x
        x = x * _BASE & _MASK
    return out


_POWERS = _powers(1 << 12)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(texts) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a list of texts, and each text's bounds.

    Words of text i are ``hashes[bounds[i]:bounds[i + 1]]``. Works on the bytes
    in blocks, so memory stays a few times the block besides the result.
    """
    raw = [t.encode() if t else b"" for t in texts]
    ends = np.cumsum([0] + [len(r) for r in raw])
    data = np.frombuffer(b"".join(raw), np.uint8)
    hashes, starts, n, i = [], [], len(data), 0
    while i < n:
        j = min(n, i + _BLOCK)
        while j < n and not _SPACE[data[j]]:
            j += 1
        block = data[i:j]
        space = _SPACE[block]
        begin = ~space
        begin[1:] &= space[:-1]
        cuts = ends[np.searchsorted(ends, i, "right") : np.searchsorted(ends, j, "left")] - i
        begin[cuts] = ~space[cuts]
        first = np.flatnonzero(begin)
        if len(first):
            lengths = np.diff(np.append(first, len(block)))
            at = np.arange(first[0], len(block)) - np.repeat(first, lengths)
            part = (block[first[0] :].astype(np.uint64) + np.uint64(1)) * _POWERS[at & 4095]
            part += (at >> 12).astype(np.uint64) * part if len(at) and at.max() > 4095 else np.uint64(0)
            part[space[first[0] :]] = 0
            hashes.append(np.add.reduceat(part, first - first[0]))
            starts.append(first + i)
        i = j
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(len(raw) + 1, np.int64)
    return mixed(np.concatenate(hashes)), np.searchsorted(np.concatenate(starts), ends)


def rolled(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words: ``len(h) - k + 1`` numbers."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, done, step, power = np.zeros(n, np.uint64), 0, h, 1
    while k:
        # `step` covers 2 ** power words; take it where k has that binary digit
        if k & 1:
            scale = np.uint64(pow(_BASE, done, 1 << 64))
            out += step[done : done + n] * scale
            done += power
        k >>= 1
        if k:
            step = step[:-power] + step[power:] * np.uint64(pow(_BASE, power, 1 << 64))
            power *= 2
    return mixed(out)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def pieces(batch, column: str, most: int = 1 << 20):
    """Slices of a pandas batch with at most about ``most`` characters of text."""
    size = batch[column].str.len().fillna(0).cumsum()
    start = 0
    while start < len(batch):
        base = size.iloc[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size.to_numpy(), base + most, "right")))
        yield batch.iloc[start:end]
        start = end
