"""Helpers that several operators share: tables, scratch, and byte arithmetic on whole columns of texts."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velorisk.session import materialise, scratch_path

__all__ = ["materialise", "scratch_path"]

#: White space of the text contracts: blank, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Text bytes handled at once in a task; bounds the arrays made of them. A longer text is handled alone.
PIECE_BYTES = 2 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the ids that learning never sees; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def salted_semi(left: DataFrame, right: DataFrame, on: list[str], spread: Column, salts: int = 16) -> DataFrame:
    """Rows of ``left`` with a partner in ``right`` (unique keys), a hot key dealt to ``salts`` tasks."""
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).join(
        copies, [*on, "_salt"], "left_semi"
    ).drop("_salt")


def salted_join(left: DataFrame, right: DataFrame, on: list[str], spread: Column, salts: int = 16, how="inner"):
    """``left`` joined to ``right`` (unique keys), a hot key dealt to ``salts`` tasks."""
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).join(
        copies, [*on, "_salt"], how
    ).drop("_salt")


#: Rows in a batch on the way to Python and back. A batch is held several times over, and texts can be long.
BATCH_ROWS = 1000


def map_batches(df: DataFrame, work, schema) -> DataFrame:
    """``mapInArrow`` with batches of few rows."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(work, schema)


def pieces(batches: Iterator[pa.RecordBatch], text: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in runs of about ``most`` text bytes, one row at least."""
    for batch in batches:
        _, offsets = utf8(batch.column(text))
        at, rows = 0, len(offsets) - 1
        while at < rows:
            upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
            yield batch.slice(at, upto - at)
            at = upto


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offset where each row starts; a null is an empty text."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def byte_class(members: str | bytes, inverse: bool = False) -> np.ndarray:
    """A table of 256 flags."""
    flags = np.zeros(256, bool)
    flags[list(members.encode() if isinstance(members, str) else members)] = True
    return ~flags if inverse else flags


def runs(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each longest run of bytes with the flag ``inside``; runs end with their row."""
    flags = inside[data]
    if not flags.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.concatenate(([False], flags[:-1])) & ~cut[:-1]
    after = np.concatenate((flags[1:], [False])) & ~cut[1:]
    starts, ends = np.flatnonzero(flags & ~before), np.flatnonzero(flags & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


#: Random odd multiplier and byte values of the rolling hash: fixed, so that all tasks agree.
_MULTIPLIER = 0x9E6C63D0876A9A47
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit values stirred so that every bit depends on every bit."""
    with np.errstate(over="ignore"):
        x = x ^ np.uint64((salt * 0x9E3779B97F4A7C15) & ((1 << 64) - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class RollingHash:
    """Hashes of any byte ranges of one array, equal for equal bytes: a polynomial modulo 2^64 over random values."""

    def __init__(self, data: np.ndarray):
        self._sums, self._inverse = np.zeros(len(data) + 1, np.uint64), _powers(_INVERSE, len(data) + 1)
        with np.errstate(over="ignore"):
            np.cumsum(_BYTE_VALUES[data] * _powers(_MULTIPLIER, len(data)), out=self._sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            raw = (self._sums[ends] - self._sums[starts]) * self._inverse[starts]
            return mixed(raw + (ends - starts).astype(np.uint64))


_known_powers: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if base not in _known_powers or len(_known_powers[base]) < n:
        steps = np.full(max(n, PIECE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            _known_powers[base] = np.cumprod(steps)
    return _known_powers[base][:n]


def chained(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of ``n`` neighbours that lie in one row, and where it starts."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    upto = len(hashes) - n + 1
    at = np.flatnonzero(rows[:upto] == rows[n - 1 :])
    out = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = mixed(out * np.uint64(3) + hashes[at + k], k + 1)
    return out, at
