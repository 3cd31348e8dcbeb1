"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the near-duplicate operators: runs without blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


#: Makes A-Z small and all else of ASCII that is neither digit nor letter a blank; bytes of other characters stay.
SPACED = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


#: Rows of an Arrow batch.  A batch holds whole texts, and a task keeps it several times outside of its heap.
BATCH_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """From now on the session hands at most BATCH_ROWS rows at a time to Python (Spark's own limit: 10 000); a lower limit of the user's stays."""
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(limit)) <= BATCH_ROWS:
        spark.conf.set(limit, str(BATCH_ROWS))


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id's decimal text leaves 0 modulo 5; false without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def lists(rows: Iterable[np.ndarray], kind: pa.DataType) -> pa.Array:
    """An Arrow list column from one numpy array a row."""
    rows = list(rows)
    ends = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(x) for x in rows], out=ends[1:])
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: spreads every input bit over 64 bits."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x ^= x >> np.uint64(shift)
            x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class Remember(dict):
    """A bounded memo in two generations: what was used lately survives when it turns over.

    It bounds memory only; what falls out is computed again.
    """

    def __init__(self, make, limit: int = 300_000):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.store(key, value)
        return value

    def store(self, key, value) -> None:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value

    def fill(self, keys: list, values: list) -> None:
        if len(self) + len(keys) > self.limit:
            self.old = dict(self)
            self.clear()
        self.update(zip(keys, values, strict=True))

    def forget(self) -> None:
        """Lets everything go, so that a worker that is used again keeps no words of an earlier task."""
        self.clear()
        self.old = {}


def batches(stream: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what a batch of long texts expands to stays small."""
    for batch in stream:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
