"""Records that are written again and again: an append log, snapshots and a manifest."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST = "version long, snapshot string, batches array<string>, schema string"


class Ledger:
    """The latest row per key of an append-only log.

    A write adds one batch of files and one manifest row that names the snapshot and the batches since; nothing is rewritten.
    ``current`` reads these only, ``compact`` turns them into the next snapshot, which holds one row a key in key order, so a look-up
    of a few keys reads the files whose column statistics hold them.  What no manifest names (a batch of a lost writer)
    is never read.  Of two writers that add the same version the second fails and has to write again.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]):
        self.spark, self.path, self.keys, self.order = spark, path, list(keys), list(order)

    def _manifest(self) -> dict:
        """The newest manifest row; a ledger without one is empty.  A version is one row."""
        try:
            newest = self.spark.read.schema(MANIFEST).option("recursiveFileLookup", True).json(f"{self.path}/manifest").agg(F.max_by(F.struct("*"), "version").alias("m")).first()["m"]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            newest = None
        return newest.asDict() if newest else {"version": 0, "snapshot": None, "batches": [], "schema": None}

    def _commit(self, version: int, snapshot: str | None, batches: list[str], schema: str) -> None:
        row = self.spark.createDataFrame([(version, snapshot, batches, schema)], MANIFEST)
        row.coalesce(1).write.mode("errorifexists").json(f"{self.path}/manifest/{version:012d}")

    def append(self, facts: DataFrame) -> None:
        """Adds rows; of one key the row with the largest ``order`` is the current one."""
        m = self._manifest()
        name = f"log/{uuid.uuid4().hex}"
        facts.write.mode("errorifexists").parquet(f"{self.path}/{name}")
        self._commit(m["version"] + 1, m["snapshot"], [*m["batches"], name], facts.schema.json())

    def _read(self, m: dict) -> DataFrame | None:
        files = [f"{self.path}/{n}" for n in ([m["snapshot"]] if m["snapshot"] else []) + m["batches"]]
        return self.spark.read.schema(StructType.fromJson(json.loads(m["schema"]))).parquet(*files) if files else None

    def current(self, where: str | None = None) -> DataFrame | None:
        """The current row of every key; None before the first write.  ``where`` may name key columns only: it goes to the files."""
        rows = self._read(self._manifest())
        return None if rows is None else self._latest(rows.where(where) if where else rows)

    def _latest(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in self.keys]
        newest = F.max_by(F.struct(*rest), F.struct(*self.order)).alias("__r")
        return rows.groupBy(*self.keys).agg(newest).select(*self.keys, "__r.*").select(*rows.columns)

    def compact(self) -> None:
        """The current rows become the snapshot; the log starts anew."""
        m = self._manifest()
        rows = self._read(m)
        if rows is None or not m["batches"]:
            return
        name = f"snapshot/{uuid.uuid4().hex}"
        ranged = self._latest(rows).repartitionByRange(*self.keys).sortWithinPartitions(*self.keys)
        ranged.write.mode("errorifexists").parquet(f"{self.path}/{name}")
        self._commit(m["version"] + 1, name, [], m["schema"])

    def depth(self) -> int:
        """Batches since the last snapshot."""
        return len(self._manifest()["batches"])
