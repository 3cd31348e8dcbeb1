"""The idempotent night append as a stream.

New nights arrive as files; rows already stored, or repeated inside the stream, are
dropped by exact key.  The key state and the file sink's log make restarts safe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def night_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def append_stream(stream: DataFrame, stored: DataFrame, key: Sequence[str], out: str, checkpoint: str) -> StreamingQuery:
    """Append what is new and stop when the input is read."""
    fresh = stream.join(stored.select(*key).distinct(), list(key), "left_anti").dropDuplicates(list(key))
    return (
        fresh.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
