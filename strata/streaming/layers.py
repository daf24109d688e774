"""Incremental silver layer: the batch cleaning steps applied to new bronze files.

The silver steps (filters, timestamps, text clean-up) look at one row at a
time, so the same DataFrame functions run unchanged on a file stream of
bronze Parquet. Each run picks up only files not yet processed, and the
checkpoint in the shared folder records which ones were processed, so a
rerun after a failure does not write them twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def stream_layer(
    spark: SparkSession,
    source_dir: str,
    schema: StructType,
    transform: Callable[[DataFrame], DataFrame],
    target_dir: str,
    checkpoint_dir: str,
    max_files_per_trigger: int | None = None,
) -> str:
    """Apply ``transform`` to the Parquet files of ``source_dir`` not yet
    processed and append the result to ``target_dir``; waits until done.

    ``transform`` must be row-local (no aggregation, join with a stream or
    ordering), as the silver steps are.
    """
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    query = (
        transform(reader.load(source_dir))
        .writeStream.format("parquet")
        .option("path", target_dir)
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"layer stream failed: {query.exception()}")
    return target_dir
