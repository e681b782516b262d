"""Incremental ingestion as a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def ingest_incremental(spark: SparkSession, source: str, schema, out: str, checkpoint: str, clean=lambda df: df,
                       files_per_batch: int = 10) -> DataFrame:
    """Take the files that were not seen yet in chunks, clean each chunk and append it to `out`.

    The stream checkpoint is the list of seen files. Each batch writes its own folder, so a retried batch replaces
    its own output. Returns the running total over all parts.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)

    def add(batch: DataFrame, batch_id: int) -> None:
        clean(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    query = (stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return running_total_table(spark.read.parquet(out))


def running_total_table(parts: DataFrame) -> DataFrame:
    """Sum of the ingested parts per (sample, feature)."""
    return parts.groupBy("sample_id", "feature_id").agg(F.sum("count").alias("count"))
