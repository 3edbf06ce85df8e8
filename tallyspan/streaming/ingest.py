"""Structured Streaming: incremental loads and windowed totals. An extension; the batch operators do the same work."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan.session import shared_dir


def window_totals(events: DataFrame, ts: str, by: list[str], value: str, width: str = "1 hour", late: str | None = "10 minutes") -> DataFrame:
    """Count and sum per window and key; with a watermark when streaming, so that state is bounded."""
    source = events.withWatermark(ts, late) if events.isStreaming and late else events
    return source.groupBy(F.window(ts, width).alias("w"), *by).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("window_start"), *by, "n", "total")


def drain(stream: DataFrame, label: str, key: list[str] | None = None) -> DataFrame:
    """Run a stream over what is there now (``availableNow``) into a table in the shared folder and read that back.

    Without ``key`` rows are appended as they are final. With it the stream is
    an aggregation of which each batch writes the rows that changed, so that
    its watermark may bound the state, and the last version of each key counts.
    """
    spark = stream.sparkSession
    base = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    start = stream.writeStream.option("checkpointLocation", f"{base}/state").trigger(availableNow=True)
    if key is None:
        start.format("parquet").option("path", f"{base}/out").start().awaitTermination()
        return spark.read.schema(stream.schema).parquet(f"{base}/out")
    write = lambda batch, n: batch.withColumn("__batch", F.lit(n)).write.mode("overwrite").parquet(f"{base}/out/n={n}")
    start.outputMode("update").foreachBatch(write).start().awaitTermination()
    rows = spark.read.schema(T.StructType([*stream.schema.fields, T.StructField("__batch", T.LongType())])).option("recursiveFileLookup", "true").parquet(f"{base}/out")
    rest = [c for c in stream.columns if c not in key]
    last = rows.groupBy(*key).agg(F.max(F.struct("__batch", *rest)).alias("__r"))
    return last.select(*[F.col(c) if c in key else F.col(f"__r.{c}").alias(c) for c in stream.columns])


def load_new(spark: SparkSession, folder: str, schema, target: str, state: str, key: list[str], where: Column | None = None) -> None:
    """Append the rows of files not seen before to a parquet table, skipping keys it holds already.

    The checkpoint in ``state`` remembers the files; each micro-batch is
    anti-joined with the table's keys and its own repeated keys are dropped.
    """
    stream = spark.readStream.schema(schema).json(folder)
    if where is not None:
        stream = stream.where(where)

    def append(batch: DataFrame, _: int) -> None:
        fresh = batch.dropDuplicates(key)
        try:
            fresh = fresh.join(spark.read.parquet(target).select(*key), key, "left_anti")
        except Exception as e:  # noqa: BLE001 - the first batch finds no table
            if "PATH_NOT_FOUND" not in str(e):
                raise
        fresh.write.mode("append").parquet(target)

    stream.writeStream.foreachBatch(append).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
