"""Restartable processing.

The studied tool's state is "what is already done": a ledger of finished
shards and the keys already in the feature store. Here that state is data:

* R1 - the ledger is a table; pending work is ``present − finished`` by
  anti-join, and the ledger is appended only after the data write commits.
* R2 - newly arrived files are picked up by Structured Streaming's file
  source with a checkpoint, drained with ``trigger(availableNow=True)``; each
  micro-batch writes its own ``batch=<id>`` folder with overwrite, so a batch
  replayed after a failure replaces its own output (exactly-once files). Rows
  that are delivered again can be dropped by state in the checkpoint.
* R3 - features are appended only for keys not yet stored (per-key anti-join).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.operators import features as FE
from corpusprep.operators import shards as SH
from corpusprep.sinks import writers as W
from corpusprep.sources import tables as TB


#: Name of the time that the state of ``once_by`` expires by.
SEEN_AT = "_seen_at"


def pending_shards(present: DataFrame, ledger: DataFrame) -> DataFrame:
    """Shards still to do = present − finished."""
    return present.select("shard").distinct().join(SH.scan_ledger(ledger), "shard", "left_anti")


def incremental_ingest(spark: SparkSession, source: str, schema: T.StructType, sink: str,
                       checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None,
                       fmt: str = "parquet", max_files_per_trigger: int | None = None,
                       once_by: list[str] | None = None, event_time: str | None = None, delay: str = "7 days") -> int:
    """R2: process files that arrived in ``source`` since the last run, once.

    With ``once_by``, a row delivered again in a later file is ingested once: the
    columns named identify it, and the rows seen are state in the checkpoint, kept over runs
    until the watermark passes them by ``delay``. Time is ``event_time``, a timestamp column, or else
    the arrival of the row's file.

    Returns the number of micro-batches (the file source makes none without new files). The output folder
    holds one ``batch=<id>`` partition per micro-batch. Files must arrive as
    new files (or ``k=v`` sub-folders) under ``source``.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source)
    if once_by:
        at = F.col(event_time) if event_time else F.col("_metadata.file_modification_time")
        stream = stream.withColumn(SEEN_AT, at).withWatermark(SEEN_AT, delay).dropDuplicatesWithinWatermark(once_by).drop(SEEN_AT)
    target = sink.rstrip("/")

    ran = []  # every batch of this run; the progress buffer keeps only the last hundred

    def each_batch(df: DataFrame, batch_id: int) -> None:
        out = transform(df) if transform is not None else df
        out.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
        ran.append(batch_id)

    q = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    return len(set(ran))


def read_ingested(spark: SparkSession, sink: str, schema: T.StructType) -> DataFrame:
    full = T.StructType(schema.fields + [T.StructField("batch", T.LongType(), True)])
    return spark.read.schema(full).parquet(sink)


def resume_features(spark: SparkSession, vectors: DataFrame, store_path: str, make_predict_fn,
                    n_in: int, input_col: str = "embedding", key: str = "key") -> DataFrame:
    """Score only keys not in the store and append them; returns what was
    appended (lazily re-readable from ``store_path``)."""
    if TB.path_exists(spark, store_path):
        stored_keys = TB.scan_feature_keys(spark, store_path)
    else:
        stored_keys = spark.createDataFrame([], f"{key} string")
    new = FE.extract_embeddings(vectors, stored_keys, make_predict_fn, n_in, input_col, key)
    W.write_features(new, store_path, mode="append")
    return new
