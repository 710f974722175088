"""Traffic totals over a folder that keeps receiving log files.

The same parse and per-key sums as the batch job, run as a Structured
Streaming query: Spark keeps the running sums per key in its state store
(checkpointed, so a restarted query resumes where it stopped), and each
micro-batch emits only the keys whose totals changed (``update`` mode).

Each micro-batch is appended to a parquet folder with its batch id.  The
current totals are the newest row per key (``current_totals``).  A
micro-batch that is re-run after a failure appends identical rows under
the same batch id, so readers see the same totals - the output is
idempotent without a transactional sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.traffic import traffic_totals


def _append_batch(out_path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("append").parquet(out_path)
    return write


def start_traffic_totals(spark: SparkSession, input_dir: str, out_path: str, checkpoint: str,
                         available_now: bool = False, max_files_per_trigger: int | None = None,
                         **parse_options) -> StreamingQuery:
    """Start the streaming totals; ``available_now`` processes what is there and stops."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    totals = traffic_totals(reader.load(input_dir), **parse_options)
    writer = (totals.writeStream.outputMode("update")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(_append_batch(out_path)))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def current_totals(spark: SparkSession, out_path: str) -> DataFrame:
    """``(key, up, down, total)``: the newest totals of each key."""
    rows = spark.read.parquet(out_path)
    newest = F.max_by(F.struct("up", "down", "total"), "batch_id").alias("t")
    return rows.groupBy("key").agg(newest).select("key", "t.up", "t.down", "t.total")
