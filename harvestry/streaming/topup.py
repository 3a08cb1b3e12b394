"""Streaming top-up: new vectors arrive as files, and each micro-batch adds rows far from what is selected."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from harvestry.operators.select import fps_selection
from harvestry.sources.files import _exists


def top_up(spark: SparkSession, incoming: str, selected: str, checkpoint: str, per_batch: int, schema: str = "id long, embedding array<double>") -> StreamingQuery:
    """Start a query that reads new Parquet files and adds `per_batch` rows of each micro-batch to the selected table.

    The rows added are the farthest from all selected so far (a batch's first pick, where there are none, is its lowest id).
    Each batch has a folder of its own that a replay overwrites, so a batch that is run again after a failure adds nothing twice.
    """

    def add(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        before = spark.read.parquet(selected).where(F.col("batch") < number) if _exists(spark, selected) else None
        if before is not None and before.isEmpty():
            before = None
        fresh = batch if before is None else batch.join(before.select("id"), "id", "left_anti")
        fresh = fresh.dropDuplicates(["id"])
        picks = fps_selection(fresh, per_batch, anchors=before)
        fresh.join(picks, "id").select("id", "embedding", "rank").write.mode("overwrite").parquet(f"{selected}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(incoming)
    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
