"""What the operators share: written intermediate tables, training rows, bounded batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harvestry.session import reachable
from harvestry.workdir import written

__all__ = ["BATCH_BYTES", "clash_free", "held_out", "map_batches", "remainder", "sampled_texts", "training_labels", "written"]


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4: 2 marks held-out rows."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def held_out(doc_id: Column) -> Column:
    return F.coalesce(remainder(doc_id) == 2, F.lit(False))


def training_labels(labels: DataFrame, column: str, limit: int) -> DataFrame:
    """At most `limit` labelled rows (doc_id, y) that are not held out, picked by a hash of the id.

    Null ids and null labels are left out; rows that repeat an id count once, with the largest label.
    """
    return (
        labels.select(F.col("doc_id"), F.col(column).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & (remainder(F.col("doc_id")) != 2))
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )


def sampled_texts(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """rows (doc_id, one further column) with the text of each id in docs, whose other columns aren't read. An id that repeats in docs counts once, with its least text, so there are no more rows than in `rows`,
    which are to be bounded, distinct by id and without nulls: they are broadcast."""
    name = next(c for c in rows.columns if c != "doc_id")
    found = docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id")
    return found.groupBy("doc_id").agg(F.first(name).alias(name), F.min("text").alias("text"))


def clash_free(schema: T.StructType, name: str) -> str:
    """`name`, with underscores in front until no column of the schema has it."""
    taken = {f.name.lower() for f in schema.fields}
    while name.lower() in taken:
        name = "_" + name
    return name


BATCH_BYTES = "8m"


def map_batches(df: DataFrame, run, schema: str) -> DataFrame:
    """df.mapInArrow, with batches bounded by bytes (long texts) and not by rows alone."""
    reachable(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(run, schema)
