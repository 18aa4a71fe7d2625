"""Rows as one struct column, Arrow stages over them, and checkpoints in the folder that the cluster names."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaudit.llm.text import slices
from plaudit.session import scratch_path


def packed(docs: DataFrame, columns: list[str]) -> DataFrame:
    """One column `doc` with the named columns as its fields; an operator's own columns stand beside it, so that
    no name of the input can clash with them."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in dict.fromkeys(columns)]).alias("doc"))


def unpacked(rows: DataFrame, *more: Column) -> DataFrame:
    return rows.select(*[F.col("doc").getField(f.name).alias(f.name) for f in rows.schema["doc"].dataType], *more)


def with_columns(rows: DataFrame, fields: str, work: Callable[[pa.RecordBatch, pa.Array], dict[str, pa.Array]],
                 text: str) -> DataFrame:
    """Adds columns made by `work` from the rows and their texts, a slice of about a megabyte at a time."""
    added = T.StructType.fromDDL(fields)
    schema = T.StructType([*rows.schema.fields, *added.fields])
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text):
            made = work(batch, text_of(batch, text))
            yield pa.RecordBatch.from_arrays([*batch.columns, *[made[f.name] for f in added]], names)

    return rows.mapInArrow(run, schema)


def text_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return pa.compute.struct_field(batch.column("doc"), name)


def text_slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, to in slices(text_of(batch, text)):
            yield batch.slice(at, to - at)
        del batch
        _give_back()


def _give_back() -> None:
    """Freed memory goes back to the machine: a worker lives on, and its task's JVM needs the room."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # numpy's memory; only some C libraries have it
    if trim:
        trim(0)


def durable(spark: SparkSession) -> SparkSession:
    """Checkpoints go to spark.checkpoint.dir. Without it a local session gets a folder of its own, as in tests; on a
    cluster, whose machines would not see it, that is an error."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or scratch_path(spark, "checkpoints"))
    return spark


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written as Parquet in the checkpoint folder and read again."""
    spark = durable(frame.sparkSession)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.parquet(path)


def checkpointed(frame: DataFrame) -> DataFrame:
    durable(frame.sparkSession)
    return frame.checkpoint(eager=True)


def fold(id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`: which fold of the labels a row belongs to."""
    return F.crc32(F.col(id).cast("string").cast("binary")) % parts


def sampled(rows: DataFrame, by: str, id: str, most: int) -> DataFrame:
    """(id, by) of at most `most` rows of each value of `by`, those with the smallest hash of the id.

    Rows are counted first, and only hashes below about twice the share that is wanted are ranked: what comes together
    for a value is bounded by `most`, however many rows and tasks there are.
    """
    rows = rows.select(id, by).dropna()
    counts = checkpointed(rows.groupBy(F.col(by).alias("_of")).agg(F.count("*").alias("_n")))
    if counts.count() <= 10_000:  # a row for each value
        counts = F.broadcast(counts)
    place = F.xxhash64(id).cast("double") / 2.0**64 + 0.5
    near = rows.join(counts, F.col(by) == F.col("_of")).filter(place * F.col("_n") <= 2.0 * most + 100)
    order = Window.partitionBy(by).orderBy(F.xxhash64(id), id)
    return near.select(id, by, F.row_number().over(order).alias("_rank")).filter(F.col("_rank") <= most).select(id, by)


def of_sample(docs: DataFrame, sample: DataFrame, id: str, most: int = 1_000_000) -> DataFrame:
    """The documents of a sample. It is broadcast after its size has been checked; else Spark joins as it likes."""
    sample = checkpointed(sample)
    return docs.join(F.broadcast(sample) if sample.count() <= most else sample, id)
