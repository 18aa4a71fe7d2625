"""Lake tables by path and through the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plaudit.config import LakeConfig
from plaudit.contracts import MERGE, MERGE_DATA, METADATA, PARSED, REVIEWS, SLICE
from plaudit.operators.slices import read_slices
from plaudit.sources.files import folders


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", contract: StructType | None = None) -> DataFrame:
    """With its contract a table's files are not opened to learn their schema; Delta knows its own."""
    reader = spark.read.format(fmt)
    return (reader.schema(contract) if contract and fmt != "delta" else reader).load(path)


def read_parsed(spark: SparkSession, path: str, contract: StructType, fmt: str = "parquet") -> DataFrame:
    """The accepted rows; the partition filter keeps rejected files from being opened."""
    return read_table(spark, path, fmt, _with_columns(contract, PARSED)).where("status = 'valid'").select(
        *contract.fieldNames())


def _with_columns(contract: StructType, more: StructType) -> StructType:
    return StructType(contract.fields + more.fields)


def read_rejected(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, path, fmt, PARSED).where("status = 'rejected'").select("value", "reason")


def read_reviews(spark: SparkSession, config: LakeConfig) -> DataFrame:
    return read_parsed(spark, config.parsed_reviews, REVIEWS, config.table_format)


def read_items(spark: SparkSession, config: LakeConfig) -> DataFrame:
    return read_parsed(spark, config.parsed_items, METADATA, config.table_format)


def read_published(spark: SparkSession, config: LakeConfig) -> DataFrame:
    """Each review of the canonical table once."""
    return read_table(spark, config.published, config.table_format, _with_columns(MERGE_DATA, SLICE))


def read_merge_data(spark: SparkSession, config: LakeConfig) -> DataFrame:
    """Historical and streamed rows of the canonical table, told apart by ``source``."""
    if config.use_manifest:
        rows = read_slices(spark, config, "merge_data", MERGE_DATA).withColumn("source", F.lit("stream"))
        if folders(spark, f"{config.merge_data}/source=batch"):
            batch = spark.read.schema(MERGE_DATA).format(config.table_format).load(f"{config.merge_data}/source=batch")
            rows = rows.unionByName(batch.select(*MERGE_DATA.fieldNames(), F.lit("batch").alias("source")))
        return rows
    table = read_table(spark, config.merge_data, config.table_format, _with_columns(MERGE_DATA, SLICE))
    return table.select(*MERGE_DATA.fieldNames(), "source")


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    """Name a lake folder in the catalog so that any SQL can reach it.

    Registering again picks up slices written since.
    """
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'")
    if fmt != "delta" and any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {name}")


def write_bucketed(rows: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> None:
    """A catalog table in buckets of the keys, one sorted file for each: two tables with the same buckets are joined on the
    keys without a shuffle."""
    (
        rows.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
        .option("path", path).mode("overwrite").saveAsTable(name)
    )


def write_by_year(rows: DataFrame, path: str, config: LakeConfig) -> None:
    """In folders by year of the review, so that a query over some years opens no others. Each task holds one file a year
    open, as ``spark.sql.maxConcurrentOutputFileWriters`` allows, or sorts its rows by it."""
    (
        rows.withColumn("review_year", F.year("timestamp")).write.format(config.table_format)
        .option("maxRecordsPerFile", config.max_records_per_file).option("compression", config.compression).partitionBy("review_year").mode("overwrite").save(path)
    )


def read_merge(spark: SparkSession, config: LakeConfig) -> DataFrame:
    """Historical reviews joined with items, before ids; a view of the canonical table, not a copy."""
    rows = read_merge_data(spark, config).where("source = 'batch'")
    return rows.select(*MERGE.fieldNames())
