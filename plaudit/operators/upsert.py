"""A change log applied to a table: the newest change of each key counts, by copy-on-write of hash partitions.

The table is partitioned by a hash of the key. A delivery of changes rewrites the partitions of its keys and no others. Rows keep
the position of the change they come from, deleted keys stay as marks, and a change that is not newer than what the table
has is passed over: changes may come twice, late, or again after a failure, and the table is the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plaudit.config import LakeConfig
from plaudit.contracts import table
from plaudit.operators.enrich import keep_first
from plaudit.operators.sinks import write_table
from plaudit.session import scratch_path
from plaudit.sources.files import folders
from plaudit.sources.lake import read_table

# Where in the change log a row comes from, in the order that counts.
POSITION = table("ts_ms BIGINT, partition INT, offset BIGINT")
MARK = table("deleted BOOLEAN")


def stored_schema(contract: StructType) -> StructType:
    return StructType(contract.fields + MARK.fields + POSITION.fields)


def newest(rows: DataFrame, key: str) -> DataFrame:
    return keep_first(rows, [key], [F.col(name).desc_nulls_last() for name in POSITION.fieldNames()])


def apply_changes(changes: DataFrame, path: str, contract: StructType, key: str, config: LakeConfig) -> None:
    """Apply rows of the contract with their position and ``deleted``; what a deleted row holds beside its key is not kept.

    The delivery is stored in its reduced form, as it says which partitions to read before it is merged into them. The
    partitions are replaced one by one when all have been written, so a reader may see some before others.
    """
    spark = changes.sparkSession
    part = F.pmod(F.xxhash64(key), F.lit(config.table_partitions)).cast("int")
    names = stored_schema(contract).fieldNames()
    columns = [F.when(~F.col("deleted"), F.col(n)).alias(n) if n in contract.fieldNames() and n != key else F.col(n)
               for n in names]
    scratch = scratch_path(spark, "delivery")
    write_table(newest(changes.select(*columns), key).withColumn("part", part), scratch, config)
    delta = read_table(spark, scratch, config.table_format)
    touched = [r.part for r in delta.select("part").distinct().collect()]  # at most table_partitions
    if not touched:
        return
    rows = delta.select(*names, "part")
    if folders(spark, path):
        rows = _stored(spark, path, contract).where(F.col("part").isin(touched)).unionByName(rows)
    (
        newest(rows, key).repartitionById(config.table_partitions, "part")
        .write.format(config.table_format).option("partitionOverwriteMode", "dynamic")
        .partitionBy("part").mode("overwrite").save(path)
    )


def _stored(spark: SparkSession, path: str, contract: StructType) -> DataFrame:
    schema = StructType(stored_schema(contract).fields + table("part INT").fields)
    return spark.read.schema(schema).parquet(path)


def read_current(spark: SparkSession, path: str, contract: StructType) -> DataFrame:
    """The rows as the changes have left them."""
    if not folders(spark, path):
        return spark.createDataFrame([], contract)
    return _stored(spark, path, contract).where("NOT deleted").select(*contract.fieldNames())
