"""Key constraints and target schemas as queries."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plaudit.contracts import FOREIGN_KEYS, PRIMARY_KEYS


def pk_violations(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def fk_orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child keys without a parent, with their row count. Null keys satisfy the constraint.

    Child rows are counted per key first, so a hot key reaches the join as one row.
    """
    per_key = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return per_key.join(parent.select(key), key, "left_anti")


def _digest(key: Column) -> Column:
    """128 bits that stand for a key in a grouping; ids are 36 characters that no compression of the shuffle shortens."""
    return F.unhex(F.md5(key.cast("string")))


def primary_key_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: rows, null keys and keys that repeat.

    All tables' keys go through one grouping; what it leaves is summed in one row.
    """
    keys = reduce(DataFrame.unionByName, [
        tables[name].select(F.lit(name).alias("table_name"), F.col(PRIMARY_KEYS[name]).alias("key")) for name in tables])
    return _keys_summed(keys, list(tables))


def derived_key_report(per_review: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The same before the tables are written: those of one row per review are taken from one pass over the reviews;
    ``tables`` are the others. Tables with the same rows and key are counted once and reported each."""
    alike = {name: PRIMARY_KEYS[name] for name in PRIMARY_KEYS if name not in tables}
    pairs = F.create_map(*[c for key in dict.fromkeys(alike.values()) for c in (F.lit(key), F.col(key))])
    keys = reduce(DataFrame.unionByName, [
        per_review.select(F.explode(pairs).alias("table_name", "key")),
        *[rows.select(F.lit(name).alias("table_name"), F.col(PRIMARY_KEYS[name]).alias("key"))
          for name, rows in tables.items()]])
    return _keys_summed(keys, [*alike, *tables], alike)


def _keys_summed(keys: DataFrame, names: list[str], counted_as: Mapping[str, str] | None = None) -> DataFrame:
    alike = counted_as or {}
    codes = {name: number for number, name in enumerate(dict.fromkeys(alike.get(name, name) for name in names))}
    coded = F.element_at(F.create_map(*[F.lit(x) for pair in codes.items() for x in pair]), F.col("table_name"))
    per_key = keys.select(coded.alias("table"), _digest(F.col("key")).alias("key")).groupBy("table", "key").agg(
        F.count(F.lit(1)).alias("n"))

    def of(name: str) -> list[Column]:
        here = F.col("table") == codes[alike.get(name, name)]
        return [F.lit(name).alias("table_name"),
                F.coalesce(F.sum(F.when(here, F.col("n"))), F.lit(0)).alias("n_rows"),
                F.coalesce(F.sum(F.when(here & F.col("key").isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
                F.count_if(here & (F.col("n") > 1) & F.col("key").isNotNull()).alias("repeated_keys")]

    return per_key.agg(F.array(*[F.struct(*of(name)) for name in names]).alias("r")).select(F.inline("r"))


def foreign_key_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per constraint: child rows that have no parent. Null keys satisfy the constraint.

    Each child table is read once for all its keys, and children meet parents in one grouping, where a hot key has
    been counted before the shuffle.
    """
    def named(child: str, key: str, parent: str) -> str:
        return f"{child}.{key} -> {parent}"

    codes = {named(*fk): F.lit(number) for number, fk in enumerate(FOREIGN_KEYS)}
    parts = []
    for child in dict.fromkeys(c for c, _, _ in FOREIGN_KEYS):
        pairs = F.create_map(*[x for c, k, p in FOREIGN_KEYS if c == child for x in (codes[named(c, k, p)], _digest(F.col(k)))])
        parts.append(tables[child].select(F.explode(pairs).alias("fk", "key"), F.lit(1).alias("n"))
                     .where(F.col("key").isNotNull()))
    parts += [tables[p].select(codes[named(c, k, p)].alias("fk"), _digest(F.col(k)).alias("key"), F.lit(0).alias("n"))
              for c, k, p in FOREIGN_KEYS]
    per_key = reduce(DataFrame.unionByName, parts).groupBy("fk", "key").agg(
        F.sum("n").alias("n"), F.min("n").alias("parent"))
    orphans = [F.struct(F.lit(named(*fk)).alias("constraint_name"), F.coalesce(F.sum(F.when(
        (F.col("fk") == codes[named(*fk)]) & (F.col("parent") == 1), F.col("n"))), F.lit(0)).alias("orphan_rows"))
        for fk in FOREIGN_KEYS]
    return per_key.agg(F.array(*orphans).alias("r")).select(F.inline("r"))


def conform(rows: DataFrame, target: StructType) -> DataFrame:
    """Columns by name in target order and type; a missing column is an error."""
    missing = [name for name in target.fieldNames() if name not in rows.columns]
    if missing:
        raise ValueError(f"columns missing for the target table: {missing}")
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields])
