"""Content-addressed manifest of a table: a Merkle tree for each group of rows, and one over the groups.

Leaves of a group stand in the order of their id. While a group has several nodes, each run of `fan_out` consecutive ones
becomes the digest of their digests; what remains is its subroot. Subroots, in the order of their group, make the root in the
same way. What is stored of inner nodes is one record for each digest, digest to children.

A leaf is proven by descent: from the root along the digits of its group's rank, then along the digits of its own rank,
looking up each digest's record, going on with the selected child and collecting the others. Requests that share a beginning
descend once, as one row for each distinct prefix, so the root's record meets one row however many requests there are. The
segments are reversed at the end, so that a path leads from the leaf to the root.

Ranks come from a range partitioning that is stored: a row's place in its partition, and how many rows of its group the
partitions before hold. No group, and no run of equal rows, comes together in one task.

Null fields are digested as `-`. The null group is a group, the first. Rows without an id stand last in their group; rows
with one id stand in the order of their digests, and repeated rows are leaves each. Empty texts are texts of no bytes, and
texts of any length are digested whole. An empty table has no root, no records and no proofs. Requests for a place that is
not in the tree give no row. What is passed on of a row is within `doc`, so that any names will do.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plaudit.llm.rows import checkpointed, packed, stored

HEX = 64
BROADCAST_ROWS = 100_000

PATH = "array<struct<digit: int, others: string>>"


class Manifest(NamedTuple):
    leaves: DataFrame  # doc, tree (the group's rank), rank, digest
    trees: DataFrame  # tree, the group, digest (the subroot), height
    records: dict[str, list[DataFrame]]  # by kind of tree and level: digest, children
    root: str | None
    fan_out: int


def row_digest(*fields: Column) -> Column:
    """Digest of the fields one after another, each with its length in bytes."""
    def told(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[told(f) for f in fields]), 256)


def node_digest(children: Column) -> Column:
    return F.sha2(F.array_join(children, ""), 256)


def numbered(rows: DataFrame, groups: list[str], order: list[Column]) -> DataFrame:
    """Adds `rank`, the row's place from 0 among those of its group. `rows` must be stored, as they are read twice."""
    by = [F.col(g).asc_nulls_first() for g in groups] + order
    place = F.monotonically_increasing_id()  # the partition, and the place in it
    spread = stored(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_place", place), "places")
    part = F.shiftright("_place", 33)
    counts = spread.groupBy(part.alias("_part"), *[F.col(g).alias(f"_{g}") for g in groups]).agg(
        F.min("_place").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(*[f"_{g}" for g in groups]).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    counts = checkpointed(counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))))
    if counts.count() <= BROADCAST_ROWS:
        counts = F.broadcast(counts)
    same = reduce(Column.__and__, [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in groups], part == F.col("_part"))
    rank = F.col("_place") - F.col("_first") + F.col("_before")
    return spread.join(counts, same).select(*rows.columns, rank.alias("rank"))


def _height(n: Column, fan_out: int) -> Column:
    """How many levels stand over n leaves."""
    powers = []
    while not powers or powers[-1] * fan_out < 1 << 62:
        powers.append(powers[-1] * fan_out if powers else 1)
    return F.size(F.filter(F.array(*[F.lit(p).cast("long") for p in powers]), lambda p: p < n))


def _levels(nodes: DataFrame, height: int, fan_out: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Records of each level from the leaves up, and the last nodes of all trees. `nodes`: tree, rank, digest, height."""
    records, tops = [], [nodes.where("height = 0")]
    for level in range(1, height + 1):
        run = F.sort_array(F.collect_list(F.struct("rank", "digest")))  # fan_out of them at most
        parents = nodes.where(F.col("height") >= level).groupBy(
            "tree", "height", F.floor(F.col("rank") / fan_out).alias("up")).agg(run.getField("digest").alias("children"))
        nodes = stored(parents.select("tree", "height", F.col("up").alias("rank"),
                                      node_digest(F.col("children")).alias("digest"), "children"), f"{name}-{level}")
        records.append(nodes.groupBy("digest").agg(F.first("children").alias("children")))
        tops.append(nodes.where(F.col("height") == level))
    return records, reduce(DataFrame.union, [t.select("tree", "digest", "height") for t in tops])


def built(rows: DataFrame, digest: str, group: str = "lang", id: str = "doc_id", carry: list[str] | None = None,
          fan_out: int = 8) -> Manifest:
    """Manifest of rows that have their digest."""
    if fan_out < 2:
        raise ValueError("fan_out must be 2 at least")
    own = F.col("doc").getField
    rows = packed(rows, [id, group, digest, *(carry or [])])
    # The salt parts equal rows, so that many of them need not fill one partition.
    rows = stored(rows.select("doc", own(group).alias("group"), own(digest).alias("digest"), F.rand().alias("_salt")),
                  "leaves")
    by = [own(id).asc_nulls_last(), F.col("digest"), F.col("_salt")]
    leaves = numbered(rows, ["group"], by)
    groups = leaves.groupBy("group").agg((F.max("rank") + 1).alias("n"))
    groups = numbered(stored(groups, "groups"), [], [F.col("group").asc_nulls_first()])
    groups = checkpointed(groups.select(F.col("group").alias("_group"), F.col("rank").alias("tree"),
                                        _height(F.col("n"), fan_out).alias("height")))
    n_trees, highest = groups.count(), groups.agg(F.max("height")).first()[0]
    known = F.broadcast(groups) if n_trees <= BROADCAST_ROWS else groups
    leaves = stored(leaves.join(known, F.col("group").eqNullSafe(F.col("_group"))).select(
        "doc", "tree", "rank", "digest", "height"), "ranked")

    records, tops = _levels(leaves.select("tree", "rank", "digest", "height"), highest or 0, fan_out, "nodes")
    trees = stored(tops.join(groups.select("tree", F.col("_group").alias("group")), "tree"), "trees")
    above = trees.select(F.lit(0).alias("tree"), F.col("tree").alias("rank"), "digest").withColumn(
        "height", _height(F.lit(n_trees).cast("long"), fan_out))
    top = sum(fan_out ** k < n_trees for k in range(62))
    above_records, root = _levels(above, top, fan_out, "subroots")
    found = root.select("digest").first()
    return Manifest(leaves, trees, {"leaves": records, "trees": above_records}, found and found.digest, fan_out)


def _step(frontier: DataFrame, records: DataFrame, wanted: DataFrame, fan_out: int) -> DataFrame:
    """One level down: the record of each digest, its selected children, and the others beside each of them.

    `wanted`: tree, rank of the children asked for, and whatever else is to be passed on."""
    rows = frontier.join(records, "digest").drop("digest").withColumnRenamed("rank", "up")
    wanted = wanted.withColumn("up", F.floor(F.col("rank") / fan_out))
    digit = (F.col("rank") % fan_out).cast("int")
    others = F.array_join(F.filter("children", lambda _, k: k != digit), "")
    path = F.array_append("path", F.struct(digit.alias("digit"), others.alias("others")))
    return rows.join(wanted, ["tree", "up"]).withColumns(
        {"digest": F.get("children", digit), "path": path}).where("digest IS NOT NULL").drop("children", "up")


def proven(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """Every request (tree, rank, and `doc`, which is passed on) with `subroot`, `digest` and `path`: for each level from the
    leaf to the root the digit of the child that leads to the leaf, and the digests of its siblings from left to right."""
    f, records = manifest.fan_out, manifest.records
    requests = requests.select("doc", "tree", "rank")

    def prefixes(asked: DataFrame, level: int) -> DataFrame:
        return asked.select("tree", F.floor(F.col("rank") / f ** level).alias("rank")).distinct()

    # Down to the subroots asked for: one tree whose leaves are the trees.
    trees = requests.select(F.lit(0).alias("tree"), F.col("tree").alias("rank")).distinct()
    frontier = requests.sparkSession.createDataFrame(
        [(0, 0, manifest.root)] if manifest.root else [], "tree long, rank long, digest string").withColumn(
        "path", F.array().cast(PATH))
    for level in range(len(records["trees"]), 0, -1):
        frontier = _step(frontier, records["trees"][level - 1], prefixes(trees, level - 1), f)
    tree = F.col("rank").alias("tree")
    starts = stored(frontier.select(tree, F.col("digest").alias("subroot"), "path").join(
        manifest.trees.select("tree", "height"), "tree"), "starts")

    # Down each tree, which joins in at the level of its own height.
    runs = stored(prefixes(requests, 1), "runs")

    def begun(level: int) -> DataFrame:
        return starts.where(F.col("height") == level).select(
            "tree", F.lit(0).cast("long").alias("rank"), F.col("subroot").alias("digest"), "path", "subroot")

    frontier = None
    for level in range(len(records["leaves"]), 0, -1):
        frontier = begun(level) if frontier is None else frontier.unionByName(begun(level))
        asked = requests if level == 1 else prefixes(runs, level - 2)
        frontier = _step(frontier, records["leaves"][level - 1], asked, f)
    alone = begun(0).join(requests, ["tree", "rank"])
    found = alone if frontier is None else frontier.unionByName(alone)
    return found.select("doc", "tree", "rank", "subroot", "digest", F.reverse("path").alias("path"))


def siblings(path: Column) -> Column:
    """All digests of a path, level by level."""
    return F.array_join(F.transform(path, lambda step: step.getField("others")), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path lead to."""
    def up(own: Column, step: Column) -> Column:
        others, at = step.getField("others"), step.getField("digit") * HEX
        return F.sha2(F.concat(F.substr(others, F.lit(1), at), own, F.substr(others, at + 1)), 256)

    return F.aggregate(path, leaf, up)
