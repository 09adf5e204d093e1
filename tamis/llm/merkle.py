"""A Merkle manifest of a dataset: a tree of digests per group of records, and a tree of the groups' roots.

Only built-in functions are used. Nodes are numbered within their group; level by level a window over (group, number / fan)
collects the digests of a run in order, which gives every node its siblings and the digest above; the first node of each run
goes on as the parent. Going back from the root, every node gets the path of its parent and adds its own siblings, so that both
ways cost in proportion to the leaves. No window holds more than `fan` rows.

Numbers come from a range partitioning by group and order: counts of each partition are summed and shifted, so that a hot group
is spread. Equal leaves are counted before, so that many copies of one record don't meet in one task.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.llm.common import stash

FAN = 3
#: Leaves that a range holds, about.
RANGE_ROWS = 1 << 16
#: Equal leaves that are written from one row.
RUN = 1 << 12
_PATH = "array<struct<before:string,after:string>>"


def framed(value: Column) -> Column:
    """A value as it enters a leaf: its UTF-8 byte count, a colon, itself; null is `-`."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(framed, values)), 256)


def _numbered(rows: DataFrame, order: list[str], carried: list[str]) -> DataFrame:
    """Rows (g, order, carried, copies) once per copy, with at: the number within g, from 0, by `order`; and size: the rows of g. No two rows are equal in g and `order`, which range partitioning deals out."""
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows.count() / RANGE_ROWS))
    ranged = rows.repartitionByRange(parts, F.asc_nulls_first("g"), *(F.asc_nulls_first(c) for c in order))
    ranged = stash(ranged.withColumn("part", F.spark_partition_id()), "ranges")
    sums = ranged.groupBy("part", "g").agg(F.sum("copies").alias("n"))
    by = Window.partitionBy("g")
    shift = sums.select("part", "g", (F.sum("n").over(by.orderBy("part")) - F.col("n")).alias("before"), F.sum("n").over(by).alias("size"))
    own = F.sum("copies").over(Window.partitionBy("part", "g").orderBy(*(F.asc_nulls_first(c) for c in order))) - F.col("copies")
    met = ranged.withColumn("own", own).join(shift, ["part", "g"])
    met = met.select("g", *carried, "copies", "size", (F.col("before") + F.col("own")).alias("first"))
    # copies in two steps, so that no long list is made
    runs = met.withColumn("run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / RUN))))
    start, end = F.col("first") + F.col("run") * RUN, F.col("first") + F.least(F.col("copies"), (F.col("run") + 1) * RUN) - 1
    return runs.select("g", *carried, "size", F.explode(F.sequence(start, end)).alias("at"))


def _levels(nodes: DataFrame, fan: int, carried: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """Written levels (g, at, size, parent, before, after; carried in the first) of all groups of more than one node, and (g, digest) of what remains of each group. nodes: a written table of g, at, size, digest, carried."""
    levels, ends = [], [nodes.where("size = 1").select("g", "digest")]
    most = nodes.agg(F.max("size")).first()[0] or 1
    join = lambda a: F.array_join(a, "")
    run = Window.partitionBy("g", "parent").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    while most > 1:
        met = nodes.where("size > 1").withColumn("parent", F.floor(F.col("at") / fan)).withColumn("run", F.collect_list("digest").over(run)).withColumn("place", (F.col("at") % fan).cast("int"))
        beside = (join(F.slice("run", F.lit(1), F.col("place"))).alias("before"), join(F.slice("run", F.col("place") + 2, F.lit(fan))).alias("after"))
        level = stash(met.select("g", "at", "size", "parent", *carried, *beside, F.sha2(join(F.col("run")), 256).alias("above")), "merkle-level")
        levels.append(level)
        carried, most = [], math.ceil(most / fan)
        # a parent once: from the first node of its run
        nodes = level.where(F.col("at") % fan == 0).select("g", F.col("parent").alias("at"), F.ceil(F.col("size") / fan).alias("size"), F.col("above").alias("digest"))
        ends.append(nodes.where("size = 1").select("g", "digest"))
    return levels, stash(reduce(DataFrame.unionByName, ends), "merkle-roots")


def _paths(levels: list[DataFrame], tops: DataFrame, fan: int, carried: list[str]) -> DataFrame:
    """(g, at, carried, path, kept) of the nodes of the first level: their siblings of each level, and then the path of tops (g, path, kept)."""
    own, kept, paths = F.array(F.struct("before", "after")), [c for c in tops.columns if c not in ("g", "path")], None
    for k, level in reversed(list(enumerate(levels))):
        new = ["g", "at", *(carried if k == 0 else []), F.concat(own, "path").alias("path"), *kept]
        # groups of which one node is left above this level go on from their top
        ended = level.where(F.col("size") <= fan).join(tops, "g").select(*new)
        if paths is None:
            paths = ended
        else:
            paths = level.where(F.col("size") > fan).join(paths.withColumnRenamed("at", "parent"), ["g", "parent"]).select(*new).unionByName(ended)
    return paths


def siblings(path: Column) -> Column:
    """All siblings of a path from leaf to root, each level from left to right, as one text."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["before"], p["after"])), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda digest, p: F.sha2(F.concat(p["before"], digest, p["after"]), 256))


def merkle_manifest(records: DataFrame, columns: list[str], group_col: str, order_col: str, changed: dict[str, Column] | None = None, fan: int = FAN) -> DataFrame:
    """order_col, leaf, subroot, root, path and folded_root of every record.

    A leaf is the SHA-256 of the framed columns, in lower-case hex like all digests. Leaves of a group ascend by order_col,
    null first, rows that repeat it by their leaf; each `fan` consecutive nodes of a level make one of the next, the digest of
    theirs one after the other; the last run may have fewer, even one. Groups are ordered by group_col, null first, bytewise,
    and their subroots make the root in the same way. path: array<struct<before, after>>, the digests beside the node in its
    run, from the leaf to the root. folded_root is the root that the path gives for the record as it would be with the columns
    `changed` (name -> expression over the record), which equals root if nothing differs. Null values are framed as `-`; a
    single record is its own subroot and root. One row per record, equal ones included; an empty table gives no rows. Other
    columns are ignored.
    """
    if fan < 2:
        raise ValueError("fan must be 2 or more")
    changed = changed or {}
    col = lambda c: F.col(f"`{c}`")
    now = leaf_of([changed.get(c, col(c)) for c in columns])
    group = col(group_col).cast("string")
    leaves = records.select(F.when(group.isNull(), "n").otherwise(F.concat(F.lit("s"), group)).alias("g"), col(order_col).alias("key"), leaf_of([col(c) for c in columns]).alias("digest"), now.alias("now"))
    leaves = stash(leaves.groupBy("g", "key", "digest", "now").agg(F.count("*").alias("copies")), "leaves")
    nodes = stash(_numbered(leaves, ["key", "digest", "now"], ["key", "digest", "now"]).withColumn("leaf", F.col("digest")), "numbered-leaves")
    levels, subroots = _levels(nodes, fan, ["key", "leaf", "now"])
    groups = subroots.select(F.lit("").alias("g"), F.col("g").alias("name"), "digest", F.lit(1).cast("bigint").alias("copies"))
    groups = stash(_numbered(groups, ["name"], ["name", "digest"]).withColumn("subroot", F.col("digest")), "groups")
    tops, roots = _levels(groups, fan, ["name", "subroot"])
    found = roots.first()
    root = F.lit(found["digest"] if found else None).cast("string")
    none = F.array().cast(_PATH)
    top = records.sparkSession.range(1).select(F.lit("").alias("g"), none.alias("path"))
    of_group = _paths(tops, top, fan, ["name", "subroot"]) if tops else groups.withColumn("path", none)  # a single group has the root
    of_group = stash(of_group.select(F.col("name").alias("g"), "path", "subroot"), "group-paths")
    out = nodes.where("size = 1").select("g", "at", "key", "leaf", "now").join(of_group, "g")
    if levels:
        out = out.unionByName(_paths(levels, of_group, fan, ["key", "leaf", "now"]))
    return out.select(F.col("key").alias(order_col), "leaf", "subroot", root.alias("root"), "path", fold(F.col("now"), F.col("path")).alias("folded_root"))
