"""Merkle manifest of a dataset, and a recursive query that climbs from every leaf to the root.

The tree is built level by level and stored as node rows that point to their parents. Checking a
leaf is then a ``WITH RECURSIVE`` query: it follows the parent links, appends the siblings on the
way and folds the hash that the leaf has now. Leaves of one run share all nodes above it, so a
climbing row holds the hashes of the whole run and the siblings they have in common, as bytes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyfold.session import written

FAN = 16
#: Climbing rows that may meet at one copy of a node; a node above more of them has copies.
ROWS_PER_COPY = 4096
#: Hex digits of a digest.
WIDTH = 64
TOP = -1

CLIMB = """
WITH RECURSIVE climb(unit, node, copy, folds, siblings, subroot) AS (
  SELECT unit, node, 0L, folds, X'', CAST(NULL AS STRING) FROM {units}
  UNION ALL
  SELECT c.unit, l.parent, pmod(xxhash64(c.unit), l.parent_copies),
         transform(c.folds, f -> unhex(sha2(concat(l.left, lower(hex(f)), l.right), 256))),
         concat(c.siblings, unhex(l.left), unhex(l.right)), coalesce(c.subroot, l.subroot)
  FROM climb c JOIN {links} l ON c.node = l.node AND c.copy = l.copy
)
SELECT unit, folds, siblings, subroot FROM climb WHERE node = {top}
"""


@dataclass
class Manifest:
    """Stored levels of a tree: ``units`` (runs of leaves), ``links`` (child to parent), the root.

    ``root`` and ``top``, the root's node id, are None for an empty dataset.
    """

    units: DataFrame
    links: DataFrame
    root: str | None
    top: str | None


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(column: Column) -> Column:
    """A value as it enters a leaf: ``-`` if null, else its length in bytes, ``:`` and itself."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def ranked(rows: DataFrame, group: str, order: Sequence[str], more=None) -> DataFrame:
    """``rows`` with ``idx``, their place from 0 within ``group``, and ``n``, the group's size.

    The rows are sorted over ranges, so no group is in one task, however many rows it has or
    share one position; a small table of one row per range and group carries the counts across.
    ``more`` may add columns to the table ``(group, n)``; the rows then have them too.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    keys = [group, *order, "_tie"]
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = written(
        tied.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(*rows.columns, F.spark_partition_id().alias("_range"), at.alias("_at")),
        "ranges",
    )
    counts = placed.groupBy("_range", group).agg(
        F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_rows")
    )
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = written(
        counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))), "ranges"
    )
    groups = counts.groupBy(group).agg(F.sum("_rows").alias("n"))
    groups = groups if more is None else more(groups)
    found = placed.join(written(counts.join(groups, group), "ranges"), ["_range", group])
    place = F.col("_at") - F.col("_from") + F.col("_before")
    own = [c for c in groups.columns if c != group]
    return found.select(*rows.columns, place.alias("idx"), *own)


def _node(scope: Column, level: int | Column, idx: Column) -> Column:
    level = F.lit(level) if isinstance(level, int) else level
    return F.concat_ws("/", *[c.cast("string") for c in (scope, level, idx)])


def _copies(units: Column) -> Column:
    return F.ceil(units / ROWS_PER_COPY).cast("long")


def _around(digests: Column, place: Column) -> tuple[Column, Column]:
    """What stands left and right of the digest at ``place`` in the concatenation of a run."""
    left = F.substring(digests, F.lit(1), (place * WIDTH).cast("int"))
    return left, F.substring(digests, ((place + 1) * WIDTH + 1).cast("int"), F.octet_length(digests))


def _raised(nodes: DataFrame, level: int, fan: int, subroots: bool) -> tuple[DataFrame, DataFrame]:
    """One level up: the parents of ``nodes`` of trees that still have several, and the links."""
    runs = written(
        nodes.filter("n > 1")
        .groupBy("scope", "n", F.floor(F.col("idx") / fan).alias("up"))
        .agg(
            F.sort_array(F.collect_list(F.struct("idx", "node", "hash", "units"))).alias("kids"),
            F.sum("units").alias("units"),
        )
        .withColumn("digests", F.array_join(F.col("kids.hash"), "")),
        f"level-{level}",
    )
    parents = runs.select(
        "scope",
        F.ceil(F.col("n") / fan).alias("n"),
        F.col("up").alias("idx"),
        _node(F.col("scope"), level, F.col("up")).alias("node"),
        digest(F.col("digests")).alias("hash"),
        "units",
    )
    kids = runs.select(
        F.explode("kids").alias("kid"),
        "digests",
        _node(F.col("scope"), level, F.col("up")).alias("parent"),
        _copies(F.col("units")).alias("parent_copies"),
    )
    left, right = _around(F.col("digests"), F.col("kid.idx") % fan)
    links = kids.select(
        F.col("kid.node").alias("node"),
        F.explode(F.sequence(F.lit(0), _copies(F.col("kid.units")) - 1)).alias("copy"),
        "parent",
        "parent_copies",
        left.alias("left"),
        right.alias("right"),
        (F.col("kid.hash") if subroots else F.lit(None).cast("string")).alias("subroot"),
    )
    return parents, links


def build(
    rows: DataFrame,
    id_column: str,
    group_column: str,
    fields: Sequence[str],
    tampered: dict[str, Column] | None = None,
    fan: int = FAN,
) -> Manifest:
    """The tree over ``rows``: a leaf per row, a subtree per group, a tree over the subtrees.

    Leaves of a group ascend by id (null first, equal ids by their hash, so repeated rows are
    leaves of their own and equal rows are interchangeable); groups ascend by value (null first,
    bytewise). ``tampered`` gives changed values of fields: a leaf's fold starts from the hash
    with them. Only ids and digests are shuffled; texts are read once. Column names of ``rows``
    are not restricted, other columns are ignored.
    """
    changed = {**{name: F.col(name) for name in fields}, **(tampered or {})}
    key = F.when(F.col(group_column).isNull(), "").otherwise(
        F.concat(F.lit("="), F.col(group_column).cast("string"))
    )
    leaf = digest(*[field(F.col(name)) for name in fields])
    now = digest(*[field(changed[name]) for name in fields])
    differs = F.lit(False)
    for name in tampered or {}:
        differs = differs | ~F.col(name).eqNullSafe(changed[name])
    leaves = rows.select(
        F.col(id_column).alias("id"),
        key.alias("key"),
        leaf.alias("leaf"),
        F.when(differs, now).alias("now"),
    )
    scopes = []

    def numbered(groups: DataFrame) -> DataFrame:
        one = groups.select("key", F.col("n").alias("rows"), F.lit("").alias("all"))
        placed = ranked(one, "all", ["key"]).select("key", "rows", F.col("idx").alias("scope"))
        scopes.append(written(placed.withColumnRenamed("rows", "n"), "scopes"))
        return scopes[0]

    leaves = ranked(leaves, "key", ["id", "leaf"], numbered)
    largest, scope_count = scopes[0].agg(F.max("n"), F.count(F.lit(1))).first()
    place = F.col("idx") % fan
    entry = F.struct(place.alias("place"), "id", "leaf", "now")
    lone = F.col("lone")
    units = (
        leaves.groupBy("scope", "n", F.floor(F.col("idx") / fan).alias("run"))
        .agg(F.sort_array(F.collect_list(entry)).alias("leaves"))
        .withColumn("lone", F.col("n") == 1)
        .withColumn("digests", F.array_join(F.col("leaves.leaf"), ""))
    )

    def start(e: Column) -> Column:
        left, right = _around(F.col("digests"), e["place"])
        own = F.coalesce(e["now"], e["leaf"])
        return F.when(lone, own).otherwise(digest(left, own, right))

    node = _node(F.col("scope"), F.when(lone, 0).otherwise(1), F.col("run"))
    units = written(
        units.select(
            F.monotonically_increasing_id().alias("unit"),
            "scope",
            F.when(lone, 1).otherwise(F.ceil(F.col("n") / fan)).cast("long").alias("n"),
            F.col("run").alias("idx"),
            node.alias("node"),
            F.when(lone, F.col("digests")).otherwise(digest(F.col("digests"))).alias("hash"),
            F.transform("leaves", lambda e: F.unhex(start(e))).alias("folds"),
            "leaves",
            F.when(~lone, F.col("digests")).otherwise("").alias("siblings"),
        ).withColumnRenamed("siblings", "digests"),
        "units",
    )
    if largest is None:
        return Manifest(units, None, None, None)

    def climbed(nodes, count, level, subroots):
        """All levels of the trees in ``nodes``, the largest of which has ``count`` nodes."""
        done, links = [nodes.filter("n = 1")], []
        while count > 1:
            level += 1
            nodes, own = _raised(nodes, level, fan, subroots and not links)
            done.append(nodes.filter("n = 1"))
            links.append(own)
            count = -(-count // fan)
        return _union(done), links

    lowest = units.select("scope", "n", "idx", "node", "hash", F.lit(1).cast("long").alias("units"))
    subroots, links = climbed(lowest, -(-largest // fan), 1, False)
    over = subroots.select(
        F.lit(TOP).cast("long").alias("scope"), F.lit(scope_count).cast("long").alias("n"),
        F.col("scope").alias("idx"), "node", "hash", "units",
    )
    top, more = climbed(written(over, "subroots"), scope_count, 0, True)
    root = top.first()
    links = written(_union(links + more), "links") if links + more else None
    return Manifest(units, links, root["hash"], root["node"])


def _union(tables: list[DataFrame]) -> DataFrame:
    whole = tables[0]
    for part in tables[1:]:
        whole = whole.unionByName(part)
    return whole


def climb(spark: SparkSession, manifest: Manifest) -> DataFrame:
    """``unit, folds, siblings, subroot`` of every run of leaves, once it has reached the root."""
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    if manifest.links is None:
        return manifest.units.select(
            "unit", "folds", F.lit(b"").alias("siblings"), F.lit(None).cast("string").alias("subroot")
        )
    return spark.sql(CLIMB, units=manifest.units, links=manifest.links, top=manifest.top)


def verify(
    rows: DataFrame,
    id_column: str,
    group_column: str,
    fields: Sequence[str],
    tampered: dict[str, Column] | None = None,
    fan: int = FAN,
) -> DataFrame:
    """``id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    ``proof_sha256`` is the hash of all siblings from the leaf up, left to right;
    ``folded_root`` is what the leaf with its ``tampered`` values gives together with them. Nulls
    in any column, empty texts and repeated rows are leaves like others; an empty table has no
    rows and no root. A dataset of one leaf is its own root, with the hash of nothing as proof.
    """
    manifest = build(rows, id_column, group_column, fields, tampered, fan)
    reached = climb(rows.sparkSession, manifest).select("unit", "folds", "siblings", "subroot")
    found = manifest.units.select("unit", "leaves", "digests").join(reached, "unit")
    each = found.select(
        F.posexplode("leaves").alias("at", "own"), "folds", "digests", "siblings", "subroot"
    )
    left, right = _around(F.col("digests"), F.col("own.place"))
    root = F.lit(manifest.root).cast("string")
    folded = F.lower(F.hex(F.get("folds", F.col("at"))))
    above = F.lower(F.hex("siblings"))
    return each.select(
        F.col("own.id").alias("id"),
        F.col("own.leaf").alias("leaf"),
        F.coalesce("subroot", root).alias("subroot"),
        root.alias("root"),
        digest(left, right, above).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == root).alias("verified"),
    )
