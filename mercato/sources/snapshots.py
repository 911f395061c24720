"""Versioned tables: snapshot lineage, ancestry, shared ancestor, changelog.

No table-format jar is assumed. A versioned table is modelled as data:

* a *lineage* DataFrame ``(table_name, snapshot_id, parent_id)``;
* a *reader* ``snapshot_id -> DataFrame`` giving the table as of that snapshot
  (a parquet folder per snapshot, or any derived DataFrame).

Ancestry is computed by pointer doubling over the lineage; the changelog between two
snapshots is ``EXCEPT ALL`` both ways, computed as one tagged union and
aggregation; ``_change_type`` marks INSERT / DELETE. With a table format
that has its own changelog, pass its reader instead -- nothing else changes.
"""

from __future__ import annotations

import sys
import itertools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.operators.diff import (B_N, C_N, T_N, Comparison, bag_changes, changes, check_schemas, compare_changelogs,
                                    compare_tables, groupable, stringify, three_way_counts)

# Change-tracking columns dropped before a diff (they differ between two
# histories even when the end states agree). ``_change_type`` is kept.
TRACKING_COLUMNS = ("_change_ordinal", "_commit_snapshot_id")
INSERT, DELETE = "INSERT", "DELETE"

_view_ids = itertools.count()


class NoSharedAncestor(LookupError):
    """The two snapshots have no common ancestor (or belong to different tables)."""


@dataclass
class VersionedTable:
    name: str
    lineage: DataFrame                         # table_name, snapshot_id, parent_id
    reader: Callable[[int], DataFrame]

    def at(self, snapshot_id: int) -> DataFrame:
        return self.reader(int(snapshot_id))


def from_snapshot_paths(spark: SparkSession, name: str, lineage_with_paths: DataFrame,
                        fmt: str = "parquet") -> VersionedTable:
    """A versioned table whose snapshots are folders: lineage has a ``path`` column.

    Opening a snapshot reads the one lineage row that has its path.
    """
    own = lineage_with_paths.filter(F.col("table_name") == name)

    def reader(snapshot_id: int) -> DataFrame:
        row = own.filter(F.col("snapshot_id") == snapshot_id).select("path").first()
        if row is None:
            raise LookupError(f"{name} has no snapshot {snapshot_id}")
        return spark.read.format(fmt).load(row.path)

    return VersionedTable(name, lineage_with_paths.select("table_name", "snapshot_id", "parent_id"), reader)


def from_catalog_table(spark: SparkSession, name: str, lineage: DataFrame) -> VersionedTable:
    """A catalog table whose format supports time travel by snapshot id
    (``spark.read.option("snapshot-id", id).table(name)``); the lineage comes
    from the format's metadata tables, loaded by the caller."""
    return VersionedTable(name, lineage,
                          lambda s: spark.read.option("snapshot-id", str(s)).table(name))


def ancestors(lineage: DataFrame, roots: list[int] | None = None, table_name: str | None = None) -> DataFrame:
    """Every snapshot (or only ``roots``) with each of its ancestors, itself at depth 0.

    Output: table_name, snapshot_id, ancestor_id, depth -- depth 0 is the
    snapshot, 1 its parent, ... (newest first when ordered by depth).

    Pointer doubling: after round k every root knows its ancestors at depths
    below 2^k, and a jump table holds each snapshot's 2^k-th ancestor; one join
    of each doubles both. A chain of depth L takes about log2(L) rounds of
    small joins (a recursive query would take L rounds). Both tables are
    written to the shared checkpoint folder each round, so plans stay short.
    """
    from mercato.session import cut_lineage, cut_lineage_counted

    # the lineage is read twice (jump table, start rows): pass a materialised
    # table, one row per snapshot, not a plan over the data
    lin = lineage.select("table_name", "snapshot_id", "parent_id")
    if table_name is not None:
        lin = lin.filter(F.col("table_name") == table_name)
    jump = lin.filter(F.col("parent_id").isNotNull()).select(
        "table_name", F.col("snapshot_id").alias("__from"), F.col("parent_id").alias("__to"))
    start = lin if roots is None else lin.filter(F.col("snapshot_id").isin([int(r) for r in roots]))
    known = start.select("table_name", "snapshot_id", F.col("snapshot_id").alias("ancestor_id"),
                         F.lit(0).alias("depth"))
    span = 1
    while True:
        step = known.join(jump, (known.table_name == jump.table_name) & (known.ancestor_id == jump.__from)) \
            .select(known.table_name, "snapshot_id", F.col("__to").alias("ancestor_id"),
                    (F.col("depth") + span).alias("depth"))
        step, n = cut_lineage_counted(step)
        if not n:
            return known
        known = known.unionByName(step)
        j2 = jump.alias("a").join(jump.alias("b"), (F.col("a.table_name") == F.col("b.table_name"))
                                  & (F.col("a.__to") == F.col("b.__from")))
        jump = cut_lineage(j2.select(F.col("a.table_name").alias("table_name"), F.col("a.__from").alias("__from"),
                                     F.col("b.__to").alias("__to")))
        span *= 2


def ancestors_recursive(lineage: DataFrame, max_depth: int = 100) -> DataFrame:
    """The same ancestry as a recursive query (one iteration per level, up to ``max_depth``)."""
    spark = lineage.sparkSession
    view = f"__lineage_{next(_view_ids)}"
    lineage.select("table_name", "snapshot_id", "parent_id").createOrReplaceTempView(view)
    return spark.sql(f"""
        WITH RECURSIVE anc (table_name, snapshot_id, ancestor_id, depth) MAX RECURSION LEVEL {int(max_depth) + 1} AS (
          SELECT table_name, snapshot_id, snapshot_id, 0 FROM {view}
          UNION ALL
          SELECT a.table_name, a.snapshot_id, l.parent_id, a.depth + 1
          FROM anc a JOIN {view} l
            ON a.table_name = l.table_name AND a.ancestor_id = l.snapshot_id
          WHERE l.parent_id IS NOT NULL
        )
        SELECT table_name, snapshot_id, ancestor_id, depth FROM anc""")


def ancestors_of(lineage: DataFrame, table_name: str, snapshot_id: int) -> DataFrame:
    """One snapshot's ancestors (linear in its depth)."""
    return ancestors(lineage, roots=[snapshot_id], table_name=table_name)


def common_ancestor(lineage: DataFrame, table_name: str, control_snapshot: int,
                    target_snapshot: int, which: str = "nearest") -> DataFrame:
    """The shared ancestor of two snapshots of one table (zero or one row).

    ``nearest`` = the newest shared ancestor (smallest depth from the target,
    hence the shortest changelogs); ``oldest`` = the oldest shared one.
    Output: table_name, control_snapshot, target_snapshot, ancestor_id,
    control_depth, target_depth.
    """
    if which not in ("nearest", "oldest"):
        raise ValueError("which must be 'nearest' or 'oldest'")
    anc = ancestors(lineage, roots=[control_snapshot, target_snapshot], table_name=table_name)
    c = anc.filter(F.col("snapshot_id") == int(control_snapshot)).select(
        "ancestor_id", F.col("depth").alias("control_depth"))
    t = anc.filter(F.col("snapshot_id") == int(target_snapshot)).select(
        "ancestor_id", F.col("depth").alias("target_depth"))
    shared = c.join(t, "ancestor_id")
    pick = F.min_by if which == "nearest" else F.max_by
    best = shared.agg(pick(F.struct("ancestor_id", "control_depth", "target_depth"),
                           F.col("target_depth")).alias("a")).filter(F.col("a").isNotNull())
    return best.select(
        F.lit(table_name).alias("table_name"),
        F.lit(int(control_snapshot)).cast("bigint").alias("control_snapshot"),
        F.lit(int(target_snapshot)).cast("bigint").alias("target_snapshot"),
        F.col("a.ancestor_id").alias("ancestor_id"),
        F.col("a.control_depth").alias("control_depth"),
        F.col("a.target_depth").alias("target_depth"))


def changelog(start: DataFrame, end: DataFrame) -> DataFrame:
    """Net changes from ``start`` to ``end``: inserted and deleted rows, with repeats.

    Equals ``end EXCEPT ALL start`` (INSERT) plus ``start EXCEPT ALL end``
    (DELETE), computed from one aggregation of both snapshots; copies of a
    row repeated many times are emitted in bounded chunks across tasks.
    """
    return bag_changes(start, end)


def drop_tracking_columns(df: DataFrame) -> DataFrame:
    """Drop change-tracking columns (name up to an optional ``#`` suffix); keep ``_change_type``."""
    return df.drop(*[c for c in df.columns if c.split("#")[0] in TRACKING_COLUMNS])


def parse_qualified(name: str) -> tuple[str, int | None]:
    """``table@snapshot`` -> (table, snapshot); no ``@`` -> (name, None)."""
    if "@" not in name:
        return name, None
    table, snap = name.split("@", 1)
    return table, int(snap)


@dataclass
class ThreeWay:
    """Two snapshots and their shared ancestor, counted row by row in one aggregation."""

    ancestor_id: int
    counts: DataFrame

    @property
    def control_changes(self) -> DataFrame:
        """The changelog from the ancestor to the control snapshot."""
        return changes(self.counts, B_N, C_N)

    @property
    def target_changes(self) -> DataFrame:
        """The changelog from the ancestor to the target snapshot."""
        return changes(self.counts, B_N, T_N)


def three_way(table: VersionedTable, control_snapshot: int, target_snapshot: int, which: str = "nearest") -> ThreeWay:
    """Both snapshots and their shared ancestor in one tagged aggregation, without change-tracking columns.

    It yields both changelogs and, without another shuffle, their diff. Raises
    ``NoSharedAncestor`` when the snapshots share no ancestor, ``SchemaMismatch`` when
    their schemas differ. Columns that cannot be grouped are compared as text.
    """
    row = common_ancestor(table.lineage, table.name, control_snapshot, target_snapshot, which).first()
    if row is None:
        raise NoSharedAncestor(
            f"no shared ancestor of {table.name}@{control_snapshot} and {table.name}@{target_snapshot}")
    versions = [drop_tracking_columns(table.at(s)) for s in (row.ancestor_id, control_snapshot, target_snapshot)]
    for other in versions[1:]:
        check_schemas(versions[0], other)
    if not groupable(versions[0]):
        versions = [stringify(v) for v in versions]
    return ThreeWay(int(row.ancestor_id), three_way_counts(*versions))


def cdc_views(table: VersionedTable, control_snapshot: int, target_snapshot: int,
              which: str = "nearest") -> tuple[DataFrame, DataFrame, int]:
    """Both changelogs since the shared ancestor, cleaned: (control, target, ancestor_id)."""
    both = three_way(table, control_snapshot, target_snapshot, which)
    return both.control_changes, both.target_changes, both.ancestor_id


def compare_snapshots(table: VersionedTable, control_snapshot: int, target_snapshot: int,
                      use_changelog: bool = True, which: str = "nearest", **compare_kw) -> Comparison:
    """Compare two snapshots: through their changelogs since the shared ancestor,
    falling back to a full compare of both snapshots when that is not possible.

    The changelogs are compared here and now, in one job that writes the rows that differ, so
    that a read that fails while it runs (an expired file of the ancestor) leads to the full
    compare too. With bag counts, the changelog diff is empty exactly when the
    snapshots are equal, and its total equals the snapshots' bag difference.
    """
    if use_changelog:
        try:
            both = three_way(table, control_snapshot, target_snapshot, which)
            return compare_changelogs(both.counts, table.name, **compare_kw).differences_only()
        except Exception as e:  # noqa: BLE001 - whatever stops the changelogs, the full compare still runs
            print(f"{table.name}: full compare instead of changelogs: {e}", file=sys.stderr)
    return compare_tables(table.at(control_snapshot), table.at(target_snapshot), table.name, **compare_kw)
