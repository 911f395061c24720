"""Dataset diff: compare two versions of a table within a float precision and a
row tolerance (D1, D5), with the row-level differences (X1-X3).

One shuffle does all of it. Both sides are tagged (control 1/0, target 0/1),
unioned and grouped by *every* column; each distinct row then carries its
count on each side:

* ``control_n > 0 and target_n = 0``  -> missing row   (control EXCEPT target)
* ``target_n > 0 and control_n = 0``  -> new row       (target EXCEPT control)
* both > 0 and different             -> duplicated a different number of times

``groupBy`` is null-safe (NULL = NULL, NaN = NaN) like ``EXCEPT``, runs partial
aggregation map-side (a row repeated a million times is combined before the
shuffle), and, unlike ``EXCEPT``, accepts map columns (key order ignored).
Every count of the result record comes from one aggregation over that table.

Modes:
* ``set`` (the contract's rule): differences = distinct missing + distinct
  new rows; only when the row counts differ a grouped check also counts rows
  whose multiplicity changed (twice: once per side) against the distinct
  control row count.
* ``bag``: differences = sum over rows of |control_n - target_n|, so
  {a, a, b} vs {a, b, b} is caught even with equal row counts.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions import count_when

C_N, T_N = "__control_n", "__target_n"
B_N = "__base_n"  # count in the version that both sides come from
UNHELD = "__unheld"  # text of the values that the precision cannot hold


class SchemaMismatch(ValueError):
    """The two sides differ in column names, order, types or nullability."""


def schema_differences(control: DataFrame, target: DataFrame) -> list[str]:
    """Field-level report; empty when ``control.schema == target.schema``."""
    a, b = control.schema, target.schema
    if a == b:
        return []
    out = []
    if a.fieldNames() != b.fieldNames():
        out.append(f"columns differ: control={a.fieldNames()} target={b.fieldNames()}")
    for fa, fb in zip(a.fields, b.fields):
        if fa.name == fb.name and fa != fb:
            out.append(f"{fa.name}: control={fa.dataType.simpleString()} nullable={fa.nullable} "
                       f"target={fb.dataType.simpleString()} nullable={fb.nullable}")
    return out or ["schemas differ in field metadata"]


def check_schemas(control: DataFrame, target: DataFrame) -> None:
    diffs = schema_differences(control, target)
    if diffs:
        raise SchemaMismatch("control schema and target schema do not match: " + "; ".join(diffs))


def _q(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def round_fractional(df: DataFrame, precision: int, keep_unheld: bool = False) -> DataFrame:
    """Every top-level float / double / decimal column -> double -> ``decimal(38, precision)``.

    Casting is ``try_cast``: NaN, infinities and overflow become NULL instead
    of failing the job. Nested fields are left as they are. With ``keep_unheld``
    the texts of these values are kept, by column, in one further column
    (NULL if a row has none), so that different ones do not compare equal.
    """
    target_type = f"decimal(38,{int(precision)})"
    cols, unheld = [], []
    for f in df.schema.fields:
        c = _q(f.name)
        if isinstance(f.dataType, T.FractionalType):
            exact = c.try_cast("double")
            c = exact.try_cast(target_type)
            unheld.append(F.when(c.isNull(), exact.cast("string")))
        cols.append(c.alias(f.name))
    if keep_unheld and unheld:
        cols.append(F.when(F.coalesce(*unheld).isNotNull(), F.to_json(F.array(*unheld))).alias(UNHELD))
    return df.select(*cols)


def _as_string(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.MapType):
        # entries sorted by key: two maps with the same entries give the same text
        return F.array_sort(F.map_entries(c)).cast("string")
    return c.cast("string")


def stringify(df: DataFrame) -> DataFrame:
    """Every column cast to string (fallback for types that cannot be grouped)."""
    return df.select(*[_as_string(_q(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def _groupable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.VariantType):
        return False
    if isinstance(dtype, (T.ArrayType,)):
        return _groupable(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _groupable(dtype.keyType) and _groupable(dtype.valueType)
    if isinstance(dtype, T.StructType):
        return all(_groupable(f.dataType) for f in dtype.fields)
    return True


def row_counts(control: DataFrame, target: DataFrame) -> DataFrame:
    """Each distinct row with its count in control and target (one shuffle)."""
    cols = [_q(c) for c in control.columns]
    tagged = control.select(*cols, F.lit(1).alias(C_N), F.lit(0).alias(T_N)).unionByName(
        target.select(*cols, F.lit(0).alias(C_N), F.lit(1).alias(T_N)))
    return tagged.groupBy(*cols).agg(F.sum(C_N).alias(C_N), F.sum(T_N).alias(T_N))


def three_way_counts(base: DataFrame, control: DataFrame, target: DataFrame) -> DataFrame:
    """Each distinct row of three versions of a table with its count in each (one shuffle)."""
    cols = [_q(c) for c in control.columns]
    marks = (B_N, C_N, T_N)
    tagged = [df.select(*cols, *[F.lit(int(m == own)).alias(m) for m in marks])
              for df, own in zip((base, control, target), marks)]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2]).groupBy(*cols).agg(*[F.sum(m).alias(m) for m in marks])


def changelog_counts(counts: DataFrame) -> DataFrame:
    """From ``three_way_counts``: each row of the control and target changelogs since the base, with
    its ``_change_type`` and its count in either changelog. Rows that neither side changed drop out."""
    data = [_q(c) for c in counts.columns if c not in (B_N, C_N, T_N)]
    none = F.lit(0).cast("bigint")
    kinds = F.array(*[F.struct(F.lit(kind).alias("kind"), F.greatest(sign * (F.col(C_N) - F.col(B_N)), none).alias("c"),
                               F.greatest(sign * (F.col(T_N) - F.col(B_N)), none).alias("t"))
                      for kind, sign in (("INSERT", F.lit(1)), ("DELETE", F.lit(-1)))])
    changed = counts.filter((F.col(C_N) != F.col(B_N)) | (F.col(T_N) != F.col(B_N)))
    rows = changed.select(*data, F.explode(kinds).alias("__x")).filter((F.col("__x.c") > 0) | (F.col("__x.t") > 0))
    return rows.select(*data, F.col("__x.kind").alias("_change_type"), F.col("__x.c").alias(C_N), F.col("__x.t").alias(T_N))


def missing_rows(counts: DataFrame) -> DataFrame:
    """Distinct rows of control that are not in target (X1)."""
    return counts.filter((F.col(C_N) > 0) & (F.col(T_N) == 0)).drop(C_N, T_N, UNHELD)


def new_rows(counts: DataFrame) -> DataFrame:
    """Distinct rows of target that are not in control (X2)."""
    return counts.filter((F.col(T_N) > 0) & (F.col(C_N) == 0)).drop(C_N, T_N, UNHELD)


def multiplicity_changes(counts: DataFrame) -> DataFrame:
    """Rows present on both sides a different number of times, with both counts."""
    return (counts.filter((F.col(C_N) > 0) & (F.col(T_N) > 0) & (F.col(C_N) != F.col(T_N))).drop(UNHELD)
            .withColumnRenamed(C_N, "control_n").withColumnRenamed(T_N, "target_n"))


def _stat_exprs() -> dict:
    c, t = F.col(C_N), F.col(T_N)
    return {
        "control_count": F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias("control_count"),
        "target_count": F.coalesce(F.sum(t), F.lit(0)).cast("bigint").alias("target_count"),
        "missing_rows_count": count_when((c > 0) & (t == 0)).alias("missing_rows_count"),
        "new_rows_count": count_when((t > 0) & (c == 0)).alias("new_rows_count"),
        "changed_multiplicity_count": count_when((c > 0) & (t > 0) & (c != t)).alias("changed_multiplicity_count"),
        "distinct_control_count": count_when(c > 0).alias("distinct_control_count"),
        "bag_differences": F.coalesce(F.sum(F.abs(c - t)), F.lit(0)).cast("bigint").alias("bag_differences"),
    }


def diff_counts(counts: DataFrame) -> DataFrame:
    """All counts of the result record in one aggregation (one row)."""
    return counts.agg(*_stat_exprs().values())


def result_record(stats: DataFrame, table_name: str, tolerance: float, mode: str = "set",
                  run_timestamp: str | None = None) -> DataFrame:
    """The per-table result record (D1 + D5) from ``diff_counts``; stays a DataFrame."""
    if mode not in ("set", "bag"):
        raise ValueError("mode must be 'set' or 'bag'")
    ts = run_timestamp or _dt.datetime.now().isoformat()
    tol = F.lit(float(tolerance))
    cc, tc = F.col("control_count"), F.col("target_count")
    miss, new = F.col("missing_rows_count"), F.col("new_rows_count")
    if mode == "set":
        total = miss + new
        threshold = tol * cc
        grouped = cc != tc
        grouped_diff = miss + new + 2 * F.col("changed_multiplicity_count")
        grouped_ok = grouped_diff.cast("double") <= tol * F.col("distinct_control_count")
        passed = (total.cast("double") <= threshold) & (~grouped | grouped_ok)
    else:
        total = F.col("bag_differences")
        threshold = tol * cc
        grouped = F.lit(None).cast("boolean")
        grouped_diff = F.lit(None).cast("bigint")
        passed = total.cast("double") <= threshold
    return stats.select(
        F.lit(table_name).alias("table_name"),
        cc.alias("control_count"), tc.alias("target_count"),
        miss.alias("missing_rows_count"), new.alias("new_rows_count"),
        total.cast("bigint").alias("total_differences"),
        tol.alias("tolerance"),
        threshold.cast("double").alias("tolerance_threshold"),
        passed.alias("passed"),
        F.lit(ts).alias("timestamp"),
        F.when(grouped, F.lit(True)).alias("grouped_comparison"),
        F.when(grouped, grouped_diff).cast("bigint").alias("grouped_differences"),
        F.lit(None).cast("string").alias("grouped_comparison_error"),
    )


@dataclass
class Comparison:
    """Lazy handles on one table comparison; nothing runs until an action."""

    table_name: str
    counts: DataFrame          # distinct rows with both counts
    tolerance: float = 0.0
    mode: str = "set"
    run_timestamp: str | None = None

    @property
    def result(self) -> DataFrame:
        """One-row result record."""
        return result_record(diff_counts(self.counts), self.table_name, self.tolerance, self.mode,
                             self.run_timestamp)

    def differences_only(self) -> "Comparison":
        """One job: the rows that differ are written to the shared checkpoint folder
        (usually a small set) while the record's counts over *all* rows are
        observed during that same write. The returned comparison's record and
        row outputs then read only that small copy."""
        from pyspark.sql import Observation

        from mercato.session import write_table

        obs = Observation()
        stats_cols = diff_counts(self.counts).columns
        observed = self.counts.observe(obs, *[_stat_exprs()[c] for c in stats_cols])
        table, _ = write_table(observed.filter(F.col(C_N) != F.col(T_N)), f"diff-{self.table_name}")
        stats = obs.get
        spark = self.counts.sparkSession
        row = spark.createDataFrame([tuple(int(stats[c]) for c in stats_cols)],
                                    ", ".join(f"{c} bigint" for c in stats_cols))
        return Observed(self.table_name, table, self.tolerance, self.mode, self.run_timestamp, row)

    @property
    def missing(self) -> DataFrame:
        return missing_rows(self.counts)

    @property
    def new(self) -> DataFrame:
        return new_rows(self.counts)

    @property
    def changed(self) -> DataFrame:
        return multiplicity_changes(self.counts)


@dataclass
class Observed(Comparison):
    """A comparison whose ``counts`` hold only the differing rows and whose
    record comes from statistics observed over all rows."""

    stats: DataFrame | None = None

    def differences_only(self) -> "Comparison":
        return self

    @property
    def result(self) -> DataFrame:
        return result_record(self.stats, self.table_name, self.tolerance, self.mode, self.run_timestamp)


def compare_tables(control: DataFrame, target: DataFrame, table_name: str = "unknown",
                   precision: int | None = None, tolerance: float = 0.0, mode: str = "set",
                   run_timestamp: str | None = None) -> Comparison:
    """Compare two versions of a table (D1).

    Raises ``SchemaMismatch`` when the schemas differ (names, order, types,
    nullability). With ``precision`` every fractional column is rounded
    first; values that it cannot hold (NaN, infinities, overflow) are compared
    by their own text, and are NULL in the row outputs. Columns that cannot be
    grouped are compared as text.
    """
    check_schemas(control, target)
    if precision is not None:
        control, target = (round_fractional(side, precision, keep_unheld=True) for side in (control, target))
    if not groupable(control):
        control, target = stringify(control), stringify(target)
    if mode not in ("set", "bag"):
        raise ValueError("mode must be 'set' or 'bag'")
    return Comparison(table_name, row_counts(control, target), tolerance, mode,
                      run_timestamp or _dt.datetime.now().isoformat())


def compare_changelogs(counts: DataFrame, table_name: str = "unknown", precision: int | None = None, tolerance: float = 0.0,
                       mode: str = "set", run_timestamp: str | None = None) -> Comparison:
    """Compare the control and target changelogs held by ``three_way_counts``, as ``compare_tables`` would.

    Their rows carry ``_change_type``. Nothing is shuffled again, but with ``precision``: then
    the changed rows are rounded and counted once more.
    """
    if mode not in ("set", "bag"):
        raise ValueError("mode must be 'set' or 'bag'")
    rows = changelog_counts(counts)
    if precision is not None:
        rows = round_fractional(rows, precision, keep_unheld=True)
        rows = rows.groupBy(*[_q(c) for c in rows.columns if c not in (C_N, T_N)]).agg(F.sum(C_N).alias(C_N), F.sum(T_N).alias(T_N))
    return Comparison(table_name, rows, tolerance, mode, run_timestamp or _dt.datetime.now().isoformat())


def groupable(df: DataFrame) -> bool:
    """Whether every column has a type that rows can be grouped by."""
    return all(_groupable(f.dataType) for f in df.schema.fields)


DEFAULT_CHUNK = 10_000


def replicate_rows(df: DataFrame, copies: str, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Each row repeated ``copies`` times (bag semantics), with bounded work per task.

    Rows needing at most ``chunk`` copies are expanded where they are. A row
    needing more (one row that holds a large share of a table) is first cut
    into chunks of at most ``chunk`` copies; the chunks are hash-spread over
    the cluster and expanded there, so no task emits more than its share.
    Both branches read the same aggregated input (its exchange is reused).
    """
    n = F.col(copies)
    data = [c for c in df.columns if c != copies]
    small = (df.filter((n > 0) & (n <= chunk))
             .select(*[_q(c) for c in data], F.explode(F.sequence(F.lit(1), n.cast("int"))).alias("__i"))
             .drop("__i"))
    big = df.filter(n > chunk)
    chunks = big.select(*[_q(c) for c in data], n.alias("__n"),
                        F.explode(F.sequence(F.lit(0), ((n - 1) / chunk).cast("int"))).alias("__chunk"))
    sizes = F.least(F.lit(chunk), F.col("__n") - F.col("__chunk") * chunk).cast("int")
    # an explicit number keeps AQE from merging the chunk rows, which are small until expanded;
    # the data columns are no keys, as maps cannot be hashed
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = (chunks.repartition(parts, F.col("__chunk"), F.col("__n"))
              .select(*[_q(c) for c in data], F.explode(F.sequence(F.lit(1), sizes)).alias("__i"))
              .drop("__i"))
    return small.unionByName(spread)


def bag_changes(start: DataFrame, end: DataFrame, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """``end EXCEPT ALL start`` tagged INSERT plus ``start EXCEPT ALL end`` tagged
    DELETE, from one aggregation of both sides."""
    return changes(row_counts(start, end), C_N, T_N, chunk)


def changes(counts: DataFrame, start: str, end: str, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """The changelog from one counted version to another: rows with ``_change_type``, each as often as it changed."""
    delta = F.col(end) - F.col(start)
    tagged = counts.filter(delta != 0).select(
        *[_q(c) for c in counts.columns if c not in (B_N, C_N, T_N)],
        F.when(delta > 0, F.lit("INSERT")).otherwise(F.lit("DELETE")).alias("_change_type"),
        F.abs(delta).alias("__copies"))
    return replicate_rows(tagged, "__copies", chunk)


def sample_rows(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows for display (the job shows them untruncated)."""
    return df.limit(n)
