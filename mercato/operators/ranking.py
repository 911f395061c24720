"""Exact row_number / ntile over a whole table (or large partitions) without
pulling every row into one task.

A plain ``row_number().over(Window.orderBy(...))`` plans an
``Exchange SinglePartition``: one task sorts the whole input. Two ways avoid it:

* ``add_ranks`` gives every row its rank. Spark's range partitioner places the
  rows by the full sort key, each range is sorted in its task, and a small
  table of counts per range gives the offsets. One plan for every size.
* ``add_tiles`` and ``ranks_of`` need no sort or shuffle of the table. They find
  the few keys that matter (the last key of each tile, the rows whose rank is
  wanted) and compare every row with those in generated code.

The key includes the tie-break columns, so even a value that holds a third of
all rows is split. Any type that Spark can order is accepted, in both
directions.
"""

from __future__ import annotations

import datetime as dt
import functools
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.session import cut_lineage

DEFAULT_ROWS_PER_BUCKET = 250_000   # rows a task sorts
MAX_RANGES = 100_000                # tasks of one shuffle; beyond it tasks take more rows and their sorts spill
BOUNDS = 31                         # keys that cut a bracket, or a set of rows, into cells
BOUND_SAMPLE = 16                   # sampled keys per bound
_POSITION_BITS = 33                 # monotonically_increasing_id: partition index above, row index below


@dataclass(frozen=True)
class RankSpec:
    """One ranking column.

    ``order``: ``[(column, ascending), ...]``; ``tiebreak``: columns appended
    ascending so the order is total (pass the grain keys). ``ntile``: when set,
    the output is ``ntile(ntile)`` instead of ``row_number``.
    Nulls sort like Spark's defaults: first when ascending, last when descending.
    """

    out: str
    order: tuple[tuple[str, bool], ...]
    partition_by: tuple[str, ...] = ()
    tiebreak: tuple[str, ...] = ()
    ntile: int | None = None

    def sort_keys(self) -> list[tuple[str, bool]]:
        return list(self.order) + [(c, True) for c in self.tiebreak]


def _window_order(spec: RankSpec) -> list[Column]:
    return [F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last()
            for c, asc in spec.sort_keys()]


def _tile(rn: Column, n: Column, k: int) -> Column:
    """ntile(k) of row ``rn`` (1-based) among ``n`` rows: the first n mod k tiles get one extra row."""
    q = F.floor(n / k).cast("bigint")
    r = (n - q * k).cast("bigint")
    big = r * (q + 1)
    first = F.floor((rn - 1) / (q + 1)).cast("bigint") + 1
    rest = r + F.floor((rn - 1 - big) / F.greatest(q, F.lit(1))).cast("bigint") + 1
    return F.when(rn <= big, first).otherwise(rest).cast("int")


# ---------------------------------------------------------- a rank per row
def add_ranks(df: DataFrame, specs: list[RankSpec], n_rows: int | None = None,
              rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> DataFrame:
    """Add one ``row_number`` / ``ntile`` column per spec, exact and distributed.

    ``df`` is read once for its sample of keys and once for its rows; it is
    counted first unless ``n_rows`` is given.
    """
    if not specs:
        return df
    n = df.count() if n_rows is None else n_rows
    ranges = min(MAX_RANGES, max(1, math.ceil(n / max(1, rows_per_bucket))))
    for spec in specs:
        df = _rank_by_ranges(df, spec, ranges)
    return df


def _rank_by_ranges(df: DataFrame, spec: RankSpec, ranges: int) -> DataFrame:
    """One ranking column through ``repartitionByRange``.

    Every row's position in its task is the low bits of
    ``monotonically_increasing_id``. The placed rows are written to the shared
    checkpoint folder, so positions and counts are read from the same
    placement. The counts per (partition value, task) have at most
    (#ranges + #partition values) rows.
    """
    order = [F.col(c).asc_nulls_first() for c in spec.partition_by] + _window_order(spec)
    placed = (df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
              .withColumn("__t", F.spark_partition_id())
              .withColumn("__pos", F.monotonically_increasing_id().bitwiseAND((1 << _POSITION_BITS) - 1)))
    placed = cut_lineage(placed)
    pk = ["__pk"] if spec.partition_by else []
    if pk:
        placed = placed.withColumn("__pk", F.struct(*spec.partition_by))
    counts = placed.groupBy(*pk, "__t").agg(F.count(F.lit(1)).alias("__c"), F.min("__pos").alias("__first"))
    before = Window.partitionBy(*pk).orderBy("__t").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*pk, "__t", "__first",
                           F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__off"),
                           F.sum("__c").over(Window.partitionBy(*pk)).alias("__n"))
    if not pk:
        counts = F.broadcast(counts)  # at most MAX_RANGES rows of four numbers
    rn = F.col("__pos") - F.col("__first") + 1 + F.col("__off")
    value = _tile(rn, F.col("__n"), spec.ntile) if spec.ntile else rn.cast("long")
    return (placed.join(counts, on=[*pk, "__t"]).withColumn(spec.out, value)
            .drop("__t", "__pos", "__first", "__off", "__n", *pk))


def row_number_over(df: DataFrame, out: str, order: list[tuple[str, bool]], partition_by=(),
                    tiebreak=(), **kw) -> DataFrame:
    return add_ranks(df, [RankSpec(out, tuple(order), tuple(partition_by), tuple(tiebreak))], **kw)


def ntile_over(df: DataFrame, out: str, k: int, order: list[tuple[str, bool]], partition_by=(),
               tiebreak=(), **kw) -> DataFrame:
    return add_ranks(df, [RankSpec(out, tuple(order), tuple(partition_by), tuple(tiebreak), k)], **kw)


def top_k_per_group(df: DataFrame, k: int, group_by: list[str], order: list[tuple[str, bool]],
                    tiebreak=(), rank_col: str = "rank_in_group") -> DataFrame:
    """Rows ranked 1..k inside each group.

    Spark keeps only each task's first k rows of a group before the shuffle
    (WindowGroupLimit), so a group's window sees at most k rows per task.
    """
    w = Window.partitionBy(*group_by).orderBy(*_window_order(RankSpec(rank_col, tuple(order), (), tuple(tiebreak))))
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k) \
        .withColumn(rank_col, F.col(rank_col).cast("long"))


# ------------------------------------------------- ranks by comparing keys
# A key is the tuple of a row's sort values. Keys that cut the table are read to the driver, at most
# BOUNDS * BOUND_SAMPLE of a bracket at a time, and compared as literals of one SQL expression.
Key = tuple


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(value, dtype: T.DataType) -> str:
    """The value as a SQL literal of the type."""
    kind = dtype.simpleString()
    if value is None:
        return f"CAST(NULL AS {kind})"
    if isinstance(dtype, T.StructType):
        return "named_struct(" + ", ".join(f"CAST(X'{f.name.encode().hex()}' AS STRING), {_literal(v, f.dataType)}"
                                           for v, f in zip(value, dtype.fields)) + ")"
    if isinstance(dtype, T.ArrayType):
        return f"CAST(array({', '.join(_literal(v, dtype.elementType) for v in value)}) AS {kind})"
    if isinstance(value, str):
        return f"CAST(X'{value.encode().hex()}' AS STRING)"
    if isinstance(value, (bytes, bytearray)):
        return f"X'{value.hex()}'"
    if isinstance(dtype, T.TimestampType):  # collected in the local time zone
        return f"timestamp_micros({int(value.timestamp()) * 1_000_000 + value.microsecond})"
    text = value.isoformat(" ") if isinstance(value, dt.datetime) else str(value)
    return f"CAST('{text}' AS {kind})"


def _before(a: list[str], b: list[str], spec: RankSpec) -> str:
    """Whether the key of fields ``a`` sorts before that of fields ``b``, as SQL.

    NULL is lowest, and Spark's own order puts NaN highest; a descending field is the ascending order reversed.
    """
    out = "false"
    for x, y, (_, asc) in reversed(list(zip(a, b, spec.sort_keys()))):
        low, high = (x, y) if asc else (y, x)
        out = f"(coalesce({low} < {high}, {low} IS NULL AND {high} IS NOT NULL) OR ({x} <=> {y} AND {out}))"
    return out


def _row_key(spec: RankSpec) -> list[str]:
    return [_quoted(c) for c, _ in spec.sort_keys()]


def _literal_key(key: Key, spec: RankSpec, schema: T.StructType) -> list[str]:
    return [_literal(v, schema[c].dataType) for v, (c, _) in zip(key, spec.sort_keys())]


def _compare(a, b) -> int:
    """Spark's ascending order of two collected values."""
    if a is None or b is None:
        return (a is not None) - (b is not None)
    if isinstance(a, (tuple, list)):
        return next((c for c in map(_compare, a, b) if c), len(a) - len(b))
    if a != a or b != b:
        return (a != a) - (b != b)
    return (a > b) - (a < b)


def _sorted_keys(keys: list[Key], spec: RankSpec) -> list[Key]:
    def compare(a: Key, b: Key) -> int:
        return next((c if asc else -c for x, y, (_, asc) in zip(a, b, spec.sort_keys()) if (c := _compare(x, y))), 0)
    ordered = sorted(keys, key=functools.cmp_to_key(compare))
    return [k for i, k in enumerate(ordered) if i == 0 or compare(ordered[i - 1], k)]


def _spread(keys: list, n: int) -> list:
    """n of the sorted keys, evenly spread."""
    return keys if len(keys) <= n else [keys[(i + 1) * len(keys) // (n + 1)] for i in range(n)]


def _cell(bounds: list[Key], spec: RankSpec, schema: T.StructType) -> str:
    """How many of the sorted bounds sort strictly before the row: a decision tree of plain comparisons, as SQL."""
    def tree(i: int, j: int) -> str:
        if i == j:
            return str(i)
        mid = (i + j) // 2
        passed = _before(_literal_key(bounds[mid], spec, schema), _row_key(spec), spec)
        return f"CASE WHEN {passed} THEN {tree(mid + 1, j)} ELSE {tree(i, mid)} END"
    return tree(0, len(bounds))


@dataclass
class _Bracket:
    """Rows after the key ``low`` up to the key ``high`` (None: no limit) of one spec, with the cut ranks among them."""

    spec: RankSpec
    low: Key | None
    high: Key | None
    start: int          # rows before the bracket
    size: int
    ranks: list[int]

    def inside(self, schema: T.StructType) -> str:
        row, out = _row_key(self.spec), ["true"]
        if self.low is not None:
            out.append(_before(_literal_key(self.low, self.spec, schema), row, self.spec))
        if self.high is not None:
            out.append("NOT " + _before(_literal_key(self.high, self.spec, schema), row, self.spec))
        return " AND ".join(out)

    def split(self, bounds: list[Key], sizes: dict[int, int]) -> list["_Bracket"]:
        """The cells that hold a cut rank; cell c ends with bounds[c]."""
        edges, start, out = [self.low, *bounds, self.high], self.start, []
        for c in range(len(bounds) + 1):
            end = start + sizes.get(c, 0)
            if held := [r for r in self.ranks if start < r <= end]:
                out.append(_Bracket(self.spec, edges[c], edges[c + 1], start, end - start, held))
            start = end
        return out


def _cut_ranks(n: int, k: int) -> list[int]:
    """Rank of the last row of each of the first k - 1 of k tiles over n rows (0: the tile is empty)."""
    q, extra = divmod(n, k)
    return [t * q + min(t, extra) for t in range(1, k)]


def _keys_of(df: DataFrame, at: int, bracket: _Bracket, which: Column) -> DataFrame:
    names = [c for c, _ in bracket.spec.sort_keys()]
    return df.select(F.lit(at).alias("__b"), which.alias("__w"), *[F.col(c).alias(f"__k{at}_{i}") for i, c in enumerate(names)])


def _read_keys(parts: list[DataFrame], specs: list[RankSpec]) -> list[list[tuple[int, Key]]]:
    """(which, key) rows of each part, collected in one job."""
    found: list[list] = [[] for _ in parts]
    for row in functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).collect():
        found[row["__b"]].append((row["__w"], tuple(row[f"__k{row['__b']}_{i}"] for i in range(len(specs[row["__b"]].sort_keys())))))
    return found


def _narrowed(df: DataFrame, brackets: list[_Bracket], seed: int) -> list[_Bracket]:
    """One round: bounded samples of the brackets cut them into cells, one pass counts the rows of all cells."""
    schema = df.schema
    drawn = _read_keys([_keys_of(df.filter(b.inside(schema)).sample(False, min(1.0, BOUNDS * BOUND_SAMPLE / b.size), seed),
                                 at, b, F.lit(0)) for at, b in enumerate(brackets)], [b.spec for b in brackets])
    bounds = [_spread(_sorted_keys([key for _, key in keys], b.spec), BOUNDS) for keys, b in zip(drawn, brackets)]
    cells = F.array(*[F.expr(f"CASE WHEN {b.inside(schema)} THEN named_struct('b', {at}, 'c', {_cell(own, b.spec, schema)}) END")
                      for at, (b, own) in enumerate(zip(brackets, bounds))])
    sizes: dict[int, dict[int, int]] = {}
    for row in (df.select(F.explode(cells).alias("x")).filter("x IS NOT NULL").groupBy("x.b", "x.c").count().collect()):
        sizes.setdefault(row.b, {})[row.c] = row["count"]
    return [part for at, (b, own) in enumerate(zip(brackets, bounds)) for part in b.split(own, sizes.get(at, {}))]


def _bounded_brackets(df: DataFrame, specs: list[RankSpec], n: int, rows_per_task: int, seed: int) -> list[_Bracket]:
    """Brackets of at most ``rows_per_task`` rows that hold the cut ranks of each spec.

    Too large ones are narrowed again and again, those of all specs in the same passes.
    """
    brackets = [_Bracket(spec, None, None, 0, n, [r for r in _cut_ranks(n, spec.ntile) if r]) for spec in specs]
    done: list[_Bracket] = []
    while brackets:
        done += [b for b in brackets if b.size <= rows_per_task and b.ranks]
        brackets = [b for b in brackets if b.size > rows_per_task and b.ranks]
        if brackets:
            seed += 1
            brackets = _narrowed(df, brackets, seed)
    return done


def _cut_keys(df: DataFrame, specs: list[RankSpec], n: int, rows_per_task: int, seed: int) -> list[list[Key]]:
    """The keys at the cut ranks of each spec: each bracket is sorted in a task of its own."""
    done = _bounded_brackets(df, specs, n, rows_per_task, seed)
    if not done:
        return [[] for _ in specs]
    parts = []
    for at, b in enumerate(done):
        keys = _keys_of(df.filter(b.inside(df.schema)), at, b, F.row_number().over(Window.partitionBy(F.lit(at)).orderBy(*_window_order(b.spec))))
        parts.append(keys.filter(F.col("__w").isin([r - b.start for r in b.ranks])))
    found: dict[int, list] = {}
    for b, keys in zip(done, _read_keys(parts, [b.spec for b in done])):
        found.setdefault(id(b.spec), []).extend((w + b.start, key) for w, key in keys)
    return [[key for _, key in sorted(found.get(id(spec), []), key=lambda x: x[0])] for spec in specs]


def add_tiles(df: DataFrame, specs: list[RankSpec], n_rows: int, seed: int = 17,
              rows_per_task: int = DEFAULT_ROWS_PER_BUCKET) -> DataFrame:
    """Add ``ntile(spec.ntile)`` over the whole table per spec, without sorting or shuffling it.

    ``df`` must be materialised (a checkpoint or a written table) with
    ``n_rows`` rows, and each spec's keys must be unique. Partitioned ntiles
    go through ``add_ranks``. No task sorts more than ``rows_per_task`` rows.
    """
    for spec in specs:
        if spec.partition_by or not spec.ntile:
            raise ValueError(f"{spec.out}: add_tiles is for ntiles over the whole table")
    cuts = _cut_keys(df, specs, n_rows, rows_per_task, seed)
    return df.withColumns({spec.out: (F.expr(_cell(keys, spec, df.schema)) + 1).cast("int") for spec, keys in zip(specs, cuts)})


def ranks_of(rows: DataFrame, df: DataFrame, spec: RankSpec, within: str,
             within_out: str) -> DataFrame:
    """Add to ``rows``, some rows of ``df``, their row_number in ``df`` (``spec.out``) and among
    the rows of ``df`` with the same ``within`` (``within_out``).

    Up to BOUNDS keys of ``rows`` cut the table into cells. One pass counts the rows of each cell and
    ``within``; only inside its own cell is a row of ``rows`` compared with rows of ``df``, by a
    join on the cell. So nothing but counts and the rows up to the last one wanted is shuffled.
    Both inputs must be materialised, keys unique.
    """
    fields = [c for c, _ in spec.sort_keys()]
    some = rows.select(*fields).orderBy(F.xxhash64(*fields)).limit(BOUNDS * BOUND_SAMPLE)
    last = rows.select(*fields).orderBy(*[o for o in _reversed_order(spec)]).limit(1)
    keys = _sorted_keys([tuple(r) for r in some.unionByName(last).collect()], spec)
    if not keys:
        return rows.withColumns({spec.out: F.lit(None).cast("long"), within_out: F.lit(None).cast("long")})
    bounds = [*_spread(keys[:-1], BOUNDS - 1), keys[-1]]
    cell = F.expr(_cell(bounds, spec, df.schema))
    early = df.select(*[F.col(c).alias(f"__x{i}") for i, c in enumerate(fields)], F.col(within).alias("__w"), cell.alias("__cell"))
    early = early.filter(F.col("__cell") < len(bounds))  # nothing after the last key matters
    counts = early.groupBy("__w", "__cell").agg(F.count(F.lit(1)).alias("__c"))

    def earlier(window) -> Column:
        return F.coalesce(F.sum("__c").over(window.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    local = counts.select(F.struct("__w").alias("__w"), "__cell", earlier(Window.partitionBy("__w")).alias("__local"))
    total = counts.groupBy("__cell").agg(F.sum("__c").alias("__c"))  # at most BOUNDS rows
    total = total.select("__cell", earlier(Window.partitionBy()).alias("__total"))
    placed = rows.withColumn("__cell", cell)
    after = F.expr(_before(_row_key(spec), [f"__x{i}" for i in range(len(fields))], spec))
    inside = (placed.join(early, "__cell").filter(~after).groupBy(*[F.col(f"`{c}`") for c in rows.columns], "__cell")
              .agg(F.count(F.lit(1)).alias("__o"), F.count_if(F.col("__w").eqNullSafe(F.col(within))).alias("__in")))
    return (inside.withColumn("__w", F.struct(F.col(within).alias("__w"))).join(total, "__cell").join(local, ["__w", "__cell"])
            .withColumns({spec.out: F.col("__total") + F.col("__o"), within_out: F.col("__local") + F.col("__in")})
            .select(*[F.col(f"`{c}`") for c in rows.columns], within_out, spec.out))


def _reversed_order(spec: RankSpec) -> list[Column]:
    return [F.col(c).desc_nulls_last() if asc else F.col(c).asc_nulls_first() for c, asc in spec.sort_keys()]
