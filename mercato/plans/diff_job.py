"""Diff job (D2-D4, E2-E4, K2, K3, K5): compare many tables, summarise, write.

Table pairs come from two root folders (``{root}/{table}`` in any Spark
format), from catalog names, or from ``table@snapshot`` names of versioned
tables (compared through their changelogs since the shared ancestor, with a
full compare as the fallback). Every table's result is a one-row DataFrame;
the results are unioned and the summary is one aggregation over them. A
failing table never stops the others: all results and the summary are
written first, then the job reports failure.

    python -m mercato.plans.diff_job --tables t1 t2 --format parquet \
        --control-root ROOT_A --target-root ROOT_B [--compare-precision 2] \
        [--row-diff-tolerance 0.0] [--mode set|bag] [--output-path OUT]
    python -m mercato.plans.diff_job --control-tables db.t1 --target-tables db2.t1 ...
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.operators.diff import Comparison, compare_tables, sample_rows
from mercato.schemas import DIFF_RESULT_SCHEMA
from mercato.session import publish, written_tables
from mercato.sources.files import read_catalog_table, read_table_pair
from mercato.sources.snapshots import VersionedTable, compare_snapshots, parse_qualified


def _now() -> str:
    return dt.datetime.now().isoformat()


@dataclass
class FailedComparison:
    """A table that could not be compared: its record carries the error."""

    spark: SparkSession
    table_name: str
    error: str
    tolerance: float
    run_timestamp: str

    @property
    def result(self) -> DataFrame:
        row = (self.table_name, 0, 0, 0, 0, 0, float(self.tolerance), 0.0, False, self.run_timestamp, None, None, self.error)
        return self.spark.createDataFrame([row], DIFF_RESULT_SCHEMA)


def _guarded(spark: SparkSession, name: str, keep_going: bool, ts: str, tolerance: float, build):
    """The comparison that ``build`` makes, or with ``keep_going`` a failed record."""
    try:
        return build()
    except Exception as e:  # noqa: BLE001 - one bad table must not lose the others' results
        if not keep_going:
            raise
        return FailedComparison(spark, name, f"{type(e).__name__}: {e}", tolerance, ts)


def _each(spark: SparkSession, tasks: list, threads: int) -> list:
    """Results of the tasks, in order; up to ``threads`` run at once, each in a scheduler pool of its own,
    so that with fair scheduling a small table does not wait for a large one."""
    if threads <= 1 or len(tasks) <= 1:
        return [task() for task in tasks]

    def pooled(number: int):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"compare-{number % threads}")
        try:
            return tasks[number]()
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(min(threads, len(tasks))) as pool:
        return list(pool.map(pooled, range(len(tasks))))


def _compare_all(spark: SparkSession, named: list, run: bool, threads: int, keep_going: bool, ts: str, tolerance: float) -> list:
    """The comparisons of (name, build) pairs; with ``run`` each one's aggregation runs here too, many at a time."""
    def task(name, build):
        return lambda: _guarded(spark, name, keep_going, ts, tolerance, lambda: build().differences_only() if run else build())
    return _each(spark, [task(name, build) for name, build in named], threads)


def compare_directories(spark: SparkSession, tables: list[str], control_root: str, target_root: str,
                        fmt: str = "parquet", csv_options: dict | None = None,
                        run_timestamp: str | None = None, keep_going: bool = False, run: bool = False, threads: int = 1,
                        **compare_kw) -> list[Comparison | FailedComparison]:
    """Directory mode (D3): ``{control_root}/{t}`` vs ``{target_root}/{t}`` for each table.

    With ``run`` the comparisons are carried out here, up to ``threads`` at a time. With
    ``keep_going`` a table that cannot be compared becomes a failed record.
    """
    ts = run_timestamp or _now()

    def one(t: str) -> Comparison:
        control, target = read_table_pair(spark, t, control_root, target_root, fmt, **(csv_options or {}))
        return compare_tables(control, target, t, run_timestamp=ts, **compare_kw)

    return _compare_all(spark, [(t, lambda t=t: one(t)) for t in tables], run, threads, keep_going, ts,
                        compare_kw.get("tolerance", 0.0))


def compare_catalog_pairs(spark: SparkSession, pairs: list[tuple[str, str]],
                          versioned: dict[str, VersionedTable] | None = None,
                          run_timestamp: str | None = None, which_ancestor: str = "nearest",
                          keep_going: bool = False, run: bool = False, threads: int = 1,
                          **compare_kw) -> list[Comparison | FailedComparison]:
    """Catalog mode (D2): each (control, target) name pair; ``table@snapshot`` names
    are looked up in ``versioned`` and compared through their changelogs, or else read by
    the catalog's ``snapshot-id`` option and compared in full. ``run``, ``threads`` and
    ``keep_going`` as in ``compare_directories``."""
    ts = run_timestamp or _now()

    def one(ctrl_name: str, target_name: str) -> Comparison:
        c_table, c_snap = parse_qualified(ctrl_name)
        t_table, t_snap = parse_qualified(target_name)
        if c_snap is not None or t_snap is not None:
            if c_snap is None or t_snap is None:
                raise ValueError(f"both names need a snapshot: {ctrl_name}, {target_name}")
            if c_table != t_table:
                raise ValueError(f"{c_table} and {t_table} are not the same table")
            if versioned and c_table in versioned:
                return compare_snapshots(versioned[c_table], c_snap, t_snap, which=which_ancestor,
                                         run_timestamp=ts, **compare_kw)
            control, target = (spark.read.option("snapshot-id", s).table(c_table) for s in (c_snap, t_snap))
            return compare_tables(control, target, c_table, run_timestamp=ts, **compare_kw)
        return compare_tables(read_catalog_table(spark, ctrl_name), read_catalog_table(spark, target_name),
                              ctrl_name, run_timestamp=ts, **compare_kw)

    return _compare_all(spark, [(c, lambda c=c, t=t: one(c, t)) for c, t in pairs], run, threads, keep_going, ts,
                        compare_kw.get("tolerance", 0.0))


def results_frame(comparisons: list[Comparison]) -> DataFrame:
    """All result records as one DataFrame (one row per table)."""
    return reduce(DataFrame.unionByName, [c.result for c in comparisons])


def _summary_columns(tolerance: float, control_root: str | None = None, run_timestamp: str | None = None) -> list:
    return [
        F.lit(run_timestamp or _now()).alias("comparison_timestamp"),
        F.count(F.lit(1)).alias("total_tables"),
        F.count_if(F.col("passed")).cast("bigint").alias("passed_tables"),
        F.count_if(~F.col("passed")).cast("bigint").alias("failed_tables"),
        F.lit(control_root or "N/A").alias("control_root"),
        F.lit(float(tolerance)).alias("tolerance"),
    ]


def run_summary(results: DataFrame, tolerance: float, control_root: str | None = None,
                run_timestamp: str | None = None) -> DataFrame:
    """D4 as one row: totals of passed / failed tables of one run and the nested ``results`` array (one
    struct per compared table, by name; the run's table list is user-given, so the array is bounded by it)."""
    return results.agg(*_summary_columns(tolerance, control_root, run_timestamp),
                       F.sort_array(F.collect_list(F.struct(*results.columns))).alias("results"))


def write_differences(comparison: Comparison, output_path: str) -> dict:
    """K2: missing / new rows of one table under ``output_path`` (only when non-empty).

    CSV when every column is atomic, parquet otherwise. Written in parallel:
    one file per task, no single-file funnel. A failed write is reported and
    does not stop the run.
    """
    stamp = dt.datetime.now().strftime("%Y%m%d_%H%M%S")
    root, name = output_path.rstrip("/"), comparison.table_name
    rec = comparison.result.first()
    written = {}
    for kind, df, n in (("missing_rows", comparison.missing, rec.missing_rows_count),
                        ("new_rows", comparison.new, rec.new_rows_count)):
        if not n:
            continue
        atomic = _atomic(df)
        path = f"{root}/{name}_{stamp}_{kind}.{'csv' if atomic else 'parquet'}"
        staged = f"{root}/_staging-{uuid.uuid4().hex}"
        try:
            (df.write.option("header", "true").csv(staged) if atomic else df.write.parquet(staged))
            publish(df.sparkSession, {path: staged})
            written[kind] = path
        except Exception as e:  # noqa: BLE001 - reported, the run goes on
            written[kind] = f"error: {e}"
    return written


def _atomic(df: DataFrame) -> bool:
    from pyspark.sql import types as T
    return all(not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) for f in df.schema.fields)


def write_summary(summary_doc: DataFrame, output_path: str) -> str:
    """K3: the run summary as JSON (one small record -> one file)."""
    stamp = dt.datetime.now().strftime("%Y%m%d_%H%M%S")
    root = output_path.rstrip("/")
    path, staged = f"{root}/comparison_summary_{stamp}.json", f"{root}/_staging-{uuid.uuid4().hex}"
    summary_doc.coalesce(1).write.json(staged)
    publish(summary_doc.sparkSession, {path: staged})
    return path


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Compare two versions of a set of tables.")
    p.add_argument("--tables", nargs="+")
    p.add_argument("--format", default="parquet")
    p.add_argument("--control-root")
    p.add_argument("--target-root")
    p.add_argument("--control-tables", nargs="+")
    p.add_argument("--target-tables", nargs="+")
    p.add_argument("--compare-precision", type=int)
    p.add_argument("--row-diff-tolerance", type=float, default=0.0)
    p.add_argument("--mode", choices=["set", "bag"], default="set")
    p.add_argument("--csv-header", choices=["true", "false"], default="true")
    p.add_argument("--csv-infer-schema", choices=["true", "false"], default="true")
    p.add_argument("--csv-delimiter", default=",")
    p.add_argument("--output-path")
    p.add_argument("--parallel-tables", type=int, default=8)
    return p


def validate_args(p: argparse.ArgumentParser, args: argparse.Namespace) -> None:
    if args.control_root is None and args.control_tables is None:
        p.error("either --control-root or --control-tables must be given")
    if args.control_root is not None and (args.tables is None or args.target_root is None):
        p.error("--control-root needs --tables and --target-root")
    if args.control_tables is not None:
        if args.target_tables is None:
            p.error("--control-tables needs --target-tables")
        if len(args.control_tables) != len(args.target_tables):
            p.error("the number of control and target tables must match")


def main(argv: list[str] | None = None, spark: SparkSession | None = None,
         versioned: dict[str, VersionedTable] | None = None) -> int:
    from mercato.session import get_session

    p = _parser()
    args = p.parse_args(argv)
    validate_args(p, args)
    spark = spark or get_session(app_name="mercato-diff", extra={"spark.scheduler.mode": "FAIR"})
    with written_tables(spark):
        return _run(spark, args, versioned)


def _run(spark: SparkSession, args: argparse.Namespace, versioned: dict[str, VersionedTable] | None) -> int:
    ts = _now()
    # One aggregation per table, several tables at once: the differing rows are written (with the
    # record's counts observed in the same job); record, samples and output files then read that small copy.
    kw = dict(precision=args.compare_precision, tolerance=args.row_diff_tolerance, mode=args.mode, run_timestamp=ts,
              keep_going=True, run=True, threads=args.parallel_tables)
    if args.control_root is not None:
        csv = dict(csv_header=args.csv_header == "true", csv_infer_schema=args.csv_infer_schema == "true",
                   csv_delimiter=args.csv_delimiter)
        comps = compare_directories(spark, args.tables, args.control_root, args.target_root, args.format, csv, **kw)
    else:
        comps = compare_catalog_pairs(spark, list(zip(args.control_tables, args.target_tables)), versioned, **kw)
    results = results_frame(comps).cache()  # a handful of rows, read by summary and writes
    for row in results.collect():
        print(f"{row.table_name}: control={row.control_count} target={row.target_count} "
              f"missing={row.missing_rows_count} new={row.new_rows_count} passed={row.passed}"
              + (f" error={row.grouped_comparison_error}" if row.grouped_comparison_error else ""),
              file=sys.stderr)
    compared = [c for c in comps if not isinstance(c, FailedComparison)]
    unwritten = 0
    for c in compared:                      # K5: a few differing rows, untruncated
        for label, df in (("new", c.new), ("missing", c.missing)):
            rows = sample_rows(df).collect()
            if rows:
                print(f"{c.table_name}: first {len(rows)} {label} rows", file=sys.stderr)
                for r in rows:
                    print(f"  {tuple(r)}", file=sys.stderr)
    failed = results.filter(~F.col("passed")).count()
    if args.output_path:
        for c in compared:
            for kind, path in write_differences(c, args.output_path).items():
                unwritten += path.startswith("error: ")
                print(f"{c.table_name} {kind}: {path}", file=sys.stderr)
        doc = run_summary(results, tolerance=args.row_diff_tolerance, control_root=args.control_root, run_timestamp=ts)
        print(f"summary: {write_summary(doc, args.output_path)}", file=sys.stderr)
    return 1 if failed or unwritten else 0


if __name__ == "__main__":
    sys.exit(main())
