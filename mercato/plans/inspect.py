"""Plan inspection helpers (used by the tests and the benchmark notes)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as text, with scan metadata (pushed filters, read schema) untruncated."""
    spark = df.sparkSession
    key = "spark.sql.maxMetadataStringLength"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "100000")
    try:
        return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def count_exchanges(df: DataFrame) -> int:
    """Number of shuffle exchanges in the (pre-AQE) physical plan."""
    return plan_text(df, "simple").count("Exchange ")


def has_python_udf(df: DataFrame) -> bool:
    text = plan_text(df, "simple")
    return any(n in text for n in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                                   "MapInPandas", "PythonUDF"))
