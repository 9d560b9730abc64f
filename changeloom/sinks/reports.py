"""Report files: ``<root>/<report>/<yyyymmdd_hhmmss>``, one folder per report and flush.

A report is written as one JSON line per row, whatever its length.  The single JSON object with a ``data`` map is for
reports that are short by definition (top lists, order status, summary); the caller asks for it.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

def report_object(report: DataFrame, key: str, name: str, at: datetime) -> DataFrame:
    """The report as one row ``report_type, generated_at, data`` with a map from key to values.

    Only for reports that are short by definition: the map is one value in one task.
    """
    return report.agg(F.map_from_entries(F.collect_list(_entry(report, key))).alias("data")).select(
        F.lit(name).alias("report_type"), F.lit(at.isoformat()).alias("generated_at"), "data"
    )


def report_lines(report: DataFrame, key: str, name: str, at: datetime) -> DataFrame:
    """The report as rows ``report_type, generated_at, key, value``."""
    return report.select(
        F.lit(name).alias("report_type"),
        F.lit(at.isoformat()).alias("generated_at"),
        _entry(report, key).alias("_e"),
    ).select("report_type", "generated_at", "_e.key", "_e.value")


def _entry(report: DataFrame, key: str) -> Column:
    rest = [c for c in report.columns if c != key]
    value = F.col(rest[0]) if len(rest) == 1 else F.struct(*rest)
    return F.struct(F.coalesce(F.col(key).cast("string"), F.lit("null")).alias("key"), value.alias("value"))


def write_report(report: DataFrame, key: str, name: str, root: str, at: datetime, as_object: bool = False) -> str:
    path = f"{root.rstrip('/')}/{name}/{at:%Y%m%d_%H%M%S}"
    out = report_object(report, key, name, at).coalesce(1) if as_object else report_lines(report, key, name, at)
    out.write.mode("overwrite").json(path)
    return path


def write_summary(summary: DataFrame, root: str, at: datetime, status: DataFrame | None = None) -> str:
    """The one-row summary; ``status`` adds the order count per status as a nested map."""
    path = f"{root.rstrip('/')}/summary/{at:%Y%m%d_%H%M%S}"
    fields = [F.col(c) for c in summary.columns]
    if status is not None:
        by_name = status.agg(
            F.map_from_entries(F.collect_list(F.struct("status", "order_count"))).alias(
                "order_status_breakdown"
            )
        )
        # Two single rows become one.
        both = summary.unionByName(by_name, allowMissingColumns=True)
        summary = both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in both.columns])
        fields.append(F.col("order_status_breakdown"))
    summary.select(
        F.lit("summary").alias("report_type"),
        F.lit(at.isoformat()).alias("generated_at"),
        F.struct(*fields).alias("metrics"),
    ).coalesce(1).write.mode("overwrite").json(path)
    return path


def write_reports(
    reports: dict[str, tuple[DataFrame, str]], root: str, at: datetime, as_object: Iterable[str] = ()
) -> dict[str, str]:
    """Write several reports; each entry gives the frame and its key column, ``as_object`` the short ones."""
    short = set(as_object)
    return {
        name: write_report(df, key, name, root, at, name in short) for name, (df, key) in reports.items()
    }
