"""Sinks: Parquet first; sorted or appended JSON lines, batches, templates and one-row documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.operators.gates import GateError, require
from colophon.operators.pool import batches


def publish(tables: dict[str, DataFrame], violations: DataFrame, out: str, dry_run: bool = False, report: str | None = None) -> None:
    """SNK-01, SNK-13, SNK-14: all gates first, then all tables; the report of violations is written even if they stop the build."""
    if report:
        violations.write.mode("overwrite").json(report)
    require(violations)
    if dry_run:
        return
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{out}/{name}")


def json_lines(df: DataFrame, path: str, order: list[Column | str]) -> None:
    """SNK-02: JSON lines in a global order; files sort by name."""
    df.orderBy(*order).write.mode("overwrite").json(path)


def append_lines(df: DataFrame, path: str) -> None:
    """SNK-03."""
    df.write.mode("append").json(path)


def write_batches(df: DataFrame, path: str, size: int, order: list[Column | str]) -> DataFrame:
    """SNK-04: one folder for each batch, old ones replaced, and the index (batch, rows) that is returned."""
    placed = batches(df, size, order)
    placed.repartition("batch").write.mode("overwrite").partitionBy("batch").json(path)
    index = placed.groupBy("batch").agg(F.count("*").alias("rows")).orderBy("batch")
    index.write.mode("overwrite").json(f"{path}-index")
    return index


def payload(df: DataFrame) -> Column:
    """SNK-06, PR-06: a row as JSON that is safe inside a script element."""
    return F.replace(F.to_json(F.struct(*df.columns)), F.lit("<"), F.lit("\\u003c"))


def fill_template(template: str, marker: str, text: str) -> str:
    """SNK-06, GT-12: the marker, which must be there, replaced literally."""
    if marker not in template:
        raise GateError(f"the template lacks {marker}")
    return template.replace(marker, text)


def filled(template: str, values: dict[str, Column]) -> Column:
    """SNK-06, GT-12: a page of each row: every marker, which the template must have, replaced literally by the row's text."""
    out = F.lit(template)
    for marker, value in values.items():
        fill_template(template, marker, "")
        out = F.replace(out, F.lit(marker), F.coalesce(value, F.lit("")))
    return out


def stats_document(df: DataFrame) -> DataFrame:
    """SNK-07: one row of statistics as one JSON text."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))


def changed(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """SNK-09: rows of the new ledger that aren't in the old one as they are; without any the old file stays."""
    return new.exceptAll(old.select(*new.columns))


def audit_html(findings: DataFrame) -> DataFrame:
    """SNK-10: the rows of an audit table, one for each gate."""
    from colophon.functions.textnorm import html_escape

    cells = F.concat(F.lit("<tr><td>"), html_escape(F.col("id")), F.lit("</td><td>"), html_escape(F.col("detail")), F.lit("</td></tr>"))
    rows = findings.select("gate", "id", cells.alias("row")).groupBy("gate").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    return rows.select("gate", F.concat(F.lit("<table>"), F.array_join("rows", ""), F.lit("</table>")).alias("html"))
