"""Schema check, rule evaluation in one pass, and the verdict behind the validation gate."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.coercion import nan_to_null, numeric_column
from basketry.functions.literals import lines, name, quoted
from basketry.operators.dedup import row_digest
from basketry.specs import DatasetSpec, RangeRule

WORD_BITS = 62  # checks per mask column


def missing_columns(df: DataFrame, spec: DatasetSpec | None) -> list[str]:
    """Expected columns the table lacks, in contract order; an unknown dataset lacks none."""
    return [c for c in spec.columns if c not in df.columns] if spec else []


def schema_check(tables: Iterable[tuple[str, DataFrame, DatasetSpec | None]], spark: SparkSession) -> DataFrame:
    """One row per dataset from column names alone: no data is read."""
    rows = []
    for dataset, df, spec in tables:
        missing = missing_columns(df, spec)
        rows.append((dataset, len(missing), ",".join(missing), not missing))
    return spark.createDataFrame(rows, "dataset string, n_missing int, missing string, passed boolean")


def out_of_range(x: str, rule: RangeRule) -> str:
    """SQL for: ``x`` is outside the rule's bounds; null is never outside."""
    broken = [f"{x} {op} {bound}" for op, bound in (("<", rule.low), (">", rule.high)) if bound is not None]
    return f"coalesce({' OR '.join(broken) or 'false'}, false)"


def invalid_email(email: Column) -> Column:
    """No '@' in the value; a missing value is invalid too."""
    return ~F.contains(F.coalesce(email.cast("string"), F.lit("nan")), F.lit("@"))


def _checks(df: DataFrame, spec: DatasetSpec) -> tuple[list[tuple[str, str, str, bool]], dict[str, Column]]:
    """The checks as (check, column, SQL of a bad row, decides the verdict), and the values they need."""
    values: dict[str, Column] = {}
    checks = [("nulls", c, f"{name(c)} IS NULL", False) for c in df.columns]
    checks += [("required", c, f"{name(c)} IS NULL" if c in df.columns else "true", True) for c in spec.required]
    for rule in spec.ranges:
        if rule.column not in df.columns:
            continue
        number = f"_number_{rule.column}"
        values[number] = numeric_column(df, rule.column, rule.embedded)
        checks.append(("malformed", rule.column, f"{name(rule.column)} IS NOT NULL AND {number} IS NULL", True))
        checks.append(("range", rule.column, out_of_range(number, rule), True))
    if spec.email_column and spec.email_column in df.columns:
        values["_bad_email"] = invalid_email(F.col(spec.email_column))
        checks.append(("email", spec.email_column, "_bad_email", True))
    return checks, values


def rule_counts(df: DataFrame, spec: DatasetSpec, check: str) -> DataFrame:
    """(dataset, column, n_bad) of one kind of check ('nulls', 'required', 'malformed', 'range',
    'email'): one scan, no shuffle of rows."""
    df = nan_to_null(df)
    checks, values = _checks(df, spec)
    chosen = [(column, bad) for kind, column, bad, _ in checks if kind == check]
    if not chosen:
        return df.sparkSession.createDataFrame([], "dataset string, column string, n_bad long")
    counted = df.withColumns(values).agg(*(F.expr(f"count_if({bad}) AS c{i}") for i, (_, bad) in enumerate(chosen)))
    rows = [
        [("dataset", quoted(spec.name)), ("column", quoted(column)), ("n_bad", f"c{i}")]
        for i, (column, _) in enumerate(chosen)
    ]
    return counted.select(lines(rows))


def quality_report(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Every check of one dataset as rows (dataset, check, column, n_bad, passed).

    The table is read once. Each row becomes a digest and a bit per broken
    check; grouping by both counts the copies, which gives the duplicates, and
    the checks add up their bits by that count. What is shuffled is 50 bytes a
    row, however wide the table. 'rows' and 'nulls' describe the data and always pass.
    """
    df = nan_to_null(df)
    checks, values = _checks(df, spec)
    place = [(f"_m{i // WORD_BITS}", 1 << i % WORD_BITS) for i in range(len(checks))]
    masks = sorted({mask for mask, _ in place})
    bits = {
        m: " + ".join(f"if({bad}, {bit}L, 0L)" for (mask, bit), (_, _, bad, _) in zip(place, checks) if mask == m)
        for m in masks
    }
    marked = df.withColumns({**values, "_digest": row_digest(df)}).select(
        "_digest", *(F.expr(bits[m]).alias(m) for m in masks)
    )
    copies = marked.groupBy("_digest", *masks).agg(F.count(F.lit(1)).alias("_n"))
    counted = copies.agg(
        F.expr("coalesce(sum(_n), 0) AS c_rows"),
        F.expr("coalesce(sum(_n - 1), 0) AS c_dup"),
        *(F.expr(f"coalesce(sum(if({m} & {bit}L != 0, _n, 0L)), 0L) AS c{i}") for i, (m, bit) in enumerate(place)),
    )

    def line(check: str, column: str, value: str, decides: bool) -> list[tuple[str, str]]:
        return [
            ("dataset", quoted(spec.name)), ("check", quoted(check)), ("column", quoted(column)),
            ("n_bad", value), ("passed", f"{value} = 0" if decides else "true"),
        ]

    rows = [line("rows", "*", "c_rows", False), line("duplicates", "*", "c_dup", True)]
    rows += [line(check, col, f"c{i}", decides) for i, (check, col, _, decides) in enumerate(checks)]
    return counted.select(lines(rows))


def profile_datasets(
    spark: SparkSession, tables: Mapping[str, DataFrame], specs: Mapping[str, DatasetSpec]
) -> tuple[DataFrame, DataFrame]:
    """(quality report, schema check) of all tables. One without a spec is profiled too: its rows, nulls and duplicates."""
    report = None
    for name, df in tables.items():
        part = quality_report(df, specs.get(name) or DatasetSpec(name, (), "", ()))
        report = part if report is None else report.unionByName(part)
    return report, schema_check(((n, df, specs.get(n)) for n, df in tables.items()), spark)


def null_profile(df: DataFrame, dataset: str) -> DataFrame:
    """(dataset, column, total_rows, n_null) for every column, in one aggregate."""
    df = nan_to_null(df)
    counted = df.agg(
        F.expr("count(1) AS n"), *(F.expr(f"count_if({name(c)} IS NULL) AS n{i}") for i, c in enumerate(df.columns))
    )
    rows = [
        [("dataset", quoted(dataset)), ("column", quoted(c)), ("total_rows", "n"), ("n_null", f"n{i}")]
        for i, c in enumerate(df.columns)
    ]
    return counted.select(lines(rows))


def verdicts(report: DataFrame) -> DataFrame:
    """(dataset, n_issues, is_valid): valid when no deciding check failed."""
    return report.groupBy("dataset").agg(
        F.count_if(~F.col("passed")).alias("n_issues"), F.every("passed").alias("is_valid")
    )


def gate(schema: DataFrame, report: DataFrame) -> DataFrame:
    """(dataset, schema_ok, quality_ok, promoted) from a schema check and a quality report."""
    quality = verdicts(report).select("dataset", F.col("is_valid").alias("quality_ok"))
    both = schema.select("dataset", F.col("passed").alias("schema_ok")).join(quality, "dataset")
    return both.select("dataset", "schema_ok", "quality_ok", (F.col("schema_ok") & F.col("quality_ok")).alias("promoted"))
