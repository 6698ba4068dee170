"""Data-quality checks. A check is one result row per scope (for instance per batch).

All column-level checks of a table share one aggregation pass, or are counted while the table is written and need none;
uniqueness and references count their
keys before anything is shuffled, so a hot key costs one row per input partition.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

RESULT = ("table_name", "check_name", "severity", "passed", "failures", "detail")


class DataQualityError(RuntimeError):
    """An error-level check failed; nothing may be loaded."""


@dataclass(frozen=True)
class ColumnCheck:
    """A check that looks at one row at a time: it counts the rows for which each of ``failing`` is true.

    With ``at_least`` it counts instead how many rows are missing from that number.
    """

    name: str
    failing: tuple[Column, ...]
    detail: Column
    at_least: int | None = None

    def failures(self, within: Column | None = None) -> Column:
        """The aggregate that counts, over all rows or those ``within`` a scope."""
        inside = F.lit(True) if within is None else within
        if self.at_least is not None:
            return F.greatest(F.lit(self.at_least) - F.count_if(inside), F.lit(0)).cast("bigint")
        counts = [F.count_if(f if within is None else f & inside) for f in self.failing]
        return sum(counts[1:], counts[0]).cast("bigint")


def _count(what: str) -> Column:
    return F.concat(F.col("_failures").cast("string"), F.lit(f" {what}"))


def failing_rows(name: str, failing: Column) -> ColumnCheck:
    return ColumnCheck(name, (failing,), _count("rows"))


def not_null(*columns: str) -> ColumnCheck:
    detail = F.when(F.col("_failures") == 0, "no nulls").otherwise(_count("nulls"))
    return ColumnCheck(f"not_null({', '.join(columns)})", tuple(F.col(c).isNull() for c in columns), detail)


def accepted_values(column: str, allowed: Sequence[str]) -> ColumnCheck:
    """NULL passes."""
    detail = F.when(F.col("_failures") == 0, "all valid").otherwise(_count("unexpected"))
    return ColumnCheck(f"accepted_values({column})", (~F.col(column).isin(*allowed),), detail)


def positive(column: str) -> ColumnCheck:
    """NULL passes."""
    return ColumnCheck(f"positive({column})", (F.col(column) <= 0,), _count("non-positive values"))


def accepted_range(column: str, low=None, high=None) -> ColumnCheck:
    """Both ends included; NULL passes."""
    outside = F.lit(False)
    if low is not None:
        outside = outside | (F.col(column) < F.lit(low))
    if high is not None:
        outside = outside | (F.col(column) > F.lit(high))
    return ColumnCheck(f"accepted_range({column})", (outside,), _count("out of range"))


def expression_is_true(expression: str) -> ColumnCheck:
    """NULL passes."""
    return ColumnCheck(f"expression_is_true({expression})", (~F.expr(expression),), _count("false"))


def min_rows(n: int) -> ColumnCheck:
    return ColumnCheck(f"min_rows({n})", (), _count("rows short"), at_least=n)


#: What was counted: per scope (None without scopes) the failures of each check by its name.
Counts = Mapping[str | None, Mapping[str, int]]


def counting(
    df: DataFrame, asked: Mapping[str, Sequence[ColumnCheck]], scope: str | None = None, values: Sequence[str] = ()
) -> tuple[DataFrame, Callable[[], dict[str, Counts]]]:
    """(``df``, which counts while it is written, and what it has counted by then) for checks under several names.

    Counting must be the last thing that happens to the rows before they are written: there each task counts once, however
    often stages before it run again. ``values`` are all scopes, each counted on its own.
    """
    metrics, places = [], []
    for name, checks in asked.items():
        for value in values or (None,):
            within = None if scope is None else F.col(scope) == F.lit(value)
            for check in checks:
                metrics.append(check.failures(within).alias(f"c{len(places)}"))
                places.append((name, value, check.name))
    observation = Observation()

    def counted() -> dict[str, Counts]:
        found: dict[str, dict] = {name: {} for name in asked}
        got = observation.get
        for i, (name, value, check) in enumerate(places):
            found[name].setdefault(value, {})[check] = got[f"c{i}"]
        return found

    return df.observe(observation, *metrics), counted


def counted_checks(
    spark: SparkSession, table: str, checks: Sequence[ColumnCheck], counts: Counts, scope: Sequence[str] = ()
) -> DataFrame:
    """The results ``check_columns`` would find, from what was counted when the table was written."""
    rows = [(*((value,) if scope else ()), table, c.name, counts[value][c.name]) for value in counts for c in checks]
    kinds = ", ".join([*(f"`{c}` string" for c in scope), "table_name string", "check_name string", "_failures bigint"])
    return _finish(spark.createDataFrame(rows, kinds), _detail(checks), scope)


def _detail(checks: Sequence[ColumnCheck]) -> Column:
    return F.coalesce(*[F.when(F.col("check_name") == c.name, c.detail) for c in checks])


def _results(counted: DataFrame, table: str, checks: Sequence[tuple[str, str, Column]], scope, scopes) -> DataFrame:
    """``counted`` has one row per scope and a column per check; make it one row per check."""
    if scope:
        counted = scopes.join(counted, list(scope), "left")
    rows = [
        F.struct(F.lit(name).alias("check_name"), F.coalesce(F.col(column), missing).alias("_failures"))
        for name, column, missing in checks
    ]
    return counted.select(*scope, F.lit(table).alias("table_name"), F.explode(F.array(*rows)).alias("r")).select(
        *scope, "table_name", "r.*"
    )


def _finish(rows: DataFrame, detail: Column, scope: Sequence[str]) -> DataFrame:
    return rows.select(
        *scope,
        "table_name",
        "check_name",
        F.lit("error").alias("severity"),
        (F.col("_failures") == 0).alias("passed"),
        F.col("_failures").cast("bigint").alias("failures"),
        detail.alias("detail"),
    )


def check_columns(
    df: DataFrame, table: str, checks: Sequence[ColumnCheck], scope: Sequence[str] = (), scopes: DataFrame | None = None
) -> DataFrame:
    """Several column checks of one table in one pass."""
    counted = df.groupBy(*scope).agg(*[c.failures().alias(f"_c{i}") for i, c in enumerate(checks)])
    # a scope without rows passes everything but the row minimum
    empty = [F.lit(c.at_least or 0).cast("bigint") for c in checks]
    rows = _results(counted, table, [(c.name, f"_c{i}", empty[i]) for i, c in enumerate(checks)], scope, scopes)
    return _finish(rows, _detail(checks), scope)


def check_unique(
    df: DataFrame,
    table: str,
    columns: Sequence[str],
    scope: Sequence[str] = (),
    scopes: DataFrame | None = None,
    nulls_count: bool = True,
) -> DataFrame:
    """Rows beyond the first of their key. The gate counts NULL as a key, the model tests leave it out."""
    if not nulls_count:
        df = df.dropna(subset=list(columns))
    groups = df.groupBy(*scope, *columns).agg(F.count("*").alias("_n"))
    counted = groups.groupBy(*scope).agg(F.sum(F.col("_n") - 1).alias("_c0"))
    rows = _results(counted, table, [(f"unique({', '.join(columns)})", "_c0", F.lit(0).cast("bigint"))], scope, scopes)
    return _finish(rows, _count("duplicate keys"), scope)


def check_relationship(
    child: DataFrame,
    table: str,
    column: str,
    parent: DataFrame,
    parent_column: str,
    scope: Sequence[str] = (),
    scopes: DataFrame | None = None,
    null_is_orphan: bool = True,
) -> DataFrame:
    """Child rows without a parent. The gate counts NULL as an orphan, the model tests ignore it."""
    if not null_is_orphan:
        child = child.filter(F.col(column).isNotNull())
    values = child.groupBy(*scope, column).agg(F.count("*").alias("_n"))
    keys = parent.select(*scope, F.col(parent_column).alias(column))
    orphans = values.join(keys, [*scope, column], "left_anti")
    counted = orphans.groupBy(*scope).agg(F.sum("_n").alias("_c0"))
    name = f"relationship({column} -> {parent_column})"
    rows = _results(counted, table, [(name, "_c0", F.lit(0).cast("bigint"))], scope, scopes)
    return _finish(rows, _count("orphan rows"), scope)


def union(parts: Sequence[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def assert_passed(results: DataFrame) -> None:
    """The gate: names every broken check of level error, with its count, and lets nothing pass beyond it."""
    broken = results.filter((F.col("severity") == "error") & ~F.col("passed"))
    names = F.concat_ws(" ", F.concat("table_name", F.lit("."), "check_name"), F.concat(F.lit("("), "detail", F.lit(")")))
    found = [r["what"] for r in broken.select(names.alias("what")).orderBy("what").collect()]  # as many as checks
    if found:
        raise DataQualityError("stopped at the gate by " + "; ".join(found))
