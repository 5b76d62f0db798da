"""Profiles of raw sources before any remediation."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cleargrain.functions import fixed
from cleargrain.functions.unfold import named, quoted, unfold
from cleargrain.operators.records import key_hash, repeated_hashes
from cleargrain.sources.raw import data_columns

# Text worth parsing: a failed parse costs far more than this match.
_NUMBER = r"^\\s*[+-]?[0-9_]*[.]?[0-9_]+[.]?([eE][+-]?[0-9]+)?\\s*$"


def profile_tables(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, columns, repeated rows and repeated keys per dataset."""
    return reduce(
        DataFrame.unionAll,
        [_profile_table(dataset, source) for dataset, source in sources.items()],
    )


def _profile_table(dataset: str, source: DataFrame) -> DataFrame:
    """Rows can be equal only where their hashes are.

    Hashes are counted first, narrow and combined before the shuffle; only rows
    under a repeated hash are compared in full, as partial counts. A hot or blank
    key meets no other row of its key.
    """
    key, columns = fixed.KEYS[dataset], data_columns(source)
    rows = source.select(*columns)
    keys = F.coalesce(F.col(key), F.lit("")).alias("key_value")
    by_key = rows.groupBy(keys).agg(F.count(F.lit(1)).alias("copies"))
    told = rows.select("*", key_hash(*columns).alias("row_hash"))
    totals = by_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
        F.count(F.when((F.col("copies") > 1) & (F.col("key_value") != ""), 1)).alias("duplicate_primary_key_count"),
    )
    same = (
        told.join(repeated_hashes(told, "row_hash"), "row_hash", "left_semi")
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_row_count"))
    )
    both = totals.unionByName(same, allowMissingColumns=True).agg(
        *[F.max(name).alias(name) for name in ("row_count", "duplicate_row_count", "duplicate_primary_key_count")]
    )
    return both.select(
        F.lit(dataset).alias("dataset"), "row_count",
        F.when(F.col("row_count") == 0, 0).otherwise(len(columns)).cast("bigint").alias("column_count"),
        "duplicate_row_count", "duplicate_primary_key_count", F.lit(key).alias("primary_key"),
    )


#: Value counts of a dataset, for callers that keep them between profiles.
ValueCounts = Callable[[str, DataFrame], DataFrame]


def value_counts(dataset: str, source: DataFrame) -> DataFrame:
    """Rows per populated value of every column, combined before the shuffle."""
    columns = data_columns(source)
    return (
        source.selectExpr(*[f"nullif({named(name)}, '') AS {named(name)}" for name in columns])
        .unpivot([], columns, "column_name", "value")
        .where("value IS NOT NULL")
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("value_count"))
        .withColumn("dataset", F.lit(dataset))
    )


def top_values(sources: Mapping[str, DataFrame], counts: ValueCounts = value_counts) -> DataFrame:
    """Most frequent values per column, by count then value.

    The limit applies within every task first, so a key column's distinct
    values do not gather in one window.
    """
    parts = []
    for dataset, source in sources.items():
        ranked = Window.partitionBy("column_name").orderBy(F.desc("value_count"), "value")
        parts.append(
            counts(dataset, source)
            .withColumn("rank", F.row_number().over(ranked))
            .where(F.col("rank") <= fixed.TOP_VALUES)
            .select("dataset", "column_name", F.col("rank").cast("bigint").alias("rank"), "value", "value_count")
        )
    return reduce(DataFrame.unionAll, parts)


def profile_columns(sources: Mapping[str, DataFrame], counts: ValueCounts = value_counts) -> DataFrame:
    """Completeness, uniqueness, range and numeric summary per column."""
    return reduce(
        DataFrame.unionAll,
        [_profile_columns(dataset, source, counts) for dataset, source in sources.items()],
    )


def _profile_columns(dataset: str, source: DataFrame, counts: ValueCounts) -> DataFrame:
    """One ungrouped scan for the ranges, one value count for uniqueness."""
    columns = data_columns(source)
    parsed, measures, entries = [], [], []
    for n, name in enumerate(columns):
        text = named(name)
        digits = f"CASE WHEN contains({text}, '_') THEN translate({text}, '_', '') ELSE {text} END"
        parsed += [
            f"nullif({text}, '') AS v{n}",
            f"CASE WHEN {text} RLIKE '{_NUMBER}' THEN {digits} END AS t{n}",
        ]
        measures += [
            f"count(*) AS r{n}", f"count(v{n}) AS p{n}", f"min(v{n}) AS lo{n}", f"max(v{n}) AS hi{n}",
            f"count(f{n}) AS c{n}", f"min(f{n}) AS min{n}", f"max(f{n}) AS max{n}", f"sum(f{n}) AS about{n}",
            f"count(w{n}) AS exact{n}", f"try_sum(w{n}) AS whole{n}", f"coalesce(sum(d{n} % 1), 0) AS rest{n}",
        ]
        entries.append({
            "column_name": quoted(name), "rows": f"r{n}", "populated": f"p{n}", "min_value": f"lo{n}",
            "max_value": f"hi{n}", "parsed": f"c{n}", "low": f"min{n}", "high": f"max{n}", "about": f"about{n}",
            "exact": f"exact{n}", "whole": f"whole{n}", "rest": f"rest{n}",
        })
    every = range(len(columns))
    numbers = source.selectExpr(*parsed).selectExpr(
        *[f"v{n}" for n in every], *[f"t{n}" for n in every], *[f"try_cast(t{n} AS DOUBLE) AS f{n}" for n in every],
        *[f"try_cast(t{n} AS DECIMAL(38,18)) AS d{n}" for n in every],
    ).selectExpr(
        "*",
        # Wider numbers have no digits behind the point that a result could show.
        *[f"coalesce(CAST(d{n} - d{n} % 1 AS DECIMAL(38,0)), try_cast(t{n} AS DECIMAL(38,0))) AS w{n}" for n in every],
    )
    ranges = unfold(numbers.selectExpr(*measures), entries)
    distinct = counts(dataset, source).groupBy("column_name").agg(F.count(F.lit(1)).alias("values"))
    numeric = (F.col("populated") > 0) & (F.col("parsed") == F.col("populated"))
    unique = F.coalesce(F.col("values"), F.lit(0))
    # Whole parts and fractions are summed apart, so 38 digits are exact; beyond them the sum is a double.
    exact = (F.col("exact") == F.col("parsed")) & F.col("whole").isNotNull()
    rows = F.col("parsed").cast("decimal(20,0)")
    total = F.coalesce(
        F.try_add("whole", F.round("rest", 2).cast("decimal(30,2)")).cast("double"), F.col("whole").cast("double")
    )
    share = F.try_divide(F.col("whole") - F.col("whole") % rows, rows).try_cast("decimal(32,0)")
    left = F.round(((F.col("whole") % rows).cast("decimal(20,0)") + F.col("rest").cast("decimal(38,18)")) / rows, 4)
    mean = F.coalesce(F.try_add(share, left.cast("decimal(24,4)")).cast("double"), F.col("whole").cast("double") / F.col("parsed"))

    def summary(value, name: str):
        return F.when(numeric, value).alias(name)

    return ranges.where("rows > 0").join(distinct, "column_name", "left").select(
        F.lit(dataset).alias("dataset"), "column_name",
        (F.col("rows") - F.col("populated")).alias("null_count"),
        unique.alias("unique_count"),
        (F.col("populated") - unique).alias("duplicate_value_count"),
        "min_value", "max_value",
        summary(F.col("parsed"), "numeric_count"),
        summary(F.col("low"), "numeric_min"),
        summary(F.col("high"), "numeric_max"),
        summary(F.when(exact, mean).otherwise(F.round(F.col("about") / F.col("parsed"), 4)), "numeric_mean"),
        summary(F.when(exact, total.cast("double")).otherwise(F.round("about", 2)), "numeric_sum"),
    )


def profile_totals(sources: Mapping[str, DataFrame], tables: DataFrame | None = None) -> DataFrame:
    """Rows, repeated rows and blank cells over all datasets; ``tables``: their table profiles, if at hand."""
    tables = (profile_tables(sources) if tables is None else tables).agg(
        F.sum("row_count").alias("rows_profiled"), F.sum("duplicate_row_count").alias("duplicate_rows")
    )
    blanks = reduce(
        DataFrame.unionAll,
        [
            source.selectExpr(
                " + ".join(f"count_if(nullif({named(name)}, '') IS NULL)" for name in data_columns(source))
                + " AS null_cells"
            )
            for source in sources.values()
        ],
    ).agg(F.sum("null_cells").alias("null_cells"))
    return tables.unionByName(blanks, allowMissingColumns=True).agg(
        *[F.max(name).alias(name) for name in ("rows_profiled", "duplicate_rows", "null_cells")]
    )


