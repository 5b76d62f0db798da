"""Count and amount conservation from source to loaded plus quarantined."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cleargrain.functions import fixed
from cleargrain.functions.clean import cents, to_decimal
from cleargrain.functions.unfold import quoted, unfold


class DataQualityError(RuntimeError):
    """The data is not safe to publish."""


def reconcile(
    dataset: str, source: DataFrame, loaded: DataFrame, quarantined: DataFrame,
    source_amount: str | None = None, target_amount: str | None = None,
) -> DataFrame:
    """One control row for the count and, with amounts, one for the cents.

    The sides are summed apart and then compared, each with partial sums, so
    only three small rows meet. A source amount that is not a number cannot be
    conserved: its control fails.
    """
    def side(name: str, frame: DataFrame, amount) -> DataFrame:
        return frame.agg(
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(amount), F.lit(0)).cast("bigint").alias("cents"),
            F.count(F.when(amount.isNull(), 1)).alias("unreadable"),
        ).withColumn("is_source", F.lit(name == "source"))

    def target(frame: DataFrame):
        return F.coalesce(F.col(target_amount), F.lit(0)) if target_amount else F.lit(0).cast("bigint")

    raw = cents(to_decimal(F.col(source_amount))) if source_amount else F.lit(0).cast("bigint")
    sides = reduce(
        DataFrame.unionAll,
        [side("source", source, raw), side("loaded", loaded, target(loaded)),
         side("quarantined", quarantined, target(quarantined))],
    )
    controls = [("count", "COUNT", "rows")]
    if source_amount:
        controls.append(("amount_cents", "CENTS", "cents"))
    entries = [
        {
            "control_name": quoted(f"{dataset}_{suffix}"), "dataset": quoted(dataset), "unit": quoted(unit),
            "source_value": f"source_{column}", "target_value": f"target_{column}",
            "unreadable": "unreadable" if column == "cents" else "0L",
        }
        for suffix, unit, column in controls
    ]
    is_source = F.col("is_source")
    totals = sides.agg(
        *[
            F.sum(F.when(is_source == (origin == "source"), F.col(column))).alias(f"{origin}_{column}")
            for origin in ("source", "target") for column in ("rows", "cents")
        ],
        F.sum(F.when(is_source, F.col("unreadable"))).alias("unreadable"),
    )
    balanced = (F.col("source_value") == F.col("target_value")) & (F.col("unreadable") == 0)
    return unfold(totals, entries).select(
        "control_name", "dataset", "unit", "source_value", "target_value",
        (F.col("source_value") - F.col("target_value")).alias("difference"),
        F.when(balanced, "PASS").otherwise("FAIL").alias("status"),
    )


#: Columns of a staged row's two fingerprints of what was dropped for it.
DROPPED = ("dropped_1", "dropped_2")


def fingerprints(key: Column, amount_cents: Column | None = None) -> list[Column]:
    """Two 64-bit hashes of a record's key and cents, as numbers whose sums over any rows stay exact.

    The sums of equal multisets are equal however the rows are split or ordered, and
    sums of parts add up; two records that swap amounts change them.
    """
    cents_ = F.lit(0).cast("bigint") if amount_cents is None else amount_cents
    parts = [F.coalesce(key, F.lit("")), cents_.isNull(), F.coalesce(cents_, F.lit(0).cast("bigint"))]
    return [F.xxhash64(F.lit(n), *parts).cast("decimal(38,0)") for n in range(len(DROPPED))]


def source_fingerprints(dataset: str) -> list[Column]:
    """Of a raw row."""
    amount = fixed.AMOUNTS.get(dataset)
    return fingerprints(F.col(fixed.KEYS[dataset]), cents(to_decimal(F.col(amount))) if amount else None)


def conservation(
    dataset: str, source: DataFrame, loaded: DataFrame, quarantined: DataFrame, dropped: Sequence[int], copies: int, target_amount: str | None = None
) -> DataFrame:
    """One control row: every raw row's key and cents are loaded, quarantined, or a dropped copy.

    The raw rows are added up as they are, without finding first rows again; what was
    dropped was added up when the first rows were found (``dropped`` and the number of
    ``copies``). Sums by task are all that is shuffled.
    """
    def side(name: str, frame: DataFrame, prints: list[Column]) -> DataFrame:
        totals = [F.coalesce(F.sum(p), F.lit(0)).cast("decimal(38,0)").alias(d) for p, d in zip(prints, DROPPED, strict=True)]
        return frame.agg(F.count(F.lit(1)).alias("rows"), *totals).withColumn("is_source", F.lit(name == "source"))

    target = fingerprints(F.col(fixed.KEYS[dataset]), F.col(target_amount) if target_amount else None)
    sides = reduce(
        DataFrame.unionAll,
        [side("source", source, source_fingerprints(dataset)), side("loaded", loaded, target), side("quarantined", quarantined, target)],
    )
    gone = (copies, *dropped)
    sums = sides.agg(
        *[
            (F.coalesce(F.sum(F.when(F.col("is_source") == origin, F.col(c))), F.lit(0)) + F.lit("0" if origin else str(more)).cast("decimal(38,0)")).alias(f"{c}_{origin}")
            for origin in (True, False) for c, more in zip(("rows", *DROPPED), gone, strict=True)
        ]
    )
    same = reduce(lambda a, b: a & b, [F.col(f"{c}_True") == F.col(f"{c}_False") for c in ("rows", *DROPPED)])
    return sums.select(
        F.lit(f"{dataset}_rows").alias("control_name"), F.lit(dataset).alias("dataset"), F.col("rows_True").cast("bigint").alias("source_rows"),
        F.col("rows_False").cast("bigint").alias("target_rows"), F.when(same, "PASS").otherwise("FAIL").alias("status"),
    )


def require_balanced(controls: DataFrame) -> None:
    """Raise with the names of failed controls; at most five rows are read."""
    failed = [row.control_name for row in controls.where("status = 'FAIL'").orderBy("control_name").collect()]
    if failed:
        raise DataQualityError(f"Critical source-to-target reconciliation failed: {', '.join(failed)}")
