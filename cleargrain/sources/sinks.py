"""Report files and the published warehouse."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cleargrain.sources import files


def write_csv_report(frame: DataFrame, path: str, order_by: tuple[str, ...] = ()) -> None:
    """One headed CSV file named ``path`` of a small report; an empty report is refused.

    Spark commits the rows of one task to a folder beside the target, also when the
    task had to run again; the one file of that folder then takes the name in a
    single step. Readers see the report before or the new one, and a refused or
    failed report leaves the one before. The rows are counted as they are
    written, so the report runs once.
    """
    spark, written = frame.sparkSession, Observation()
    counted = frame.coalesce(1).observe(written, F.count(F.lit(1)).alias("rows"))
    ordered = counted.sortWithinPartitions(*order_by) if order_by else counted
    parent, name = path.rstrip("/").rsplit("/", 1)
    draft = f"{parent}/_{name}-{uuid.uuid4().hex}"
    try:
        ordered.write.mode("error").option("header", True).option("escape", '"').csv(draft)
        if not written.get["rows"]:
            raise ValueError(f"Cannot publish an empty reporting dataset: {path}")
        (part,) = [file for file in files.listed(spark, draft) if file.startswith("part-")]
        files.move(spark, f"{draft}/{part}", path)
    finally:
        files.remove(spark, draft)


def write_json(frame: DataFrame, path: str) -> None:
    """JSON lines, one file per partition."""
    frame.write.mode("overwrite").option("ignoreNullFields", False).json(path)
