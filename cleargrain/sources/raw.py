"""The five raw sources: all text, with a row order that decides keep-first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cleargrain.functions import fixed
from cleargrain.sources import csv_splits

ROW_ORDER = "row_order"


class SourceError(ValueError):
    """A raw source is missing or does not carry the agreed columns."""


def as_source(dataset: str, frame: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Give a table the shape of a raw source.

    Every column becomes text; ``order_by`` ranks rows that share a key (the
    lowest is kept). Ties fall to the remaining columns when the first row is
    chosen, so the choice does not depend on how the rows were partitioned.
    """
    data = [column for column in frame.columns if column not in order_by or column in fixed.RAW_COLUMNS[dataset]]
    missing = [column for column in fixed.RAW_COLUMNS[dataset] if column not in data]
    if missing:
        raise SourceError(f"{dataset} lacks the columns {missing}")
    return frame.select(
        *[F.col(column).cast("string").alias(column) for column in data],
        F.struct(*order_by).alias(ROW_ORDER),
    )


def data_columns(source: DataFrame) -> list[str]:
    return [column for column in source.columns if column != ROW_ORDER]


def read_csv(spark: SparkSession, dataset: str, path: str, multi_line: bool = True) -> DataFrame:
    """UTF-8 CSV with a header; file order is the row order.

    Quoted fields may hold line breaks, and files are split all the same (see
    ``csv_splits``); only files with quotes inside unquoted fields are read whole.
    Blank lines are skipped, and missing fields of a short line are NULL.
    ``multi_line=False`` takes every line for a record, in one pass; it is refused
    where a line's quotes do not balance, because its record would be torn. Files
    whose headers disagree are refused.
    """
    frame, place = None, ["file", "block", "line"]
    if multi_line:
        try:
            frame = csv_splits.read(spark, path)
        except ValueError as error:
            raise SourceError(f"{dataset}: {error}") from error
    else:
        quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
        if not spark.read.text(path).where(quotes % 2 == 1).isEmpty():
            raise SourceError(f"{dataset} has quoted line breaks; read it with multi_line=True")
    if frame is None:
        frame = (
            spark.read.option("header", True).option("escape", '"').option("enforceSchema", False).option("multiLine", multi_line).csv(path)
        )
        columns = frame.columns
        place = [
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ]
    else:
        columns = [column for column in frame.columns if column not in place]
    missing = [column for column in fixed.RAW_COLUMNS[dataset] if column not in columns]
    if missing:
        raise SourceError(f"{dataset} lacks the columns {missing}")
    return frame.select(*columns, F.struct(*place).alias(ROW_ORDER))


def load_csv_folder(spark: SparkSession, folder: str, multi_line: bool = True) -> dict[str, DataFrame]:
    return {
        dataset: read_csv(spark, dataset, f"{folder}/{dataset}.csv", multi_line)
        for dataset in fixed.DATASETS
    }


def load_parquet_folder(
    spark: SparkSession, folder: str, order_by: Mapping[str, Sequence[str]]
) -> dict[str, DataFrame]:
    return {
        dataset: as_source(dataset, spark.read.parquet(f"{folder}/{dataset}.parquet"), order_by[dataset])
        for dataset in fixed.DATASETS
    }
