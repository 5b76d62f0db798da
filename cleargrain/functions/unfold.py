"""Turning one wide row of measures into a short listing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame


def quoted(text: str) -> str:
    """SQL text literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def named(name: str) -> str:
    """SQL column reference for any column name."""
    return "`" + name.replace("`", "``") + "`"


def unfold(frame: DataFrame, entries: Sequence[Mapping[str, str]]) -> DataFrame:
    """One output row per entry, whose columns are SQL expressions over the input row."""
    rows = (
        "struct(" + ", ".join(f"{sql} AS {name}" for name, sql in entry.items()) + ")"
        for entry in entries
    )
    return frame.selectExpr(f"inline(array({', '.join(rows)}))")
