"""Validated tables, each computed once and kept in the shared folder."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cleargrain.functions import fixed
from cleargrain.functions.unfold import quoted, unfold
from cleargrain.operators import records, rules, validate
from cleargrain.operators.numbering import number, place
from cleargrain.operators.reconcile import DROPPED, DataQualityError, conservation
from cleargrain.plans import storage


class Staging:
    """Raw sources and what validation made of them.

    A table is built on first use and written to ``folder``: later steps and
    queries read only the columns they need, and a lost executor costs a
    re-read instead of the whole lineage.
    """

    def __init__(self, spark: SparkSession, sources: Mapping[str, DataFrame], folder: str | None = None):
        self.spark = spark
        self.sources = sources
        self._shelf = storage.Shelf(folder or storage.fresh_folder(spark, "staging"))
        self._written: dict[str, Observation] = {}

    def prepare(self, *datasets: str) -> None:
        """Validate several datasets, independent ones at the same time."""
        storage.at_once(*[partial(self.validated, dataset) for dataset in datasets])

    def validated(self, dataset: str) -> DataFrame:
        """Deduplicated, typed and judged records of one dataset."""
        parents = {
            "orders": ("customers", "products"),
            "support_tickets": ("customers",),
            "finance_transactions": ("orders",),
        }.get(dataset, ())
        judge = {
            "customers": validate.validate_customers,
            "products": validate.validate_products,
            "orders": validate.validate_orders,
            "support_tickets": validate.validate_tickets,
            "finance_transactions": validate.validate_finance,
        }[dataset]

        def build() -> DataFrame:
            storage.at_once(
                partial(self.sources.__getitem__, dataset), *[partial(self.validated, parent) for parent in parents]
            )
            judged = judge(self.sources[dataset], *[self.validated(parent) for parent in parents], repeated=self.repeated(dataset))
            self._written[dataset] = Observation()
            return judged.observe(self._written[dataset], *_metrics(dataset))

        return self._shelf.get(dataset, build)

    def repeated(self, dataset: str) -> DataFrame:
        """Hashes of repeated keys of the raw source, counted once for all that look for first rows in it."""
        key = fixed.KEYS[dataset]
        rows = records.keyed(self.sources[dataset].select(key), [key])
        return records.if_few(self._shelf.get(f"repeated_{dataset}", lambda: records.times_counted(rows, "_hash")))

    def written(self, dataset: str) -> dict[str, int]:
        """What was counted while a dataset was written: rows by fate, copies, hits by rule, dropped fingerprints.

        The counts belong to the tasks that wrote the table, each partition's once, so
        a task that is lost and run again does not count twice.
        """
        self.validated(dataset)
        return {name: int(value or 0) for name, value in self._written[dataset].get.items()}

    def keep(self, name: str, frame: DataFrame) -> DataFrame:
        """A derived table, written once beside the validated ones."""
        return self._shelf.get(name, lambda: frame)

    def loaded(self, dataset: str) -> DataFrame:
        return self.validated(dataset).where(~rules.quarantined(dataset))

    def quarantined(self, dataset: str) -> DataFrame:
        return self.validated(dataset).where(rules.quarantined(dataset))

    def issues(self) -> DataFrame:
        """Every finding with its emission order, unnumbered."""
        self.prepare(*fixed.DATASETS)
        return reduce(
            DataFrame.unionByName,
            [
                rules.list_issues(dataset, self.validated(dataset)).select(*rules.ISSUE_COLUMNS, "phase")
                for dataset in fixed.DATASETS
            ],
        )

    def exceptions(self) -> DataFrame:
        """Findings numbered in emission order: ``exception_id`` plus the issue columns."""

        def placed() -> DataFrame:
            self.prepare(*fixed.DATASETS)
            parts = [
                place(rules.list_issues(dataset, self.validated(dataset)), rules.EMISSION_ORDER)
                for dataset in fixed.DATASETS
            ]
            kept = (*rules.ISSUE_COLUMNS, "phase", "dataset_no", "part", "place")
            return reduce(DataFrame.unionByName, [part.select(*kept) for part in parts])

        numbered = number(self._shelf.get("placed_issues", placed), ["phase", "dataset_no"], "issue_no")
        return numbered.select(
            F.format_string("DQ%06d", F.col("issue_no")).alias("exception_id"), *rules.ISSUE_COLUMNS
        )

    def issue_summary(self) -> DataFrame:
        """Findings per rule, counted while the datasets were written; nothing is read for it."""
        self.prepare(*fixed.DATASETS)
        entries = []
        for dataset in fixed.DATASETS:
            counts = self.written(dataset)
            entries += [
                {
                    "dataset": quoted(dataset), "issue_type": quoted(rule.issue_type),
                    "severity": quoted(rule.severity), "action": quoted(rule.action),
                    "hits": f"{counts[f'hits_{rule.bit}']}L",
                }
                for rule in rules.CATALOGUE[dataset]
            ]
        return unfold(self.spark.range(1), entries)

    def issue_counts(self) -> DataFrame:
        """Findings per dataset, type, severity and action (those that occur)."""
        return (
            self.issue_summary()
            .groupBy("dataset", "issue_type", "severity", "action")
            .agg(F.sum("hits").alias("issue_count"))
            .where("issue_count > 0")
        )

    def controls(self) -> DataFrame:
        """Validation controls: one per kind of finding, then the five gates, by dataset and name.

        Four gates are judged by the findings. ``SOURCE_FILES_READABLE`` holds by
        the time there is anything to judge: a source that cannot be opened, or
        lacks a column, raises before.
        """
        kinds = self.issue_counts().select(
            "dataset", F.col("issue_type").alias("control"), "severity", "action", "issue_count",
            F.when(F.col("action") == "FAIL_PIPELINE", "FAIL").otherwise("WARNING").alias("status"),
        )
        # Gate names, each with the findings that would fail it.
        gates = (
            ("PRIMARY_KEYS_PRESENT", "issue_type = 'MISSING_PRIMARY_KEY'"),
            ("DIMENSION_DOMAINS_VALID", "action = 'FAIL_PIPELINE' AND issue_type = 'INVALID_CATEGORY'"),
            ("DIMENSION_AMOUNTS_VALID", "issue_type = 'INVALID_PRODUCT_AMOUNT'"),
            ("SOURCE_FILES_READABLE", "false"),
            ("CRITICAL_ERROR_THRESHOLD", "action = 'FAIL_PIPELINE'"),
        )
        counted = self.issue_summary().selectExpr(
            *[f"coalesce(sum(hits) FILTER (WHERE {broken}), 0) AS g{n}" for n, (_, broken) in enumerate(gates)]
        )
        entries = [
            {
                "dataset": "'enterprise'", "control": quoted(name), "severity": "'CRITICAL'",
                "action": "'NONE'", "issue_count": f"g{n}",
                "status": f"CASE WHEN g{n} = 0 THEN 'PASS' ELSE 'FAIL' END",
            }
            for n, (name, _) in enumerate(gates)
        ]
        return kinds.unionByName(unfold(counted, entries)).orderBy("dataset", "control", "severity", "action")

    def require_no_critical(self) -> None:
        """Raise with the first messages when a critical rule hit any record."""
        count = self.issue_counts().where("action = 'FAIL_PIPELINE'").agg(F.sum("issue_count")).first()[0]
        if not count:
            return
        shown = (
            self.exceptions()
            .where("action = 'FAIL_PIPELINE'")
            .orderBy(F.length("exception_id"), "exception_id")
            .limit(fixed.CRITICAL_MESSAGES_SHOWN)
            .collect()
        )
        lines = "\n".join(f"{row.dataset}/{row.record_id}: {row.message}" for row in shown)
        raise DataQualityError(f"Critical source validation failed:\n{lines}")

    def counts(self) -> DataFrame:
        """Source, unique, loaded and quarantined rows, and repeated keys, per dataset.

        Source rows are the copies folded into each kept row.
        """
        self.prepare(*fixed.DATASETS)
        entries = []
        for dataset in fixed.DATASETS:
            counts = self.written(dataset)
            entries.append({"dataset": quoted(dataset)} | {name: f"{counts[name]}L" for name in _FATES})
        return unfold(self.spark.range(1), entries)

    def conservation(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """Controls that every raw record is loaded, quarantined or a dropped copy, by key and cents."""
        # Dataset, its two tables and its typed amount column.
        sides = (
            ("orders", "fact_order", "order_quarantine", "order_amount_cents"),
            ("support_tickets", "fact_support_ticket", "support_ticket_quarantine", None),
            ("finance_transactions", "fact_finance_transaction", "finance_transaction_quarantine", "transaction_amount_cents"),
        )
        parts = []
        for dataset, fact, held, amount in sides:
            counts = self.written(dataset)
            dropped, copies = [counts[name] for name in DROPPED], counts["source_rows"] - counts["unique_rows"]
            parts.append(conservation(dataset, self.sources[dataset], tables[fact], tables[held], dropped, copies, amount))
        return reduce(DataFrame.unionAll, parts)


_FATES = ("source_rows", "unique_rows", "loaded_rows", "quarantined_rows", "duplicate_keys")


def _metrics(dataset: str) -> list[Column]:
    """What is counted while a validated dataset is written."""
    held = rules.hit_sql(rules.flags_with(dataset, action="QUARANTINE"))
    repeated = rules.hit_sql(rules.flags_with(dataset, name="repeated_key"))
    fates = ("coalesce(sum(copies), 0L)", "count(*)", f"count_if(NOT ({held}))", f"count_if({held})", f"count_if({repeated})")
    return [
        *[F.expr(sql).alias(name) for name, sql in zip(_FATES, fates, strict=True)],
        *[F.expr(f"count_if({rules.hit_sql(rule.flag)})").alias(f"hits_{rule.bit}") for rule in rules.CATALOGUE[dataset]],
        *[F.sum(name).alias(name) for name in DROPPED],
    ]
