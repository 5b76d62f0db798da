"""The star-schema warehouse: views over staging, or published tables."""

from __future__ import annotations

import json
import time
from collections.abc import Mapping
from functools import cached_property, partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cleargrain.functions import fixed
from cleargrain.functions.measure import sum_if
from cleargrain.operators import audit, rules
from cleargrain.operators.records import hot_keys, keep_first, lookup, met_by_key
from cleargrain.operators.reconcile import DataQualityError, reconcile, require_balanced
from cleargrain.plans.staging import Staging
from cleargrain.plans.storage import COMPRESSION, at_once
from cleargrain.sources import files, schemas
from cleargrain.sources.raw import ROW_ORDER

# Published tables and their month columns.
MONTHS = {
    "fact_order": "order_month",
    "fact_support_ticket": "opened_month",
    "fact_finance_transaction": "posted_month",
}


class Warehouse:
    """Named tables plus the enriched grains that analytics read.

    Hot parents of a fact table are broadcast, so their facts need not meet.
    """

    def __init__(self, tables: Mapping[str, DataFrame]):
        self._given = tables

    def __getitem__(self, name: str) -> DataFrame:
        return self._given[name]

    @property
    def tables(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in schemas.WAREHOUSE}

    @cached_property
    def enriched_orders(self) -> DataFrame:
        """Orders with their customer's segment and region and product's category."""
        facts = self["fact_order"]
        rows = lookup(
            facts, "customer_id", "order_id", self["dim_customer"], "customer_id",
            {"customer_segment": "customer_segment", "region": "region"}, "has_customer", hot_keys(facts, "customer_id"),
        )
        rows = lookup(
            rows, "product_id", "order_id", self["dim_product"], "product_id",
            {"product_category": "product_category"}, "has_product", hot_keys(facts, "product_id"),
        )
        return rows.where("has_customer AND has_product").drop("has_customer", "has_product")

    @cached_property
    def enriched_tickets(self) -> DataFrame:
        facts = self["fact_support_ticket"]
        rows = lookup(
            facts, "customer_id", "ticket_id", self["dim_customer"], "customer_id",
            {"customer_segment": "customer_segment"}, "has_customer", hot_keys(facts, "customer_id"),
        )
        return rows.where("has_customer").drop("has_customer")

    @cached_property
    def orders_with_ledger(self) -> DataFrame:
        """Enriched orders with their posted cents and number of ledger rows, each order once."""
        rows = self["fact_finance_transaction"]
        ledger = rows.groupBy("order_id").agg(
            sum_if(F.col("posting_status") == "POSTED", F.col("transaction_amount_cents")).alias("net_cents"),
            F.count(F.lit(1)).alias("ledger_rows"),
        )
        return self.enriched_orders.join(met_by_key(ledger, rows), "order_id", "left")


class StagedWarehouse(Warehouse):
    """Lazy warehouse tables over the staged records.

    The enriched grains need no join here: validation looked the references up
    and staging kept what it found.
    """

    # Dataset behind each table; quarantine columns that turn blank text to NULL.
    _LOADED = {
        "dim_customer": "customers", "dim_product": "products", "fact_order": "orders",
        "fact_support_ticket": "support_tickets", "fact_finance_transaction": "finance_transactions",
    }
    _HELD = {
        "order_quarantine": ("orders", ("customer_id", "product_id", "order_date")),
        "support_ticket_quarantine": ("support_tickets", ("customer_id", "opened_at")),
        "finance_transaction_quarantine": ("finance_transactions", ("order_id", "posted_date")),
    }

    def __init__(self, staging: Staging):
        super().__init__({})
        self._staging = staging
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def _build(self, name: str) -> DataFrame:
        if name == "data_quality_exception":
            return self._staging.exceptions()
        if name == "etl_control":
            return reconciliation(self._staging, self)
        columns = schemas.WAREHOUSE[name].names
        if name in self._LOADED:
            dataset = self._LOADED[name]
            rows = self._staging.loaded(dataset).withColumn("quality_flag", rules.quality_flag(dataset))
            return rows.select(*columns)
        dataset, blanks = self._HELD[name]
        held = self._staging.quarantined(dataset).withColumn("quarantine_reason", rules.reason(dataset))
        return held.selectExpr(
            *[f"nullif({column}, '') AS {column}" if column in blanks else column for column in columns]
        )

    @cached_property
    def enriched_orders(self) -> DataFrame:
        return self._staging.loaded("orders").select(
            *[name for name in schemas.WAREHOUSE["fact_order"].names if name != "quality_flag"],
            "customer_segment", "region", "product_category",
        )

    @cached_property
    def enriched_tickets(self) -> DataFrame:
        return self._staging.loaded("support_tickets").select(
            *[name for name in schemas.WAREHOUSE["fact_support_ticket"].names if name != "quality_flag"],
            "customer_segment",
        )

    @cached_property
    def orders_with_ledger(self) -> DataFrame:
        """Joined once and kept: four reports read it."""
        build = super().orders_with_ledger
        columns = ("order_month", "product_category", "customer_id", "quantity", "order_amount_cents", "order_status")
        return self._staging.keep("orders_with_ledger", build.select(*columns, "net_cents", "ledger_rows"))


def _first_rows(staging: Staging, dataset: str) -> DataFrame:
    """Unique rows as the raw source holds them, found without the staged table."""
    source = staging.sources[dataset].select(*fixed.RAW_COLUMNS[dataset], ROW_ORDER)
    return keep_first(source, [fixed.KEYS[dataset]], [ROW_ORDER], repeated=staging.repeated(dataset))


def reconciliation(staging: Staging, warehouse: Warehouse) -> DataFrame:
    """Controls that each unique source row and cent is either loaded or quarantined.

    The source side is counted on the raw source, so a row lost on the way to
    staging fails its control.
    """
    # Dataset, its two tables and its raw and typed amount columns.
    sides = (
        ("orders", "fact_order", "order_quarantine", "order_amount", "order_amount_cents"),
        ("support_tickets", "fact_support_ticket", "support_ticket_quarantine", None, None),
        ("finance_transactions", "fact_finance_transaction", "finance_transaction_quarantine",
         "transaction_amount", "transaction_amount_cents"),
    )
    return reduce(
        DataFrame.unionAll,
        [
            reconcile(dataset, _first_rows(staging, dataset), warehouse[fact], warehouse[held], source, target)
            for dataset, fact, held, source, target in sides
        ],
    )


def publish(staging: Staging, target: str, run_id: str) -> Warehouse:
    """Write, audit, then announce a warehouse version.

    The run's name is claimed first, so of two runs of one name the second is
    refused. Tables go to a folder of their own; counts, cents, single records,
    constraints, keys and references are then checked on what was written. Only when
    all hold does the run take the next version number; a run that fails removes
    what it wrote, and leaves readers on the version they had.
    """
    staging.require_no_critical()
    spark, folder = staging.spark, _version_folder(target, run_id)
    if not files.create_once(spark, f"{target}/claims/{run_id}", ""):
        raise DataQualityError(f"Run {run_id} was published, or is under way, in {target}")
    try:
        written = _write_and_audit(staging, folder)
        announce(spark, target, run_id)
    except BaseException:
        files.remove(spark, folder)
        files.remove(spark, f"{target}/claims/{run_id}")
        raise
    return written


def _write_and_audit(staging: Staging, folder: str) -> Warehouse:
    staged = StagedWarehouse(staging)
    at_once(
        *[
            partial(_write_table, name, staged[name], f"{folder}/{name}")
            for name in schemas.WAREHOUSE
            if name != "etl_control"
        ]
    )
    written = open_version(staging.spark, folder, ("etl_control",))
    _write_table("etl_control", reconciliation(staging, written), f"{folder}/etl_control")
    written = open_version(staging.spark, folder)
    require_balanced(written["etl_control"])
    require_balanced(staging.conservation(written.tables))
    _require_sound(written.tables)
    return written


def announce(spark: SparkSession, target: str, run_id: str) -> int:
    """Take the next version number for a finished run.

    A number is a file that only one run can create. Who loses a number to
    another run tries the next one, so concurrent runs end up in one order that every reader sees.
    """
    number = max(_numbers(spark, target), default=0)
    while True:
        number += 1
        if files.create_once(spark, f"{target}/publications/{number:012d}.json", json.dumps({"run_id": run_id})):
            return number


def _version_folder(target: str, run_id: str) -> str:
    return f"{target}/versions/{run_id}"


def _numbers(spark: SparkSession, target: str) -> list[int]:
    """Numbers taken, the last one first."""
    names = files.listed(spark, f"{target}/publications")
    return sorted((int(name[:12]) for name in names if name[:12].isdigit() and name.endswith(".json")), reverse=True)


def publications(spark: SparkSession, target: str, last: int | None = None) -> list[tuple[int, str]]:
    """(number, run_id) of the announced versions, the last one first; at most ``last`` of them.

    A number whose file is empty was taken by a run that ended at that moment, or is
    being written: it announces nothing yet.
    """
    found: list[tuple[int, str]] = []
    for number in _numbers(spark, target):
        if last is not None and len(found) >= last:
            break
        if text := files.read_text(spark, f"{target}/publications/{number:012d}.json"):
            found.append((number, json.loads(text)["run_id"]))
    return found


def retain(spark: SparkSession, target: str, keep: int = 3, abandoned_after: float = 7 * 86400) -> list[str]:
    """Delete the tables of older versions; the names of the runs whose tables went.

    The last ``keep`` announced versions stay. Tables that no version announces belong to a
    run under way, or to one whose driver was lost: they go once the claim of their
    run is ``abandoned_after`` seconds old, which must exceed the longest run. Numbers
    and claims of announced runs stay, so no number and no name is ever used twice.
    """
    if keep < 1:
        raise ValueError("Keep one version at least")
    claims = files.listed(spark, f"{target}/claims")
    present = files.listed(spark, f"{target}/versions")
    announced = [run_id for _, run_id in publications(spark, target)]
    kept, old, late = set(announced[:keep]), set(announced[keep:]), time.time() - abandoned_after
    lost = {run_id for run_id in claims.keys() - kept - old if claims[run_id] < late}
    for run_id in (old & present.keys()) | lost:
        files.remove(spark, _version_folder(target, run_id))
    for run_id in lost:
        files.remove(spark, f"{target}/claims/{run_id}")
    return sorted((old | lost) & present.keys())


def _write_table(name: str, frame: DataFrame, path: str) -> None:
    """Facts go by month; rebalancing sizes the files and splits a heavy month."""
    month = MONTHS.get(name)
    if month is None:
        frame.hint("rebalance").write.mode("error").option("compression", COMPRESSION).parquet(path)
    else:
        frame.hint("rebalance", F.col(month)).write.mode("error").option("compression", COMPRESSION).partitionBy(month).parquet(path)


def _require_sound(tables: dict[str, DataFrame]) -> None:
    problems = [
        f"{row.table_name}.{row.column_name} {row.check_name}: {row.violations}"
        for row in audit.constraint_audit(tables).where("violations > 0").collect()
    ]
    problems += [
        f"{row.table_name} repeated keys: {row.repeated_keys}"
        for row in audit.key_audit(tables).where("repeated_keys > 0").collect()
    ]
    problems += [
        f"{row.control_name}: {row.issue_count}"
        for row in audit.reference_audit(tables).where("issue_count > 0").collect()
    ]
    if problems:
        raise DataQualityError("Warehouse validation failed: " + "; ".join(problems))


def open_version(spark: SparkSession, folder: str, without: tuple[str, ...] = ()) -> Warehouse:
    """Tables of one version, read with their fixed schemas."""
    return Warehouse(
        {
            name: spark.read.schema(schema).parquet(f"{folder}/{name}").select(*schema.names)
            for name, schema in schemas.WAREHOUSE.items()
            if name not in without
        }
    )


def open_latest(spark: SparkSession, target: str) -> Warehouse:
    """The announced version with the greatest number."""
    latest = publications(spark, target, last=1)
    if not latest:
        raise DataQualityError(f"No published warehouse in {target}")
    return open_version(spark, _version_folder(target, latest[0][1]))
