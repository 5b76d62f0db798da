"""Every registered query: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property, partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cleargrain.functions import fixed
from cleargrain.operators import audit, profile, records, rules
from cleargrain.plans import analytics, reports, storage
from cleargrain.plans.staging import Staging
from cleargrain.plans.warehouse import StagedWarehouse, Warehouse, open_latest, publish
from cleargrain.sources import csv_splits, schemas
from cleargrain.sources.adapter import BASE_TABLES, DIRTY_RECIPES, RECIPES, Recipe, damaged, derive_source

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fields whose absence the missing-field report lists.
REQUIRED = {
    "customers": ("customer_name", "customer_segment", "region", "created_date", "crm_status"),
    "products": ("product_name", "product_category", "unit_price", "unit_cost", "active_flag"),
    "orders": ("customer_id", "product_id", "order_date", "quantity", "order_amount"),
    "support_tickets": ("customer_id", "opened_at", "resolved_at", "issue_category", "satisfaction_score"),
    "finance_transactions": ("order_id", "posted_date", "transaction_amount", "currency"),
}
# Foreign keys between the raw sources.
RAW_REFERENCES = (
    ("orders", "customer_id", "customers"),
    ("orders", "product_id", "products"),
    ("support_tickets", "customer_id", "customers"),
    ("finance_transactions", "order_id", "orders"),
)


class Workspace:
    """Sources, staging, warehouse views and the small frames that several queries share."""

    def __init__(self, spark: SparkSession, sf_dir: str, recipes: Mapping[str, Recipe]):
        self._spark, folder = spark, storage.fresh_folder(spark, "workspace")
        builders = {name: partial(derive_source, spark, sf_dir, name, recipes) for name in fixed.DATASETS}
        self.sources = storage.Landed(f"{folder}/sources", builders)
        self.staging = Staging(spark, self.sources, f"{folder}/staging")
        self.warehouse = StagedWarehouse(self.staging)
        self._frames = storage.Shelf(f"{folder}/frames")
        self._published = f"{folder}/published"

    @cached_property
    def damaged(self) -> Warehouse:
        """The warehouse with planted damage, for the audits to find."""
        return Warehouse({name: damaged(name, table) for name, table in self.warehouse.tables.items()})

    @cached_property
    def published(self) -> Warehouse:
        """The warehouse as written, audited, announced and opened again."""
        publish(self.staging, self._published, "latest")
        return open_latest(self._spark, self._published)

    def values(self, dataset: str, source: DataFrame) -> DataFrame:
        return self._frames.get(f"values_{dataset}", lambda: profile.value_counts(dataset, source))

    @property
    def profiled(self) -> DataFrame:
        return self._frames.get("profile_tables", lambda: profile.profile_tables(self.sources.land()))

    @property
    def totals(self) -> DataFrame:
        return self._frames.get("profile_totals", lambda: profile.profile_totals(self.sources, self.profiled))

    @property
    def counts(self) -> DataFrame:
        return self._frames.get("counts", self.staging.counts)

    @property
    def issue_counts(self) -> DataFrame:
        return self._frames.get("issue_counts", self.staging.issue_counts)

    @property
    def controls(self) -> DataFrame:
        return self._frames.get("controls", self.staging.controls)

    @property
    def balances(self) -> DataFrame:
        return self._frames.get("balances", lambda: self.warehouse["etl_control"])

    @property
    def score(self) -> DataFrame:
        return analytics.quality_score(analytics.quality_inputs(self.counts, self.issue_counts))

    @property
    def overall(self) -> DataFrame:
        return self._frames.get("overall", lambda: analytics.kpi_overall(self.warehouse, self.score))

    @property
    def months(self) -> DataFrame:
        return self._frames.get("months", lambda: analytics.monthly_trends(self.warehouse))

    @property
    def categories(self) -> DataFrame:
        return self._frames.get("categories", lambda: analytics.category_performance(self.warehouse))

    @property
    def segments(self) -> DataFrame:
        return self._frames.get("segments", lambda: analytics.segment_metrics(self.warehouse))


_workspaces: dict[tuple, Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str, recipes: Mapping[str, Recipe] = RECIPES) -> Workspace:
    """One workspace per session, kind of sources and state of the input tables."""
    state = (
        spark.sparkContext.applicationId, sf_dir, recipes is DIRTY_RECIPES, storage.fingerprint(spark, sf_dir, BASE_TABLES)
    )
    if state not in _workspaces:
        _workspaces[state] = Workspace(spark, sf_dir, recipes)
    return _workspaces[state]


Build = Callable[[Workspace], DataFrame]
_builds: dict[str, Build] = {}


def _query(build: Build, name: str) -> None:
    _builds[name] = build
    QUERIES[name] = lambda spark, sf_dir: build(workspace(spark, sf_dir))


def _on_warehouse(name: str, build: Callable[[Warehouse], DataFrame]) -> None:
    _query(lambda ws: build(ws.warehouse), name)


def _each_source(ws: Workspace, build: Callable[[str, DataFrame], DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [build(name, ws.sources[name]) for name in fixed.DATASETS])


# --- Profiles ---------------------------------------------------------------

_query(lambda ws: ws.profiled, "profile_tables")
_query(lambda ws: profile.profile_columns(ws.sources.land(), ws.values), "profile_columns")
_query(lambda ws: profile.top_values(ws.sources.land(), ws.values), "profile_top_values")
_query(lambda ws: ws.totals, "profile_totals")

# --- Data-quality primitives --------------------------------------------------


def _duplicates(ws: Workspace) -> DataFrame:
    return _each_source(
        ws,
        lambda name, source: records.find_duplicates(source, fixed.KEYS[name]).select(
            F.lit(name).alias("dataset"), "key_value", "copies"
        ),
    )


def _missing_required(ws: Workspace) -> DataFrame:
    return _each_source(
        ws,
        lambda name, source: records.missing_required(source, REQUIRED[name], fixed.KEYS[name]).select(
            F.lit(name).alias("dataset"), "record_id", F.array_join("fields", "|").alias("fields")
        ),
    )


def _invalid_references(ws: Workspace) -> DataFrame:
    return reduce(
        DataFrame.unionAll,
        [
            records.invalid_references(
                ws.sources[child], field, ws.sources[parent], fixed.KEYS[parent], fixed.KEYS[child]
            ).select(F.lit(child).alias("dataset"), F.lit(field).alias("field"), "record_id", "value")
            for child, field, parent in RAW_REFERENCES
        ],
    )


def _dedup_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    order_by = [
        "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus",
    ]
    return records.keep_first(lines, ["l_orderkey", "l_linenumber"], order_by).withColumn(
        "l_shipdate", F.col("l_shipdate").cast("date").cast("string")
    )


def _quarantine_ids(ws: Workspace) -> DataFrame:
    facts = ("orders", "support_tickets", "finance_transactions")
    return reduce(
        DataFrame.unionAll,
        [
            ws.staging.quarantined(name).select(
                F.lit(name).alias("dataset"), F.col(fixed.KEYS[name]).alias("record_id")
            )
            for name in facts
        ],
    )


def _issue_map(ws: Workspace) -> DataFrame:
    """Issue types by record; a record without a key is listed as such beside its own."""
    parts = []
    for name in fixed.DATASETS:
        rows, dataset = ws.staging.validated(name), F.lit(name).alias("dataset")
        flag, lost = rules.quality_flag(name), rules.has_any(rules.flags_with(name, name="missing_key"))
        parts.append(
            rows.select(dataset, F.col(fixed.KEYS[name]).alias("record_id"), flag.alias("issue_types")).where("issue_types <> 'PASS'")
        )
        parts.append(
            rows.where(lost).select(dataset, F.lit(rules.MISSING_KEY_ID).alias("record_id"), F.lit("MISSING_PRIMARY_KEY").alias("issue_types"))
        )
    return reduce(DataFrame.unionAll, parts)


_query(_duplicates, "dq_duplicates")
_query(_missing_required, "dq_missing_required")
_query(_invalid_references, "dq_invalid_fk")
QUERIES["dedup_first"] = _dedup_lineitem
_query(lambda ws: ws.staging.issues().select(*rules.ISSUE_COLUMNS), "dq_issues")
_query(lambda ws: ws.staging.exceptions(), "dq_exceptions")
_query(lambda ws: ws.staging.controls(), "dq_controls")
_query(_quarantine_ids, "dq_quarantine_ids")
_query(_issue_map, "dq_issue_map")
_query(lambda ws: reports.issue_type_counts(ws.issue_counts), "dq_issue_counts")

# --- Warehouse, routing, audit ---------------------------------------------------

for _name, _table in {
    "wh_dim_customer": "dim_customer",
    "wh_dim_product": "dim_product",
    "wh_fact_order": "fact_order",
    "wh_fact_support_ticket": "fact_support_ticket",
    "wh_fact_finance": "fact_finance_transaction",
    "quarantine_orders": "order_quarantine",
    "quarantine_tickets": "support_ticket_quarantine",
    "quarantine_finance": "finance_transaction_quarantine",
    "recon_controls": "etl_control",
}.items():
    _on_warehouse(_name, lambda wh, table=_table: wh[table])


def _cascade(ws: Workspace) -> DataFrame:
    flag = rules.flags_with("finance_transactions", name=rules.CASCADE_RULE)
    return ws.staging.validated("finance_transactions").where(rules.has_any(flag)).select(
        "finance_transaction_id", "order_id", F.lit("ORDER_NOT_LOADED").alias("issue_type")
    )


def _quarantine_inventory(ws: Workspace) -> DataFrame:
    return ws.staging.counts().where(F.col("dataset").isin("orders", "support_tickets", "finance_transactions")).select(
        "dataset", F.col("quarantined_rows").alias("quarantined")
    )


_query(_cascade, "finance_cascade")
_query(lambda ws: ws.staging.counts(), "etl_counts")
_query(lambda ws: ws.staging.conservation(ws.published.tables), "published_conservation")
_query(lambda ws: ws.staging.conservation(ws.warehouse.tables), "recon_rows")


def _csv_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents through CSV: written by Spark, line breaks in quotes and all, and read in splits."""
    folder = storage.fresh_folder(spark, "csv")
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    documents.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(folder)
    return csv_splits.read(spark, folder).select("doc_id", "lang", "source", "n_chars", "text")


QUERIES["csv_documents"] = _csv_documents
_on_warehouse("constraint_audit", lambda wh: audit.constraint_audit(wh.tables))
_on_warehouse("key_audit", lambda wh: audit.key_audit(wh.tables))
_on_warehouse("reference_audit", lambda wh: audit.reference_audit(wh.tables))
_on_warehouse(
    "fk_audit",
    lambda wh: audit.reference_audit(wh.tables, ("ORDER_CUSTOMER_FK", "ORDER_PRODUCT_FK", "FINANCE_ORDER_FK")),
)
_on_warehouse("range_audit", analytics.range_audit)
_query(_quarantine_inventory, "quarantine_inventory")
_on_warehouse("control_listing", lambda wh: wh["etl_control"].orderBy("control_name"))

# --- Analytics -------------------------------------------------------------------

_on_warehouse("kpi_orders", analytics.kpi_orders)
_on_warehouse("kpi_finance", analytics.kpi_finance)
_on_warehouse("kpi_support", analytics.kpi_support)
_query(lambda ws: ws.overall, "kpi_overall")
_query(lambda ws: ws.score, "quality_score")
_on_warehouse("monthly_orders", analytics.monthly_orders)
_on_warehouse("monthly_finance", analytics.monthly_finance)
_on_warehouse("monthly_support", analytics.monthly_support)
_on_warehouse("monthly_trends", analytics.monthly_trends)
_on_warehouse("category_performance", analytics.category_performance)
_on_warehouse("category_performance_grain_safe", lambda wh: analytics.category_performance(wh, grain_safe=True))
_on_warehouse("segment_metrics", analytics.segment_metrics)
_on_warehouse("dashboard_dataset", analytics.dashboard_dataset)
_on_warehouse("dashboard_dataset_grain_safe", lambda wh: analytics.dashboard_dataset(wh, grain_safe=True))
_query(lambda ws: analytics.pick_highlights(ws.categories, ws.segments, ws.months), "highlights")
_on_warehouse("executive_kpis", analytics.executive_kpis)
_on_warehouse("category_rank_share", analytics.category_rank_share)
_on_warehouse("segment_having", analytics.segment_having)
_on_warehouse("sla_by_priority", analytics.sla_by_priority)
_on_warehouse("enriched_orders", analytics.enriched_order_summary)
_on_warehouse("finance_variance", analytics.finance_variance)
_on_warehouse("mom_growth", analytics.mom_growth)
_on_warehouse("top_customers", analytics.top_customers)
_query(lambda ws: analytics.exception_summary(ws.issue_counts), "exception_summary")
_query(lambda ws: analytics.exception_rank(ws.issue_counts), "exception_rank")

# --- Reports --------------------------------------------------------------------

_query(lambda ws: reports.kpi_summary(ws.overall), "kpi_summary")
_query(lambda ws: reports.top_issues(ws.issue_counts), "top_issues")
_query(lambda ws: reports.control_outcomes(ws.controls), "control_outcomes")
_query(lambda ws: reports.publish_status(ws.issue_counts, ws.balances), "publish_status")
_query(
    lambda ws: reports.findings(ws.overall, ws.issue_counts, ws.months),
    "findings",
)


def _report_facts(ws: Workspace) -> DataFrame:
    return reports.report_facts(
        ws.overall, ws.totals, ws.issue_counts, ws.controls, ws.balances, ws.categories, ws.segments, ws.months,
    )


_query(_report_facts, "report_facts")

# --- Sources in which every rule hits, and damaged tables ---------------------------

DIRTY = (
    "dq_duplicates", "dq_missing_required", "dq_invalid_fk", "dq_issues", "dq_exceptions", "dq_controls",
    "dq_quarantine_ids", "dq_issue_map", "wh_dim_customer", "wh_dim_product", "wh_fact_order", "wh_fact_support_ticket",
    "wh_fact_finance", "quarantine_orders", "quarantine_tickets", "quarantine_finance", "recon_controls", "etl_counts",
    "recon_rows", "constraint_audit", "category_performance", "category_performance_grain_safe", "dashboard_dataset",
    "finance_variance", "sla_by_priority", "profile_columns", "publish_status",
)
for _name in DIRTY:
    QUERIES[f"dirty_{_name}"] = lambda spark, sf_dir, build=_builds[_name]: build(workspace(spark, sf_dir, DIRTY_RECIPES))

DAMAGED: dict[str, Callable[[Warehouse], DataFrame]] = {
    "constraint_audit": lambda wh: audit.constraint_audit(wh.tables),
    "key_audit": lambda wh: audit.key_audit(wh.tables),
    "reference_audit": lambda wh: audit.reference_audit(wh.tables),
    "range_audit": analytics.range_audit,
}
for _name, _audit in DAMAGED.items():
    _query(lambda ws, check=_audit: check(ws.damaged), f"damaged_{_name}")

# --- The published warehouse ----------------------------------------------------------


def _inventory(wh: Warehouse) -> DataFrame:
    """Rows of every published table."""
    return reduce(
        DataFrame.unionAll,
        [wh[name].agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name in schemas.WAREHOUSE],
    )


_query(lambda ws: _inventory(ws.published), "published_inventory")
for _name, _table in {
    "orders": "fact_order", "tickets": "fact_support_ticket", "ledger": "fact_finance_transaction",
    "order_quarantine": "order_quarantine", "exceptions": "data_quality_exception", "controls": "etl_control",
}.items():
    _query(lambda ws, table=_table: ws.published[table], f"published_{_name}")
_query(lambda ws: analytics.category_performance(ws.published), "published_categories")
_query(lambda ws: analytics.segment_metrics(ws.published), "published_segments")
