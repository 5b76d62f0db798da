"""The whole run: land, profile, validate, publish, analyse, report."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from cleargrain.operators import profile
from cleargrain.plans import analytics, reports, storage
from cleargrain.plans.staging import Staging
from cleargrain.plans.warehouse import StagedWarehouse, Warehouse, publish
from cleargrain.sources.sinks import write_csv_report, write_json


@dataclass(frozen=True)
class Run:
    warehouse: Warehouse
    reports: str


def run_pipeline(spark: SparkSession, sources: Mapping[str, DataFrame], target: str, run_id: str) -> Run:
    """Publish a warehouse version and its reports under ``target``.

    Each source is read once and landed; each report frame is computed once.
    Reports are written after publication and read the staged tables, whose
    enriched grains need no joins. Any failed control stops the run first. The
    landed and staged tables are deleted at the end, also after a failure.
    """
    work = storage.fresh_folder(spark, "run")
    try:
        builders = {name: partial(sources.__getitem__, name) for name in sources}
        landed = storage.Landed(f"{work}/sources", builders).land()
        staging = Staging(spark, landed, f"{work}/staging")
        published = publish(staging, target, run_id)
        folder = f"{target}/reports/{run_id}"
        _write_reports(staging, landed, published, storage.Shelf(f"{work}/frames"), folder)
        return Run(published, folder)
    finally:
        storage.discard(spark, work)


def _write_reports(
    staging: Staging, sources: Mapping[str, DataFrame], published: Warehouse, shelf: storage.Shelf, folder: str
) -> None:
    staged, balanced = StagedWarehouse(staging), published["etl_control"]
    counts, issues = shelf.get("counts", staging.counts), shelf.get("issue_counts", staging.issue_counts)
    controls = shelf.get("controls", staging.controls)
    score = analytics.quality_score(analytics.quality_inputs(counts, issues))
    overall = shelf.get("overall", lambda: analytics.kpi_overall(staged, score))
    months = shelf.get("months", lambda: analytics.monthly_trends(staged))
    categories = shelf.get("categories", lambda: analytics.category_performance(staged))
    segments = shelf.get("segments", lambda: analytics.segment_metrics(staged))
    tables = shelf.get("profile_tables", lambda: profile.profile_tables(sources))
    totals = shelf.get("profile_totals", lambda: profile.profile_totals(sources, tables))
    status = shelf.get("status", lambda: reports.publish_status(issues, balanced))

    write_csv_report(reports.kpi_summary(overall), f"{folder}/kpi_summary.csv")
    write_csv_report(months, f"{folder}/monthly_trends.csv", ("reporting_month",))
    write_csv_report(
        analytics.dashboard_dataset(staged), f"{folder}/dashboard_dataset.csv", ("reporting_month", "product_category")
    )
    facts = reports.report_facts(overall, totals, issues, controls, balanced, categories, segments, months)
    write_csv_report(facts, f"{folder}/report_facts.csv")
    write_csv_report(reports.findings(overall, issues, months), f"{folder}/findings.csv", ("finding_no",))
    write_csv_report(reports.top_issues(issues), f"{folder}/top_issues.csv")
    evidence = {
        "status": status, "counts": counts, "issue_counts": reports.issue_type_counts(issues),
        "validation_controls": controls, "reconciliation_controls": balanced,
        "exceptions": published["data_quality_exception"],
    }
    for name, frame in evidence.items():
        write_json(frame, f"{folder}/data_quality/{name}")

    def values(dataset: str, source: DataFrame) -> DataFrame:
        return shelf.get(f"values_{dataset}", lambda: profile.value_counts(dataset, source))

    parts = {
        "tables": tables, "columns": profile.profile_columns(sources, values),
        "top_values": profile.top_values(sources, values), "totals": totals,
    }
    for name, frame in parts.items():
        write_json(frame, f"{folder}/data_profile/{name}")
