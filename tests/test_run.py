import os

from test_profile_and_files import write_folder

from cleargrain.plans.pipeline import run_pipeline
from cleargrain.plans.warehouse import open_latest
from cleargrain.sources.raw import load_csv_folder


def test_whole_run_from_csv(spark, folder):
    os.makedirs(f"{folder}/in")
    write_folder(f"{folder}/in")
    run = run_pipeline(spark, load_csv_folder(spark, f"{folder}/in"), f"{folder}/out", "r1")
    assert sorted(name for name in os.listdir(run.reports) if not name.startswith(".")) == [
        "dashboard_dataset.csv", "data_profile", "data_quality", "findings.csv", "kpi_summary.csv", "monthly_trends.csv",
        "report_facts.csv", "top_issues.csv",
    ]
    kpis = {r.kpi_name: r.kpi_value for r in spark.read.option("header", True).csv(f"{run.reports}/kpi_summary.csv").collect()}
    assert len(kpis) == 14 and kpis["net_revenue"] == "180.0" and kpis["order_count"] == "1.0"
    facts = {r.fact: r.value for r in spark.read.option("header", True).csv(f"{run.reports}/report_facts.csv").collect()}
    assert facts["net_revenue"] == "$180.00" and facts["loaded_orders"] == "1" and facts["raw_rows"] == "6"
    assert spark.read.json(f"{run.reports}/data_quality/status").first().status == "PASS"
    assert open_latest(spark, f"{folder}/out")["fact_order"].count() == 1
