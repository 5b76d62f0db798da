from collections import Counter
from decimal import Decimal

import pytest

from cleargrain.functions import fixed
from cleargrain.operators import profile
from cleargrain.plans.staging import Staging
from cleargrain.sources import raw, sinks


def by_hand(records, key):
    """The profile as a plain loop over a small table."""
    columns = {}
    for name in records[0]:
        values = [record[name] for record in records if record[name] not in (None, "")]
        counts = Counter(values)
        try:
            numbers = [Decimal(value) for value in values]
        except ArithmeticError:
            numbers = []
        columns[name] = (
            len(records) - len(values), len(counts), len(values) - len(counts),
            min(values, default=None), max(values, default=None), len(numbers) or None,
            round(float(sum(numbers)), 2) if numbers else None,
            sorted(counts.items(), key=lambda pair: (-pair[1], pair[0]))[:10],
        )
    whole = len(records) - len({tuple(record.items()) for record in records})
    keys = Counter(record[key] for record in records if record[key])
    return len(records), whole, sum(count > 1 for count in keys.values()), columns


def test_profile_equals_a_plain_loop(spark, make_sources):
    changes = [{"order_id": f"O{n % 40}", "customer_id": f"C{n % 13}" if n % 5 else "",
                "order_amount": f"{n % 7}.50", "quantity": "many" if n == 3 else str(n % 4)} for n in range(60)]
    sources = make_sources(orders=changes)
    records = [{name: row[name] for name in fixed.RAW_COLUMNS["orders"]} for row in sources["orders"].collect()]
    total, whole, repeated, columns = by_hand(records, "order_id")
    table = profile.profile_tables({"orders": sources["orders"]}).first()
    assert (table.row_count, table.duplicate_row_count, table.duplicate_primary_key_count) == (total, whole, repeated)
    tops = {}
    for row in profile.top_values({"orders": sources["orders"]}).orderBy("column_name", "rank").collect():
        tops.setdefault(row.column_name, []).append((row.value, row.value_count))
    for row in profile.profile_columns({"orders": sources["orders"]}).collect():
        expected = columns[row.column_name]
        assert (row.null_count, row.unique_count, row.duplicate_value_count, row.min_value, row.max_value,
                row.numeric_count, row.numeric_sum, tops.get(row.column_name, [])) == expected


def test_empty_table_profile(spark, make_sources):
    empty = {"customers": make_sources()["customers"].limit(0)}
    row = profile.profile_tables(empty).first()
    assert (row.row_count, row.column_count, row.duplicate_row_count) == (0, 0, 0)
    assert profile.profile_columns(empty).isEmpty()


def write_folder(folder):
    texts = {
        "customers": 'customer_id,customer_name,customer_segment,region,created_date,crm_status,source_system\n'
                     'C1,"Smith, ""Jo""",SMB,,2025-01-01,ACTIVE,CRM\n\nC1,second,SMB,EAST,2025-01-01,ACTIVE,CRM\n',
        "products": "product_id,product_name,product_category,unit_price,unit_cost,active_flag\nP1,Tool,SOFTWARE,10,4,Y\n",
        "orders": "order_id,customer_id,product_id,order_date,quantity,unit_price,discount_rate,order_amount,order_status,channel\n"
                  "O1,C1,P1,2025-01-15,2,100.00,0.10,180.00,COMPLETED,DIRECT\n",
        "support_tickets": "ticket_id,customer_id,opened_at,resolved_at,ticket_status,priority,issue_category,satisfaction_score\n"
                           "T1,C1,2025-01-01T10:00,,OPEN,LOW,ACCESS\n",
        "finance_transactions": "finance_transaction_id,order_id,posted_date,transaction_type,transaction_amount,currency,posting_status\n"
                                "F1,O1,2025-01-16,SALE,180.00,USD,POSTED\n",
    }
    for name, text in texts.items():
        with open(f"{folder}/{name}.csv", "w", encoding="utf-8") as handle:
            handle.write(text)


def test_csv_sources_keep_file_order(spark, folder):
    write_folder(folder)
    sources = raw.load_csv_folder(spark, folder)
    assert raw.data_columns(sources["customers"])[-1] == "source_system"
    staging = Staging(spark, sources)
    customers = staging.validated("customers").collect()
    assert [(row.customer_name, row.region, row.copies) for row in customers] == [('Smith, "Jo"', "UNKNOWN", 2)]
    assert staging.validated("support_tickets").first().satisfaction_score is None
    staging.require_no_critical()


def test_missing_column_is_refused(spark, folder):
    with open(f"{folder}/orders.csv", "w", encoding="utf-8") as handle:
        handle.write("order_id,customer_id\nO1,C1\n")
    with pytest.raises(raw.SourceError, match="product_id"):
        raw.read_csv(spark, "orders", f"{folder}/orders.csv")


def test_parquet_sources_rank_by_given_columns(spark, folder, make_sources):
    table = make_sources(customers=[{"customer_name": "late"}, {"customer_name": "early"}])["customers"]
    table.selectExpr("* except (row_order)", "if(customer_name = 'late', 2, 1) AS seen").write.parquet(f"{folder}/c")
    source = raw.as_source("customers", spark.read.parquet(f"{folder}/c"), ["seen"])
    staging = Staging(spark, {**make_sources(), "customers": source})
    assert staging.validated("customers").first().customer_name == "early"


def test_reports_are_one_headed_file_and_never_empty(spark, folder):
    frame = spark.createDataFrame([("b", 2), ("a", 1)], "name string, n int")
    sinks.write_csv_report(frame.repartition(2), f"{folder}/report", ("name",))
    assert [tuple(r) for r in spark.read.option("header", True).csv(f"{folder}/report").collect()] == [("a", "1"), ("b", "2")]
    with pytest.raises(ValueError, match="empty"):
        sinks.write_csv_report(frame.limit(0), f"{folder}/none")
    sinks.write_json(frame, f"{folder}/json")
    assert spark.read.json(f"{folder}/json").count() == 2


def test_profile_of_very_wide_numbers(spark, make_sources):
    """Eighteen-digit ids over a thousand rows, and a cell of 21 digits, as ``Decimal`` has them."""
    ids = [str(10**17 + n * 7) for n in range(1000)]
    wide = ["123456789012345678901", "0.5", "-2"]
    sources = make_sources(orders=[
        {"order_id": value, "quantity": wide[n % 3], "discount_rate": "1e400" if n == 5 else "1"} for n, value in enumerate(ids)])
    found = {r.column_name: r for r in profile.profile_columns({"orders": sources["orders"]}).collect()}
    total = sum(map(Decimal, ids))
    assert found["order_id"].numeric_sum == float(total)
    assert found["order_id"].numeric_mean == float(round(total / 1000, 4))
    numbers = [Decimal(wide[n % 3]) for n in range(1000)]
    quantity = found["quantity"]
    assert (quantity.numeric_count, quantity.numeric_min, quantity.numeric_max) == (1000, -2.0, float(max(numbers)))
    assert quantity.numeric_sum == float(sum(numbers)) and quantity.numeric_mean == float(sum(numbers) / 1000)
    assert found["discount_rate"].numeric_count == 1000


def test_wide_amounts_are_judged_as_numbers(spark, make_sources):
    staging = Staging(spark, make_sources(orders=[{"order_amount": "123456789012345678901", "quantity": "3000000000"}]))
    assert [r.issue_type for r in staging.issues().where("dataset = 'orders'").collect()] == ["UNUSUAL_NUMERIC_VALUE"]
    assert staging.validated("orders").first().quantity == 3_000_000_000


def test_line_breaks_in_quoted_fields(spark, folder):
    path = f"{folder}/customers.csv"
    with open(path, "w") as out:
        out.write(",".join(fixed.RAW_COLUMNS["customers"]) + "\n")
        out.write('K-1,"Line\nbreak ""and"" more",SMB,EAST,2024-01-01,ACTIVE\n\nK-2,short,SMB\n')
    rows = raw.read_csv(spark, "customers", path).orderBy("customer_id").collect()
    assert [(r.customer_id, r.customer_name, r.region) for r in rows] == [
        ("K-1", 'Line\nbreak "and" more', "EAST"), ("K-2", "short", None)]
    with pytest.raises(raw.SourceError, match="quoted line breaks"):
        raw.read_csv(spark, "customers", path, multi_line=False)
