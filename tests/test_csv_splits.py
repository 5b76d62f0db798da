"""CSV with line breaks in quotes, in many splits, against Python's reader."""

import csv
import random

import pytest

from cleargrain.functions import fixed
from cleargrain.sources import csv_splits, raw

NAMES = ["key", "text", "more"]
PARTS = ["a", "bc", "é", " ", ",", '"', '""', "\n", "\n\n", "x\ny", "'", "\\", ";", "long " * 30]


@pytest.fixture
def small_splits(spark):
    """Splits of ``size`` bytes, many of them to a file of some kilobytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}

    def put(size):
        for name, value in zip(names, (size, 0), strict=True):
            spark.conf.set(name, str(value))

    yield put
    for name, value in before.items():
        spark.conf.set(name, value)


def write(path, rows, names=NAMES, **how):
    with open(path, "w", newline="", encoding="utf-8") as handle:
        writer = csv.writer(handle, **how)
        writer.writerow(names)
        writer.writerows(rows)


def expected(path):
    with open(path, newline="", encoding="utf-8") as handle:
        return [tuple(row.values()) for row in csv.DictReader(handle)]


def odd_rows(seed, count):
    rng = random.Random(seed)
    return [(str(n), "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))), rng.choice(["", "z", "q\nq"])) for n in range(count)]


@pytest.mark.parametrize("size", [40, 333, 5000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_over_many_splits(spark, folder, small_splits, size, end):
    small_splits(size)
    path = f"{folder}/t.csv"
    write(path, odd_rows(size, 150), lineterminator=end, quoting=csv.QUOTE_ALL)
    frame = csv_splits.read(spark, path)
    assert frame.rdd.getNumPartitions() > 1
    got = [tuple(x or "" for x in r[3:]) for r in sorted(frame.collect(), key=lambda r: (r["file"], r["block"], r["line"]))]
    assert got == expected(path)


def test_a_field_over_many_whole_splits(spark, folder, small_splits):
    small_splits(30)
    path = f"{folder}/t.csv"
    long = "\n".join(f'line {n}, "quoted"' for n in range(200))
    write(path, [("1", long, "x"), ("2", "b", long), ("3", "", "\n"), ("4", "plain", "end")])
    rows = sorted(csv_splits.read(spark, path).collect(), key=lambda r: (r["block"], r["line"]))
    assert [(r["key"], r["text"] or "", r["more"]) for r in rows] == expected(path)


def test_several_files_blank_lines_and_short_records(spark, folder, small_splits):
    small_splits(64)
    for n in range(3):
        with open(f"{folder}/part-{n}.csv", "w", encoding="utf-8") as handle:
            handle.write(f'\n{",".join(NAMES)}\n\n{n},"a\n\nb"\n   \n{n}x,"c ""d"" e",f,too many\n{n}y,"",\n' if n else f'{",".join(NAMES)}\n0,"a\n\nb"\n0y,"",')
    rows = sorted(csv_splits.read(spark, folder).collect(), key=lambda r: (r["file"], r["block"], r["line"]))
    assert [(r["key"], r["text"], r["more"]) for r in rows] == [
        ("0", "a\n\nb", None), ("0y", None, None), ("1", "a\n\nb", None), ("1x", 'c "d" e', "f"), ("1y", None, None),
        ("2", "a\n\nb", None), ("2x", 'c "d" e', "f"), ("2y", None, None),
    ]
    write(f"{folder}/part-9.csv", [], names=["key", "other", "more"])
    with pytest.raises(ValueError, match="disagree"):
        csv_splits.read(spark, folder)


def test_no_record_and_no_file(spark, folder, small_splits):
    write(f"{folder}/t.csv", [])
    assert csv_splits.read(spark, f"{folder}/t.csv").count() == 0


def test_quotes_inside_fields_are_left_to_the_other_reader(spark, folder):
    path = f"{folder}/customers.csv"
    columns = fixed.RAW_COLUMNS["customers"]
    values = [["1", 'a 5" pipe', *["x"] * (len(columns) - 2)], ["2", "b\nb", *["x"] * (len(columns) - 2)]]
    with open(path, "w", encoding="utf-8") as handle:
        handle.write(",".join(columns) + "\n" + ",".join(values[0]) + "\n" + ",".join(['"' + x + '"' for x in values[1]]) + "\n")
    assert csv_splits.read(spark, path) is None
    rows = raw.read_csv(spark, "customers", path).orderBy(raw.ROW_ORDER).collect()
    assert [list(r)[:-1] for r in rows] == values


def test_other_splits_are_noticed(spark, folder, small_splits):
    path = f"{folder}/t.csv"
    write(path, odd_rows(1, 80))
    small_splits(100)
    state = csv_splits.begins_inside(csv_splits._lines(spark, path))
    small_splits(270)
    lines = csv_splits._lines(spark, path)
    with pytest.raises(Exception, match="no longer those"):
        lines.mapInArrow(lambda batches: csv_splits._joined(batches, state), csv_splits._SCHEMA).collect()


def test_the_pass_that_reads_has_no_shuffle(spark, folder, small_splits):
    """Unless a split begins inside a field, records leave the tasks that read them."""
    write(f"{folder}/t.csv", [(str(n), "plain", "x") for n in range(50)])
    small_splits(100)
    plan = csv_splits.read(spark, f"{folder}/t.csv")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
