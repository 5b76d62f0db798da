import json
import os
import threading

import pytest

from cleargrain.operators.reconcile import DataQualityError
from cleargrain.plans import warehouse
from cleargrain.plans.staging import Staging
from cleargrain.sources import files, sinks


@pytest.fixture(scope="module")
def staging(spark, make_sources):
    return Staging(spark, make_sources())


def together(tasks):
    """Run all at once; what each returned or raised."""
    start, out = threading.Barrier(len(tasks)), [None] * len(tasks)

    def run(place, task):
        start.wait()
        try:
            out[place] = task()
        except Exception as problem:
            out[place] = problem

    threads = [threading.Thread(target=run, args=pair) for pair in enumerate(tasks)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    return out


def test_one_writer_creates_a_file(spark, folder):
    made = together([lambda n=n: files.create_once(spark, f"{folder}/deep/one", f"writer {n}") for n in range(16)])
    assert sorted(made) == [False] * 15 + [True]
    assert files.read_text(spark, f"{folder}/deep/one") == f"writer {made.index(True)}"
    assert os.listdir(f"{folder}/deep") == ["one"]


def test_announcements_at_once_are_one_order(spark, folder):
    numbers = together([lambda n=n: warehouse.announce(spark, folder, f"run-{n}") for n in range(12)])
    assert sorted(numbers) == list(range(1, 13))
    listed = warehouse.publications(spark, folder)
    assert listed == sorted(((number, f"run-{n}") for n, number in enumerate(numbers)), reverse=True)
    assert warehouse.publications(spark, folder, last=2) == listed[:2]


def test_two_publications_at_once(spark, staging, folder):
    done = together([lambda name=name: warehouse.publish(staging, folder, name) for name in ("left", "right")])
    assert all(isinstance(x, warehouse.Warehouse) for x in done), done
    listed = warehouse.publications(spark, folder)
    assert [number for number, _ in listed] == [2, 1] and {name for _, name in listed} == {"left", "right"}
    assert warehouse.open_latest(spark, folder)["fact_order"].inputFiles()[0].count(f"/versions/{listed[0][1]}/")


def test_one_name_is_published_once(spark, staging, folder):
    done = together([lambda: warehouse.publish(staging, folder, "same") for _ in range(2)])
    refused = [x for x in done if isinstance(x, DataQualityError)]
    assert len(refused) == 1 and "same" in str(refused[0])
    with pytest.raises(DataQualityError, match="same"):
        warehouse.publish(staging, folder, "same")
    assert warehouse.publications(spark, folder) == [(1, "same")]
    assert warehouse.open_latest(spark, folder)["fact_order"].count() == 1


def test_failed_run_leaves_nothing_and_may_try_again(spark, staging, make_sources, folder):
    broken = Staging(spark, make_sources(orders=[{}, {"order_id": "B-902", "channel": "FAX"}]))
    with pytest.raises(DataQualityError, match="channel"):
        warehouse.publish(broken, folder, "daily")
    assert os.listdir(f"{folder}/versions") == [] and os.listdir(f"{folder}/claims") == []
    with pytest.raises(DataQualityError, match="No published"):
        warehouse.open_latest(spark, folder)
    warehouse.publish(staging, folder, "daily")
    assert warehouse.publications(spark, folder) == [(1, "daily")]


def test_empty_number_announces_nothing(spark, folder):
    assert warehouse.announce(spark, folder, "one") == 1
    files.create_once(spark, f"{folder}/publications/000000000002.json", "")
    assert warehouse.publications(spark, folder) == [(1, "one")]
    assert warehouse.announce(spark, folder, "two") == 3


def test_retention_keeps_versions_and_runs_under_way(spark, folder):
    def claim(name, age=0):
        files.create_once(spark, f"{folder}/claims/{name}", "")
        files.create_once(spark, f"{folder}/versions/{name}/fact_order/part", name)
        past = os.stat(f"{folder}/claims/{name}").st_mtime - age
        os.utime(f"{folder}/claims/{name}", (past, past))

    for name in ("a", "b", "c", "d"):
        claim(name, age=10_000)
        warehouse.announce(spark, folder, name)
    claim("lost", age=10_000)
    claim("running")
    assert warehouse.retain(spark, folder, keep=2, abandoned_after=5_000) == ["a", "b", "lost"]
    assert sorted(os.listdir(f"{folder}/versions")) == ["c", "d", "running"]
    assert sorted(os.listdir(f"{folder}/claims")) == ["a", "b", "c", "d", "running"]
    assert warehouse.retain(spark, folder, keep=2, abandoned_after=5_000) == []
    assert [name for _, name in warehouse.publications(spark, folder)] == ["d", "c", "b", "a"]
    with pytest.raises(ValueError):
        warehouse.retain(spark, folder, keep=0)


def test_report_is_one_named_file(spark, folder):
    frame = spark.createDataFrame([("b", 'say "x", then\nstop'), ("a", None)], "name string, note string")
    sinks.write_csv_report(frame.repartition(2), f"{folder}/report.csv", ("name",))
    assert [name for name in os.listdir(folder) if not name.endswith(".crc")] == ["report.csv"]
    with open(f"{folder}/report.csv", encoding="utf-8") as file:
        assert file.read() == 'name,note\na,\nb,"say ""x"", then\nstop"\n'


def test_report_replaces_the_one_before_or_leaves_it(spark, folder):
    frame = spark.createDataFrame([(1,), (2,)], "n int")
    path = f"{folder}/report.csv"
    os.makedirs(f"{path}/from-an-older-release")
    for rows in (frame, frame.where("n = 2")):
        sinks.write_csv_report(rows, path)
    assert spark.read.option("header", True).csv(path).collect()[0].n == "2"
    with pytest.raises(ValueError, match="empty"):
        sinks.write_csv_report(frame.limit(0), path)
    with pytest.raises(Exception, match="no such value"):
        sinks.write_csv_report(frame.selectExpr("cast(raise_error('no such value') AS int) AS n"), path)
    assert spark.read.option("header", True).csv(path).collect()[0].n == "2"
    assert [name for name in os.listdir(folder) if not name.endswith(".crc")] == ["report.csv"]


def test_number_files_are_plain_json(spark, folder):
    warehouse.announce(spark, folder, 'quoted "name"')
    with open(f"{folder}/publications/000000000001.json", encoding="utf-8") as file:
        assert json.load(file) == {"run_id": 'quoted "name"'}
