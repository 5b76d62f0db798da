"""Where intermediate tables live: a folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections import defaultdict
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

#: Of tables on a shelf and of published ones.
COMPRESSION = "zstd"
_SETTING = "spark.checkpoint.dir"
_local_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a local one only on a local master."""
    global _local_folder
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"Set {_SETTING} to a folder all executors can reach")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="cleargrain-")
    return _local_folder


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/cleargrain/{purpose}-{uuid.uuid4().hex}"


def write_then_read(frame: DataFrame, path: str, **options: str) -> DataFrame:
    """Cut the lineage with a Parquet table; later reads prune its columns."""
    frame.write.mode("overwrite").options(**options).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a folder that ``fresh_folder`` named, with all that was written there."""
    if not folder.startswith(f"{shared_folder(spark)}/cleargrain/"):
        raise ValueError(f"{folder} is not a folder of this library")
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


class Shelf:
    """Tables written once each and read back, safe to ask from several threads."""

    def __init__(self, folder: str):
        self._folder = folder
        self._tables: dict[str, DataFrame] = {}
        self._locks: dict[str, Lock] = defaultdict(Lock)
        self._guard = Lock()

    def get(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        with self._guard:
            lock = self._locks[name]
        with lock:
            if name not in self._tables:
                self._tables[name] = write_then_read(build(), f"{self._folder}/{name}", compression=COMPRESSION)
            return self._tables[name]


class Landed(Mapping[str, DataFrame]):
    """Tables built from elsewhere, each written once on first use and read back after.

    Raw text is parsed, or derived, a single time; every later read is a plain
    columnar scan with its own column pruning and pushdown.
    """

    def __init__(self, folder: str, builders: Mapping[str, Callable[[], DataFrame]]):
        self._shelf, self._builders = Shelf(folder), dict(builders)

    def __getitem__(self, name: str) -> DataFrame:
        return self._shelf.get(name, self._builders[name])

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def land(self) -> Landed:
        at_once(*[partial(self.__getitem__, name) for name in self])
        return self


def at_once(*tasks: Callable[[], object]) -> None:
    """Submit independent jobs together, so one fills the cores another leaves idle."""
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(tasks)) as pool:
        for future in [pool.submit(inherit(task)) for task in tasks]:
            future.result()


def fingerprint(spark: SparkSession, path: str, names: tuple[str, ...]) -> tuple:
    """Size and change time of every input, to notice that tables were replaced."""
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs
    marks = []
    for name in names:
        location = hadoop.Path(f"{path}/{name}.parquet")
        files = location.getFileSystem(context._jsc.hadoopConfiguration())
        listed = files.listStatus(location)
        marks.append(
            (name, len(listed), sum(f.getLen() for f in listed), max((f.getModificationTime() for f in listed), default=0))
        )
    return tuple(marks)
