"""Record-level checks usable on any table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cleargrain.functions.clean import is_blank
from cleargrain.plans import storage

#: So many hashes are broadcast, 8 bytes each; beyond that rows meet them in a shuffle.
_MOST_HASHES = 1_000_000

#: One side of a join is broadcast with so many rows at most, whatever the size of its files.
_MOST_PARENTS = 100_000


#: Hashes have so many bits; the lower ones travel as 4 bytes each, in arrays by the others.
_HASH_BITS, _LOW_BITS = 44, 32


def key_hash(*columns: str) -> Column:
    """A hash for ``repeated_hashes``: equal values have equal hashes."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << _HASH_BITS))


def times_counted(frame: DataFrame, column: str) -> DataFrame:
    """Values of a column of ``key_hash`` that come more than once.

    Hashes meet as arrays of their lower bits, 4 bytes each. Those that would fill an
    array by themselves are known beforehand and stay out of it.
    """
    often = [row.item for row in _frequent(frame, column).where("count > 1").collect()]
    low, value = 1 << _LOW_BITS, F.col(column)
    arrays = (
        frame.where(~value.isin(often))
        .select(F.shiftright(value, _LOW_BITS).alias("_high"), (F.pmod(value, F.lit(low)) - low // 2).cast("int").alias("_low"))
        .groupBy("_high")
        .agg(F.collect_list("_low").alias("_lows"))
    )
    found = arrays.select("_high", F.explode("_lows").alias("_low")).groupBy("_high", "_low").agg(F.count(F.lit(1)).alias("_times"))
    rare = found.where("_times > 1").select((F.col("_high") * low + F.col("_low") + low // 2).alias(column))
    return rare.unionAll(frame.sparkSession.createDataFrame([(item,) for item in often], f"{column} long"))


def if_few(hashes: DataFrame) -> DataFrame:
    """Written hashes, marked for a broadcast unless there are too many."""
    return F.broadcast(hashes) if hashes.count() <= _MOST_HASHES else hashes.hint("merge")


def met_by_key(side: DataFrame, rows: DataFrame) -> DataFrame:
    """One side of a join by key, shuffled unless ``rows``, which has as many rows or more, has few.

    Spark takes a table for small by the size of its files. Packed columns are
    many times larger as rows, and the driver holds all that is broadcast.
    """
    return side if rows.count() <= _MOST_PARENTS else side.hint("merge")


def repeated_hashes(frame: DataFrame, column: str) -> DataFrame:
    """Values of a column of ``key_hash`` that come more than once, written once.

    Every repeated key has such a hash. Few other keys do, so what rows carry besides
    their hash stays where it is unless their key is likely to repeat.
    """
    found = times_counted(frame, column)
    return if_few(storage.write_then_read(found, storage.fresh_folder(frame.sparkSession, "repeated")))


def find_duplicates(frame: DataFrame, key: str) -> DataFrame:
    """Populated key values that occur more than once: ``key_value, copies``.

    Hashes of all keys are counted, then the keys themselves of the repeated hashes.
    Partial counts run before both shuffles, so a key holding most of the table
    travels as one row per task.
    """
    held = frame.where(~is_blank(F.col(key))).select(F.col(key).alias("key_value"), key_hash(key).alias("_hash"))
    return count_repeated(held.join(repeated_hashes(held, "_hash"), "_hash", "left_semi"), "key_value")


def count_repeated(frame: DataFrame, key: str) -> DataFrame:
    """As ``find_duplicates``, in one pass in which every key travels."""
    return (
        frame.where(~is_blank(F.col(key)))
        .groupBy(F.col(key).alias("key_value"))
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )


def missing_required(frame: DataFrame, required: Sequence[str], key: str) -> DataFrame:
    """One row per record lacking a required field: ``record_id, fields``."""
    absent = [F.when(is_blank(F.col(name)), F.lit(name)) for name in required]
    any_blank = F.lit(False)
    for name in required:
        any_blank = any_blank | is_blank(F.col(name))
    return frame.where(any_blank).select(
        F.coalesce(F.col(key), F.lit("MISSING_KEY")).alias("record_id"),
        F.array_compact(F.array(*absent)).alias("fields"),
    )


def invalid_references(
    child: DataFrame, field: str, parent: DataFrame, parent_key: str, key: str
) -> DataFrame:
    """Records whose populated foreign key is absent from the parent table.

    A blank key is not an invalid one.
    """
    held = child.where(~is_blank(F.col(field))).select(F.col(key).alias("record_id"), F.col(field).alias("value"))
    known = parent.select(F.col(parent_key).alias("parent_value")).distinct()
    checked = lookup(held, "value", "record_id", known, "parent_value", {}, "known", hot_keys(held, "value"), counted=parent)
    return checked.where(~F.col("known")).select("record_id", "value")


def keyed(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The frame with ``_key0``... (blank text is one key) and their ``_hash``."""
    text_keys = {name for name, kind in frame.dtypes if kind == "string"}
    names = [f"_key{n}" for n in range(len(keys))]
    named = frame.select(
        "*",
        *[(F.coalesce(F.col(key), F.lit("")) if key in text_keys else F.col(key)).alias(name) for key, name in zip(keys, names, strict=True)],
    )
    return named.withColumn("_hash", key_hash(*names))


def keep_first(
    frame: DataFrame, keys: Sequence[str], order_by: Sequence[str], dropped: Mapping[str, Column] | None = None,
    repeated: DataFrame | None = None,
) -> DataFrame:
    """First row of every key in the given order, with ``copies`` per key.

    ``dropped`` names sums over the rows that are not kept: decimals of a row, added up
    in the same step. ``repeated`` holds the repeated hashes of the ``keyed`` frame where
    they were counted before.

    Hashes of the keys are counted on their own, combined before the shuffle. Rows
    whose hash comes once pass through as they are; only the others meet, by their
    keys, as partial minima of whole rows, ordering columns first. Remaining
    columns break ties, so the choice never depends on partitioning, and a key
    that holds a third of the rows never gathers in one task. Blank text keys
    count as one key.
    """
    rows, names = keyed(frame, keys), [f"_key{n}" for n in range(len(keys))]
    if repeated is None:
        repeated = repeated_hashes(rows, "_hash")
    sums = dropped or {}
    nothing = [F.lit(0).cast("decimal(38,0)").alias(name) for name in sums]
    once = rows.join(repeated, "_hash", "left_anti").select(*frame.columns, F.lit(1).cast("bigint").alias("copies"), *nothing)
    ranked = [*order_by, *[column for column in frame.columns if column not in order_by]]
    several = (
        rows.join(repeated, "_hash", "left_semi")
        .groupBy(*names)
        .agg(F.min(F.struct(*ranked)).alias("first"), F.count(F.lit(1)).alias("copies"), *[F.sum(value).alias(name) for name, value in sums.items()])
        .select(*[f"first.{column}" for column in frame.columns], "copies", *sums)
        .withColumns({name: (F.col(name) - value).cast("decimal(38,0)") for name, value in sums.items()})
    )
    return once.unionByName(several)


# What the frequent-items sketch can list and track.
_MOST_LISTED, _MOST_TRACKED = 1000, 1_000_000


def hot_share(spark: SparkSession) -> int:
    """A key with one row in this many would fill a shuffle partition by itself."""
    return max(32, min(_MOST_LISTED, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def hot_keys(frame: DataFrame, key: str) -> DataFrame:
    """Keys that would fill a partition: ``hot_key``, at most ``hot_share`` rows.

    A frequent-items sketch reads one column and keeps a fixed number of
    counters per task, far more than needed to catch every key this frequent.
    It only decides how rows travel; results never depend on it.
    """
    return _frequent(frame.where(~is_blank(F.col(key))), key).select(F.col("item").alias("hot_key"))


def _frequent(frame: DataFrame, column: str) -> DataFrame:
    """Values that hold a ``hot_share`` of the rows or more, and their number: ``item, count``."""
    share = hot_share(frame.sparkSession)
    tracked = min(_MOST_TRACKED, 16 * share)
    return (
        frame.selectExpr(f"approx_top_k({column}, {share}, {tracked}) AS top", "count(*) AS total")
        .selectExpr("inline(top)", "total")
        .where(F.col("count") * share >= F.col("total"))
    )


def lookup(
    facts: DataFrame, fact_key: str, record_key: str, parents: DataFrame, parent_key: str,
    carry: dict[str, str], found: str, hot: DataFrame, counted: DataFrame | None = None,
) -> DataFrame:
    """Left-join the parent's ``carry`` columns and a ``found`` flag onto facts.

    Parent keys are unique. Rows of a hot key take their parent from a
    broadcast of the few hot parents; those rows and rows with a blank key are
    then spread over the shuffle join by their own record key, so no partition
    gathers them. All other rows join by key as usual, and carry it once; more
    than a few parents are not broadcast. ``counted`` has as many rows as the parents
    or more, where it is cheaper to count.
    """
    apart = is_blank(F.col(fact_key)) | F.col("hot_key").isNotNull()
    known = parents.where(~is_blank(F.col(parent_key))).select(
        F.col(parent_key).alias("_parent"), *[F.col(source).alias(f"_{target}") for source, target in carry.items()]
    )
    hot_known = known.join(F.broadcast(hot), F.col("_parent") == F.col("hot_key")).select(
        "hot_key", F.lit(True).alias("_hot_hit"),
        *[F.col(f"_{target}").alias(f"_hot_{target}") for target in carry.values()],
    )
    # Both sides hold at most ``hot_share`` rows: parent keys are unique.
    hot_table = hot.join(F.broadcast(hot_known), "hot_key", "left")
    spread = F.concat(F.lit("\u0000"), F.coalesce(F.col(record_key), F.lit("")))
    return (
        facts.join(F.broadcast(hot_table), F.col(fact_key) == F.col("hot_key"), "left")
        .withColumns({"_apart": apart, "_lookup": F.when(apart, spread).otherwise(F.col(fact_key)), "_held": F.when(apart, F.col(fact_key))})
        .drop(fact_key, "hot_key")
        .join(
            met_by_key(known.withColumnRenamed("_parent", "_lookup").withColumn("_hit", F.lit(True)), parents if counted is None else counted),
            "_lookup", "left",
        )
        .withColumns({
            "_cold": F.coalesce(F.col("_hit"), F.lit(False)) & ~F.col("_apart"),
            fact_key: F.when(F.col("_apart"), F.col("_held")).otherwise(F.col("_lookup")),
        })
        .select(
            *facts.columns,
            *[
                F.when(F.col("_cold"), F.col(f"_{target}")).otherwise(F.col(f"_hot_{target}")).alias(target)
                for target in carry.values()
            ],
            (F.col("_cold") | F.coalesce(F.col("_hot_hit"), F.lit(False))).alias(found),
        )
    )
