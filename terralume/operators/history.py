"""Versions of changing attributes from periodic snapshots, by Merkle comparison."""

from __future__ import annotations

import math
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terralume.functions.lineage import cut

#: Children of a node of the tree, and keys that a leaf bucket should hold.
FANOUT, KEYS_PER_LEAF = 16, 8
#: Sightings of a key that are put in order at a time: a period with more, in which the key changed, is cut into slices of its time.
MOST_SIGHTINGS = 1000


def tree_depth(keys: int, fanout: int = FANOUT, per_leaf: int = KEYS_PER_LEAF) -> int:
    """Levels below the root, so that a leaf bucket holds about ``per_leaf`` keys: leaves grow with the keys."""
    return max(1, math.ceil(math.log(max(1.0, keys / per_leaf), fanout)))


def merkle_leaves(df: DataFrame, group: list[str], leaf: str, before: str, after: str) -> DataFrame:
    """Leaf hashes of two trees for each group: the exclusive or of the hashes of the states in a bucket."""
    return df.groupBy(*group, leaf).agg(F.bit_xor(before).alias("before"), F.bit_xor(after).alias("after"))


def changed_leaves(leaves: DataFrame, group: list[str], leaf: str, depth: int, fanout: int = FANOUT) -> DataFrame:
    """``(group, leaf)`` of the leaves that differ, found from the roots down.

    The hashes of each level are those of the level below, put together; only children of a differing node
    are looked at. ``leaf`` counts from 0 to ``fanout ** depth - 1``.
    """
    levels = [leaves.withColumnRenamed(leaf, "node")]
    for _ in range(depth):
        levels.append(levels[-1].groupBy(*group, F.floor(F.col("node") / fanout).alias("node")).agg(F.bit_xor("before").alias("before"), F.bit_xor("after").alias("after")))
    reached = levels.pop().where("before <> after").select(*group, "node")
    while levels:
        children = levels.pop().where("before <> after").withColumn("parent", F.floor(F.col("node") / fanout))
        reached = children.join(reached.withColumnRenamed("node", "parent"), [*group, "parent"], "left_semi").select(*group, "node")
    return reached.withColumnRenamed("node", leaf)


def _sightings(df: DataFrame, key: list[str], at: str, value: str, written: str, row_id: str, usable: F.Column) -> DataFrame:
    """One row for each key and instant that counts: ``key, at, value``. Aggregated by both, so a key of many rows is many groups."""
    state = F.struct(F.col(written).alias("w"), F.col(row_id).alias("r"), F.col(value).alias("value"), F.coalesce(usable, F.lit(False)).alias("ok"))
    keyed = df.where(F.col(at).isNotNull()).select(*[F.coalesce(F.col(k), F.lit("")).alias(k) for k in key], F.col(at).alias("at"), state.alias("state"))
    return keyed.groupBy(*key, "at").agg(F.max("state").alias("state")).where("state.ok").select(*key, "at", F.col("state.value").alias("value"))


def _summary(df: DataFrame, by: list[str]) -> DataFrame:
    ends = [F.min(F.struct("at", "value")).alias("begin"), F.max(F.struct("at", "value")).alias("end")]
    return df.groupBy(*by).agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("*").alias("n"), *ends).select(*by, "lo", "hi", "n", F.col("begin.at").alias("begin_at"), F.col("end.at").alias("end_at"), F.col("end.value").alias("last"))


def version_history(df: DataFrame, key: list[str], at: str, value: str, written: str, row_id: str, usable: F.Column, snapshot: F.Column, most_sightings: int = MOST_SIGHTINGS) -> DataFrame:
    """One row for each version of ``value``: ``key``, ``value``, ``valid_from``, ``valid_to`` (null: still valid).

    Rows with the same key and ``at`` are one sighting, that of the latest ``written`` (ties: the larger
    ``row_id``), and it counts only if ``usable``. A version is a longest run of sightings with one value.

    ``snapshot`` cuts time into periods (an expression over ``at``). For each period and key the state before it (the last value seen
    earlier, however long ago) stands against the values seen in it; the key buckets of the two are compared as Merkle trees, and only
    periods of keys in leaf buckets that differ are looked into. There a period with more than ``most_sightings`` of a key is cut into
    slices of its time, and only slices in which something changed are put in order and compared sighting by sighting. So no task
    sorts more than a slice of one key, and windows over a key or period hold summaries. Null key parts are empty text; rows with a null ``at`` take no part;
    repeated rows change nothing. An empty table gives an empty table.
    """
    by_period = [*key, "period"]
    sightings = cut(_sightings(df, key, at, value, written, row_id, usable).withColumn("period", snapshot))
    carried = _summary(sightings, by_period).withColumn("before", F.lag("last").over(Window.partitionBy(*key).orderBy("period")))
    hashed = cut(carried.withColumn("key_hash", F.xxhash64(*key)).withColumns({"h_before": F.xxhash64("key_hash", F.col("before").cast("string")), "h_after": F.when(F.col("lo") == F.col("hi"), F.xxhash64("key_hash", F.col("lo").cast("string"))).otherwise(F.xxhash64("key_hash", F.lit("changed"), "lo", "hi"))}))
    depth = tree_depth(hashed.agg(F.approx_count_distinct("key_hash")).collect()[0][0])
    leaf = F.pmod("key_hash", F.lit(FANOUT**depth))
    leaves = cut(merkle_leaves(hashed.withColumn("leaf", leaf), ["period"], "leaf", "h_before", "h_after"))
    touched = hashed.withColumn("leaf", leaf).join(changed_leaves(leaves, ["period"], "leaf", depth), ["period", "leaf"], "left_semi")
    # a leaf holds some keys that stayed as they were
    moved = cut(touched.where("h_before <> h_after").select(*by_period, "before", "n", "begin_at", "end_at"))
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    slices = F.ceil(F.col("n") / most_sightings)
    place = F.when(slices > 1, F.floor((micros("at") - micros("begin_at")) * slices / (micros("end_at") - micros("begin_at") + 1))).otherwise(F.lit(0).cast("bigint"))
    sliced = cut(sightings.join(moved, by_period).withColumn("slice", place).select(*by_period, "slice", "at", "value"))
    by_slice = [*by_period, "slice"]
    parts = _summary(sliced, by_slice).select(*by_slice, "lo", "hi", "last").join(moved.select(*by_period, "before"), by_period).withColumn("earlier", F.coalesce(F.lag("last").over(Window.partitionBy(*by_period).orderBy("slice")), F.col("before")))
    stirred = parts.where("earlier is null or lo <> hi or lo <> earlier").select(*by_slice, "earlier")
    in_slice = Window.partitionBy(*by_slice).orderBy("at")
    compared = sliced.join(stirred, by_slice).withColumn("previous", F.coalesce(F.lag("value").over(in_slice), F.col("earlier")))
    starts = cut(compared.where("previous is null or previous <> value").select(*by_slice, "at", "value"))
    # a version ends where the next one of the key begins: in the slice, else in a later one, else in a later period
    of_slice = starts.groupBy(*by_slice).agg(F.min("at").alias("first_at")).withColumn("next_slice_at", F.lead("first_at").over(Window.partitionBy(*by_period).orderBy("slice")))
    of_period = of_slice.groupBy(*by_period).agg(F.min("first_at").alias("first_at")).withColumn("next_period_at", F.lead("first_at").over(Window.partitionBy(*key).orderBy("period")))
    ends = of_slice.select(*by_slice, "next_slice_at").join(of_period.select(*by_period, "next_period_at"), by_period)
    bounded = starts.withColumn("following", F.lead("at").over(in_slice)).join(ends, by_slice)
    return bounded.select(*key, F.col("value").alias(value), F.col("at").alias("valid_from"), F.coalesce("following", "next_slice_at", "next_period_at").alias("valid_to"))


# -- snapshot by snapshot --------------------------------------------------------------------
class VersionStore:
    """A history kept in a folder and brought up to date snapshot by snapshot.

    ``leaves`` holds the tree of the last snapshot (hashes of its lowest level) and which run last wrote the states of each leaf bucket,
    ``states`` the last value of each key, in folders by branch of the tree, and ``versions`` what each snapshot began. A snapshot's tree is
    compared with the stored one from the root down; states are read, compared key by key and written again only for leaf buckets
    that differ. Each run writes folders of its own, ``leaves`` last, so one that failed is simply run again.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str], value: str, depth: int):
        self.spark, self.path, self.key, self.value, self.depth = spark, path, key, value, depth

    def _folder(self, table: str, run: int) -> str:
        return os.path.join(self.path, table, f"_run={run}")

    def _runs(self, table: str, before: int) -> list[int]:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(os.path.join(self.path, table))
        files = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(r for r in (int(s.getPath().getName()[5:]) for s in files.listStatus(where) if s.getPath().getName().startswith("_run=")) if r < before) if files.exists(where) else []

    def _read(self, table: str, runs: list[int], schema: str) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.option("basePath", os.path.join(self.path, table)).parquet(*[self._folder(table, r) for r in runs])

    def append(self, snapshot: DataFrame, run: int, at: F.Column) -> dict[str, int]:
        """The snapshot (``key``, ``value``; one row for each key, keys that are gone are simply not in it) as run ``run``, a number above
        all before. Gives how many leaf buckets there were, differed, and how many versions began.

        Null key parts are empty text, rows without value are left out. A key that isn't in the snapshot keeps its value; one that comes
        back with it begins no version.
        """
        texts = ", ".join(f"`{k}` string" for k in self.key)
        fresh = snapshot.select(*[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in self.key], F.col(self.value).cast("string").alias("value")).where(F.col("value").isNotNull()).dropDuplicates(self.key)
        fresh = cut(fresh.withColumn("leaf", F.pmod(F.xxhash64(*self.key), F.lit(FANOUT**self.depth))))
        tree = self._read("leaves", self._runs("leaves", run)[-1:], "leaf bigint, hash bigint, owner bigint").select("leaf", F.col("hash").alias("before"), "owner")
        after = fresh.groupBy("leaf").agg(F.bit_xor(F.xxhash64(*self.key, "value")).alias("after"))
        zero = F.lit(0).cast("bigint")
        both = cut(after.join(tree, "leaf", "full").select("leaf", F.lit(0).alias("all"), F.coalesce("before", zero).alias("before"), F.coalesce("after", zero).alias("after"), "owner"))
        differing = cut(changed_leaves(both.drop("owner"), ["all"], "leaf", self.depth).select("leaf").join(both.select("leaf", "owner"), "leaf"))
        branch = F.floor(F.col("leaf") / FANOUT ** (self.depth - 1)).cast("int")
        states = self._read("states", self._runs("states", run), f"{texts}, leaf bigint, value string, since timestamp, _run bigint, branch int")
        held = states.join(differing.withColumn("branch", branch).withColumnRenamed("owner", "_run"), ["branch", "leaf", "_run"], "left_semi").select(*self.key, F.col("leaf").alias("_leaf"), F.col("value").alias("_value"), F.col("since").alias("_since"))
        new = fresh.join(differing.select("leaf"), "leaf", "left_semi")
        began = F.col("value").isNotNull() & ~F.col("value").eqNullSafe(F.col("_value"))
        merged = cut(new.join(held, self.key, "full").select(*self.key, F.coalesce("leaf", "_leaf").alias("leaf"), F.coalesce("value", "_value").alias("value"), F.when(began, at.cast("timestamp")).otherwise(F.col("_since")).alias("since"), began.alias("began")))
        merged.where("began").select(*self.key, "value", F.col("since").alias("valid_from")).write.mode("overwrite").parquet(self._folder("versions", run))
        merged.drop("began").withColumn("branch", branch).repartition("branch").sortWithinPartitions("branch", "leaf").write.mode("overwrite").partitionBy("branch").parquet(self._folder("states", run))
        owned = both.join(differing.select("leaf", F.lit(True).alias("_differs")), "leaf", "left")
        owned.select("leaf", F.col("after").alias("hash"), F.when(F.col("_differs"), F.lit(run).cast("bigint")).otherwise(F.col("owner")).alias("owner")).write.mode("overwrite").parquet(self._folder("leaves", run))
        return {"leaves": both.count(), "differing": differing.count(), "versions": merged.where("began").count()}

    def versions(self) -> DataFrame:
        """``key, value, valid_from, valid_to`` (null: still valid), values as text."""
        rows = self._read("versions", self._runs("versions", 1 << 60), ", ".join(f"`{k}` string" for k in self.key) + ", value string, valid_from timestamp")
        following = F.lead("valid_from").over(Window.partitionBy(*self.key).orderBy("valid_from"))
        return rows.select(*self.key, F.col("value").alias(self.value), "valid_from", following.alias("valid_to"))
