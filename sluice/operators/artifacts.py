"""Object checks against an inventory table (SRC-6, JOIN-4, RECON-2, FLT-6,
RULE-6).

Sizes and times come from an inventory table (bucket, key, size,
last_modified): a storage inventory report, or the listing of a folder tree
(``inventory_from_folder``), which has zero-byte objects too.
"""

from __future__ import annotations

import datetime as dt
import math
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions.exprs import file_name, normalise_prefix
from sluice.session import materialize
from sluice.sources.files import list_files

# ── fixed values: default outbound object name pattern ───────────────────
DEFAULT_OBJECT_PATTERN = r".*\.csv$"
#: Time slots of an object search.
SEARCH_SLOTS = 256


def inventory_from_folder(spark: SparkSession, root: str, bucket: str) -> DataFrame:
    """Inventory of a folder that stands for a bucket, empty files included; no file is opened."""
    top = re.sub("^[a-z0-9]+:(//[^/]*(?=/))?", "", root).rstrip("/") + "/"
    return list_files(spark, root).select(F.lit(bucket).alias("bucket"), F.substring(F.concat(F.lit("/"), F.ltrim("path", F.lit("/"))), len(top) + 1, 1 << 20).alias("key"),
                                          "size", F.col("modified_at").alias("last_modified"))


def check_artifacts(artifacts: DataFrame, inventory: DataFrame, runs: DataFrame, picks: DataFrame,
                    enforce_freshness: bool = False) -> DataFrame:
    """RECON-2 per referenced object: missing or empty fails; older than the
    run start (strictly) fails when freshness is enforced or the log's run
    ownership is unproven, else warns."""
    inv = inventory.select("bucket", "key", "size", "last_modified", F.lit(True).alias("_exists"))
    a = artifacts.select("run_id", "rule_key", "position", "bucket", "key").dropDuplicates(
        ["run_id", "rule_key", "bucket", "key"])
    j = (a.join(inv, ["bucket", "key"], "left")
         .join(runs.select("run_id", "started_at"), "run_id", "left")
         .join(picks.select("run_id", "run_verified"), "run_id", "left"))
    exists = F.coalesce("_exists", F.lit(False))
    stale = exists & (F.col("last_modified") < F.col("started_at"))
    verified = F.coalesce("run_verified", F.lit(False))
    state = (F.when(~exists, F.lit("not found")).when(F.coalesce("size", F.lit(0)) == 0, F.lit("0 bytes"))
             .when(stale, F.lit("stale")).otherwise(F.lit("ok")))
    verdict = (F.when(~exists | (F.coalesce("size", F.lit(0)) == 0), F.lit("FAIL"))
               .when(stale, F.lit("FAIL") if enforce_freshness else F.when(verified, "WARN").otherwise("FAIL"))
               .otherwise(F.lit("PASS")))
    return j.select("run_id", "rule_key", "position", "bucket", "key", exists.alias("exists"), "size",
                    "last_modified", state.alias("state"), verdict.alias("verdict"))


def ancestors(key):
    """Every directory of a key, from the root ('') down, each with its
    trailing '/'; a leading '/' of the key is ignored."""
    parts = F.split(F.ltrim(key, F.lit("/")), "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda d: F.when(d == 0, F.lit("")).otherwise(
        F.concat(F.array_join(F.slice(parts, F.lit(1), d), "/"), F.lit("/"))))


def under_prefix_join(objects: DataFrame, targets: DataFrame) -> DataFrame:
    """Objects whose key (leading '/' ignored) lies under a target's
    normalised ``prefix``: each key yields its ancestor directories, which
    meet the targets in one equi-join on (bucket, prefix).  A normalised
    prefix is '' or ends in '/', so this is ``startswith`` for any depth."""
    o = objects.withColumn("_dir", F.explode(ancestors(F.col("key"))))
    return o.join(targets, (o["bucket"] == targets["target_bucket"]) & (o["_dir"] == targets["prefix"])).drop("_dir")


def _named(df: DataFrame, pattern: str) -> DataFrame:
    return df.where(file_name(F.col("key")).rlike(pattern))


def matching_objects(inventory: DataFrame, targets: DataFrame, pattern: str = DEFAULT_OBJECT_PATTERN,
                     contents: DataFrame | None = None) -> DataFrame:
    """Every object that each search admits (the listing behind FLT-6).

    ``targets``: (search_id, target_bucket, prefix, since[, must_contain]).
    Objects match when under the prefix, modified at/after ``since``, and the
    file name matches ``pattern``; with ``contents`` (bucket, key, value) the
    object must also hold a row whose value equals ``must_contain``.
    """
    t = targets.withColumn("prefix", normalise_prefix(F.col("prefix")))
    if contents is not None and "must_contain" in targets.columns:
        # the searched values pick the objects first
        held = (contents.select("bucket", "key", F.col("value").alias("must_contain"))
                .join(t.select("must_contain").distinct(), "must_contain", "left_semi").distinct())
        j = under_prefix_join(_named(inventory, pattern).join(held, ["bucket", "key"]),
                              t.withColumnRenamed("must_contain", "_wanted")).where(F.col("must_contain") == F.col("_wanted"))
    else:
        j = under_prefix_join(_named(inventory, pattern), t)
    return j.where(F.col("last_modified") >= F.col("since")).select("search_id", "bucket", "key", "size", "last_modified")


def search_objects(inventory: DataFrame, targets: DataFrame, pattern: str = DEFAULT_OBJECT_PATTERN,
                   contents: DataFrame | None = None) -> DataFrame:
    """FLT-6 for many searches at once: the first object (by time, then key)
    that each search admits; searches without one give no row.

    Without a content condition, searches of one prefix share its objects
    (``_first_at_or_after``): the work is objects plus searches, never their
    product, and no prefix is one task's."""
    if contents is not None and "must_contain" in targets.columns:
        best = F.min_by(F.struct("bucket", "key", "size", "last_modified"), F.struct("last_modified", "key"))
        return (matching_objects(inventory, targets, pattern, contents).groupBy("search_id").agg(best.alias("b"))
                .select("search_id", "b.bucket", "b.key", "b.size", "b.last_modified"))
    t = targets.select("search_id", "target_bucket", normalise_prefix(F.col("prefix")).alias("prefix"), "since")
    j = under_prefix_join(_named(inventory, pattern), t.select("target_bucket", "prefix").distinct())
    first = j.groupBy("target_bucket", "prefix", "last_modified").agg(F.min_by(F.struct("key", "size"), "key").alias("o"))
    return _first_at_or_after(materialize(first, "search-objects"), t)


def _slot(at: Column, bounds: list) -> Column:
    """Number of bounds at or before a time, in two steps of about sqrt(n)."""
    step = max(1, math.isqrt(len(bounds)))
    size = lambda xs: F.size(F.filter(xs, lambda b: b <= at))
    lits = lambda xs: F.array(*(F.lit(x) for x in xs)).cast("array<timestamp>")
    coarse = F.greatest(size(lits(bounds[::step])) - 1, F.lit(0)) * step
    return coarse + size(F.slice(lits(bounds), coarse + 1, step))


def _first_at_or_after(first: DataFrame, asked: DataFrame) -> DataFrame:
    """For each search the first object of its (bucket, prefix) at or after ``since``.

    Time is cut into slots that hold about as many objects each.  A search
    looks inside its own slot, where objects and searches are walked together,
    and else takes the first object of the next slot that has one; so a prefix with
    most objects and searches is spread over all slots."""
    key = ["target_bucket", "prefix"]
    points = [k / SEARCH_SLOTS for k in range(SEARCH_SLOTS)]
    seconds = first.agg(F.percentile_approx(F.unix_micros(F.col("last_modified").cast("timestamp")), points, 10_000)).first()[0]
    bounds = [dt.datetime.fromtimestamp(0, dt.timezone.utc) + dt.timedelta(microseconds=x) for x in sorted(set(seconds or []))]
    if not bounds:
        return asked.limit(0).select("search_id", F.col("target_bucket").alias("bucket"), F.lit("").alias("key"), F.lit(0).cast("long").alias("size"), F.col("since").alias("last_modified"))
    held = first.withColumn("slot", _slot(F.col("last_modified").cast("timestamp"), bounds))
    object_ = F.struct("last_modified", "o.key", "o.size")
    # At most one entry a slot: the prefix's slots in order, with the first object of each.
    slots = (held.groupBy(*key, "slot").agg(F.min(object_).alias("object"))
             .groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("slot", "object"))).alias("slots")))
    searches = asked.join(slots, key).withColumn("slot", _slot(F.col("since").cast("timestamp"), bounds))
    later = F.try_element_at(F.filter("slots", lambda x: x["slot"] > F.col("slot")), F.lit(1))["object"]
    searches = searches.select("search_id", *key, "slot", "since", later.alias("later"))
    events = held.select(*key, "slot", F.col("last_modified").alias("at"), F.lit(1).alias("is_object"), object_.alias("object"),
                         F.lit(None).cast("string").alias("search_id"))
    mine = searches.select(*key, "slot", F.col("since").alias("at"), F.lit(0).alias("is_object"), F.lit(None).cast(events.schema["object"].dataType).alias("object"), "search_id", "later")
    w = (Window.partitionBy(*key, "slot").orderBy(F.desc("at"), F.desc("is_object"))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = events.unionByName(mine, allowMissingColumns=True).withColumn("object", F.coalesce(F.last("object", ignorenulls=True).over(w), "later"))
    return (found.where(F.col("search_id").isNotNull() & F.col("object").isNotNull())
            .select("search_id", F.col("target_bucket").alias("bucket"), "object.key", "object.size", "object.last_modified"))
