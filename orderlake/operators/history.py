"""Versioned dimensions, point-in-time lookups, table state from changes, incremental sync."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from orderlake.functions import hash_pii
from orderlake.operators.keyed import SLICE, as_of, latest_per_key, time_slice

DAY = 86_400
YEAR = 366 * DAY


def silver_users(users: DataFrame, salt: str) -> DataFrame:
    """Users without identifiers; the hash is the only key. Times that can't be read are null."""
    return users.select(
        hash_pii("user_id", salt).alias("user_id_hash"), "country_code", "acquisition_channel",
        F.col("created_at").try_cast("timestamp").alias("created_at"), F.col("updated_at").try_cast("timestamp").alias("updated_at"),
    )


def _next_time(key: str, ts: str) -> Column:
    """Next version time: inside the slice, else the first time of the next slice (see ``_with_slices``)."""
    inside = Window.partitionBy(key, SLICE).orderBy(ts)
    return F.coalesce(F.lead(ts).over(inside), F.col("_next_slice"))


def _with_slices(versions: DataFrame, key: str, ts: str, slice_seconds: int = YEAR) -> DataFrame:
    sliced = versions.withColumn(SLICE, time_slice(F.col(ts), slice_seconds))
    firsts = sliced.groupBy(key, SLICE).agg(F.min(ts).alias("_t0"))
    following = firsts.select(key, SLICE, F.lead("_t0").over(Window.partitionBy(key).orderBy(SLICE)).alias("_next_slice"))
    return sliced.join(following, [key, SLICE])


def scd2_users(versions: DataFrame) -> DataFrame:
    """Full history from all known versions: one interval per (user, update time)."""
    unique = latest_per_key(versions, ["user_id_hash", "updated_at"], [F.xxhash64(*versions.columns)])
    sliced = _with_slices(unique, "user_id_hash", "updated_at")
    return sliced.select(
        *unique.columns, F.col("updated_at").alias("valid_from"), _next_time("user_id_hash", "updated_at").alias("valid_to"))


def scd2_apply(history: DataFrame, incoming: DataFrame, as_of_time: Column, close_missing: bool = True) -> DataFrame:
    """Apply a new snapshot (or batch of versions) to an existing history.

    Newer versions close the open row at their update time; with ``close_missing`` users absent from the snapshot are closed
    at ``as_of_time``. Closed rows are never touched.
    """
    key = "user_id_hash"
    columns = history.columns
    closed = history.filter(F.col("valid_to").isNotNull())
    current = history.filter(F.col("valid_to").isNull())
    arriving = latest_per_key(incoming, [key, "updated_at"], [F.xxhash64(*incoming.columns)])
    known = current.select(key, F.col("updated_at").alias("_known"))
    newer = arriving.join(known, key, "left").filter(F.col("_known").isNull() | (F.col("updated_at") > F.col("_known"))).drop("_known")
    line = current.drop("valid_to").unionByName(newer.withColumn("valid_from", F.col("updated_at")))
    sliced = _with_slices(line, key, "updated_at")
    timeline = sliced.select(*line.columns, _next_time(key, "updated_at").alias("valid_to")).select(*columns)
    if close_missing:
        present = incoming.select(key).distinct().withColumn("_present", F.lit(True))
        timeline = timeline.join(present, key, "left").withColumn(
            "valid_to", F.when(F.col("valid_to").isNull() & F.col("_present").isNull(), as_of_time).otherwise(F.col("valid_to"))
        ).select(*columns)
    return closed.unionByName(timeline)


def scd2_point_in_time(facts: DataFrame, history: DataFrame, ts: str, attributes: list[str], slice_seconds: int = 90 * DAY) -> DataFrame:
    """Attributes valid at each fact's time (valid_from <= t < valid_to), NULL where none is valid.

    An interval is put into every time slice that it covers between the first and the last fact, so the range is tested within an equi-join on (user,
    slice): facts and intervals are shuffled once each, and a user with most of the facts is spread over the slices. The intervals of
    a user don't overlap, as in ``scd2_users``.
    """
    key = "user_id_hash"
    reach = facts.agg(F.struct(time_slice(F.min(ts), slice_seconds).alias("low"), time_slice(F.max(ts), slice_seconds).alias("high"))).scalar()
    intervals = history.where(F.col(key).isNotNull() & F.col("valid_from").isNotNull()).select(
        F.col(key).alias("_key"), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"), *[F.col(a).alias(f"_{a}") for a in attributes], reach.alias("_reach"))
    first = F.greatest(time_slice(F.col("_from"), slice_seconds), F.col("_reach.low"))
    last = F.least(F.coalesce(time_slice(F.col("_to"), slice_seconds), F.col("_reach.high")), F.col("_reach.high"))
    pieces = intervals.withColumn("_covers", F.explode(F.when(first <= last, F.sequence(first, last)))).drop("_reach")
    sliced = facts.withColumn(SLICE, time_slice(F.col(ts), slice_seconds))
    inside = (F.col("_from") <= F.col(ts)) & (F.col("_to").isNull() | (F.col(ts) < F.col("_to")))
    found = sliced.join(pieces, (F.col(key) == F.col("_key")) & (F.col(SLICE) == F.col("_covers")) & inside, "left")
    return found.select(*facts.columns, *[F.col(f"_{a}").alias(a) for a in attributes])


def asof_features(entities: DataFrame, features: DataFrame, key: str, entity_ts: str, feature_ts: str,
                  values: list[str], ttl_seconds: int = 30 * DAY, slice_seconds: int | None = None, tie: list[str] | None = None) -> DataFrame:
    """Latest feature row not after the entity time and not older than the time to live."""
    found = as_of(entities, features, key, entity_ts, feature_ts, ttl_seconds, slice_seconds, tie)
    age = F.unix_micros(entity_ts) - F.unix_micros(F.col(f"match.{feature_ts}"))
    fresh = age <= F.lit(ttl_seconds * 1_000_000)
    return found.select(
        *entities.columns, F.when(fresh, F.col(f"match.{feature_ts}")).alias("feature_timestamp"),
        *[F.when(fresh, F.col(f"match.{v}")).alias(v) for v in values])


def cdc_merge_latest(snapshot: DataFrame, changes: DataFrame, key: str, apply_deletes: bool = True) -> DataFrame:
    """Current table state: initial snapshot rows (op ``r``) followed by changes, newest per key.

    A delete that is newest removes the row; with ``apply_deletes=False`` delete events are ignored instead.
    """
    rows = snapshot.unionByName(changes, allowMissingColumns=True)
    if not apply_deletes:
        rows = rows.filter(F.col("op") != "d")
    picked = latest_per_key(rows, [key], [F.col("ts_ms"), (F.col("op") == "d").cast("int"), F.xxhash64(*rows.columns)])
    return picked.filter(F.col("op") != "d")


def incremental_append_dedup(target: DataFrame, incoming: DataFrame, primary_key: list[str], cursor: str,
                             full_refresh: bool = False) -> DataFrame:
    """Append rows at or past the target's cursor position, then keep the newest row per primary key."""
    if full_refresh:
        return latest_per_key(incoming, primary_key, [F.col(cursor), F.xxhash64(*incoming.columns)])
    mark = target.agg(F.max(cursor)).scalar()
    fresh = incoming.filter(mark.isNull() | (F.col(cursor) >= mark)).withColumn("_batch", F.lit(1))
    rows = target.withColumn("_batch", F.lit(0)).unionByName(fresh)
    picked = latest_per_key(rows, primary_key, [F.col(cursor), F.col("_batch"), F.xxhash64(*target.columns)])
    return picked.drop("_batch")


def campaign_performance(ads: DataFrame, as_of_date: Column, days: int = 30) -> DataFrame:
    return ads.filter(F.col("date") >= F.date_sub(as_of_date, days)).select(
        "campaign_id", "campaign_name", "campaign_status", "impressions", "clicks", "cost_micros", "conversions", "date")
