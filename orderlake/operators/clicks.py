"""Click events and idle-timeout sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from orderlake.functions import hash_pii
from orderlake.operators.keyed import computed_once

IDLE_SECONDS = 30 * 60
HEAD, TIMED, TAIL = 0, 1, 2


def parse_click_events(events: DataFrame, salt: str) -> DataFrame:
    """Envelope or flat click JSON (column ``v``); rows with neither an event nor a session id are dropped."""
    after = F.variant_get("v", "$.after", "variant")
    wrapped = F.coalesce(F.schema_of_variant(after).rlike("^OBJECT<[^>]"), F.lit(False))
    extra = [c for c in events.columns if c not in ("value", "v")]
    rows = computed_once(events, extra, {"v": F.when(wrapped, after).otherwise(F.col("v"))})

    def text(name: str):
        return F.try_variant_get("v", f"$.{name}", "string")

    return computed_once(rows, extra, {
        "event_id": text("event_id"),
        "session_id": text("session_id"),
        "user_id_hash": hash_pii(text("user_id"), salt),
        "event_type": F.when(F.variant_get("v", "$.event_type", "variant").isNull(), F.lit("page_view")).otherwise(text("event_type")),
        "product_id": text("product_id"),
        "page_url": text("page_url"),
        "occurred_at": text("occurred_at"),
    }).filter((F.coalesce("event_id", F.lit("")) != "") | (F.coalesce("session_id", F.lit("")) != ""))


def sessionize(clicks: DataFrame, idle_seconds: int = IDLE_SECONDS) -> DataFrame:
    """Sessions split where the gap between consecutive events of one ``session_id`` exceeds the timeout.

    Events inside one slice no longer than the timeout can never be split, so they are first reduced to one row per
    (session_id, slice) with a map-side aggregate; gaps are then looked for between slice rows only. A bot that owns a third
    of all events costs at most one row per slice in the window, instead of one sort of all its events in a single task.

    Events without a readable time never split a session: an absent time sorts before and other text after the timed events,
    they count towards the first / last session, and a session that begins or ends with one has duration 0.
    Rows without a ``session_id`` are not sessions; route them away with ``missing_session``.
    """
    ts = F.col("occurred_at") if dict(clicks.dtypes)["occurred_at"] == "timestamp" else F.try_to_timestamp("occurred_at")
    raw = F.coalesce(F.col("occurred_at").cast("string"), F.lit(""))
    rows = clicks.filter(F.col("session_id").isNotNull()).select("*", ts.alias("_ts"), raw.alias("_raw"))
    place = F.when(F.col("_ts").isNotNull(), TIMED).when(F.col("_raw") == "", HEAD).otherwise(TAIL)
    width = F.lit(idle_seconds * 1_000_000)
    rows = rows.withColumns({
        "_place": place,
        "_slice": F.when(F.col("_ts").isNotNull(), F.floor(F.unix_micros("_ts") / width)).otherwise(F.lit(0)).cast("bigint"),
        "_order": F.struct(place.alias("p"), F.col("_ts"), F.col("_raw"), F.col("event_id")),
    })
    ends = F.struct("user_id_hash", "page_url", F.col("_ts").isNull().alias("untimed"))

    def is_type(name: str):
        return F.count_if(F.col("event_type") == name)

    parts = rows.groupBy("session_id", "_place", "_slice").agg(
        F.min("_ts").alias("t0"), F.max("_ts").alias("t1"),
        F.count(F.lit(1)).alias("events"),
        is_type("page_view").alias("pv"), is_type("product_view").alias("prv"),
        is_type("add_to_cart").alias("cart"), is_type("search").alias("srch"), is_type("purchase").alias("buy"),
        F.min(F.struct("_order", ends.alias("e"))).alias("head"), F.max(F.struct("_order", ends.alias("e"))).alias("tail"),
    )
    line = Window.partitionBy("session_id").orderBy("_place", "_slice")
    gap = F.unix_micros("t0") - F.unix_micros(F.lag("t1").over(line))
    numbered = parts.withColumn("_new", F.when(gap > width, 1).otherwise(0)).withColumn(
        "session_seq", F.sum("_new").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.lit(1))
    whole = numbered.groupBy("session_id", "session_seq").agg(
        F.min("head").alias("head"), F.max("tail").alias("tail"),
        F.min("t0").alias("session_start"), F.max("t1").alias("session_end"),
        *[F.sum(c).alias(c) for c in ("events", "pv", "prv", "cart", "srch", "buy")],
    )
    seconds = ((F.unix_micros("session_end") - F.unix_micros("session_start")) / F.lit(1_000_000)).cast("bigint")
    return whole.select(
        "session_id",
        F.col("session_seq").cast("bigint").alias("session_seq"),
        F.col("head.e.user_id_hash").alias("user_id_hash"),
        "session_start",
        "session_end",
        F.when(F.col("head.e.untimed") | F.col("tail.e.untimed"), F.lit(0)).otherwise(seconds).cast("bigint").alias("duration_seconds"),
        F.col("events").alias("event_count"),
        F.col("pv").alias("page_views"),
        F.col("prv").alias("product_views"),
        F.col("cart").alias("add_to_cart_count"),
        F.col("srch").alias("search_count"),
        (F.col("buy") > 0).alias("converted"),
        F.col("head.e.page_url").alias("entry_page"),
        F.col("tail.e.page_url").alias("exit_page"),
    )


def session_parts(clicks: DataFrame, idle_seconds: int = IDLE_SECONDS) -> DataFrame:
    """Sessions within each ``run_date``, with open ends at its borders: a date is worked on by itself and replaced by itself (see ``stitch_sessions``).

    Only clicks with a readable time, as ``occurred_at`` timestamps, are taken.
    """
    keyed = clicks.where("session_id is not null and occurred_at is not null").withColumn("session_id", F.concat_ws("|", F.col("run_date").cast("string"), "session_id"))
    parts = sessionize(keyed, idle_seconds)
    day = F.substring_index("session_id", "|", 1)
    return parts.withColumn("run_date", day.cast("date")).withColumn("session_id", F.substring(F.col("session_id"), F.length(day) + 2, F.length("session_id")))


def stitch_sessions(parts: DataFrame, idle_seconds: int = IDLE_SECONDS) -> DataFrame:
    """Whole sessions from the parts of all dates: parts of one session no further apart than the timeout are one. Equal to ``sessionize`` of all clicks."""
    line = Window.partitionBy("session_id").orderBy("session_start", "session_end", "run_date", "session_seq")
    before = F.max("session_end").over(line.rowsBetween(Window.unboundedPreceding, -1))
    gap = F.unix_micros("session_start") - F.unix_micros(before)
    numbered = parts.withColumn("_new", F.when(gap > idle_seconds * 1_000_000, 1).otherwise(0)).withColumn(
        "_seq", (F.sum("_new").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + 1).cast("bigint"))
    first, last = F.struct("session_start", "run_date", "session_seq"), F.struct("session_end", "run_date", "session_seq")
    counts = ["event_count", "page_views", "product_views", "add_to_cart_count", "search_count"]
    whole = numbered.groupBy("session_id", F.col("_seq").alias("seq")).agg(
        F.min_by("user_id_hash", first).alias("user_id_hash"), F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"),
        *[F.sum(c).alias(c) for c in counts], F.max("converted").alias("converted"), F.min_by("entry_page", first).alias("entry_page"), F.max_by("exit_page", last).alias("exit_page"))
    seconds = ((F.unix_micros("session_end") - F.unix_micros("session_start")) / F.lit(1_000_000)).cast("bigint")
    return whole.select("session_id", F.col("seq").alias("session_seq"), "user_id_hash", "session_start", "session_end", seconds.alias("duration_seconds"), *counts, "converted", "entry_page", "exit_page")


def missing_session(clicks: DataFrame) -> DataFrame:
    return clicks.filter(F.col("session_id").isNull())


def entry_exit_page(clicks: DataFrame) -> DataFrame:
    return sessionize(clicks).select("session_id", "session_seq", "user_id_hash", "entry_page", "exit_page")


def session_metrics(sessions: DataFrame) -> DataFrame:
    return sessions.agg(F.coalesce(F.sum("event_count"), F.lit(0)).alias("events"), F.count(F.lit(1)).alias("sessions"))
