"""Status transitions, metrics and the current state of experiments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqtables import fixed

COUNTERS = ("tagstotal", "tagsmapped", "tagsribo", "tagssuppressed", "tagsused")
METRICS = COUNTERS + ("fragmentsize", "fragmentsizeest", "islandcount", "size")


def status_latest(events: DataFrame) -> DataFrame:
    """The last status of each experiment by time, then event id. Works on a stream as well."""
    last = F.max_by(F.struct("libstatus", "event_id"), F.struct("ts", "event_id"))
    return events.groupBy("uid").agg(last.alias("last")).select(
        "uid", F.col("last.libstatus").alias("libstatus"), F.col("last.event_id").alias("event_id")
    )


def pending_events(log: DataFrame, downloads: DataFrame, ready: DataFrame, now: Column | None = None) -> DataFrame:
    """All events to apply: the logged ones at their times and the queue decisions at theirs.

    ``log`` has uid, ts, event_id, event and message; ``downloads`` uid; ``ready`` uid and action. Decisions
    without a ``ts`` of their own are taken now; they have no event id and follow logged events of the same time.
    """
    now = F.current_timestamp() if now is None else now

    def decided(rows: DataFrame, event: Column) -> DataFrame:
        ts = F.col("ts") if "ts" in rows.columns else now
        return rows.select("uid", ts.cast("timestamp_ntz").alias("ts"), F.lit(None).cast("bigint").alias("event_id"),
                           event.alias("event"), F.lit(None).cast("string").alias("message"))

    logged = log.select("uid", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id", "event", "message")
    return logged.unionByName(decided(downloads, F.lit("queued"))).unionByName(decided(ready, F.col("action")))


def _by_event(values: dict[str, Column | int | str], kind: str) -> Column:
    """The value an event writes into a column; null for other events."""
    out = F.lit(None).cast(kind)
    for name, value in values.items():
        out = F.when(F.col("event") == name, value).otherwise(out)
    return out


_ORDER = "struct<ts: timestamp_ntz, event_id: bigint>"
_TAKEN = "array<struct<lo: bigint, hi: bigint>>"
#: Event ids of one block of this many bits are sorted together, and an interval of taken ids lies in one block.
BLOCK_BITS = 16
WRITERS = ("status", "text", "deleted", "run", "start", "end", "gone", "counters")


def _block(event_id: Column) -> Column:
    return F.shiftright(event_id, BLOCK_BITS)


def not_taken(events: DataFrame, held: DataFrame) -> DataFrame:
    """The events whose id lies in none of their experiment's intervals (uid, applied); events without an id all.

    An event meets the last interval that begins at or before its id, in the order of one experiment's block of ids. So each
    event and each interval is sorted once, and an experiment of very many events is spread over its blocks.
    """
    intervals = held.select("uid", F.inline("applied")).select(
        "uid", _block(F.col("lo")).alias("_block"), F.col("lo").alias("_at"), F.col("hi").alias("_hi"))
    place = _block(F.coalesce("event_id", F.xxhash64("uid", "ts", "event")))
    both = (events.withColumns({"_block": place, "_at": F.col("event_id"), "_hi": F.lit(None).cast("bigint"), "_event": F.lit(True)})
            .unionByName(intervals.withColumn("_event", F.lit(False)), allowMissingColumns=True))
    until = Window.partitionBy("uid", "_block").orderBy("_at", "_event")
    begun = F.last("_hi", ignorenulls=True).over(until.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (both.withColumn("_begun", begun).filter(F.col("_event") & (F.col("event_id").isNull() | F.col("_begun").isNull() | (F.col("_begun") < F.col("_at"))))
            .select(*events.columns))


def taken_intervals(events: DataFrame, held: DataFrame) -> DataFrame:
    """uid and applied: the intervals held so far and those of the events' ids.

    Ids in a row of the log form an island. Within one an experiment's first to last id are one interval: all ids between are
    in the log, and belong to it or to others, so no event to come has one of them. An experiment thus keeps an interval
    for each island it has events in, not one for each event; giving the whole log again joins what increments left apart.
    """
    ids = events.filter("event_id is not null").select("uid", "event_id", _block(F.col("event_id")).alias("block"))
    island = F.col("event_id") - F.dense_rank().over(Window.partitionBy("block").orderBy("event_id"))
    new = (ids.withColumn("island", island).groupBy("uid", "block", "island")
           .agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).drop("island"))
    old = held.select("uid", F.inline("applied")).withColumn("block", _block(F.col("lo")))
    order = Window.partitionBy("uid", "block").orderBy("lo", "hi")
    reached = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reached.isNull() | (F.col("lo") > F.col("_reached") + 1), 1).otherwise(0)
    merged = (new.unionByName(old.select(*new.columns)).withColumn("_reached", reached).withColumn("_begins", begins)
              .withColumn("_island", F.sum("_begins").over(order)).groupBy("uid", "block", "_island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    return merged.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("applied"))


def lifecycle_next(labdata: DataFrame, events: DataFrame) -> DataFrame:
    """Experiments after all their events, and the last logged event that was applied.

    ``events`` has uid, ts, event_id, event, message and, for finished analyses, optionally new params. Each column
    takes the value of the last event, by (ts, event_id), that writes it; dates are those of the events.
    A queue decision counts if its guard holds for the experiment as it was read; ``reprocess`` must come from experiments
    with their read files present. Logged events whose id lies in an interval of ``applied`` have been taken before and change
    nothing, so the same log can be given again. ``writers`` keeps the (ts, event_id) that wrote each column: an event that
    arrives late writes the columns no newer one has written. Of a state with (applied_ts, applied_id) but no list, logged
    events up to that mark count as taken. Experiments without a new event pass through.
    """
    col, first_run = F.col, "applied" not in labdata.columns
    for name, kind in (("dateanalyzes", "timestamp_ntz"), ("dateanalyzee", "timestamp_ntz"), ("datedel", "date"),
                       ("applied_ts", "timestamp_ntz"), ("applied_id", "bigint"), ("applied", _TAKEN),
                       ("writers", f"struct<{', '.join(f'{w}: {_ORDER}' for w in (*WRITERS, 'first'))}>")):
        if name not in labdata.columns:
            labdata = labdata.withColumn(name, F.lit(None).cast(kind))
    if "params" not in events.columns:
        events = events.withColumn("params", F.lit(None).cast("string"))
    guards = {
        "queued": (col("libstatus") == fixed.START_DOWNLOAD) & (col("deleted") == 0)
        & col("url").isNotNull() & (col("url") != ""),
        "reprocess": (col("forcerun") == 1) & (col("libstatus") > fixed.PROCESSING) & (col("deleted") == 0),
        "delete": col("deleted") == 1,
    }
    allowed = F.lit(True)
    for name, guard in guards.items():
        allowed = F.when(col("event") == name, guard).otherwise(allowed)
    mark = F.struct(col("applied_ts").alias("ts"), col("applied_id").alias("event_id"))
    own = F.struct("ts", "event_id")
    taken = col("event_id").isNotNull() & col("applied").isNull() & F.coalesce(own <= mark, F.lit(False))
    message = F.coalesce(F.replace("message", F.lit("'"), F.lit('"')), F.lit(""))
    written = {
        "to_status": _by_event({
            "queued": fixed.DOWNLOADING, "retry": fixed.RESTART_DOWNLOAD, "download_failed": fixed.FAIL_DOWNLOAD,
            "downloaded": fixed.START_PROCESS, "started": fixed.PROCESSING, "completed": fixed.SUCCESS_PROCESS,
            "failed": fixed.FAIL_PROCESS, "reprocess": fixed.START_PROCESS}, "int"),
        "to_text": _by_event({
            "retry": fixed.TEXT_RETRY, "download_failed": message, "downloaded": fixed.TEXT_DOWNLOADED,
            "started": fixed.TEXT_STARTED, "completed": fixed.TEXT_COMPLETE,
            "failed": F.concat(F.lit(fixed.TEXT_FAILED_PREFIX), message),
            "reprocess": fixed.TEXT_REPROCESS, "delete": fixed.TEXT_DELETED}, "string"),
        "to_deleted": _by_event({"queued": 0, "delete": 2}, "int"),
    }
    order = F.struct("ts", F.coalesce("event_id", F.lit((1 << 63) - 1)).alias("event_id"))
    finished = col("event").isin("completed", "failed")
    last = lambda value, where: F.max_by(value, F.when(where, order))  # noqa: E731 - rows without an order are passed over
    state = labdata.select("uid", "libstatus", "deleted", "forcerun", "url", "applied_ts", "applied_id", "applied")
    known = col("to_status").isNotNull() | col("to_text").isNotNull()
    events = events.select("uid", col("ts").cast("timestamp_ntz").alias("ts"), "event_id", "event", "message", col("params").alias("new_params"))
    held = labdata.select("uid", "applied")
    folded = (
        (events if first_run else not_taken(events, held)).join(state, "uid")
        .withColumn("event", F.when(F.coalesce(allowed, F.lit(False)) & ~taken, col("event")))
        .withColumns(written).withColumn("event", F.when(known, col("event")))
        .groupBy("uid").agg(
            last(col("event"), col("event").isNotNull()).alias("event"),
            *[last(col(c), col(c).isNotNull()).alias(c) for c in written],
            *[F.max(F.when(where, order)).alias(f"by_{w}") for w, where in zip(WRITERS, (
                col("to_status").isNotNull(), col("to_text").isNotNull(), col("to_deleted").isNotNull(),
                col("event").isin("started", "reprocess"), col("event") == "started", finished, col("event") == "delete",
                finished | (col("event") == "reprocess")))],
            F.max(F.when(col("event") == "reprocess", order)).alias("reset"),
            F.max(F.when(col("event") == "started", col("ts"))).alias("last_start"),
            F.min(F.when(col("event") == "started", col("ts"))).alias("first_start"),
            F.max(F.when(finished, col("ts"))).alias("last_end"),
            last(F.struct("new_params"), finished).alias("end"),
            F.max(F.when(col("event") == "delete", col("ts").cast("date"))).alias("gone"),
            F.max(F.when(col("event").isNotNull() & col("event_id").isNotNull(), own)).alias("seen"))
    )

    def newer(writer: str, by: str | None = None) -> Column:
        by, before = col(by or f"by_{writer}"), col(f"writers.{writer}")
        return by.isNotNull() & (before.isNull() | (by > before))

    first = F.coalesce("dateanalyzed", "first_start")
    seen = F.greatest(col("seen"), F.when(col("applied_ts").isNotNull(), mark))
    columns = {
        "libstatus": F.when(newer("status"), col("to_status")).otherwise(col("libstatus")),
        "libstatustxt": F.when(newer("text"), col("to_text")).otherwise(col("libstatustxt")),
        "deleted": F.when(newer("deleted"), col("to_deleted")).otherwise(col("deleted")),
        "forcerun": F.when(newer("run"), 0).otherwise(col("forcerun")),
        "dateanalyzes": F.when(newer("start"), col("last_start")).otherwise(col("dateanalyzes")),
        # the first start; a late one that is earlier replaces only what an event wrote
        "dateanalyzed": F.when(col("dateanalyzed") == col("writers.first.ts"), F.least("dateanalyzed", "first_start")).otherwise(first),
        "dateanalyzee": F.when(newer("end"), col("last_end")).otherwise(col("dateanalyzee")),
        "datedel": F.when(newer("gone"), col("gone")).otherwise(col("datedel")),
        "params": F.when(newer("end"), F.coalesce("end.new_params", "params")).otherwise(col("params")),
        "applied_ts": F.coalesce(seen["ts"], "applied_ts"),
        "applied_id": F.coalesce(seen["event_id"], "applied_id"),
        "applied": col("now_applied"),
        "writers": F.when(col("event").isNotNull(), F.struct(
            *[F.greatest(f"writers.{w}", f"by_{w}").alias(w) for w in WRITERS],
            F.when(col("dateanalyzed").isNull() | (col("dateanalyzed") == col("writers.first.ts")),
                   F.struct(F.least(col("writers.first.ts"), col("first_start")).alias("ts"), F.lit(None).cast("bigint").alias("event_id")))
            .otherwise(col("writers.first")).alias("first"))).otherwise(col("writers")),
        **{c: F.when(newer("counters", "reset"), F.lit(0)).otherwise(col(c)) for c in COUNTERS},
    }
    applied = taken_intervals(events, held).withColumnRenamed("applied", "now_applied")
    after = labdata.join(folded, "uid", "left").join(applied, "uid", "left")
    return after.withColumns(columns).select(*labdata.columns, "event")


def apply_metrics(labdata: DataFrame, *metrics: DataFrame) -> DataFrame:
    """Experiments with the counters of new result files; others keep their values.

    Each metrics frame has uid, unique, and some of the columns in ``METRICS``.
    """
    out = labdata
    for frame in metrics:
        names = [c for c in METRICS if c in frame.columns]
        new = frame.select("uid", *[F.col(c).alias(f"new_{c}") for c in names])
        out = out.join(new, "uid", "left").withColumns(
            {c: F.coalesce(f"new_{c}", c) for c in names}
        ).drop(*[f"new_{c}" for c in names])
    return out.select(*labdata.columns)
