"""Queues and status as Structured Streaming jobs.

Claims and the status log use native operators and the Parquet file sink, so a restart continues from the checkpoint.
The current status is a stateful aggregate whose changed rows replace those of a stored table, batch by batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seqtables.operators import queues
from seqtables.sources import buckets


def _append(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def claim_downloads(changes: DataFrame, path: str, checkpoint: str, download_job: str = "download") -> StreamingQuery:
    """Claim queued experiments once per attempt and append their launch requests.

    ``changes`` is a stream of experiment rows with ``attempt``. The state holds one key per claim;
    give the session the RocksDB state store where claims are many.
    """
    queued = queues.download_queue(changes).dropDuplicates(["uid", "attempt"])
    digest = F.sha2(F.concat_ws(":", F.lit(download_job), "uid", F.col("attempt").cast("string")), 256)
    requests = queued.select(
        "uid", "url", "attempt", F.lit(download_job).alias("job"),
        F.concat_ws("__", F.lit("trig"), "uid", digest).alias("run_id"),
    )
    return _append(requests, path, checkpoint)


def append_status_log(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append every status event to the log that ``lifecycle.status_latest`` folds, however late it comes.

    The fold goes by (ts, event_id), so a repeated event changes nothing and no state is needed to drop it.
    """
    return _append(events.select("uid", F.col("ts").cast("timestamp").alias("ts"), "event_id", "libstatus"), path, checkpoint)


def claim_attempts(changes: DataFrame, written: DataFrame, path: str, checkpoint: str, download_job: str = "download") -> StreamingQuery:
    """Claim queued experiments once per cause, and number the attempts after the launches written before.

    ``changes`` is a stream of experiment rows with ``event_id``, the event that queued them; ``written`` a static table
    (uid, job, cause, attempt), read anew in each run. A cause that has been launched keeps its number and id.
    """
    cause = F.concat(F.lit("download:"), F.coalesce(F.col("event_id"), F.lit(0)).cast("string"))
    queued = queues.download_queue(changes).select("uid", "url", cause.alias("cause")).dropDuplicates(["uid", "cause"])
    mine = written.filter(F.col("job") == download_job)
    last = mine.groupBy("uid").agg(F.max("attempt").alias("last"))
    same = mine.groupBy("uid", "cause").agg(F.min("attempt").alias("same"))
    attempt = F.coalesce("same", F.coalesce("last", F.lit(0)) + 1).cast("int")
    numbered = queued.join(last, "uid", "left").join(same, ["uid", "cause"], "left").withColumn("attempt", attempt)
    ident = queues.run_id(F.lit("trig"), F.lit(download_job), F.col("uid"), F.col("attempt"))
    return _append(numbered.select("uid", "url", F.lit("download").alias("kind"), F.lit(download_job).alias("job"), "cause", "attempt",
                                   ident.alias("run_id")), path, checkpoint)


CURRENT = "uid string, libstatus int, ts timestamp, event_id bigint"


def keep_current(events: DataFrame, path: str, checkpoint: str, count: int | None = None) -> StreamingQuery:
    """Keep the last status of every experiment in a bucketed table: one row each, with the event that set it.

    The state holds one row an experiment, whatever the number of events; a batch gives the rows it changed, however
    late their events come, and these replace the stored ones. A batch's rows are written under its number first, so
    a batch that is run again after a loss writes the same rows to the same place.
    """
    last = F.max_by(F.struct("libstatus", "ts", "event_id"), F.struct("ts", "event_id"))
    current = (events.select("uid", F.col("ts").cast("timestamp").alias("ts"), "event_id", "libstatus").groupBy("uid").agg(last.alias("last"))
               .select("uid", "last.libstatus", "last.ts", "last.event_id"))

    def put(changed: DataFrame, batch: int) -> None:
        changes = f"{checkpoint.rstrip('/')}-changes/batch={batch}"
        changed.write.mode("overwrite").parquet(changes)
        buckets.replace(changed.sparkSession.read.schema(CURRENT).parquet(changes), path, count=count)

    return (current.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
