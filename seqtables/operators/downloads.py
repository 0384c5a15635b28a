"""What becomes of a download: each file's check in order of mates, up to the first that fails or is still awaited."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtables import fixed
from seqtables.operators import queues

#: What a download without its second address says.
TEXT_NO_ADDRESS = "Error: no address"


def download_steps(dim: DataFrame, local: DataFrame, fetched: DataFrame, checks: DataFrame) -> DataFrame:
    """uid, mate, state (``ok``, ``failed`` or ``awaited``) and why of each file that a url or a local name brings.

    ``dim`` has the experiments under way (uid, url, pair), ``local`` is ``queues.local_files`` of them, ``fetched`` has uid, mate
    and file_type of the files that arrived, ``checks`` uid, mate and valid of the FASTQ check. A file without lines has
    no check and passes.
    """
    urls = queues.fetch_tasks(dim).filter("route = 'url'").select("uid", "mate", F.col("source").isNotNull().alias("named"), F.lit(None).cast("string").alias("refused"))
    refused = F.when(F.col("action") == "skip", fixed.TEXT_NO_LOCAL).when(F.col("action") == "error", fixed.TEXT_BAD_FILTER)
    mates = F.sequence(F.lit(1), F.when(F.col("action") == "use", F.col("n_files")).otherwise(1).cast("int"))
    names = local.select("uid", F.explode(mates).alias("mate"), F.lit(True).alias("named"), refused.alias("refused"))
    steps = urls.unionByName(names).join(fetched, ["uid", "mate"], "left").join(checks.select("uid", "mate", "valid"), ["uid", "mate"], "left")
    why = (
        F.when(F.col("refused").isNotNull(), F.col("refused"))
        .when(~F.col("named"), TEXT_NO_ADDRESS)
        .when(F.col("file_type").isNotNull() & ~F.col("file_type").isin(*fixed.DOWNLOAD_TYPES), fixed.TEXT_UNKNOWN_TYPE)
        .when(F.col("file_type").isNotNull() & ~F.coalesce("valid", F.lit(True)), fixed.TEXT_NOT_FASTQ)
    )
    state = F.when(F.col("why").isNotNull(), "failed").when(F.col("file_type").isNull(), "awaited").otherwise("ok")
    return steps.withColumn("why", why).select("uid", "mate", state.alias("state"), "why")


def download_outcome(dim: DataFrame, steps: DataFrame, files: DataFrame) -> DataFrame:
    """uid, event (``downloaded`` or ``download_failed``) and message of the downloads that have ended.

    The second mate is looked at only once the first is there, so the first step that is not ``ok`` decides; while that is
    awaited there is no outcome. Archive downloads and copies have no checks of their own: they end when the read files
    (``files``: uid, mate) are all there.
    """
    stopped = F.when(F.col("state") != "ok", F.col("mate"))
    by_step = steps.groupBy("uid").agg(F.min_by(F.struct("state", "why"), stopped).alias("first"))
    checked = by_step.filter("first is null or first.state = 'failed'").select(
        "uid", F.when(F.col("first").isNull(), "downloaded").otherwise("download_failed").alias("event"), F.col("first.why").alias("message"))
    other = dim.filter(queues.route(F.col("url")).isin("sra", "copy")).select("uid", "pair")
    there = files.groupBy("uid").agg(F.bool_or(F.col("mate") == 1).alias("has_1"), F.bool_or(F.col("mate") == 2).alias("has_2"))
    arrived = other.join(there, "uid").filter("has_1 and (not pair or has_2)").select(
        "uid", F.lit("downloaded").alias("event"), F.lit(None).cast("string").alias("message"))
    return checked.unionByName(arrived)
