"""What becomes of an experiment's results: its loaders in order, up to the first that cannot load.

An experiment's type lists its loaders. They run in that order, each from a source of its own: a result file, the rows and
rejects of that file, the experiment's genome. Here each loader's verdict is a row (uid, position, rule), found by one join
for each kind of source; the first failing position of an experiment is a partial aggregate over those rows, and the
loaders from there on are void. So all experiments are decided in one plan, whatever their number of loaders.
"""

from __future__ import annotations

import posixpath
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtables import fixed, schemas
from seqtables.operators import manifests, rollups
from seqtables.session import shared_folder
from seqtables.sources import buckets, inventory, readers, storage

#: Loaders that name a table after the experiment's genome, and loaders that read their file.
NEED_GENOME = ("upload_iaintersect_result", *fixed.COVERAGE_TRACKS)
READ_FILE = tuple(readers.READERS)


def rejects(rule: str, rows: DataFrame) -> DataFrame:
    """(uid, rule, line) of what a loader cannot load, from its reader's rows. A one-record file without values counts."""
    fields = [c for c in rows.columns if c not in ("uid", "reject")]
    line = F.col("reject")
    if rule in readers.WHOLE_FILE:
        line = F.when(line.isNull() & F.coalesce(*fields).isNull(), "").otherwise(line)
    return rows.select("uid", F.lit(rule).alias("rule"), line.alias("line")).filter("line is not null")


def verdicts(experiments: DataFrame, rules: DataFrame, settings: DataFrame, genome: DataFrame, files: DataFrame,
             rejected: DataFrame) -> DataFrame:
    """uid, position, rule, path and why: null for a loader that can load, else what keeps it from that.

    ``experiments`` has uid, experimenttype_id and genome_id, ``files`` path and length of every file there is, ``rejected``
    the rows of ``rejects`` (a file of length 0 gives a reader no row, so a one-record file is judged by its length). A loader's sources are looked at in the order the loader needs them: its name, the genome, the
    file, the lines.
    """
    listed = manifests.output_manifest(experiments, rules, settings, keep=("genome_id",))
    known = genome.select(F.col("id").alias("genome_id")).distinct().withColumn("has_genome", F.lit(True))
    there = files.groupBy("path").agg(F.max("length").alias("length"))
    first = rejected.groupBy("uid", "rule").agg(F.min("line").alias("line"))
    joined = listed.join(known, "genome_id", "left").join(there, "path", "left").join(first, ["uid", "rule"], "left")
    missing = lambda c: F.col(c).isNull()
    why = (
        F.when(~F.col("rule").isin(*fixed.RESULT_FILES), F.concat(F.lit("'"), "rule", F.lit("'")))
        .when(F.col("rule").isin(*NEED_GENOME) & missing("has_genome"), "DB not found")
        .when(F.col("rule").isin(*READ_FILE) & missing("length"),
              F.concat(F.lit("[Errno 2] No such file or directory: '"), "path", F.lit("'")))
        .when(F.col("rule").isin(*readers.WHOLE_FILE) & (F.col("length") == 0), "cannot load ''")
        .when(F.col("rule").isin(*READ_FILE) & F.col("line").isNotNull(), F.concat(F.lit("cannot load '"), "line", F.lit("'")))
    )
    return joined.select("uid", "position", "rule", "path", why.alias("why"))


def upload_outcome(experiments: DataFrame, rules: DataFrame, found: DataFrame) -> DataFrame:
    """uid, event (``completed`` or ``failed``), position and rule of the loader that failed, and the event's message.

    An empty list of loaders completes. An experiment whose type has no readable list has no outcome.
    """
    lists = rules.filter(F.from_json("upload_rules", "array<string>").isNotNull()).select("experimenttype_id")
    failing = F.when(F.col("why").isNotNull(), F.col("position"))
    folded = found.groupBy("uid").agg(F.min_by(F.struct("position", "rule", "why"), failing).alias("first"))
    message = F.concat(F.lit("Failed to upload "), "first.rule", F.lit(" : "), "uid", F.lit(" : "), "first.why")
    return experiments.join(lists, "experimenttype_id").select("uid").join(folded, "uid", "left").select(
        "uid", F.when(F.col("first.rule").isNull(), "completed").otherwise("failed").alias("event"),
        F.col("first.position").alias("position"), F.col("first.rule").alias("rule"), message.alias("message"))


def effective(found: DataFrame, outcome: DataFrame) -> DataFrame:
    """uid, position, rule and path of the loaders that take effect: those before the experiment's failing one."""
    failed = outcome.select("uid", F.col("position").alias("failed_at"))
    return found.join(failed, "uid").filter("failed_at is null or position < failed_at").select("uid", "position", "rule", "path")


def outcome_events(outcome: DataFrame, now: Column | None = None) -> DataFrame:
    """The outcomes as rows of the status log, without ids: the log gives them."""
    now = F.current_timestamp() if now is None else now
    return outcome.select("uid", now.cast("timestamp_ntz").alias("ts"), F.lit(None).cast("bigint").alias("event_id"), "event", "message")


def load_results(spark: SparkSession, folder: str, experiments: DataFrame, rules: DataFrame, settings: DataFrame,
                 genome: DataFrame, tables: str, now: Column | None = None, count: int | None = None) -> dict[str, DataFrame]:
    """Load the results of finished experiments from ``folder`` (one folder an experiment) into the tables below ``tables``.

    Each loader that takes effect replaces its experiment's rows, by none where its file has none. Returned are the
    ``events`` to log and, for ``lifecycle.apply_metrics``, the ``counts``, ``fragments`` and ``sizes``. A loader that fails
    loads nothing, not the lines before the one it cannot load.
    """
    rows = {rule: readers.load(spark, rule, f"{folder.rstrip('/')}/*/") for rule in READ_FILE}
    rejected = None
    for rule, read in rows.items():
        more = rejects(rule, read)
        rejected = more if rejected is None else rejected.unionByName(more)
    files = inventory.inventory(spark, folder)
    found = kept(verdicts(experiments, rules, settings, genome, files, rejected), "verdicts")
    outcome = kept(upload_outcome(experiments, rules, found), "outcomes")
    active = kept(effective(found, outcome), "loaders")

    def of(*names: str) -> DataFrame:
        return active.filter(F.col("rule").isin(*names)).select("uid").distinct()

    def accepted(rule: str) -> DataFrame:
        return readers.accepted(rows[rule]).join(of(rule), "uid", "left_semi")

    def put(name: str, table: DataFrame, uids: DataFrame, order: Sequence[str]) -> None:
        buckets.replace(schemas.stored(table, name), f"{tables}/{name}", uids, order, count)

    isoforms, peaks = kept(accepted("upload_rpkm"), "isoforms"), kept(accepted("upload_iaintersect_result"), "peaks")
    by_rule = {"upload_rpkm": (("isoforms", isoforms), ("genes", rollups.genes(isoforms)), ("common_tss", rollups.common_tss(isoforms))),
               "upload_iaintersect_result": (("islands", peaks), ("browser_islands", rollups.peaks_bed(peaks))),
               "upload_atdp": (("atdp", accepted("upload_atdp")),)}
    orders = {"browser_islands": ("chrom", "chrom_start"), "islands": ("chrom", "start_pos"), "atdp": ("x",)}
    for rule, made in by_rule.items():
        for name, table in made:
            put(name, table, of(rule), orders.get(name, ("chrom", "tx_start")))
    tracks = manifests.track_registry(experiments, rules, genome, settings)
    track_of = {strand: rule for rule, (strand, _) in fixed.COVERAGE_TRACKS.items()}
    rule_of = F.when(F.col("strand").isNull(), track_of[None]).when(F.col("strand") == "+", track_of["+"]).otherwise(track_of["-"])
    coverage = active.filter(F.col("rule").isin(*fixed.COVERAGE_TRACKS)).select("uid", "rule")
    put("coverage", tracks.withColumn("rule", rule_of).join(coverage, ["uid", "rule"], "left_semi").drop("rule"),
        of(*fixed.COVERAGE_TRACKS), ("genome_db",))
    measured = storage.footprint_kib(inventory.of_experiments(files, f"/{re.escape(posixpath.basename(folder.rstrip('/')))}/([^/]+)/"))
    sizes = of("upload_folder_size").join(measured, "uid", "left").select("uid", F.coalesce("size", F.lit(0.0)).alias("size"))
    return {"events": outcome_events(outcome, now), "counts": accepted("upload_get_stat"),
            "fragments": accepted("upload_macs2_fragment_stat"), "sizes": sizes, "loaders": active}


def kept(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read back: they are decided once and used several times."""
    path = shared_folder(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
