"""Lists of what an experiment writes and what a clean-up removes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtables import fixed
from seqtables.functions import text
from seqtables.operators.experiments import settings_row


def _folder(uid: Column, raw_data: Column) -> Column:
    """The folder of an experiment's files."""
    joined = F.concat(raw_data, F.lit("/"), uid)
    return F.when(text.is_plain_name(uid) & (raw_data != "/"), joined).otherwise(text.norm_path(joined))


def output_manifest(
    experiments: DataFrame, rules: DataFrame, settings: DataFrame, keep: Sequence[str] = ()
) -> DataFrame:
    """The files each experiment is expected to leave, in loader order.

    ``rules`` holds a JSON list of loader names per type; a name without a loader gives a null
    path. ``keep`` names more columns of ``experiments`` to carry.
    """
    file_names = F.create_map(*[F.lit(x) for pair in fixed.RESULT_FILES.items() for x in pair])
    per_type = rules.select(
        F.col("experimenttype_id").alias("type_id"),
        F.posexplode(F.from_json("upload_rules", "array<string>")).alias("position", "rule"),
    ).withColumn("file_name", F.try_element_at(file_names, F.col("rule")))
    uid = F.col("uid")
    return (
        experiments.withColumn("s", settings_row(settings)).withColumn("folder", _folder(uid, F.col("s.raw_data")))
        .join(per_type, F.col("experimenttype_id") == F.col("type_id"))
        .select(
            "uid", *keep, F.col("position").cast("int").alias("position"), "rule",
            F.concat("folder", F.lit("/"), F.replace(F.col("file_name"), F.lit("{}"), uid)).alias("path"),
        )
    )


def track_registry(labdata: DataFrame, rules: DataFrame, genome: DataFrame, settings: DataFrame) -> DataFrame:
    """Coverage files of each experiment and the browser table that points to each."""
    def by_rule(part: int) -> Column:
        pairs = [F.lit(x) for rule, track in fixed.COVERAGE_TRACKS.items() for x in (rule, track[part])]
        return F.try_element_at(F.create_map(*pairs), F.col("rule"))

    databases = genome.select(F.col("id").alias("genome_id"), F.col("db").alias("genome_db"))
    manifest = output_manifest(labdata.join(databases, "genome_id"), rules, settings, keep=("genome_db",))
    return manifest.filter(F.col("rule").isin(*fixed.COVERAGE_TRACKS)).select(
        "uid", by_rule(0).alias("strand"), "genome_db",
        F.concat(text.browser_name(F.col("uid")), by_rule(1)).alias("table_name"),
        F.col("path").alias("file_name"),
    )


def _objects(database: Column, prefix: Column, groups: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """The objects of one experiment in one database, from (kind, suffixes)."""
    return F.array(*[
        F.struct(database.alias("db"), F.concat(prefix, F.lit(s)).alias("name"), F.lit(kind).alias("kind"))
        for kind, suffixes in groups for s in suffixes
    ])


def cleanup_manifest(queue: DataFrame, genome: DataFrame, settings: DataFrame) -> DataFrame:
    """Tables and views to drop for each queued experiment, in every browser database and in the
    results database.

    The distinct browser databases travel as one array, from a subquery of the same plan, and each queue row
    is expanded in place: the queue is read once and not shuffled, whatever the number of databases.
    """
    listed = genome.select("db").distinct().agg(F.array_sort(F.collect_set("db")).alias("dbs")).scalar()
    browser_groups = (("table", fixed.BROWSER_TABLE_SUFFIXES), ("view", fixed.BROWSER_VIEW_SUFFIXES))
    result_groups = (("table", fixed.RESULT_TABLE_SUFFIXES), ("view", fixed.RESULT_VIEW_SUFFIXES))
    # the results database follows the browser databases, as a null
    every = F.concat(F.coalesce("dbs", F.array().cast("array<string>")), F.array(F.lit(None).cast("string")))
    per_database = queue.select("uid").withColumn("dbs", listed).withColumn("s", settings_row(settings)).select(
        "uid", text.browser_name(F.col("uid")).alias("browser_uid"), F.col("s.experimentsdb").alias("results_db"),
        F.explode(every).alias("db"),
    )
    in_results = _objects(F.col("results_db"), F.col("uid"), result_groups)
    in_browser = _objects(F.col("db"), F.col("browser_uid"), browser_groups)
    return per_database.select("uid", F.inline(F.when(F.col("db").isNull(), in_results).otherwise(in_browser)))


def folders_above(files: DataFrame, folders: DataFrame) -> DataFrame:
    """path and folder: of the folders that a file lies in those as deep as one of ``folders``.

    The depths travel as one array, from a subquery of the same plan. So a file mostly makes one short row, and the folders
    that all files lie in, each a key of very many rows, make none.
    """
    parts = F.split("path", "/")
    depths = folders.filter("folder is not null").agg(F.collect_set(F.size(F.split("folder", "/")))).scalar()
    inside = F.filter("depths", lambda i: i < F.size(parts))
    above = F.transform(inside, lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    return files.withColumn("depths", depths).select("path", F.explode(above).alias("folder"))


def cleanup_files(queue: DataFrame, uploaded: DataFrame, settings: DataFrame, files: DataFrame) -> DataFrame:
    """Files and folders to remove: uid, reason, kind and path.

    ``queue`` has uid and action: before an experiment runs again (``reprocess``) every file of its folder goes whose name does
    not hold ``fastq``, and the folder ``tophat`` whole; a deleted one (``delete``) loses its folder. Of experiments in
    ``uploaded`` (uid, those whose ``delete_files`` took effect) the plain FASTQ files named after them go. ``files`` is an inventory.

    A file meets the experiments by an equi-join of the folders above it, so the whole store is read once. ``queue`` and
    ``uploaded`` are read twice.
    """
    named = queue.select("uid", F.col("action").alias("reason")).unionByName(uploaded.select("uid", F.lit("upload").alias("reason")))
    folders = named.withColumn("s", settings_row(settings)).select("uid", "reason", _folder(F.col("uid"), F.col("s.raw_data")).alias("folder"))
    placed = folders_above(files, folders).join(folders, "folder")
    rest, name = F.expr("substring(path, length(folder) + 2)"), text.base_name(F.col("path"))
    goes = (
        F.when(F.col("reason") == "delete", True)
        .when(F.col("reason") == "reprocess", ~F.contains(name, F.lit("fastq")) | F.startswith(rest, F.lit("tophat/")))
        .otherwise((rest == name) & F.startswith(name, "uid") & F.endswith(name, F.lit(".fastq")))
    )
    single = placed.filter(goes).select("uid", "reason", F.lit("file").alias("kind"), "path")
    whole = folders.filter("reason <> 'upload'").select(
        "uid", "reason", F.lit("folder").alias("kind"),
        F.when(F.col("reason") == "delete", F.col("folder")).otherwise(F.concat("folder", F.lit("/tophat"))).alias("path"))
    return single.unionByName(whole)
