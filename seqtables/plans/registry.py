"""Every query by name: ``name -> (spark, sf_dir) -> DataFrame`` over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtables.operators import catalogue, downloads, experiments, lifecycle, manifests, queues, rollups, tracks, uploads
from seqtables.session import shared_folder
from seqtables.sources import buckets, fastq, inventory, readers, storage
from seqtables.sources.adapters import table
from seqtables.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# the clock of the queries that write dates, so that results can be compared
CLOCK = "2026-01-01 00:00:00"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _two_places(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 2) for c in columns})


# --- readers -------------------------------------------------------------------------------

def _lines(df: DataFrame, fields, separator: str, header: str, null_word: str | None = None) -> DataFrame:
    """Rows as the lines of result files. Each line stands below a header and an empty line, as the
    reader must drop both; generating them also keeps the text building out of the reader's plan."""
    names = [F.col(n).cast("string") for n, _ in fields]
    if null_word:
        names = [F.coalesce(n, F.lit(null_word)) for n in names]
    line = F.concat_ws(separator, *names)
    return df.select("uid", F.explode(F.array(F.lit(header), F.lit(""), line)).alias("value"))


@query
def read_isoforms(spark, sf):
    header = "RefseqId,GeneId,Chrom,TxStart,TxEnd,Strand,TotalReads,Rpkm"
    lines = _lines(table(spark, sf, "isoforms"), readers.ISOFORM_FIELDS, ",", header)
    return readers.accepted(readers.isoforms(lines))


@query
def read_peaks(spark, sf):
    lines = _lines(table(spark, sf, "peaks"), readers.PEAK_FIELDS, "\t", "refseq_id\tgene_id\ttxStart", "NULL")
    return readers.accepted(readers.peaks(lines))


@query
def read_atdp(spark, sf):
    lines = _lines(table(spark, sf, "atdp"), readers.PROFILE_FIELDS, "\t", "X\tY")
    return readers.accepted(readers.profile(lines))


@query
def read_align_stat(spark, sf):
    bodies = table(spark, sf, "stat_tokens").select("uid", F.concat("body", F.lit("\n")).alias("value"))
    return readers.accepted(readers.align_stat(bodies))


@query
def read_fragment_stat(spark, sf):
    bodies = table(spark, sf, "fragment_tokens").select("uid", F.concat("body", F.lit("\n")).alias("value"))
    return readers.accepted(readers.fragment_stat(bodies))


# --- rollups -------------------------------------------------------------------------------

@query
def genes(spark, sf):
    return _two_places(rollups.genes(table(spark, sf, "isoforms")), "tot_r_0", "rpkm_0")


@query
def common_tss(spark, sf):
    return _two_places(rollups.common_tss(table(spark, sf, "isoforms")), "tot_r_0", "rpkm_0")


@query
def peaks_bed(spark, sf):
    return _two_places(rollups.peaks_bed(table(spark, sf, "islands")), "name")


# --- experiments ---------------------------------------------------------------------------

def _types(spark, sf) -> DataFrame:
    """The experiment types with template and rules."""
    ids = table(spark, sf, "experimenttype").select("id", "etype")
    return ids.join(catalogue.seed(spark).drop("insert_position"), "etype").select(
        "id", "etype", "workflow", "template", "upload_rules")


def _dim(spark, sf, types: DataFrame | None = None) -> DataFrame:
    t = lambda name: table(spark, sf, name)
    return experiments.experiment_dim(
        t("labdata_full"), t("experimenttype") if types is None else types,
        t("genome_full"), t("antibody"), t("worker"))


@query
def experiment_dim(spark, sf):
    return _dim(spark, sf)


@query
def experiment_paths(spark, sf):
    dim = _dim(spark, sf)
    paths = experiments.experiment_paths(dim, table(spark, sf, "settings"))
    return paths.select("uid", *[c for c in paths.columns if c not in dim.columns])


@query
def experiment_genome(spark, sf):
    return experiments.experiment_genome(table(spark, sf, "labdata"), table(spark, sf, "genome"))


@query
def job_inputs(spark, sf):
    dim = _dim(spark, sf, experiments.with_template_parts(_types(spark, sf)))
    return experiments.job_inputs(experiments.experiment_paths(dim, table(spark, sf, "settings")))


@query
def result_params(spark, sf):
    return experiments.result_params(table(spark, sf, "labdata"), table(spark, sf, "job_results"))


# --- browser tracks and manifests ----------------------------------------------------------

def _tracks(spark, sf, **views):
    t = lambda name: table(spark, sf, name)
    return tracks.track_db(t("labdata"), t("experimenttype"), t("genome"), **views)


@query
def track_db(spark, sf):
    return _tracks(spark, sf, views=(("hg19", "hg"),)).drop("genome_db")


@query
def track_db_all_genomes(spark, sf):
    return _tracks(spark, sf)


@query
def track_registry(spark, sf):
    t = lambda name: table(spark, sf, name)
    return manifests.track_registry(t("labdata"), t("upload_rules"), t("genome"), t("settings"))


@query
def output_manifest(spark, sf):
    t = lambda name: table(spark, sf, name)
    return manifests.output_manifest(t("labdata"), t("upload_rules"), t("settings"))


@query
def cleanup_manifest(spark, sf):
    t = lambda name: table(spark, sf, name)
    return manifests.cleanup_manifest(_ready(spark, sf), t("genome"), t("settings"))


# --- uploads -------------------------------------------------------------------------------

def _verdicts(spark, sf) -> DataFrame:
    t = lambda name: table(spark, sf, name)
    body = lambda name: t(name).select("uid", F.col("body").alias("value"))
    rejected = (
        uploads.rejects("upload_get_stat", readers.align_stat(body("stat_bodies")))
        .unionByName(uploads.rejects("upload_macs2_fragment_stat", readers.fragment_stat(body("fragment_bodies"))))
        .unionByName(uploads.rejects("upload_atdp", readers.profile(t("atdp_lines")))))
    return uploads.verdicts(t("finished"), t("upload_rules"), t("settings"), t("genome"), t("result_files"), rejected)


def _outcome(spark, sf, found: DataFrame) -> DataFrame:
    return uploads.upload_outcome(table(spark, sf, "finished"), table(spark, sf, "upload_rules"), found)


@query
def upload_outcome(spark, sf):
    return _outcome(spark, sf, _verdicts(spark, sf))


@query
def cleanup_files(spark, sf):
    t = lambda name: table(spark, sf, name)
    found = uploads.kept(_verdicts(spark, sf), "verdicts")
    uploaded = uploads.effective(found, _outcome(spark, sf, found)).filter("rule = 'delete_files'").select("uid")
    return manifests.cleanup_files(uploads.kept(_present(spark, sf).select("uid", "action"), "queue"), uploads.kept(uploaded, "uploaded"),
                                   t("settings"), t("store_files"))


# --- queues --------------------------------------------------------------------------------

@query
def download_queue(spark, sf):
    return queues.download_queue(table(spark, sf, "labdata")).select("id", "uid", "url")


@query
def reprocess_queue(spark, sf):
    return queues.reprocess_queue(table(spark, sf, "labdata")).select("uid", "action")


@query
def rna_completed(spark, sf):
    return queues.rna_completed(table(spark, sf, "labdata"), table(spark, sf, "experimenttype"))


@query
def route_source(spark, sf):
    return queues.route_source(table(spark, sf, "labdata"))


@query
def fetch_tasks(spark, sf):
    return queues.fetch_tasks(_dim(spark, sf))


@query
def copy_sources(spark, sf):
    return queues.copy_sources(_dim(spark, sf))


@query
def local_files(spark, sf):
    return queues.local_files(table(spark, sf, "labdata"), table(spark, sf, "local_paths"))


@query
def download_outcome(spark, sf):
    t = lambda name: table(spark, sf, name)
    underway = _dim(spark, sf).filter("libstatus = 1")
    checks = fastq.check_numbered(_numbered_lines(spark, sf), "uid", "mate")
    steps = downloads.download_steps(underway, queues.local_files(underway, t("local_paths")), t("fetched"), checks)
    return downloads.download_outcome(underway, steps, inventory.read_files(t("read_file_paths")))


def _present(spark, sf) -> DataFrame:
    t = lambda name: table(spark, sf, name)
    queue = queues.reprocess_queue(t("labdata"))
    files = inventory.read_files(t("read_file_paths"))
    return queues.files_present(queue, t("experimenttype"), t("genome"), files)


def _ready(spark, sf) -> DataFrame:
    return queues.ready_to_clean(_present(spark, sf))


@query
def files_present(spark, sf):
    return _present(spark, sf)


@query
def plugin_match(spark, sf):
    t = lambda name: table(spark, sf, name)
    return queues.plugin_match(t("labdata"), t("experimenttype"), t("plugintype"))


@query
def launch_requests(spark, sf):
    t = lambda name: table(spark, sf, name)
    last = t("last_events")
    caused = lambda df: df.join(last, "uid", "left")
    known = t("labdata").join(t("genome").select(F.col("id").alias("genome_id")), "genome_id")
    downloaded = known.filter("libstatus = 10").join(t("experimenttype").withColumnRenamed("id", "experimenttype_id"), "experimenttype_id")
    finished = t("labdata").filter("libstatus = 12")
    return queues.launches(
        caused(queues.download_queue(t("labdata"))),
        caused(downloaded),
        caused(_ready(spark, sf).filter("action = 'reprocess'")),
        caused(queues.plugin_match(finished, t("experimenttype"), t("plugintype"))),
        t("launch_log"),
    )


# --- state ---------------------------------------------------------------------------------

@query
def status_latest(spark, sf):
    return lifecycle.status_latest(table(spark, sf, "status_events"))


@query
def lifecycle_next(spark, sf):
    t = lambda name: table(spark, sf, name)
    clock = F.lit(CLOCK).cast("timestamp_ntz")
    events = lifecycle.pending_events(
        t("lifecycle_log"), queues.download_queue(t("labdata")), _ready(spark, sf), clock)
    new_params = experiments.result_params(t("labdata"), t("job_results"))
    after = lifecycle.lifecycle_next(t("labdata_full"), events.join(new_params, "uid", "left"))
    return after.select(
        "uid", "event", "applied_ts", "applied_id", "libstatus", "libstatustxt", "deleted", "forcerun", "dateanalyzes", "dateanalyzed",
        "dateanalyzee", F.col("datedel").cast("string").alias("datedel"), "params", *lifecycle.COUNTERS)


@query
def apply_metrics(spark, sf):
    t = lambda name: table(spark, sf, name)
    stat = readers.accepted(readers.align_stat(t("stat_tokens").select("uid", F.col("body").alias("value"))))
    # only DNA experiments leave fragment statistics
    dna = t("labdata").join(t("upload_rules").filter("upload_rules like '%fragment_stat%'"), "experimenttype_id")
    fragment = readers.accepted(readers.fragment_stat(
        t("fragment_tokens").join(dna.select("uid"), "uid").select("uid", F.col("body").alias("value"))))
    sizes = storage.footprint_kib(t("file_listing"))
    return lifecycle.apply_metrics(t("labdata_full"), stat, fragment, sizes).select("uid", *lifecycle.METRICS)


@query
def catalogue_upsert(spark, sf):
    return catalogue.upsert(table(spark, sf, "current_types"), catalogue.seed(spark))


# --- storage -------------------------------------------------------------------------------

@query
def replace_partition(spark, sf):
    path = shared_folder(spark, "isoforms")
    rows = table(spark, sf, "isoforms")
    storage.replace_experiments(rows, path, ("chrom", "tx_start"))
    again = rows.filter("uid = 'exp-1'").withColumn("tot_r_0", F.col("tot_r_0") * 2)
    storage.replace_experiments(again, path, ("chrom", "tx_start"))
    return spark.read.parquet(path).select(*rows.columns)


@query
def reload_experiments(spark, sf):
    """Density profiles, and then a seventh of the experiments again: half of those with other values, half without rows."""
    path = shared_folder(spark, "atdp")
    rows = table(spark, sf, "atdp")
    number = F.regexp_extract("uid", "([0-9]+)$", 1).cast("bigint")
    buckets.replace(rows, path, order=("x",), count=16)
    again = rows.filter(number % 7 == 3)
    buckets.replace(again.filter(number % 2 == 0).withColumn("y", F.col("y") * 2), path, again.select("uid"), ("x",))
    return buckets.read(spark, path, rows.schema)


@query
def footprint_kib(spark, sf):
    return storage.footprint_kib(table(spark, sf, "file_listing"))


# --- FASTQ ---------------------------------------------------------------------------------

def _numbered_lines(spark, sf) -> DataFrame:
    return fastq.record_lines(table(spark, sf, "fastq_records"))


@query
def fastq_valid(spark, sf):
    return fastq.check_numbered(_numbered_lines(spark, sf), "uid", "mate")


@query
def fastq_file_check(spark, sf):
    path = shared_folder(spark, "fastq")
    lines = _numbered_lines(spark, sf)
    order = ("mate", "uid", "line_no")
    # whole records per file: the range key is the record, not the line
    record = F.floor(F.col("line_no") / fastq.RECORD_LINES)
    (lines.repartitionByRange("mate", "uid", record).sortWithinPartitions(*order)
        .select("mate", "value").write.partitionBy("mate").text(path))
    per_file = fastq.check_files(fastq.fastq_lines(spark, path))
    mate = F.regexp_extract("file", "mate=([0-9]+)/", 1).cast("int")
    return per_file.groupBy(mate.alias("mate")).agg(
        F.sum("n_heads").alias("n_heads"), F.sum("n_pluses").alias("n_pluses"))


@query
def fastq_merge(spark, sf):
    return fastq.merge_sources(queues.copy_sources(_dim(spark, sf)), _numbered_lines(spark, sf))


# --- streams -------------------------------------------------------------------------------

def _run(stream) -> None:
    stream.awaitTermination()


@query
def queue_claim(spark, sf):
    out, checkpoint = shared_folder(spark, "claims"), shared_folder(spark, "claims-checkpoint")
    changes = table(spark, sf, "labdata", stream="orders").withColumn("attempt", F.lit(1))
    _run(jobs.claim_downloads(changes, out, checkpoint))
    return spark.read.parquet(out)


@query
def status_latest_stream(spark, sf):
    out, checkpoint = shared_folder(spark, "status"), shared_folder(spark, "status-checkpoint")
    _run(jobs.append_status_log(table(spark, sf, "status_events", stream="events"), out, checkpoint))
    return lifecycle.status_latest(spark.read.parquet(out))


@query
def status_current_stream(spark, sf):
    out, checkpoint = shared_folder(spark, "current"), shared_folder(spark, "current-checkpoint")
    _run(jobs.keep_current(table(spark, sf, "status_events", stream="events"), out, checkpoint, 16))
    return buckets.read(spark, out, jobs.CURRENT).drop("ts")
