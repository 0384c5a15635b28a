"""Work queues: downloads, reprocessing, copies, local files, plugins, launches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqtables import fixed
from seqtables.functions import text


# length of the pieces by which file names are looked up
PIECE = 8


def download_queue(labdata: DataFrame) -> DataFrame:
    """Experiments waiting for their first download. Works on a stream as well."""
    return labdata.filter(
        (F.col("libstatus") == fixed.START_DOWNLOAD) & (F.col("deleted") == 0)
        & F.col("url").isNotNull() & (F.col("url") != "")
    )


def reprocess_queue(labdata: DataFrame) -> DataFrame:
    """Experiments to run again or to delete, with the ``action``."""
    again = (F.col("forcerun") == 1) & (F.col("libstatus") > fixed.PROCESSING) & (F.col("deleted") == 0)
    gone = F.col("deleted") == 1
    return labdata.filter(again | gone).withColumn("action", F.when(gone, "delete").otherwise("reprocess"))


def rna_completed(labdata: DataFrame, experimenttype: DataFrame) -> DataFrame:
    """Finished RNA experiments that were not deleted."""
    done = labdata.filter((F.col("libstatus") == fixed.SUCCESS_PROCESS) & (F.col("deleted") == 0))
    rna = experimenttype.filter(F.startswith("etype", F.lit("RNA")))
    return done.alias("l").join(rna.alias("e"), F.col("l.experimenttype_id") == F.col("e.id")).select(
        F.col("l.uid"), F.col("e.etype")
    )


def route(url: Column) -> Column:
    """Where an experiment's reads come from: sra, url, copy or local. The first match wins."""
    return (
        F.when(url.rlike(fixed.ROUTE_ARCHIVE), "sra")
        .when(url.rlike(fixed.ROUTE_URL), "url")
        .when(url.rlike(fixed.ROUTE_COPY), "copy")
        .when(url.isNotNull(), "local")
    )


def route_source(experiments: DataFrame) -> DataFrame:
    """The route of every experiment that names a source."""
    return experiments.filter(F.col("url").isNotNull()).select("uid", "url", route(F.col("url")).alias("route"))


def fetch_tasks(dim: DataFrame) -> DataFrame:
    """What to fetch for archive and url experiments, one row per accession or mate.

    A paired url holds two addresses split by ';'. A missing second address stays as a row with
    a null source, since such an experiment cannot complete.
    """
    url, pair = F.col("url"), F.col("pair")
    routed = dim.filter(url.isNotNull()).select("uid", "pair", "url", route(url).alias("route"))
    halves = F.split("url", ";")
    half = lambda i: F.nullif(F.try_element_at(halves, F.lit(i)), F.lit(""))
    task = lambda source, mate, suffix: F.struct(
        source.alias("source"), F.lit(mate).cast("int").alias("mate"), F.lit(suffix).alias("suffix")
    )
    accessions = F.transform(F.split(F.trim(url), r"\s+"), lambda a: task(a, None, ""))
    tasks = (
        F.when(F.col("route") == "sra", accessions)
        .when((F.col("route") == "url") & pair, F.array(task(half(1), 1, ""), task(half(2), 2, "_2")))
        .when(F.col("route") == "url", F.array(task(url, 1, "")))
    )
    return routed.select("uid", "route", F.posexplode(tasks).alias("position", "task")).select(
        "uid", "route", F.col("position").cast("int").alias("position"), "task.source", "task.mate", "task.suffix"
    )


def copy_sources(dim: DataFrame) -> DataFrame:
    """Experiments whose reads are copied from others, with each source in list order.

    Repeated ids count once, at their first position. Sources of another pairing are left out.
    """
    # ids are compared as numbers, so 12 and 012 are one source
    ids = F.expr("array_distinct(transform(split(url, ' '), x -> try_cast(x as bigint)))")
    wanted = dim.filter(route(F.col("url")) == "copy").select("uid", "pair", F.posexplode(ids).alias("position", "source_id"))
    sources = dim.select(F.col("id").alias("source_id"), F.col("uid").alias("source_uid"), "pair")
    return wanted.join(sources, ["source_id", "pair"]).select(
        "uid", "pair", F.col("position").cast("int").alias("position"), "source_id", "source_uid"
    )


def local_files(experiments: DataFrame, paths: DataFrame) -> DataFrame:
    """Uploaded files whose name contains an experiment's url: skip none, use one or two, else error.

    The containment test runs as an equi-join on pieces of ``PIECE`` characters (a shorter url is one piece). Each
    url is looked up by its piece that is rarest among the urls, each name by all its pieces, and a pair that
    meets is compared at that place. So urls and names of any length take part, and a name makes one short row for each of
    its characters and each piece length in use. Matches are folded to count, first and last name before they meet the
    experiments, so a url shared by many experiments or files costs one row.
    """
    local = experiments.filter((F.col("url") != "") & (route(F.col("url")) == "local")).select("uid", "url")
    size = F.least(F.length("url"), F.lit(PIECE))
    urls = local.select("url").distinct()
    cut = urls.select("url", size.alias("size"), F.explode(F.sequence(F.lit(1), F.length("url") - size + 1)).alias("at"))
    cut = cut.withColumn("piece", F.expr("substring(url, at, size)"))
    common = cut.groupBy("piece").agg(F.count("*").alias("n"))
    keys = cut.join(common, "piece").groupBy("url").agg(
        F.min_by(F.struct("piece", "at"), F.struct("n", "at")).alias("key")).select("url", "key.piece", "key.at")
    sizes = urls.agg(F.array_sort(F.collect_set(size)).alias("sizes")).scalar()
    pieces = F.flatten(F.transform(
        F.filter(F.col("sizes"), lambda n: n <= F.length("name")),
        lambda n: F.transform(F.sequence(F.lit(1), F.length("name") - n + 1),
                              lambda i: F.struct(i.alias("place"), F.substring(F.col("name"), i, n).alias("piece")))))
    names = paths.select("path", text.base_name(F.col("path")).alias("name")).withColumn("sizes", sizes)
    found = (
        names.select("path", "name", F.inline(pieces))
        .join(keys, "piece")
        .filter(F.expr("place >= at and substring(name, place - at + 1, length(url)) = url"))
        .select("url", "path").distinct()
        .groupBy("url")
        .agg(F.count("*").alias("n_files"), F.min("path").alias("first"), F.max("path").alias("last"))
    )
    n = F.coalesce("n_files", F.lit(0))
    return local.join(found, "url", "left").select(
        "uid", "url", n.alias("n_files"),
        F.when(n == 0, "skip").when(n <= 2, "use").otherwise("error").alias("action"),
        F.when(n.between(1, 2), F.col("first")).alias("mate_1"),
        F.when(n == 2, F.col("last")).alias("mate_2"),
    )


def files_present(queue: DataFrame, experimenttype: DataFrame, genome: DataFrame, files: DataFrame) -> DataFrame:
    """Whether each queued experiment has the read files it needs: mate 1, and mate 2 if paired.

    Experiments of an unknown type or genome are left out, as they have no job.
    """
    by_uid = files.groupBy("uid").agg(
        F.bool_or(F.col("mate") == 1).alias("has_1"), F.bool_or(F.col("mate") == 2).alias("has_2")
    )
    types = experimenttype.select(F.col("id").alias("experimenttype_id"), "workflow",
                                  F.contains("etype", F.lit("pair")).alias("pair"))
    known = queue.join(types, "experimenttype_id").join(genome.select(F.col("id").alias("genome_id")), "genome_id")
    has = lambda name: F.coalesce(name, F.lit(False))
    return known.join(by_uid, "uid", "left").select(
        "uid", "action", "pair", "workflow", (has("has_1") & (~F.col("pair") | has("has_2"))).alias("present")
    )


def ready_to_clean(present: DataFrame) -> DataFrame:
    """Queue rows that are acted on: every delete, and reprocessing with its files present."""
    return present.filter((F.col("action") == "delete") | F.col("present"))


def plugin_match(labdata: DataFrame, experimenttype: DataFrame, plugintype: DataFrame) -> DataFrame:
    """Plugins to run for each experiment: those whose id list holds its type."""
    listed = plugintype.select(
        "ptype", "workflow",
        F.explode(F.array_distinct(F.from_json("etype_id", "array<int>"))).alias("type_id"),
    )
    per_type = experimenttype.select(F.col("id").alias("type_id")).join(listed, "type_id")
    return labdata.join(per_type, F.col("experimenttype_id") == F.col("type_id")).select(
        "uid", "ptype", F.replace(text.stem(F.col("workflow")), F.lit("."), F.lit("_dot_")).alias("job")
    )


def _request(rows: DataFrame, kind: str, prefix: str, job: Column) -> DataFrame:
    return rows.select("uid", F.lit(kind).alias("kind"), job.alias("job"), F.lit(prefix).alias("prefix"), "attempt")


def launch_requests(
    downloads: DataFrame, analyses: DataFrame, reruns: DataFrame, plugins: DataFrame, download_job: str = "download"
) -> DataFrame:
    """Runs to start, with ids that stay the same when a request is computed again.

    ``downloads`` needs uid and attempt, ``analyses`` and ``reruns`` also workflow, ``plugins``
    also job.
    """
    workflow_job = text.stem(text.base_name(F.col("workflow")))
    requests = (
        _request(downloads, "download", "trig", F.lit(download_job))
        .unionByName(_request(analyses, "analysis", "trig", workflow_job))
        .unionByName(_request(reruns, "reprocess", "forcerun", workflow_job))
        .unionByName(_request(plugins, "plugin", "trig", F.col("job")))
    )
    digest = F.sha2(F.concat_ws(":", "job", "uid", F.col("attempt").cast("string")), 256)
    return requests.select("uid", "kind", "job", F.concat_ws("__", "prefix", "uid", digest).alias("run_id"))


def _caused(rows: DataFrame, kind: str, prefix: str, job: Column) -> DataFrame:
    cause = F.concat(F.lit(f"{kind}:"), F.coalesce(F.col("event_id"), F.lit(0)).cast("string"))
    return rows.select("uid", F.lit(kind).alias("kind"), job.alias("job"), F.lit(prefix).alias("prefix"), cause.alias("cause"))


def numbered(requests: DataFrame, written: DataFrame) -> DataFrame:
    """Requests (uid, job, cause and more) with their attempt, given the launches written so far (uid, job, cause, attempt).

    A request whose cause was launched before has that launch's number again, so computing it anew gives the same
    run; another cause has the next number. Causes that come together are numbered in order.
    """
    last = written.groupBy("uid", "job").agg(F.max("attempt").alias("_last"))
    same = written.groupBy("uid", "job", "cause").agg(F.min("attempt").alias("_same"))
    joined = requests.join(last, ["uid", "job"], "left").join(same, ["uid", "job", "cause"], "left")
    place = F.dense_rank().over(Window.partitionBy("uid", "job", F.col("_same").isNull()).orderBy("cause"))
    attempt = F.coalesce("_same", F.coalesce("_last", F.lit(0)) + place).cast("int")
    return joined.withColumn("attempt", attempt).drop("_last", "_same")


def run_id(prefix: Column, job: Column, uid: Column, attempt: Column) -> Column:
    """The id of a run: the same for the same job, experiment and attempt."""
    return F.concat_ws("__", prefix, uid, F.sha2(F.concat_ws(":", job, uid, attempt.cast("string")), 256))


def launches(downloads: DataFrame, analyses: DataFrame, reruns: DataFrame, plugins: DataFrame, written: DataFrame,
             download_job: str = "download") -> DataFrame:
    """Runs to start: uid, kind, job, cause, attempt, run_id. Appended to ``written`` they are known the next time.

    Each frame has uid and event_id, the experiment's last status event, which brought it into the queue (null: none yet);
    ``analyses`` and ``reruns`` also workflow, ``plugins`` also job. So a second forced run follows another event than the
    first, is another attempt and has another id, and a queue that is read twice gives the same ids.
    """
    workflow_job = text.stem(text.base_name(F.col("workflow")))
    requests = (
        _caused(downloads, "download", "trig", F.lit(download_job))
        .unionByName(_caused(analyses, "analysis", "trig", workflow_job))
        .unionByName(_caused(reruns, "reprocess", "forcerun", workflow_job))
        .unionByName(_caused(plugins, "plugin", "trig", F.col("job")))
    )
    ident = run_id(F.col("prefix"), F.col("job"), F.col("uid"), F.col("attempt"))
    return numbered(requests, written).select("uid", "kind", "job", "cause", "attempt", ident.alias("run_id"))
