"""The experiment dimension, its paths, its genome and its job inputs.

Joins carry no broadcast hint: the dimension tables are broadcast only while Spark's own size
estimate stays under ``spark.sql.autoBroadcastJoinThreshold``; beyond it the join shuffles and
adaptive execution splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtables import fixed
from seqtables.functions import jobjson, text

FLAGS = ("pair", "dutp", "forcerun", "spike", "force_fragment_size", "broad_peak", "remove_duplicates")

# names a job template may use
JOB_FIELDS = (
    "uid", "etype", "workflow", "db", "findex", "genome", "annotation", "annottable", "genome_size", "url",
    "deleted", "params", "clip_5p_end", "clip_3p_end", "exp_fragment_size", "control", "control_id", "email",
    "pair", "dUTP", "forcerun", "spike", "force_fragment_size", "broad_peak", "remove_duplicates",
    "raw_data", "upload", "indices", "threads", "experimentsdb", "fastq_file_upstream",
    "fastq_file_downstream", "star_indices_folder", "bowtie_indices_folder", "bowtie_indices_folder_ribo",
    "chrom_length", "annotation_input_file", "exclude_chr", "output_folder", "control_file",
)


def experiment_dim(
    labdata: DataFrame, experimenttype: DataFrame, genome: DataFrame, antibody: DataFrame, worker: DataFrame
) -> DataFrame:
    """One row per experiment whose type and genome exist, with defaults and flags."""
    l, e, g, a, w = (
        labdata.alias("l"), experimenttype.alias("e"), genome.alias("g"), antibody.alias("a"), worker.alias("w")
    )
    or_zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    joined = (
        l.join(e, F.col("l.experimenttype_id") == F.col("e.id"))
        .join(g, F.col("l.genome_id") == F.col("g.id"))
        .join(a, F.col("l.antibody_id") == F.col("a.id"), "left")
        .join(w, F.col("l.worker_id") == F.col("w.id"), "left")
    )
    type_columns = [F.col(f"e.{c}") for c in experimenttype.columns if c != "id"]
    genome_columns = [F.col(f"g.{c}") for c in genome.columns if c not in ("id", "gsize")]
    return joined.select(
        F.col("l.id"), F.col("l.uid"), *type_columns, *genome_columns,
        F.col("g.gsize").alias("genome_size"),
        F.col("l.url"), F.col("l.deleted"), F.col("l.libstatus"),
        F.when(F.length("l.params") > 0, F.col("l.params")).otherwise("{}").alias("params"),
        or_zero("l.trim5").alias("clip_5p_end"),
        or_zero("l.trim3").alias("clip_3p_end"),
        or_zero("l.fragmentsizeexp").alias("exp_fragment_size"),
        or_zero("l.control").alias("control"),
        F.coalesce("l.control_id", F.lit("")).alias("control_id"),
        F.coalesce("w.email", F.lit("")).alias("email"),
        F.contains("e.etype", F.lit("pair")).alias("pair"),
        F.contains("e.etype", F.lit("dUTP")).alias("dutp"),
        (F.col("l.forcerun") == 1).alias("forcerun"),
        F.contains("g.genome", F.lit("spike")).alias("spike"),
        (or_zero("l.fragmentsizeforceuse") == 1).alias("force_fragment_size"),
        (or_zero("a.properties") == 2).alias("broad_peak"),
        (or_zero("l.rmdup") == 1).alias("remove_duplicates"),
    )


def settings_row(settings: DataFrame) -> Column:
    """The settings the paths need as one struct, in a scalar subquery.

    Only the named keys are read, so the subquery's single row has a fixed width. The three base
    folders lose the slashes they begin with, are normalised and lose a lone trailing slash, so that parts can be
    appended. A folder whose setting is missing is null, and so is every path below it.
    """
    wanted = settings.filter(F.col("k").isin(*fixed.SETTING_KEYS))
    fields = [F.max(F.when(F.col("k") == key, F.col("v"))).alias(key) for key in fixed.SETTING_KEYS]
    folders = F.array(*[F.concat("wardrobe", F.lit("/"), F.ltrim(F.col(key), F.lit("/"))) for key in ("preliminary", "upload", "indices")])
    return wanted.agg(*fields).select("*", text.norm_paths(folders).alias("folders")).select(
        F.struct(
            *[F.col("folders")[i].alias(name) for i, name in enumerate(("raw_data", "upload", "indices"))],
            F.col("maxthreads").alias("threads"), F.col("experimentsdb"),
        ).alias("s")
    ).scalar()


def experiment_paths(dim: DataFrame, settings: DataFrame) -> DataFrame:
    """The experiment dimension with its folder and file columns.

    Uids, index names and control ids are normally plain names, so joining them to the normalised
    base folders already gives normal paths; only other rows are normalised. A path with a missing part is null,
    never a shorter one.
    """
    raw, uid, index, control = F.col("raw_data"), F.col("uid"), F.col("findex"), F.col("control_id")
    slashed = lambda parts: [x for p in parts for x in (F.lit("/"), F.lit(p) if isinstance(p, str) else p)][1:]
    below = lambda *parts: F.concat(*slashed(parts))
    indices = lambda *parts: below(F.col("indices"), *parts)
    joined = {
        "fastq_file_upstream": below(raw, uid, F.concat(uid, F.lit(".fastq.bz2"))),
        "fastq_file_downstream": below(raw, uid, F.concat(uid, F.lit("_2.fastq.bz2"))),
        "star_indices_folder": indices(fixed.STAR_FOLDER, index),
        "bowtie_indices_folder": indices(fixed.BOWTIE_FOLDER, index),
        "bowtie_indices_folder_ribo": indices(fixed.BOWTIE_FOLDER, F.concat(index, F.lit("_ribo"))),
        "chrom_length": indices(fixed.BOWTIE_FOLDER, index, fixed.CHROM_LENGTH_FILE),
        "annotation_input_file": indices(fixed.ANNOTATION_FOLDER, index, fixed.ANNOTATION_FILE),
        "output_folder": below(raw, uid),
        "control_file": F.when(control != "", below(raw, control, F.concat(control, F.lit(".bam")))),
    }
    plain = text.is_plain_name(uid) & text.is_plain_name(index) & ((control == "") | text.is_plain_name(control)) \
        & (raw != "/") & (F.col("indices") != "/")
    staged = (
        dim.withColumn("s", settings_row(settings)).select(*dim.columns, "s.*")
        .withColumns({"joined": F.array(*joined.values()), "plain": plain})
    )
    paths = F.when(F.col("plain"), F.col("joined")).otherwise(text.norm_paths(F.col("joined")))
    return staged.withColumn("paths", paths).withColumns({
        **{name: F.col("paths")[i] for i, name in enumerate(joined)},
        "exclude_chr": F.when(F.col("spike"), "control").otherwise(""),
    }).drop("joined", "plain", "paths")


def experiment_genome(labdata: DataFrame, genome: DataFrame) -> DataFrame:
    """Each experiment's genome database; ``found`` is false where the genome is missing."""
    return labdata.alias("l").join(genome.alias("g"), F.col("l.genome_id") == F.col("g.id"), "left").select(
        F.col("l.uid"), F.col("g.db").alias("db"), F.col("g.db").isNotNull().alias("found")
    )


def with_template_parts(experimenttype: DataFrame) -> DataFrame:
    """Experiment types with their template cut into parts, once per type."""
    return experimenttype.withColumn("template_parts", text.template_parts(F.col("template"), JOB_FIELDS))


def job_inputs(paths: DataFrame) -> DataFrame:
    """The job object of each experiment: its type's template filled, unset inputs removed.

    ``paths`` comes from types prepared by ``with_template_parts``.
    """
    def value(field: str) -> Column:
        name = "dutp" if field == "dUTP" else field
        return F.when(F.col(name), "True").otherwise("False") if name in FLAGS else F.col(name)

    # the generator keeps the optimizer from building the texts anew for every template part
    texts = F.explode(F.array(text.placeholder_texts([value(f) for f in JOB_FIELDS]))).alias("texts")
    filled = jobjson.booleans_unquoted(text.fill_parts(F.col("template_parts"), F.col("texts")))
    return (
        paths.select("uid", "etype", "workflow", "template_parts", texts)
        .select("uid", "etype", "workflow", filled.alias("filled"))
        .withColumn("object", jobjson.parsed(F.col("filled")))
        .select("uid", "etype", "workflow", jobjson.set_inputs_sorted(F.col("filled"), F.col("object")).alias("job"))
    )


def result_params(labdata: DataFrame, results: DataFrame) -> DataFrame:
    """New params of finished experiments: the result object plus the promoter kept from the old."""
    old = F.when(F.length("params") > 0, F.col("params")).otherwise("{}")
    return (
        labdata.select("uid", jobjson.parsed(old).alias("old"))
        .join(results.select("uid", jobjson.parsed(F.col("result")).alias("new")), "uid")
        .select("uid", jobjson.with_entry(
            F.col("new"), "promoter", jobjson.entry(F.col("old"), "promoter", str(fixed.DEFAULT_PROMOTER))
        ).alias("params"))
    )
