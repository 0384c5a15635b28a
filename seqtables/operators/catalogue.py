"""The experiment-type catalogue: seed rows and their upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqtables import fixed


def _entry(key: str, kind: str, value: str) -> str:
    if kind == "raw":
        return f'"{key}": {value}'
    if kind == "text":
        return f'"{key}": "{value}"'
    if kind == "dir":
        return f'"{key}": {{{{"class": "Directory", "location": "{value}"}}}}'
    return f'"{key}": {{{{"class": "File", "location": "{value}", "format": "{fixed.EDAM_FORMAT}{kind}"}}}}'


def job_template(etype: str) -> str:
    """The job template of an experiment type, from its family's entries."""
    entries = fixed.FASTQ_PAIRED if "pair" in etype else fixed.FASTQ_SINGLE
    if "DNA" in etype:
        entries += fixed.DNA_ENTRIES
    else:
        entries += fixed.STAR_ENTRY
        if "Mitochondrial" in etype:
            entries += fixed.STAR_MITO_ENTRY
        entries += fixed.RNA_ENTRIES
    return "{{" + ", ".join(_entry(*e) for e in entries) + "}}"


def upload_rules(etype: str) -> tuple[str, ...]:
    if "DNA" in etype:
        return fixed.RULES_DNA
    return fixed.RULES_RNA_STRANDED if "dUTP" in etype else fixed.RULES_RNA


def seed(spark: SparkSession) -> DataFrame:
    """The seed types: etype, workflow, template, upload_rules, insert_position (null: update only).

    Built from literals, so that the planner knows how small it is.
    """
    rows, position = [], 0
    for etype, workflow, inserted in fixed.EXPERIMENT_TYPES:
        position += inserted
        rules = "[" + ",".join(f'"{r}"' for r in upload_rules(etype)) + "]"
        rows.append(F.struct(
            F.lit(etype).alias("etype"), F.lit(workflow).alias("workflow"),
            F.lit(job_template(etype)).alias("template"), F.lit(rules).alias("upload_rules"),
            F.lit(position if inserted else None).cast("int").alias("insert_position"),
        ))
    return spark.range(1).select(F.inline(F.array(*rows)))


def upsert(current: DataFrame, seeds: DataFrame) -> DataFrame:
    """Current types with the seed's values by ``etype``; absent insertable types get the next ids.

    ``current`` may lack the workflow, template and upload_rules columns. The seed side is
    broadcast: it is the fixed list of ``fixed.EXPERIMENT_TYPES``.
    """
    values = ("workflow", "template", "upload_rules")
    base = current.select(
        F.col("id").cast("bigint").alias("id"), "etype",
        *[F.col(c) if c in current.columns else F.lit(None).cast("string").alias(c) for c in values],
    )
    updated = base.alias("c").join(F.broadcast(seeds).alias("s"), "etype", "left").select(
        F.col("c.id"), F.col("etype"), *[F.coalesce(f"s.{c}", f"c.{c}").alias(c) for c in values]
    )
    known = base.join(F.broadcast(seeds.select("etype")), "etype").select("etype").distinct()
    absent = seeds.filter("insert_position is not null").join(known, "etype", "left_anti")
    last_id = F.coalesce(base.agg(F.max("id").alias("last")).scalar(), F.lit(0))
    # at most len(EXPERIMENT_TYPES) rows are numbered here
    numbered = absent.withColumn("id", last_id + F.row_number().over(Window.orderBy("insert_position")))
    return updated.unionByName(numbered.select("id", "etype", *values))
