"""Rollups of isoforms and peaks.

Every rollup keys on ``uid`` and works over all experiments. Lists need the distinct ids of a
group, so the rows are first folded to one row per (group, id): that step is a plain hash
aggregate with map-side partial sums, and it spreads a hot gene or start site over its ids
before the lists are put together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtables.functions.text import joined_distinct


def genes(isoforms: DataFrame) -> DataFrame:
    """Isoforms by gene: distinct refseq ids, extreme positions, summed reads and RPKM."""
    per_isoform = isoforms.groupBy("uid", "gene_id", "refseq_id", "chrom", "strand").agg(
        F.max("tx_start").alias("tx_start"),
        F.max("tx_end").alias("tx_end"),
        F.sum("tot_r_0").alias("tot_r_0"),
        F.sum("rpkm_0").alias("rpkm_0"),
    )
    return per_isoform.groupBy("uid", "gene_id").agg(
        joined_distinct(F.col("refseq_id")).alias("refseq_id"),
        F.max("chrom").alias("chrom"),
        F.max("tx_start").alias("tx_start"),
        F.max("tx_end").alias("tx_end"),
        F.max("strand").alias("strand"),
        F.coalesce(F.sum("tot_r_0"), F.lit(0.0)).alias("tot_r_0"),
        F.coalesce(F.sum("rpkm_0"), F.lit(0.0)).alias("rpkm_0"),
    )


def common_tss(isoforms: DataFrame) -> DataFrame:
    """Isoforms that share a transcription start site.

    The site is txStart on '+' and txEnd on '-'; rows on other strands have none. One aggregate
    with the site as key covers both strands.
    """
    site = F.when(F.col("strand") == "+", F.col("tx_start")).otherwise(F.col("tx_end"))
    per_isoform = (
        isoforms.filter(F.col("strand").isin("+", "-"))
        .groupBy("uid", "chrom", "strand", site.alias("site"), "refseq_id", "gene_id")
        .agg(
            F.min("tx_start").alias("tx_start"),
            F.max("tx_end").alias("tx_end"),
            F.sum("tot_r_0").alias("tot_r_0"),
            F.sum("rpkm_0").alias("rpkm_0"),
        )
    )
    return per_isoform.groupBy("uid", "chrom", "strand", "site").agg(
        joined_distinct(F.col("refseq_id")).alias("refseq_id"),
        joined_distinct(F.col("gene_id")).alias("gene_id"),
        F.min("tx_start").alias("tx_start"),
        F.max("tx_end").alias("tx_end"),
        F.coalesce(F.sum("tot_r_0"), F.lit(0.0)).alias("tot_r_0"),
        F.coalesce(F.sum("rpkm_0"), F.lit(0.0)).alias("rpkm_0"),
    ).drop("site")


def peaks_bed(islands: DataFrame) -> DataFrame:
    """Peaks as browser BED rows, one per interval.

    ``name`` stays a number here; ``schemas.stored`` turns it into text. ``score`` is rounded, as it is when
    a real number is stored in an integer column.
    """
    return islands.groupBy("uid", "chrom", "start_pos", "end_pos").agg(
        F.lit(0).alias("bin"),
        F.max("log10p").alias("name"),
        F.rint(F.max("log10q")).cast("int").alias("score"),
    ).select(
        "uid", "bin", "chrom",
        F.col("start_pos").cast("bigint").alias("chrom_start"),
        F.col("end_pos").cast("bigint").alias("chrom_end"),
        "name", "score",
    )
