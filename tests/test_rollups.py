from pyspark.sql import functions as F

from seqtables.operators import rollups
from seqtables.sources.adapters import table

SCHEMA = ("uid string, refseq_id string, gene_id string, chrom string, tx_start int, tx_end int, strand string, "
          "tot_r_0 double, rpkm_0 double")


def test_genes_lists_maxima_and_null_sums(rows):
    got = rollups.genes(rows([
        ("a", "N2", "G", "chr1", 5, 50, "+", 1.0, 2.0),
        ("a", "N1", "G", "chr2", 7, 40, "-", 2.0, None),
        ("a", "N2", "G", "chr1", 1, 60, "+", None, None),
        ("b", "N9", "G", "chr1", 1, 2, "+", None, None),
    ], SCHEMA))
    by = {r.uid: r.asDict() for r in got.collect()}
    assert by["a"] == dict(uid="a", gene_id="G", refseq_id="N1,N2", chrom="chr2", tx_start=7, tx_end=60,
                           strand="-", tot_r_0=3.0, rpkm_0=2.0)
    assert by["b"]["tot_r_0"] == 0.0 and by["b"]["rpkm_0"] == 0.0


def test_common_tss_groups_by_strand_end(rows):
    got = rollups.common_tss(rows([
        ("a", "N1", "G1", "chr1", 10, 50, "+", 1.0, 1.0),
        ("a", "N2", "G2", "chr1", 10, 70, "+", 1.0, 1.0),
        ("a", "N3", "G3", "chr1", 5, 50, "-", 1.0, 1.0),
        ("a", "N4", "G3", "chr1", 2, 50, "-", 1.0, 1.0),
        ("a", "N5", "G5", "chr1", 10, 50, ".", 1.0, 1.0),
        ("a", "N6", "G5", "chr1", 10, 50, None, 1.0, 1.0),
    ], SCHEMA)).collect()
    assert {(r.strand, r.tx_start, r.tx_end, r.refseq_id, r.gene_id, r.tot_r_0) for r in got} == {
        ("+", 10, 70, "N1,N2", "G1,G2", 2.0), ("-", 2, 50, "N3,N4", "G3", 2.0)}


def test_sums_are_kept(spark, sf):
    isoforms = table(spark, sf, "isoforms")
    total = lambda df: round(df.agg(F.sum("tot_r_0")).first()[0], 2)
    assert total(rollups.genes(isoforms)) == total(isoforms)
    assert total(rollups.common_tss(isoforms)) == total(isoforms.filter("strand in ('+', '-')"))


def test_one_gene_holding_a_third_of_the_rows(spark):
    n = 30000
    skewed = spark.range(n).select(
        F.lit("a").alias("uid"), F.concat(F.lit("N"), F.col("id") % 500).alias("refseq_id"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("G"), F.col("id") % 1000)).alias("gene_id"),
        F.lit("chr1").alias("chrom"), F.lit(1).alias("tx_start"), F.lit(2).alias("tx_end"), F.lit("+").alias("strand"),
        F.lit(1.0).alias("tot_r_0"), F.lit(1.0).alias("rpkm_0"))
    hot = rollups.genes(skewed).filter("gene_id = 'HOT'").first()
    assert hot.tot_r_0 == n / 3 and len(hot.refseq_id.split(",")) == 500


def test_peaks_bed_rounds_half_to_even(rows):
    got = rollups.peaks_bed(rows([
        ("a", "chr1", 1, 5, 2.0, 2.5), ("a", "chr1", 1, 5, 3.5, 1.0), ("a", "chr1", 2, 5, 1.0, 2.7),
    ], "uid string, chrom string, start_pos int, end_pos int, log10p double, log10q double")).collect()
    assert {(r.chrom_start, r.name, r.score, r.bin) for r in got} == {(1, 3.5, 2, 0), (2, 1.0, 3, 0)}
