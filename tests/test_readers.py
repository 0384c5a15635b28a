import pytest

from seqtables.sources import readers

LINES = "uid string, value string"


def test_isoforms_skip_headers_and_reject_bad_lines(rows):
    lines = rows([
        ("a", "RefseqId,GeneId,Chrom,TxStart,TxEnd,Strand,TotalReads,Rpkm"),
        ("a", ""),
        ("a", "NM_1,G1,chr1,10,20,+,3,1.5"),
        ("a", "NM_GeneId,G1,chr1,10,20,+,3,1.5"),
        ("a", "NM_2,G1,chr1,10,20,+,3"),
        ("a", "NM_3,G1,chr1,ten,20,+,3,1.5"),
        ("b", 'NM "4",,chr1,10,,-,3,1e2'),
        ("b", "NULL,G\\5,chr1,10,20,-,3,2"),
    ], LINES)
    parsed = readers.isoforms(lines)
    good = {tuple(r) for r in readers.accepted(parsed).collect()}
    assert good == {
        ("a", "NM_1", "G1", "chr1", 10, 20, "+", 3.0, 1.5),
        ("b", 'NM "4"', "", "chr1", 10, None, "-", 3.0, 100.0),
        ("b", "NULL", "G\\5", "chr1", 10, 20, "-", 3.0, 2.0),
    }
    assert {r.line[:4] for r in readers.rejected(parsed).collect()} == {"NM_2", "NM_3"}


def test_peaks_nulls_long_ids_and_blanks(rows):
    long_id, edge_id = "N" * 500, "M" * 499
    tail = "10 20 + chr1 100 200 100 150 5.5 1.25 2.0 0.5 exon"
    lines = rows([
        ("a", "refseq_id\tgene_id\ttxStart"),
        ("a", f"  {long_id}\t{edge_id} " + tail.replace(" ", "\t") + "  "),
        ("a", "NULL NULL NULL NULL NULL chr2  7 8 1 7 1 1 1 1 NULL"),
        ("a", " \t "),
        ("a", "x y z"),
    ], LINES)
    parsed = readers.peaks(lines)
    got = {r.chrom: r for r in readers.accepted(parsed).collect()}
    assert len(got["chr1"].refseq_id) == 450 and got["chr1"].gene_id == edge_id
    assert got["chr1"].start_pos == 100 and got["chr1"].log10q == 0.5 and got["chr1"].region == "exon"
    assert got["chr2"].refseq_id is None and got["chr2"].tx_start is None and got["chr2"].region is None
    assert [r.line for r in readers.rejected(parsed).collect()] == ["x y z"]


def test_profile(rows):
    parsed = readers.profile(rows([("a", "X\tY"), ("a", " -100\t0.25 "), ("a", "1 2 3")], LINES))
    assert [tuple(r) for r in readers.accepted(parsed).collect()] == [("a", -100, 0.25)]
    assert readers.rejected(parsed).count() == 1


@pytest.mark.parametrize("body,expected", [
    ("100 90 7 80\n", (100, 90, 7, 7, 80)),
    ("100 90 3 7\n80", (100, 90, 3, 7, 80)),
    ("1 2 3", None),
    ("1 2 3 4 5 6", None),
    ("1 2 x 4 5", None),
])
def test_align_stat(rows, body, expected):
    parsed = readers.align_stat(rows([("a", body)], LINES))
    got = [tuple(r)[1:] for r in readers.accepted(parsed).collect()]
    assert got == ([expected] if expected else [])
    assert readers.rejected(parsed).count() == (0 if expected else 1)


def test_load_from_files(spark, tmp_path):
    (tmp_path / "exp-1.isoforms.csv").write_text("RefseqId,GeneId,x\nNM_1,G1,chr1,1,2,+,3,4\n\nNM_2,G1,chr1,1,2,-,3,4\n")
    (tmp_path / "exp 2+3%.isoforms.csv").write_text("NM_1,G1,chr1,1,2,+,3,4\n")
    (tmp_path / "exp-2.stat").write_text("10 9 3\n8\n")
    (tmp_path / "exp-2_fragment_stat.tsv").write_text("150 140 12\n")
    path = str(tmp_path)
    counts = readers.accepted(readers.load(spark, "upload_rpkm", path)).groupBy("uid").count().collect()
    assert {tuple(r) for r in counts} == {("exp-1", 2), ("exp 2+3%", 1)}
    assert [tuple(r) for r in readers.accepted(readers.load(spark, "upload_get_stat", path)).collect()] == \
        [("exp-2", 10, 9, 3, 3, 8)]
    assert [tuple(r) for r in readers.accepted(readers.load(spark, "upload_macs2_fragment_stat", path)).collect()] == \
        [("exp-2", 150, 140, 12)]
