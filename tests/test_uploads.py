"""Loading result files end to end: outcomes, tables, events and clean-up."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from seqtables import schemas
from seqtables.operators import lifecycle, manifests, uploads
from seqtables.sources import buckets, inventory, storage

DNA = '["upload_macs2_fragment_stat","upload_iaintersect_result","upload_get_stat","upload_atdp","upload_bigwig","upload_folder_size","delete_files"]'
RNA = '["upload_bigwig","upload_get_stat","upload_rpkm","upload_folder_size","delete_files"]'
PEAK = "NM_1\tG1\t100\t900\t+\tchr1\t{}\t{}\t50\t75\t1.5\t2.5\t3.5\t4.5\texon"
ISOFORM = "NM_{},G1,chr1,100,900,+,5.0,1.25"
NOW = dt.datetime(2026, 1, 1)


def write(folder, uid, **files):
    """Files of one experiment: keyword names are suffixes, with __ for a point."""
    (folder / uid).mkdir(parents=True, exist_ok=True)
    for suffix, text in files.items():
        (folder / uid / f"{uid}{suffix.replace('__', '.')}").write_text(text)


def dna(folder, uid, **other):
    files = {"_fragment_stat__tsv": "150 148 2\n", "_macs_peaks_iaintersect__tsv": "refseq_id\tgene_id\n" + PEAK.format(10, 60) + "\n",
             "__stat": "100 90 3 80\n", "_atdp__tsv": "X\tY\n-1\t0.5\n0\t1.5\n", "__fastq": "@"} | other
    write(folder, uid, **{k: v for k, v in files.items() if v is not None})


def rna(folder, uid, **other):
    files = {"__stat": "100 90 5 3 80", "__isoforms__csv": "RefseqId,GeneId\n" + ISOFORM.format(1) + "\n" + ISOFORM.format(2) + "\n"} | other
    write(folder, uid, **{k: v for k, v in files.items() if v is not None})


@pytest.fixture
def world(rows, tmp_path):
    folder = tmp_path / "raw_data"
    dna(folder, "good")
    dna(folder, "nopeaks", _macs_peaks_iaintersect__tsv=None)
    dna(folder, "nogenome")
    dna(folder, "badstat", __stat="")
    rna(folder, "007")
    rna(folder, "badrna", __isoforms__csv=ISOFORM.format(1) + "\nNM_2,G1,chr1,x,900,+,5.0,1.25\n")
    rna(folder, "odd")
    (folder / "bare").mkdir()
    experiments = rows([("good", 1, 1), ("nopeaks", 1, 1), ("nogenome", 1, 9), ("badstat", 1, 1), ("007", 2, 1), ("badrna", 2, 1), ("odd", 3, 1),
                        ("bare", 4, 1), ("unlisted", 5, 1), ("gone", 6, 1)], "uid string, experimenttype_id int, genome_id int")
    rules = rows([(1, DNA), (2, RNA), (3, '["upload_get_stat","nonsense","upload_rpkm"]'), (4, "[]"), (5, None)],
                 "experimenttype_id int, upload_rules string")
    settings = rows([("wardrobe", str(tmp_path)), ("preliminary", "/raw_data"), ("experimentsdb", "x")], "k string, v string")
    genome = rows([(1, "hg19")], "id int, db string")
    return folder, experiments, rules, settings, genome


def load(spark, world, tables):
    folder, experiments, rules, settings, genome = world
    return uploads.load_results(spark, str(folder), experiments, rules, settings, genome, tables, F.lit(NOW), 4)


def read(spark, tables, name):
    return buckets.read(spark, f"{tables}/{name}", schemas.RESULT_TABLES[name])


def test_outcomes_and_tables(spark, rows, world, tmp_path):
    folder, tables = world[0], str(tmp_path / "tables")
    done = load(spark, world, tables)
    said = {r.uid: (r.event, r.message) for r in done["events"].collect()}
    fail = lambda rule, uid, why: ("failed", f"Failed to upload {rule} : {uid} : {why}")
    assert said == {
        "good": ("completed", None), "007": ("completed", None), "bare": ("completed", None),
        "nopeaks": fail("upload_iaintersect_result", "nopeaks",
                        f"[Errno 2] No such file or directory: '{folder}/nopeaks/nopeaks_macs_peaks_iaintersect.tsv'"),
        "nogenome": fail("upload_iaintersect_result", "nogenome", "DB not found"),
        "badstat": fail("upload_get_stat", "badstat", "cannot load ''"),
        "badrna": fail("upload_rpkm", "badrna", "cannot load 'NM_2,G1,chr1,x,900,+,5.0,1.25'"),
        "odd": fail("nonsense", "odd", "'nonsense'")}
    uids = lambda df: {r.uid for r in df.select("uid").collect()}
    assert uids(done["fragments"]) == {"good", "nopeaks", "nogenome", "badstat"}
    assert uids(done["counts"]) == {"good", "007", "badrna", "odd"}
    assert uids(done["sizes"]) == {"good", "007"}
    size = sum(f.stat().st_size for f in (folder / "good").iterdir())
    assert done["sizes"].filter("uid = 'good'").first()["size"] == size / 1024
    assert uids(read(spark, tables, "islands")) == uids(read(spark, tables, "browser_islands")) == {"good", "badstat"}
    assert uids(read(spark, tables, "atdp")) == {"good"} and uids(read(spark, tables, "coverage")) == {"good", "007", "badrna"}
    assert uids(read(spark, tables, "isoforms")) == uids(read(spark, tables, "common_tss")) == {"007"}
    assert [(r.uid, r.refseq_id, r.tot_r_0) for r in read(spark, tables, "genes").collect()] == [("007", "NM_1,NM_2", 10.0)]


def test_a_reload_clears_and_keeps(spark, world, tmp_path):
    folder, tables = world[0], str(tmp_path / "tables")
    load(spark, world, tables)
    rna(folder, "007", __isoforms__csv="RefseqId,GeneId\n")
    dna(folder, "nopeaks")
    dna(folder, "good", __stat="1 2")
    done = load(spark, world, tables)
    assert {r.uid for r in done["events"].filter("event = 'completed'").collect()} == {"007", "bare", "nopeaks"}
    assert read(spark, tables, "isoforms").count() == read(spark, tables, "genes").count() == 0
    # the islands of good are reloaded, its profile stays as it was before the loader in front failed
    assert {r.uid for r in read(spark, tables, "islands").collect()} == {"good", "nopeaks", "badstat"}
    assert sorted(r.uid for r in read(spark, tables, "atdp").collect()) == ["good", "good", "nopeaks", "nopeaks"]


def test_events_reach_the_state(spark, rows, world, tmp_path):
    done = load(spark, world, str(tmp_path / "tables"))
    lab = world[1].selectExpr(
        "uid", "11 as libstatus", "'Analysing' as libstatustxt", "0 as deleted", "0 as forcerun", "'x' as url", "'{}' as params",
        "cast(null as timestamp_ntz) as dateanalyzed", *[f"cast(null as bigint) as {c}" for c in lifecycle.COUNTERS],
        "cast(null as bigint) as fragmentsize", "cast(null as bigint) as fragmentsizeest", "cast(null as bigint) as islandcount", "cast(null as double) as size")
    state = lifecycle.apply_metrics(lifecycle.lifecycle_next(lab, done["events"]), done["counts"], done["fragments"], done["sizes"])
    got = {r.uid: r for r in state.collect()}
    assert (got["good"].libstatus, got["good"].libstatustxt, got["good"].tagsribo, got["good"].islandcount) == (12, "Complete:upgraded", 3, 2)
    assert (got["nogenome"].libstatus, got["nogenome"].libstatustxt) == (
        2010, "Fail:Failed to upload upload_iaintersect_result : nogenome : DB not found")
    assert got["nopeaks"].libstatustxt.endswith('No such file or directory: "' + str(world[0]) + '/nopeaks/nopeaks_macs_peaks_iaintersect.tsv"')
    assert (got["unlisted"].libstatus, got["gone"].libstatus, got["badrna"].dateanalyzee) == (11, 11, NOW)


def test_files_to_remove(spark, rows, world, tmp_path):
    folder, _, _, settings, _ = world
    for name in ("again/a.bam", "again/a.fastq.bz2", "again/sub/b.txt", "again/tophat/c.fastq", "gone/x.fastq.bz2", "gone/y/z", "other/a.bam",
                 "good/sub/good.fastq", "good/good_2.fastq", "good/other.fastq"):
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text("")
    queue = rows([("again", "reprocess"), ("gone", "delete")], "uid string, action string")
    files = inventory.inventory(spark, str(folder))
    got = {(r.reason, r.kind, r.path.removeprefix(f"{folder}/")) for r in
           manifests.cleanup_files(queue, rows([("good",)], "uid string"), settings, files).collect()}
    assert got == {
        ("reprocess", "file", "again/a.bam"), ("reprocess", "file", "again/sub/b.txt"), ("reprocess", "file", "again/tophat/c.fastq"),
        ("reprocess", "folder", "again/tophat"), ("delete", "file", "gone/x.fastq.bz2"), ("delete", "file", "gone/y/z"),
        ("delete", "folder", "gone"), ("upload", "file", "good/good.fastq"), ("upload", "file", "good/good_2.fastq")}
    assert storage.read_files(spark, str(folder)).count() == 0


def test_loaders_after_a_failure_are_void(spark, rows):
    found = rows([("a", 0, "r0", "p0", None), ("a", 1, "r1", "p1", "x"), ("a", 2, "r2", "p2", None), ("a", 3, "r3", "p3", "y"), ("b", 0, "r0", "q", None)],
                 "uid string, position int, rule string, path string, why string")
    outcome = uploads.upload_outcome(rows([("a", 1), ("b", 1), ("c", 1)], "uid string, experimenttype_id int"),
                                     rows([(1, '["r0"]')], "experimenttype_id int, upload_rules string"), found)
    assert {(r.uid, r.event, r.position) for r in outcome.collect()} == {("a", "failed", 1), ("b", "completed", None), ("c", "completed", None)}
    assert {(r.uid, r.rule) for r in uploads.effective(found, outcome).collect()} == {("a", "r0"), ("b", "r0")}


def test_a_file_makes_rows_for_folders_of_experiments_depth_only(rows):
    files = rows([("/w/raw/a/x.txt",), ("/w/raw/a/sub/y.txt",), ("/w/z",), ("top",), (None,)], "path string")
    folders = rows([("/w/raw/a",), ("/w/raw/b",), (None,)], "folder string")
    assert sorted(tuple(r) for r in manifests.folders_above(files, folders).collect()) == [
        ("/w/raw/a/sub/y.txt", "/w/raw/a"), ("/w/raw/a/x.txt", "/w/raw/a")]
    deep = folders.unionByName(rows([("/w",)], "folder string"))
    assert sorted(tuple(r) for r in manifests.folders_above(files, deep).collect()) == [
        ("/w/raw/a/sub/y.txt", "/w"), ("/w/raw/a/sub/y.txt", "/w/raw/a"), ("/w/raw/a/x.txt", "/w"), ("/w/raw/a/x.txt", "/w/raw/a"), ("/w/z", "/w")]
    assert manifests.folders_above(files, folders.filter("false")).count() == 0
