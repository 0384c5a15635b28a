from seqtables import schemas
from seqtables.sources import fastq, storage

SCHEMA = "uid string, chrom string, tx_start int"


def read(spark, path):
    return {tuple(r) for r in spark.read.parquet(path).select("uid", "chrom", "tx_start").collect()}


def test_replace_touches_only_given_experiments(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    storage.replace_experiments(rows([("a", "chr1", 1), ("a", "chr1", 2), ("b", "chr1", 3)], SCHEMA), path, ("chrom",))
    storage.replace_experiments(rows([("b", "chr2", 9)], SCHEMA), path, ("chrom",))
    assert read(spark, path) == {("a", "chr1", 1), ("a", "chr1", 2), ("b", "chr2", 9)}
    storage.replace_experiments(rows([("b", "chr2", 9)], SCHEMA), path, ("chrom",))
    assert len(read(spark, path)) == 3


def test_rebuild_layout_keeps_rows_and_sorts(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    data = [("a", "chr1", i % 7) for i in range(20)] + [("b", "chr1", 5), ("b", "chr1", 1)]
    rows(data, SCHEMA).repartition(5).write.partitionBy("uid").parquet(path)
    before = sorted(map(tuple, spark.read.parquet(path).select("uid", "chrom", "tx_start").collect()))
    storage.rebuild_layout(spark, path, rows([("a",)], "uid string"), ("chrom", "tx_start"), str(tmp_path / "staging"))
    assert sorted(map(tuple, spark.read.parquet(path).select("uid", "chrom", "tx_start").collect())) == before
    for file in (tmp_path / "t" / "uid=a").glob("*.parquet"):
        starts = [r.tx_start for r in spark.read.parquet(str(file)).collect()]
        assert starts == sorted(starts)


def test_clustered_layout(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    data = [(f"u{i % 11}", "chr1", i) for i in range(100)]
    storage.write_clustered(rows(data, SCHEMA), path, ("chrom", "tx_start"))
    assert read(spark, path) == set(data)


def test_footprint(spark, tmp_path):
    for uid, name, size in (("a", "x.bin", 1024), ("a", "deep/y.bin", 512), ("b", "z.bin", 100)):
        file = tmp_path / uid / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(b"0" * size)
    got = storage.footprint_kib(storage.listing(spark, str(tmp_path), rf"{tmp_path.name}/([^/]+)/"))
    assert {tuple(r) for r in got.collect()} == {("a", 1.5), ("b", 100 / 1024)}


def test_stored_types(rows):
    bed = rows([("a", 0, "chr1", 1, 2, 12.1, 3), ("b", 0, "chr1", 1, 2, 3.0, 3)],
               "uid string, bin int, chrom string, chrom_start bigint, chrom_end bigint, name double, score int")
    assert {r.name for r in schemas.stored(bed, "browser_islands").collect()} == {"12.1", "3.0"}
    profile = schemas.stored(rows([("a", 0.5, 1)], "uid string, y double, x int"), "atdp")
    assert [(f.name, f.dataType.simpleString()) for f in profile.schema] == [("uid", "string"), ("x", "int"), ("y", "float")]


def test_fastq_listing_and_lines(spark, tmp_path):
    folder = tmp_path / "exp-1"
    folder.mkdir()
    for name, text in (("exp-1.fastq", "@a\nAC\n+\nII\n"), ("exp-1_2.fastq", "@b\nGT\n+\nII\n"), ("exp-1.bam", "x")):
        (folder / name).write_text(text)
    assert storage.read_files(spark, str(tmp_path)).count() == 0
    (tmp_path / "other").mkdir()
    for name in ("exp-1/exp-1.fastq.bz2", "exp-1/exp-1_2.fastq.bz2", "other/exp-8.fastq.bz2", "exp-1/exp-8_2.fastq.bz2"):
        (tmp_path / name).write_text("")
    assert {tuple(r) for r in storage.read_files(spark, str(tmp_path)).collect()} == {("exp-1", 1), ("exp-1", 2)}
    for name in ("exp-1/exp-1.fastq.bz2", "exp-1/exp-1_2.fastq.bz2", "exp-1/exp-8_2.fastq.bz2"):
        (tmp_path / name).rename(tmp_path / name.replace("fastq", "kept"))
    lines = fastq.experiment_lines(spark, str(folder)).filter("line_no = 1").collect()
    assert {(r.uid, r.mate, r.value) for r in lines} == {("exp-1", 1, "AC"), ("exp-1", 2, "GT")}


def test_catalogue_table_reads_declared_columns(spark, rows, tmp_path):
    path = str(tmp_path / "antibody")
    rows([(1, 2, "x")], "id int, properties int, extra string").write.parquet(path)
    assert [tuple(r) for r in storage.catalogue_table(spark, path, "antibody").collect()] == [(1, 2)]


def test_large_experiment_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "t")
    hot = spark.range(400000).selectExpr(
        "case when id % 3 = 0 then concat('u', id % 50) else 'hot' end as uid", "sha2(cast(id as string), 256) as chrom",
        "cast(id as int) as tx_start").repartition(8)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        storage.replace_experiments(hot, path, ("tx_start",))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = lambda uid: len(list((tmp_path / "t" / f"uid={uid}").glob("*.parquet")))
    assert files("hot") > 2 and files("u3") == 1
    assert spark.read.parquet(path).count() == 400000
