import pytest
from pyspark.sql import functions as F

from seqtables.sources import buckets, storage

SCHEMA = "uid string, chrom string, tx_start int"


def read(spark, path):
    return sorted((tuple(r) for r in buckets.read(spark, path, SCHEMA).collect()), key=repr)


def test_reloads_keep_the_other_experiments(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    assert read(spark, path) == []
    first = [(f"{i:03d}", "chr1", i) for i in range(40)] + [("007", "chr2", 99), ("0042", "chr1", 5), (None, "chr1", 1)]
    buckets.replace(rows(first, SCHEMA), path, count=4)
    assert read(spark, path) == sorted(first, key=repr)
    # 007 anew, 0042 and 008 emptied, 900 emptied before it had rows
    buckets.replace(rows([("007", "chr3", 1)], SCHEMA), path, rows([("0042",), ("008",), ("900",), ("007",)], "uid string"), ("tx_start",))
    want = [r for r in first if r[0] not in ("007", "0042", "008")] + [("007", "chr3", 1)]
    assert set(read(spark, path)) == set(want) and len(read(spark, path)) == len(want)
    buckets.replace(rows([("007", "chr3", 1)], SCHEMA), path)
    assert len(read(spark, path)) == len(want)


def test_a_bucket_without_rows_goes(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    buckets.replace(rows([("a", "chr1", 1)], SCHEMA), path, count=8)
    buckets.replace(rows([], SCHEMA), path, rows([("a",)], "uid string"))
    assert read(spark, path) == [] and not list((tmp_path / "t").glob("bucket=*"))
    buckets.replace(rows([], SCHEMA), path, rows([], "uid string"))
    buckets.replace(rows([("a", "chr1", 2)], SCHEMA), path)
    assert read(spark, path) == [("a", "chr1", 2)]


def test_only_touched_buckets_are_rewritten(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    buckets.replace(rows([(f"u{i}", "chr1", i) for i in range(50)], SCHEMA), path, count=16)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
    buckets.replace(rows([("u7", "chr9", 7)], SCHEMA), path)
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
    changed = {f.parent.name for f in set(before.items()) ^ set(after.items()) for f in [f[0]]}
    assert len(changed) == 1 and len(before) > 8
    with pytest.raises(ValueError):
        buckets.replace(rows([("u7", "chr9", 7)], SCHEMA), path, count=8)


def test_a_large_experiment_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "t")
    hot = spark.range(300000).selectExpr("case when id % 3 = 0 then concat('u', id % 50) else 'hot' end as uid",
                                         "sha2(cast(id as string), 256) as chrom", "cast(id as int) as tx_start").repartition(8)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        buckets.replace(hot, path, order=("tx_start",), count=4)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert buckets.read(spark, path, hot.schema).count() == 300000
    hot_bucket = spark.range(1).select(buckets.bucket(F.lit("hot"), 4)).first()[0]
    assert len(list((tmp_path / "t" / f"bucket={hot_bucket}").glob("*.parquet"))) >= 2


def test_rebuilding_the_layout_keeps_uids_of_digits(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    storage.replace_experiments(rows([("007", "chr1", 2), ("007", "chr1", 1), ("8", "chr1", 1)], SCHEMA), path)
    storage.rebuild_layout(spark, path, rows([("007",)], "uid string"), ("tx_start",), str(tmp_path / "staging"))
    got = spark.read.schema("chrom string, tx_start int, uid string").parquet(path).collect()
    assert sorted((r.uid, r.tx_start) for r in got) == [("007", 1), ("007", 2), ("8", 1)]
