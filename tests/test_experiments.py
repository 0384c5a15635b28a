import json
import os

import pytest
from pyspark.sql import functions as F

from seqtables.functions import jobjson, text
from seqtables.operators import catalogue, experiments, manifests


@pytest.mark.parametrize("path", [
    "/a/b", "/a//b", "/a/./b/", "/a/../b", "/../a", "//a/b", "///a", "/", "/a/b/..", "/a/.b/..c", "/a/...",
])
def test_norm_path_agrees_with_posix(rows, path):
    got = rows([(path,)], "p string").select(text.norm_path(F.col("p"))).first()[0]
    assert got == os.path.normpath(path)


@pytest.mark.parametrize("template,values,expected", [
    ("{{{a}}} {b}", {"a": "1", "b": "{a}"}, "{1} {a}"),
    ("{{a}}\n{a}", {"a": "x"}, "{a} x"),
    ("{a}{missing}", {"a": "x"}, None),
    ("{a}", {"a": None}, "None"),
])
def test_template_fill(rows, template, values, expected):
    df = rows([(template, *values.values())], "t string, " + ", ".join(f"{k} string" for k in values))
    parts = text.template_parts(F.col("t"), list(values))
    got = df.select(text.fill_parts(parts, text.placeholder_texts([F.col(k) for k in values]))).first()[0]
    assert got == expected


def test_unset_inputs_are_removed_at_any_depth(rows):
    job = {
        "z": 1, "a": "None", "b": {"class": "File", "location": "null"}, "c": None, "d": ["x", ["None"]],
        "e": {"null": 1}, "f": '["null"]', "g": "nullable", "h": True, "i": {"k": [{"m": "None"}]},
    }
    df = rows([(json.dumps(job),)], "j string").withColumn("o", jobjson.parsed(F.col("j")))
    got = df.select(jobjson.set_inputs_sorted(F.col("j"), F.col("o"))).first()[0]
    assert json.loads(got) == {k: job[k] for k in "cefghz"}
    assert list(json.loads(got)) == sorted("cefghz")


def test_promoter(rows):
    old = rows([("a", None), ("b", "{}"), ("c", '{"promoter":500}'), ("d", '{"promoter":null}'), ("e", '{"promoter":"x"}')],
               "uid string, params string")
    new = rows([(u, '{"out":{"b":1},"promoter":7}') for u in "abcde"], "uid string, result string")
    got = {r.uid: json.loads(r.params) for r in experiments.result_params(old, new).collect()}
    assert {u: p["promoter"] for u, p in got.items()} == {"a": 1000, "b": 1000, "c": 500, "d": None, "e": "x"}
    assert all(p["out"] == {"b": 1} for p in got.values())


LAB = ("id bigint, uid string, experimenttype_id int, genome_id int, antibody_id int, worker_id int, libstatus int, "
       "deleted int, forcerun int, url string, params string, trim5 int, trim3 int, fragmentsizeexp int, "
       "fragmentsizeforceuse int, rmdup int, control int, control_id string")


def lab(rows, *data):
    return rows(list(data), LAB)


def dims(spark, rows):
    types = experiments.with_template_parts(catalogue.seed(spark).withColumn(
        "id", F.when(F.col("etype") == "DNA-Seq pair", 1).when(F.col("etype") == "RNA-Seq dUTP", 2).otherwise(99))
        .filter("id < 99").drop("insert_position"))
    genome = rows([(1, "hg19", "hg19_spike", "a", "t", "hg19_spike", "hs")],
                  "id int, db string, findex string, annotation string, annottable string, genome string, gsize string")
    antibody = rows([(1, 2)], "id int, properties int")
    worker = rows([(1, "w@x.org")], "id int, email string")
    return types, genome, antibody, worker


SETTINGS = [("wardrobe", "/w/"), ("preliminary", "//raw"), ("upload", "/up/../up2"), ("indices", "idx"),
            ("maxthreads", "3"), ("experimentsdb", "exps"), ("other", "x")]


def test_dimension_defaults_and_missing_sides(spark, rows):
    data = lab(
        rows,
        (1, "u-1", 1, 1, 1, 1, 0, 0, 1, "x", None, 1, 2, 150, 1, 1, 1, "u-2"),
        (2, "u-2", 2, 1, None, 5, 0, 0, 0, None, "", None, None, None, None, None, None, None),
        (3, "u-3", 77, 1, 1, 1, 0, 0, 0, None, "", None, None, None, None, None, None, None),
        (4, "u-4", 1, 77, 1, 1, 0, 0, 0, None, "", None, None, None, None, None, None, None),
    )
    got = {r.uid: r for r in experiments.experiment_dim(data, *dims(spark, rows)).collect()}
    assert set(got) == {"u-1", "u-2"}
    a, b = got["u-1"], got["u-2"]
    assert (a.pair, a.dutp, a.forcerun, a.spike, a.force_fragment_size, a.broad_peak, a.remove_duplicates) == (
        True, False, True, True, True, True, True)
    assert (b.pair, b.dutp, b.forcerun, b.force_fragment_size, b.broad_peak, b.remove_duplicates) == (
        False, True, False, False, False, False)
    assert (b.clip_5p_end, b.exp_fragment_size, b.control_id, b.email, b.params) == (0, 0, "", "", "{}")


def test_paths_and_jobs(spark, rows):
    data = lab(
        rows,
        (1, "u-1", 1, 1, 1, 1, 0, 0, 1, "x", None, 1, 2, 150, 1, 1, 1, "u-2"),
        (2, "u-2", 1, 1, None, 5, 0, 0, 0, None, "", None, None, None, None, None, None, None),
        (3, "x/../y", 2, 1, None, 5, 0, 0, 0, None, "", None, None, None, None, None, None, None),
    )
    settings = rows(SETTINGS, "k string, v string")
    paths = experiments.experiment_paths(experiments.experiment_dim(data, *dims(spark, rows)), settings)
    got = {r.uid: r for r in paths.collect()}
    a = got["u-1"]
    assert (a.raw_data, a.upload, a.indices) == ("/w/raw", "/w/up2", "/w/idx")
    assert a.fastq_file_downstream == "/w/raw/u-1/u-1_2.fastq.bz2"
    assert a.chrom_length == "/w/idx/bowtie/hg19_spike/chrNameLength.txt"
    assert a.bowtie_indices_folder_ribo == "/w/idx/bowtie/hg19_spike_ribo"
    assert a.control_file == "/w/raw/u-2/u-2.bam" and got["u-2"].control_file is None
    assert got["x/../y"].output_folder == "/w/raw/y"

    jobs = {r.uid: json.loads(r.job) for r in experiments.job_inputs(paths).collect()}
    assert jobs["u-1"]["control_file"]["location"] == "/w/raw/u-2/u-2.bam"
    assert "control_file" not in jobs["u-2"]
    assert jobs["u-1"]["remove_duplicates"] is True and jobs["u-2"]["remove_duplicates"] is False
    assert jobs["u-1"]["threads"] == 3 and jobs["u-1"]["clip_5p_end"] == 1
    assert jobs["x/../y"]["exclude_chr"] == "control"
    assert jobs["x/../y"]["star_indices_folder"] == {"class": "Directory", "location": "/w/idx/STAR/hg19_spike"}


def test_a_path_with_a_missing_part_is_null(rows):
    gone = [kv for kv in SETTINGS if kv[0] != "preliminary"]
    manifest = lambda settings: manifests.output_manifest(
        rows([("u-1", 1)], "uid string, experimenttype_id int"),
        rows([(1, '["upload_get_stat"]')], "experimenttype_id int, upload_rules string"), rows(settings, "k string, v string")).first().path
    assert manifest(gone) is None
    slashed = [(k, f"//{v}" if k == "preliminary" else v) for k, v in SETTINGS]
    assert manifest(slashed) == manifest(SETTINGS) == "/w/raw/u-1/u-1.stat"


def test_missing_genome_is_reported(rows):
    got = experiments.experiment_genome(
        rows([("a", 1), ("b", 9)], "uid string, genome_id int"), rows([(1, "hg19")], "id int, db string"))
    assert {tuple(r) for r in got.collect()} == {("a", "hg19", True), ("b", None, False)}


def test_manifest_of_unknown_rule_has_no_path(rows):
    got = manifests.output_manifest(
        rows([("u-1", 1)], "uid string, experimenttype_id int"),
        rows([(1, '["upload_get_stat","nothing"]')], "experimenttype_id int, upload_rules string"),
        rows(SETTINGS, "k string, v string")).collect()
    assert {(r.position, r.rule, r.path) for r in got} == {
        (0, "upload_get_stat", "/w/raw/u-1/u-1.stat"), (1, "nothing", None)}


def test_cleanup_lists_every_database_and_plans_without_a_job(spark, rows):
    queue = rows([("a-1",), ("b",)], "uid string")
    genome = rows([(i, f"db{i % 1500}") for i in range(3000)], "id int, db string")
    settings = rows(SETTINGS, "k string, v string")
    spark.sparkContext.setJobGroup("planning", "clean-up list")
    planned = manifests.cleanup_manifest(queue, genome, settings)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    got = planned.collect()
    found = {tuple(r) for r in got}
    assert len(found) == len(got) == 2 * (1500 * 6 + 8)
    assert ("a-1", "db0", "a_1_islands", "view") in found and ("a-1", "exps", "a-1_atdph", "table") in found


def test_catalogue_upsert(spark, rows):
    current = rows([(3, "DNA-Seq"), (9, "Mine"), (5, "RNA-Seq Trim Galore")], "id int, etype string")
    got = {r.etype: r for r in catalogue.upsert(current, catalogue.seed(spark)).collect()}
    assert got["DNA-Seq"].id == 3 and got["DNA-Seq"].workflow == "chipseq-se.cwl"
    assert got["Mine"].workflow is None
    assert got["RNA-Seq Trim Galore"].id == 5
    new = sorted(r.id for e, r in got.items() if e not in ("DNA-Seq", "Mine", "RNA-Seq Trim Galore"))
    assert new == list(range(10, 17)) and "RNA-Seq" not in got
    again = catalogue.upsert(spark.createDataFrame(list(got.values())), catalogue.seed(spark))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got.values()), key=lambda r: r)
