"""Every registered query against its SQL, and the shape of its plan."""

import pytest

import __spark_entry__ as entry
from seqtables.plans.oracles import ORACLES
from seqtables.plans.registry import QUERIES
from tests.compare import compare, connection

NO_SQL: set[str] = set()


@pytest.fixture(scope="module")
def con(sf):
    return connection(sf)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLES) == NO_SQL
    assert set(ORACLES) <= set(QUERIES)


def test_entry_lists_them():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in NO_SQL])
def test_matches_sql(spark, con, sf, name):
    assert compare(spark, con, name, sf) == ""


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if "stream" not in n and n != "queue_claim"])
def test_no_pairwise_join_and_no_python(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for word in ("BroadcastNestedLoopJoin", "CartesianProduct",
                 "BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas", "FlatMapGroups"):
        assert word not in text


def test_tracks_scan_experiments_once(spark, sf):
    assert plan(QUERIES["track_db_all_genomes"](spark, sf)).count("FileScan parquet") == 1


def test_scans_are_pruned(spark, sf):
    text = plan(QUERIES["peaks_bed"](spark, sf))
    schema = text.split("ReadSchema: ")[1].splitlines()[0]
    assert "l_extendedprice" not in schema and "l_shipdate" not in schema


def test_queue_filters_reach_the_scan(spark, sf, tmp_path):
    from seqtables.operators import queues
    from seqtables.sources.adapters import table

    path = str(tmp_path / "labdata")
    table(spark, sf, "labdata").write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    text = plan(queues.download_queue(spark.read.parquet(path)).select("uid"))
    assert "EqualTo(libstatus,0)" in text and "EqualTo(deleted,0)" in text and "IsNotNull(url)" in text
