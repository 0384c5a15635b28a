import datetime as dt

from seqtables.operators import lifecycle, queues
from seqtables.sources import buckets
from seqtables.streaming import jobs

CHANGES = "uid string, url string, libstatus int, deleted int, attempt int"
EVENTS = "uid string, ts timestamp, event_id bigint, libstatus int"


def stream(spark, path, schema):
    return spark.readStream.schema(schema).parquet(path)


def test_claims_happen_once_and_survive_a_restart(spark, rows, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    claim = lambda: jobs.claim_downloads(stream(spark, src, CHANGES), out, ck).awaitTermination()
    rows([("a", "x", 0, 0, 1), ("a", "x", 0, 0, 1), ("b", "", 0, 0, 1), ("c", "x", 10, 0, 1)], CHANGES).write.mode("append").parquet(src)
    claim()
    assert [(r.uid, r.attempt) for r in spark.read.parquet(out).collect()] == [("a", 1)]
    claim()
    assert spark.read.parquet(out).count() == 1
    rows([("a", "x", 0, 0, 1), ("a", "x", 0, 0, 2), ("d", "y", 0, 0, 1)], CHANGES).write.mode("append").parquet(src)
    claim()
    got = spark.read.parquet(out).collect()
    assert sorted((r.uid, r.attempt) for r in got) == [("a", 1), ("a", 2), ("d", 1)]
    # the ids are those of the batch form
    batch = queues.launch_requests(
        rows([("a", 1)], "uid string, attempt int"), *[rows([], "uid string, workflow string, attempt int")] * 2,
        rows([], "uid string, job string, attempt int")).first()
    assert batch.run_id in {r.run_id for r in got}


def test_status_log_folds_to_the_batch_result(spark, rows, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    first = [("a", day(1), 1, 0), ("a", day(2), 2, 10), ("b", day(1), 3, 12), ("a", day(2), 2, 10)]
    second = [("a", day(2, 5), 4, 11), ("b", day(1), 3, 12), ("c", day(1, 3), 5, 0)]
    for batch in (first, second):
        rows(batch, EVENTS).write.mode("append").parquet(src)
        jobs.append_status_log(stream(spark, src, EVENTS), out, ck).awaitTermination()
    log = spark.read.parquet(out)
    assert {r.event_id for r in log.collect()} == {1, 2, 3, 4, 5}
    latest = lambda df: {tuple(r) for r in lifecycle.status_latest(df).collect()}
    assert latest(log) == latest(rows(first + second, EVENTS)) == {("a", 11, 4), ("b", 12, 3), ("c", 0, 5)}


def test_an_event_months_late_reaches_the_log(spark, rows, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    when = lambda m, d: dt.datetime(2024, m, d)
    for batch in ([("a", when(3, 1), 1, 0)], [("a", when(3, 2), 2, 10)], [("late", when(1, 1), 3, 12)]):
        rows(batch, EVENTS).write.mode("append").parquet(src)
        jobs.append_status_log(stream(spark, src, EVENTS), out, ck).awaitTermination()
    assert {tuple(r) for r in lifecycle.status_latest(spark.read.parquet(out)).collect()} == {("a", 10, 2), ("late", 12, 3)}


def test_status_fold_runs_on_a_stream(spark, rows, tmp_path):
    src = str(tmp_path / "src")
    data = [("a", dt.datetime(2024, 1, 1), i, i) for i in range(5)]
    rows(data, EVENTS).write.parquet(src)
    q = (lifecycle.status_latest(stream(spark, src, EVENTS)).writeStream.outputMode("complete").format("memory")
         .queryName("latest_status").trigger(availableNow=True).start())
    q.awaitTermination()
    assert [tuple(r) for r in spark.table("latest_status").collect()] == [("a", 4, 4)]


def test_attempts_on_a_stream(spark, rows, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    schema = "uid string, url string, libstatus int, deleted int, event_id bigint"
    read = lambda: spark.read.schema("uid string, url string, kind string, job string, cause string, attempt int, run_id string").parquet(out)
    none = rows([], "uid string, job string, cause string, attempt int")
    rows([("a", "x", 0, 0, None), ("a", "x", 0, 0, None), ("b", "", 0, 0, 1)], schema).write.mode("append").parquet(src)
    jobs.claim_attempts(stream(spark, src, schema), none, out, ck).awaitTermination()
    assert [(r.uid, r.attempt) for r in read().collect()] == [("a", 1)]
    rows([("a", "x", 0, 0, 7), ("a", "x", 0, 0, None), ("c", "x", 0, 0, 2)], schema).write.mode("append").parquet(src)
    written = spark.createDataFrame(read().select("uid", "job", "cause", "attempt").collect(), none.schema)
    jobs.claim_attempts(stream(spark, src, schema), written, out, ck).awaitTermination()
    assert sorted((r.uid, r.attempt) for r in read().collect()) == [("a", 1), ("a", 2), ("c", 1)]
    # the ids are those of the batch form
    batch = queues.launches(rows([("a", 7)], "uid string, event_id bigint"), *[rows([], "uid string, event_id bigint, workflow string")] * 2,
                            rows([], "uid string, event_id bigint, job string"), written).first()
    assert batch.run_id in {r.run_id for r in read().collect()}


def test_the_current_status_is_stored(spark, rows, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    when = lambda d: dt.datetime(2024, 1, d)
    keep = lambda: jobs.keep_current(stream(spark, src, EVENTS), out, ck, 4).awaitTermination()
    read = lambda: sorted((r.uid, r.libstatus, r.event_id) for r in buckets.read(spark, out, jobs.CURRENT).collect())
    rows([("a", when(1), 1, 0), ("a", when(3), 2, 10), ("007", when(1), 3, 12)], EVENTS).write.mode("append").parquet(src)
    keep()
    assert read() == [("007", 12, 3), ("a", 10, 2)]
    rows([("a", when(2), 4, 11), ("b", when(1), 5, 0), ("007", when(1), 6, 1000)], EVENTS).write.mode("append").parquet(src)
    keep()
    assert read() == [("007", 1000, 6), ("a", 10, 2), ("b", 0, 5)]
    keep()
    # a batch that is written again changes nothing
    last = max((tmp_path / "ck-changes").iterdir(), key=lambda f: int(f.name.split("=")[1]))
    buckets.replace(spark.read.schema(jobs.CURRENT).parquet(str(last)), out)
    assert read() == [("007", 1000, 6), ("a", 10, 2), ("b", 0, 5)]
