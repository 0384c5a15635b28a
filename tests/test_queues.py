import random

import pytest
from pyspark.sql import functions as F

from seqtables.operators import queues


@pytest.mark.parametrize("url,expected", [
    ("SRR1", "sra"), ("GSM1 SRX22 SRA3", "sra"), ("SRR1  SRR2", "local"), ("SRR1x", "local"),
    ("http://x", "url"), ("https://x 1", "url"), ("ftp://x", "url"), ("sftp://x", "url"), ("-x", "url"),
    ("httpx://y", "local"), ("12", "copy"), ("12 13", "copy"), ("12,13", "local"), ("", "local"), (None, None),
])
def test_route(rows, url, expected):
    assert rows([(url,)], "url string").select(queues.route(F.col("url"))).first()[0] == expected


def test_queues(rows):
    data = rows([
        ("a", 0, 0, 0, "x"), ("b", 0, 0, 0, ""), ("c", 0, 0, 0, None), ("d", 0, 1, 0, "x"), ("e", 1, 0, 0, "x"),
        ("f", 12, 0, 1, "x"), ("g", 11, 0, 1, "x"), ("h", 2010, 0, 1, None), ("i", 12, 2, 1, "x"), ("j", 12, 1, 1, "x"),
    ], "uid string, libstatus int, deleted int, forcerun int, url string")
    assert {r.uid for r in queues.download_queue(data).collect()} == {"a"}
    assert {(r.uid, r.action) for r in queues.reprocess_queue(data).collect()} == {
        ("d", "delete"), ("f", "reprocess"), ("h", "reprocess"), ("j", "delete")}


def test_fetch_tasks(rows):
    got = queues.fetch_tasks(rows([
        ("a", False, "SRR1 SRR2"), ("b", True, "http://x/1;http://x/2;http://x/3"), ("c", True, "http://x/1"),
        ("d", False, "http://x/1;2"), ("e", False, "5 6"), ("f", False, None), ("g", False, "lane"),
    ], "uid string, pair boolean, url string"))
    assert {tuple(r) for r in got.collect()} == {
        ("a", "sra", 0, "SRR1", None, ""), ("a", "sra", 1, "SRR2", None, ""),
        ("b", "url", 0, "http://x/1", 1, ""), ("b", "url", 1, "http://x/2", 2, "_2"),
        ("c", "url", 0, "http://x/1", 1, ""), ("c", "url", 1, None, 2, "_2"),
        ("d", "url", 0, "http://x/1;2", 1, ""),
    }


def test_copy_sources_keep_order_drop_repeats_and_other_pairing(rows):
    got = queues.copy_sources(rows([
        (1, "a", True, "3 2 3 4 99"), (2, "b", True, None), (3, "c", True, "x"), (4, "d", False, "1"),
    ], "id bigint, uid string, pair boolean, url string"))
    assert {(r.uid, r.position, r.source_uid) for r in got.collect()} == {("a", 0, "c"), ("a", 1, "b")}


def test_copies_compare_ids_as_numbers(rows):
    dim = rows([(1, "a", "12 012 7", False), (12, "b", "", False), (7, "c", "", False)], "id bigint, uid string, url string, pair boolean")
    got = queues.copy_sources(dim).orderBy("position").collect()
    assert [(r.uid, r.source_uid) for r in got] == [("a", "b"), ("a", "c")]


def test_local_files_equal_brute_force(rows):
    random.seed(7)
    word = lambda n: "".join(random.choice("ab_") for _ in range(random.randint(1, n)))
    names = [f"/up/{'b/' if i % 3 else ''}{word(9)}{i}.gz" for i in range(60)]
    urls = [(f"e{i}", word(4)) for i in range(60)] + [("long", "z" * 300), ("dup1", "ab"), ("dup2", "ab"), ("blank", "")]
    got = {r.uid: r for r in queues.local_files(rows(urls, "uid string, url string"), rows([(n,) for n in names], "path string")).collect()}
    assert set(got) == {u for u, url in urls if url}
    for uid, url in urls:
        if not url:
            continue
        hits = sorted(n for n in names if url in n.rsplit("/", 1)[1])
        r = got[uid]
        assert r.n_files == len(hits)
        assert r.action == ("skip" if not hits else "use" if len(hits) <= 2 else "error")
        assert r.mate_1 == (hits[0] if len(hits) in (1, 2) else None)
        assert r.mate_2 == (hits[1] if len(hits) == 2 else None)


def test_local_files_of_any_length(rows):
    long = "lane_" + "x" * 295
    shared = "sample_of_the_shared_run_"
    urls = [("long", long)] + [(f"e{i}", f"{shared}{i:04d}") for i in range(200)]
    paths = [(f"/up/{long}_R1.gz",)] + [(f"/up/{shared}{i:04d}_R{m}.gz",) for i in range(0, 200, 2) for m in (1, 2)]
    got = {r.uid: r for r in queues.local_files(rows(urls, "uid string, url string"), rows(paths, "path string")).collect()}
    assert (got["long"].action, got["long"].mate_1) == ("use", paths[0][0])
    assert all(got[f"e{i}"].n_files == (0 if i % 2 else 2) for i in range(200))


def test_files_present(rows):
    kinds = {"a": 1, "b": 2, "c": 2, "d": 1, "e": 2, "f": 9}
    queue = rows([(u, "delete" if u == "e" else "reprocess", k, 1) for u, k in kinds.items()]
                 + [("g", "delete", 1, 9)], "uid string, action string, experimenttype_id int, genome_id int")
    types = rows([(1, "DNA-Seq", "s.cwl"), (2, "DNA-Seq pair", "p.cwl")], "id int, etype string, workflow string")
    files = rows([("a", 1), ("b", 1), ("c", 1), ("c", 2), ("d", 2)], "uid string, mate int")
    present = queues.files_present(queue, types, rows([(1, "hg19")], "id int, db string"), files)
    assert {(r.uid, r.workflow) for r in present.filter("present").collect()} == {("a", "s.cwl"), ("c", "p.cwl")}
    assert {r.uid for r in queues.ready_to_clean(present).collect()} == {"a", "c", "e"}


def test_plugins(rows):
    got = queues.plugin_match(
        rows([("a", 1), ("b", 7), ("c", 2)], "uid string, experimenttype_id int"),
        rows([(1, "x"), (7, "y")], "id int, etype string"),
        rows([("p", "dir/p.adv.cwl", "[1, 1, 2]"), ("q", "q.cwl", "[7]"), ("r", "r", "[]")],
             "ptype string, workflow string, etype_id string"))
    assert sorted(tuple(r) for r in got.collect()) == [("a", "p", "dir/p_dot_adv"), ("b", "q", "q")]


def test_launch_ids_repeat_per_attempt(rows):
    def ids(attempt):
        d = rows([("a", attempt)], "uid string, attempt int")
        w = rows([("a", "dir/w.x.cwl", attempt)], "uid string, workflow string, attempt int")
        p = rows([("a", "w_dot_x", attempt)], "uid string, job string, attempt int")
        return {r.kind: r for r in queues.launch_requests(d, w, w, p).collect()}

    first, again, later = ids(1), ids(1), ids(2)
    assert first == again and all(first[k].run_id != later[k].run_id for k in first)
    assert first["analysis"].job == "w.x" and first["reprocess"].run_id.startswith("forcerun__a__")
    assert len({r.run_id for r in first.values()}) == 4


REQUEST = "uid string, event_id bigint"
WRITTEN = "uid string, job string, cause string, attempt int"


def started(rows, downloads=(), analyses=(), reruns=(), plugins=(), written=()):
    more = REQUEST + ", workflow string"
    frame = queues.launches(rows(list(downloads), REQUEST), rows(list(analyses), more), rows(list(reruns), more),
                            rows(list(plugins), REQUEST + ", job string"), rows(list(written), WRITTEN))
    return {(r.uid, r.kind, r.job, r.cause, r.attempt, r.run_id) for r in frame.collect()}


def test_an_attempt_follows_its_cause(rows):
    first = started(rows, reruns=[("a", 5, "x/chip.cwl")], downloads=[("b", None)])
    assert {r[:5] for r in first} == {("a", "reprocess", "chip", "reprocess:5", 1), ("b", "download", "download", "download:0", 1)}
    log = [(r[0], r[2], r[3], r[4]) for r in first]
    # computed again, before or after it is written: the same
    assert started(rows, reruns=[("a", 5, "x/chip.cwl")], downloads=[("b", None)], written=log) == first
    second = started(rows, reruns=[("a", 9, "x/chip.cwl")], written=log)
    assert {r[4] for r in second} == {2} and not {r[5] for r in second} & {r[5] for r in first}
    log += [(r[0], r[2], r[3], r[4]) for r in second]
    assert {r[4] for r in started(rows, reruns=[("a", 5, "x/chip.cwl")], written=log)} == {1}


def test_causes_that_come_together_are_numbered(rows):
    got = started(rows, analyses=[("a", 3, "chip.cwl")], reruns=[("a", 3, "chip.cwl"), ("a", 3, "chip.cwl")], plugins=[("a", 3, "chip"), ("a", 3, "pca")],
                  written=[("a", "chip", "download:1", 4), ("z", "chip", "x", 9)])
    assert {(r[1], r[2], r[4]) for r in got} == {("analysis", "chip", 5), ("plugin", "chip", 6), ("reprocess", "chip", 7), ("plugin", "pca", 1)}
    assert len({r[5] for r in got}) == 4
    assert started(rows) == set()
