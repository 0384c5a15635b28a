import bz2
import gzip
import os

import pytest

from seqtables.sources import fastq


def records(n, bad=()):
    out = []
    for i in range(n):
        out += [("x" if i in bad else "@") + f"read{i}", "ACGT" * (1 + i % 40), "+", "@III" * (1 + i % 40)]
    return out


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def write(folder, name, lines):
    data = "".join(f"{line}\n" for line in lines).encode()
    opener = {".gz": gzip.open, ".bz2": bz2.open}.get(os.path.splitext(name)[1], open)
    with opener(folder / name, "wb") as f:
        f.write(data)


def test_line_numbers_and_check_across_splits(spark, tmp_path, small_splits):
    files = {
        "good.fastq": records(900), "bad.fastq": records(700, bad={650}), "zip.fastq.gz": records(300),
        "two.fastq.bz2": records(300), "short.fastq": records(2)[:7], "none.fastq": [],
        "blank.fastq": ["", " \t@r", "AC", "+", "II"], "lead.fastq": ["  @r", "AC", "\t+", "II"],
        "fair one+two.fastq": ["@r", "AC", "x", "II", "r", "AC", "+", "II"],
    }
    for name, lines in files.items():
        write(tmp_path, name, lines)
    lines = fastq.fastq_lines(spark, str(tmp_path))
    splits = {r.file: r.n for r in lines.select("file", "split_start").distinct().groupBy("file").count()
              .withColumnRenamed("count", "n").collect()}
    assert max(splits.values()) > 2
    got: dict[str, dict[int, str]] = {}
    for r in fastq.numbered(lines).collect():
        got.setdefault(r.file.rsplit("/", 1)[1], {})[r.line_no] = r.value
    for name, expected in files.items():
        assert [v for _, v in sorted(got.get(name, {}).items())] == expected
        assert sorted(got.get(name, {})) == list(range(len(expected)))
    listing = spark.createDataFrame([(f"file:{tmp_path}/{name}",) for name in files], "file string")
    verdict = {r.file.rsplit("/", 1)[1]: r for r in fastq.check_files(lines, listing).collect()}
    assert verdict["none.fastq"].valid
    assert len(verdict) == len(files) and fastq.check_files(lines).count() == len(files) - 1
    for name, expected in files.items():
        heads = sum(v.split()[:1] != [] and v.split()[0].startswith("@") for v in expected[0::4])
        pluses = sum(v.split()[:1] != [] and v.split()[0].startswith("+") for v in expected[2::4])
        assert (verdict[name].n_heads, verdict[name].n_pluses, verdict[name].valid) == (heads, pluses, heads == pluses)


def test_numbered_check_equals_file_check(spark, rows):
    data = [("a", i, v) for i, v in enumerate(records(5, bad={2}))] + [("b", i, v) for i, v in enumerate(records(3))]
    got = fastq.check_numbered(rows(data, "uid string, line_no bigint, value string"), "uid").collect()
    assert {(r.uid, r.n_heads, r.n_pluses, r.valid) for r in got} == {("a", 4, 5, False), ("b", 3, 3, True)}


def test_merge_in_list_order(spark, rows, tmp_path):
    copies = rows([("t", True, 0, "s2"), ("t", True, 1, "s1"), ("u", False, 0, "s1"), ("t", True, 2, "s2b")],
                  "uid string, pair boolean, position int, source_uid string")
    lines = rows([("s1", 1, 0, "a0"), ("s1", 1, 1, "a1"), ("s1", 2, 0, "A0"), ("s2", 1, 0, "b0"), ("s2b", 1, 0, "c0"),
                  ("s2", 2, 0, "B0"), ("s2", 2, 1, "B1"), ("z", 1, 0, "no")], "uid string, mate int, line_no bigint, value string")
    merged = fastq.merge_sources(copies, lines)
    got = {}
    for r in merged.orderBy("line_no").collect():
        got.setdefault((r.uid, r.mate), []).append((r.line_no, r.value))
    assert got == {
        ("t", 1): [(0, "b0"), (1, "a0"), (2, "a1"), (3, "c0")], ("t", 2): [(0, "B0"), (1, "B1"), (2, "A0")],
        ("u", 1): [(0, "a0"), (1, "a1")],
    }
    from seqtables.sources import storage

    storage.write_lines(merged, str(tmp_path / "out"), "uid", "mate")
    parts = sorted((tmp_path / "out" / "uid=t" / "mate=1").glob("part-*.txt"))
    assert "".join(p.read_text() for p in parts) == "b0\na0\na1\nc0\n"
