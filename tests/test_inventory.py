import pytest

from seqtables.operators import queues
from seqtables.sources import inventory


def tree(tmp_path, names):
    for name, size in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * size)


@pytest.mark.parametrize("shares", [1, 3, 64])
def test_every_file_once(spark, tmp_path, shares):
    names = [(f"exp-{i}/deep/{j}/f{j}.bin", (i + j) % 3) for i in range(20) for j in range(3)] + [("top.txt", 0), ("exp-1/a b%20c.é", 7)]
    tree(tmp_path, names)
    (tmp_path / "empty" / "folder").mkdir(parents=True)
    got = sorted((r.path, r.length) for r in inventory.inventory(spark, str(tmp_path), shares).collect())
    assert got == sorted((f"{tmp_path}/{name}", size) for name, size in names)


def test_many_files_in_one_folder(spark, tmp_path, monkeypatch):
    tree(tmp_path, [(f"exp-1/{i}", 0) for i in range(25)])
    monkeypatch.setattr(inventory, "BATCH", 4)
    assert inventory.inventory(spark, str(tmp_path)).count() == 25


def test_a_missing_folder_is_an_error_and_an_empty_one_is_not(spark, tmp_path):
    with pytest.raises(Exception, match="no folder"):
        inventory.inventory(spark, str(tmp_path / "none")).count()
    assert inventory.inventory(spark, str(tmp_path)).count() == 0


def test_files_present_counts_empty_read_files(spark, rows, tmp_path):
    tree(tmp_path, [("007/007.fastq.bz2", 0), ("b/b.fastq.bz2", 5), ("b/b_2.fastq.bz2", 0), ("c/c_2.fastq.bz2", 1), ("d/x.fastq.bz2", 1)])
    queue = rows([(u, 1, 1, "reprocess") for u in ("007", "b", "c", "d")], "uid string, experimenttype_id int, genome_id int, action string")
    single = rows([(1, "RNA-Seq", "w.cwl")], "id int, etype string, workflow string")
    paired = rows([(1, "RNA-Seq pair", "w.cwl")], "id int, etype string, workflow string")
    files = inventory.read_files(inventory.inventory(spark, str(tmp_path)))
    present = lambda types: {r.uid for r in queues.files_present(queue, types, rows([(1,)], "id int"), files).filter("present").collect()}
    assert present(single) == {"007", "b"}
    assert present(paired) == {"b"}
