from seqtables.operators import downloads, queues

DIM = "uid string, pair boolean, url string"


def outcome(rows, dim, fetched=(), checks=(), paths=(), files=()):
    dim = rows(dim, DIM)
    local = queues.local_files(dim, rows([(p,) for p in paths], "path string"))
    steps = downloads.download_steps(dim, local, rows(list(fetched), "uid string, mate int, file_type string"),
                                     rows(list(checks), "uid string, mate int, valid boolean"))
    found = downloads.download_outcome(dim, steps, rows(list(files), "uid string, mate int"))
    return {r.uid: (r.event, r.message) for r in found.collect()}


def test_urls(rows):
    one, two = "https://h/a.gz", "https://h/a.gz;https://h/b.gz"
    dim = [("ok", False, one), ("bad", False, one), ("type", True, two), ("second", True, two), ("wait", True, two), ("lone", True, one),
           ("none", False, one), ("both", True, two), ("late", True, two)]
    fetched = [("ok", 1, "gzip"), ("bad", 1, "ASCII"), ("type", 1, "HTML"), ("type", 2, "PDF"), ("second", 1, "Zip"), ("second", 2, "gzip"),
               ("wait", 1, "bzip2"), ("lone", 1, "gzip"), ("both", 1, "gzip"), ("both", 2, "gzip"), ("late", 2, "HTML")]
    checks = [("ok", 1, True), ("bad", 1, False), ("second", 1, True), ("second", 2, False)]
    done = ("downloaded", None)
    fail = lambda why: ("download_failed", why)
    assert outcome(rows, dim, fetched, checks) == {
        "ok": done, "both": done, "bad": fail("Error: not a fastq"), "type": fail("Error: file type unknown"),
        "second": fail("Error: not a fastq"), "lone": fail("Error: no address")}


def test_local_names(rows):
    dim = [("one", False, "lane1_"), ("two", True, "lane2_"), ("many", False, "lane3_"), ("none", False, "lane9_"), ("empty", False, "")]
    paths = ["/u/lane1_a.gz", "/u/lane2_a.gz", "/u/lane2_b.gz", "/u/lane3_a", "/u/lane3_b", "/u/lane3_c"]
    fetched = [("one", 1, "gzip"), ("two", 1, "gzip"), ("two", 2, "HTML"), ("many", 1, "gzip")]
    assert outcome(rows, dim, fetched, paths=paths) == {
        "one": ("downloaded", None), "two": ("download_failed", "Error: file type unknown"), "many": ("download_failed", "Error: Bad filter"),
        "none": ("download_failed", "Skip local: File not found 0")}


def test_archives_and_copies_end_with_their_files(rows):
    dim = [("a", False, "SRR1"), ("b", True, "SRR1 SRR2"), ("c", True, "12 13"), ("d", False, "12"), ("e", False, None)]
    assert outcome(rows, dim, files=[("a", 1), ("b", 1), ("c", 1), ("c", 2)]) == {"a": ("downloaded", None), "c": ("downloaded", None)}
    assert outcome(rows, []) == {}
