"""The corpus pipeline stage by stage against brute force, each stage on its own input."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from seqtables.llm import packing
from tests.llm.test_text_operators import encode

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SOUNDS = {"en": ["th", "ing", "er", "on", "an"], "de": ["sch", "ung", "ei", "ch", "en"], "fr": ["eau", "que", "oi", "é", "le"]}


def speak(rng, lang, n):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng, rows = random.Random(12), []
    for i in range(150):
        lang = rng.choice(list(SOUNDS))
        rows.append((i, speak(rng, lang, rng.randint(5, 120)), lang, f"s{i % 4}"))
    passage = speak(rng, "en", 60)
    rows += [(200 + i, f"{speak(rng, 'en', 20)}\n{passage}\n{speak(rng, 'en', 10)}", "en", "s1") for i in range(4)]
    base = speak(rng, "de", 90).split()
    rows += [(300 + i, " ".join(base[:i] + ["neu"] + base[i + 1:]), "de", "s2") for i in range(6)]
    rows += [(400 + i, rows[3][1], rows[3][2], "s3") for i in range(5)]
    rows += [(500, None, "en", "s0"), (501, "", None, None), (502, "12 34 ...", "en", "s0"), (503, "zz qq xx vv kk ww", None, "s1"), (7, rows[7][1], rows[7][2], "s3")]
    path = str(tmp_path_factory.mktemp("pipeline"))
    (spark.createDataFrame([(d, t, lang, s, len(t or "")) for d, t, lang, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
     .repartition(3).write.parquet(f"{path}/documents.parquet"))
    return path


@pytest.fixture(scope="module")
def kept(spark, folder):
    """The rows before each stage and after it."""
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), docs.schema)
        found.append((name, before, docs.collect()))
    return {name: (before, after) for name, before, after in found}, docs


def test_language(kept):
    before, after = kept[0]["language"]
    gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
    assert gone == {500, 501, 502, 503}
    assert len(after) == sum(r["doc_id"] not in gone for r in before)


def shingles(text):
    w = WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_copies(kept):
    before, after = kept[0]["near_copies"]
    sets = [(r["doc_id"], shingles(r["text"])) for r in before]
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    assert sorted(r["doc_id"] for r in after) == sorted({root(d) for d, _ in sets})


def test_repeated_passages(kept):
    before, after = kept[0]["repeated_passages"]
    seen, left = {}, {}
    for r in sorted(before, key=lambda r: r["doc_id"]):
        w = WORD.findall(r["text"] or "")
        gone = set()
        for i in range(len(w) - 49):
            first = seen.setdefault(tuple(w[i:i + 50]), (r["doc_id"], i))
            if first != (r["doc_id"], i):
                gone.update(range(i, i + 50))
        left[r["doc_id"]] = [x for i, x in enumerate(w) if i not in gone]
    assert {r["doc_id"]: WORD.findall(r["text"]) for r in after} == {d: w for d, w in left.items() if w}
    assert any(len(left[r["doc_id"]]) < len(WORD.findall(r["text"])) for r in before)


def test_mixture(kept):
    before, after = kept[0]["mixture"]
    copies, whole = Counter(tuple(r) for r in after), {tuple(r) for r in before}
    assert set(copies) <= whole and max(copies.values()) <= 3
    size = defaultdict(int)
    for r in before:
        size[r["source"]] += len(WORD.findall(r["text"]))
    taken = defaultdict(int)
    for r in after:
        taken[r["source"]] += len(WORD.findall(r["text"]))
    weight = {s: 1 + i % 3 for i, s in enumerate(sorted(size))}
    free, left, target = set(size), float(sum(size.values())), {}
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * size[s]} or free
        for s in over:
            target[s] = min(share[s], 3.0 * size[s])
            left -= target[s]
        free = free - over
    for s in size:
        assert abs(taken[s] - target[s]) < 0.15 * target[s]


def test_sequences(spark, kept, folder):
    docs = kept[1]
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    ids = {r["doc_id"]: encode(r["text"]) + [0] for r in docs.collect()}
    filled = defaultdict(list)
    for r in rows:
        piece = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["doc_tokens"] == len(ids[r["doc_id"]]) and r["length"] == len(piece) > 0
        assert r["ids_crc32"] == zlib.crc32(np.array(piece, "<u4").tobytes())
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    copies = Counter(r["doc_id"] for r in docs.collect())
    assert Counter(r["doc_id"] for r in rows for _ in range(r["length"])) == {d: n * len(ids[d]) for d, n in copies.items()}
    for spans in filled.values():
        spans.sort()
        assert [a for a, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))] and sum(n for _, n in spans) <= 1024
    assert sum(sum(n for _, n in s) < 1024 for s in filled.values()) <= 1


def test_run_is_the_stages(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == packing.pack(spark.read.parquet(f"{folder}/documents.parquet")).columns and got.count() > 0
