"""Brute force for matching, language filters and fingerprints, and cases that earlier versions got wrong."""

import os
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from seqtables.llm import common, jaccard, langid, mixing, suffixes, syncmers, tokens, toxicity
from seqtables.llm.common import Workspace

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- toxicity ------------------------------------------------------------------------------------

@pytest.mark.parametrize("masked, plain", [
    ("hat3", "hate"), ("as5", "ass"), ("a$$hole", "asshole"), ("gr0bal", "grobal"), ("Hello!", "hello"), ("wow!!!", "wow"), ("1234", "1234"),
    ("5$", "5"), ("h@t3|", "hate"), ("$hit", "shit"), ("it!s", "itis"), ("grоbаl", "grobal"), ("a_b3", "a_be"), ("", ""), ("!|", ""), ("7even up", "teven up")])
def test_folding(masked, plain):
    assert toxicity.fold(masked).split() == plain.split()


def test_matches_are_those_of_a_plain_search():
    rng = random.Random(4)
    for _ in range(200):
        word = lambda n: "".join(rng.choice("ab") for _ in range(rng.randint(1, n)))
        weights = {f" {word(3)}{rng.choice(['', ' '])}": float(rng.randint(1, 9)) for _ in range(6)}
        spared = [f" {word(3)} {word(2)} " for _ in range(3)]
        lexicon = toxicity.Lexicon(weights, spared)
        text = toxicity.fold(" ".join(word(4) for _ in range(rng.randint(0, 30))))
        held = [(m.start(), m.start() + len(p)) for p in spared for m in re.finditer(f"(?={re.escape(p)})", text)]
        want = {}
        for entry, weight in weights.items():
            for m in re.finditer(f"(?={re.escape(entry)})", text):
                if m.start() not in want or want[m.start()][1] < weight:
                    want[m.start()] = (m.start() + len(entry), weight)
        want = {(b, w) for b, (e, w) in want.items() if not any(x <= b and e <= y for x, y in held)}
        assert {(b, w) for b, _, w in lexicon.matches(lexicon.automaton(), text)} == want or len(set(weights.values())) < len(weights)


def test_repeated_labels_and_documents(spark):
    rows = [(i, "grobal tree" if i % 4 == 0 else "walk tree") for i in range(80)] * 2
    labels = [(i, int(i % 4 == 0)) for i in range(80)] + [(i, 0) for i in range(0, 80, 4)] + [(5, None), (None, 1)]
    lexicon = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), lexicon).collect()
    assert len(got) == len(rows) and {(r["doc_id"] % 4 == 0, r["predicted"]) for r in got} == {(True, 1), (False, 0)}


# --- language ------------------------------------------------------------------------------------

def test_filters_agree_with_exact_ngram_sets(spark):
    """Bit-sliced filters against sets of the n-grams themselves."""
    rng = random.Random(9)
    sounds = {"en": ["th", "ing", "er", "on"], "de": ["sch", "ung", "ei", "ch"], "fr": ["eau", "que", "oi", "é"]}
    speak = lambda lang, n: " ".join("".join(rng.choice(sounds[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))
    rows = [(i, speak(lang, rng.randint(5, 40)), lang) for i, lang in enumerate(list(sounds) * 60)]
    filters = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    learned = [r for r in rows if langid_held(r[0]) is False]
    sets = exact_sets(learned, filters.languages)
    texts = [speak(lang, 12) for lang in list(sounds) * 20] + [f"{speak('en', 6)} {speak('de', 6)}", "", "12 34", "zzz"]
    hits, total = filters.hits(pa.array(texts))
    for text, row, n in zip(texts, hits, total):
        grams = all_ngrams(text)
        assert n == len(grams)
        exact = [sum(g in sets[lang] for g in grams) for lang in filters.languages]
        assert np.allclose(row, exact, atol=0.02 * max(1, len(grams)) + 0.5)


def langid_held(doc):
    import zlib

    return zlib.crc32(str(doc).encode()) % 3 == 1


def all_ngrams(text):
    raw = " ".join(["", *re.findall(r"[a-z\x80-\xff]+", text.lower().encode().decode("latin-1")), ""])
    raw = re.sub(r"[^a-z\x80-\xff]", " ", f" {text.lower()} ".encode().decode("latin-1"))
    return [raw[i:i + n] for n in langid.LENGTHS for i in range(len(raw) - n + 1) if "  " not in raw[i:i + n]]


def exact_sets(rows, languages):
    from collections import Counter

    counts = {lang: Counter(g for _, text, own in rows if own == lang for g in all_ngrams(text)) for lang in languages}
    seen = {lang: {g: n for g, n in c.items() if n >= 3} for lang, c in counts.items()}
    totals = {(lang, k): sum(n for g, n in seen[lang].items() if len(g) == k) for lang in languages for k in langid.LENGTHS}
    rate = lambda lang, g: seen[lang].get(g, 0) / max(totals[lang, len(g)], 1)
    return {lang: {g for g in seen[lang] if rate(lang, g) >= langid.SHARE_OF_BEST * max(rate(o, g) for o in languages)} for lang in languages}


# --- near copies, passages -----------------------------------------------------------------------

def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))


def test_texts_of_one_id_hold_all_their_links(spark):
    rng = random.Random(2)
    five = [words(rng, 30) for _ in range(5)]
    rows = [(30, t) for t in five] + [(20 + k, t) for k, t in enumerate(five)] + [(50, "x y z"), (30, None)]
    got = {(r["doc_id"], r["component_id"]) for r in jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(30, 20), *((20 + k, 20) for k in range(5)), (50, 50), (30, 30)}


def test_links_stay_below_the_documents(spark):
    rng = random.Random(3)
    base, rows = words(rng, 90).split(), []
    for i in range(400):
        w = list(base)
        for _ in range(rng.choice([1, 2, 3, 3])):
            w[rng.randrange(90)] = words(rng, 1)
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    _, links = jaccard.linked(docs, Workspace(spark, "links"))
    assert links.count() < len(rows)


def test_one_row_of_a_repeated_id_stays(spark):
    rng = random.Random(4)
    text = words(rng, 20)
    rows = [(1, text, "z"), (1, text, "b"), (2, text, "a"), (3, "alone here", "q"), (None, text, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [tuple(r) for r in jaccard.representatives(docs.repartition(3)).collect()]
    assert sorted(got, key=repr) == sorted([(1, text, "b"), (3, "alone here", "q"), (None, text, "n")], key=repr)


def test_passages_of_texts_that_share_an_id(spark):
    rng = random.Random(6)
    passage = words(rng, 60)
    alone, short = words(rng, 70), words(rng, 30)
    rows = [(1, passage + " " + words(rng, 5)), (2, words(rng, 5) + " " + passage), (2, alone), (2, short), (3, alone + " tail")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r["doc_id"], len(WORD.findall(r["text"]))) for r in suffixes.without_repeats(docs).collect())
    assert kept == [(1, 65), (2, 5), (2, 30), (2, 70), (3, 1)]
    spans = {(r["doc_id"], r["start"], r["n_words"], r["first"]) for r in suffixes.repeated_spans(docs).collect()}
    assert spans == {(1, 0, 60, True), (2, 5, 60, False), (2, 0, 70, True), (3, 0, 70, False)}


# --- fingerprints --------------------------------------------------------------------------------

def brute_anchors(raw, k, s):
    small = [int(x) for x in syncmers.mixed(np.array([int.from_bytes(raw[i:i + s], "little") for i in range(len(raw) - s + 1)], np.uint64))]
    width = k - s + 1
    return [i for i in range(len(raw) - k + 1) if min(small[i:i + width]) in (small[i], small[i + width - 1])]


def test_both_kinds_of_syncmers_against_brute_force():
    rng = random.Random(7)
    texts = ["".join(rng.choice("abcdé ") for _ in range(n)) for n in (5, 7, 12, 31, 32, 33, 50, 63, 64, 65, 200)]
    for text, found in zip(texts, syncmers.anchors(pa.array(texts), None)):
        raw = text.encode()
        large = brute_anchors(raw, *syncmers.LARGE) if len(text) >= syncmers.SHORT else []
        small = brute_anchors(raw, *syncmers.SMALL) if len(text) < syncmers.LONG else []
        of = [found[found < syncmers._SMALL_BIT], found[found >= syncmers._SMALL_BIT]]
        assert [(x & np.uint64(0xFFFF)).tolist() for x in of] == [[i // 16 for i in large], [i // 16 for i in small or ([0] if len(text) < syncmers.LONG else [])]]


def test_likeness_has_no_border():
    rng = random.Random(8)
    for n in (25, 31, 33, 36, 40, 63, 64, 66, 90):
        text = "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
        a, b, c = syncmers.anchors(pa.array([text, text[:3 * n // 4], text[:-1]]))
        assert syncmers.likeness(a, c) > 0.7 and syncmers.likeness(a, b) > 0.5
    assert syncmers.likeness(*syncmers.anchors(pa.array(["", "a"]))) == 0.0
    assert syncmers.likeness(*syncmers.anchors(pa.array(["ab", "ab"]))) == 1.0


def test_sketches_estimate_the_exact_likeness():
    rng = np.random.default_rng(3)
    miss = []
    for share in (0.1, 0.25, 0.5):
        for _ in range(20):
            text = rng.integers(97, 123, 20000, dtype=np.uint8).tobytes().decode()
            other = text[:int(20000 * (1 - share))] + rng.integers(97, 123, int(20000 * share), dtype=np.uint8).tobytes().decode()
            both = pa.array([text, other])
            exact = syncmers.likeness(*syncmers.anchors(both, None), None)
            assert abs(exact - (1 - share)) < 0.03
            miss.append(syncmers.likeness(*syncmers.anchors(both)) - exact)
    assert np.sqrt(np.mean(np.square(miss))) < 0.08


# --- mixing --------------------------------------------------------------------------------------

def test_one_seed_draws_each_document_by_the_fraction(spark):
    """One-document sources of two sizes; with one seed the copies are spread as the rates say."""
    rows = [(i, " ".join(["w"] * (10 if i % 2 else 30)), f"s{i:04d}") for i in range(600)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), seeds=1).collect()
    assert all(r["copies"] == round(r["target"] / r["size"]) for r in got if r["size"] == 10)
    for rate in (1 / 3, 2 / 3):
        mine = [r["copies"] for r in got if r["size"] == 30 and abs(r["target"] / 30 - rate) < 0.01]
        assert len(mine) == 100 and set(mine) == {0, 1} and abs(sum(mine) - 100 * rate) < 16


# --- token ids -------------------------------------------------------------------------------------

def test_words_skip_the_pre_tokenizer(monkeypatch):
    coder, sent = tokens.Encoder(tokens.vocabulary()), []
    whole = coder._whole
    monkeypatch.setattr(coder, "_whole", lambda texts: sent.extend(texts) or whole(texts))
    texts = ["Plain words, été und Maß.\nNew line", "3.14 × don't", ""]
    want = [ids + b"\x02\x00" for ids in whole(texts)]
    assert coder.encode(texts, 2) == want == coder.encode(texts, 2)
    assert set(sent) == {",", ".", "\n", "3.14", " ×", " don't"} and len(sent) == 6


@pytest.mark.parametrize("remembered", [5, 700_000])
def test_pieces_have_the_ids_of_the_whole_text(monkeypatch, remembered):
    monkeypatch.setattr(tokens, "REMEMBERED", remembered)
    rng, coder = random.Random(6), tokens.Encoder(tokens.vocabulary())
    parts = ["a", "B", "é", "À", "ÿ", "×", "÷", "ж", "漢", "1", ",", ".", "'s", "'", " ", "  ", "\n", "\n\n", "\t", "\r\n", " the", "x" * 60, "\u0301"]
    for _ in range(20):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(50)]
        assert coder.encode(texts, 2) == [ids + b"\x02\x00" for ids in coder._whole(texts)]


# --- memory -------------------------------------------------------------------------------------

def test_frequent_tokens_of_a_chunk_are_counted_in_one_copy_of_it():
    rng = np.random.default_rng(6)
    parts = [rng.integers(0, 1 << 63, 100_000, dtype=np.uint64) for _ in range(10)]
    for i, part in enumerate(parts):
        part[:50] = np.arange(50)
        part[50:60] = np.arange(100, 110) if i % 2 else part[50:60]
    for least in (6, 5, 4.2, 1):
        want = {int(t): int(n) for t, n in zip(*np.unique(np.concatenate(parts), return_counts=True)) if n >= least}
        assert dict(zip(*(x.tolist() for x in jaccard.repeated(list(parts), least)))) == want
    chunk, size = list(parts), sum(p.nbytes for p in parts)
    tracemalloc.start()
    jaccard.repeated(chunk, 6)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert not chunk and most < 1.5 * size


def test_working_tables_reach_python_in_small_batches(spark):
    def measure(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64()), pa.array([batch.num_rows], pa.int64())], ["bytes", "n"])

    rows = spark.range(0, 6000, 1, 1).selectExpr("repeat('text ', 1000) as text")
    found = Workspace(spark, "batches").save("measured", rows.mapInArrow(measure, "bytes long, n long")).collect()
    assert sum(r["n"] for r in found) == 6000 and max(r["bytes"] for r in found) < 9 << 20
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") != str(4 << 20)


def test_saved_tables_reach_python_in_small_batches(spark):
    def measure(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64()), pa.array([batch.num_rows], pa.int64())], ["bytes", "n"])

    rows = spark.range(0, 6000, 1, 1).selectExpr("repeat('text ', 1000) as text")
    found = common.saved(rows.mapInArrow(measure, "bytes long, n long"), "batches").collect()
    assert sum(r["n"] for r in found) == 6000 and max(r["bytes"] for r in found) < 9 << 20


def test_work_of_other_operators_drops_what_a_worker_kept():
    batch = pa.RecordBatch.from_arrays([pa.array(["a text"])], ["text"])
    coder = tokens.encoder(tokens.vocabulary())
    list(common.lean(lambda batches: batches, tokens.KEPT)([batch]))
    assert tokens.encoder(tokens.vocabulary()) is coder
    assert list(common.lean(lambda batches: batches)([batch])) == [batch]
    assert not tokens._encoders and tokens.encoder(tokens.vocabulary()) is not coder


def test_a_worker_gives_memory_back_between_batches(monkeypatch):
    calls, now = [], [0.0]
    monkeypatch.setattr(common, "give_back", lambda: calls.append(now[0]))
    monkeypatch.setattr(common.time, "monotonic", lambda: now[0])
    monkeypatch.setattr(common, "_given", [])
    batch = pa.RecordBatch.from_arrays([pa.array(["text"])], ["text"])

    def slow(batches):
        for _ in batches:
            now[0] += 0.2
            yield batch

    for _ in range(2):
        assert len(list(common.lean(slow)([batch] * 6))) == 6
    assert [round(x, 1) for x in calls] == [0, 0.6, 1.2, 1.8, 2.4]  # many short tasks do not pay for it one by one


def test_memory_that_nothing_holds_leaves_the_process():
    def held():
        found = re.search(r"\nPss_Anon:\s+(\d+)", open("/proc/self/smaps_rollup").read())
        return int(found[1]) >> 10

    if not os.path.exists("/proc/self/smaps_rollup"):
        pytest.skip("no such figures on this system")
    common.give_back()
    before = held()
    buffers = [pa.array(np.ones(40_000)).take(pa.array(np.arange(40_000))) for _ in range(400)]
    assert held() > before + 100
    del buffers
    common.give_back()
    assert held() < before + 30


def test_texts_are_cut_slice_by_slice(spark):
    """Texts of several slices in one batch; every second one ends with the same passage."""
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(60))
    own = [" ".join(f"{rng.getrandbits(40):x}" for _ in range(30_000)) for _ in range(9)]
    rows = [(i, f"{x} {passage}" if i % 2 else x, "k") for i, x in enumerate(own)] + [(9, None, None), (10, "", "k"), (11, passage, "k")]
    got = {r["doc_id"]: (r["text"], r["kind"]) for r in suffixes.without_repeats(spark.createDataFrame(rows, "doc_id long, text string, kind string").coalesce(1)).collect()}
    want = {i: (f"{x} {passage}" if i == 1 else f"{x} " if i % 2 else x, "k") for i, x in enumerate(own)} | {9: (None, None), 10: ("", "k")}
    assert got == want
