"""Each operator on a small corpus of hard cases, against brute force."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seqtables.llm import common, fixity, codesearch, jaccard, langid, mixing, packing, suffixes, syncmers, tokenfiles, tokens, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def encode(text):
    return tokens.encoder(tokens.vocabulary()).tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# --- helpers ------------------------------------------------------------------------------

def test_words_and_hashes_are_those_of_each_text():
    texts = ["a bb\tccc", None, "", " x", "bb", "é bb\n"]
    found = common.Words(*common.utf8(pa.array(texts)))
    assert np.diff(found.first).tolist() == [len(WORD.findall(t or "")) for t in texts]
    h = found.hashes()
    assert h[1] == h[4] == h[6] and len(set(h.tolist())) == 5
    runs = common.runs_hashed(h, 2)
    assert len(set(runs[:-1].tolist())) == len(h) - 1


def test_pieces_encode_as_whole_texts():
    odd = ["a\n\nb.  c,\td ’s it's, don't x.\n", "\n", "", " . , ", "é.,ü.\r\nñ", "a <|endoftext|> b", "x  y", "١٢ 3.5, 4²."]
    coder = tokens.Encoder(tokens.vocabulary())
    assert [np.frombuffer(b, coder.dtype).tolist() for b in coder.encode(odd, 2)] == [encode(t) + [2] for t in odd]


# --- language -------------------------------------------------------------------------------

def test_language(spark, docs, empty):
    rows = [(i, ("der hund und die katze gehen heute " if i % 2 else "the dog and the cat walk today ") * 3, "de" if i % 2 else "en") for i in range(120)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = langid.fit(train)
    got = {r["doc_id"]: r for r in langid.identify(train, filters).collect()}
    assert filters.languages == ["de", "en"]
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows)
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _, _ in rows)
    hard = langid.identify(docs, filters).collect()
    assert len(hard) == docs.count() and all(0 <= r["score"] <= 1 for r in hard)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in hard:
        letters = any(c.isalpha() for c in texts[r["doc_id"]] or "")
        assert (r["lang_pred"] == "und") == (not letters)
    assert langid.identify(empty, filters).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs, langid.fit(empty)).collect()} == {"und"}
    kept = langid.accepted(docs, filters, 0.0)
    assert kept.columns == docs.columns and kept.filter("text is null").count() == 0
    assert langid.accepted(train, filters).count() == len(rows)


# --- mixing -----------------------------------------------------------------------------------

def test_mixing_against_water_filling(docs, corpus_rows, empty):
    sizes = Counter()
    for r in corpus_rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    target, left, free = {}, float(sum(sizes.values())), set(order)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= over
    rows = mixing.mix(docs).collect()
    source = {r[0]: r[3] for r in corpus_rows}
    assert len(rows) == len(corpus_rows)
    for r in rows:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - target[s]) < 1e-6
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
    assert sorted(rows, key=repr) == sorted(mixing.mix(docs).collect(), key=repr)
    assert mixing.mix(empty).count() == 0
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in rows)


def test_mixing_plan_is_native(docs):
    plan = mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- packing, files -----------------------------------------------------------------------------

def test_packing_places_each_id_once(docs, corpus_rows, empty):
    rows = packing.pack(docs, window=2).collect()
    ids = {r[0]: encode(r[1]) + [0] for r in corpus_rows}
    times = Counter(r[0] for r in corpus_rows)
    taken, filled = Counter(), Counter()
    for r in rows:
        own = ids[r["doc_id"]]
        assert r["ids_crc32"] == crc(own[r["start"]:r["start"] + r["length"]]) and r["doc_tokens"] == len(own)
        assert 0 < r["length"] and r["offset"] + r["length"] <= packing.LENGTH
        for k in range(r["start"], r["start"] + r["length"]):
            taken[r["doc_id"], k] += 1
        for k in range(r["offset"], r["offset"] + r["length"]):
            filled[r["sequence_id"], k] += 1
    assert taken == {(d, k): times[d] for d in ids for k in range(len(ids[d]))}
    assert set(filled.values()) == {1} and len(filled) == sum(taken.values())
    assert set(filled) == {(i // packing.LENGTH, i % packing.LENGTH) for i in range(len(filled))}
    assert packing.pack(empty).count() == 0


def test_windows_follow_the_target_shares(spark):
    rows = [(i, "word " * (20 + i % 7), "a" if i % 4 else "b") for i in range(400)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string"), window=1)
    source = {i: s for i, _, s in rows}
    per = Counter()
    for r in got.collect():
        per[r["window"], source[r["doc_id"]]] += r["length"]
    total = Counter()
    for (_, s), n in per.items():
        total[s] += n
    windows, largest = 1 + max(w for w, _ in per), 30
    sent = Counter()
    for w in range(windows):
        for s in "ab":
            sent[s] += per[w, s]
            assert abs(sent[s] - total[s] * (w + 1) / windows) <= largest


def test_windows_meet_given_weights(spark):
    rows = [(i, "word " * (3000 if i % 40 == 0 else 100), "abc"[i % 3]) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    source, length = {i: s for i, _, s in rows}, packing.LENGTH * 2
    for weights in (None, {"a": 3, "b": 1}):
        got = packing.pack(docs, window=2, weights=weights).collect()
        per, total = Counter(), Counter()
        for r in got:
            per[r["window"], source[r["doc_id"]]] += r["length"]
            total[source[r["doc_id"]]] += r["length"]
        windows = 1 + max(w for w, _ in per)
        assert windows == -(-sum(total.values()) // length)
        size = sum(total.values()) / windows
        if weights is None:  # a document longer than a window's quantum is dealt over several
            assert all(abs(per[w, s] - total[s] / windows) <= 2 for w in range(windows) for s in "abc")
        else:
            share = [w for w in range(windows) if (w + 1) * size * 0.75 <= total["a"]]
            assert share and all(abs(per[w, "a"] - size * 0.75) <= 2 and abs(per[w, "b"] - size * 0.25) <= 2 and not per[w, "c"] for w in share)
            assert all(w >= max(share) for w, s in per if s == "c")
        places = Counter((r["doc_id"], k) for r in got for k in range(r["start"], r["start"] + r["length"]))
        assert set(places.values()) == {1} and len(places) == sum(total.values())


def test_token_files_round_trip(spark, docs, corpus_rows, empty):
    rows = tokenfiles.read(spark, tokenfiles.write(docs)).orderBy("start").collect()
    order = sorted(corpus_rows, key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    for r, want in zip(rows, order, strict=True):
        ids = encode(want[1]) + [2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (want[0], start, len(ids), crc(ids))
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        start += len(ids)
    assert tokenfiles.read(spark, tokenfiles.write(empty)).count() == 0


def test_rank_code_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = rng.integers(0, 1 << 32, n, dtype=np.uint64) >> rng.integers(0, 32, n, dtype=np.uint64)
        controls, data = tokenfiles.encode_ranks(ranks)
        assert len(controls) == -(-n // 4)
        assert tokenfiles.decode_ranks(controls, data, n).tolist() == ranks.tolist()


# --- near copies ------------------------------------------------------------------------------

def shingles(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components(rows):
    sets = [(r[0], shingles(r[1])) for r in rows if r[0] is not None]
    parent = {d: d for d, _ in sets}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    return {d: find(d) for d in parent}


def test_jaccard_join(docs, corpus_rows, empty):
    want = components(corpus_rows)
    rows = jaccard.join(docs).collect()
    assert len(rows) == len(corpus_rows)
    texts = {r[0]: r[1] for r in corpus_rows}
    for r in rows:
        assert r["n_shingles"] == len(shingles(texts[r["doc_id"]]))
        assert r["component_id"] == want.get(r["doc_id"])
    assert jaccard.join(empty).count() == 0
    kept = jaccard.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(set(want.values()))


def test_signature_tree_loses_no_link():
    rng = np.random.default_rng(3)
    base = [np.unique(rng.integers(0, 1 << 63, 60, dtype=np.uint64)) for _ in range(6)]
    sets = sorted((np.unique(np.concatenate([b[rng.random(len(b)) > 0.1], rng.integers(0, 1 << 63, rng.integers(0, 12), dtype=np.uint64)]))
                   for b in base for _ in range(20)), key=len)
    bits = np.stack([jaccard.signature(s) for s in sets])
    i, j = jaccard.tree_pairs(np.array([len(s) for s in sets]), bits, np.arange(len(sets)))
    found = set(zip(i.tolist(), j.tolist()))
    links = {(a, b) for b in range(len(sets)) for a in range(b) if jaccard.alike(sets[a], sets[b])}
    assert links and links <= found and len(found) < len(sets) * (len(sets) - 1) / 4


def test_links_share_a_first_token():
    rng = np.random.default_rng(4)
    for _ in range(200):
        base = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 40), dtype=np.uint64))
        other = np.unique(np.concatenate([base[rng.random(len(base)) > 0.15], rng.integers(0, 1 << 63, rng.integers(0, 4), dtype=np.uint64)]))
        if len(other) and jaccard.alike(base, other):
            frequent = np.sort(rng.choice(base, len(base) // 3, replace=False))
            tier = rng.choice(np.array([1, 3], np.uint64), len(frequent))
            assert len(np.intersect1d(jaccard.prefix(base, frequent, tier), jaccard.prefix(other, frequent, tier)))


def test_hot_buckets_are_dealt_by_block_pairs(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 16)
    rows = [(7, c * 7919, c % 3 == 0, 40, 80) for c in range(120)] + [(8, c, c == 0, 1, 9) for c in range(10)]
    cells, places = {}, {}
    for r in jaccard._celled(spark.createDataFrame(rows, "token long, class long, main boolean, bulk long, others long")).collect():
        cells.setdefault((r["token"], r["cell"]), []).append(r)
        places.setdefault((r["token"], r["class"]), {})[r["cell"]] = (r["side"], r["main"])
    assert max(map(len, cells.values())) <= 4 * 16
    for token, a, main, *_ in rows:
        for other, b, also, *_ in rows:
            if token == other and a < b:
                x, y = places[token, a], places[token, b]
                met = sum((x[c][0] == 0) or x[c][0] != y[c][0] for c in set(x) & set(y))
                assert met == (0 if main and also and token == 7 else 1)


def test_template_pages_make_no_pairs_and_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 8)
    page = " ".join(f"menu{k}" for k in range(20))
    texts = [f"{page} {' '.join(f'own{i}x{k}' for k in range(4))}" for i in range(60)]
    texts += [f"{page} same{i // 2} same same {'end' * (i % 2)}" for i in range(30)]
    docs = [(i, t) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.join(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert got == components(docs)
    # sets of one size that meet in too few buckets are dropped as a tree
    n, bits = np.full(5000, 20), np.full((5000, jaccard.SIGNATURE_BITS // 8), 255, np.uint8)
    tree = jaccard._tree(n, bits, np.arange(5000), np.full(5000, 2))
    assert not list(jaccard._crossed(tree, tree))
    tree = jaccard._tree(n, bits, np.arange(5000))
    assert max(len(x) for x, _ in jaccard._crossed(tree, tree)) <= jaccard._AT_ONCE


def test_frequent_tokens_are_those_of_the_whole_corpus(spark):
    # six copies side by side are frequent in their chunk, but not among all documents
    rows = spark.range(0, 14000, 1, 8).selectExpr("id as doc_id", "concat('page ', id div 6, ' of this book') as text")
    assert jaccard._frequent(jaccard._described(rows)).count() == 0
    common = rows.selectExpr("doc_id", "if(doc_id % 100 = 0, 'one text all over again', if(doc_id % 250 = 3, 'a less common text here', text)) as text")
    assert sorted(r["tier"] for r in jaccard._frequent(jaccard._described(common)).collect()) == [1, 3]


# --- repeated passages ----------------------------------------------------------------------------

def spans(rows, length=suffixes.PASSAGE):
    rows = sorted({(r[0], r[1]) for r in rows if r[0] is not None and r[1]})
    first, count, hashes = {}, Counter(), []
    for d, t in rows:
        w = WORD.findall(t)
        own = [tuple(w[i:i + length]) for i in range(len(w) - length + 1)]
        hashes.append((d, own))
        for i, h in enumerate(own):
            first.setdefault(h, (d, i))
            count[h] += 1
    covered = {}
    same = Counter(t for _, t in rows)
    least = {}
    for d, t in rows:
        least.setdefault(t, d)
    for (d, own), (_, t) in zip(hashes, rows):
        for i, h in enumerate(own):
            if count[h] > 1:
                covered.setdefault((d, first[h] == (d, i)), set()).update(range(i, i + length))
        n = len(WORD.findall(t))
        if same[t] > 1 and n >= length:
            covered.setdefault((d, least[t] == d), set()).update(range(n))
    return covered


def test_repeated_passages(docs, corpus_rows, empty):
    got = {}
    for r in suffixes.repeated_spans(docs).collect():
        cell = got.setdefault((r["doc_id"], r["first"]), set())
        own = set(range(r["start"], r["start"] + r["n_words"]))
        assert r["n_words"] >= suffixes.PASSAGE and not cell & own
        cell |= own
    want = spans(corpus_rows)
    assert got == want and any(not f for _, f in want)
    assert suffixes.repeated_spans(empty).count() == 0
    texts = {}
    for r in suffixes.without_repeats(docs).collect():
        assert r["n_chars"] == len(r["text"] or "") or r["doc_id"] is None
        texts.setdefault(r["doc_id"], r["text"])
    for d, t, *_ in corpus_rows:
        gone = want.get((d, False), set())
        left = [w for i, w in enumerate(WORD.findall(t or "")) if i not in gone]
        assert WORD.findall(texts.get(d) or "") == left
        if not gone:
            assert texts[d] == t


# --- fingerprints -------------------------------------------------------------------------------

def test_fingerprints(docs, corpus_rows, empty, spark):
    rows = sorted(syncmers.fingerprints(docs).collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    order = sorted(corpus_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    prints = {}
    for i, (r, want) in enumerate(zip(rows, order, strict=True)):
        text, following = want[1] or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 4
        changed = text[:len(text) - cut] + following[:cut]
        assert r["doc_id"] == want[0] and r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"] and (r["fingerprint"] == "") == (text == "")
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if len(text) > 400:
            assert r["near_edited"] > 0.5
    assert syncmers.fingerprints(empty).count() == 0
    alone = syncmers.fingerprints(spark.createDataFrame([(1, "just this one text")], "doc_id long, text string")).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0


def test_syncmers_are_those_of_brute_force():
    text = "the quick brown fox jumps over the lazy dog, then rests a while under a tree"
    raw = text.encode()
    found = syncmers.anchors(pa.array([text]))[0]
    small = common.mixed(np.array([int.from_bytes(raw[i:i + syncmers.S], "little") for i in range(len(raw) - syncmers.S + 1)], np.uint64)).tolist()
    width = syncmers.K - syncmers.S + 1
    chosen = [i for i in range(len(raw) - syncmers.K + 1) if min(small[i:i + width]) in (small[i], small[i + width - 1])]
    assert len(found) == min(len(chosen), syncmers.ANCHORS)
    assert set((found & np.uint64(0xFFFF)).tolist()) <= {i // 16 for i in chosen}
    assert syncmers.likeness(found, found) == 1.0


def test_fingerprints_of_very_long_texts():
    rng = np.random.default_rng(6)
    long = [rng.integers(97, 123, 6_000_000, dtype=np.uint8).tobytes().decode() for _ in range(2)]
    turned = long[0][:2_000_000] + long[0][4_000_000:] + long[0][2_000_000:4_000_000]
    found = syncmers.anchors(pa.array([*long, turned]))
    assert syncmers.likeness(found[0], found[1]) == 0.0
    assert syncmers.likeness(found[0], found[0]) == 1.0
    assert syncmers.likeness(found[0], found[2]) < 0.9
    assert all(len(syncmers.text_of(f)) == 16 * syncmers.ANCHORS for f in found)


# --- toxicity -------------------------------------------------------------------------------------

def test_toxicity(spark, docs, empty):
    rng = np.random.default_rng(8)
    plain = ["walk", "tree", "house", "river", "stone", "light", "paper", "green"]
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        w = rng.choice(plain, 30).tolist()
        if bad:
            w[int(rng.integers(30))] = ["grobal", "snirk"][i % 8 // 4]
        elif i % 30 == 1:
            w[5:7] = ["snirk", "fish"]
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    train = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    lexicon = toxicity.fit(train, marks)
    got = {r["doc_id"]: r for r in toxicity.score(train, lexicon).collect()}
    assert sum(got[i]["predicted"] == y for i, y in labels) >= 390
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _ in labels)
    tricky = spark.createDataFrame([(1, "Gr0bal tree"), (2, "grоbal stone"), (3, "snirk fish"), (4, ""), (5, None)], "doc_id long, text string")
    marked = {r["doc_id"]: r["predicted"] for r in toxicity.score(tricky, lexicon).collect()}
    assert marked == {1: 1, 2: 1, 3: 0, 4: 0, 5: 0}
    assert toxicity.score(docs, lexicon).count() == docs.count() and toxicity.score(empty, lexicon).count() == 0
    assert {r["score"] for r in toxicity.score(docs, toxicity.fit(docs, marks.limit(0))).collect()} < {0.0} | {float(np.exp(-50.0))} | {1 / (1 + np.exp(50.0))}


# --- search, fixity ---------------------------------------------------------------------------------

def test_code_search(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=24).tolist()) for i in range(300)] + [(300 + i, [1.0] * 24) for i in range(40)]
    rows += [(400, None), (None, [1.0] * 24), (450, [0.5, None, -1.0]), (300, [1.0] * 24)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    bits = {}
    for i, v in rows:
        if i is not None and v is not None:
            bits[i] = [x is not None and x > 0 for x in v] + [False] * (24 - len(v))
    got = {}
    for r in codesearch.search(vectors, k=5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["distance"], r["neighbour_id"]))
    assert set(got) == {i for i in bits if i % 50 == 0}
    for q, found in got.items():
        want = sorted((sum(a != b for a, b in zip(bits[q], bits[i])), i) for i in bits if i != q)[:5]
        assert [(d, i) for _, d, i in sorted(found)] == want
    assert codesearch.search(vectors.limit(0)).count() == 0


def test_code_search_in_groups(spark, monkeypatch):
    """Masks become rows for the first bits of a segment only, and crowded groups are dealt over several."""
    unfolded, flips = [], codesearch._flips
    monkeypatch.setattr(codesearch, "_flips", lambda width, radius: unfolded.append((width, radius)) or flips(width, radius))
    monkeypatch.setattr(codesearch, "GROUP_CODES", 64)
    monkeypatch.setattr(codesearch, "MOST_CODES", 16)
    rng = np.random.default_rng(8)
    signs = rng.integers(0, 2, (600, 32)) * 2 - 1
    signs[200:400, :11] = 1
    signs[400:420] = signs[7]
    vectors = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(signs)], "vec_id long, embedding array<double>")
    got = {}
    for r in codesearch.search(vectors, k=6).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["distance"], r["neighbour_id"]))
    assert set(got) == set(range(0, 600, 50))
    for q, found in got.items():
        want = sorted((int((signs[q] != signs[i]).sum()), i) for i in range(600) if i != q)[:6]
        assert [(d, i) for _, d, i in sorted(found)] == want
    assert unfolded and max(width for width, _ in unfolded) <= 4 and max(radius for _, radius in unfolded) <= 4


def test_nearest_keep_ties_of_one_id():
    asking, distance, least = (np.array(x) for x in ([1, 0, 0, 0, 0, 1], [4, 2, 2, 2, 1, 3], [9, 5, 5, 6, 8, 9]))
    assert sorted(codesearch._nearest(asking, distance, least, 2).tolist()) == [0, 1, 2, 4, 5]
    assert len(codesearch._nearest(*(np.zeros(0, int),) * 3, 2)) == 0


def test_fixity(spark):
    pages = spark.createDataFrame([(i, f"http://x/{i}", "page " * (i % 13)) for i in range(1, 700)] + [(5000, None, None), (None, "u", "h")],
                                  "page_id long, url string, html string")
    a = fixity.records(pages)
    hurt = F.when(F.col("page_id") == 77, F.lit("hurt")).otherwise(F.col("html"))
    b = fixity.records(pages.filter("page_id <> 300").withColumn("html", hurt).unionByName(
        spark.createDataFrame([(9000, "http://new", "x")], pages.schema)))
    found = {r["record_id"]: r for r in fixity.audit(a, b).collect()}
    assert {k: r["status"] for k, r in found.items()} == {77: "changed", 300: "missing", 9000: "extra"}
    held = {r["record_id"]: r["record"].encode() for r in a.collect()}
    volume = b"".join(held[i] for i in sorted(held) if i < fixity.VOLUME)
    r = found[77]
    assert volume[r["offset"]:r["offset"] + r["length"]] == held[77] and r["hash"] == hashlib.sha256(held[77]).hexdigest()
    assert fixity.audit(a, a).count() == 0
    assert fixity.audit(a, a.limit(0)).count() == 700
