"""Backtracking byte pairs against the rank files' own library, and round trips."""

import hashlib
import random

import numpy as np
import pytest
import tiktoken

from seqtables.llm import bytepairs
from seqtables.llm.registry import QUERIES


def library(path):
    return tiktoken.Encoding("own", pat_str=bytepairs.pattern(), mergeable_ranks=bytepairs.read_ranks(path), special_tokens={})


def texts():
    rng = random.Random(3)
    alphabets = ("ab", "abc ", "etaoin shrdlu", "0123456789.,", "\n\t  a\x1c\xa0", "éüß日本語😀 a", "'srtve l", " 　 x.")
    hard = ["", " ", "a" * 5000, " " * 3000, "ab" * 2000, "\n\n x", "<|endoftext|> b", "١٢ 3.5, 4².", " x", "don't  'S", "\xa0 \xa0b"]
    return hard + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 120))) for letters in alphabets for _ in range(60)]


def vocabularies():
    import public_tokenizers

    return [public_tokenizers.path(f"byte_bpe_{kind}.tiktoken") for kind in ("50k", "multi_50k")]


@pytest.mark.parametrize("path", vocabularies())
@pytest.mark.parametrize("stretch", [bytepairs.STRETCH, 7])
def test_ids_are_the_librarys(path, stretch, monkeypatch):
    monkeypatch.setattr(bytepairs, "STRETCH", stretch)
    coder, own = bytepairs.Codec(path, bytepairs.pattern()), library(path)
    for text in texts():
        ids = coder.encode(text)
        assert ids.tolist() == own.encode_ordinary(text), text[:60]
        assert coder.decode(ids) == text.encode()


def test_ids_under_another_pattern():
    cut = r"\S+|\s+"
    coder = bytepairs.Codec(bytepairs.vocabulary(), cut)
    own = tiktoken.Encoding("own", pat_str=cut, mergeable_ranks=bytepairs.read_ranks(bytepairs.vocabulary()), special_tokens={})
    for text in texts()[:200]:
        assert coder.encode(text).tolist() == own.encode_ordinary(text)


def test_small_memory_gives_the_same_ids(monkeypatch):
    monkeypatch.setattr(bytepairs, "REMEMBERED", 3)
    coder, own = bytepairs.Codec(bytepairs.vocabulary(), bytepairs.pattern()), library(bytepairs.vocabulary())
    for text in texts()[:200]:
        assert coder.encode(text).tolist() == own.encode_ordinary(text)


def test_tokens_that_no_merge_makes(tmp_path):
    """A vocabulary with a token out of reach of merges, and one without some bytes."""
    import base64

    tokens = [b"a", b"b", b"c", b"d", b"bc", b"ab", b"cd", b"abcd", b"abc"]
    path = tmp_path / "small.tiktoken"
    path.write_text("\n".join(f"{base64.b64encode(t).decode()} {i}" for i, t in enumerate(tokens)))
    coder, ranks = bytepairs.Codec(str(path), r"\S+|\s+"), bytepairs.read_ranks(str(path))
    rng = random.Random(8)
    for _ in range(400):
        text = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 14)))
        want = [ranks[text.encode()]] if text.encode() in ranks else bytepairs.merged(text.encode(), ranks)
        assert coder.encode(text).tolist() == want
    with pytest.raises(ValueError):
        coder.encode("x")


def test_tables(spark, docs, corpus_rows, empty):
    own = library(bytepairs.vocabulary())
    ids = sorted(((r["doc_id"], r["ids"]) for r in bytepairs.encode(docs).collect()), key=repr)
    assert ids == sorted(((r[0], own.encode_ordinary(r[1] or "")) for r in corpus_rows), key=repr)
    back = sorted(((r["doc_id"], bytes(r["bytes"])) for r in bytepairs.decode(bytepairs.encode(docs)).collect()), key=repr)
    assert back == sorted(((r[0], (r[1] or "").encode()) for r in corpus_rows), key=repr)
    got = sorted((tuple(r) for r in bytepairs.digests(bytepairs.encode(docs)).collect()), key=repr)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert got == sorted(((r[0], len(i), sha(" ".join(map(str, i))), sha(r[1] or "")) for r in corpus_rows for i in [own.encode_ordinary(r[1] or "")]), key=repr)
    assert bytepairs.digests(bytepairs.encode(empty)).count() == 0


def test_query(spark, sf):
    own = library(bytepairs.vocabulary())
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op12_bytepairs"](spark, sf)
    assert got.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    for r in got.collect():
        ids = own.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_decoding_gathers_any_ids():
    coder = bytepairs.Codec(bytepairs.vocabulary(), bytepairs.pattern())
    ids = np.array([0, 50255, 17, 17, 300])
    assert coder.decode(ids) == b"".join(coder.token[i] for i in ids)
