"""Token ids of whole texts, as bytes.

Byte-level BPE looks at one pre-token at a time. Its pre-tokens never reach across the beginning of a run of white space, from
a letter to a comma or point, or past a line break that stands alone. So the texts of a slice are cut there, Arrow
finds the distinct pieces, each goes through the tokenizer once and is remembered (up to a bound), and a text's ids are its
pieces' ids one after another, gathered by numpy. Where that does not hold (another kind of tokenizer, other white space
than ASCII's, a text with one of the vocabulary's added tokens), the text is encoded whole. Both ways give the same ids.

A new piece of letters of Latin-1, after a space or not, is one pre-token, so the tokenizer's model gets it with its bytes
written as the vocabulary writes them, without the pre-tokenizer, which takes most of the time.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa

from seqtables.llm.common import cache, utf8

#: Text bytes encoded at once.
SLICE = 1 << 22
#: Pieces remembered by a worker, and as many older ones; about 200 bytes each.
REMEMBERED = 250_000
#: The name under which a worker keeps its encoders.
KEPT = "tokens"
_LONGEST_REMEMBERED = 48
_WORD = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: What each byte is to the cutting.
_SPACE, _LETTER, _STOP = (np.isin(np.arange(256), list(x)) for x in (
    b" \t\n\r\f\v", b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", b".,"))
#: The second bytes of Latin-1's letters, all after 0xC3.
_LEAD, _SECOND = 0xC3, np.isin(np.arange(256), sorted(set(range(0x80, 0xC0)) - {0x97, 0xB7}))
#: How a vocabulary of bytes writes each byte.
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_WRITTEN = "".join(chr(b if b in _PLAIN else 256 + sum(x not in _PLAIN for x in range(b))) for b in range(256))
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")

_encoders: dict[str, "Encoder"] = cache(KEPT)


def vocabulary() -> str:
    """The default vocabulary's file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def cut(raw: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each piece of the texts begins (one more entry for the end), and how many begin before each text's place."""
    if not len(raw):
        return np.zeros(1, np.int64), np.zeros(len(places), np.int64)
    white = _SPACE[raw]
    first = np.zeros(len(raw), bool)
    first[places[:-1][places[:-1] < places[1:]]] = True
    begins = first.copy()
    begins[1:] |= white[1:] & ~white[:-1]
    alone = (raw[:-1] == 10) & begins[:-1] & ~white[1:]
    letter = _LETTER[raw]
    letter[1:] |= (raw[:-1] == _LEAD) & _SECOND[raw[1:]]
    begins[1:] |= alone | _STOP[raw[1:]] & letter[:-1]
    starts = np.append(np.flatnonzero(begins), len(raw))
    return starts, np.searchsorted(starts, places)


class _Memory:
    """Pieces and their ids: a number for each piece, and all ids in one array."""

    def __init__(self, dtype: np.dtype):
        self.number: dict[str, int] = {}
        self.ids, self.ends = np.zeros(1 << 16, dtype), np.zeros(1 << 16, np.int64)  # ends[k + 1] is where piece k ends
        self.count = 0

    def add(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.number.update(zip(pieces, range(self.count, self.count + len(pieces))))
        self.append(ids, sizes)

    def append(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        """The ids of pieces that are not to be found by their text."""
        used, count = int(self.ends[self.count]), self.count + len(sizes)
        self.ids, self.ends = _grown(self.ids, used + len(ids)), _grown(self.ends, count + 1)
        self.ids[used:used + len(ids)] = ids
        self.ends[self.count + 1:count + 1] = used + np.cumsum(sizes)
        self.count = count

    def forget(self, count: int) -> None:
        """Only the first so many stay."""
        self.count, used = count, int(self.ends[count])
        if len(self.ids) > 2 * used + (1 << 20):
            self.ids = self.ids[:used].copy()

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the numbered pieces, one piece after another, and how many each has."""
        begins = self.ends[numbers]
        sizes = self.ends[numbers + 1] - begins
        shift = begins - (np.cumsum(sizes) - sizes)
        return self.ids[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))], sizes


def _grown(x: np.ndarray, size: int) -> np.ndarray:
    return x if size <= len(x) else np.concatenate([x, np.zeros(max(size, len(x) * 3 // 2) - len(x), x.dtype)])


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the unit of parallel work
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        shape = json.loads(self.tokenizer.to_str())
        first = shape.get("pre_tokenizer") or {}
        self.in_pieces = (shape["model"]["type"] == "BPE" and not shape.get("normalizer") and first.get("type") == "ByteLevel"
                          and first.get("use_regex") and not first.get("add_prefix_space"))
        added = [t["content"] for t in shape.get("added_tokens", [])]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.known, self.older = _Memory(self.dtype), _Memory(self.dtype)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str], end: int) -> list[bytes]:
        """The ids of each text and then the id of its end, little-endian in ``dtype``."""
        last = np.array([end], self.dtype).tobytes()
        whole = [i for i, t in enumerate(texts)
                 if not self.in_pieces or _ODD_SPACE.search(t) or (self.added and self.added.search(t))]
        done: list[bytes | None] = [None] * len(texts)
        for i, ids in zip(whole, self._whole([texts[i] for i in whole])):
            done[i] = ids + last
        cuttable = [i for i, ids in enumerate(done) if ids is None]
        if not cuttable:
            return done
        raw, places = utf8(pa.array([texts[i] for i in cuttable], pa.large_string()))
        starts, first = cut(raw, places)
        pieces = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(raw)).dictionary_encode()
        numbers, lasting = self._numbers(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids, sizes = self.known.gather(numbers[pieces.indices.to_numpy()])
        self.known.forget(lasting)
        ends = np.append(0, np.cumsum(sizes))[first] * self.dtype.itemsize
        data = memoryview(ids.tobytes())
        for i, b, e in zip(cuttable, ends[:-1].tolist(), ends[1:].tolist()):
            done[i] = bytes(data[b:e]) + last
        return done

    def _numbers(self, wanted: list[str]) -> tuple[np.ndarray, int]:
        """The numbers of distinct pieces in ``known``, which learns those it lacks, and how many of all numbered ones stay
        after this slice: the pieces too long to be remembered come last."""
        if self.known.count > REMEMBERED:
            self.known, self.older = _Memory(self.dtype), self.known
        numbers = np.fromiter(map(self.known.number.get, wanted, repeat(-1)), np.int64, len(wanted))
        missing = np.flatnonzero(numbers < 0)
        if not len(missing):
            return numbers, self.known.count
        before = np.fromiter((self.older.number.get(wanted[i], -1) for i in missing.tolist()), np.int64, len(missing))
        long = np.fromiter((len(wanted[i]) > _LONGEST_REMEMBERED for i in missing.tolist()), bool, len(missing))
        again, fresh, passing = missing[before >= 0], missing[(before < 0) & ~long], missing[long]
        for at, learned in ((again, self.older.gather(before[before >= 0])), (fresh, None), (passing, None)):
            pieces = [wanted[i] for i in at.tolist()]
            numbers[at] = np.arange(self.known.count, self.known.count + len(pieces))
            if at is passing:
                lasting = self.known.count
                self.known.append(*self._learned(pieces))
            else:
                self.known.add(pieces, *(learned or self._learned(pieces)))
        return numbers, lasting

    def _learned(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces, one after another, and how many each has."""
        others = [p for p in pieces if not _WORD.fullmatch(p)]
        found, tokenize = dict(zip(others, self._whole(others))), self.tokenizer.model.tokenize
        ids = [found[p] if p in found else array(self.code, [t.id for t in tokenize(p.encode().decode("latin-1").translate(_WRITTEN))]).tobytes()
               for p in pieces]
        return np.frombuffer(b"".join(ids), self.dtype), np.array([len(x) for x in ids], np.int64) // self.dtype.itemsize


def crc(ids: bytes, dtype: np.dtype) -> int:
    """Checksum of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.frombuffer(ids, dtype).astype("<u4").tobytes())


def encoder(path: str) -> Encoder:
    """This process's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
