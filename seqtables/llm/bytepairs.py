"""Byte-level BPE by backtracking over longest matches, in time linear in the text.

The vocabulary's byte strings, mapped to Latin-1, go into an Aho-Corasick automaton, which gives the longest token from
every place of a piece in one pass. Merging by rank ends in the one sequence of tokens in which each token comes out of
its own bytes and each two neighbours come out of theirs: any merge that crosses a border between them would have been
made. So the encoder goes from longest match to longest match, takes the next shorter prefix where a token does not
suit the one before, goes back one token where no prefix suits, and never tries a place again from which it went back.
Whether two tokens suit is found once, by merging their bytes, and remembered; so are words of ordinary length.

A piece that is a token as a whole is that token, as in the rank files' own library. Decoding gathers the tokens' bytes
from one table by numpy.

Defined cases: a null or empty text has no ids and no bytes; a very long text is cut into pieces by stretches, so that only
its ids are held whole; repeated rows and ids give a row each; an empty table gives no rows. Columns other than doc_id
and text are not looked at. There are no special tokens: their strings are text like any other.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from seqtables.llm.common import slices

#: Units and pairs of tokens remembered by a worker, twice: a full memory is kept as the older one.
REMEMBERED = 400_000
LONGEST_REMEMBERED = 48
#: Characters cut into pieces at once, and text bytes encoded at once.
STRETCH = 1 << 20
SLICE = 1 << 22

NEVER, UNSEEN = 1 << 62, -2
_WORD = re.compile(r"\s*\S+|\s+", re.ASCII)
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

_codecs: dict[tuple[str, str], "Codec"] = {}


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The definition: the adjacent pair of least rank, the first of equal ones, is merged until none is known."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    pairs = [ranks.get(piece[i:i + 2], NEVER) for i in range(len(piece) - 1)]
    while pairs:
        least = min(pairs)
        if least == NEVER:
            break
        i = pairs.index(least)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], NEVER)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], NEVER)
    return [ranks[p] for p in parts]


class Memory:
    """A dict of bounded size: what was remembered before it last filled up is still found."""

    def __init__(self, most: int):
        self.most, self.newer, self.older = most, {}, {}

    def find(self, key):
        """The value, or None."""
        value = self.newer.get(key)
        if value is None and key in self.older:
            value = self.newer[key] = self.older[key]
        return value

    def tidy(self) -> None:
        if len(self.newer) > self.most:
            self.newer, self.older = {}, self.newer


class Codec:
    def __init__(self, path: str, cut: str):
        import ahocorasick
        import regex

        self.ranks = read_ranks(path)
        self.pieces_of = regex.compile(cut).findall
        size = max(self.ranks.values(), default=-1) + 1
        self.token = [b""] * size
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, rank in self.ranks.items():
            self.token[rank] = token
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.length = [len(t) for t in self.token]
        self.lengths = np.array(self.length, np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(self.token), np.uint8)
        self.decimal = [str(i) for i in range(size)]
        self.known, self.suits = Memory(REMEMBERED), Memory(REMEMBERED)
        #: by token: itself, or the longest prefix that merging makes; the longest proper such prefix; UNSEEN, or -1 for none
        self.usable, self.shorter = [UNSEEN] * size, [UNSEEN] * size
        #: whether matches of the pattern end wherever white space begins
        self.by_words = cut == pattern()

    def _usable(self, token: int) -> int:
        """The token if merging its own bytes gives it (others never come out of a merge), else its longest such prefix."""
        self.usable[token] = token if merged(self.token[token], self.ranks) == [token] else self._shorter(token)
        return self.usable[token]

    def _shorter(self, token: int) -> int:
        text = self.token[token]
        for k in range(len(text) - 1, 0, -1):
            prefix = self.ranks.get(text[:k])
            if prefix is not None:
                found = self.usable[prefix]
                self.shorter[token] = self._usable(prefix) if found == UNSEEN else found
                return self.shorter[token]
        self.shorter[token] = -1
        return -1

    def _suit(self, key: int) -> bool:
        found = self.suits.find(key)
        if found is None:
            a, b = divmod(key, len(self.token))
            found = self.suits.newer[key] = merged(self.token[a] + self.token[b], self.ranks) == [a, b]
        return found

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size, length, usable, shorter, count = len(piece), self.length, self.usable, self.shorter, len(self.token)
        longest = [-1] * size
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            longest[end - length[token] + 1] = token
        dead = bytearray(size + 1)
        suits = self.suits.newer.get
        taken: list[int] = []
        place, token = 0, longest[0]
        if token >= 0 and usable[token] != token:
            token = self._usable(token)
        while place < size:
            if token < 0:
                if not taken:
                    raise ValueError("the vocabulary lacks a byte of the text")
                dead[place] = 1
                token = taken.pop()
                place -= length[token]
            else:
                end = place + length[token]
                if not dead[end]:
                    fits = True
                    if taken:
                        key = taken[-1] * count + token
                        fits = suits(key)
                        if fits is None:
                            fits = self._suit(key)
                    if fits:
                        taken.append(token)
                        place = end
                        if place < size:
                            token = longest[place]
                            if token >= 0 and usable[token] != token:
                                token = self._usable(token)
                        continue
            found = shorter[token]
            token = self._shorter(token) if found == UNSEEN else found
        return taken

    def _units(self, text: str) -> Iterator[list[str]]:
        """The text in units, each of whole matches of the pattern, by stretches.

        The default pattern never matches across the beginning of white space, so there a unit may be a word with the
        white space before it. Other patterns, and texts with white space beyond ASCII's, are cut by the pattern. A
        stretch's last two units might go on beyond it and are read again.
        """
        cut = _WORD.findall if self.by_words and not _ODD_SPACE.search(text) else self.pieces_of
        begin, reach = 0, STRETCH
        while len(text) - begin > reach:
            found = cut(text, begin, begin + reach)
            held = found[:-2]
            if not held or sum(map(len, found)) != reach:
                reach *= 2
                continue
            yield held
            begin, reach = begin + sum(map(len, held)), STRETCH
        yield cut(text, begin)

    def _encode_unit(self, unit: str) -> bytes:
        pieces = self.pieces_of(unit)
        if len(pieces) == 1:
            return array("I", self.encode_piece(unit.encode())).tobytes()
        done = []
        for piece in pieces:
            ids = self.known.find(piece)
            if ids is None:
                ids = array("I", self.encode_piece(piece.encode())).tobytes()
                if len(piece) <= LONGEST_REMEMBERED:
                    self.known.newer[piece] = ids
            done.append(ids)
        return b"".join(done)

    def encode(self, text: str) -> np.ndarray:
        """The ids as unsigned 32-bit numbers."""
        done = []
        for units in self._units(text):
            self.known.tidy()
            self.suits.tidy()
            known, passing = self.known.newer, []
            for unit in set(units).difference(known):
                if self.known.find(unit) is None:
                    known[unit] = self._encode_unit(unit)
                    if len(unit) > LONGEST_REMEMBERED:
                        passing.append(unit)
            done += map(known.__getitem__, units)
            for unit in passing:
                del known[unit]
        return np.frombuffer(b"".join(done), np.uint32)

    def decode(self, ids: np.ndarray) -> bytes:
        if not len(ids):
            return b""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.begins[ids] - (ends - lengths), lengths)
        return self.bytes[shift + np.arange(int(ends[-1]))].tobytes()


def codec(path: str, cut: str) -> Codec:
    """This process's codec for a rank file and a pattern."""
    if (path, cut) not in _codecs:
        _codecs[path, cut] = Codec(path, cut)
    return _codecs[path, cut]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(a) for a in arrays])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(arrays).astype(np.int32)))


def encode(docs: DataFrame, path: str | None = None, cut: str | None = None) -> DataFrame:
    """doc_id and the text's ids, in order."""
    path, cut = path or vocabulary(), cut or pattern()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        coder = codec(path, cut)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                ids = [coder.encode(t or "") for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), _lists(ids)], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def _each(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    column = batch.column("ids")
    values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    for a, b in zip(ends[:-1], ends[1:]):
        yield values[a:b]


def decode(tokens: DataFrame, path: str | None = None, cut: str | None = None) -> DataFrame:
    """doc_id and the bytes of the ids; cast them to string where the ids are those of a whole text."""
    path, cut = path or vocabulary(), cut or pattern()
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches):
        coder = codec(path, cut)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([coder.decode(i) for i in _each(batch)], pa.binary())],
                                             ["doc_id", "bytes"])

    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, bytes binary")


def digests(tokens: DataFrame, path: str | None = None, cut: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the bytes they stand for."""
    path, cut = path or vocabulary(), cut or pattern()
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches):
        coder = codec(path, cut)
        for batch in batches:
            rows = list(_each(batch))
            written = [" ".join(map(coder.decimal.__getitem__, ids.tolist())).encode() for ids in rows]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(ids) for ids in rows], pa.int64()),
                pa.array([hashlib.sha256(w).hexdigest() for w in written]),
                pa.array([hashlib.sha256(coder.decode(ids)).hexdigest() for ids in rows])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
