"""Language identification with language-bitmask n-gram filters.

One Bloom filter per language, stored bit-sliced: slot j holds a bitmask of the languages whose filter has bit j
set, so the AND of an n-gram's slots gives all languages containing it at once. Per text and language the hits
are counted, corrected for the filter's false positives, and the largest corrected share decides.

n-grams are 2 to 4 bytes of the lower-cased text with everything but letters as a space. A language contains an
n-gram when its rate there is at least ``SHARE_OF_BEST`` of the best language's rate. The filters are fitted on a
bounded sample of labelled documents (``SAMPLE_PER_LANGUAGE`` for each language in expectation, chosen by a hash
of the id); every whole text is then predicted.

Defined cases: null texts and texts without a letter are ``und`` with score 0; a text of which no n-gram is known
takes the most frequent language, with score 0; with nothing to learn from every text is ``und``; null ids are
never held out and never learned from; ties go to the language first in code-point order; repeated rows are
predicted alike. Columns other than doc_id, text and lang are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtables.llm.common import lean, mixed, slices, utf8

SAMPLE_PER_LANGUAGE = 3000
NGRAMS_PER_LANGUAGE = 30000
SLOTS = 1 << 20
HASHES = 3
SHARE_OF_BEST = 0.2
LENGTHS = (2, 3, 4)
#: A text with a smaller share of known n-grams is in none of the languages.
LEAST_KNOWN = 0.25
UNDETERMINED = "und"

_MULTIPLIERS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)


def held_out():
    """Rows kept from learning: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _plain(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case bytes with a space at both ends of each text and for each ASCII character that is no letter."""
    texts = pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    space = pa.scalar(" ", pa.large_string())
    raw, places = utf8(pc.binary_join_element_wise(space, texts, space, pa.scalar("", pa.large_string())))
    return np.where((raw >= 128) | ((raw >= 97) & (raw <= 122)), raw, 32).astype(np.uint8), places


def _grams(raw: np.ndarray, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams as numbers, and the text of each. n-grams with two spaces in a row are left out."""
    count = len(raw) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    gram = raw[:count].astype(np.uint32)
    for j in range(1, length):
        gram |= raw[j:j + count].astype(np.uint32) << np.uint32(8 * j)
    space = raw == 32
    gap = space[:-1] & space[1:]
    good = ~gap[:count]
    for j in range(1, length - 1):
        good &= ~gap[j:j + count]
    at = np.flatnonzero(good)
    # each text begins and ends with a space, so an n-gram across two texts has two spaces in a row
    return gram[at], np.searchsorted(places, at, side="right") - 1


def _slot(gram: np.ndarray, length: int, which: int) -> np.ndarray:
    salted = gram * np.uint32(_MULTIPLIERS[which]) + np.uint32(0x27D4EB2F * length & 0xFFFFFFFF)
    salted ^= salted >> np.uint32(15)
    return (salted * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - SLOTS.bit_length() + 1)


@dataclass
class Filters:
    """languages in code-point order; masks[w][slot] has the bits of languages 8w to 8w + 7."""

    languages: list[str]
    masks: np.ndarray
    false_positives: np.ndarray
    default: int

    def hits(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Corrected hits by text and language, and the number of n-grams by text."""
        raw, places = _plain(texts)
        found = np.zeros((len(texts), len(self.languages)))
        total = np.zeros(len(texts))
        for length in LENGTHS:
            gram, owner = _grams(raw, places, length)
            edges = np.searchsorted(owner, np.arange(len(texts) + 1))
            total += np.diff(edges)
            slots = [_slot(gram, length, h) for h in range(HASHES)]
            for w, mask in enumerate(self.masks):
                both = mask[slots[0]]
                for s in slots[1:]:
                    both = both & mask[s]
                for bit in range(min(8, len(self.languages) - 8 * w)):
                    counts = np.concatenate([[0], np.cumsum((both >> bit) & 1, dtype=np.int64)])
                    found[:, 8 * w + bit] += counts[edges[1:]] - counts[edges[:-1]]
        corrected = (found - total[:, None] * self.false_positives) / (1 - self.false_positives)
        return np.maximum(corrected, 0), total

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and share of known n-grams of each text."""
        spoken = _has_letter(texts)
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        hits, total = self.hits(texts)
        best = hits.argmax(axis=1)
        top = hits[np.arange(len(hits)), best]
        hits[np.arange(len(hits)), best] = 0
        second = hits.max(axis=1, initial=0)
        best = np.where(top > 0, best, self.default)
        score = np.where(spoken & (top > 0), top / np.maximum(top + second, 1e-9), 0.0)
        known = np.where(spoken, top / np.maximum(total, 1), 0.0)
        return [self.languages[b] if s else UNDETERMINED for b, s in zip(best, spoken)], np.clip(score, 0, 1), np.clip(known, 0, 1)


def _has_letter(texts: pa.Array) -> np.ndarray:
    """True where a text has a letter of any script."""
    return pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)


def fit(docs: DataFrame, sample: int = SAMPLE_PER_LANGUAGE) -> Filters:
    """Filters from the documents that are not held out. What reaches the driver is bounded by the sample."""
    labelled = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Filters([], np.zeros((1, SLOTS), np.uint8), np.zeros(0), 0)
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, min(1.0, sample / n)).otherwise(share)
    drawn = (F.xxhash64("doc_id", F.lit(7)) % 1000000 + 1000000) % 1000000 / 1000000.0
    number = {lang: i for i, lang in enumerate(languages)}

    def count(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                which = np.array([number[x] for x in part.column("lang").to_pylist()], dtype=np.int64)
                raw, places = _plain(part.column("text"))
                for length in LENGTHS:
                    gram, owner = _grams(raw, places, length)
                    keys, counts = np.unique((which[owner] << 32) | gram.astype(np.int64), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keys), length, np.int32)), pa.array(keys), pa.array(counts)],
                        ["length", "key", "n"])

    counted = (labelled.filter(drawn < share).select("text", "lang").mapInArrow(lean(count), "length int, key long, n long")
               .groupBy("length", "key").agg(F.sum("n").alias("n")).filter("n >= 3").toPandas())
    rate = np.zeros(0)
    masks = np.zeros(((len(languages) + 7) // 8, SLOTS), np.uint8)
    length, key, n = (counted[c].to_numpy(dtype=np.int64) for c in ("length", "key", "n"))
    lang, gram = key >> 32, (key & 0xFFFFFFFF).astype(np.uint32)
    totals = np.zeros((5, len(languages)))
    np.add.at(totals, (length, lang), n)
    rate = n / np.maximum(totals[length, lang], 1)
    _, same = np.unique((length << 32) | gram.astype(np.int64), return_inverse=True)
    best = np.zeros(same.max(initial=-1) + 1)
    np.maximum.at(best, same, rate)
    inside = rate >= SHARE_OF_BEST * best[same]
    for i in range(len(languages)):
        mine = np.flatnonzero(inside & (lang == i))
        mine = mine[np.lexsort((key[mine], -n[mine]))][:NGRAMS_PER_LANGUAGE]
        for size in LENGTHS:
            of_size = gram[mine[length[mine] == size]]
            for h in range(HASHES):
                masks[i // 8][_slot(of_size, size, h)] |= np.uint8(1 << (i % 8))
    filled = np.array([((masks[i // 8] >> (i % 8)) & 1).mean() for i in range(len(languages))])
    return Filters(languages, masks, filled ** HASHES, languages.index(max(languages, key=lambda x: (sizes[x], x))))


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, held_out, lang_pred, score, known of every document."""
    def predict(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                lang, score, known = filters.predict(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(lang, pa.string()), pa.array(score), pa.array(known)],
                    ["doc_id", "held_out", "lang_pred", "score", "known"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", held_out().alias("held_out")).mapInArrow(
        lean(predict), f"doc_id {kind}, held_out boolean, lang_pred string, score double, known double")


def accepted(docs: DataFrame, filters: Filters, least_known: float = LEAST_KNOWN) -> DataFrame:
    """The documents in one of the learned languages, with their own columns; the rest is rejected."""
    at = docs.columns.index("text")

    def keep(batches):
        for batch in batches:
            for part in slices(batch, batch.schema.names[at]):
                lang, _, known = filters.predict(part.column(at))
                yield part.filter(pa.array([x != UNDETERMINED and k >= least_known for x, k in zip(lang, known)], pa.bool_()))

    return docs.mapInArrow(lean(keep), docs.schema)
