"""Toxicity by a weighted lexicon, matched with Aho-Corasick.

Text is folded first: lower case, look-alike letters of other scripts and digits or signs that stand for letters, at any
place of a run with a letter, become the letter meant. The lexicon holds whole words and word beginnings, each weighted by how much more often
it occurs in toxic than in other documents; it is learned from a bounded sample of labelled documents
(``SAMPLE_PER_CLASS`` of each class in expectation). Entries are taken one by one, each for the toxic documents
that none before it explains, so words that merely recur in copies of a toxic document stay out. Exception phrases are words or word pairs around a match
that occur in clean documents; a match inside one does not count. The sum of weights and the sum per word of the text give the score through a logistic curve.

Defined cases: null, empty and matchless texts have the score of texts without matches; documents without a label are scored
like any other; where nothing is labelled every score is 0; labels repeated for a document count as toxic if one
of them is; null ids are not held out and never learned from. Columns other than those named are not looked at.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtables.llm.common import slices

SAMPLE_PER_CLASS = 4000
#: A lexicon entry occurs in so many toxic documents of the sample, and this many times more often than in others.
LEAST_DOCUMENTS = 4
LEAST_RATIO = 8.0
MOST_CANDIDATES = 20000
#: Entries with this share of the heaviest one's weight stay whatever the others explain.
NEARLY = 0.85
STEMS = range(4, 10)
THRESHOLD = 0.3

# Letters of other scripts that look like a Latin letter, and signs written for one.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "ι": "i", "κ": "k", "ν": "v", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g",
}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}

_LOOKS = str.maketrans(LOOK_ALIKES)
_SIGNED = str.maketrans(SIGNS)
_WORD = re.compile(r"\w+")
#: a run of letters, digits and signs that holds a digit or sign standing for a letter
_MASKED = re.compile(r"(?<![^\W_])(?<![@$!|])[^\W_0134578]*+[0134578@$!|](?:[^\W_]|[@$!|])*+")
_UNEVEN = re.compile(r"[ıɡͰ-ӿԀ-ԯ]")


def held_out():
    """Rows kept from learning: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _unmasked(found: re.Match) -> str:
    """The run with its digits and signs as letters, if it has a letter at all. ``!`` and ``|`` at its end are punctuation."""
    run = found.group()
    word = run.rstrip("!|")
    return word.translate(_SIGNED) + run[len(word):] if any(c.isalpha() for c in word) else run


def fold(text: str | None) -> str:
    """The text's words in lower case with look-alikes resolved, with one space before and after each."""
    if not text:
        return " "
    text = text.lower()
    if not text.isascii() and _UNEVEN.search(text):
        text = text.translate(_LOOKS)
    text = _MASKED.sub(_unmasked, text)
    return f" {' '.join(_WORD.findall(text))} "


@dataclass
class Lexicon:
    """weights by entry; an entry begins with a space, and ends with one if it is a whole word."""

    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    curve: tuple[float, ...] = (-50.0, 0.0, 0.0)

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            found.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), None))
        if len(found):
            found.make_automaton()
        return found

    def matches(self, automaton, folded: str) -> list[tuple[int, int, float]]:
        """Begin, end and weight of the matches outside exceptions; at one begin the heaviest counts."""
        if not len(automaton):
            return []
        hits: dict[int, tuple[int, float]] = {}
        spared = []
        for last, (length, weight) in automaton.iter(folded):
            begin = last + 1 - length
            if weight is None:
                spared.append((begin, last + 1))
            elif begin not in hits or hits[begin][1] < weight:
                hits[begin] = (last + 1, weight)
        # the furthest end of the exceptions that begin at or before a match decides whether one holds it
        spared.sort()
        begins, ends = [x for x, _ in spared], list(accumulate((y for _, y in spared), max))
        held = lambda b, e: (k := bisect_right(begins, b)) > 0 and ends[k - 1] >= e
        return [(b, e, w) for b, (e, w) in hits.items() if not held(b, e)]

    def features(self, automaton, text: str | None) -> tuple[float, float]:
        folded = fold(text)
        weight = sum(w for _, _, w in self.matches(automaton, folded))
        return np.log1p(weight), np.log1p(100 * weight / folded.count(" "))

    def score(self, features: np.ndarray) -> np.ndarray:
        bias, total, dense = self.curve
        return 1 / (1 + np.exp(-np.clip(bias + total * features[:, 0] + dense * features[:, 1], -50, 50)))


def sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> tuple[DataFrame, dict[int, float]]:
    """Text and label of a bounded number of documents that are not held out, and each class's share drawn."""
    known = (labels.select("doc_id", "toxic").filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    shares = {k: min(1.0, per_class / n) for k, n in sizes.items()}
    drawn = (F.xxhash64("doc_id", F.lit(11)) % 1000000 + 1000000) % 1000000 / 1000000.0
    share = F.when(F.col("toxic") == 1, shares.get(1, 0.0)).otherwise(shares.get(0, 0.0))
    # the sample is bounded by per_class, so it may be broadcast
    few = F.broadcast(known.filter(drawn < share).select("doc_id", "toxic"))
    return docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(few, "doc_id").select("text", "toxic"), shares


def _counted(rows: DataFrame, pieces) -> dict[str, dict[str, int]]:
    """For each piece the number of toxic and of other documents with it; pieces: folded text -> set."""
    def count(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                seen: Counter = Counter()
                for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                    seen.update((p, toxic) for p in pieces(fold(text)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _ in seen]), pa.array([t for _, t in seen], pa.int32()), pa.array(list(seen.values()), pa.int64())],
                    ["piece", "toxic", "n"])

    both = (rows.mapInArrow(count, "piece string, toxic int, n long").groupBy("piece")
            .agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
                 F.sum(F.when(F.col("toxic") == 1, 0).otherwise(F.col("n"))).alias("good")))
    return both


def _candidates(folded: str) -> set[str]:
    found = set()
    for word in folded.split():
        if len(word) >= 3:
            found.add(f" {word} ")
        found.update(f" {word[:n]}" for n in STEMS if len(word) >= n)
    return found


def _around(lexicon: Lexicon):
    """Words and word pairs about the lexicon's matches."""
    automaton = lexicon.automaton()

    def pieces(folded: str) -> set[str]:
        found = set()
        for begin, end, _ in lexicon.matches(automaton, folded):
            stop = folded.index(" ", max(end - 1, begin + 1))
            before = folded.rfind(" ", 0, begin) if begin else 0
            after = folded.find(" ", stop + 1)
            found.add(folded[begin:stop + 1])
            found.add(folded[max(before, 0):stop + 1])
            found.add(folded[begin:(after if after > 0 else stop) + 1])
        return found

    return pieces


def _choose(rows: list[tuple[str, int, int]], toxic: float, clean: float) -> dict[str, float]:
    """Of a word's beginnings the longest that loses no more than a tenth of the shorter one's documents."""
    ratio = {p: (bad + 0.5) / (toxic + 1) / ((good + 0.5) / (clean + 1)) for p, bad, good in rows}
    bad = {p: b for p, b, _ in rows}
    chosen: dict[str, float] = {}
    for piece in sorted((p for p in ratio if ratio[p] >= LEAST_RATIO), key=lambda p: (len(p), p)):
        shorter = next((piece[:n] for n in range(len(piece) - 1, 2, -1) if piece[:n] in chosen), None)
        if shorter is None:
            chosen[piece] = float(np.log(ratio[piece]))
        elif bad[piece] >= 0.9 * bad[shorter] and ratio[piece] >= 0.9 * ratio[shorter]:
            del chosen[shorter]
            chosen[piece] = float(np.log(ratio[piece]))
    most = sorted(chosen, key=lambda p: (-bad[p] * chosen[p], p))[:MOST_CANDIDATES]
    return {p: chosen[p] for p in most}


def _cover(weights: dict[str, float], held: list[list[str]], least: int) -> dict[str, float]:
    """Entries in turn by weight times newly explained documents; held: the entries in each toxic document."""
    where: dict[str, set[int]] = {}
    for i, entries in enumerate(held):
        for e in set(entries):
            where.setdefault(e, set()).add(i)
    kept: dict[str, float] = {}
    heap = [(-weights[e] * len(docs), e) for e, docs in where.items()]
    heapq.heapify(heap)
    explained: set[int] = set()
    while heap:
        promised, e = heapq.heappop(heap)
        new = len(where[e] - explained)
        if new < least:
            continue
        if -weights[e] * new > promised + 1e-9:
            heapq.heappush(heap, (-weights[e] * new, e))
            continue
        kept[e] = weights[e]
        explained |= where[e]
    sure = NEARLY * max(kept.values(), default=np.inf)
    return kept | {e: w for e, w in weights.items() if w >= sure}


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Coefficients of a lightly penalised logistic regression, by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    beta, penalty = np.zeros(x.shape[1]), np.diag([1e-4, 1e-2, 1e-2]) * weight.sum() / 100
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - penalty @ beta
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(bend + 1e-9 * np.eye(len(beta)), slope)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Lexicon:
    """The lexicon, its exceptions and the curve. What reaches the driver is bounded by the sample."""
    rows, shares = sample(docs, labels, per_class)
    if not shares:
        return Lexicon({})
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = counts.get(1, 0), sum(n for k, n in counts.items() if k != 1)
    often = _counted(rows, _candidates).filter(
        (F.col("bad") >= LEAST_DOCUMENTS) & (F.col("bad") + 0.5 >= (F.col("good") + 0.5) * LEAST_RATIO * (toxic + 1) / (clean + 1)))
    wide = Lexicon(_choose([tuple(r) for r in often.collect()], toxic, clean))

    def entries(batches):
        automaton = wide.automaton()
        for batch in batches:
            for part in slices(batch, "text"):
                found = [(fold(t), wide.matches(automaton, fold(t))) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([sorted({t[b:e] for b, e, _ in m}) for t, m in found], pa.list_(pa.string()))], ["entries"])

    held = rows.filter("toxic = 1").select("text").mapInArrow(entries, "entries array<string>")
    lexicon = Lexicon(_cover(wide.weights, [list(r["entries"]) for r in held.toLocalIterator()], LEAST_DOCUMENTS - 1))
    spared = _counted(rows, _around(lexicon)).filter(
        (F.col("good") >= 3) & ((F.col("bad") + 0.5) / (toxic + 1) < (F.col("good") + 0.5) / (clean + 1)))
    lexicon.exceptions = sorted(r["piece"] for r in spared.collect() if r["piece"] not in lexicon.weights)

    def measure(batches):
        automaton = lexicon.automaton()
        for batch in batches:
            x = np.array([lexicon.features(automaton, t) for t in batch.column("text").to_pylist()]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1]), batch.column("toxic")], ["total", "dense", "toxic"])

    seen = rows.mapInArrow(measure, "total double, dense double, toxic int").toPandas()
    y = (seen["toxic"] == 1).to_numpy(dtype=float)
    weight = np.where(y == 1, 1 / max(shares.get(1, 1), 1e-9), 1 / max(shares.get(0, 1), 1e-9))
    lexicon.curve = _logistic(seen[["total", "dense"]].to_numpy(dtype=float).reshape(-1, 2), y, weight) if len(seen) else lexicon.curve
    return lexicon


def score(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    def apply(batches):
        automaton = lexicon.automaton()
        for batch in batches:
            for part in slices(batch, "text"):
                x = np.array([lexicon.features(automaton, t) for t in part.column("text").to_pylist()]).reshape(-1, 2)
                p = lexicon.score(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", held_out().alias("held_out")).mapInArrow(
        apply, f"doc_id {kind}, held_out boolean, score double, predicted int")
