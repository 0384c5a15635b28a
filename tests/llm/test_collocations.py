"""Phrase mining on hard texts against counting every phrase, with slices of a few words and of many."""

import re
from collections import Counter

import pytest

from seqtables.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, least, longest, best, inside):
    counts, total = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            counts.update((lang, *w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    found = []
    for (lang, *w), a in counts.items():
        if len(w) < 2 or a < least:
            continue
        cut = lambda k: (counts[(lang, *w[:k])], counts[(lang, *w[k:])])
        score, _, (l, r) = min((2000000 * a // sum(cut(k)), k, cut(k)) for k in range(1, len(w)))
        found.append((lang, tuple(w), a, l, r, total[lang], score))
    large = [(lang, w, a) for lang, w, a, *_ in found]
    holds = lambda big, small: any(big[i:i + len(small)] == small for i in range(len(big) - len(small) + 1))
    kept = [f for f in found if not any(g[0] == f[0] and len(g[1]) > len(f[1]) and 100 * g[2] >= inside * f[2] and holds(g[1], f[1]) for g in large)]
    kept.sort(key=lambda f: (f[0], -f[6], -f[2], " ".join(f[1]).encode()))
    ranks, done = Counter(), []
    for lang, w, *rest in kept:
        ranks[lang] += 1
        if ranks[lang] <= best:
            done.append((lang, ranks[lang], " ".join(w), *rest))
    return sorted(done)


@pytest.mark.parametrize("slice_words, best", [(collocations.SLICE_WORDS, 2000), (50, 2000), (1, 5)])
def test_against_counting_every_phrase(spark, slice_words, best):
    base = ["The Quick, brown fox jumps over the lazy dog. the quick brown", "new york city hall\tnew york city\nnew york", "a a a a a", "", None,
            " . ,, \r\n", "x  \t y;z:x y!z x y", "Ünï ÜNÏ ünï ünï", "the the the quick the quick brown fox", "one"]
    rows = [(base[i % len(base)], ["en", "de", None, "und"][i // 3 % 4]) for i in range(90)] + [("w " * 3000, "en")]
    table = spark.createDataFrame([(i, *r, 1, "x", 0) for i, r in enumerate(rows)], "doc_id long, text string, lang string, f int, phrase string, slice int").repartition(3)
    got = sorted(tuple(r) for r in collocations.mine(table, 4, 4, best, 80, slice_words).collect())
    assert got == expected(rows, 4, 4, best, 80)
    assert got


def test_corpus_and_empty(docs, corpus_rows, empty):
    got = sorted(tuple(r) for r in collocations.mine(docs, 3, 4, 100).collect())
    assert got == expected([(r[1], r[2]) for r in corpus_rows], 3, 4, 100, 80)
    nothing = collocations.mine(empty)
    assert nothing.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and nothing.count() == 0
