"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from trackline.llm.spelling import spelling_forms, vocabulary

SCHEMA = "doc_id long, text string, word string"


def words_of(rows):
    total = Counter()
    for doc, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute(words):
    near = {w: [x for x in words if one_apart(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, words[w], len(near[w]), form[w], words[form[w]] if form[w] else None, root))
    return out


def corpus(rng):
    letters = "abcdeéÿÀ"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 10))) for _ in range(60)]
    base += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "abababab", "bababab", "z" * 3000, "z" * 2999 + "y", "ünïcödé×÷"]
    rows = []
    for d in range(400):
        out = []
        for _ in range(60):
            w = rng.choice(base[:10] if rng.random() < 0.5 else base)
            if rng.random() < 0.4:
                i, c = rng.randrange(len(w) + 1), rng.choice("abÀ")
                w = rng.choice([w[:i] + c + w[i:], w[:i] + c + w[i + 1:], w[:i] + w[i + 1:]])
            out.append(w.upper() if rng.random() < 0.1 and w.isascii() else w)
        rows.append((rng.randint(-5, 10 ** 6), rng.choice([" ", "-", "\n", "1"]).join(out)))
    return rows + [(None, "Nullid " * 9), (3, None), (4, ""), (5, "12 ! 日本語日本語")] + rows[:3]


@pytest.mark.parametrize("shard", [8_000, 20])
def test_against_all_pairs(spark, shard):
    rows = corpus(random.Random(shard))
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(4)
    words = vocabulary(df, planted=199)
    expected = words_of(rows)
    assert {r["word"]: r["n"] for r in words.collect()} == expected
    assert len(expected) > 300
    got = spelling_forms(words, shard=shard).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert {tuple(r) for r in got} == brute(expected) and len(got) == len(expected)


def test_no_words(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert spelling_forms(vocabulary(none)).collect() == []
    short = spark.createDataFrame([(1, "ab cd", "x")] * 9, SCHEMA)
    assert spelling_forms(vocabulary(short)).collect() == []
