"""Word models of toxicity against plain counting."""

import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from trackline.llm import toxicity


def _rows(n, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 3)))
    return [(" ".join(word() for _ in range(rng.randint(0, 60))) + (" The END of it" if i % 3 == 0 else ""), i % 4 == 0) for i in range(n)]


def test_terms_are_those_of_plain_counts(spark):
    """Words in bins and predecessors by 64 bits gave other terms; here every
    word has its own counts, and one word has over 700 different ones before it."""
    rows = _rows(300, 3) + [(f"w{i} common", i % 2 == 0) for i in range(700)]
    n, before = (Counter(), Counter()), defaultdict(set)
    for text, label in rows:
        ws = re.findall("[a-z0-9]+", text.lower())
        n[label].update(ws)
        for a, b in zip(ws, ws[1:], strict=False):
            before[b].add(a)
    every = set(n[0]) | set(n[1])
    total = sum(map(len, before.values())) + len(every) + 1
    rest = [toxicity.DISCOUNT * len(c) / sum(c.values()) for c in n]
    p = lambda c, w: max(n[c][w] - toxicity.DISCOUNT, 0) / sum(n[c].values()) + rest[c] * (len(before[w]) + 1) / total
    want = sorted(math.log(p(1, w)) - math.log(p(0, w)) for w in every)
    learn = spark.createDataFrame([(t.encode(), int(y)) for t, y in rows], "text binary, label int").repartition(4)
    terms, count, other = toxicity._word_terms(learn)
    got = sorted(r["term"] for r in terms.collect())
    assert count == len(every) == len(got) and len(before["common"]) == 700
    assert all(abs(a - b) < 1e-9 for a, b in zip(got, want, strict=True))
    assert abs(other - math.log(rest[1] / rest[0])) < 1e-9


def test_joined_terms_score_like_held_ones(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(_rows(120, 8))] + [(200, None), (201, ""), (202, "a a a b zz9"), (203, "a a a b zz9")],
                                 "doc_id long, text string")
    learn = spark.createDataFrame([(t, int(y), i % 8) for i, (t, y) in enumerate(_rows(400, 9))], "text string, label int, part int")
    held = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, learn).collect()}
    monkeypatch.setattr(toxicity, "TERM_BYTES", -1)
    joined = toxicity.score_toxicity(docs, learn).collect()
    assert len(joined) == 124 == len(held)
    for r in joined:
        assert abs(r["mean_term"] - held[r["doc_id"]]["mean_term"]) < 1e-6 and abs(r["score"] - held[r["doc_id"]]["score"]) < 1e-4
    assert toxicity.score_toxicity(docs.limit(0), learn.where(F.lit(False))).count() == 0
