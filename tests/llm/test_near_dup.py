"""Near-duplicate components against all pairs of whole shingle sets."""

import random
import re

from trackline.llm.near_dup import drop_near_duplicates, near_duplicates

SCHEMA = "doc_id long, text string, lang string, kept string"


def sets_of(text, words):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set())


def brute(rows, words, percent):
    sets = {d: sets_of(t, words) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(s), find(d), find(d) == d) for d, s in sets.items()}


def edited(rng, text, n):
    w = text.split(" ")
    for _ in range(n):
        w[rng.randrange(len(w))] = f"w{rng.randrange(10 ** 6)}"
    return " ".join(w)


def corpus(rng):
    rows = []
    for g in range(25):
        base = " ".join(f"t{rng.randrange(3000)}" for _ in range(rng.randint(1, 150)))
        for _ in range(rng.choice([1, 2, 5, 40 if g < 2 else 3])):
            text = edited(rng, base, rng.choice([0, 0, 1, 2, 3, 5, 8]))
            rows.append(text.upper() if rng.random() < 0.2 else text)
        chain = base
        for _ in range(4):
            chain = edited(rng, chain, 2)
            rows.append(chain)
    rng.shuffle(rows)
    out = [(rng.randint(-10, 10) * 10_000 + i, t) for i, t in enumerate(rows)]
    return out + [(700_000, None), (700_001, ""), (700_002, " \n\t"), (700_003, "one"), (700_004, "One"), (700_005, "one two"),
                  (700_006, "lang " * 30_000), (700_007, "lang " * 20_000)]


def test_against_brute_force(spark):
    for seed, words in ((1, 4), (2, 5)):
        rows = corpus(random.Random(seed))
        df = spark.createDataFrame([(d, t, "en", "x") for d, t in rows], SCHEMA).repartition(3)
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(df, words=words).collect()}
        assert got == brute(rows, words, 80)


def test_repeated_rows_null_ids_and_empty(spark):
    text = " ".join(f"a{i}" for i in range(50))
    df = spark.createDataFrame([(1, text, "en", "x"), (1, text, "en", "x"), (2, text, None, None), (None, text, "en", None)], SCHEMA)
    got = sorted(near_duplicates(df).collect(), key=str)
    assert [(r["doc_id"], r["component_id"], r["kept"]) for r in got] == [(1, 1, True), (1, 1, True), (2, 1, False), (None, None, True)]
    assert {r["n_shingles"] for r in got} == {46}
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns and kept.count() == 3
    assert near_duplicates(df.limit(0)).count() == 0
    alone = spark.createDataFrame([(1, "a b c d e f", "en", "x"), (2, "q r s t u v", "en", "x")], SCHEMA)
    assert near_duplicates(alone).where("kept").count() == 2
