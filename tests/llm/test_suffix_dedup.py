"""Suffix dedup against brute force over every byte string of the length."""

import hashlib
import random

from pyspark.sql import functions as F

from trackline.llm.queries import op1_suffix_dedup
from trackline.llm.suffix_dedup import suffix_dedup

SCHEMA = "doc_id long, text string, lang string, kept string"


def brute(rows, length):
    """rows: (id, text), ids unique. Bytes covered by a string that also starts earlier."""
    seen, out = {}, {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            else:
                seen[w] = (doc, p)
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc] = (len(kept), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def run(spark, rows, length=100):
    df = spark.createDataFrame([(d, t, "en", "x") for d, t in rows], SCHEMA).repartition(3)
    got = suffix_dedup(df, length=length).select(
        "doc_id", F.sha2("kept", 256).alias("h"), "n_removed", "n_spans").collect()
    return {r["doc_id"]: (r["n_removed"], r["n_spans"], r["h"]) for r in got}, len(got)


def check(spark, rows, length=100):
    want = {k: v[1:] for k, v in brute(rows, length).items()}
    got, n = run(spark, rows, length)
    assert n == len(rows)
    assert got == want


def test_random_corpora(spark):
    rng = random.Random(5)
    for trial in range(3):
        words = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6))) for _ in range(40)]
        pool = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 60))) for _ in range(12)]
        rows = []
        for i in range(60):
            parts = [rng.choice(pool) if rng.random() < 0.5 else " ".join(rng.choice(words) for _ in range(30))
                     for _ in range(rng.randint(0, 6))]
            rows.append((rng.randint(-5, 5) * 1000 + i, "\n".join(parts)))
        rows += [(90_000, None), (90_001, ""), (None, pool[0] * 3), (90_002, "x" * 700), (90_003, "x" * 99), (90_004, "ab" * 400)]
        check(spark, rows, 100 if trial else 40)


def test_hot_passage_and_long_text(spark):
    rng = random.Random(9)
    line = "".join(rng.choice("abcdefgh ") for _ in range(150))
    rows = [(i, ("".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 120))) + line
                 + "".join(rng.choice("abcdefgh ") for _ in range(50)))) for i in range(200)]
    rows.append((500, "Is onhe. " * 3000))
    rows.append((501, "".join(rng.choice("abcdefgh ") for _ in range(700_000)) + line))
    check(spark, rows)


def test_copies_ties_and_empty(spark):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdef ") for _ in range(400))
    df = spark.createDataFrame([(1, text, "en", "x"), (1, text, "en", "x"), (2, text, None, None), (2, text, "en", "x")], SCHEMA)
    rows = sorted((r["doc_id"], r["n_removed"]) for r in suffix_dedup(df).collect())
    assert rows == [(1, 0), (1, 0), (2, 400), (2, 400)]
    assert suffix_dedup(df.limit(0)).count() == 0


def test_repeated_ids_with_other_texts(spark):
    """Rows of one id are ties where they start alike: each loses what an
    earlier document holds, also where that is less than what they share."""
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    head, tails = word(400), [word(300) for _ in range(6)]
    rows = []
    for i in range(6):
        # the earlier document shares a part of the head, in other surroundings
        at = 20 + 25 * i
        rows += [(10 * i, word(50) + head[at:at + 130] + word(50)), *[(10 * i + 5, head + t) for t in tails[:i + 1]]]
    seen, want = {}, []
    for doc, text in sorted(rows):
        for p in range(len(text) - 99):
            seen[text[p:p + 100]] = min(seen.get(text[p:p + 100], (doc, p)), (doc, p))
    for doc, text in rows:
        gone = {q for p in range(len(text) - 99) if seen[text[p:p + 100]] < (doc, p) for q in range(p, p + 100)}
        want.append((doc, len(gone), hashlib.sha256("".join(c for q, c in enumerate(text) if q not in gone).encode()).hexdigest()))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffix_dedup(df).select("doc_id", "n_removed", F.sha2("kept", 256)).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_query_tells_the_size_of_the_whole_text(spark, tmp_path):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdé ") for _ in range(300))
    rows = [(1, text), (2, "x" + text), (3, None), (4, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in op1_suffix_dedup(spark, str(tmp_path)).collect()}
    n = len(text.encode())
    assert got == {1: (n, 0, 0), 2: (n + 1, n, 1), 3: (0, 0, 0), 4: (0, 0, 0)}
