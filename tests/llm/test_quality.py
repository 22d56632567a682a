"""Additive quality model: figures by a plain reading, accuracy on held-out rows."""

import random
import re

import numpy as np

from trackline.llm import quality as Q
from trackline.llm.queries import op11_quality

SCHEMA = "doc_id long, text string, c0 string, score string"


def plain(text):
    """Some figures of a text, read word by word."""
    b = text.encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", b)
    lines = [ln.strip(b" \t\x0b\x0c\r") for ln in b.split(b"\n")]
    lines = [ln for ln in lines if ln]
    n = max(len(words), 1)
    out = {"log_bytes": np.log1p(len(b)), "log_words": np.log1p(len(words)), "word_bytes": sum(map(len, words)) / n,
           "bars": b.count(b"|") / max(len(b), 1), "stops": sum(w[-1:] in (b".", b"!", b"?") for w in words) / n,
           "short_words": sum(len(w) <= 3 for w in words) / n, "line_words": len(words) / max(len(lines), 1),
           "repeated_lines": 1 - len(set(lines)) / len(lines) if lines else 0,
           "top_word": max((words.count(w) for w in set(words)), default=0) / n,
           "wordless": sum(not any(c >= 128 or chr(c).isalpha() for c in w) for w in words) / n}
    for k, name in ((1, "repeated_words"), (2, "repeated_pairs"), (4, "repeated_shingles")):
        grams = [tuple(words[i:i + k]) for i in range(len(words) - k + 1)]
        out[name] = 1 - len(set(grams)) / len(grams) if grams else 0
    return out


TEXTS = ["", "one", "A b c.\nA b c.\n\nd e f!", "x | y | z | x", "HELLO!! WORLD!! HELLO!! WORLD!!", "é ü ß 12 3.5 $$$", "\n \n", "a " * 5000, "Été. " * 3 + "\nfin"]


def test_figures():
    data = "".join(TEXTS).encode()
    offs = np.concatenate(([0], np.cumsum([len(t.encode()) for t in TEXTS])))
    got = Q.figures(np.frombuffer(data, np.uint8), offs)
    for row, text in zip(got, TEXTS, strict=True):
        for name, value in plain(text).items():
            assert abs(row[Q.FEATURES.index(name)] - value) < 1e-4, (text[:20], name)


def test_tables_learn_a_feature_and_a_pair():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 32, (4000, 5)).astype(np.uint8)
    y = ((x[:, 0] > 20) | ((x[:, 1] > 15) ^ (x[:, 2] > 15))).astype(float)
    start, main, pairs = Q.boost(x, y, np.ones(len(y)))
    z = start + sum(main[f][x[:, f]] for f in range(5)) + sum(t[x[:, a], x[:, b]] for (a, b), t in pairs.items())
    assert (1, 2) in pairs and ((z > 0) == (y > 0)).mean() > 0.97


def test_cases(spark):
    rng = random.Random(3)
    good = [(i, " ".join(rng.choice(["the", "house", "stands", "by", "a river", "quietly."]) for _ in range(40)), "g", "z") for i in range(60)]
    bad = [(100 + i, " | ".join("BUY!!" for _ in range(rng.randint(3, 30))), "b", "z") for i in range(40)]
    odd = [(200, None, None, None), (201, "", None, None), (202, "word " * 200_000, None, None), (None, "null id", None, None)]
    df = spark.createDataFrame(good + bad + odd + good[:2], SCHEMA)
    rows = Q.measured(df)
    assert rows.columns == ["doc_id", "c0", "score", "figures"]
    from pyspark.sql import functions as F
    learn = rows.where("c0 is not null").withColumn("label", F.when(F.col("c0") == "g", 1).otherwise(0))
    got = Q.score_quality(rows, Q.fit(learn)).collect()
    assert len(got) == 106 and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == (r["c0"] == "g") for r in got if r["c0"])
    one = Q.score_quality(rows, Q.fit(learn.where("label = 1"))).collect()
    assert all(r["score"] > 0.5 for r in one)
    none = Q.score_quality(rows, Q.fit(learn.withColumn("label", F.lit(None).cast("int")))).collect()
    assert all(r["score"] == 0.5 for r in none)
    assert Q.score_quality(Q.measured(df.limit(0)), Q.fit(learn)).count() == 0


def test_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = op11_quality(spark, sf).where("held_out")
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality is not null")
    rows = got.join(labels, "doc_id").select("score", "predicted", "quality").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == k] for k in (1, 0))
    wins = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert wins > 0.97, wins
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95
