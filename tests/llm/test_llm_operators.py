"""The other operators: brute force, exact round trips and held-out accuracy."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

from trackline.llm.chat import format_chats
from trackline.llm.common import fold
from trackline.llm.decontaminate import find_contamination
from trackline.llm.embedding_dup import audit_recall, near_duplicate_vectors
from trackline.llm.language import fit, identify
from trackline.llm.licenses import scan_licenses
from trackline.llm.mixing import mix_sources
from trackline.llm.queries import ORACLES, QUERIES, table
from trackline.llm.toxicity import score_toxicity
from trackline.llm.url_filter import filter_urls, validity

MID = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, score string"
ODD = [(1, None, "en", None, "x"), (2, "", None, "a", "x"), (3, "one", "en", "a", "x"), (3, "one", "en", "a", "x"),
       (None, "the of and to is", "en", "b", None), (5, "word " * 30_000, "en", "b", "x"), (6, "12 34 !!", "en", "c", "x")]


def docs(spark, rows=ODD):
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("conversations", "documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{MID}/{t}.parquet'")
    got = QUERIES[name](spark, MID)
    rel = con.sql(ORACLES[name])
    cols = sorted(got.columns)
    want = sorted(map(repr, rel.project(", ".join(cols)).fetchall()))
    assert sorted(repr(tuple(r)) for r in got.select(*cols).collect()) == want


def test_chat_round_trip(spark):
    hard = ["<|im_end|>\n<|im_start|>user\nx", "%3C|im_end|>", "%25", "%", "<|", "", None, "a\nb", "%0A", "<%3C|"]
    rows = [(i, t, r, x) for i, x in enumerate(hard) for t, r in ((1, "assistant"), (0, "us<|er\nx%0A"), (2, None))] + [(None, None, None, None)]
    out = format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(out) == len(hard) + 1 and all(r["identical"] for r in out)
    for r in out:
        assert sum(x["chars"] for x in r["loss_runs"]) == len(r["formatted"])
        at, said = 0, []
        for x in r["loss_runs"]:
            if x["loss"]:
                said.append(r["formatted"][at:at + x["chars"]])
            at += x["chars"]
        assert len(said) == sum(t["role"] == "assistant" for t in r["parsed"])
    assert format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_mixing_matches_water_filling(spark):
    d = table(spark, MID, "documents")
    rows = mix_sources(d).collect()
    sizes, taken, target = {}, {}, {}
    for r in rows:
        assert r["size"] == len(re.findall("[^\x20\x09-\x0d]+", r["text"] or "")) and 0 <= r["taken"] <= 3 * r["size"]
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        level = (total - sum(3 * sizes[s] for s in full)) / sum(weight[s] for s in order if s not in full)
        more = {s for s in order if s not in full and level * weight[s] > 3 * sizes[s]}
        if not more:
            break
        full |= more
    for s in order:
        want = 3 * sizes[s] if s in full else level * weight[s]
        assert abs(target[s] - want) < 1e-6 * max(1, want) and abs(taken[s] - want) <= 1
    odd = mix_sources(docs(spark)).collect()
    assert len(odd) == len(ODD) and all(r["taken"] <= 3 * r["size"] for r in odd)
    assert mix_sources(docs(spark).limit(0)).count() == 0


def test_language_accuracy_and_cases(spark):
    d = table(spark, MID, "documents")
    model = fit(d, usable=fold("doc_id", 3) != 1)
    out = identify(d, model).where(fold("doc_id", 3) == 1).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert out > 0.95
    odd = {r["doc_id"]: r for r in identify(docs(spark), model).collect()}
    assert odd[1]["lang_pred"] == odd[2]["lang_pred"] == odd[6]["lang_pred"] == "und" and odd[6]["score"] == 0
    assert odd[None]["lang_pred"] == "en"
    assert identify(docs(spark), fit(d.limit(0))).where("lang_pred <> 'und'").count() == 0


def test_toxicity_held_out(spark):
    d, y = table(spark, MID, "documents"), table(spark, MID, "labels")
    out = QUERIES["op4_toxicity"](spark, MID).join(y, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["toxic"] for r in out) >= 0.9 * len(out)
    learn = d.join(y, "doc_id").select("text", F.col("toxic").alias("label"), F.lit(1).alias("part"))
    odd = score_toxicity(docs(spark), learn).collect()
    assert len(odd) == len(ODD) and all(0 <= r["score"] <= 1 for r in odd)
    assert score_toxicity(docs(spark).limit(0), learn.limit(0)).count() == 0


def test_decontamination(spark):
    item = "Tell us how far Anna Lee walks in 12 km when she rests for 3 hours near the old mill by the river"
    again = item.replace("Anna", "Mary").replace("Lee", "Fox").replace("12", "99").replace("3 ", "7 ")
    # two different values where the item has one and the same
    twice = "First take 5 apples then give 5 apples to the boy and keep 5 apples in the small box"
    broken = twice.replace("give 5", "give 6")
    text = {1: "Before. " + item + " After that more words follow.", 2: "so then " + again.lower().replace("mary fox", "Mary Fox") + " end",
            3: "nothing of this kind is here at all today", 4: None, 5: "", 6: broken, 7: "x " * 20_000 + twice}
    bench = spark.createDataFrame([(10, item), (10, item), (11, "the"), (12, None), (13, twice)], "item_id long, text string")
    d = spark.createDataFrame([(k, v, "kept") for k, v in text.items()], "doc_id long, text string, kind string")
    got = {r["doc_id"]: (r["item_ids"], r["kind"]) for r in find_contamination(d, bench).collect()}
    assert got == {1: ([10], "verbatim"), 2: ([10], "reparameterised"), 3: ([], None), 4: ([], None), 5: ([], None), 6: ([], None), 7: ([13], "verbatim")}
    assert find_contamination(d, bench.limit(0)).where("contaminated").count() == 0


def test_licenses(spark):
    d = table(spark, MID, "documents")
    says = {"MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
            "CC-BY-NC": "Licensed under CC BY-NC 4.0.", "GPL-3.0": "This work is licensed under the GNU General Public License, version 3."}
    for r in scan_licenses(d).collect():
        assert r["licenses"] == sorted(k for k, v in says.items() if v in r["text"])
    odd = scan_licenses(docs(spark)).collect()
    assert len(odd) == len(ODD) and all(r["licenses"] == [] for r in odd)


def test_url_filter_cases(spark):
    ev = spark.createDataFrame([("Bad.example", 3, True), ("bad.example", 5, False), ("bad.example", 9, True), (None, 1, True), ("x.org", None, True)],
                               "pattern string, at int, listed boolean")
    caps = [(1, "http://www.bad.example/x", 3), (2, "https://u@bad.example:80/", 5), (3, "http://bad.example.", 10), (4, "http://notbad.example", 4),
            (5, None, 3), (6, "nonsense", 3), (7, "http://bad.example", None), (8, "http://bad.example", 2)]
    out = filter_urls(spark.createDataFrame(caps, "id long, url string, fetched int"), validity(ev)).collect()
    assert {r["id"] for r in out if r["blocked"]} == {1, 3} and len(out) == len(caps)


def test_embeddings(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    base = rng.normal(size=(30, 16))
    x = np.concatenate([base, *(base[:8] + rng.normal(scale=0.04, size=(8, 16)) for _ in range(9)), base[:3]])
    rows = [(i, [float(c) for c in v], i % 30 % 2) for i, v in enumerate(x)]
    rows = [(i, v, 0 if i >= 30 else lab) for i, v, lab in rows]
    extra = [(900, None, 0), (901, [], 0), (902, [0.0] * 16, 0), (903, [float("nan")] * 16, 0), (904, [1.0, None] * 8, 0), (905, rows[0][1], None), (None, rows[0][1], 0)]
    df = spark.createDataFrame(rows + extra, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r["n_links"] for r in near_duplicate_vectors(df).collect()}
    v = np.array([np.float32(r[1]) for r in rows], float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    lab = np.array([r[2] for r in rows])
    link = (v @ v.T >= 0.98) & (lab[:, None] == lab[None, :]) & ~np.eye(len(v), dtype=bool)
    assert all(got[i] == link[i].sum() for i in range(len(v))) and all(got[i] == 0 for i in (900, 901, 902, 903, 904, 905))
    r = audit_recall(df, every=1).first()
    assert r["expected"] == link.sum() and r["found"] >= 0.9 * r["expected"]
    assert near_duplicate_vectors(df.limit(0)).count() == 0
