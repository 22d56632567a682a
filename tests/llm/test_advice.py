"""Cases of the review's findings, each on its own."""

import re
import textwrap

import numpy as np
from pyspark.sql import functions as F

from trackline.llm import language
from trackline.llm.chat import END, START, format_chats
from trackline.llm.decontaminate import find_contamination
from trackline.llm.language import fit, identify
from trackline.llm.licenses import TEMPLATES, _lines, _scored, _training, own_lines, scan_licenses


def test_chat_end_alone_is_escaped(spark):
    texts = ["a<|im_end|>b", "a<|im_end|>", "<|im_end|>", "a<|im_end|>\nb", "<|im_end|", "plain"]
    rows = [(i, 0, "user", x) for i, x in enumerate(texts)] + [(90, 0, "us<|im_end|>er", "x")]
    out = {r["conv_id"]: r for r in format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    for i, _, role, text in rows:
        r = out[i]
        assert r["identical"] and [tuple(t) for t in r["parsed"]] == [(role, text)]
        assert r["escaped"] == (END in role + text)
        # the template's own control strings and no other
        assert re.findall("<\\|im_(?:start|end)\\|>", r["formatted"]) == [START, END]


def test_language_of_copies_keeps_its_sample(spark):
    """20,000 rows of five texts: shares by rows left all five out."""
    texts = ["zorv quint abbel zorvig", "quintel zorv marn", "abbel marn quintig zorv", "marnel abbelig quint", "zorvel quint marnig abbel"]
    copies = spark.range(20_000).select(F.lit("xx").alias("lang"), F.element_at(F.array(*map(F.lit, texts)), (F.col("id") % 5 + 1).cast("int")).alias("text"))
    other = spark.range(40).select(F.lit("en").alias("lang"), F.concat(F.lit("the house of the king and "), F.col("id"), F.lit(" men with them")).alias("text"))
    model = fit(copies.unionByName(other))
    assert set(model.langs) == {"en", "xx"}
    got = identify(spark.createDataFrame([(x,) for x in texts], "text string"), model).collect()
    assert all(r["lang_pred"] == "xx" and not r["rejected"] for r in got)


def test_language_frequencies_count_all_texts(spark):
    """3,000 of 10,000 texts hold a trigram: a sample's count differs from the whole count."""
    d = spark.range(10_000).select(F.lit("en").alias("lang"), F.concat(F.lit("the house "), F.when(F.col("id") < 3000, "qqq ").otherwise(""), F.col("id")).alias("text"))
    at = int(language.counts(np.frombuffer(b"qqq", np.uint8), np.array([0, 3])).argmax())
    assert abs(fit(d).idf[at] - (np.log(10_001 / 3001) + 1)) < 1e-5


def test_language_sample_is_bounded_and_of_different_texts(spark):
    one = spark.range(5000).select(F.lit("en").alias("lang"), F.lit("one text of all").alias("text"))
    few = spark.range(1500).select(F.lit("en").alias("lang"), F.concat(F.lit("other text "), F.col("id")).alias("text"))
    got = language._sample(one.unionByName(few)).agg(F.count("h"), F.count_distinct("text")).first()
    assert tuple(got) == (language.SAMPLE, language.SAMPLE)


def test_language_clusters_are_fitted_on_all_texts(spark):
    """Of 4,000 texts of a language a quarter was clustered: the centroids are
    the scaled sums of all texts nearest to them, and each text has one."""
    d = spark.range(4000).select(F.lit("en").alias("lang"), F.concat(F.lit("the house of "), F.conv(F.hash("id"), 10, 26)).alias("text"))
    d = d.select("lang", F.translate("text", "0123456789", "qrstuvwxyz").alias("text")).unionByName(
        spark.createDataFrame([("de", "das haus")], "lang string, text string")).cache()
    one = fit(d, usable=F.col("lang") == "de")
    assert one.langs.tolist() == ["de"]
    old, language.STEPS = language.STEPS, 1
    try:
        model = fit(d)
    finally:
        language.STEPS = old
    starts = language._sample(d).groupBy("lang").applyInPandas(language._starts(model.idf), "lang string, centroid binary").collect()
    starts = np.array([np.frombuffer(c, np.float32) for x, c in sorted((r["lang"], bytes(r["centroid"])) for r in starts) if x == "en"])
    x = language.vectors(language._text_counts([r["text"].encode() for r in d.where("lang = 'en'").collect()]), model.idf)
    near = (x @ starts.T).argmax(axis=1)
    sums = np.stack([x[near == k].sum(axis=0) for k in range(len(starts))])
    want = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    assert np.allclose(model.centroids[model.langs == "en"], want, atol=1e-5)
    floor = np.quantile((x @ want.T).max(axis=1), language.FLOOR_QUANTILE) * language.FLOOR_SHARE
    assert abs(model.floors[model.langs == "en"][0] - floor) < 1e-3


def test_decontamination_in_any_case_and_place(spark):
    anna = "Anna has 5 apples. Anna buys 3 more. How many does Anna have"
    mill = "Tell us how far Anna Lee walks in 12 km when she rests for 3 hours near the old mill by the river"
    mary = anna.replace("Anna", "Mary").replace("5", "8")
    text = {1: mill.lower(), 2: mill.upper(), 3: mill.title(), 4: anna.lower(), 5: "First this. " + mary + ", they ask.",
            6: "How Many Apples\n" + mary, 7: "so Red blue dog it is", 8: "red blue cat", 9: mary.replace("buys", "sells").replace("How many", "What"),
            10: anna.replace("Anna buys", "Mary buys")}
    bench = spark.createDataFrame([(20, mill), (21, anna), (22, "Red blue dog"), (None, "dog it"), (24, "is")], "item_id long, text string")
    d = spark.createDataFrame(list(text.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["item_ids"], r["kind"]) for r in find_contamination(d, bench).collect()}
    assert got == {1: ([20], "verbatim"), 2: ([20], "verbatim"), 3: ([20], "verbatim"), 4: ([21], "verbatim"), 5: ([21], "reparameterised"),
                   6: ([21], "reparameterised"), 7: ([None, 22], "verbatim"), 8: ([], None), 9: ([], None), 10: ([], None)}


def test_wrapped_licenses(spark):
    long = [(f, t) for f, group in TEMPLATES.items() for t in group if len(t) > 60]
    rows, want = [], {}
    for mark in ("", " * ", "# ", "// ", "dnl "):
        for width in (40, 60, 72):
            for f, t in long:
                lines = textwrap.wrap("Copyright 2020 the authors. " + t, width)
                want[len(rows)] = [f]
                rows.append((len(rows), "\n".join(["int first;", "", *(mark + x for x in lines), mark.rstrip(), "other words of a text"])))
    gpl = ["This program is free software: you can redistribute it and/or modify", "it under the terms of the GNU General Public License as published by",
           "the Free Software Foundation, either version 3 of the License, or", "(at your option) any later version."]
    bsd = ["Redistribution and use in source and binary forms, with or without", "modification, are permitted provided that the following conditions are met:"]
    mpl = ["This Source Code Form is subject to the terms of the Mozilla Public", "License, v. 2.0. If a copy of the MPL was not distributed with this file"]
    for text, f in (("\n".join(gpl), ["GPL-3.0"]), ("\n".join(bsd), ["BSD"]), ("\n".join(mpl), ["MPL-2.0"]), ("\n".join(bsd + ["filler"] * 12 + mpl), ["BSD", "MPL-2.0"]),
                    (bsd[0] + "\n\n" + bsd[1], []), ("Licensed under the MIT License.\nmore", ["MIT"])):
        want[len(rows)] = f
        rows.append((len(rows), text))
    got = {r["doc_id"]: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    bad = [(i, rows[i][1], got[i]["licenses"], f) for i, f in want.items() if got[i]["licenses"] != f or got[i]["n_license_paragraphs"] != len(f)]
    assert not bad


def test_licenses_of_any_wrapping_and_copies(spark):
    bsd = TEMPLATES["BSD"][1]
    two = TEMPLATES["MIT"][0] + "\n" + TEMPLATES["CC0"][1]
    text = {1: "\n".join(bsd.split()), 2: "\n".join("# " + w for w in bsd.split()), 3: two, 4: two, 5: "\n\n".join(bsd.split()), 6: None, 7: ""}
    d = spark.createDataFrame([(k, t, "x") for k, t in text.items()] + [(None, two, "x")], "doc_id long, text string, licenses string")
    got = scan_licenses(d)
    assert got.columns == ["doc_id", "text", "licenses", "n_license_paragraphs", "max_probability"]
    assert {r["doc_id"]: (r["licenses"], r["n_license_paragraphs"]) for r in got.collect()} == {
        1: (["BSD"], 1), 2: (["BSD"], 1), 3: (["CC0", "MIT"], 2), 4: (["CC0", "MIT"], 2), 5: ([], 0), 6: ([], 0), 7: ([], 0), None: (["CC0", "MIT"], 2)}
    assert scan_licenses(d.limit(0)).count() == 0


def test_licences_are_calibrated_by_all_lines(spark):
    """Some 20,000 different lines were taken, of as many different texts."""
    own = _scored(spark.range(60_000).select(F.split(F.concat(F.lit("under the w"), F.col("id").cast("string")), " ").alias("words")))
    rows = _training(spark, own, 80).where(F.size("words") == 3).where("words[2] like 'w%'")
    assert rows.agg(F.count(F.lit(1)), F.count_distinct("words"), F.count_if("held")).first() == (60_000, 60_000, 60_000)


def test_licences_in_long_runs_without_words(spark):
    text = "-\n" * 100_000 + TEMPLATES["MIT"][0] + "\nrem " * 20_000
    assert [r["licenses"] for r in scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()] == [["MIT"]]


def test_own_lines_are_those_with_a_bigram(spark):
    texts = ["Under  the\nunder\nthe", "xunder the", "under thex", "UNDER-THE\r\n\n# of. the #", "\u212aind of the", "\u0130s of\u0130the", "", None, "under\tthe\n" * 3, "\n\n--\nto the end"]
    t = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "k long, t string")
    want = _scored(_lines(t).select("words")).select("words", "f0", "f5").distinct()
    got = own_lines(t).select("words", "f0", "f5").distinct()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() >= 4
