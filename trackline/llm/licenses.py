"""Licence scans of paragraphs: a trained classifier, confirmed by templates.

Paragraphs are the lines of a text and, for notices that are wrapped, however
many lines they take, stretches of a block's words (a block ends at a line
without a letter or digit; comment marks are no words).  A stretch lies around a
word pair of a template: the template's length and a quarter of it, or once its
length, on both sides.  It counts only where none of its block's lines alone names the family, once a
block.  Features are the word unigrams and
bigrams (A-Z lower-cased runs of letters and digits) of a vocabulary taken
from the templates, as presence.  A multinomial logistic regression over the
licence families and an ``unknown`` class is trained on the templates and, as
``unknown``, parts of them.  It is calibrated by all of the corpus's own
different lines that have a vocabulary bigram but hold no half of a template: a
prediction counts only above the highest family probability that they reach (a
quantile), and at least at one half.  A counted prediction is confirmed when
the paragraph holds at least ``percent`` percent of the bigrams of one of
that family's templates, and no larger part of another family's.

Only texts that can hold a confirmed paragraph are split and scored: one with
``percent`` percent of a template's bigrams lacks fewer of them than
``_anchors`` lists, so it holds one of these.  That leaves results whole.  Each
different text (by 128 bits of hashes) that is left is scanned once.

Everything is DataFrame operations: SQL functions for the features, and the
DataFrame API of pyspark.ml for fitting and applying the regression.

Defined cases: null and empty texts hold no licence; repeated paragraphs
count each; several families in a text are all reported; rows with null ids
are scanned like others; an empty table gives an empty result; columns named
as a result are replaced.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.llm.common import cut, free_name, without

QUANTILE = 0.999
UNKNOWN = "unknown"
SALTS = 16
# fixed values: notices by which texts state their licence
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "You may not use this file except in compliance with the Apache License, Version 2.0"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it under the terms of the GNU General Public License version 3"],
    "GPL-2.0": ["This program is licensed under the GNU General Public License, version 2.",
                "you can redistribute it under the terms of the GNU General Public License version 2"],
    "LGPL": ["This library is licensed under the GNU Lesser General Public License.",
             "redistribute it under the terms of the GNU Lesser General Public License"],
    "BSD": ["Licensed under the BSD License.", "Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related rights to this work.",
            "Licensed under CC0 1.0 Universal."],
}


def _words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def _bigrams(text: str) -> list[str]:
    w = ["^", *_words(text)]
    return sorted({f"{a} {b}" for a, b in zip(w[1:], w[2:], strict=False)})


def _vocabulary() -> list[str]:
    texts = [t for group in TEMPLATES.values() for t in group]
    return sorted({w for t in texts for w in _words(t)}) + sorted({b for t in texts for b in _bigrams(t)})


def words_of(paragraph: Column) -> Column:
    """Words of a paragraph, as an array."""
    return F.filter(F.split(F.lower(paragraph), "[^a-z0-9]+"), lambda w: w != "")


def bigrams_of(words: Column) -> Column:
    return F.when(F.size(words) > 1, F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words)),
                                                lambda a, b: F.concat_ws(" ", a, b))).otherwise(F.array().cast("array<string>"))


def _share(bigrams: Column, template: str) -> Column:
    """Part of the template's bigrams that the paragraph holds."""
    wanted = _bigrams(template)
    return F.size(F.array_intersect(bigrams, F.array(*[F.lit(b) for b in wanted]))) / F.lit(len(wanted))


def _anchors(percent: int) -> dict[str, list[tuple[int, int]]]:
    """Word pairs of which a paragraph with ``percent`` percent of some
    template's bigrams holds one: of each template its longest pairs, one more
    than may be missing.  With each pair, for every template it is from, the
    words before it there and the template's words."""
    out: dict[str, list[tuple[int, int]]] = {}
    for t in [t for group in TEMPLATES.values() for t in group]:
        w, pairs = _words(t), _bigrams(t)
        allowed = len(pairs) - -(-len(pairs) * percent // 100)
        for pair in sorted(pairs, key=lambda p: (-len(p), p))[:allowed + 1]:
            out.setdefault(pair, []).extend((i, len(w)) for i in range(len(w) - 1) if f"{w[i]} {w[i + 1]}" == pair)
    return out


def _scored(p: DataFrame) -> DataFrame:
    """Paragraphs (as ``words``) that hold a vocabulary bigram, with
    ``bigrams`` and the best template share of each family (``f0``, ``f1``, ...)."""
    pairs = sorted({b for group in TEMPLATES.values() for t in group for b in _bigrams(t)})
    # a generator keeps the arrays from being computed again for each use
    p = p.withColumn("bigrams", F.explode(F.array(F.array_intersect(bigrams_of(F.col("words")), F.array(*[F.lit(b) for b in pairs])))))
    p = p.where(F.size("bigrams") > 0)
    shares = [F.greatest(*[_share(F.col("bigrams"), t) for t in group]) if len(group) > 1 else _share(F.col("bigrams"), group[0])
              for group in TEMPLATES.values()]
    return p.select("*", *[s.alias(f"f{i}") for i, s in enumerate(shares)])


def _lines(texts: DataFrame) -> DataFrame:
    """(k, b, block, words) of the lines of ``texts`` (k, t)."""
    blocks = texts.select("k", F.posexplode(F.split("t", "\\n(?:[^\\p{L}\\p{N}\\n]*+\\n)++")).alias("b", "block"))
    return blocks.select("k", "b", "block", F.explode(F.split("block", "\\n")).alias("paragraph")).select("k", "b", "block", words_of(F.col("paragraph")).alias("words"))


def holding(texts: DataFrame, percent: int) -> DataFrame:
    """Each different text of ``texts`` (k, t) that holds one of the word
    pairs of ``_anchors``, whatever stands between the two words."""
    # possessive here and below: other repeated groups overflow the stack on long runs
    plain = F.concat(F.lit(" "), F.regexp_replace(F.lower("t"), "(?:\\n[ \\t]*(?:dnl|rem)[ \\t]|[^a-z0-9])++", " "), F.lit(" "))
    p = texts.select("k", "t", F.explode(F.array(plain)).alias("plain"))
    some = reduce(lambda a, b: a | b, [F.contains("plain", F.lit(f" {pair} ")) for pair in sorted(_anchors(percent))])
    return p.where(some).groupBy("k").agg(F.first("t").alias("t"))


def candidates(texts: DataFrame, percent: int) -> DataFrame:
    """Lines and stretches of words (``wide``) that hold ``percent`` percent
    of a template, with the key ``k`` of their text and their block ``b``, as
    ``_scored`` describes them."""
    best = F.greatest(*[F.col(f"f{i}") for i in range(len(TEMPLATES))]) >= percent / 100
    lines = _lines(texts)
    single = _scored(lines.select("k", "b", F.lit(False).alias("wide"), "words")).where(best)
    anchors = _anchors(percent)
    places = F.create_map(*[c for pair, at in sorted(anchors.items()) for c in (
        F.lit(pair), F.array(*[F.struct(F.lit(q).alias("q"), F.lit(n).alias("n")) for q, n in sorted(set(at))]))])
    blocks = texts.select("k", F.posexplode(F.split("t", "\\n(?:[^\\p{L}\\p{N}\\n]*+\\n)++")).alias("b", "block")).where(F.contains("block", F.lit("\n")))
    words = words_of(F.regexp_replace("block", "(?mi)^[ \\t]*(?:dnl|rem)[ \\t]", " "))
    blocks = blocks.select("k", "b", F.explode(F.array(words)).alias("w")).where(F.size("w") > 1)
    at = blocks.select("k", "b", "w", F.posexplode(bigrams_of(F.col("w"))).alias("p", "pair"))
    at = at.where(F.col("pair").isin(sorted(anchors))).select("k", "b", "w", "p", F.explode(F.element_at(places, F.col("pair"))).alias("a"))
    # close around the notice, and with room for words put into it
    at = at.withColumn("slack", F.explode(F.array(F.floor(F.col("a.n") / 4).cast("int"), F.col("a.n"))))
    slack = F.col("slack")
    start = F.col("p") - F.col("a.q") - slack
    stretch = F.slice("w", F.greatest(F.lit(1), start + 1), F.col("a.n") + 2 * slack + F.least(F.lit(0), start))
    wide = _scored(at.select("k", "b", F.lit(True).alias("wide"), stretch.alias("words"))).where(best)
    return single.unionByName(wide)


def _any_of(pairs: list[str]) -> str:
    """Pattern of any of the word pairs, whatever stands between the words; what
    pairs begin with alike is tried once."""
    def alike(tails: list[str]) -> str:
        if tails == [""]:
            return "(?![a-z0-9])"
        heads = sorted({t[:1] for t in tails})
        ways = [("[^a-z0-9]+" if h == " " else h) + alike(sorted(t[1:] for t in tails if t[:1] == h)) if h else "(?![a-z0-9])" for h in heads]
        return ways[0] if len(ways) == 1 else "(?:" + "|".join(ways) + ")"
    return "(?<![a-z0-9])" + alike(sorted(set(pairs)))


def own_lines(texts: DataFrame) -> DataFrame:
    """All lines of ``texts`` (t) that hold a vocabulary bigram, as ``_scored``
    describes them."""
    pairs = sorted({b for group in TEMPLATES.values() for t in group for b in _bigrams(t)})
    lines = texts.select(F.explode(F.split(F.lower("t"), "\n")).alias("line"))
    return _scored(lines.where(F.col("line").rlike(_any_of(pairs))).select(words_of(F.col("line")).alias("words")))


def _training(spark: SparkSession, own: DataFrame, percent: int) -> DataFrame:
    """(words, bigrams, label, held) of templates and template parts, to learn
    from, and of the corpus's own different lines in ``own`` that hold no half
    of a template nor ``percent`` percent, held out to calibrate by."""
    families = list(TEMPLATES)
    rows = []
    for i, f in enumerate(families):
        for t in TEMPLATES[f]:
            w = _words(t)
            rows.append((t, float(i), 40))
            # parts of a notice that no longer say which licence it is
            rows += [(" ".join(w[:n]), float(len(families)), 1) for n in range(1, len(w) // 2)]
    fixed = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(t).alias("paragraph"), F.lit(y).alias("label"), F.lit(n).alias("n"))
                                                      for t, y, n in rows])).alias("r")).select("r.*")
    fixed = fixed.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n"))))
    fixed = fixed.withColumn("words", words_of(F.col("paragraph"))).withColumn("bigrams", bigrams_of(F.col("words")))
    best = F.greatest(*[F.col(f"f{i}") for i in range(len(families))])
    own = own.where(best < min(0.5, percent / 100)).withColumn("h", F.xxhash64("words")).dropDuplicates(["h"])
    own = own.select("words", "bigrams", F.lit(float(len(families))).alias("label"), F.lit(True).alias("held"))
    return fixed.select("words", "bigrams", "label", F.lit(False).alias("held")).unionByName(own)


def scan_licenses(docs: DataFrame, text_col: str = "text", percent: int = 80) -> DataFrame:
    """All columns of ``docs`` plus ``licenses`` (families, sorted),
    ``n_license_paragraphs`` and ``max_probability``."""
    docs = without(docs, "licenses", "n_license_paragraphs", "max_probability")
    spark = docs.sparkSession
    families = list(TEMPLATES)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    key = F.struct(F.xxhash64(text).alias("x"), F.xxhash64(F.lit(1), text).alias("y"))
    keyed = docs.select(key.alias("k"), text.alias("t"))
    found = cut(candidates(cut(holding(keyed, percent), "holding"), percent), "paragraphs")
    vocabulary = CountVectorizerModel.from_vocabulary(_vocabulary(), inputCol="grams", outputCol="features")
    vocabulary.setBinary(True)
    features = lambda d: vocabulary.transform(d.withColumn("grams", F.concat("words", "bigrams")))
    training = cut(_training(spark, own_lines(keyed), percent), "training")
    model = LogisticRegression(family="multinomial", maxIter=40, regParam=0.001).fit(features(training.where("not held")))
    # calibration: what the unknown class's held-out paragraphs reach for a family
    probs = vector_to_array("probability")
    known = F.array_max(F.slice(probs, 1, len(families)))
    held = model.transform(features(training.where("held")))
    level = held.agg(F.percentile_approx(known, QUANTILE, 10000)).first()[0]
    level = min(0.95, max(0.5, level or 0.0))

    scored = model.transform(features(found)).select(
        "k", "b", "wide", known.alias("p"), F.array_position(probs, F.array_max(probs)).cast("int").alias("best"),
        F.array(*[F.col(f"f{i}") for i in range(len(families))]).alias("shares"))
    ok = scored.where((F.col("best") <= len(families)) & (F.col("p") > level))
    own = F.element_at("shares", F.col("best"))
    ok = ok.where((own >= percent / 100) & (own >= F.array_max("shares")))
    names = F.array(*[F.lit(f) for f in families])
    # a block's lines, or a run of them where no line alone names the family
    per = ok.groupBy("k", "b", F.element_at(names, F.col("best")).alias("family")).agg(
        F.count_if(~F.col("wide")).alias("n"), F.max("p").alias("p"))
    per = per.groupBy("k").agg(F.sort_array(F.collect_set("family")).alias("licenses"), F.sum(F.greatest("n", F.lit(1))).alias("n_license_paragraphs"),
                               F.max("p").alias("max_probability"))
    # the key is a column of its own, so the join need not carry texts that the caller drops; a text
    # with very many copies is met in SALTS tasks
    per = per.withColumn("l_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed("k", "l_k")
    at, salt = free_name(docs, "text_key"), free_name(docs, "text_salt")
    out = docs.withColumn(at, key).withColumn(salt, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]), F.lit(SALTS)).cast("int"))
    out = out.join(per, (F.col(at) == F.col("l_k")) & (F.col(salt) == F.col("l_s")), "left")
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"),
                      F.coalesce("n_license_paragraphs", F.lit(0)).cast("long").alias("n_license_paragraphs"), "max_probability")
