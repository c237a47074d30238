"""Licence scan: a trained paragraph classifier confirmed by templates; DataFrame functions only."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.functions.steps import computed_once
from millrace.workspace import cut_lineage

# Short public notices of licence families.
NOTICES = [
    ("agpl", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("bsd", "Released under the BSD 3-Clause License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License."),
    ("lgpl", "Licensed under the GNU Lesser General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("reserved", "All rights reserved."),
]
STEMS = ["licens", "rights reserved", "permission is", "redistribution"]  # cheap marks of documents worth sampling
NONE = "none"
UNKNOWN = "unknown"
SAMPLE_DOCS = 1_000  # documents with a notice's word, and as many without, that the sample is drawn from
SAMPLE = 4_000  # paragraphs of the corpus the classifier is fitted on, half of them with a notice's word
VOCABULARY = 4_096
CONFIRMED = 0.8  # share of a template's word pairs that stand in the paragraph
LONGEST = max(len(text.split()) for _, text in NOTICES) + 8  # words; numbers and marks may split off
PRECISION = 0.99  # wanted of each family on the held-out part of the sample


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}.]+|\.(?!\p{N})"), lambda w: w != "")


def pairs(words: Column) -> Column:
    n = F.size(words) - 1
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1)))).otherwise(
        F.array().cast("array<string>"))


def grams(words: Column) -> Column:
    """Distinct words and word pairs."""
    return F.array_distinct(F.concat(words, pairs(words)))


def paragraphs(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, place, words) of each non-blank line."""
    lines = docs.select(F.col(key), F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), r"\R")).alias("place", "line"))
    return computed_once(lines, {"words": tokens(F.col("line"))}).select(key, "place", "words").where(F.size("words") > 0)


def notices(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame([(f, i, t) for i, (f, t) in enumerate(NOTICES)], "family string, notice int, text string")
    words = rows.select("family", "notice", tokens(F.col("text")).alias("words"))
    return words.withColumn("pairs", F.array_distinct(pairs(F.col("words"))))


def template_shares(word_pairs: Column, templates: list[tuple[str, list[str]]]) -> Column:
    """Per template, (share of its word pairs that stand in the paragraph, family, number of those pairs)."""
    listed = F.array(*[F.struct(F.lit(f).alias("family"), F.array(*[F.lit(p) for p in ps]).alias("pairs")) for f, ps in templates])
    held = lambda t: F.size(F.array_intersect(word_pairs, t["pairs"]))
    return F.transform(listed, lambda t: F.struct((held(t) / F.size(t["pairs"])).alias("share"), t["family"].alias("family"), held(t).alias("held")))


def telling(templates: list[tuple[str, list[str]]]) -> list[str]:
    """Words of which a text that confirms any template holds one.

    ``CONFIRMED`` lets some pairs of a template be missing; every word that is missing takes a pair at least.
    """
    out = set()
    for _, ps in templates:
        words = sorted({w for p in ps for w in p.split(" ")}, key=lambda w: (-len(w), w))
        out |= set(words[:int(len(ps) * (1 - CONFIRMED) + 1e-9) + 1])
    return sorted(out)


def passages(docs: DataFrame, templates: list[tuple[str, list[str]]], key: str, text: str) -> DataFrame:
    """(key, place, last, words) of notices that run over several lines: consecutive lines, joined, that confirm a template.

    A line without words is a border. From every line, windows of 1, 2, ... lines reach ``LONGEST`` words past that line
    or to the border. Of overlapping windows of a family the one with the most of a template's pairs stays, then
    the one with the fewest lines; those of one line are left to ``paragraphs``.
    """
    low, marks = F.lower(F.col(text)), telling(templates)
    has = F.lit(False)
    for w in marks:
        has = has | low.contains(w)
    whole = low.rlike(rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(map(re.escape, marks))})(?![\p{{L}}\p{{N}}])")
    held = docs.where(F.col(text).isNotNull() & has & whole).select(key, F.split(F.col(text), r"\R").alias("raw"))
    lines = computed_once(held, {"lines": F.transform("raw", tokens)}).drop("raw").where(F.size("lines") > 1)
    some = F.array(*[F.lit(w) for w in marks])
    lines = computed_once(lines, {"sizes": F.transform("lines", F.size), "told": F.transform("lines", lambda l: F.arrays_overlap(l, some))})
    nothing = F.struct(F.lit(0).alias("n"), F.lit(0).alias("more"), F.lit(True).alias("open"))

    def read(held: Column, size: Column) -> Column:
        still = held["open"] & (size > 0) & (held["n"] < LONGEST)
        return F.struct((held["n"] + size).alias("n"), (held["more"] + still.cast("int")).alias("more"), still.alias("open"))

    def ahead(i: Column) -> Column:
        more = F.aggregate(F.slice(F.col("sizes"), i + 2, LONGEST + 1), nothing, read)["more"]
        return F.struct(i.alias("place"), F.slice(F.col("lines"), i + 1, more + 1).alias("ahead"))

    # a window has LONGEST words before its last line, and none of its lines is blank
    near = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: F.exists(F.slice("told", i + 1, LONGEST + 1), lambda x: x))
    # words and pairs once a window: within a lambda they would be computed anew for each word and template
    starts = lines.select(key, F.explode(F.transform(near, ahead)).alias("x")).select(key, "x.place", "x.ahead").where(F.size(F.get("ahead", F.lit(0))) > 0)
    wide = computed_once(starts, {"words": F.flatten("ahead")}).where(F.arrays_overlap("words", some))
    wide = computed_once(wide, {"pairs": pairs(F.col("words"))}).where(F.exists(template_shares(F.col("pairs"), templates), lambda t: t["share"] >= CONFIRMED))
    each = wide.select(key, "place", "ahead", F.explode(F.sequence(F.lit(1), F.size("ahead"))).alias("n"))
    each = computed_once(each.withColumn("last", F.col("place") + F.col("n") - 1), {"words": F.flatten(F.slice("ahead", F.lit(1), F.col("n")))})
    shares = computed_once(each, {"pairs": pairs(F.col("words"))}).select(
        key, "place", "last", "n", "words", F.explode(template_shares(F.col("pairs"), templates)).alias("t")).where(F.col("t.share") >= CONFIRMED)
    found = cut_lineage(shares.groupBy(key, "place", "last", "n", F.col("t.family").alias("family")).agg(
        F.max("t.held").alias("held"), F.first("words").alias("words")))
    rank = F.struct("held", (-F.col("n")).alias("n"), "place")
    on = found.select(key, "family", "place", "last", rank.alias("rank"), F.explode(F.sequence("place", "last")).alias("line"))
    on = on.withColumn("top", F.max("rank").over(Window.partitionBy(key, "family", "line")))
    kept = on.groupBy(key, "family", "place", "last").agg(F.bool_and(F.col("rank") == F.col("top")).alias("kept")).where("kept and last > place")
    return found.join(kept.select(key, "place", "last").distinct(), [key, "place", "last"]).groupBy(key, "place", "last").agg(F.first("words").alias("words"))


@dataclass(frozen=True)
class Classifier:
    """The fitted counts of grams and regression, the grams with a weight, class names, intercepts and the least probability per class."""

    counted: CountVectorizerModel
    fitted: LogisticRegressionModel
    grams: list[str]
    classes: list[str]
    intercepts: list[float]
    least: list[float]
    words: list[str]
    templates: list[tuple[str, list[str]]]


def train(docs: DataFrame, key: str, text: str, sample: int = SAMPLE) -> Classifier:
    """Fit on at most ``sample`` paragraphs of the corpus and on rewritten notices.

    Corpus paragraphs come from ``SAMPLE_DOCS`` documents with a distinctive word of a notice and as many without,
    first by hash of the text; half of the paragraphs have such a word. They are labelled by template: whole notices by their family, those that share no more than a
    third of every notice as none; what lies between is left out. Every notice is added whole and with
    each of its words dropped, alone and with a paragraph before or after it. A fifth is held out to find the probability above which
    a family's predictions reach ``PRECISION``.
    """
    spark = docs.sparkSession
    known = notices(spark).collect()  # fixed and short
    templates = [(r["family"], r["pairs"]) for r in known]
    classes = [NONE, *sorted({f for f, _ in templates})]
    marks = sorted({w for r in known for w in r["words"] if len(w) > 5})
    low = F.lower(F.col(text))
    has = low.contains(STEMS[0])
    for stem in STEMS[1:]:
        has = has | low.contains(stem)
    kept = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("h"), F.coalesce(has, F.lit(False)).alias("has"))
    # two ordered takes keep the sample in each task; nothing else is shuffled
    some = [kept.where(F.col("has") == F.lit(x)).orderBy("h", "text").limit(SAMPLE_DOCS).select("h", "text") for x in (True, False)]
    lines = paragraphs(some[0].unionByName(some[1]), "h", "text").select("words").distinct().withColumn(
        "marked", F.arrays_overlap("words", F.array(*[F.lit(w) for w in marks])))
    picked = cut_lineage(lines.withColumn("h", F.xxhash64("words")).withColumn(
        "turn", F.row_number().over(Window.partitionBy("marked").orderBy("h", "words"))).where(F.col("turn") <= sample // 2).select("words", "h"))
    best = F.array_max(template_shares(pairs(F.col("words")), templates))
    labelled = picked.withColumn("best", best).withColumn("family", F.when(
        F.col("best.share") >= 0.99, F.col("best.family")).when(F.col("best.share") <= 1 / 3, F.lit(NONE))).where("family is not null").select("words", "family", "h")
    around = [r["words"] for r in labelled.where(F.col("family") == NONE).orderBy("h").limit(8).select("words").collect()]
    dropped = notices(spark).select("family", "words", F.explode(F.sequence(F.lit(0), F.size("words"))).alias("out")).select(
        "family", F.filter("words", lambda w, i: i != F.col("out")).alias("words")).where(F.size("words") > 1)
    others = F.array(*[F.array(*[F.lit(w) for w in ws]).cast("array<string>") for ws in [[], *around]])
    beside = dropped.select("family", "words", F.explode(others).alias("other"))
    rewritten = beside.select("family", F.explode(F.array(F.concat("words", "other"), F.concat("other", "words"))).alias("words"))
    rows = labelled.select("words", "family").unionByName(rewritten)
    numbers = F.create_map(*[x for i, c in enumerate(classes) for x in (F.lit(c), F.lit(float(i)))])
    data = cut_lineage(rows.select(
        grams(F.col("words")).alias("grams"), numbers[F.col("family")].alias("label"), (F.pmod(F.xxhash64("words"), F.lit(5)) == 0).alias("held")))
    counted = CountVectorizer(inputCol="grams", outputCol="features", vocabSize=VOCABULARY, minDF=2.0, binary=True).fit(data.where("not held"))
    shown = cut_lineage(counted.transform(data))
    fitted = LogisticRegression(family="multinomial", regParam=0.001, elasticNetParam=0.5, maxIter=30).fit(shown.where("not held"))
    matrix, intercepts = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray().tolist()
    # the label count is that of the largest label seen; classes without rows keep no weight
    kept = [(g, [float(x) for x in matrix[:, i]]) for i, g in enumerate(counted.vocabulary) if abs(matrix[:, i]).max() > 1e-6]
    useful = {g for g, w in kept if max(w[1:], default=0) > w[0]}
    # whoever holds a useful gram holds the rarer of its words
    rank = {g: i for i, g in enumerate(counted.vocabulary)}
    words = sorted({max(g.split(" "), key=lambda w: rank.get(w, len(rank))) for g in useful})
    checked = fitted.transform(shown.where("held")).select("label", "prediction", F.array_max(_vector(F.col("probability"))).alias("p")).groupBy(
        "prediction", F.floor(F.col("p") * 100).alias("p")).agg(F.count_if(F.col("label") == F.col("prediction")).alias("right"), F.count("*").alias("n")).collect()
    least = []
    for i in range(len(classes)):
        right = n = 0
        bound = 0.5
        for r in sorted((r for r in checked if r["prediction"] == i), key=lambda r: -r["p"]):
            right, n = right + r["right"], n + r["n"]
            if right < PRECISION * n:
                bound = min(0.99, (r["p"] + 1) / 100)
                break
        least.append(max(0.5, bound))
    return Classifier(counted, fitted, [g for g, _ in kept], classes[:len(intercepts)], intercepts, least, words, templates)


def _vector(column: Column) -> Column:
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(column)


def scan(docs: DataFrame, model: Classifier, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Licence of every document: (key, licence, families, n_paragraphs, n_unknown, score).

    Each line of the whole text is classified, and each passage of several lines that confirms a template (``passages``):
    a confirmed passage counts once, in place of its unknown lines and its lines of the same family. A line without any gram that speaks for a family is none without
    being scored, which is what its score would say. A line whose best class is a family is that
    family if its probability reaches the family's calibrated bound and a template of the family
    confirms it, else unknown. ``licence`` is the family of the confirmed line or passage with the highest
    probability (ties: first in order), ``unknown`` if there are only unknown lines, else ``none``;
    ``families`` lists the confirmed ones, ``score`` is the highest probability (none: 0).

    Null and blank texts: none. Equal keys are judged together, null ones among them, and repeated rows
    stay repeated. Other columns do not matter.
    """
    # In a struct a null key is equal to itself, in joins as in groups.
    own, name = key, "_own"
    docs, key = docs.select(F.struct(F.col(own).alias("id")).alias(name), F.col(text).alias("_text")), name
    text = "_text"
    some = F.arrays_overlap("words", F.array(*[F.lit(w) for w in model.words])) if model.words else F.lit(False)
    single = paragraphs(docs, key, text).where(some).select(key, "place", F.col("place").alias("last"), "words")
    lines = single.unionByName(passages(docs, model.templates, key, text).where(some)).withColumn("grams", grams(F.col("words")))
    n = len(model.classes)
    if max(range(n), key=lambda i: model.intercepts[i]) > 0:  # else a line without a weight is none
        lines = lines.where(F.arrays_overlap("grams", F.array(*[F.lit(g) for g in model.grams]).cast("array<string>")))
    # a line is scored where it is read, and only those that speak for a family are kept
    judged = model.fitted.transform(model.counted.transform(lines)).where("prediction > 0").select(
        key, "place", "last", "words", F.array_max(_vector(F.col("probability"))).alias("p"), F.col("prediction").cast("int").alias("i"))
    family = F.element_at(F.array(*[F.lit(c) for c in model.classes]), F.col("i") + 1)
    bound = F.element_at(F.array(*[F.lit(x) for x in model.least[:n]]), F.col("i") + 1)
    seen = judged.withColumn("family", family)
    shares = template_shares(F.col("pairs"), model.templates)
    confirmed = F.exists(shares, lambda t: (t["family"] == F.col("family")) & (t["share"] >= CONFIRMED))
    seen = computed_once(seen, {"pairs": pairs(F.col("words"))}).withColumn("sure", (F.col("p") >= bound) & confirmed)
    seen = cut_lineage(seen.select(key, "place", "last", "family", "p", "i", "sure").where("sure or last = place"))
    inside = seen.where("sure and last > place").select(key, "family", F.explode(F.sequence("place", "last")).alias("place")).groupBy(key, "place").agg(
        F.collect_set("family").alias("within"))
    seen = seen.join(inside, [key, "place"], "left").where(
        F.col("within").isNull() | (F.col("last") > F.col("place")) | (F.col("sure") & ~F.array_contains("within", F.col("family"))))
    order = F.struct(F.col("p"), (-F.col("i")).alias("i"), "family")
    found = seen.groupBy(key).agg(
        F.max(F.when(F.col("sure"), order)).alias("top"), F.array_sort(F.collect_set(F.when(F.col("sure"), F.col("family")))).alias("families"),
        F.count_if("sure").alias("n_paragraphs"), F.count_if(~F.col("sure")).alias("n_unknown"), F.max("p").alias("score"))
    return docs.select(key).join(found, key, "left").select(
        F.col(key)["id"].alias(own), F.coalesce("top.family", F.when(F.col("n_unknown") > 0, F.lit(UNKNOWN)), F.lit(NONE)).alias("licence"),
        F.coalesce(F.array_join("families", ","), F.lit("")).alias("families"), F.coalesce("n_paragraphs", F.lit(0)).cast("long").alias("n_paragraphs"),
        F.coalesce("n_unknown", F.lit(0)).cast("long").alias("n_unknown"), F.coalesce("score", F.lit(0.0)).alias("score"))
