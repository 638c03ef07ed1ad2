"""Licence paragraphs by a sparse word-pair logistic regression, confirmed against the templates of the predicted family.

The model is a multinomial regression over the templates' word pairs with one class for everything
else. A pair outside that vocabulary has no weight, so scoring joins the pairs of a paragraph to a
small table of weights and adds up what it finds: the corpus moves only its hits.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tiffinlake.session import materialize

from .support import bounded_sample

UNKNOWN = "unknown"
# Notices of well-known licences, by family.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "This project is released under the Apache License 2.0."],
    "bsd": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation."],
    "lgpl": ["This library is licensed under the GNU Lesser General Public License, version 2.1."],
    "mit": [
        "Released under the MIT License.",
        "This software is distributed under the terms of the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "public-domain": ["This work is released into the public domain.", "To the extent possible under law, the author has waived all copyright under CC0 1.0."],
    "rights-reserved": ["All rights reserved.", "Copyright (c) 2020 the authors. All rights reserved."],
}
# Share of a template's word pairs that confirms its family.
CONFIRM = 0.6
# Other paragraphs to learn from, at most, and the share of those kept for calibration that may pass for a licence.
SAMPLE_DOCS, SAMPLE_PARAGRAPHS, FALSE_SHARE = 1500, 6000, 0.001
LEAST_PROBABILITY = 0.5
# A paragraph no text holds, so that every document keeps a row.
MARK = "\x02"
# Before a pair of the last word of a line and the first of the next.
BREAK = "\x03"
# Lines over which a notice may be wrapped.
RUN_LINES = 8


def words(paragraph: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(paragraph), r"[^\p{L}\p{N}.+-]+|[.]+(?=\s|$)", " "))
    return F.filter(F.split(plain, " +"), lambda w: w != "")


def pairs(paragraph: Column) -> Column:
    """Distinct neighbouring words of a paragraph, its ends included."""
    return _neighbours(words(paragraph))


def _neighbours(words: Column) -> Column:
    framed = F.concat(F.array(F.lit("^")), words, F.array(F.lit("$")))
    return F.array_distinct(F.zip_with(framed, F.slice(framed, 2, F.size(framed)), lambda a, b: F.concat(a, F.lit(" "), b)))


def template_table(spark: SparkSession) -> DataFrame:
    rows = [(family, i, text) for i, (family, text) in enumerate((f, t) for f, texts in TEMPLATES.items() for t in texts)]
    return spark.createDataFrame(rows, "family string, template int, text string")


def fit(docs: DataFrame, text_col: str = "text", key_col: str = "doc_id", seed: int = 6) -> dict:
    """Weights of the templates' word pairs for each family and for none, and the least probability to believe.

    Licence paragraphs to learn from are the templates and their windows of words, alone and between
    other words; the others are paragraphs of a bounded sample of the texts that hold less than half
    of any template. A quarter of these calibrates: the least probability is such that the given
    share of them would pass. Without texts the least probability is the default.
    """
    spark = docs.sparkSession
    notices = template_table(spark)
    vocabulary = sorted(r[0] for r in notices.select(F.explode(F.filter(pairs(F.col("text")), lambda g: g.isNotNull()))).distinct().collect())
    sized = notices.withColumn("w", F.split("text", " ")).withColumn("n", F.size("w"))
    windows = (sized.withColumn("size", F.explode(F.array(*[F.greatest(F.lit(3), F.ceil(F.col("n") * s).cast("int")) for s in (0.6, 0.8, 1.0)])))
               .withColumn("at", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("n") - F.col("size") + 1))))
               .withColumn("part", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ")))
    framed = windows.select("family", F.explode(F.array(F.col("part"), F.concat(F.lit("zzz "), "part", F.lit(" zzz")))).alias("paragraph"))
    whole = notices.select("family", F.explode(F.array_repeat(F.col("text"), 8)).alias("paragraph"))
    texts = docs.select(F.col(key_col).alias("key"), F.col(text_col).alias("text"), F.lit(0).alias("all")).where("text is not null")
    others = (bounded_sample(texts, "all", "key", SAMPLE_DOCS, seed)
              .select(F.explode(F.split("text", "\n")).alias("paragraph")).where("length(paragraph) > 0").distinct()
              .orderBy(F.xxhash64(F.lit(seed), "paragraph")).limit(SAMPLE_PARAGRAPHS))
    has = [F.size(F.array_intersect("grams", F.array(*[F.lit(g) for g in grams]))) / F.lit(float(len(grams))) for _, grams in _grams_of(notices)]
    others = materialize(others.withColumn("grams", pairs(F.col("paragraph"))).where(F.greatest(*has) < 0.5)
                         .select(F.lit(UNKNOWN).alias("family"), "grams", (F.pmod(F.xxhash64(F.lit(seed + 1), "paragraph"), F.lit(4)) == 0).alias("held")), "others")
    licences = whole.unionByName(framed).select("family", pairs(F.col("paragraph")).alias("grams"), F.lit(False).alias("held"))
    families = [UNKNOWN, *TEMPLATES]
    number = F.create_map(*[x for i, f in enumerate(families) for x in (F.lit(f), F.lit(float(i)))])
    rows = licences.unionByName(others).withColumn("grams", F.filter("grams", lambda g: g.isNotNull())).withColumn("label", number[F.col("family")])
    count = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features", minTF=None)
    ready = materialize(count.transform(rows).select("label", "features", "held"), "ready")
    model = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=60).fit(ready.where("not held").coalesce(2))
    weights, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    from pyspark.ml.functions import vector_to_array

    held = model.transform(ready.where("held")).select(F.array_max(F.slice(vector_to_array("probability"), 2, len(families))).alias("p"))
    least = held.agg(F.percentile_approx("p", 1 - FALSE_SHARE, 10_000)).first()[0]
    return {"families": families, "vocabulary": vocabulary, "weights": weights, "bias": bias, "least": max(LEAST_PROBABILITY, least or 0.0)}


def _grams_of(notices: DataFrame) -> list[tuple[int, list[str]]]:
    """Word pairs of each template, by number (a fixed small list)."""
    rows = notices.select("template", F.filter(pairs(F.col("text")), lambda g: g.isNotNull()).alias("g")).orderBy("template").collect()
    return [(r["template"], r["g"]) for r in rows]


def paragraphs(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Paragraphs with at least one known word pair: ``doc_id``, ``paragraph``, ``lines``, ``family``, ``probability``, ``overlap``, ``confirmed``.

    A paragraph is a line, named by its number, or a run of up to ``RUN_LINES`` lines, named by its first, over which
    a notice is wrapped; of runs only the confirmed ones are listed. They may overlap. A line without
    words inside a run costs it the pair that it breaks.

    Every document also has a row for paragraph -1, which holds nothing. ``family`` is the likeliest
    class, ``unknown`` below the least probability. It is confirmed if the paragraph holds enough of
    the word pairs of one of the family's templates. A line without known pairs is unknown and
    not listed.
    """
    spark = docs.sparkSession
    families, vocabulary = model["families"], model["vocabulary"]
    grams = _grams_of(template_table(spark))
    classes = [f"c{i}" for i in range(len(families))]
    marks = [f"t{i}" for i, _ in grams]
    table = [(g, i, *map(float, model["weights"][:, i]), *[int(g in own) for _, own in grams]) for i, g in enumerate(vocabulary)]
    nothing = [*[0.0] * len(classes), *[0] * len(marks)]
    named = ", ".join(["gram string", "pair int", *[f"{c} double" for c in classes], *[f"{m} int" for m in marks]])
    # A pair over a line's end says nothing of the line: its weights are zero there.
    known = spark.createDataFrame([*table, *[(BREAK + g, i, *nothing) for i, g in enumerate(vocabulary)], (MARK, None, *nothing)], named)
    lines = F.concat(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), F.array(F.lit(MARK)))
    # Numbered before the lines are unfolded: all lines of a row share its number.
    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), lines.alias("lines"))
    rows = rows.select("doc_id", "row", F.transform("lines", lambda x: F.when(x == MARK, F.array(F.lit(MARK))).otherwise(words(x))).alias("lines"))
    paired = F.zip_with("lines", F.slice("lines", 2, F.size("lines")), lambda a, b: F.when(F.get(a, F.lit(0)) == MARK, a).otherwise(
        F.concat(_neighbours(a), _over(a, b))))
    rows = rows.select("doc_id", "row", F.posexplode(paired).alias("at", "grams"))
    hits = (rows.select("doc_id", "row", F.when(F.get("grams", F.lit(0)) == MARK, -1).otherwise(F.col("at")).alias("paragraph"),
                        F.explode("grams").alias("gram"))
            .join(F.broadcast(known), "gram"))  # the templates' word pairs: a fixed list
    # What a line gives to a run: its inner pairs, and at the run's ends or breaks those of its own.
    first, last, over = F.col("gram").startswith("^ "), F.col("gram").endswith(" $"), F.col("gram").startswith(BREAK)
    sums = hits.groupBy("row", "paragraph").agg(
        F.first("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in [*classes, *marks]],
        F.collect_set(F.when(~first & ~last & ~over, F.col("pair"))).alias("inner"), F.max(F.when(first, F.col("pair"))).alias("first"),
        F.max(F.when(last, F.col("pair"))).alias("last"), F.collect_set(F.when(over, F.col("pair"))).alias("over"))
    # Stored: the lines are read twice, for themselves and for the runs.
    judged = materialize(_judge(sums, model, grams, classes, marks).drop(*classes, *marks, "logits"), "lines")
    given = judged.where("paragraph >= 0").select(
        "doc_id", "row", F.explode(F.array(F.floor(F.col("paragraph") / RUN_LINES), F.floor(F.col("paragraph") / RUN_LINES) - 1)).alias("block"),
        F.struct(F.col("paragraph").alias("at"), "inner", "first", "last", "over").alias("line"))
    # A block and the next hold every run that begins in the block; few hold enough of any template.
    near = given.groupBy("row", "block").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list("line")).alias("near")).where("size(near) > 1")
    place = {g: i for i, g in enumerate(vocabulary)}
    held = F.flatten(F.transform("near", lambda x: F.concat(x["inner"], x["over"], F.array(x["first"], x["last"]))))
    near = near.withColumn("held", F.array_distinct(held)).where(F.greatest(*[
        F.size(F.array_intersect("held", F.array(*[F.lit(place[g]) for g in own]))) / F.lit(float(len(own))) for _, own in grams]) >= CONFIRM)
    begun = near.select("doc_id", "row", "block", "near", F.explode("near").alias("from")).where(F.floor(F.col("from.at") / RUN_LINES) == F.col("block"))
    ended = begun.select("doc_id", "row", "near", "from", F.explode(F.filter("near", lambda x: (x["at"] > F.col("from.at")) & (x["at"] < F.col("from.at") + RUN_LINES))).alias("to"))
    inside = F.filter("near", lambda x: (x["at"] >= F.col("from.at")) & (x["at"] <= F.col("to.at")))
    runs = ended.select("doc_id", "row", "from", "to", inside.alias("inside")).select(
        "doc_id", "row", F.col("from.at").alias("paragraph"), (F.col("to.at") - F.col("from.at") + 1).alias("lines"),
        F.explode(F.array_distinct(F.concat(F.flatten("inside.inner"), F.array("from.first", "to.last"),
                                            F.flatten(F.transform(F.filter("inside", lambda x: x["at"] < F.col("to.at")), lambda x: x["over"]))))).alias("pair"))
    weighed = spark.createDataFrame(table, named).drop("gram")
    totals = (runs.join(F.broadcast(weighed), "pair").groupBy("row", "paragraph", "lines")
              .agg(F.first("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in [*classes, *marks]]))
    wrapped = _judge(totals, model, grams, classes, marks).where("confirmed")
    names = ["doc_id", "row", "paragraph", "lines", "family", "probability", "overlap", "confirmed"]
    return judged.withColumn("lines", F.lit(1)).select(names).unionByName(wrapped.select(names))


def _over(a: Column, b: Column) -> Column:
    """Pairs over the end of a line ``a`` and the beginning of the next, marked; a word broken at its hyphen is one word."""
    last, first = F.get(a, F.size(a) - 1), F.get(b, F.lit(0))
    broken = F.concat(last, first)
    over = lambda x, y: F.concat(F.lit(BREAK), x, F.lit(" "), y)
    return F.when(last.endswith("-"), F.array(over(F.get(a, F.size(a) - 2), broken), over(broken, F.get(b, F.lit(1))))).otherwise(
        F.array(over(last, first)))


def _judge(sums: DataFrame, model: dict, grams: list[tuple[int, list[str]]], classes: list[str], marks: list[str]) -> DataFrame:
    """``family``, ``probability``, ``overlap`` and ``confirmed`` from the summed weights and template pairs."""
    families = model["families"]
    # Columns of their own, as the code made for one expression of all of it grows too long to compile.
    sums = (sums.withColumn("logits", F.array(*[F.col(c) + F.lit(float(b)) for c, b in zip(classes, model["bias"])]))
            .withColumn("top", F.array_max("logits"))
            .withColumn("likeliest", F.get(F.array(*[F.lit(f) for f in families]), (F.array_position("logits", F.col("top")) - 1).cast("int"))))
    total = F.aggregate("logits", F.lit(0.0), lambda done, x: done + F.exp(x - F.col("top")))
    family_of = [f for f, texts in TEMPLATES.items() for _ in texts]
    overlap = F.greatest(F.lit(0.0), *[F.when(F.col("likeliest") == family, F.col(mark) / F.lit(float(len(own)))).otherwise(0.0)
                                       for mark, (_, own), family in zip(marks, grams, family_of)])
    judged = sums.withColumn("probability", F.lit(1.0) / total).withColumn("overlap", overlap)
    family = F.when((F.col("likeliest") != UNKNOWN) & (F.col("probability") >= model["least"]), F.col("likeliest")).otherwise(UNKNOWN)
    return judged.withColumn("family", family).withColumn("confirmed", (F.col("family") != UNKNOWN) & (F.col("overlap") >= CONFIRM))


def _apart(spans: Column, like: str) -> Column:
    """The spans that overlap no better one, in their order: the most of a template first, then the fewest lines."""
    meets = lambda x: lambda y: (x["at"] < y["at"] + y["lines"]) & (y["at"] < x["at"] + x["lines"])
    return F.aggregate(spans, F.array().cast(like), lambda done, x: F.when(F.exists(done, meets(x)), done).otherwise(F.concat(done, F.array(x))))


def scan(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its confirmed licence families in order, how many paragraphs, and the surest one.

    Of overlapping paragraphs of one family the one with the most of a template counts, so a wrapped notice counts once.
    A document without a confirmed paragraph has an empty list, 0 and nulls. Null and empty texts
    have none; null ids and repeated rows keep a row each; other columns are not read.
    """
    found = paragraphs(docs, model, id_col, text_col)
    fields = {"missing": -F.col("overlap"), "lines": F.col("lines"), "at": F.col("paragraph"), "probability": F.col("probability")}
    like = "array<struct<missing: double, lines: int, at: int, probability: double>>"
    span = F.when(F.col("confirmed"), F.struct(*[c.cast("double" if n in ("missing", "probability") else "int").alias(n) for n, c in fields.items()]))
    by_family = (found.groupBy("row", F.when(F.col("confirmed"), F.col("family")).alias("family"))
                 .agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(span)).alias("spans")).withColumn("spans", _apart(F.col("spans"), like)))
    sure = F.array_max(F.transform("spans", lambda x: F.struct(
        x["probability"].alias("probability"), (-x["missing"]).alias("overlap"), (-x["at"]).alias("p"), F.col("family").alias("family"))))
    by_doc = by_family.withColumn("best", sure).groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_set("family")).alias("families"),
        F.sum(F.size("spans")).alias("n_licence_paragraphs"), F.max("best").alias("best"))
    return by_doc.select("doc_id", "families", "n_licence_paragraphs", F.col("best.family").alias("surest_family"),
                         F.col("best.probability").alias("probability"), F.col("best.overlap").alias("overlap"), (-F.col("best.p")).alias("paragraph"))
