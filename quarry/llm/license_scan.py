"""License scans by diagonal voting, in DataFrame functions alone.

Templates are phrases (which must stand whole) and passages (which may be altered).  All rolling word k-grams of all
documents are joined by hash with the k-grams of the templates; the join keeps pairs of equal words only.  A pair votes
for the diagonal ``place in the document - place in the template``.

* A phrase stands where a diagonal has all of its grams.
* For a passage, diagonals at most ``SLACK`` apart are merged (an inserted or dropped word moves the diagonal), and the
  span is verified: enough of the passage's grams, and enough of the span's grams, must have voted.

The templates' table follows the templates, not the data, and is broadcast within a checked number of rows.  A document's
grams are thinned by a table of bytes, sized by the templates' grams, before they are exploded and joined; exploded rows
carry the words of their gram alone.  Only votes are shuffled, by document.  A document's words, as an array, are the unit
of memory, and work is in proportion to them.

Defined cases: a null or empty text has no words and no spans; a text of any length is scanned whole.  Repeated rows are
scanned one by one.  Spans that begin together are in the order of their ends, then of their templates.  The result has
columns of its own, whatever other columns ``docs`` has.  An empty table gives an empty report.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C


class Template(NamedTuple):
    label: str
    text: str
    phrase: bool = False


# The phrases of the base, and wordings in which licenses are commonly granted.
PHRASES = (Template("mit", "mit license", True), Template("apache", "apache license", True), Template("gpl", "general public license", True))
PASSAGES = (
    Template("cc-by-nc", "licensed under cc by-nc 4.0"),
    Template("cc-by-sa", "licensed under cc by-sa 4.0"),
    Template("cc-by", "licensed under a creative commons attribution 4.0 international license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    Template("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
)

#: Words in a gram: of a phrase, of a passage.
PHRASE_GRAM, PASSAGE_GRAM = 2, 3
SLACK = 2
#: Least share of a passage's grams, and of a span's grams, that must have voted.
COVERAGE, DENSITY = 0.5, 0.5
BROADCAST_GRAMS = 200_000
#: Places of the thinning table for each template gram.
SPARSE = 32
SEPARATORS = C.WORD_CLASS.replace("[^", "[")


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased."""
    return F.filter(F.split(C.ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), lambda w: w != "")


def _starts(words: Column, k: int) -> Column:
    return F.when(F.size(words) >= k, F.sequence(F.lit(0), F.size(words) - k)).otherwise(F.array().cast("array<int>"))


def _gram(words: Column, i: Column, k: int) -> Column:
    """The hash of the run of k words from the i-th."""
    return F.xxhash64(F.lit(k), *(F.get(words, i + j) for j in range(k)))


def template_grams(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """``hash, template, t_pos, gram, k, n_grams`` of all templates."""
    rows = spark.createDataFrame([(i, t.text, PHRASE_GRAM if t.phrase else PASSAGE_GRAM) for i, t in enumerate(templates)], "template int, text string, k int")
    words = F.col("words")

    def hashes(k: int) -> Column:
        return F.transform(_starts(words, k), lambda i: _gram(words, i, k))

    grams = F.when(F.col("k") == PHRASE_GRAM, hashes(PHRASE_GRAM)).otherwise(hashes(PASSAGE_GRAM))
    each = rows.withColumn("words", words_of(F.col("text"))).withColumn("grams", grams)
    each = each.select("template", "k", "words", F.size("grams").alias("n_grams"), F.posexplode("grams").alias("t_pos", "hash"))
    return each.select("hash", "template", "t_pos", F.expr("slice(words, t_pos + 1, k)").alias("gram"), "k", "n_grams")


def _thinning(index: DataFrame, n: int) -> tuple[Column, int]:
    """A table of bytes and its length, at least ``SPARSE`` for each of the n template grams; the bytes at their hashes are 1."""
    places = max(64, 1 << (SPARSE * n - 1).bit_length())
    table = bytearray(places)
    for r in index.select(F.pmod("hash", F.lit(places)).alias("at")).distinct().collect():  # follows the templates, not the data
        table[r["at"]] = 1
    return F.lit(bytes(table)), places


def license_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Sequence[Template] = PHRASES + PASSAGES) -> DataFrame:
    """One row for each document row: its id, ``n_words`` and ``spans``, sorted: ``start, end`` (words from 0, end exclusive),
    ``template`` (index), ``label``, ``phrase``, ``coverage`` (share of the template's grams)."""
    spark = docs.sparkSession
    index = C.cut(template_grams(spark, templates))
    n_grams = index.count()
    table, places = _thinning(index, n_grams)
    words, n = F.col("words"), F.size("words")

    def met(k: int) -> Column:
        """Grams of k words that may be a template's, with their place and words."""
        kept = F.filter(_starts(words, k), lambda i: F.substr(table, (F.pmod(_gram(words, i, k), F.lit(places)) + 1).cast("int"), F.lit(1)) == F.lit(b"\x01"))
        return F.transform(kept, lambda i: F.struct(i.alias("pos"), F.lit(k).alias("its"), _gram(words, i, k).alias("hash"), F.slice(words, i + 1, k).alias("here")))

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("words"))
    # each document's own row has no place, and its number of words
    own = F.array(F.struct(F.lit(None).cast("int").alias("pos"), n.alias("its"), F.lit(None).cast("bigint").alias("hash"), F.lit(None).cast("array<string>").alias("here")))
    # explode_outer: for explode, the optimiser would compute the whole array once more, to test its size
    each = rows.select("rid", "id", F.explode_outer(F.concat(own, met(PHRASE_GRAM), met(PASSAGE_GRAM))).alias("g"))
    each = each.select("rid", "id", "g.pos", "g.its", "g.here", F.col("g.hash").alias("near"))
    index = C.bounded_broadcast(index, n_grams, BROADCAST_GRAMS)
    joined = each.join(index, (F.col("near") == F.col("hash")) & (F.col("its") == F.col("k")) & (F.col("here") == F.col("gram")), "left")
    own = F.col("pos").isNull()
    votes = joined.filter(own | F.col("template").isNotNull()).select(
        "rid",
        F.when(own, F.col("id")).alias("id"),
        F.coalesce("template", F.lit(-1)).alias("template"),
        F.coalesce("t_pos", F.lit(0)).alias("t_pos"),
        F.coalesce("n_grams", F.lit(0)).alias("n_grams"),
        F.coalesce("k", F.lit(0)).alias("k"),
        F.when(own, F.col("its")).otherwise(F.col("pos") - F.col("t_pos")).alias("diagonal"),
    )
    own = F.col("template") < 0

    by_diagonal = votes.groupBy("rid", "template", "diagonal", "n_grams", "k").agg(F.first("id", ignorenulls=True).alias("id"), F.count("*").alias("votes"), F.min("t_pos").alias("low"), F.max("t_pos").alias("high"))
    # spread by document once: all that follows keeps to it
    ordered = Window.partitionBy("rid", "template").orderBy("diagonal")
    names = F.array(*(F.lit(t.label) for t in templates))
    phrase = F.get(F.array(F.lit(True), *(F.lit(t.phrase) for t in templates)), F.col("template") + 1)
    apart = phrase | (F.col("diagonal") - F.lag("diagonal").over(ordered) > SLACK)
    runs = by_diagonal.repartition("rid").withColumn("opens", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("run", F.sum("opens").over(ordered))
    merged = runs.groupBy("rid", "template", "run", "n_grams", "k").agg(
        F.first("id", ignorenulls=True).alias("id"),
        F.sum("votes").alias("votes"),
        F.min(F.col("diagonal") + F.col("low")).alias("start"),
        F.max(F.col("diagonal") + F.col("high") + F.col("k")).alias("end"),
    )
    coverage = F.least(F.lit(1.0), F.col("votes") / F.col("n_grams"))
    density = F.col("votes") / (F.col("end") - F.col("start") - F.col("k") + 1)
    stands = F.when(phrase, F.col("votes") == F.col("n_grams")).otherwise((coverage >= COVERAGE) & (density >= DENSITY))
    span = F.when(~own & stands, F.struct(F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"), "template", F.get(names, F.col("template")).alias("label"), phrase.alias("phrase"), coverage.alias("coverage")))
    doc = F.when(own, F.struct("id", F.col("start").cast("bigint").alias("n_words")))
    by_doc = merged.groupBy("rid").agg(F.first(doc, ignorenulls=True).alias("doc"), F.array_sort(F.collect_list(span)).alias("spans"))
    return by_doc.select(F.col("doc.id").alias(id_col), "doc.n_words", "spans")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.filter("spans", lambda s: s["phrase"])
    starts = F.transform(base, lambda s: s["start"])

    def labels(spans: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    found = license_spans(C.table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["coverage"])), F.lit(0.0)).alias("score"),
    )


QUERIES = {"op4_license_scan": op4_license_scan}

ORACLE_SQL = {
    "op4_license_scan": """
    WITH t AS (
      SELECT template, label, phrase, k, w, len(w) - k + 1 AS n_grams FROM (
        SELECT template, label, phrase, CASE WHEN phrase THEN {k2} ELSE {k3} END AS k, {words} AS w FROM (VALUES {templates}) v(template, label, phrase, text))
    ), tg AS (SELECT template, k, i - 1 AS t_pos, array_to_string(w[i:i + k - 1], ' ') AS gram FROM t, unnest(range(1, n_grams + 1)) AS x(i)),
    d AS (SELECT doc_id, row_number() OVER () AS rid, {words} AS w FROM documents),
    dg AS (SELECT rid, k, i - 1 AS pos, array_to_string(w[i:i + k - 1], ' ') AS gram FROM d, (VALUES ({k2}), ({k3})) s(k), unnest(range(1, len(w) - k + 2)) AS x(i)),
    v AS (SELECT rid, template, dg.k, pos - t_pos AS diagonal, count(*) AS votes, min(pos) AS low, max(pos + dg.k) AS high
          FROM dg JOIN tg ON dg.gram = tg.gram AND dg.k = tg.k GROUP BY ALL),
    o AS (SELECT *, CASE WHEN k = {k2} OR coalesce(diagonal - lag(diagonal) OVER (PARTITION BY rid, template ORDER BY diagonal) > {slack}, true) THEN 1 ELSE 0 END AS opens FROM v),
    r AS (SELECT *, sum(opens) OVER (PARTITION BY rid, template ORDER BY diagonal) AS run FROM o),
    m AS (SELECT rid, template, run, sum(votes) AS votes, min(low) AS low, max(high) AS high FROM r GROUP BY ALL),
    s AS (SELECT rid, label, phrase, low, least(1.0, CAST(votes AS DOUBLE) / n_grams) AS coverage FROM m JOIN t USING (template)
          WHERE CASE WHEN phrase THEN votes = n_grams ELSE CAST(votes AS DOUBLE) / n_grams >= {coverage} AND CAST(votes AS DOUBLE) / (high - low - k + 1) >= {density} END),
    g AS (SELECT rid, count(*) FILTER (phrase) AS n_base, min(low) FILTER (phrase) AS first_word, max(low) FILTER (phrase) AS last_word,
          array_to_string(list_sort(list(DISTINCT label) FILTER (phrase)), ',') AS base_labels, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(coverage) AS score FROM s GROUP BY rid)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
      coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0.0) AS DOUBLE) AS score
    FROM d LEFT JOIN g USING (rid)
    """.replace("{words}", C.SQL_WORDS)
    .replace("{templates}", ", ".join(f"({i}, '{t.label}', {t.phrase}, '{t.text}')" for i, t in enumerate(PHRASES + PASSAGES)))
    .replace("{k2}", str(PHRASE_GRAM))
    .replace("{k3}", str(PASSAGE_GRAM))
    .replace("{slack}", str(SLACK))
    .replace("{coverage}", str(COVERAGE))
    .replace("{density}", str(DENSITY))
}
