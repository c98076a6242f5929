"""License scans by diagonal voting.

A template is a word sequence.  Every pair of neighbouring words of a text
that also stands in a template votes for a diagonal: the text position less
the template position.  A copy of the template puts its votes on one diagonal;
a copy with a word inserted or left out on neighbouring ones.  The steps, all
DataFrame functions (no Python runs on the executors):

    1. every text's rolling word pairs meet the template positions in a
       broadcast join by hash (equal hashes are verified by the words); the
       catalogue is a parameter and all that is broadcast;
    2. votes are aggregated by document, template and diagonal;
    3. neighbouring diagonals (at most a quarter of the template's words and
       MAX_GAP apart, so two copies never meet) are merged into one span;
    4. a span is verified: its distinct text and template positions against
       the longer of the template and the span.

A template of few words has no neighbouring diagonals: it is found where its
words stand consecutively, and nowhere else.

Memory: a task holds one text and its words.  Rows that leave a scan are one
head per document and its votes, so the shuffles carry no text.

Defined results: a NULL or empty text has no words and no spans; a NULL id
passes through; repeated rows give as many equal rows; an empty table gives no
rows; columns other than the id and the text are not read, whatever their
names.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 2
MAX_GAP = 4
MIN_SCORE = 0.7
COPIES_AT_ONCE = 10_000

# Phrases that say a license by themselves.
PHRASES = [
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
]

# Notices of common licenses.
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4.0 international license"),
    ("cc-by-nc", "licensed under cc by-nc 4.0"),
    ("cc-by-sa", "licensed under cc by-sa 4.0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v. 2.0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
CATALOGUE = PHRASES + NOTICES


def template_words(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))


def widest_gap(n_words: int) -> int:
    """How far apart neighbouring diagonals of a template may lie."""
    return min(MAX_GAP, n_words // 4) if n_words >= 8 else 0


def template_positions(spark: SparkSession, catalogue: Sequence[tuple[str, str]]) -> DataFrame:
    """(first, second, hash, template, at, label, total, gap): a row for each
    word pair of each template; ``total`` counts the template's pairs."""
    rows = [("", "", -1, 0, "", 1, 0)]   # every document's head
    for k, (label, text) in enumerate(catalogue):
        words = template_words(text)
        if len(words) < GRAM:
            raise ValueError(f"a template has {GRAM} words or more: {text!r}")
        rows += [(*words[i:i + GRAM], k, i, label, len(words) - GRAM + 1, widest_gap(len(words)))
                 for i in range(len(words) - GRAM + 1)]
    return spark.createDataFrame(
        rows, "first string, second string, template int, at int, label string, total int, gap int").withColumn(
        "hash", F.xxhash64("first", "second"))


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lower, NO_WORD, -1), "")


def votes(docs: DataFrame, catalogue: Sequence[tuple[str, str]], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, digest, n_words, template, label, total, gap, diagonal, at):
    the votes, and with template -1 one head row per document.  Rows of equal
    id and text are told apart by nothing and share a digest."""
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text.cast("string")).alias("digest"),
                       # Two empty words in front: the first pair is the head's.
                       F.concat(F.array(F.lit(""), F.lit("")), words_of(text)).alias("words"))
    # The last word has no successor: its pair holds a NULL and meets nothing.
    pairs = F.arrays_zip(F.col("words").alias("first"), F.slice("words", F.lit(2), F.size("words")).alias("second"))
    grams = rows.select("doc_id", "digest", (F.size("words") - 2).alias("n_words"), F.posexplode(pairs).alias("place", "pair")).select(
        "doc_id", "digest", "n_words", "place", "pair.*")
    known = F.broadcast(template_positions(docs.sparkSession, catalogue))   # the catalogue's size, whatever the corpus
    return grams.withColumn("hash", F.xxhash64("first", "second")).join(known, ["hash", "first", "second"]).select(
        "doc_id", "digest", "n_words", "template", "label", "total", "gap",
        (F.col("place") - 2 - F.col("at")).alias("diagonal"), "at")


def spans(voted: DataFrame) -> DataFrame:
    """(doc_id, digest, n_words, template, label, first_word, last_word,
    exact, score, copies): the merged diagonals of every document and template.
    Heads pass through; ``copies`` counts their rows."""
    doc = ["doc_id", "digest", "n_words"]
    lines = voted.groupBy(*doc, "template", "label", "total", "gap", "diagonal").agg(
        F.collect_set("at").alias("at"), F.count("*").alias("copies"))
    along = Window.partitionBy(*doc, "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along)
    chained = lines.withColumn("new", F.when(apart <= F.col("gap"), 0).otherwise(1)).withColumn(
        "chain", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    merged = chained.groupBy(*doc, "template", "label", "total", "chain").agg(
        F.max(F.size("at")).alias("best"), F.min(F.col("diagonal") + F.array_min("at")).alias("lo"),
        F.max(F.col("diagonal") + F.array_max("at")).alias("hi"), F.max("copies").alias("copies"),
        F.flatten(F.collect_list("at")).alias("at"),
        F.flatten(F.collect_list(F.expr("transform(at, x -> x + diagonal)"))).alias("place"))
    matched = F.least(F.size(F.array_distinct("at")), F.size(F.array_distinct("place")))
    score = F.greatest(F.col("best") / F.col("total"),
                       matched / F.greatest(F.col("total"), F.col("hi") - F.col("lo") + 1))
    return merged.select(*doc, "template", "label", F.col("lo").alias("first_word"), (F.col("hi") + GRAM - 1).alias("last_word"),
                         (F.col("best") == F.col("total")).alias("exact"), score.alias("score"), "copies")


def scan(docs: DataFrame, catalogue: Sequence[tuple[str, str]] = CATALOGUE, id_col: str = "doc_id",
         text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """(doc_id, n_words, spans, score), one row per row of ``docs``.

    ``spans`` lists the verified spans as (first_word, last_word, template,
    label, exact, score), in order; ``score`` is the best score of any span,
    verified or not (0 to 1; 0 where nothing voted).
    """
    head = F.col("template") < 0
    verified = ~head & (F.col("exact") | (F.col("score") >= min_score))
    span = F.struct("first_word", "last_word", "template", "label", "exact", "score")
    table = spans(votes(docs, catalogue, id_col, text_col)).groupBy("doc_id", "digest", "n_words").agg(
        F.max(F.when(head, F.col("copies"))).alias("copies"),
        F.array_sort(F.collect_list(F.when(verified, span))).alias("spans"),
        F.max(F.when(head, 0.0).otherwise(F.col("score"))).alias("score"))
    # Repeated rows come back, a bounded number at a time.
    at_once = F.lit(COPIES_AT_ONCE)
    blocks = table.withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / at_once))))
    return blocks.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(at_once, F.col("copies") - F.col("block") * at_once)))).select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), "spans", "score")


def label_list(found: Column) -> Column:
    """The distinct labels of spans, sorted, comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda s: s["label"]))), ",")


def digest(scanned: DataFrame, n_phrases: int = len(PHRASES)) -> DataFrame:
    """Counts and labels of ``scan``; its first ``n_phrases`` templates are
    phrases, which count where they stand word by word."""
    base = F.filter("spans", lambda s: (s["template"] < n_phrases) & s["exact"])
    starts = F.transform("base", lambda s: s["first_word"].cast("long"))
    return scanned.withColumn("base", base).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), label_list(F.col("base")).alias("base_labels"),
        label_list(F.col("spans")).alias("labels"), "score")


def oracle_sql(catalogue: Sequence[tuple[str, str]] = CATALOGUE, n_phrases: int = len(PHRASES)) -> str:
    """The same in DuckDB's SQL, by joins on the word pairs themselves."""
    rows = []
    for k, (label, text) in enumerate(catalogue):
        words = template_words(text)
        rows += [f"({k}, {i}, '{' '.join(words[i:i + GRAM])}', '{label}', {len(words) - GRAM + 1}, {widest_gap(len(words))})"
                 for i in range(len(words) - GRAM + 1)]
    return rf"""
WITH tpl(template, tpos, gram, label, total, gap) AS (VALUES {', '.join(rows)}),
src AS (SELECT row_number() OVER () AS k, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
words AS (SELECT k, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM src),
grams AS (SELECT a.k, a.pos, a.word || ' ' || b.word AS gram FROM words a JOIN words b ON a.k = b.k AND b.pos = a.pos + 1
  WHERE a.word IN (SELECT split_part(gram, ' ', 1) FROM tpl)),
line AS (SELECT DISTINCT k, template, label, total, gap, pos - tpos AS diagonal, tpos, pos FROM grams JOIN tpl USING (gram)),
voted AS (SELECT k, template, gap, diagonal, count(*) AS votes FROM line GROUP BY ALL),
diag AS (SELECT *, diagonal - lag(diagonal) OVER (PARTITION BY k, template ORDER BY diagonal) AS apart FROM voted),
chain AS (SELECT k, template, diagonal, votes, sum(CASE WHEN apart <= gap THEN 0 ELSE 1 END)
  OVER (PARTITION BY k, template ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS chain FROM diag),
span AS (SELECT k, template, label, total, chain, max(votes) AS best, min(pos) AS lo, max(pos) AS hi,
  least(count(DISTINCT tpos), count(DISTINCT pos)) AS matched FROM line JOIN chain USING (k, template, diagonal)
  GROUP BY k, template, label, total, chain),
scored AS (SELECT *, greatest(best::DOUBLE / total, matched::DOUBLE / greatest(total, hi - lo + 1)) AS s FROM span),
doc AS (SELECT k, count(*) FILTER (template < {n_phrases} AND best = total) AS n_base,
  min(lo) FILTER (template < {n_phrases} AND best = total) AS first_word,
  max(lo) FILTER (template < {n_phrases} AND best = total) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (template < {n_phrases} AND best = total) AS base_labels,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (best = total OR s >= {MIN_SCORE}) AS labels,
  max(s) AS score FROM scored GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0.0)::DOUBLE AS score
FROM src LEFT JOIN doc USING (k)"""
