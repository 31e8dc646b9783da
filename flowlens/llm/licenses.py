"""License phrases and notices by diagonal voting.

Every pair of neighbouring words of every document is hashed and joined to the places of that pair in the
templates. A hit at word p of the text and word q of a template votes for the diagonal p - q, the place
where the template would begin. A phrase stands where all its pairs vote for one diagonal. A notice may have
words put in or left out, so neighbouring diagonals are merged; it stands where the merged diagonals hold
``COVERAGE`` of its pairs within at most twice its length. Hits are verified by comparing the words themselves.

The template table is a fixed list and is broadcast; the pairs of all texts stream through the join and only
hits are kept, with one row per document for its number of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowlens.llm import words as W
from flowlens.llm.queries import query, table
from flowlens.workspace import materialize

GRAM = 2
COVERAGE = 0.6
#: Diagonals of one notice lie at most so many words apart.
DRIFT = 3

# Phrases and their labels, then notices that the licenses themselves prescribe.
PHRASES = [
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
]
NOTICES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("this work is licensed under a creative commons attribution", "cc-by"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]
#: Pairs of these words alone are no evidence for a notice.
COMMON = set("a and any at in into is it of or that the this to under with".split())


def template_rows() -> list[tuple]:
    """(hash, gram, template, label, phrase or notice, place, pairs of the template, words of the template)."""
    found = []
    for number, (text, label) in enumerate(PHRASES + NOTICES):
        words = text.encode().split()
        phrase = number < len(PHRASES)
        hashes = W.join_hashes(np.array([W.hash_of(w) for w in words], dtype=np.uint64), GRAM).view(np.int64)
        places = [i for i in range(len(hashes)) if phrase or not {w.decode() for w in words[i : i + GRAM]} <= COMMON]
        for i in places:
            gram = b" ".join(words[i : i + GRAM]).decode()
            found.append((int(hashes[i]), gram, number, label, phrase, i, len(places), len(words)))
    return found


TEMPLATE_SCHEMA = "hash long, wanted string, template int, label string, phrase boolean, place int, pairs int, length int"


def grams(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text_no``, ``at``, ``hash``, ``gram`` of all word pairs, and a row with ``n_words`` for every text.

    The words themselves are given only for pairs whose hash ends like that of a template's pair.
    """
    ends = np.zeros(1 << 16, dtype=bool)
    ends[[row[0] & 0xFFFF for row in template_rows()]] = True
    names = ["doc_id", "text_no", "at", "hash", "gram", "n_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = W.Powers()
        for batch in batches:
            ids, numbers = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            whole, bounds = W.text_bytes(batch.column(2))
            for low, high in W.runs(bounds):
                data = W.LOWER[whole[bounds[low] : bounds[high]]]
                offsets = bounds[low : high + 1] - bounds[low]
                starts, ends_at, owner = W.word_bounds(data, offsets, W.ALPHANUMERIC)
                count = np.bincount(owner, minlength=high - low)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[low:high]), pa.array(numbers[low:high]), *(pa.nulls(high - low, t) for t in (pa.int64(), pa.int64(), pa.string())), pa.array(count)],
                    names,
                )
                if len(starts) < GRAM:
                    continue
                hashes = W.join_hashes(W.span_hashes(data, starts, ends_at, powers), GRAM)
                at = np.flatnonzero(owner[: 1 - GRAM] == owner[GRAM - 1 :])
                hashes, owned = hashes[at], owner[at]
                text = np.full(len(at), None, dtype=object)
                for i in np.flatnonzero(ends[(hashes & np.uint64(0xFFFF)).astype(np.int64)]):
                    words = range(at[i], at[i] + GRAM)
                    text[i] = b" ".join(data[starts[w] : ends_at[w]].tobytes() for w in words).decode()
                first = np.searchsorted(owner, owned)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[low + owned]), pa.array(numbers[low + owned]), pa.array(at - first), pa.array(hashes.view(np.int64)), pa.array(text, pa.string()), pa.nulls(len(at), pa.int64())],
                    names,
                )

    text_no = F.monotonically_increasing_id().alias("text_no")
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), text_no, F.col(text_col).cast("string"))
    return rows.mapInArrow(run, "doc_id long, text_no long, at long, hash long, gram string, n_words long")


def votes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verified hits, and the rows with ``n_words``."""
    templates = F.broadcast(docs.sparkSession.createDataFrame(template_rows(), TEMPLATE_SCHEMA))
    joined = grams(docs, id_col, text_col).join(templates, "hash", "left")
    return joined.where("n_words IS NOT NULL OR gram = wanted")


def spans(hits: DataFrame) -> DataFrame:
    """``doc_id``, ``label``, ``phrase``, ``first``, ``last`` (words), ``share`` of the template, ``stands`` or not.

    Phrases: one row per diagonal. Notices: of each run of diagonals with gaps of at most ``DRIFT``, the window of
    less than twice the notice's words that holds most of it, the first of equals. So words in front or
    behind that repeat parts of the notice don't hide it.
    """
    text, key = ["doc_id", "text_no", "template"], ["doc_id", "text_no", "template", "label", "phrase", "pairs", "length"]
    diagonal = (
        hits.where("template IS NOT NULL")
        .withColumn("diagonal", F.col("at") - F.col("place"))
        .groupBy(*key, "diagonal")
        .agg(F.collect_set("place").alias("places"), F.min("at").alias("first"), (F.max("at") + GRAM - 1).alias("last"))
    )
    along = Window.partitionBy(*text).orderBy("diagonal")
    starts = F.col("phrase") | (F.col("diagonal") - F.lag("diagonal", 1, -(2**40)).over(along) > DRIFT)
    runs = diagonal.withColumn("starts", starts.cast("int")).withColumn("run", F.sum("starts").over(along))
    # a diagonal is no longer than its template, so that a window holds a bounded number of them
    ahead = Window.partitionBy(*text, "run").orderBy("first").rangeBetween(0, 2 * max(row[-1] for row in template_rows()))
    near = F.filter(
        F.collect_list(F.struct("last", "places")).over(ahead), lambda x: x["last"] - F.col("first") < 2 * F.col("length")
    )
    windows = runs.withColumn("near", near).select(
        *key, "run", "first",
        F.size(F.array_distinct(F.flatten(F.transform("near", lambda x: x["places"])))).alias("held"),
        F.array_max(F.transform("near", lambda x: x["last"])).alias("last"),
    )
    best = F.max(F.struct("held", (-F.col("first")).alias("back"), "last")).alias("best")
    merged = windows.groupBy(*key, "run").agg(best)
    share = F.col("best.held") / F.col("pairs")
    whole = F.when(F.col("phrase"), share == 1).otherwise(share >= COVERAGE)
    return merged.select(
        "doc_id", "label", "phrase", (-F.col("best.back")).alias("first"), F.col("best.last").alias("last"),
        share.alias("share"), whole.alias("stands"),
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document with its words, phrases, labels and ``score``, the largest share of a template.

    A null or empty text has no words and no labels, and score 0. Rows that repeat an id are one document: their
    words and places add up, and no template is put together from several rows; rows without an id are left out; an empty table gives no rows; further
    columns are ignored.
    """
    hits = materialize(votes(docs, id_col, text_col), "license-hits")
    words = hits.where("n_words IS NOT NULL").groupBy("doc_id").agg(F.sum("n_words").alias("n_words"))
    base = F.col("phrase") & F.col("stands")
    labels = lambda c: F.array_join(F.sort_array(F.collect_set(F.when(c, F.col("label")))), ",")
    found = spans(hits).groupBy("doc_id").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("stands")).alias("labels"),
        F.max("share").alias("score"),
    )
    none = {"n_base": 0, "base_labels": "", "labels": "", "score": 0.0}
    return words.join(found, "doc_id", "left").fillna(none)


def sql() -> str:
    """The whole scan for DuckDB, with the pairs themselves in place of their hashes."""
    rows = ", ".join(
        f"('{gram}', {number}, '{label}', {phrase}, {place}, {pairs}, {length})"
        for _, gram, number, label, phrase, place, pairs, length in template_rows()
    )
    return rf"""
WITH templates(gram, template, label, phrase, place, pairs, length) AS (VALUES {rows}),
texts AS (
  SELECT doc_id, row_number() OVER () AS text_no, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), grams AS (
  SELECT doc_id, text_no, i - 1 AS pos, words[i] || ' ' || words[i + 1] AS gram
  FROM (SELECT doc_id, text_no, words, unnest(range(1, len(words))) AS i FROM texts) t
), diagonals AS (
  SELECT doc_id, text_no, template, label, phrase, pairs, length, pos - place AS diagonal, list(DISTINCT place) AS places,
         min(pos) AS first, max(pos) + 1 AS last
  FROM grams JOIN templates USING (gram) GROUP BY ALL
), marked AS (
  SELECT *, CASE WHEN phrase OR diagonal - lag(diagonal, 1, -1000000000) OVER w > {DRIFT} THEN 1 ELSE 0 END AS starts
  FROM diagonals WINDOW w AS (PARTITION BY text_no, template ORDER BY diagonal)
), runs AS (
  SELECT *, sum(starts) OVER (PARTITION BY text_no, template ORDER BY diagonal) AS run FROM marked
), windows AS (
  SELECT a.doc_id, a.text_no, a.template, a.label, a.phrase, a.pairs, a.run, a.diagonal, a.first,
         len(list_distinct(flatten(list(b.places)))) AS held
  FROM runs a JOIN runs b ON a.text_no = b.text_no AND a.template = b.template AND a.run = b.run
   AND b.first >= a.first AND b.last - a.first < 2 * a.length
  GROUP BY a.doc_id, a.text_no, a.template, a.label, a.phrase, a.pairs, a.run, a.diagonal, a.first
), spans AS (
  SELECT doc_id, label, phrase, arg_max(first, held * 1000000000 - first) AS first, max(held) / CAST(pairs AS DOUBLE) AS share,
         CASE WHEN phrase THEN max(held) = pairs
              ELSE max(held) / CAST(pairs AS DOUBLE) >= CAST({COVERAGE} AS DOUBLE) END AS stands
  FROM windows GROUP BY doc_id, text_no, template, label, phrase, pairs, run
), found AS (
  SELECT doc_id, count(*) FILTER (phrase AND stands) AS n_base, min(first) FILTER (phrase AND stands) AS first_word,
         max(first) FILTER (phrase AND stands) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase AND stands) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (stands) AS labels, max(share) AS score
  FROM spans GROUP BY doc_id
)
SELECT doc_id, n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM (SELECT doc_id, CAST(sum(len(words)) AS BIGINT) AS n_words FROM texts WHERE doc_id IS NOT NULL GROUP BY doc_id) counted LEFT JOIN found USING (doc_id)
"""


@query("op2_license_scan", sql())
def op2_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return scan(table(spark, sf, "documents"))
