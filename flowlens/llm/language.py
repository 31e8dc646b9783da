"""The language of a text by Bayesian fusion of evidence.

* Text: letter trigrams in hashed buckets, one multinomial per language, fitted on about
  ``TRAINING_DOCS`` labelled rows of each language (those with a small hash of their id: a documented bound for
  fitting only). Every label with ``LABELLED_ROWS`` rows in the whole table is a language. Trigrams are not
  independent, so n of them count as n / (1 + n / ``SATURATION``). A uniform model stands for "none of these".
* Declared language (of the markup) and address suffix: how often each language, as the text alone has
  it, comes with each value, from grouped counts over all rows.
* Host: shares of the languages on the host, smoothed towards those of its domain, and these towards the
  whole table's. All are grouped counts over all rows.

Counts are combined before the shuffle; the tables of hosts and declared values are joined as tables of any
size. The scores of all rows are written once to the shared folder.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm import words as W
from flowlens.llm.queries import query, table
from flowlens.workspace import materialize

#: Documents of each language; a label with fewer has all of them.
TRAINING_DOCS = 8000
#: A label needs so many rows in the table to be a language.
LABELLED_ROWS = 3
BUCKET_BITS = 16
SATURATION = 100.0
#: Pseudo-rows from the level above, for hosts and domains, and of each value for declared languages and suffixes.
PRIOR_ROWS, VALUE_ROWS = 20.0, 1.0
#: Share of trigrams that may be of no language (names, codes, junk), so that these alone reject no text.
STRANGE = 0.5
#: Prior share of "none of these", and the least posterior of an accepted language.
NONE_PRIOR, ACCEPTED = 0.01, 0.5
NONE = "und"
LN_BUCKETS = BUCKET_BITS * math.log(2)

#: Letters, lower-cased where ASCII; every other byte is a blank.
LETTERS = np.where(W.ALPHANUMERIC, W.LOWER, 0x20).astype(np.uint8)
LETTERS[0x30:0x3A] = 0x20


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all trigrams that hold a letter and lie in one text, and the number of each one's text."""
    own = LETTERS[data].astype(np.uint32)
    if len(own) < 3:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    a, b, c = own[:-2], own[1:-1], own[2:]
    mixed = (a | (b << np.uint32(8)) | (c << np.uint32(16))) * np.uint32(0x9E3779B1)
    keep = b != 0x20
    for shift in (1, 2):  # trigrams that reach into the next text
        border = offsets[1:-1] - shift
        keep[border[(border >= 0) & (border < len(keep))]] = False
    at = np.flatnonzero(keep)
    return (mixed[at] >> np.uint32(32 - BUCKET_BITS)).astype(np.int64), np.searchsorted(offsets, at, "right") - 1


def _rows(batches: Iterator[pa.RecordBatch], column: int):
    """Runs of rows: (batch, first row, their bytes and offsets)."""
    for batch in batches:
        data, offsets = W.text_bytes(batch.column(column))
        for low, high in W.runs(offsets):
            yield batch, low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]


def fit(docs: DataFrame, id_col: str, text_col: str, label_col: str) -> tuple[list[str], np.ndarray]:
    """Languages, and the log probability of each bucket (rows) in each language (columns)."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(label_col).alias("label")
    )
    rows = rows.where("label IS NOT NULL AND id IS NOT NULL")
    labels = rows.groupBy("label").agg(F.count("*").alias("n"), F.approx_count_distinct("id").alias("ids"))  # a row per label
    labels = labels.where(F.col("n") >= LABELLED_ROWS).select("label", (TRAINING_DOCS / F.col("ids")).alias("share"))
    place = F.shiftrightunsigned(F.xxhash64("id"), 11) / float(1 << 53)  # from 0 to 1
    sample = rows.join(F.broadcast(labels), "label").where(place < F.col("share")).select("label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = np.array(batch.column(0).to_pylist(), dtype=object)
            for label in sorted(set(labels)):
                part = batch.filter(pa.array(labels == label))
                total = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
                for _, _, _, data, offsets in _rows(iter([part]), 1):
                    total += np.bincount(trigrams(data, offsets)[0], minlength=1 << BUCKET_BITS)
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label] * (len(at) + 1)), pa.array(np.append(at, -1)), pa.array(np.append(total[at], part.num_rows))],
                    ["label", "bucket", "n"],
                )

    counts = sample.mapInArrow(run, "label string, bucket long, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    found = counts.toPandas()  # at most labels x buckets
    languages = sorted(found[found.bucket < 0].label)
    total = np.zeros((1 << BUCKET_BITS, len(languages)))
    for j, language in enumerate(languages):
        own = found[(found.label == language) & (found.bucket >= 0)]
        total[own.bucket.to_numpy(), j] = own.n.to_numpy()
    total += 0.1
    shares = (1 - STRANGE) * total / total.sum(axis=0) + STRANGE / (1 << BUCKET_BITS)
    return languages, np.log(shares).astype(np.float32)


def text_scores(rows: DataFrame, model: np.ndarray) -> DataFrame:
    """Adds ``n`` (trigrams) and ``scores`` (evidence of each language over "none of these") for ``text``, which goes."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in rows.schema if f.name != "text"]
    at = rows.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch, low, high, data, offsets in _rows(batches, at):
            buckets, owner = trigrams(data, offsets)
            n = np.bincount(owner, minlength=high - low)
            total = np.zeros((high - low, model.shape[1]))
            for j in range(model.shape[1]):
                total[:, j] = np.bincount(owner, model[:, j][buckets], minlength=high - low)
            weight = 1 / np.maximum(1, n) * (n / (1 + n / SATURATION))
            total = (total + (n * LN_BUCKETS)[:, None]) * weight[:, None]
            part = batch.slice(low, high - low)
            scores = pa.ListArray.from_arrays(
                pa.array(np.arange(high - low + 1, dtype=np.int32) * model.shape[1]), pa.array(total.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [*(c for i, c in enumerate(part.columns) if i != at), pa.array(n), scores],
                [*(f.name for f in kept), "n", "scores"],
            )

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "n long, scores array<double>"])
    return rows.mapInArrow(run, schema)


def _counts(k: int, weight: Column | None = None) -> Column:
    return F.array(*(F.sum((F.col("best") == j).cast("double")) for j in range(k)))


def _added(k: int, column: str) -> Column:
    return F.array(*(F.sum(F.col(column)[j]) for j in range(k)))


def _smoothed(counts: str, above: str) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(counts, above, lambda n, p: (n + PRIOR_ROWS * p) / (total + PRIOR_ROWS))


def _value_evidence(rows: DataFrame, column: str, k: int, name: str) -> DataFrame:
    """For each value of a column the log probability of the value in each language."""
    found = rows.where(F.col(column).isNotNull()).groupBy(column).agg(_counts(k).alias("counts"))
    totals = found.agg(_added(k, "counts").alias("totals"), F.count("*").cast("double").alias("kinds")).first()
    of_all = [(t or 0.0) + VALUE_ROWS * (totals["kinds"] + 1) for t in totals["totals"]]
    shares = F.array(*(F.log((F.col("counts")[j] + VALUE_ROWS) / F.lit(of_all[j])) for j in range(k)))
    return found.select(column, shares.alias(name))


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    declared: Column | None = None,
    suffix: Column | None = None,
    host: Column | None = None,
    training: DataFrame | None = None,
) -> DataFrame:
    """One row per row: id, ``lang`` (``und`` if rejected), ``text_lang``, ``declared``, ``confidence``, ``accepted``.

    ``declared``, ``suffix`` and ``host`` are columns of ``docs``; a null one is no evidence. ``training`` (default
    ``docs``) has labelled rows with the same column names. Texts without letters are rejected, as are null ones and those
    that no language explains better than chance; of equal posteriors the first language in the alphabet
    wins. Without any language to compare with, nothing is rejected. Repeated rows and null ids are kept, an
    empty table gives no rows, further columns are ignored.
    """
    languages, model = fit(docs if training is None else training, id_col, text_col, label_col)
    none = F.lit(None).cast("string")
    domain = lambda h: F.regexp_extract(h, r"([^.]+\.)?[^.]+$", 0)
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).cast("string").alias("text"),
        (none if declared is None else declared.cast("string")).alias("declared"),
        (none if suffix is None else suffix.cast("string")).alias("suffix"),
        (none if host is None else host.cast("string")).alias("host"),
    ).withColumn("domain", domain(F.col("host")))
    if not languages:
        return rows.select(
            F.col("id").alias(id_col), F.lit(NONE).alias("lang"), F.lit(NONE).alias("text_lang"), "declared",
            F.lit(0.0).alias("confidence"), F.lit(True).alias("accepted"),
        )
    k = len(languages)
    best = F.when(F.col("n") > 0, F.array_position("scores", F.array_max("scores")).cast("int") - 1)
    scored = materialize(text_scores(rows, model).withColumn("best", best), "language-scores")

    hosts = scored.groupBy("domain", "host").agg(_counts(k).alias("counts"))
    everywhere = hosts.agg(_added(k, "counts").alias("all")).first()["all"]
    everywhere = [x or 0.0 for x in everywhere]
    shares = F.array(*(F.lit((x + 1.0) / (sum(everywhere) + k)) for x in everywhere))
    domains = hosts.groupBy("domain").agg(_added(k, "counts").alias("of_domain"))
    domains = domains.select("domain", _smoothed("of_domain", shares).alias("of_domain"))
    priors = hosts.where("host IS NOT NULL").join(domains, "domain").select("host", _smoothed("counts", "of_domain").alias("prior"))
    for name, column in (("by_declared", "declared"), ("by_suffix", "suffix")):
        scored = scored.join(_value_evidence(scored, column, k, name), column, "left")
    scored = scored.join(priors, "host", "left").withColumn("prior", F.coalesce("prior", shares))

    nothing = F.lit([0.0] * k)
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    evidence = add(
        add(F.transform("prior", lambda p: F.log(p * (1 - NONE_PRIOR))), F.col("scores")),
        add(F.coalesce("by_declared", nothing), F.coalesce("by_suffix", nothing)),
    )
    # what is declared says nothing about "none of these", so it counts there as for the average language
    mean = lambda c: F.aggregate(F.coalesce(c, nothing), F.lit(0.0), lambda a, x: a + x / k)
    chance = F.lit(math.log(NONE_PRIOR)) + mean(F.col("by_declared")) + mean(F.col("by_suffix"))
    top = F.greatest(F.array_max("evidence"), F.col("chance"))
    whole = F.aggregate("evidence", F.exp(F.col("chance") - top), lambda a, x: a + F.exp(x - top))
    names = F.lit(languages)
    judged = scored.withColumn("evidence", evidence).withColumn("chance", chance)
    judged = judged.withColumn("confidence", F.exp(F.array_max("evidence") - top) / whole)
    accepted = (F.col("n") > 0) & (F.col("confidence") >= ACCEPTED)
    name = lambda at: F.element_at(names, at.cast("int"))
    return judged.select(
        F.col("id").alias(id_col),
        F.when(accepted, name(F.array_position("evidence", F.array_max("evidence")))).otherwise(NONE).alias("lang"),
        F.coalesce(F.when(F.col("n") > 0, name(F.col("best") + 1)), F.lit(NONE)).alias("text_lang"),
        "declared", "confidence", accepted.alias("accepted"),
    )


def markup_language(html: Column) -> Column:
    """The two-letter language that the html element declares, else null."""
    return F.nullif(F.lower(F.regexp_extract(html, r"(?i)<html[^>]*\slang\s*=\s*[\"']?([a-z]{2})", 1)), F.lit(""))


def address_suffix(url: Column) -> Column:
    """The last label of the host of an address or of a bare host, else null."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^(?:[^/?#]*//)?[^/?#]*\.([A-Za-z]+)(?::[0-9]+)?(?:[/?#]|$)", 1)), F.lit(""))


def address_host(url: Column) -> Column:
    """The host of an address without user and port, else null."""
    return F.nullif(F.lower(F.regexp_extract(url, r"//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def documents_languages(docs: DataFrame) -> DataFrame:
    """``identify`` for tables like ``documents``: ``lang`` is what is declared, ``source`` the host."""
    return identify(docs, declared=F.col("lang"), suffix=address_suffix(F.col("source")), host=F.col("source"))


def pages_languages(pages: DataFrame) -> DataFrame:
    """``identify`` for tables like ``pages``: the markup declares a language, the address has suffix and host."""
    declared = markup_language(F.col("html"))
    text = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    rows = pages.select("page_id", "url", declared.alias("lang"), text.alias("text"))
    return identify(
        rows, "page_id", declared=F.col("lang"), suffix=address_suffix(F.col("url")), host=address_host(F.col("url"))
    )


def accepted_documents(docs: DataFrame) -> DataFrame:
    """The documents whose language is accepted, with all their columns; rows without an id go."""
    kept = documents_languages(docs).where("accepted").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi")


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return documents_languages(table(spark, sf, "documents"))


@query("op4_page_language_id")
def op4_page_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return pages_languages(table(spark, sf, "pages"))
