"""Stupid-backoff scores of documents under the counts of the whole corpus without themselves.

1. Documents are taken in packets of about ``PACKET_BYTES``. A packet's distinct n-grams with their counts are
   dealt out by hash: one row per packet and hash bucket (only where there are any), sorted hashes stored
   as differences. So a frequent n-gram travels once per packet, however many documents have it.
2. Each bucket is a partition of the n-gram count tables. Its counts are summed over all packets and joined
   back to the n-grams of each packet.
3. A packet's words and the counts of its n-grams meet; every word is scored and scores are summed by document.

The number of buckets follows the size of the corpus, so that a bucket and a packet stay small at any size.
The packets are written to the shared folder once; what is joined later always agrees with them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm import words as W
from flowlens.llm.queries import query, table
from flowlens.workspace import materialize

BACKOFF = 0.4
PACKET_BYTES = 4 << 20
#: Text for each hash bucket; about a sixth of its bytes are n-grams to count.
BUCKET_BYTES = 7 << 20
#: Bits of a hash that are kept inside a bucket; the others choose the bucket.
KEPT_BITS = 40


def packed(values: np.ndarray) -> bytes:
    """Small numbers in few bytes: the bytes of equal weight together, compressed."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if len(values) else b""


def unpacked(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, dtype=np.uint64)
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


class Grams:
    """The n-grams of a packet, from its distinct word hashes and the places of its words among them."""

    def __init__(self, vocabulary: np.ndarray, words: np.ndarray, owner: np.ndarray, buckets: int) -> None:
        self.words, self.owner = words, owner
        self.follows = np.flatnonzero(owner[1:] == owner[:-1]) + 1  # words with a word in front of them
        pairs = words[self.follows - 1] * len(vocabulary) + words[self.follows]
        self.pairs, self.pair_of = np.unique(pairs, return_inverse=True)
        first, second = vocabulary[self.pairs // max(1, len(vocabulary))], vocabulary[self.pairs % max(1, len(vocabulary))]
        hashes = np.concatenate((vocabulary, W.mix(first * np.uint64(W.BASE) + second)))
        bucket = (hashes >> np.uint64(KEPT_BITS)) % np.uint64(buckets)
        self.kept = hashes & np.uint64((1 << KEPT_BITS) - 1)
        self.bucket = bucket.astype(np.int64)
        self.order = np.lexsort((self.kept, self.bucket))

    def counts(self, vocabulary_size: int) -> np.ndarray:
        single = np.bincount(self.words, minlength=vocabulary_size)
        return np.concatenate((single, np.bincount(self.pair_of, minlength=len(self.pairs))))


def packets(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows of ``packet``, ``bucket`` (-1: the packet itself), ``n``, ``first``, ``second``.

    The packet itself: its words, distinct word hashes, places of its words; document ids and lengths in ``docs``.
    Otherwise the n-grams of a bucket: how many, their hashes, their counts.
    """
    schema = "packet long, bucket int, n long, first binary, second binary, ids array<long>, lengths array<long>"
    names = ["packet", "bucket", "n", "first", "second", "ids", "lengths"]

    def rows_of(packet: int, ids: list, hashes: list, lengths: list) -> pa.RecordBatch:
        vocabulary, words = np.unique(np.concatenate(hashes), return_inverse=True)
        counted = np.concatenate(lengths)
        grams = Grams(vocabulary, words, np.repeat(np.arange(len(counted)), counted), buckets)
        counts = grams.counts(len(vocabulary))[grams.order]
        kept, bucket = grams.kept[grams.order], grams.bucket[grams.order]
        borders = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
        found = [(packet, -1, len(words), packed(np.diff(vocabulary, prepend=np.uint64(0))), packed(words),
                  np.concatenate(ids).tolist(), counted.tolist())]
        for a, b in zip(borders[:-1], borders[1:]):
            apart = np.diff(kept[a:b], prepend=np.uint64(0))
            found.append((packet, int(bucket[a]), int(b - a), packed(apart), packed(counts[a:b]), None, None))
        types = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), *[pa.list_(pa.int64())] * 2]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, held, size = W.Powers(), ([], [], []), 0
        packet = TaskContext.get().partitionId() << 32
        for batch in batches:
            own = batch.column(0).to_numpy()
            whole, bounds = W.text_bytes(batch.column(1))
            for low, high in W.runs(bounds):
                data = W.LOWER[whole[bounds[low] : bounds[high]]]
                starts, ends, owner = W.word_bounds(data, bounds[low : high + 1] - bounds[low], W.ALPHANUMERIC)
                held[0].append(own[low:high])
                held[1].append(W.span_hashes(data, starts, ends, powers))
                held[2].append(np.bincount(owner, minlength=high - low))
                size += len(data)
                if size >= PACKET_BYTES:
                    yield rows_of(packet, *held)
                    packet, held, size = packet + 1, ([], [], []), 0
        if held[0]:
            yield rows_of(packet, *held)

    return docs.mapInArrow(run, schema)


def totals(asked: DataFrame) -> DataFrame:
    """For each packet and bucket the corpus's counts of the packet's n-grams."""

    def run(group: pa.Table) -> pa.Table:
        sizes = group.column("n").to_numpy()
        kept = [np.cumsum(unpacked(x.as_py(), n)) for x, n in zip(group.column("first"), sizes)]
        counts = [unpacked(x.as_py(), n) for x, n in zip(group.column("second"), sizes)]
        _, place = np.unique(np.concatenate(kept), return_inverse=True)
        total = np.bincount(place, np.concatenate(counts).astype(float)).astype(np.int64)[place]
        parts = np.split(total, np.cumsum(sizes)[:-1])
        return pa.table([group.column("packet"), group.column("bucket"), pa.array([packed(p) for p in parts], pa.binary())],
                        names=["packet", "bucket", "total"])

    return asked.groupBy("bucket").applyInArrow(run, "packet long, bucket int, total binary")


def _within(owner: np.ndarray, items: np.ndarray, size: int) -> np.ndarray:
    """For each word or pair how often its document has it."""
    _, place, n = np.unique(owner * max(1, size) + items, return_inverse=True, return_counts=True)
    return n[place]


def packet_scores(grams: Grams, total: np.ndarray, vocabulary_size: int, lengths: np.ndarray, corpus: int) -> tuple:
    """Log score and number of backed-off words of each document of a packet.

    A word after another scores c(pair) / c(word before) if the pair occurs elsewhere, else ``BACKOFF`` times
    the word's own share; the first word scores its share. A word that occurs nowhere else counts ``BACKOFF`` times.
    """
    words, owner, follows = grams.words, grams.owner, grams.follows
    elsewhere = total[words] - _within(owner, words, vocabulary_size)
    others = np.maximum(1, corpus - lengths)[owner]
    share = np.log(np.where(elsewhere > 0, elsewhere, BACKOFF) / others)
    pair = total[vocabulary_size:][grams.pair_of] - _within(owner[follows], grams.pair_of, len(grams.pairs))
    seen = pair > 0
    after = np.where(seen, np.log(np.maximum(pair, 1) / np.maximum(elsewhere[follows - 1], 1)), math.log(BACKOFF) + share[follows])
    score = share
    score[follows] = after
    n = len(lengths)
    return np.bincount(owner, score, n).astype(float), np.bincount(owner[follows], ~seen, n).astype(np.int64)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``log_score`` (sum of natural logarithms), ``mean_score`` per word, ``backed_off``.

    Words are runs of letters and digits (anything beyond ASCII counts as such), A-Z lower-cased. Counts are
    those of all rows but the document's own. A null or empty text has 0 words, score 0 and a null mean. Rows that
    repeat an id are separate documents; rows without an id are left out; an empty table gives no rows; further
    columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where("doc_id IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(1 << (64 - KEPT_BITS), size // BUCKET_BYTES + 1)
    written = materialize(packets(rows, buckets), "packets")
    own = written.where("bucket = -1")
    corpus = own.agg(F.sum("n")).first()[0] or 0
    answers = totals(written.where("bucket >= 0").select("packet", "bucket", "n", "first", "second"))
    names = ["doc_id", "n_words", "log_score", "mean_score", "backed_off"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        lengths = np.array(row["lengths"], dtype=np.int64)
        words = unpacked(row["second"], row["n"]).astype(np.int64)
        distinct = int(words.max()) + 1 if len(words) else 0
        vocabulary = np.cumsum(unpacked(row["first"], distinct))
        grams = Grams(vocabulary, words, np.repeat(np.arange(len(lengths)), lengths), buckets)
        answer = dict(zip(right.column("bucket").to_pylist(), right.column("total").to_pylist()))
        total = np.zeros(len(grams.kept), dtype=np.int64)
        bucket = grams.bucket[grams.order]
        borders = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
        for a, b in zip(borders[:-1], borders[1:]):
            total[grams.order[a:b]] = unpacked(answer[int(bucket[a])], int(b - a))
        log_score, backed_off = packet_scores(grams, total, distinct, lengths, corpus)
        mean = pa.array(log_score / np.maximum(1, lengths), mask=lengths == 0)
        return pa.table([pa.array(row["ids"], pa.int64()), pa.array(lengths), pa.array(log_score), mean, pa.array(backed_off)], names=names)

    schema = "doc_id long, n_words long, log_score double, mean_score double, backed_off long"
    return own.groupBy("packet").cogroup(answers.groupBy("packet")).applyInArrow(run, schema)


@query("op9_lm_scoring")
def op9_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return score(table(spark, sf, "documents"))
