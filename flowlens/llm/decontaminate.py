"""Documents that contain items of a benchmark: BM25 with block-max pruning, then a check of shared shingles.

The index holds the benchmark's items; every passage of every document is a query. Passages are windows of
twice the longest item's words and ``GAP``, overlapping by half, so that any item lies whole in one of them, also with
up to ``GAP`` words between question and answer. A score is
BM25 divided by the score of the item against itself. Retrieval is exact: each item whose score reaches
``THRESHOLD`` is found.

* The most frequent terms, which together can't bring any item near the threshold, only bound scores
  (the lists that WAND never puts in front of its pivot).
* For blocks of ``BLOCK`` items each further term has its largest weight. The bounds of all blocks are
  summed for many passages at once; only blocks whose bound reaches the threshold are opened.
* In opened blocks items are scored in full.

Retrieved items are verified by their 5-word shingles: at least ``OVERLAP`` of those of the question and of those
of the answer must stand in the passage, or as many of those of the undivided item. All three shares are returned.

The index of at most ``INDEX_BYTES`` of items goes to every task; a larger benchmark is cut into shards of that
size, each asked by all passages. Frequencies always come from the whole benchmark.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm import words as W
from flowlens.llm.queries import query, table

THRESHOLD = 0.6
OVERLAP = 0.8
SHINGLE = 5
#: Words that may stand between question and answer in any case.
GAP = 32
K1, B = 1.2, 0.75
#: Share of the threshold that the terms which only bound may reach in any item.
BOUNDING = 0.3
BLOCK = 4
INDEX_BYTES = 32 << 20
#: Passages x blocks whose bounds are held at once.
CELLS = 1 << 21
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RESULT = "doc_id long, item_id long, score double, overlap double, question_overlap double, answer_overlap double"


def words_of(text: str) -> list[bytes]:
    return [x.encode() for x in re.findall(WORD, text)]


def parts_of(text: str) -> tuple[str, str]:
    """Question and answer: up to the last question mark, else all but the last sentence."""
    cut = text.rfind("?") + 1
    if not cut:
        ends = [m.end() for m in re.finditer(r"[.!](?=\s)|\n", text.rstrip())]
        cut = ends[-1] if ends else len(text)
    return text[:cut], text[cut:]


def shingles(found: list[bytes]) -> set[bytes]:
    """The 5-word shingles of a word list; of a shorter one the whole."""
    return {b" ".join(found[i : i + SHINGLE]) for i in range(max(1, len(found) - SHINGLE + 1))} if found else set()


def contained(overlap: tuple[float, float, float], parts: tuple[set, set, set]) -> bool:
    """Whether the shares of an item, its question and its answer say that a passage holds it."""
    whole, question, answer = overlap
    return whole >= OVERLAP or bool(parts[1] and parts[2]) and question >= OVERLAP and answer >= OVERLAP


class Index:
    """Items (id, lower-cased text) of a shard, with the benchmark's size, mean length and document frequencies."""

    def __init__(self, items: list[tuple[int, str]], n: int, mean: float, df: dict[str, int]) -> None:
        self.ids, self.words, self.weights, self.shingles = [], [], [], []
        for item, text in items:
            if not (found := words_of(text)):
                continue
            raw = {}
            for term, f in Counter(found).items():
                idf = math.log(1 + (n - df[term.decode()] + 0.5) / (df[term.decode()] + 0.5))
                raw[term] = idf * f * (K1 + 1) / (f + K1 * (1 - B + B * len(found) / mean))
            total = sum(raw.values())
            question, answer = parts_of(text)
            self.ids.append(item)
            self.words.append(found)
            self.weights.append({t: x / total for t, x in raw.items()})
            self.shingles.append(tuple(map(shingles, (found, words_of(question), words_of(answer)))))
        self.stride = GAP + max(map(len, self.words), default=0)
        self.blocks = -(-len(self.ids) // BLOCK)
        self._lists()

    def _lists(self) -> None:
        """Term numbers by hash; for each term that isn't only bounding, its blocks and largest weights there."""
        lists: dict[bytes, list[int]] = {}
        for d, weights in enumerate(self.weights):
            for term in weights:
                lists.setdefault(term, []).append(d)
        bound = np.zeros(len(self.ids))
        self.bounding: set[bytes] = set()
        for term in sorted(lists, key=lambda t: (-len(lists[t]), t)):
            more = bound.copy()
            for d in lists[term]:
                more[d] += self.weights[d][term]
            if more.max() > BOUNDING * THRESHOLD:
                break
            bound = more
            self.bounding.add(term)
        self.rest = np.array([bound[b * BLOCK : (b + 1) * BLOCK].max() for b in range(self.blocks)])
        terms = sorted((W.hash_of(t), t) for t in lists if t not in self.bounding)
        self.hashes = np.array([h for h, _ in terms], dtype=np.uint64)
        starts, blocks, largest = [0], [], []
        for _, term in terms:
            best: dict[int, float] = {}
            for d in lists[term]:
                best[d // BLOCK] = max(best.get(d // BLOCK, 0.0), self.weights[d][term])
            blocks += best
            largest += best.values()
            starts.append(len(blocks))
        self.starts, self.list_blocks, self.list_weights = np.array(starts), np.array(blocks), np.array(largest)

    def opened(self, hashes: np.ndarray, passages: np.ndarray, n: int) -> Iterator[tuple[int, int]]:
        """Pairs (passage, block) whose bound reaches the threshold. ``passages`` numbers each word's passage."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        known = self.hashes[at] == hashes
        pairs = np.unique(passages[known].astype(np.int64) * len(self.hashes) + at[known])
        passage, term = pairs // len(self.hashes), pairs % len(self.hashes)
        step = max(1, CELLS // self.blocks)
        for low in range(0, n, step):
            high = min(n, low + step)
            a, b = np.searchsorted(passage, (low, high))
            size = self.starts[term[a:b] + 1] - self.starts[term[a:b]]
            first = np.repeat(self.starts[term[a:b]] - np.concatenate(([0], np.cumsum(size)[:-1])), size)
            posting = first + np.arange(size.sum())
            cell = np.repeat(passage[a:b] - low, size) * self.blocks + self.list_blocks[posting]
            bound = np.bincount(cell, self.list_weights[posting], (high - low) * self.blocks)
            bound = bound.reshape(high - low, self.blocks) + self.rest
            for p, block in zip(*np.nonzero(bound >= THRESHOLD - 1e-9)):
                yield low + int(p), int(block)

    def retrieved(self, words: list[bytes], block: int) -> Iterator[tuple[int, float]]:
        """Items of a block that reach the threshold in a passage."""
        present = set(words)
        for d in range(block * BLOCK, min(len(self.ids), (block + 1) * BLOCK)):
            score = sum(x for t, x in self.weights[d].items() if t in present)
            if score >= THRESHOLD - 1e-9:
                yield d, score

    def verified(self, words: list[bytes], d: int) -> tuple[float, float, float]:
        """Shares of the shingles of the item, its question and its answer that stand in a passage."""
        text = b" " + b" ".join(words) + b" "
        return tuple(
            sum(b" " + s + b" " in text for s in part) / len(part) if part else 0.0 for part in self.shingles[d]
        )

    def search(self, data: np.ndarray, offsets: np.ndarray, powers: W.Powers) -> Iterator[tuple]:
        """(document number, item id, score, overlaps) of the best passage for each document and verified item."""
        starts, ends, owner = W.word_bounds(data, offsets, W.ALPHANUMERIC)
        if not len(starts) or not self.ids:
            return
        hashes = W.span_hashes(data, starts, ends, powers)
        first = np.searchsorted(owner, np.arange(len(offsets) - 1))  # first word of each document
        count = np.diff(np.append(first, len(owner)))
        piece = (np.arange(len(owner)) - first[owner]) // self.stride
        base = np.concatenate(([0], np.cumsum(-(-count // self.stride))))
        own = base[owner] + piece
        inside = piece > 0
        n = int(base[-1])
        best: dict[tuple[int, int], tuple] = {}
        for passage, block in self.opened(
            np.concatenate((hashes, hashes[inside])), np.concatenate((own, own[inside] - 1)), n
        ):
            doc = int(np.searchsorted(base, passage, "right")) - 1
            low = int(first[doc] + (passage - base[doc]) * self.stride)
            high = min(low + 2 * self.stride, int(first[doc] + count[doc]))
            found = [data[a:b].tobytes() for a, b in zip(starts[low:high], ends[low:high])]
            for d, score in self.retrieved(found, block):
                overlap = self.verified(found, d)
                if contained(overlap, self.shingles[d]) and (score, overlap) > best.get((doc, d), (0.0, ())):
                    best[doc, d] = (score, overlap)
        for (doc, d), (score, overlap) in sorted(best.items()):
            yield doc, self.ids[d], score, *overlap


def shards(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[Index]:
    """The index in shards of at most about ``INDEX_BYTES`` of text; only one is on the driver at a time."""
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.lower(F.col(text_col).cast("string")).alias("text"))
    rows = rows.where("id IS NOT NULL AND text IS NOT NULL").withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    rows = rows.where("size(words) > 0")
    n, mean, size = rows.agg(F.count("*"), F.avg(F.size("words")), F.sum(F.octet_length("text"))).first()
    if not n:
        return
    frequencies = rows.select(F.explode(F.array_distinct("words")).alias("term")).groupBy("term").count()
    cut = math.ceil(size / INDEX_BYTES)
    for shard in range(cut):
        own = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(cut)) == shard)
        terms = own.select(F.explode("words").alias("term")).distinct()
        df = {r["term"]: r["count"] for r in frequencies.join(terms, "term", "left_semi").collect()}
        yield Index([(r["id"], r["text"]) for r in own.select("id", "text").orderBy("id", "text").collect()], n, mean, df)


def _search(docs: DataFrame, index: Index) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, powers = sent.value, W.Powers()
        for batch in batches:
            data, offsets = W.text_bytes(batch.column(1))
            found = []
            for low, high in W.runs(offsets):
                part = data[offsets[low] : offsets[high]]
                found += [(low + hit[0], *hit[1:]) for hit in index.search(part, offsets[low : high + 1] - offsets[low], powers)]
            columns = [list(c) for c in zip(*found)] or [[] for _ in range(6)]
            columns[0] = batch.column(0).take(pa.array(columns[0], pa.int64()))
            types = [pa.int64(), pa.int64(), *[pa.float64()] * 4]
            names = [x.split()[0] for x in RESULT.split(", ")]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)], names)

    return docs.mapInArrow(run, RESULT)


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document and benchmark item that it contains: ``RESULT``.

    Null texts count as empty and contain nothing, items without words are in no document, rows without an id
    are left out, a row that is repeated is found as often, equal items with different ids are each found,
    empty tables give no rows. Further columns are ignored.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.lower(F.col(text_col).cast("string")).alias("text"))
    narrow = narrow.where("doc_id IS NOT NULL")
    found = [_search(narrow, index) for index in shards(items)]
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], RESULT)


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those that contain an item; rows without an id stay."""
    hit = matches(docs, items, id_col, text_col).select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(hit, id_col, "left_anti")


@query("op6_benchmark_decontamination")
def op6_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return matches(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
