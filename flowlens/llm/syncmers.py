"""Document fingerprints from closed syncmers.

A stretch of ``K`` bytes is an anchor if the smallest hash among its inner stretches of ``S`` bytes is at
its first or last place. Whether it is depends on nothing but the stretch itself, so a text's anchors survive
any edit elsewhere and can be matched by position. A fingerprint has the anchors of the whole text whose hash is
among the smallest 1 / ``SPARSE`` of all hashes, with their positions, so it grows with the text; a text with fewer
than ``SKETCH`` of these has its ``SKETCH`` smallest ones. The likeness of two is the Dice share of anchors that agree
in position: with the same shift between their places as at least one other anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm import words as W
from flowlens.llm.queries import query, table

K, S = 16, 9
#: Inner stretches of an anchor; a power of two.
INNER = K - S + 1
SKETCH = 64
#: One in so many anchors of a long text is in its fingerprint.
SPARSE = 8
#: Anchors on one diagonal that make a stretch in common.
STRETCH = 2
HEX = 16
LOW = np.uint64(0xFFFFFFFF)
#: Characters of text that are fingerprinted at once.
CHARS = 1 << 19


def select(data: np.ndarray, offsets: np.ndarray, powers: W.Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position, 32-bit hash and text number of all closed syncmers of the texts that ``offsets`` cut out."""
    n = len(data)
    if n < K:
        none = np.zeros(0, dtype=np.int64)
        return none, none.astype(np.uint32), none
    up, down = powers.to(n)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(W.BYTE_VALUES[data] * up[:n], out=total[1:])
    inner = (total[S:] - total[:-S]) * down[: n - S + 1]
    inner = (inner ^ (inner >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    least = inner
    shift = 1
    while shift < INNER:
        least = np.minimum(least[:-shift], least[shift:])
        shift *= 2
    closed = (least == inner[: len(least)]) | (least == inner[INNER - 1 :])
    at = np.flatnonzero(closed)
    owner = np.searchsorted(offsets, at, "right") - 1
    whole = at + K <= offsets[owner + 1]
    at, owner = at[whole], owner[whole]
    hashes = W.mix((total[at + K] - total[at]) * down[at])
    return at, (hashes >> np.uint64(32)).astype(np.uint32), owner


def sketches(texts: list[str], powers: W.Powers) -> list[np.ndarray]:
    """The fingerprint of each text: position << 32 | hash, ascending; of a text without anchors its own hash at 0."""
    raw = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    at, hashes, owner = select(data, offsets, powers)
    bounds = np.searchsorted(owner, np.arange(len(raw) + 1))
    found = []
    for i, r in enumerate(raw):
        part = slice(bounds[i], bounds[i + 1])
        border, distinct = (1 << 32) // SPARSE, np.unique(hashes[part])
        if len(distinct) and np.searchsorted(distinct, border) < SKETCH:
            border = int(distinct[:SKETCH][-1]) + 1
        keep = hashes[part] < border
        own = ((at[part][keep] - offsets[i]).astype(np.uint64) << np.uint64(32)) | hashes[part][keep]
        if not len(own) and r:
            own = np.array([W.hash_of(r) >> 32], dtype=np.uint64)
        found.append(own)
    return found


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Dice share of the anchors that stand on diagonals in common; two empty texts are alike.

    A hash that is repeated pairs its k-th place with its k-th place, from the front and from the back, so that pairs
    grow no faster than anchors. A diagonal counts with ``STRETCH`` pairs, or all that the shorter text has. Each
    anchor counts at most once.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    limit = LOW  # a fingerprint of fewer than SKETCH distinct hashes is complete, others reach up to their largest
    for distinct in (np.unique(a & LOW), np.unique(b & LOW)):
        if len(distinct) >= SKETCH:
            limit = min(limit, distinct[-1])
    a, b = a[(a & LOW) <= limit], b[(b & LOW) <= limit]
    if not len(a) or not len(b):
        return 0.0
    front, back = _paired(a, b), _paired(a[::-1], b[::-1])
    first = np.concatenate((front[0], len(a) - 1 - back[0]))
    second = np.concatenate((front[1], len(b) - 1 - back[1]))
    both = np.unique(first * len(b) + second)
    first, second = both // len(b), both % len(b)
    shift = (a[first] >> np.uint64(32)).astype(np.int64) - (b[second] >> np.uint64(32)).astype(np.int64)
    _, which, n = np.unique(shift, return_inverse=True, return_counts=True)
    good = n[which] >= min(STRETCH, len(a), len(b))
    shared = min(len(np.unique(first[good])), len(np.unique(second[good])))
    return 2 * shared / (len(a) + len(b))


def _paired(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of equal hashes in both, the k-th of a hash with its k-th."""

    def keys(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes = x & LOW
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        starts = np.searchsorted(ranked, ranked)
        return (ranked << np.uint64(32)) | (np.arange(len(x)) - starts).astype(np.uint64), order

    (one, at_one), (two, at_two) = keys(a), keys(b)
    _, i, j = np.intersect1d(one, two, assume_unique=True, return_indices=True)
    return at_one[i], at_two[j]


def as_text(sketch: np.ndarray) -> str:
    return "".join(f"{int(h):0{HEX}x}" for h in sketch)


def from_text(fingerprint: str) -> np.ndarray:
    return np.array([int(fingerprint[i : i + HEX], 16) for i in range(0, len(fingerprint), HEX)], dtype=np.uint64)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        data, offsets = W.text_bytes(batch.column(1))
        for low, high in W.runs(offsets):
            yield batch.slice(low, high - low), data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]


def anchors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``position`` (byte) and ``anchor`` (hash) of all closed syncmers, for matching by position.

    Null, empty and short texts have none; repeated rows and null ids are kept; further columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = W.Powers()
        for part, data, offsets in _batches(batches):
            at, hashes, owner = select(data, offsets, powers)
            columns = [part.column(0).take(pa.array(owner)), pa.array(at - offsets[owner]), pa.array(hashes.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "position", "anchor"])

    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` {kind}, position long, anchor long")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and ``fingerprint`` of every row, as ``anchors``; a null or empty text has an empty one."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = W.Powers()
        for part, _, _ in _batches(batches):
            made = sketches([x or "" for x in part.column(1).to_pylist()], powers)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(as_text, made), pa.string())], [id_col, "fingerprint"])

    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` {kind}, fingerprint string")


def _place(splits: list[int], value: Column) -> Column:
    """How many splits are at most ``value``, by binary search."""
    steps = [1 << i for i in reversed(range(len(splits).bit_length()))]
    all_splits = F.lit(splits).cast("array<long>")
    return F.aggregate(
        F.lit(steps).cast("array<int>"),
        F.lit(0),
        lambda at, step: F.when(F.try_element_at(all_splits, at + step) <= value, at + step).otherwise(at),
    )


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text``, ``group``, ``extra``: rows dealt into ranges of ids and sorted, in partitions.

    In each group the documents stand in order; after the last one (``extra``) comes the first of the next
    group, after the last group that of the first. So whoever reads on sees every document's successor, with
    a single shuffle and no task that holds more than its range. Rows without an id are left out.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.where("doc_id IS NOT NULL")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.select(F.col("doc_id").cast("double")).approxQuantile("doc_id", [i / (2 * parts) for i in range(1, 2 * parts)], 0.2 / parts)
    group = _place(sorted({int(c) for c in cuts}), F.col("doc_id")) if cuts else F.lit(0)
    firsts = sorted(
        (r["g"], r["first"]) for r in rows.groupBy(group.alias("g")).agg(F.min("doc_id").alias("first")).collect()
    )  # one row for each range
    before = [(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)]
    first_of = docs.sparkSession.createDataFrame(before, "doc_id long, previous int")
    own = F.struct(group.alias("group"), F.lit(False).alias("extra"))
    copy = F.struct(F.col("previous").alias("group"), F.lit(True).alias("extra"))
    places = F.when(F.col("previous").isNull(), F.array(own)).otherwise(F.array(own, copy))
    dealt = rows.join(F.broadcast(first_of), "doc_id", "left").select("doc_id", "text", F.inline(places))
    return dealt.repartition(parts, "group").sortWithinPartitions("group", "extra", "doc_id", "text")


def compare_with_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint against that of an edited text and that of the next document.

    The last quarter of the edited text comes from the next document (ascending id, then text; after the last
    the first). A null or empty text has an empty fingerprint; rows that repeat an id are separate documents;
    rows without an id are left out; an empty table gives no rows; further columns are ignored.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, str, str]]:
        """Number of each document within the task, its id, its text, the next text; None between groups."""
        last = None
        for batch in batches:
            for doc, text, group, extra in zip(*(batch.column(i) for i in range(4))):
                row = (doc.as_py(), text.as_py(), group.as_py(), extra.as_py())
                if last and last[2] == row[2] and not last[3]:
                    yield last[0], last[1], row[1]
                last = row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, held, size = W.Powers(), [], 0

        def flush() -> pa.RecordBatch:
            edited = [t[: len(t) - len(t) // 4] + n[: len(t) // 4] for _, t, n in held]
            texts = [t for _, t, _ in held] + [held[-1][2]]
            # the next text is mostly the text of the next row, so it has its fingerprint already
            made = sketches(texts + edited, powers)
            own, new = made[: len(held)], made[len(held) + 1 :]
            near = []
            for i, (_, _, following) in enumerate(held):
                other = made[i + 1] if texts[i + 1] == following else sketches([following], powers)[0]
                near.append(likeness(own[i], other))
            columns = [
                pa.array([d for d, _, _ in held], pa.int64()),
                pa.array([len(t) for _, t, _ in held], pa.int64()),
                pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
                pa.array([as_text(x) for x in own]),
                pa.array([as_text(x) for x in new]),
                pa.array([likeness(a, b) for a, b in zip(own, new)], pa.float64()),
                pa.array(near, pa.float64()),
            ]
            return pa.RecordBatch.from_arrays(columns, names)

        for pair in pairs(batches):
            held.append(pair)
            size += len(pair[1])
            if size >= CHARS:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = ["long", "long", "string", "string", "string", "double", "double"]
    return with_next(docs, id_col, text_col).mapInArrow(run, ", ".join(map(" ".join, zip(names, kinds))))


@query("op8_document_fingerprints")
def op8_document_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return compare_with_edited(table(spark, sf, "documents"))
