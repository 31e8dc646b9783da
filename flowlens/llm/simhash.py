"""Near duplicates by SimHash, found by hashing every fingerprint's ball of half the radius.

Two fingerprints differ in at most 4 bits exactly if some word lies within 2 bits of both. So each
fingerprint emits all 2,081 words within 2 bits of it, and fingerprints that meet on a word are linked.

Only distinct fingerprints take part. The shuffle carries variants grouped by the parities of ``k`` blocks
of bits: a flipped bit changes one parity, so the variants of a fingerprint lie in 1 + k + k(k-1)/2 groups;
one row goes to each of them, and the task that owns the group writes out just the variants that lie in it.
Those of one fingerprint spread over its groups (225 of 2,081 in the fullest for k = 8), so that a large
set of near copies doesn't gather in one task. ``k`` grows with the number of fingerprints.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm.components import components
from flowlens.llm.queries import query, table
from flowlens.workspace import materialize

BITS = 64
RADIUS = 4
HALF = RADIUS // 2
SHINGLE = 4
SEED = 42
#: Variants that a group should hold on average, and those that a task sorts at once.
GROUP_VARIANTS = 1 << 20
SORTED_VARIANTS = 1 << 21
#: Shingles whose bits are counted at once.
BIT_ROWS = 1 << 15


def majority(hashes: np.ndarray) -> int:
    """The number whose bits are set in over half of the hashes."""
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), BIT_ROWS):
        part = np.ascontiguousarray(hashes[at : at + BIT_ROWS]).astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def fingerprint(text: str | None) -> int:
    """The SimHash of a whole text over its 4-word shingles; 0 if it has no words."""
    # bytes.lower and bytes.split know ASCII only: A-Z, and space, tab to carriage return
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    digest = xxhash.xxh64_intdigest
    shingles = (digest(b" ".join(words[i : i + SHINGLE]), SEED) for i in range(n))
    return majority(np.fromiter(shingles, dtype=np.uint64, count=n))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint as a signed long) of every row with an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(x.as_py()) for x in batch.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks)], ["doc_id", "fp"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return chosen.where("doc_id IS NOT NULL").mapInArrow(run, "doc_id long, fp long")


def blocks(k: int) -> list[int]:
    """Masks that cut 64 bits into ``k`` blocks."""
    return [sum(1 << int(bit) for bit in part) for part in np.array_split(np.arange(BITS), k)]


def block_count(distinct: int) -> int:
    """Blocks for which a group holds about ``GROUP_VARIANTS`` variants."""
    ball = sum(math.comb(BITS, r) for r in range(HALF + 1))
    return min(40, max(6, math.ceil(math.log2(max(1, distinct * ball / GROUP_VARIANTS)))))


def group_errors(k: int) -> dict[int, np.ndarray]:
    """For each difference of parities, the bits whose flip leads there with at most 2 flips."""
    found: dict[int, list[int]] = {}
    block_of = [j for j, part in enumerate(np.array_split(np.arange(BITS), k)) for _ in part]
    for a in range(BITS):
        found.setdefault(1 << block_of[a], []).append(1 << a)
        for b in range(a):
            found.setdefault((1 << block_of[a]) ^ (1 << block_of[b]), []).append((1 << a) | (1 << b))
    found.setdefault(0, []).append(0)
    return {d: np.array(e, dtype=np.uint64) for d, e in found.items()}


def parities(marks: np.ndarray, masks: list[int]) -> np.ndarray:
    out = np.zeros(len(marks), dtype=np.int64)
    for j, mask in enumerate(masks):
        out |= (np.bitwise_count(marks & np.uint64(mask)).astype(np.int64) & 1) << j
    return out


def merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the groups of ``a[i]`` and ``b[i]``; a label is the smallest index of its group."""
    while True:
        left, right = labels[a], labels[b]
        differ = left != right
        if not differ.any():
            return labels
        left, right = left[differ], right[differ]
        np.minimum.at(labels, np.maximum(left, right), np.minimum(left, right))
        while not np.array_equal(up := labels[labels], labels):
            labels = up


def linked(marks: np.ndarray, group: int, k: int) -> np.ndarray:
    """For each fingerprint of a group, the index of one that its variants in the group connect it to.

    Memory is bounded: a group with more variants is worked through in slices of the variants' hash.
    """
    masks, errors = blocks(k), group_errors(k)
    apart = parities(marks, masks) ^ group
    members = [(np.flatnonzero(apart == d), e) for d, e in errors.items()]
    total = sum(len(m) * len(e) for m, e in members)
    slices = max(1, math.ceil(total / SORTED_VARIANTS))
    labels = np.arange(len(marks))
    for part in range(slices):
        variants, owners = [], []
        for rows, error in members:
            step = max(1, SORTED_VARIANTS // len(error))
            for at in range(0, len(rows), step):
                some = rows[at : at + step].astype(np.int32)
                words = (marks[some][:, None] ^ error[None, :]).ravel()
                whose = np.repeat(some, len(error))
                if slices > 1:
                    mine = ((words * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(slices) == part
                    words, whose = words[mine], whose[mine]
                variants.append(words)
                owners.append(whose)
        words, whose = np.concatenate(variants), np.concatenate(owners)
        variants, owners = [], []
        order = np.argsort(words)
        words, whose = words[order], whose[order]
        met = np.flatnonzero(words[1:] == words[:-1])
        a, b = whose[met], whose[met + 1]
        near = np.bitwise_count(marks[a] ^ marks[b]) <= RADIUS
        labels = merge(labels, a[near], b[near])
    return labels


def links(marks: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of fingerprints that connect all fingerprints with a chain of links.

    In each group of variants at most one pair per fingerprint, whatever the number of links.
    """
    k = block_count(marks.count())
    steps = [0, *(1 << a for a in range(k)), *((1 << a) | (1 << b) for a in range(k) for b in range(a))]
    parity = F.lit(0).cast("long")
    for j, mask in enumerate(blocks(k)):
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        bit = F.bit_count(F.col("fp").bitwiseAND(F.lit(signed))).bitwiseAND(F.lit(1)).cast("long")
        parity = parity.bitwiseOR(F.shiftleft(bit, j))
    near = F.explode(F.transform(F.lit(steps).cast("array<long>"), lambda s: s.bitwiseXOR(F.col("parity"))))
    sent = marks.select("fp", parity.alias("parity")).select(near.alias("group"), "fp")

    def run(key: tuple, group: pa.Table) -> pa.Table:
        own = group.column("fp").to_numpy().view(np.uint64)
        labels = linked(own, key[0].as_py(), k) if len(own) > 1 else np.arange(len(own))
        moved = np.flatnonzero(labels != np.arange(len(own)))
        pairs = [pa.array(own[x].view(np.int64)) for x in (moved, labels[moved])]
        return pa.table(pairs, names=["a", "b"])

    return sent.groupBy("group").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` for every row with an id.

    Fingerprints link at 4 or fewer differing bits; ``component_id`` is the smallest id reachable. A null or
    empty text has fingerprint zero and links like any other. Rows that repeat an id stay separate rows; rows
    without an id are left out; an empty table gives no rows. Further columns of ``docs`` are ignored.
    """
    own = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    marks = materialize(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "marks")
    roots = components(links(marks.select("fp")), "a", "b")
    grouped = marks.join(roots, marks.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = materialize(grouped.join(least, "root").select("fp", "component_id"), "classes")
    return own.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document with the smallest id of each group of near duplicates, once, with all its columns."""
    groups = near_duplicates(docs, id_col, text_col)
    kept = groups.where("doc_id = component_id").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(kept, id_col, "left_semi").dropDuplicates([id_col])


@query("op3_simhash_near_dedup")
def op3_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"))
