"""A manifest of a dataset: a tree of SHA-256 digests whose parents keep the hash states before each child.

A digest in hex is 64 characters, exactly one block of SHA-256. A parent that hashes up to eight children
therefore passes through one state of 32 bytes in front of each child, and keeps these states. To see what a
changed child makes of the root, hashing resumes at the state in front of that child with the replacement and
its right siblings; the left siblings are already in the state.

Rows are placed by one range exchange. A task then builds a block: four levels over at most 4,096
consecutive nodes; the tops of the blocks are the nodes of the next round, so that a table of any size needs a
round for each factor of 4,096. For folding, the states and siblings above each block come down from the
root, a row per block, and every block folds its own rows. No task sees more than a block, and a group with a
third of all rows is many blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowlens.llm.queries import query, table
from flowlens.workspace import materialize

ARITY = 8
#: Levels that one task builds, over at most so many nodes.
LEVELS = 4
BLOCK = ARITY**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "tree string, level int, pos long, arity int, digest binary, children binary, states binary"
PATH = "tree string, block long, path binary, subroot binary"

_PRIMES = [p for p in range(2, 312) if all(p % q for q in range(2, p))]
#: The constants of SHA-256: fractions of the cube and square roots of the first primes.
ROUND = np.array([int(p ** (1 / 3) % 1 * 2**32) for p in _PRIMES], dtype=np.uint32)
START = np.array([int(p**0.5 % 1 * 2**32) for p in _PRIMES[:8]], dtype=np.uint32)
HEX = np.frombuffer("".join(f"{b:02x}" for b in range(256)).encode(), dtype=np.uint8).reshape(256, 2)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """SHA-256 states (8 x n words) after one more block (16 x n words) each."""
    words = list(block)
    a, b, c, d, e, f, g, h = state
    for i in range(64):
        if i >= 16:
            x, y = words[i - 15], words[i - 2]
            x = _turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))
            y = _turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))
            words.append(words[i - 16] + x + words[i - 7] + y)
        one = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + ROUND[i] + words[i]
        two = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


def as_block(digests: np.ndarray) -> np.ndarray:
    """The block (16 x n words) that each digest (n x 32 bytes) is as hex text."""
    return HEX[digests].reshape(len(digests), 64).view(">u4").astype(np.uint32).T


def finish(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests (n x 32 bytes) of states after whole blocks, of which each has had ``blocks``."""
    last = np.zeros((16, state.shape[1]), dtype=np.uint32)
    last[0], last[15] = 1 << 31, blocks * 512
    return as_bytes(compress(state, last))


def as_bytes(state: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(state.T.astype(">u4")).view(np.uint8).reshape(-1, 32)


def as_state(data: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(data).view(">u4").astype(np.uint32).T


def resume(state, slot, arity, child, siblings) -> np.ndarray:
    """Digests of parents with ``child`` (n x 32) in ``slot``, from the state in front of it.

    ``siblings`` are the parents' children (n x 8 x 32), of which only those right of the slot are read.
    """
    state = compress(state, as_block(child))
    for step in range(1, ARITY):
        at = slot + step
        some = np.flatnonzero(at < arity)
        if not len(some):
            break
        state[:, some] = compress(state[:, some], as_block(siblings[some, at[some]]))
    return finish(state, arity)


def height(total: int) -> int:
    """Levels above the leaves of a tree."""
    levels = 0
    while total > 1:
        total, levels = -(-total // ARITY), levels + 1
    return levels


def packed(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Binary values of one length as an array of bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, width)


def parents(digests: np.ndarray) -> tuple[np.ndarray, ...]:
    """Arity, digest, children (n x 8 x 32, zero where absent) and states (n x 8 x 32) of the next level."""
    n = -(-len(digests) // ARITY)
    arity = np.full(n, ARITY)
    arity[-1] = len(digests) - ARITY * (n - 1)
    children = np.zeros((n * ARITY, 32), dtype=np.uint8)
    children[: len(digests)] = digests
    children = children.reshape(n, ARITY, 32)
    states = np.zeros((n, ARITY, 32), dtype=np.uint8)
    state = np.repeat(START[:, None], n, axis=1)
    for slot in range(ARITY):
        some = np.flatnonzero(slot < arity)
        if not len(some):
            break
        states[some, slot] = as_bytes(state[:, some])
        state[:, some] = compress(state[:, some], as_block(children[some, slot]))
    return arity, finish(state, arity), children, states


def _build(level: int):
    """The nodes above one block of nodes of ``level``."""

    def run(nodes: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("pos")
        tree, first = nodes["tree"][0].as_py(), nodes["pos"][0].as_py()
        digests, made = packed(nodes["digest"], 32), []
        for up in range(level + 1, min(level + LEVELS, height(nodes["total"][0].as_py())) + 1):
            first //= ARITY
            arity, digests, children, states = parents(digests)
            made += [
                (tree, up, first + i, int(n), digests[i].tobytes(), children[i, :n].tobytes(), states[i, :n].tobytes())
                for i, n in enumerate(arity)
            ]
        names = [x.split(" ")[0] for x in NODE.split(", ")]
        types = [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*made), types)], names=names)

    return run


def _step(slot: int, arity: int, children: bytes, states: bytes) -> bytes:
    """One level of a path: slot, arity, the state in front of the slot, all children."""
    return bytes([slot, arity]) + states[32 * slot : 32 * slot + 32] + children


def steps(path: bytes) -> Iterable[tuple[int, int, bytes, bytes]]:
    at = 0
    while at < len(path):
        slot, arity, end = path[at], path[at + 1], at + 34 + 32 * path[at + 1]
        yield slot, arity, path[at + 2 : at + 34], path[at + 34 : end]
        at = end


def _descend(level: int):
    """The path from each node of ``level`` in a block up to the root, from the block's own path."""

    def run(rows: pa.Table) -> pa.Table:
        tree = rows["tree"][0].as_py()
        nodes, above, subroot = {}, b"", None
        for kind, pos, arity, children, states in zip(
            *(rows[c].to_pylist() for c in ("level", "pos", "arity", "children", "states"))
        ):
            if kind == 0:
                above, subroot = children, states
            else:
                nodes[kind, pos] = (arity, children, states)
        top = max((kind for kind, _ in nodes), default=level)
        paths = {pos: above for kind, pos in nodes if kind == top}
        for up in range(top, level, -1):
            paths = {
                pos * ARITY + slot: _step(slot, *nodes[up, pos]) + path
                for pos, path in paths.items()
                for slot in range(nodes[up, pos][0])
            }
        made = [pa.array(paths, pa.int64()), pa.array(paths.values(), pa.binary())]
        n = len(paths)
        return pa.table(
            [pa.array([tree] * n, pa.string()), *made, pa.array([subroot] * n, pa.binary())],
            names=["tree", "block", "path", "subroot"],
        )

    return run


def _fold(leaves: pa.Table, above: pa.Table) -> pa.Table:
    """What each leaf of one block makes of the root, and the digest of its siblings up to there."""
    leaves = leaves.sort_by("pos")
    place = np.array(leaves["pos"].to_numpy())
    value, levels, path, subroot = packed(leaves["presented"], 32), {}, b"", b""
    proofs = [hashlib.sha256() for _ in place]
    for kind, pos, arity, children, states in zip(
        *(above[c].to_pylist() for c in ("level", "pos", "arity", "children", "states"))
    ):
        if kind == 0:
            path, subroot = children, states
        else:
            levels.setdefault(kind, []).append((pos, arity, children, states))
    for kind in sorted(levels):
        nodes = sorted(levels[kind])
        slot, parent = place % ARITY, place // ARITY - nodes[0][0]
        arity = np.array([n for _, n, _, _ in nodes])[parent]
        children, states = (
            np.frombuffer(b"".join(x[k].ljust(32 * ARITY, b"\0") for x in nodes), dtype=np.uint8).reshape(-1, ARITY, 32)
            for k in (2, 3)
        )
        value = resume(as_state(states[parent, slot]), slot, arity, value, children[parent])
        runs = [x[2].hex().encode() for x in nodes]
        for proof, i, k in zip(proofs, parent, slot):
            proof.update(runs[i][: 64 * k])
            proof.update(runs[i][64 * k + 64 :])
        place = place // ARITY
    rest = b""
    for k, n, state, children in steps(path):
        own = np.frombuffer(children.ljust(32 * ARITY, b"\0"), dtype=np.uint8).reshape(1, ARITY, 32)
        many = len(value)
        state = np.repeat(as_state(np.frombuffer(state, dtype=np.uint8).reshape(1, 32)), many, axis=1)
        value = resume(state, np.full(many, k), np.full(many, n), value, np.broadcast_to(own, (many, ARITY, 32)))
        text = children.hex().encode()
        rest += text[: 64 * k] + text[64 * k + 64 :]
    for proof in proofs:
        proof.update(rest)
    made = {
        "subroot": [subroot.hex()] * len(value),
        "proof_sha256": [x.hexdigest() for x in proofs],
        "folded_root": [x.tobytes().hex() for x in value],
    }
    return pa.table([leaves["row"], *(pa.array(x, pa.string()) for x in made.values())], names=["row", *made])


def ranked(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0 within ``tree``, nulls first) and ``total`` (rows of the tree), written.

    One range exchange; the partitions' counts, a row per tree and partition, give what comes before each.
    """
    keys = [F.col(c).asc_nulls_first() for c in (tree, *order)]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = materialize(placed.withColumn("place", F.monotonically_increasing_id()), "places")
    placed = placed.withColumn("part", F.shiftright("place", 33))
    counts = materialize(placed.groupBy(tree, "part").agg(F.count("*").alias("n"), F.min("place").alias("first")), "counts")
    own = Window.partitionBy(tree)
    before = F.coalesce(F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = materialize(
        counts.select(tree, "part", (before - F.col("first")).alias("shift"), F.sum("n").over(own).alias("total")), "counts"
    )
    return placed.join(base, [tree, "part"]).withColumn("pos", F.col("place") + F.col("shift")).drop("part", "shift")


@dataclass
class Manifest:
    """``leaves`` (row, tree, pos, total, digest and given columns), the nodes of each round, the root digest.

    ``tops`` has the path and the digest of each tree's own root. All tables are written ones.
    """

    leaves: DataFrame
    rounds: list[DataFrame]
    tops: DataFrame
    root: str | None


def _grow(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The rounds of nodes above all trees, and ``tree, digest`` of their roots."""
    totals = nodes.agg(F.max("total")).first()[0] or 0
    names = ["tree", "pos", "total", "digest"]
    sizes = nodes.select("tree", "total").where("pos = 0")
    rounds, roots = [], nodes.where("total = 1").select("tree", "digest")
    for level in range(0, height(totals), LEVELS):
        block = F.expr(f"pos div {BLOCK}").alias("block")
        # trees of more than 8 ** level leaves go on
        going = nodes.where(F.col("total") > ARITY**level).select(*names)
        made = materialize(going.groupBy("tree", block).applyInArrow(_build(level), NODE), "nodes")
        rounds.append(made)
        nodes = made.where(F.col("level") == level + LEVELS).join(sizes, "tree").select(*names)
        tops = made.where("pos = 0").groupBy("tree").agg(F.max_by("digest", "level").alias("digest"), F.max("level").alias("level"))
        ended = tops.join(sizes, "tree").where(F.col("total") <= F.lit(ARITY) ** F.col("level"))
        roots = roots.unionByName(ended.select("tree", "digest"))
    return rounds, materialize(roots, "roots")


def _above(nodes: DataFrame, level: int, paths: DataFrame) -> DataFrame:
    """The nodes of a round and, as rows of level 0, the paths of its blocks; all by tree and block."""
    block = F.expr(f"(pos * {ARITY}L * shiftleft(1L, cast(3 * (level - {level} - 1) as int))) div {BLOCK}")
    own = nodes.select("tree", block.alias("block"), "level", "pos", "arity", "children", "states")
    more = paths.select(
        "tree", "block", F.lit(0).alias("level"), F.lit(0).cast("long").alias("pos"), F.lit(0).alias("arity"),
        F.col("path").alias("children"), F.col("subroot").alias("states"),
    )
    return own.unionByName(more)


def _paths(rounds: list[DataFrame], tops: DataFrame, last: int) -> DataFrame:
    """Paths (``PATH``) of the blocks below round ``last``, from those of the trees (tree, path, subroot, total)."""
    start = lambda least, most: tops.where(
        (F.col("total") > least) & (F.col("total") <= most)
    ).select("tree", F.lit(0).cast("long").alias("block"), "path", "subroot")
    paths = start(BLOCK ** len(rounds), 2**62)
    for number in range(len(rounds) - 1, last - 1, -1):
        least = BLOCK**number if number else 0
        # trees of one node have no round; their leaf's path is the tree's
        paths = paths.unionByName(start(least, BLOCK ** (number + 1)))
        rows = _above(rounds[number], number * LEVELS, paths)
        below = rows.groupBy("tree", "block").applyInArrow(_descend(number * LEVELS), PATH)
        paths = materialize(below, "paths")
    return paths if last else paths.unionByName(start(0, 0))


def build(leaves: DataFrame, tree: str, order: list[str], digest: str = "leaf") -> Manifest:
    """The manifest of a table of leaves: a tree for each value of ``tree`` (null is one), one over their roots.

    ``digest`` is the leaf's digest in hex. Leaves ascend by ``order``, nulls first; of equal ones the smaller digest
    comes first, so that the root doesn't depend on the order of the rows. An empty table has no root.
    """
    name = F.when(F.col(tree).isNull(), "").otherwise(F.concat(F.lit("="), F.col(tree).cast("string")))
    # written before the exchange, which looks at its keys twice
    rows = materialize(leaves.select("*", name.alias("tree"), F.unhex(digest).alias("digest")), "leaves")
    placed = ranked(rows, "tree", [*order, "digest"]).withColumnRenamed("place", "row")
    placed = materialize(placed, "leaves")
    rounds, roots = _grow(placed)
    ranks = ranked(roots.select("digest", F.lit("").alias("tree"), F.col("tree").alias("name")), "tree", ["name"])
    ranks = materialize(ranks, "ranks")
    upper, root = _grow(ranks)
    first = root.first()
    empty = F.lit(b"")
    apex = root.join(ranks.where("pos = 0").select("tree", "total"), "tree")
    apex = apex.select("tree", empty.alias("path"), empty.alias("subroot"), "total")
    if upper:
        paths = _paths(upper, apex, 0).select(F.col("block").alias("pos"), "path")
        named = ranks.join(paths, "pos").select(F.col("name").alias("tree"), "path", F.col("digest").alias("subroot"))
    else:
        named = ranks.select(F.col("name").alias("tree"), empty.alias("path"), F.col("digest").alias("subroot"))
    tops = materialize(named.join(placed.where("pos = 0").select("tree", "total"), "tree"), "tops")
    return Manifest(placed, rounds, tops, first.digest.hex() if first else None)


def fold(manifest: Manifest, presented: str = "presented") -> DataFrame:
    """``row``, ``subroot``, ``proof_sha256`` and ``folded_root`` of every leaf.

    ``presented`` is a column of the manifest's leaves: the digest in hex that is put in the leaf's place.
    """
    leaves = manifest.leaves.select(
        "tree", F.expr(f"pos div {BLOCK}").alias("block"), "pos", "row", F.unhex(presented).alias("presented")
    )
    if manifest.rounds:
        above = _above(manifest.rounds[0], 0, _paths(manifest.rounds, manifest.tops, 1).unionByName(
            manifest.tops.where(F.col("total") <= BLOCK).select("tree", F.lit(0).cast("long").alias("block"), "path", "subroot")
        ))
    else:
        above = _above(
            manifest.leaves.sparkSession.createDataFrame([], NODE), 0,
            manifest.tops.select("tree", F.lit(0).cast("long").alias("block"), "path", "subroot"),
        )
    pairs = leaves.groupBy("tree", "block").cogroup(above.groupBy("tree", "block"))
    return pairs.applyInArrow(_fold, "row long, subroot string, proof_sha256 string, folded_root string")


def field(column: Column) -> Column:
    text = column.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: Iterable[Column]) -> Column:
    """SHA-256 in hex of fields: ``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    return F.sha2(F.concat(*(field(x) for x in fields)), 256)


def verify(docs: DataFrame, tampered: Column, changed: Column) -> DataFrame:
    """``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified`` of each row.

    Rows become leaves of ``FIELDS``, with a tree for each ``lang``. Where ``tampered``, the leaf is folded with the text
    ``changed`` in place of ``text``; ``verified`` says whether the root stays the same. Null fields are part of
    the leaf, a null id comes first in its tree, rows that repeat an id are leaves of their own, ordered by
    digest. An empty table gives no rows. Further columns are ignored, texts are hashed whole.
    """
    own = leaf(F.col(c) for c in FIELDS)
    other = leaf(changed if c == "text" else F.col(c) for c in FIELDS)
    rows = docs.select("doc_id", "lang", own.alias("leaf"), F.when(tampered, other).alias("other"))
    rows = rows.select("doc_id", "lang", "leaf", F.coalesce("other", "leaf").alias("presented"))
    manifest = build(rows, "lang", ["doc_id"])
    folded = fold(manifest)
    return (
        manifest.leaves.select("row", "doc_id", "leaf")
        .join(folded, "row")
        .withColumn("root", F.lit(manifest.root))
        .withColumn("verified", F.col("folded_root") == F.col("root"))
        .select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    )


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _sql(levels: int = 9, upper: int = 6) -> str:
    """The same rows in DuckDB, level by level, for trees of up to 8 ** 9 leaves and 8 ** 6 trees."""
    part = lambda x: f"coalesce(strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR, '-')"
    hashed = lambda text: f"sha256({' || '.join(part(text if x == 'text' else x) for x in FIELDS)})"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    step = "xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))"
    digits = "flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), lambda a, x: {step}), 4294967295)"
    parts = [
        f"rows AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, coalesce('=' || lang, '') AS tree, {hashed('text')} AS leaf, "
        f"CASE WHEN {crc} % 3 = 0 THEN {hashed(f'({low})')} ELSE {hashed('text')} END AS presented FROM documents)",
        "placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM rows)",
        "n0 AS (SELECT tree, pos, leaf AS digest, count(*) OVER (PARTITION BY tree) AS c FROM placed)",
        "f0 AS (SELECT id, tree, pos, presented AS digest, '' AS proof FROM placed)",
    ]
    for k in range(levels + upper):
        if k == levels:  # from here on the trees are the leaves of one
            parts += [
                f"top AS MATERIALIZED (SELECT tree, row_number() OVER (ORDER BY tree) - 1 AS pos, digest FROM n{k})",
                f"m{k} AS (SELECT '' AS tree, pos, digest, count(*) OVER () AS c FROM top)",
                f"g{k} AS (SELECT id, '' AS tree, top.pos, f.digest, proof FROM f{k} f JOIN top USING (tree))",
            ]
        n, f = (f"m{k}", f"g{k}") if k == levels else (f"n{k}", f"f{k}")
        joined = "string_agg({}, '' ORDER BY n.pos)"
        parts += [
            f"n{k + 1} AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY tree) AS c FROM (SELECT tree, pos // 8 AS pos, "
            f"CASE WHEN any_value(c) = 1 THEN any_value(digest) ELSE sha256({joined.format('digest')}) END AS digest "
            f"FROM {n} n GROUP BY tree, n.pos // 8))",
            f"f{k + 1} AS MATERIALIZED (SELECT f.id, f.tree, f.pos // 8 AS pos, CASE WHEN any_value(n.c) = 1 THEN any_value(f.digest) "
            f"ELSE sha256({joined.format('CASE WHEN n.pos = f.pos THEN f.digest ELSE n.digest END')}) END AS digest, "
            f"any_value(f.proof) || coalesce(string_agg(n.digest, '' ORDER BY n.pos) FILTER (WHERE n.pos <> f.pos), '') AS proof "
            f"FROM {f} f JOIN {n} n ON n.tree = f.tree AND n.pos // 8 = f.pos // 8 GROUP BY f.id, f.tree, f.pos)",
        ]
    end = levels + upper
    return (
        "WITH " + ", ".join(parts) + " SELECT doc_id, leaf, top.digest AS subroot, r.digest AS root, sha256(f.proof) AS proof_sha256, "
        f"f.digest AS folded_root, f.digest = r.digest AS verified FROM rows JOIN top USING (tree) JOIN f{end} f USING (id), n{end} r"
    )


@query("op12_merkle_manifest", _sql())
def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Texts of ids whose CRC-32 is divisible by 3 are tampered with: their A-Z come in lower case."""
    docs = table(spark, sf, "documents")
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return verify(docs, picked, lowered(F.col("text")))
