"""Nearest neighbours by descent on a neighbour graph, and greedy search of that graph.

Every vector keeps a list of its nearest vectors found so far. Neighbours of a vector are likely to be
neighbours of each other: in each round a sample of every list, and of the vectors in whose lists it is, is joined
with itself, and each list takes what comes nearer than its last entry. Pairs of which both have been compared
before are left out, and the rounds end when few lists change. The first lists come from stretches of
random-projection orders.

A query starts at its own vector and keeps a beam of the nearest vectors found. In each round the nearest ones
not yet looked at are joined with the graph, in both directions of its edges, and what is nearer than the
beam's last entry enters; it ends when all of its beam has been looked at. Distances of the search are taken on
the vectors themselves, in double precision; only the building of the graph uses vectors rounded to a byte per
component, a quarter of what would travel otherwise.

All steps are joins and grouped maps over bounded groups; nothing grows on the driver. Equal vectors are one node of the
graph, so that a vector with any number of copies is searched once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowlens.llm.merkle import ranked
from flowlens.llm.queries import query, table
from flowlens.workspace import discard, materialize

#: Entries of a list; of these, so many new and so many old ones are joined in a round, and as many of the
#: lists it is in; so many of a member's nearest leave a join; rounds; share of changed entries at which they end.
DEGREE, SAMPLE, OFFERED, ROUNDS, QUIET = 20, 10, 8, 7, 0.02
#: Random orders for the first lists, vectors compared in one stretch of them, bits of an order.
ORDERS, STRETCH, BITS = 3, 256, 31
#: Entries of a query's beam, and how many are looked at in one round.
BEAM, WIDTH = 600, 100
#: Vectors turned over at once in a task.
ROWS = 1 << 13
OFFERS = "u long, v long, d double, fresh boolean"
LISTS = OFFERS + ", pick int, place int, worst double"


def usable(vector: Column) -> Column:
    """No null, no component that is null or not finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as the rows of an array."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def by_size(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Row numbers of equal size."""
    for size in np.unique(sizes):
        yield np.flatnonzero(sizes == size)


def rounded(vectors: np.ndarray) -> list[bytes]:
    """Each vector as a scale (8 bytes) and a byte per component."""
    scale = np.maximum(np.abs(vectors).max(axis=1) / 127, np.finfo(np.float64).tiny)
    codes = np.clip(np.rint(vectors / scale[:, None]), -127, 127).astype(np.int8)
    joined = np.concatenate([scale[:, None].view(np.int8), codes], axis=1)
    return [row.tobytes() for row in joined]


def restored(codes: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(codes), dtype=np.int8).reshape(len(codes), -1)
    return data[:, 8:] * np.ascontiguousarray(data[:, :8]).view(np.float64)


def squares(x: np.ndarray) -> np.ndarray:
    """Squared distances between the vectors of each group (g x m x dimension)."""
    norms = (x * x).sum(axis=-1)
    return np.maximum(norms[..., :, None] + norms[..., None, :] - 2 * (x @ np.swapaxes(x, -1, -2)), 0)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, shrink: Callable | None = None) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``key``; ``shrink`` keeps the open group small."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        if not len(rows):
            continue
        keys = rows[key].to_numpy()
        open_ = int(np.searchsorted(keys, keys[-1]))
        if open_ > ROWS // 4:
            yield rows.slice(0, open_)
            rest = rows.slice(open_)
        else:
            rest = rows
        if shrink and len(rest) > 4 * ROWS:
            rest = shrink(rest)
    if rest is not None and len(rest):
        yield rest


def nearest(degree: int, sample: int, turn: int):
    """Keeps the nearest ``degree`` of each ``u``, and picks those that are joined next."""

    def merge(rows: pa.Table) -> tuple[np.ndarray, ...]:
        u, v, d, fresh = (rows[c].to_numpy() for c in ("u", "v", "d", "fresh"))
        order = np.lexsort((d, fresh, v, u))  # a pair known before stays as it is
        u, v, d, fresh = u[order], v[order], d[order], fresh[order]
        once = np.append(True, (u[1:] != u[:-1]) | (v[1:] != v[:-1]))
        u, v, d, fresh = u[once], v[once], d[once], fresh[once]
        order = np.lexsort((v, d, u))
        u, v, d, fresh = u[order], v[order], d[order], fresh[order]
        place = np.arange(len(u)) - np.searchsorted(u, u)
        keep = place < degree
        return u[keep], v[keep], d[keep], fresh[keep], place[keep]

    def shrink(rows: pa.Table) -> pa.Table:
        u, v, d, fresh, _ = merge(rows)
        return pa.table({"u": u, "v": v, "d": d, "fresh": fresh}).cast(rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "u", shrink):
            u, v, d, fresh, place = merge(rows)
            # a random order within the new and within the old entries of each list
            chance = (u * 0x9E3779B1 ^ v * 0x85EBCA6B ^ turn * 0xC2B2AE35) % 0xFFFFFFFB
            order = np.lexsort((chance, fresh, u))
            first = np.append(True, (u[order][1:] != u[order][:-1]) | (fresh[order][1:] != fresh[order][:-1]))
            at = np.arange(len(u))
            rank = np.empty(len(u), dtype=np.int64)
            rank[order] = at - np.maximum.accumulate(np.where(first, at, 0))
            pick = np.where(rank < sample, np.where(fresh, 1, 2), 0)
            worst = np.full(len(u), np.inf)
            full = np.flatnonzero(place == degree - 1)
            worst[full - (degree - 1)] = d[full]
            made = {"u": u, "v": v, "d": d, "fresh": fresh, "pick": pick.astype(np.int32), "place": place.astype(np.int32), "worst": worst}
            yield pa.RecordBatch.from_pydict({k: pa.array(x) for k, x in made.items()})

    return run


def stretches(degree: int):
    """Each vector's nearest in a stretch of an order."""

    def run(rows: pa.Table) -> pa.Table:
        node, found = rows["node"].to_numpy(), []
        if len(node) > 1:
            d = squares(restored(rows["code"].to_pylist()))
            np.fill_diagonal(d, np.inf)
            near = np.argpartition(d, min(degree, len(node) - 1) - 1, axis=1)[:, : min(degree, len(node) - 1)]
            found = [np.repeat(node, near.shape[1]), node[near].ravel(), np.take_along_axis(d, near, 1).ravel()]
        else:
            found = [np.zeros(0, dtype=np.int64)] * 2 + [np.zeros(0)]
        return pa.table({"u": found[0], "v": found[1], "d": found[2], "fresh": np.ones(len(found[0]), dtype=bool)})

    return run


def joined(offered: int):
    """Compares the members of each center, the new ones with all, and offers each what is nearer than its last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "center"):
            center, member, fresh, worst = (rows[c].to_numpy() for c in ("center", "member", "fresh", "worst"))
            codes = rows["code"].to_pylist()
            for some in by_size(np.array([len(x) for x in codes])):
                start = np.flatnonzero(np.append(True, center[some][1:] != center[some][:-1]))
                sizes = np.diff(np.append(start, len(some)))
                # groups of the same number of members in one go
                for alike in by_size(sizes):
                    size = sizes[alike[0]]
                    if size < 2:
                        continue
                    for at in range(0, len(alike), max(1, ROWS // size)):
                        index = some[start[alike[at : at + max(1, ROWS // size)], None] + np.arange(size)]
                        d = squares(restored([codes[i] for i in index.ravel()]).reshape(*index.shape, -1))
                        new, who, limit = fresh[index], member[index], worst[index]
                        d[~(new[:, :, None] | new[:, None, :]) | (who[:, :, None] == who[:, None, :])] = np.inf
                        d[d >= limit[:, :, None]] = np.inf
                        many = min(offered, size - 1)
                        near = np.argpartition(d, many - 1, axis=2)[:, :, :many]
                        d = np.take_along_axis(d, near, 2)
                        u = np.broadcast_to(who[:, :, None], d.shape)
                        v = np.take_along_axis(np.broadcast_to(who[:, None, :], (*who.shape, size)), near, 2)
                        good = np.isfinite(d)
                        if good.any():
                            yield pa.RecordBatch.from_pydict(
                                {"u": u[good], "v": v[good], "d": d[good], "fresh": np.ones(int(good.sum()), dtype=bool)}
                            )

    return run


def _first_lists(nodes: DataFrame, degree: int) -> DataFrame:
    """Pairs that stand near each other in random-projection orders, each order of one dimension."""

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column(1).to_pylist()
            for some in by_size(np.array([len(x) for x in codes])):
                x = restored([codes[i] for i in some])
                for turn in range(ORDERS):
                    plane = np.random.default_rng([turn, x.shape[1]]).standard_normal((x.shape[1], BITS))
                    bits = ((x @ plane) > 0) @ (1 << np.arange(BITS, dtype=np.int64))
                    yield pa.RecordBatch.from_pydict({
                        "node": batch.column(0).take(some), "code": pa.array([codes[i] for i in some], pa.binary()),
                        "tree": pa.array([f"{turn}:{x.shape[1]}"] * len(some)), "bits": pa.array(bits),
                    })

    made = nodes.select("node", "code").mapInArrow(order, "node long, code binary, tree string, bits long")
    # the planes are drawn by dimension, not by row; ties follow a hash, not the ids
    placed = ranked(made.withColumn("chance", F.xxhash64("node", "tree")), "tree", ["bits", "chance", "node"])
    near = placed.groupBy("tree", F.expr(f"pos div {STRETCH}").alias("stretch"))
    return near.applyInArrow(stretches(degree), OFFERS)


def _lists(offers: DataFrame, degree: int, sample: int, turn: int) -> DataFrame:
    sorted_ = offers.repartition("u").sortWithinPartitions("u")
    return materialize(sorted_.mapInArrow(nearest(degree, sample, turn), LISTS), "lists")


def graph(nodes: DataFrame, degree: int = DEGREE, sample: int = SAMPLE, rounds: int = ROUNDS) -> DataFrame:
    """``u``, ``v`` and ``d`` (squared, of rounded vectors): the lists of all nodes.

    ``nodes`` has ``node`` and ``code``. Each round is written to the shared folder.
    """
    n = nodes.count()
    lists = _lists(_first_lists(nodes, degree), degree, sample, 0)
    for turn in range(1, rounds + 1):
        ahead = lists.where("pick > 0").select(
            F.col("u").alias("center"), F.col("v").alias("member"), (F.col("pick") == 1).alias("fresh")
        )
        back = ahead.select(F.col("member").alias("center"), F.col("center").alias("member"), "fresh")
        chance = Window.partitionBy("center", "fresh").orderBy(F.xxhash64("center", "member", F.lit(turn)))
        back = back.withColumn("place", F.row_number().over(chance)).where(F.col("place") <= sample).drop("place")
        both = ahead.unionByName(back).groupBy("center", "member").agg(F.max("fresh").alias("fresh"))
        limits = lists.where("place = 0").select(F.col("u").alias("member"), "worst")
        sides = nodes.select(F.col("node").alias("member"), "code").join(limits, "member")
        members = both.join(sides, "member").repartition("center").sortWithinPartitions("center")
        offers = members.mapInArrow(joined(OFFERED), OFFERS)
        # joined entries aren't new any more
        kept = lists.select("u", "v", "d", (F.col("fresh") & (F.col("pick") != 1)).alias("fresh"))
        older, lists = lists, _lists(kept.unionByName(offers), degree, sample, turn)
        discard(older)
        changed = lists.where("fresh").count()
        if changed <= QUIET * degree * n:
            break
    return lists.select("u", "v", "d")


BEAMS = "q long, near array<long>, d array<double>, looked array<boolean>, next array<long>, worst double"


def advance(beam: int, width: int):
    """A query's beam with what a round has found, and what is looked at next."""

    def run(state: pa.Table, found: pa.Table) -> pa.Table:
        if not len(state):
            return state.slice(0, 0)
        near, d, looked = (np.array(state[c][0].values.to_numpy(zero_copy_only=False)) for c in ("near", "d", "looked"))
        new, first = np.unique(found["node"].to_numpy(), return_index=True)
        fresh = ~np.isin(new, near)
        near = np.append(near, new[fresh])
        d = np.append(d, found["d"].to_numpy()[first[fresh]])
        looked = np.append(looked, np.zeros(int(fresh.sum()), dtype=bool))
        order = np.lexsort((near, d))[:beam]
        near, d, looked = near[order], d[order], looked[order].astype(bool)
        following = np.flatnonzero(~looked)[:width]
        looked[following] = True
        worst = d[-1] if len(d) == beam else np.inf
        made = {"q": [state["q"][0].as_py()], "near": [near], "d": [d], "looked": [looked], "next": [near[following]], "worst": [worst]}
        types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.float64()]
        return pa.table([pa.array(x, t) for x, t in zip(made.values(), types)], names=list(made))

    return run


def _far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Squared distances of found nodes that may enter their query's beam."""
    for batch in batches:
        for some in by_size(batch["vector"].value_lengths().to_numpy()):
            part = batch.take(pa.array(some))
            d = ((matrix(part["vector"]) - matrix(part["own"])) ** 2).sum(axis=1)
            good = np.flatnonzero(d < part["worst"].to_numpy())
            yield pa.RecordBatch.from_pydict({"q": part["q"].take(pa.array(good)), "node": part["node"].take(pa.array(good)), "d": pa.array(d[good])})


def search(nodes: DataFrame, edges: DataFrame, queries: DataFrame, beam: int = BEAM, width: int = WIDTH) -> DataFrame:
    """``q`` and ``near``, ``d`` (squared): the beam of every query at its end, nearest first, itself included.

    ``queries`` has ``q``, the node that a search starts from, and ``own``, its vector. The graph is searched in both
    directions of its edges.
    """
    turned = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    around = materialize(edges.select("u", "v").unionByName(turned).distinct(), "around")
    places = nodes.select("node", "vector")
    start = queries.select(
        "q", F.array("q").alias("near"), F.array(F.lit(0.0)).alias("d"), F.array(F.lit(True)).alias("looked"),
        F.array("q").alias("next"), F.lit(float("inf")).alias("worst"),
    )
    state, older = materialize(start, "beams"), None
    while state.where(F.size("next") > 0).limit(1).count():
        asked = state.select("q", F.explode("next").alias("u")).join(around, "u").select("q", F.col("v").alias("node"))
        limits = queries.join(state.where(F.size("next") > 0).select("q", "worst"), "q")
        pairs = asked.join(places, "node").join(limits, "q")
        found = pairs.select("q", "node", "vector", "own", "worst").mapInArrow(_far, "q long, node long, d double")
        older = state
        moved = state.groupBy("q").cogroup(found.select(F.col("q").alias("for"), "node", "d").groupBy("for"))
        state = materialize(moved.applyInArrow(advance(beam, width), BEAMS), "beams", replaces=older)
    return state.select("q", "near", "d")


def neighbours(
    vectors: DataFrame, chosen: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    beam: int = BEAM, width: int = WIDTH,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` nearest rows found for each row that is ``chosen``.

    Nearness is Euclidean distance, ``score`` that distance in double precision; ties go to the smaller id, a row is no
    neighbour of its own id. Found means that the search may miss some; with ``k`` or fewer other rows of the
    dimension all are found. Rows without an id, and vectors that are null, zero or hold a null or
    non-finite component take no part. Vectors of different dimensions have no distance. Equal rows count once; an id
    that has several vectors is a row for each. An empty table gives no rows; further columns are ignored.
    """
    rows = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), chosen.alias("chosen")
    )
    # equal vectors have equal hashes of 128 bits
    rows = rows.select("id", "vector", "chosen", F.xxhash64("vector").alias("a"), F.xxhash64(F.lit(7), "vector").alias("b"))
    rows = materialize(rows, "vectors")
    place = F.row_number().over(Window.partitionBy("a", "b").orderBy("id"))
    # of equal vectors no more than k + 1 can be among the k nearest of any query
    copies = rows.select("a", "b", "id").distinct().withColumn("place", place).where(F.col("place") <= k + 1)
    copies = copies.groupBy("a", "b").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    once = rows.groupBy("a", "b").agg(F.any_value("vector").alias("vector"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[bytes] = [b""] * batch.num_rows
            for some in by_size(batch["vector"].value_lengths().to_numpy()):
                for i, x in zip(some, rounded(matrix(batch["vector"].take(pa.array(some))))):
                    made[i] = x
            yield batch.append_column("code", pa.array(made, pa.binary()))

    # an id may have several vectors, so a node is a number of its own
    kind = rows.schema["vector"].dataType.simpleString()
    nodes = copies.join(once, ["a", "b"]).mapInArrow(code, f"a long, b long, ids array<long>, vector {kind}, code binary")
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    asking = rows.where("chosen").select("a", "b", F.col("id").alias("query_id")).distinct()
    queries = asking.select("a", "b").distinct().join(nodes, ["a", "b"])
    queries = materialize(queries.select("a", "b", F.col("node").alias("q"), F.col("vector").alias("own")), "queries")
    beams = search(nodes, graph(nodes), queries.select("q", "own"), beam, width)
    last = F.coalesce(F.get("d", F.lit(k)), F.array_max("d"))
    near = beams.select("q", F.explode(F.filter(F.arrays_zip("near", "d"), lambda x: x.d <= last)).alias("x"))
    near = near.select("q", F.col("x.near").alias("node"), F.sqrt("x.d").alias("score"))
    near = near.join(nodes.select("node", "ids"), "node").select("q", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("q").orderBy("score", "vec_id")
    near = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    near = near.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("near"))
    found = asking.join(queries.select("a", "b", "q"), ["a", "b"]).join(near, "q")
    other = F.filter("near", lambda x: x.vec_id != F.col("query_id"))
    found = found.select("query_id", F.posexplode(F.slice(other, 1, k)))
    return found.select("query_id", (F.col("pos") + 1).alias("rank"), "col.vec_id", "col.score")


@query("op13_neighbours")
def op13_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)
