import hashlib
import random
import zlib

import numpy as np
import pytest
from fixtures import ROWS, edge_docs, no_docs
from pyspark.sql import functions as F

from flowlens.llm import merkle

LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf(row, text):
    fields = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return sha(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))


def tree(leaves):
    """Root and, per leaf, the siblings up to it."""
    level, at, proofs = leaves, list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for i, pos in enumerate(at):
            run = pos // 8 * 8
            proofs[i] += [x for j, x in enumerate(level[run : run + 8], run) if j != pos]
            at[i] = pos // 8
        level = [sha(*level[k : k + 8]) for k in range(0, len(level), 8)]
    return level[0], proofs


def refold(leaves, i, value):
    return tree([*leaves[:i], value, *leaves[i + 1 :]])[0]


def brute(rows):
    langs = {}
    for row in rows:
        own = leaf(row, row["text"])
        text = row["text"]
        if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0 and text is not None:
            text = text.translate(LETTERS)
        langs.setdefault(row["lang"], []).append((row["doc_id"], own, leaf(row, text)))
    names = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    for name in names:
        langs[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {n: tree([x[1] for x in langs[n]]) for n in names}
    subroots = [trees[n][0] for n in names]
    root, upper = tree(subroots)
    found = []
    for k, name in enumerate(names):
        own = [x[1] for x in langs[name]]
        for i, (doc, digest, presented) in enumerate(langs[name]):
            folded = refold(subroots, k, refold(own, i, presented))
            proof = sha(*trees[name][1][i], *upper[k])
            found.append((doc, digest, subroots[k], root, proof, folded, folded == root))
    return sorted(found, key=repr)


def verified(docs):
    low = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return merkle.verify(docs, low, merkle.lowered(F.col("text")))


def test_constants_and_states_equal_the_library():
    rnd = random.Random(4)
    digests = np.frombuffer(rnd.randbytes(32 * 50), dtype=np.uint8).reshape(50, 32)
    arity, made, children, states = merkle.parents(digests)
    assert arity.tolist() == [8] * 6 + [2]
    for i in range(7):
        run = [digests[8 * i + k].tobytes().hex() for k in range(arity[i])]
        assert made[i].tobytes().hex() == sha(*run)
        for k in range(arity[i]):
            other = rnd.randbytes(32)
            state = merkle.as_state(states[i : i + 1, k])
            new = merkle.resume(state, np.array([k]), arity[i : i + 1], np.frombuffer(other, np.uint8).reshape(1, 32), children[i : i + 1])
            assert new[0].tobytes().hex() == sha(*run[:k], other.hex(), *run[k + 1 :])


def test_folding_reads_right_siblings_only():
    digests = np.arange(8 * 32, dtype=np.uint8).reshape(8, 32)
    arity, _, children, states = merkle.parents(digests)
    spoilt = children.copy()
    spoilt[0, :3] = 7
    args = (np.array([3]), arity, digests[3:4])
    one, two = (merkle.resume(merkle.as_state(states[:, 3]), *args, x) for x in (children, spoilt))
    assert (one == two).all()


@pytest.mark.parametrize("n", [1, 9, 700])
def test_equal_brute_force_in_small_blocks(spark, monkeypatch, n):
    monkeypatch.setattr(merkle, "LEVELS", 1 if n < 100 else 2)
    monkeypatch.setattr(merkle, "BLOCK", 8 if n < 100 else 64)
    rnd = random.Random(n)
    rows = [
        {"doc_id": i * 3 + 1, "text": rnd.choice("AbCdé") * rnd.randint(0, 5), "source": "s", "n_chars": i,
         "lang": rnd.choice(["en"] * 8 + ["de", "fr", None, "", "é", "zz"])}
        for i in range(n)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, lang string")
    found = verified(docs.repartition(5))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(rows)


def test_many_languages(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    rows = [{"doc_id": i, "text": "A", "source": None, "n_chars": 1, "lang": f"l{i % 150}"} for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, lang string")
    assert sorted((tuple(r) for r in verified(docs).collect()), key=repr) == brute(rows)


def test_nulls_repeats_clashes_and_empty_tables(spark):
    docs = edge_docs(spark).withColumns({c: F.lit("x") for c in ("tree", "pos", "total", "row", "leaf", "digest", "level")})
    rows = [r.asDict() for r in docs.collect()]
    found = verified(docs)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(rows)
    assert found.count() == len(ROWS)
    assert verified(no_docs(spark)).count() == 0


def test_order_of_rows_and_partitions_does_not_matter(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    roots = {merkle.verify(d, F.lit(False), F.col("text")).agg(F.min("root"), F.max("folded_root")).first() for d in (docs, docs.repartition(7))}
    assert len(roots) == 1 and len(set(roots.pop())) == 1
