import random

import numpy as np
from fixtures import ROWS, edge_docs, no_docs, table_of

from flowlens.llm import components, simhash


def groups(marks):
    """Smallest index reachable over all pairs at 4 or fewer differing bits."""
    up = list(range(len(marks)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(marks):
        for j in range(i):
            if (a ^ marks[j]).bit_count() <= 4 and root(i) != root(j):
                up[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(marks))]


def crowd(n, seed=1):
    rnd = random.Random(seed)
    centres = [rnd.getrandbits(64) for _ in range(6)] + [0, 2**64 - 1]
    return sorted({rnd.choice(centres) ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 6))) for _ in range(n)})


def test_fingerprint_by_its_definition():
    import xxhash

    text = "Aa b\tC d\x0be   f g É a b c d"
    words = [w for w in text.replace("A", "a").replace("C", "c").replace("\t", " ").replace("\x0b", " ").split(" ") if w]
    hashes = [xxhash.xxh64(" ".join(words[i : i + 4]).encode(), 42).intdigest() for i in range(len(words) - 3)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text) == want
    assert simhash.fingerprint("one two") == xxhash.xxh64(b"one two", 42).intdigest()
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


def test_bits_are_counted_over_all_parts(monkeypatch):
    hashes = np.random.default_rng(3).integers(0, 2**63, 1001, dtype=np.uint64)
    whole = simhash.majority(hashes)
    monkeypatch.setattr(simhash, "BIT_ROWS", 7)
    assert simhash.majority(hashes) == whole


def test_groups_of_variants_find_every_link(monkeypatch):
    marks = crowd(300)
    own = np.array(marks, dtype=np.uint64)
    for k, limit in ((6, 1 << 22), (13, 1 << 22), (6, 1000)):
        monkeypatch.setattr(simhash, "SORTED_VARIANTS", limit)
        errors, parity = simhash.group_errors(k), simhash.parities(own, simhash.blocks(k))
        assert sum(map(len, errors.values())) == 2081 and len(errors) == 1 + k + k * (k - 1) // 2
        labels = np.arange(len(own))
        for group in sorted({int(p) ^ d for p in parity for d in errors}):
            mine = np.flatnonzero([int(p) ^ group in errors for p in parity])
            local = simhash.linked(own[mine], group, k)
            labels = simhash.merge(labels, mine, mine[local])
        assert labels.tolist() == groups(marks)


def test_links_and_components_equal_brute_force(spark):
    marks = crowd(500, 2)
    signed = [m - 2**64 if m >> 63 else m for m in marks]
    frame = spark.createDataFrame([(m,) for m in signed], "fp long")
    roots = {r.node: r.root for r in components.components(simhash.links(frame), "a", "b").collect()}
    want = groups(marks)
    same = {}
    for mark, group in zip(signed, want):
        same.setdefault(group, set()).add(roots.get(mark, mark))
    assert all(len(x) == 1 for x in same.values()) and len({min(x) for x in same.values()}) == len(same)


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 100), (200, None), (300, 301), (301, 300)]
    star = [(1000, 1000 + i) for i in range(1, 80)]
    edges = spark.createDataFrame(chain + star, "a long, b long")
    got = {r.node: r.root for r in components.components(edges, "a", "b").collect()}
    assert got == {i: 0 for i in range(61)} | {300: 300, 301: 300} | {1000 + i: 1000 for i in range(80)}
    assert components.components(edges.where("a < 0"), "a", "b").count() == 0


def test_near_duplicates_equal_brute_force(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    texts = []
    for _ in range(25):
        words = [word() for _ in range(400)]
        for _ in range(4):
            words[rnd.randrange(400)] = word()
            texts.append(" ".join(words))
    texts += [None, "", texts[0]]
    rows = {r.doc_id: r for r in simhash.near_duplicates(table_of(spark, texts)).collect()}
    marks = [simhash.fingerprint(t) for t in texts]
    assert [rows[i].fingerprint for i in range(len(texts))] == [f"{m:016x}" for m in marks]
    assert [rows[i].component_id for i in range(len(texts))] == groups(marks)
    assert len(set(groups(marks))) < 90


def test_edges(spark):
    docs = edge_docs(spark)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(ROWS) - 1
    component = {r.doc_id: r.component_id for r in rows}
    assert component[2] == component[1] == 1 and component[4] == component[6] == component[3] == 3
    kept = simhash.one_of_each(docs)
    assert sorted(kept.columns) == sorted(docs.columns)
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == sorted({i for i, c in component.items() if i == c})
    assert simhash.near_duplicates(no_docs(spark)).count() == 0 and simhash.one_of_each(no_docs(spark)).count() == 0
