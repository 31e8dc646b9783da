import math
import random
from collections import Counter

import numpy as np
import pytest
from fixtures import ROWS, edge_docs, no_docs, word_runs

from flowlens.llm import lm


def plain(rows):
    docs = [(i, word_runs(t)) for i, t in rows]
    single = Counter(w for _, words in docs for w in words)
    double = Counter(p for _, words in docs for p in zip(words, words[1:]))
    total = sum(single.values())
    found = []
    for i, words in docs:
        own, pairs = Counter(words), Counter(zip(words, words[1:]))
        rest, score, backed_off = max(1, total - len(words)), 0.0, 0
        share = lambda w: math.log(((single[w] - own[w]) or lm.BACKOFF) / rest)  # noqa: B023, E731
        for before, w in zip([None, *words], words):
            n = 0 if before is None else double[before, w] - pairs[before, w]
            if n:
                score += math.log(n / (single[before] - own[before]))
            else:
                score += share(w) + (math.log(lm.BACKOFF) if before is not None else 0)
                backed_off += before is not None
        found.append((i, len(words), round(score, 6), round(score / len(words), 6) if words else None, backed_off))
    return sorted(found, key=str)


def got(docs):
    rows = lm.score(docs).collect()
    return sorted(((r[0], r[1], round(r[2], 6), None if r[3] is None else round(r[3], 6), r[4]) for r in rows), key=str)


@pytest.mark.parametrize("packet, bucket", [(8 << 20, 7 << 20), (500, 900)])
def test_scores_equal_brute_force(spark, monkeypatch, packet, bucket):
    monkeypatch.setattr(lm, "PACKET_BYTES", packet)
    monkeypatch.setattr(lm, "BUCKET_BYTES", bucket)
    monkeypatch.setattr(lm.W, "CHUNK_BYTES", 200)
    rnd = random.Random(3)
    words = ["the"] * 30 + ["w" + str(i) for i in range(60)]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 2, 30, 200])))) for i in range(120)]
    rows += [(1, "The THE the"), (500, None), (501, "never seen before"), (502, rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(docs) == plain(rows)


def test_packing_keeps_numbers():
    for values in ([], [0], [2**63, 1, 2**64 - 1], list(range(1000))):
        own = np.array(values, dtype=np.uint64)
        assert lm.unpacked(lm.packed(own), len(own)).tolist() == values


def test_edges(spark):
    rows = [(i, t) for i, t, *_ in ROWS if i is not None]
    assert got(edge_docs(spark)) == plain(rows)
    assert lm.score(no_docs(spark)).count() == 0
    assert got(edge_docs(spark, [(1, "one", "en", "s")])) == plain([(1, "one")])
    assert got(edge_docs(spark, [(1, None, "en", "s"), (2, "", "en", "s")])) == [(1, 0, 0.0, None, 0), (2, 0, 0.0, None, 0)]
