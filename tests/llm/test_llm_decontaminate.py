import math
import random
from collections import Counter

import pytest
from fixtures import ROWS, edge_docs, no_docs, table_of
from pyspark.sql import functions as F

from flowlens.llm import decontaminate as D


def vocabulary(rnd, n=300):
    return ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(n)] + ["the", "of"] * 40


def items_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def made_up(seed=1, items=60, docs=150):
    rnd = random.Random(seed)
    words = vocabulary(rnd)
    some = lambda n: [rnd.choice(words) for _ in range(n)]
    bench = [" ".join(some(rnd.randint(8, 45))).capitalize() + "?\nIt is " + " ".join(some(rnd.randint(1, 10))) + "." for _ in range(items)]
    texts = []
    for i in range(docs):
        own = some(rnd.randint(0, 400))
        at = rnd.randint(0, len(own))
        item = bench[rnd.randrange(items)]
        if i % 3 == 0:  # the whole item, in other letters and signs
            own[at:at] = item.upper().replace(" ", ", ").split(" ")
        elif i % 3 == 1:  # an item with one word changed, or its half
            part = item.split()
            part = part[: len(part) // 2] if i % 2 else part[:-1] + ["other"]
            own[at:at] = part
        texts.append(" ".join(own))
    return bench, texts


def overlaps(text, item):
    found, wanted = D.shingles(D.words_of(text.lower())), D.shingles(D.words_of(item.lower()))
    return len(found & wanted) / len(wanted) if wanted else 0


def test_matches_equal_brute_force(spark):
    bench, texts = made_up()
    rows = D.matches(table_of(spark, texts), items_of(spark, bench)).collect()
    got = {(r.doc_id, r.item_id): r.overlap for r in rows}
    want = {(d, i): x for d, t in enumerate(texts) for i, b in enumerate(bench) if (x := overlaps(t, b)) >= D.OVERLAP}
    assert len(rows) == len(got) and set(got) == set(want) and len(want) >= 50
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_retrieval_is_exact(spark, monkeypatch):
    bench, texts = made_up(2)
    words = [D.words_of(b.lower()) for b in bench]
    df = Counter(w.decode() for own in words for w in set(own))
    mean = sum(map(len, words)) / len(words)
    index = D.Index(list(enumerate(b.lower() for b in bench)), len(bench), mean, df)
    passages = [D.words_of(t.lower())[: 2 * index.stride] for t in texts]
    hashes = [D.W.hash_of(w) for p in passages for w in p]
    place = [i for i, p in enumerate(passages) for _ in p]
    import numpy as np

    for cells in (1 << 21, 100):
        monkeypatch.setattr(D, "CELLS", cells)
        got = {
            (p, d)
            for p, block in index.opened(np.array(hashes, dtype=np.uint64), np.array(place), len(passages))
            for d, _ in index.retrieved(passages[p], block)
        }

        def bm25(passage, own):
            total = 0
            for w, f in Counter(own).items():
                idf = math.log(1 + (len(bench) - df[w.decode()] + 0.5) / (df[w.decode()] + 0.5))
                total += (w in passage) * idf * f * (D.K1 + 1) / (f + D.K1 * (1 - D.B + D.B * len(own) / mean))
            return total

        want = {(p, d) for p, passage in enumerate(passages) for d, own in enumerate(words)
                if bm25(set(passage), own) / bm25(set(own), own) >= D.THRESHOLD}
        assert got == want and len(want) > 30


@pytest.mark.parametrize("size", [300, 2000])
def test_shards_give_the_same_rows(spark, monkeypatch, size):
    bench, texts = made_up(3, 20, 60)
    whole = D.matches(table_of(spark, texts), items_of(spark, bench)).orderBy("doc_id", "item_id").collect()
    monkeypatch.setattr(D, "INDEX_BYTES", size)
    cut = D.matches(table_of(spark, texts), items_of(spark, bench)).orderBy("doc_id", "item_id").collect()
    assert cut == whole and whole


def test_question_and_answer():
    assert D.parts_of("What is it? A cat.") == ("What is it?", " A cat.")
    assert D.parts_of("One. Two two. Three") == ("One. Two two.", " Three")
    assert D.parts_of("only this") == ("only this", "")


def test_edges(spark):
    docs = edge_docs(spark)
    bench = [ROWS[0][1].upper(), None, "", "...", "one", ROWS[0][1], "erst the onth and of erst the onth and of erst"]
    items = items_of(spark, bench).withColumn("doc_id", F.lit(7)).withColumn("id", F.lit("x"))
    got = sorted((r.doc_id, r.item_id) for r in D.matches(docs, items).collect())
    assert got == sorted([(1, 0), (1, 5), (2, 0), (2, 0), (2, 5), (2, 5), (5, 4), (7, 6)])
    kept = D.clean(docs, items)
    assert sorted(kept.columns) == sorted(docs.columns)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["3", "4", "6", "8", "9", "10", "None"])
    assert D.matches(no_docs(spark), items).count() == 0
    none = items.where("item_id < 0")
    assert D.matches(docs, none).count() == 0 and D.clean(docs, none).count() == len(ROWS)


@pytest.mark.parametrize("between", ["Answer:", "The right answer to this, as all of us should know by now, is"])
def test_a_marker_between_question_and_answer_hides_nothing(spark, between):
    rnd = random.Random(9)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(400)]
    some = lambda n: " ".join(rnd.sample(words, n))
    bench = [(some(10 + 4 * i) + "?", some(5) + ".") for i in range(6)]
    texts = [f"{some(i * 7)} {q} {between} {a} {some(100)}" for i, (q, a) in enumerate(bench * 6)]
    texts += [f"{some(50)} {q} {some(100)}" for q, _ in bench[:2]]  # without the answer
    rows = D.matches(table_of(spark, texts), items_of(spark, [f"{q} {a}" for q, a in bench])).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(i, i % 6) for i in range(36)]
    assert all(r.question_overlap == r.answer_overlap == 1 for r in rows)
    assert any(r.overlap < D.OVERLAP for r in rows)
