import hashlib
import random

import numpy as np
from fixtures import ROWS, edge_docs, no_docs, table_of

from flowlens.llm import syncmers as S
from flowlens.llm import words as W


def text_of(n, seed):
    rnd = random.Random(seed)
    return "".join(rnd.choice("abcdefghijklmnop é\n") for _ in range(n))


def anchors_of(text):
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    at, hashes, _ = S.select(raw, np.array([0, len(raw)]), W.Powers())
    return dict(zip(at.tolist(), hashes.tolist()))


def test_anchors_by_their_definition():
    text = text_of(400, 1).encode()
    raw = np.frombuffer(text, dtype=np.uint8)

    def polynomial(part):
        return sum(int(W.BYTE_VALUES[b]) * pow(W.BASE, j, 2**64) for j, b in enumerate(part)) % 2**64

    def inner(i):
        value = polynomial(text[i : i + S.S])
        return (value ^ value >> 29) * 0x94D049BB133111EB % 2**64

    want = []
    for i in range(len(text) - S.K + 1):
        row = [inner(i + j) for j in range(S.INNER)]
        if min(row) in (row[0], row[-1]):
            want.append((i, int(W.mix(np.array([polynomial(text[i : i + S.K])], dtype=np.uint64))[0]) >> 32))
    at, hashes, _ = S.select(raw, np.array([0, len(raw)]), W.Powers())
    assert list(zip(at.tolist(), hashes.tolist())) == want and len(want) > 60


def test_anchors_do_not_depend_on_what_is_around():
    a, b, c = text_of(500, 2), text_of(800, 3), text_of(100, 4)
    first, second = anchors_of(a + b), anchors_of(c + b)
    shift = len(c.encode()) - len(a.encode())
    inside = {at + shift: h for at, h in first.items() if at >= len(a.encode())}
    assert inside and inside == {at: h for at, h in second.items() if at >= len(c.encode())}


def test_texts_of_a_batch_do_not_mix():
    texts = [text_of(n, n) for n in (0, 3, 15, 16, 17, 300, 0, 1000)]
    whole = S.sketches(texts, W.Powers())
    for text, sketch in zip(texts, whole):
        assert S.sketches([text], W.Powers())[0].tolist() == sketch.tolist()
        assert S.from_text(S.as_text(sketch)).tolist() == sketch.tolist()
        assert (len(sketch) > 0) == (text != "")


def test_likeness_follows_the_shared_part():
    powers = W.Powers()
    base = text_of(20_000, 5)
    for kept in (0.25, 0.5, 0.75, 1.0):
        n = int(len(base) * kept)
        other = base[:n] + text_of(len(base) - n, 6)
        a, b = S.sketches([base, other], powers)
        assert abs(S.likeness(a, b) - kept) < 0.2
    assert S.likeness(a, a) == 1 and S.likeness(a[:0], a[:0]) == 1 and S.likeness(a, a[:0]) == 0


def plain(rows):
    powers, found = W.Powers(), []
    rows = sorted((i, t or "") for i, t in rows)
    for n, (i, text) in enumerate(rows):
        following = rows[(n + 1) % len(rows)][1]
        q = len(text) // 4
        edited = text[: len(text) - q] + following[:q]
        a, b, c = (S.sketches([t], powers)[0] for t in (text, edited, following))
        found.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), S.as_text(a), S.as_text(b), S.likeness(a, b), S.likeness(a, c)))
    return sorted(found)


def test_edited_texts_equal_brute_force(spark, monkeypatch):
    rnd = random.Random(7)
    rows = [(rnd.randint(-500, 5000) * 3, text_of(rnd.choice([0, 1, 5, 40, 400, 3000]), i)) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert sorted(map(tuple, S.compare_with_edited(frame).collect())) == plain(rows)
    monkeypatch.setattr(S, "CHARS", 500)
    assert sorted(map(tuple, S.compare_with_edited(frame).collect())) == plain(rows)
    one = table_of(spark, ["only this text is there, and nothing else"])
    assert [tuple(r) for r in S.compare_with_edited(one).collect()] == plain([(0, "only this text is there, and nothing else")])


def test_edges(spark):
    docs = edge_docs(spark)
    rows = [(i, t) for i, t, *_ in ROWS if i is not None]
    assert sorted(map(tuple, S.compare_with_edited(docs).collect())) == plain(rows)
    marks = {r.doc_id: r.fingerprint for r in S.fingerprints(docs).collect()}
    assert marks[1] == marks[2] and marks[3] == marks[4] == "" and marks[5]
    own = S.anchors(docs).where("doc_id = 1").collect()
    assert {r.position: r.anchor for r in own} == anchors_of(ROWS[0][1])
    for empty in (S.compare_with_edited, S.fingerprints, S.anchors):
        assert empty(no_docs(spark)).count() == 0


def test_long_texts_keep_their_places(spark):
    powers = W.Powers()
    one, two, shared = text_of(60_000, 11), text_of(60_000, 12), text_of(4_000, 13)
    a, b, plain_two = S.sketches([one + shared, shared + two, two], powers)
    assert len(a) > 1000 and S.likeness(a, plain_two) == 0
    assert abs(S.likeness(a, b) - 4 / 64) < 0.02  # a passage in another place of another long text
    places = anchors_of(one + shared)
    assert all(places[int(x) >> 32] == int(x) & 0xFFFFFFFF for x in a)


def test_reordered_text_is_not_the_original(spark):
    rnd = random.Random(14)
    parts = [text_of(40, i) for i in range(400)]
    other = parts[:]
    rnd.shuffle(other)
    a, b = S.sketches(["".join(parts), "".join(other)], W.Powers())
    assert S.likeness(a, a) == 1 and S.likeness(a, b) < 0.8
