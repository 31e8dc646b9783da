import collections
import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from fixtures import ROWS, edge_docs, no_docs, table_of
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from flowlens.llm import align, bpe

FIRST, SECOND = bpe.default_vocabulary(), align.default_model()
A = Tokenizer.from_file(FIRST)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=SECOND)
NAMES = bpe.byte_names()


@pytest.fixture(scope="module")
def own():
    with open(FIRST, encoding="utf-8") as file, open(SECOND, "rb") as model:
        return align.aligner(file.read(), model.read())


def sides(text):
    """(id, start, end) of both sides' tokens by the two libraries, or nothing."""
    if not text:
        return [], []
    a = [(i, bytes(NAMES[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = [
        (i, bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode())
        for i in B.encode(text) for p in [B.id_to_piece(i)]
    ]
    if not b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
        return [], []
    found = []
    for side in (a, b):
        at, spans = 0, []
        for i, x in side:
            spans.append((i, at, at + len(x)))
            at += len(x)
        found.append(spans)
    return tuple(found)


def grouped(a, b):
    ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
    found, start = [], 0
    for end in ends:
        found.append(tuple([i for i, s, e in side if start <= s and e <= end] for side in (a, b)))
        start = end
    return found


def overlaps(a, b):
    return [(i, j) for i, s, e in a for j, t, f in b if max(s, t) < min(e, f)]


def brute(texts):
    split = [sides(t) for t in texts]
    pairs = [overlaps(*x) for x in split]
    counts = collections.Counter(p for x in pairs for p in x)
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    found = []
    for (a, b), own in zip(split, pairs):
        groups = grouped(a, b)
        text = ";".join("|".join(",".join(map(str, s)) for s in g) for g in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if a else ""
        found.append((len(a), len(b), len(groups), len(own), sum(counts[p] == best[p[1]] for p in own), sum(counts[p] for p in own), digest))
    return found


def odd_texts():
    rnd = random.Random(11)
    alphabets = ["ab", "aeiou thr", "  \n\t", "=-_#* ", "éàü ß中文字 ", "0123456789 ,.", "'s't're'll ", "xyz<|endoftext|></s><s>", "▁ a", "\U0001f600 é \x00"]
    texts = ["".join(rnd.choice(x) for _ in range(n)) for x in alphabets for n in (1, 3, 40, 300)]
    return [*texts, None, "", " ", "Hello   world", "Hello   world", "<unk> <0x41> a", "x" * 500]


def test_tokens_equal_both_libraries(own):
    for text in odd_texts():
        a, b = sides(text)
        got = own.tokens(text)
        assert [i for x, _ in got for i in x] == [i for i, _, _ in a] and [i for _, y in got for i in y] == [i for i, _, _ in b]


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_groups_of_any_text(text):
    with open(FIRST, encoding="utf-8") as file, open(SECOND, "rb") as model:
        own = align.aligner(file.read(), model.read())
    assert own.groups(text) == grouped(*sides(text))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(1, 40)), st.sets(st.integers(1, 40))), min_size=1, max_size=4))
def test_cuts_are_all_common_ends(texts):
    a, b, a_to, b_to = [], [], [], []
    for k, (x, y) in enumerate(texts):
        a += [100 * k + e for e in sorted(x | {50})]
        b += [100 * k + e for e in sorted(y | {50})]
        a_to.append(len(a))
        b_to.append(len(b))
    got = align.common_ends(*map(np.array, (a, b, a_to, b_to)))
    common = sorted(set(a) & set(b))
    assert [a[i - 1] for i in got[0]] == common and [b[i - 1] for i in got[1]] == common


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(1, 10**6)), max_size=50, unique_by=lambda x: x[0]))
def test_packed_pairs_come_back(pairs):
    number, times = (np.array(x, dtype=np.int64) for x in (zip(*sorted(pairs)) if pairs else ((), ())))
    got = align.unsqueeze(align.squeeze(number, times))
    assert got[0].tolist() == number.tolist() and got[1].tolist() == times.tolist()


@pytest.mark.parametrize("small", [False, True])
def test_result_equals_brute_force(spark, monkeypatch, small):
    texts = odd_texts()
    if small:  # the settings travel with the function only in a local run of it
        monkeypatch.setattr(align, "RUN_BYTES", 50)
    want = brute(texts)
    with open(FIRST, encoding="utf-8") as file, open(SECOND, "rb") as model:
        packet = align.Packet(align.aligner(file.read(), model.read()))
    for n, text in enumerate(texts):
        packet.add(n, text)
    packet.align()
    assert [(r[1], r[2], r[3], r[4], r[5].hexdigest() if r[6] else "") for r in packet.rows] == [(*w[:4], w[6]) for w in want]
    if not small:
        rows = sorted(align.align(table_of(spark, texts).repartition(5), FIRST, SECOND).collect())
        assert [tuple(r[1:]) for r in rows] == want


def test_long_texts_are_cut_between_words(own, monkeypatch):
    text = "The cat's 12 dogs,  and  the rest.\n " * 300 + "x" * 500
    whole = own.groups(text)
    assert whole == grouped(*sides(text))
    for size in (1, 10, 333):
        monkeypatch.setattr(bpe, "PIECE", size)
        assert own.groups(text) == whole


def test_long_words_and_long_spaces(own):
    for text in ("ab" * 300_000, " " * 1_000_000, "\n" * 300_000):
        assert sum(len(x) for x, _ in own.groups(text)) > 0


def test_edges(spark):
    rows = align.align(edge_docs(spark), FIRST, SECOND).collect()
    want = collections.Counter(zip([r[0] for r in ROWS], brute([r[1] if len(r[1] or "") < 50_000 else "" for r in ROWS])))
    keep = lambda x: (x[0], *x[1:5], x[7])
    got = collections.Counter(keep(r) for r in rows if r.doc_id != 7)
    assert got == collections.Counter({keep((i, *w)): n for (i, w), n in want.items() if i != 7}) and len(rows) == len(ROWS)
    assert align.align(no_docs(spark), FIRST, SECOND).count() == 0
