import random

import pytest
from fixtures import ROWS, edge_docs, no_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from flowlens.llm import bpe

PATH = bpe.default_vocabulary()


@pytest.fixture(scope="module")
def own():
    with open(PATH, encoding="utf-8") as file:
        return bpe.transducer(file.read())


LIBRARY = Tokenizer.from_file(PATH)


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


ALPHABETS = ["ab", "aeiou thr", "     \n\t", "a", "=-_#* ", "éàü ß中文字 ", "0123456789 ,.", "'s't're'll ", "xyzABC<|endoftext|>"]


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_tokens_equal_the_library(own, alphabet):
    rnd = random.Random(alphabet)
    for n in range(200):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.choice([3, 20, 200, 1500])))
        text = "<|endoftext|>".join([text, text[:7], ""]) if n % 10 == 0 else text
        ids = library(text)
        assert list(own.encode(text)) == ids
        assert "".join(own.decode(ids)) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text(text):
    with open(PATH, encoding="utf-8") as file:
        own = bpe.transducer(file.read())
    ids = list(own.encode(text))
    assert ids == library(text) and "".join(own.decode(ids)) == text


def test_every_kind_of_character(own):
    for code in [*range(0x3000), *range(0x3000, 0x11000, 37), *range(0x11000, 0x110000, 997)]:
        if not 0xD800 <= code < 0xE000:
            text = f"a{chr(code)}1{chr(code)} {chr(code)}{chr(code)}!{chr(code)} x"
            assert list(own.encode(text)) == library(text), hex(code)


def test_streaming_in_chunks_emits_early_and_forgets(own):
    rnd = random.Random(1)
    for word in ("a" * 3000, "=" * 5000, "thequickbrownfox" * 300, "".join(rnd.choice("abcdefgh") for _ in range(20_000))):
        data, read = word.encode(), 0

        def chunks(size=7):
            nonlocal read
            for at in range(0, len(data), size):  # noqa: B023
                read = at + size
                yield data[at : at + size]  # noqa: B023

        done, behind, found = 0, 0, []
        for token in own.stream(chunks()):
            found.append(token)
            done += len(own.bytes_of[token])
            behind = max(behind, read - done) if read < len(data) else behind
        assert found == library(word)
        assert behind <= 6 * own.lookahead


def test_long_texts_are_cut_between_words(own, monkeypatch):
    for text in (
        "The cat's 12 dogs,  and  the rest.\n " * 300 + "x" * 500,
        "they're we'll '' 'll'll I've!'re\n\n  'd  " * 100,
        "\u4e2d\u6587\u3002\u5b57\u3002" * 400 + " \u00e9t\u00e9's" * 50,
        "=" * 700 + " " * 900 + "'" * 300,
    ):
        whole = library(text)
        for size in (1, 2, 3, 10, 333):
            monkeypatch.setattr(bpe, "PIECE", size)
            for pattern in (own.words, *([own.ascii_words] if text.isascii() else [])):
                assert [w for run in bpe.words_of(text, pattern) for w in run] == pattern.findall(text)
            assert list(own.encode(text)) == whole


def test_every_word_passes_through_the_transducer(own, monkeypatch):
    seen = []
    stream = own.stream
    monkeypatch.setattr(own, "stream", lambda chunks: stream(seen.append(c) or c for c in chunks))
    monkeypatch.setattr(own, "remembered", bpe.Remembered(own._word))
    monkeypatch.setattr(bpe, "CHUNK", 100)
    text = "a bb ccc a bb " + "thequickbrownfox" * 100
    assert list(own.encode(text)) == library(text)
    assert b"".join(seen) == b"a bb ccc a" + b" " + b"thequickbrownfox" * 100 and max(map(len, seen)) == 100


def test_memory_stays_flat_on_a_long_word(own):
    import tracemalloc

    def peak(n):
        word = "thequickbrownfoxé" * n
        tracemalloc.start()
        made = bpe.row_outputs(own, word, ["n_tokens", "ids_sha256", "decoded_sha256"])
        found = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert made[0] == len(library(word))
        return found

    peak(1_000)
    # copies of the word itself and no more: 300,000 numbers would take ten times its size
    assert peak(60_000) < peak(6_000) + 4 * 17 * 60_000


def test_remembered_words_are_bounded(own, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_WORDS", 5)
    memory = bpe.Remembered(lambda w: iter((len(w),)))
    for n in range(100):
        assert memory["x" * (n % 17)] == (n % 17,)
        assert len(memory) <= 5 and len(memory.older) <= 5
    assert list(memory["y" * 1000]) == [1000] and "y" * 1000 not in memory


def test_decoding_of_broken_bytes(own):
    rnd = random.Random(3)
    for _ in range(300):
        ids = [rnd.randrange(50257) for _ in range(rnd.randint(0, 30))]
        assert "".join(own.decode(ids)) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_columns_and_edges(spark):
    import hashlib

    outputs = list(bpe.OUTPUTS)
    found = bpe.encode(edge_docs(spark), PATH, outputs)
    assert found.columns == ["doc_id", *outputs]
    rows = found.collect()
    assert len(rows) == len(ROWS)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    texts = {i: t or "" for i, t, *_ in ROWS}
    for row in rows:
        text = texts[row.doc_id]
        assert row.ids == library(text) and row.n_tokens == len(row.ids) and row.decoded == text
        assert row.ids_sha256 == digest(",".join(map(str, row.ids))) and row.decoded_sha256 == digest(text)
    back = {r.doc_id: r.decoded for r in bpe.decode(found, PATH).collect()}
    assert back == texts
    assert bpe.encode(no_docs(spark), PATH, outputs).count() == 0
    assert bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), PATH).first().decoded == ""
