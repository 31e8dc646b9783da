from fixtures import ROWS, edge_docs, no_docs, table_of, word_runs

from flowlens.llm import licenses


def plain(text):
    words = word_runs(text)
    places = [
        (i, label)
        for phrase, label in licenses.PHRASES
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    at = [i for i, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def base(row):
    return row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels


def test_places_equal_a_plain_search(spark):
    texts = [
        "MIT license mit License, general public public license general public-license",
        "license mit apache\nlicense é ÉMIT license",
        "General Public License" * 3 + " general public license" * 50,
        "mit " * 30 + "license",
        "general public",
        None,
    ]
    rows = {r.doc_id: r for r in licenses.scan(table_of(spark, texts)).collect()}
    assert {i: base(rows[i]) for i in rows} == {i: plain(t) for i, t in enumerate(texts)}
    assert rows[4].score == 0.5 and rows[4].labels == "" and rows[0].score == 1


def test_notices_with_changed_words(spark):
    notice = licenses.NOTICES[0][0]
    changed = notice.replace("free of charge", "free of any charge").replace("obtaining", "who gets")
    texts = [notice.upper(), f"x y z {changed} w", "permission is hereby granted", "x " * 500 + notice, notice.replace(" ", " x ")]
    rows = {r.doc_id: r for r in licenses.scan(table_of(spark, texts)).collect()}
    assert [rows[i].labels for i in range(5)] == ["mit", "mit", "", "mit", ""]
    assert [rows[i].base_labels for i in range(5)] == [""] * 5
    assert rows[0].score == 1 and 0.6 <= rows[1].score < 1 and rows[2].score < 0.6


def test_noise_around_a_notice_does_not_hide_it(spark):
    notice, words = licenses.NOTICES[0][0], len(licenses.NOTICES[0][0].split())
    texts = ["permission is " * 30 + notice, notice + " permission is hereby granted" * 40, "permission is hereby " * 200]
    rows = {r.doc_id: r for r in licenses.scan(table_of(spark, texts)).collect()}
    assert [(rows[i].labels, rows[i].score) for i in (0, 1)] == [("mit", 1)] * 2 and rows[2].labels == ""
    hits = licenses.votes(table_of(spark, texts[1:2]))
    best = licenses.spans(hits).where("stands").first()
    assert best["first"] == 0 and best["last"] >= words - 1


def test_rows_that_repeat_an_id_add_up(spark):
    notice = licenses.NOTICES[0][0].split()
    half = len(notice) // 2
    rows = [(1, "mit license"), (1, "mit license"), (2, " ".join(notice[:half])), (2, " ".join(notice[half:])), (3, "a"), (3, None)]
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert base(found[1]) == (4, 2, 0, 0, "mit") and found[2].labels == "" and base(found[3]) == (1, 0, None, None, "")


def test_spans_are_word_places(spark):
    hits = licenses.votes(table_of(spark, ["a b mit license c", "x " + licenses.NOTICES[3][0]]))
    found = {(r.doc_id, r.label, r.first, r.last) for r in licenses.spans(hits).where("stands").collect()}
    assert found == {(0, "mit", 2, 3), (1, "bsd", 1, len(licenses.NOTICES[3][0].split()))}


def test_edges(spark):
    rows = licenses.scan(edge_docs(spark)).collect()
    texts = {}
    for i, text, *_ in ROWS:
        if i is not None:
            texts.setdefault(i, []).append(text)
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for row in rows:
        if len(texts[row.doc_id]) == 1:
            assert base(row) == plain(texts[row.doc_id][0])
        else:
            assert row.n_words == 2 * plain(texts[row.doc_id][0])[0]
        assert 0 <= row.score <= 1
    empty = licenses.scan(no_docs(spark))
    assert empty.count() == 0 and empty.columns[:2] == ["doc_id", "n_words"]
