import random

import numpy as np
from fixtures import ROWS, edge_docs, no_docs
from pyspark.sql import functions as F

from flowlens.llm import language
from flowlens.llm import words as W


def prose(letters, n, rnd):
    return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(2, 8))) for _ in range(n))


SOUNDS = {"aa": "aeioulmn", "bb": "aeioukgt", "cc": "öäüchßre"}


def corpus(spark, n=180, words=40):
    rnd = random.Random(n)
    rows = []
    for i in range(n):
        lang = list(SOUNDS)[i % 3]
        rows.append((i, prose(SOUNDS[lang], words, rnd), lang, f"{lang}.site.{lang}", lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, host string, truth string")


def test_trigrams_equal_a_plain_count():
    texts = ["Ab 1c", "", "é", "abc", "x", "the end"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
    got, owner = language.trigrams(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets)
    want, whose = [], []
    for i, r in enumerate(raw):
        low = bytes(int(language.LETTERS[b]) for b in r)
        for j in range(len(low) - 2):
            if low[j + 1] != 0x20:
                value = (low[j] | low[j + 1] << 8 | low[j + 2] << 16) * 0x9E3779B1 % 2**32
                want.append(value >> (32 - language.BUCKET_BITS))
                whose.append(i)
    assert got.tolist() == want and owner.tolist() == whose


def test_accuracy_on_unseen_texts_with_wrong_declarations(spark):
    train = corpus(spark, 180)
    unseen = corpus(spark, 240, 12).withColumn("lang", F.when(F.col("doc_id") % 5 == 0, "aa").otherwise(F.col("truth")))
    found = language.identify(unseen, declared=F.col("lang"), host=F.col("host"), training=train)
    rows = found.join(unseen.select("doc_id", "truth"), "doc_id").collect()
    assert sum(r.lang == r.truth for r in rows) >= 0.97 * len(rows) and all(r.accepted for r in rows)


def test_other_evidence_decides_texts_that_say_little(spark):
    rnd = random.Random(1)
    base = corpus(spark, 180)
    vague = [(1000 + i, "ae io", None, f"{x}.site.{x}", x) for i, x in enumerate(["aa", "bb"] * 3)]
    docs = base.unionByName(spark.createDataFrame(vague, base.schema))
    rows = language.identify(docs, host=F.col("host"), suffix=language.address_suffix(F.concat(F.lit("x://"), "host")))
    got = {r.doc_id: r.lang for r in rows.where("doc_id >= 1000").collect()}
    assert got == {1000 + i: x for i, x in enumerate(["aa", "bb"] * 3)}
    declared = language.identify(docs.withColumn("said", F.coalesce("lang", F.lit("bb"))), declared=F.col("said"))
    assert {r.lang for r in declared.where("doc_id >= 1000").collect()} == {"bb"}
    assert rnd


def test_texts_in_none_of_the_languages_are_rejected(spark):
    base = corpus(spark, 180)
    odd = [(2000, "Съешь же ещё этих мягких французских булок да выпей чаю " * 5, "aa", "aa.site.aa", "?"), (2001, "12 34 !!", "aa", None, "?")]
    docs = base.unionByName(spark.createDataFrame(odd, base.schema))
    found = language.identify(docs, declared=F.col("lang"), host=F.col("host"), training=base)
    rows = {r.doc_id: r for r in found.collect()}
    assert not rows[2000].accepted and rows[2000].lang == "und"
    assert not rows[2001].accepted and rows[2001].text_lang == "und"
    assert sum(r.accepted for r in rows.values()) == 180


def test_codes_in_a_short_text_do_not_reject_it(spark):
    rnd = random.Random(5)
    base = corpus(spark, 180)
    odd = [(2000, prose(SOUNDS["aa"], 4, rnd) + " QZXKWVJTPEYD2FQBC2ZHJ " + prose(SOUNDS["aa"], 2, rnd), "aa", "aa.site.aa", "aa")]
    docs = base.unionByName(spark.createDataFrame(odd, base.schema))
    row = language.identify(docs, declared=F.col("lang"), host=F.col("host"), training=base).where("doc_id = 2000").first()
    assert row.accepted and row.lang == "aa"


def test_prior_by_brute_force(spark):
    docs = corpus(spark, 90)
    rows = language.identify(docs, host=F.col("host")).collect()
    languages, model = language.fit(docs, "doc_id", "text", "lang")
    best = {r.doc_id: languages.index(r.text_lang) for r in rows}
    hosts = {r.doc_id: r.host for r in docs.collect()}
    k = len(languages)
    whole = np.array([list(best.values()).count(j) for j in range(k)], dtype=float)
    share = (whole + 1) / (whole.sum() + k)
    for row in docs.limit(9).collect():
        domain = row.host.split(".", 1)[1]
        of_domain = np.array([sum(best[i] == j and hosts[i].endswith(domain) for i in best) for j in range(k)], dtype=float)
        of_host = np.array([sum(best[i] == j and hosts[i] == row.host for i in best) for j in range(k)], dtype=float)
        m = language.PRIOR_ROWS
        domain_prior = (of_domain + m * share) / (of_domain.sum() + m)
        prior = (of_host + m * domain_prior) / (of_host.sum() + m)
        data = np.frombuffer(row.text.encode(), dtype=np.uint8)
        buckets, _ = language.trigrams(data, np.array([0, len(data)]))
        n = len(buckets)
        text = (model[buckets].astype(float).sum(axis=0) + n * language.LN_BUCKETS) / n * (n / (1 + n / language.SATURATION))
        evidence = np.log(prior * (1 - language.NONE_PRIOR)) + text
        chance = np.log(language.NONE_PRIOR)
        want = np.exp(evidence.max()) / (np.exp(evidence).sum() + np.exp(chance))
        got = next(r for r in rows if r.doc_id == row.doc_id)
        assert abs(got.confidence - want) < 1e-6 and got.lang == languages[int(evidence.argmax())]


def test_pages_have_all_evidence(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    declared = language.markup_language(F.col("html"))
    host = F.regexp_extract("url", "://([^/?#]*)", 1)
    found = language.identify(
        pages.withColumn("lang", declared), "page_id", "html", "lang", declared, language.address_suffix(F.col("url")), host
    )
    rows = found.collect()
    assert len(rows) == pages.count() and sum(r.lang == r.declared for r in rows) > 0.95 * len(rows)


def test_edges(spark):
    docs = edge_docs(spark)
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.accepted for r in language.documents_languages(unlabelled).collect()} == {True}
    many = docs.unionByName(edge_docs(spark, [(100 + i, ROWS[0][1], "en", "src0") for i in range(30)]))
    rows = language.documents_languages(many).collect()
    assert len(rows) == len(ROWS) + 30
    accepted = {r.doc_id: r.accepted for r in rows}
    assert not accepted[3] and not accepted[4] and not accepted[6] and accepted[1] and accepted[100]
    kept = language.accepted_documents(many)
    assert sorted(kept.columns) == sorted(docs.columns) and kept.where("doc_id IN (1, 2, 2)").count() == 3
    assert kept.where("doc_id IS NULL OR doc_id IN (3, 4, 6)").count() == 0
    assert language.documents_languages(no_docs(spark)).count() == 0
    assert language.accepted_documents(no_docs(spark)).count() == 0
    assert W.ALPHANUMERIC[0xC3]


def test_a_rare_language_is_known_in_a_large_table(spark, monkeypatch):
    monkeypatch.setattr(language, "TRAINING_DOCS", 30)
    rnd = random.Random(8)
    rows = [(i, prose(SOUNDS["aa"], 12, rnd), "aa", None, "aa") for i in range(3000)]
    rows += [(5000 + i, prose(SOUNDS["cc"], 12, rnd), "cc", None, "cc") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, host string, truth string")
    assert language.fit(docs, "doc_id", "text", "lang")[0] == ["aa", "cc"]
    found = language.identify(docs).where("doc_id >= 5000").collect()
    assert [(r.lang, r.accepted) for r in found] == [("cc", True)] * 5
    two = docs.where("doc_id < 5002")
    assert language.fit(two, "doc_id", "text", "lang")[0] == ["aa"]


def test_suffix_of_addresses_and_bare_hosts(spark):
    urls = ["news.example.de", "http://a.example.FR:80/x.html", "src0", "//b.example.es/", "1.2.3.4", None, "example.it/a.b"]
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, url string").orderBy("i")
    got = [r[0] for r in frame.select(language.address_suffix(F.col("url"))).collect()]
    assert got == ["de", "fr", None, "es", None, None, "it"]


def test_the_suffix_of_a_bare_source_decides(spark):
    rnd = random.Random(11)
    base = [(i, prose(SOUNDS[x], 40, rnd), x, f"h{i}.{x}") for i, x in enumerate(["aa", "bb"] * 60)]
    vague = [(1000 + i, "ae io", None, f"new{i}.{x}") for i, x in enumerate(["aa", "bb"] * 3)]
    docs = spark.createDataFrame(base + vague, "doc_id long, text string, lang string, source string")
    rows = language.documents_languages(docs).where("doc_id >= 1000").collect()
    assert {r.doc_id: r.lang for r in rows} == {1000 + i: x for i, x in enumerate(["aa", "bb"] * 3)}


def test_pages_are_identified_by_a_query(spark, sf):
    from flowlens.llm.queries import QUERIES

    rows = QUERIES["op4_page_language_id"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/pages.parquet").count()
    assert sum(r.lang == r.declared for r in rows) > 0.95 * len(rows)
