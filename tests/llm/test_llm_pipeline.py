import pytest
from fixtures import edge_docs, no_docs
from harness import bad_shape, compare, duck, plan_text

import __spark_entry__ as entry_module
import corpus_pipeline
from flowlens.llm import bpe, decontaminate, pii, simhash
from flowlens.llm.registered import ORACLES, QUERIES

#: Tables and id columns of the queries that don't read documents.
KEYED = {"op4_page_language_id": ("pages", "page_id"), "op13_neighbours": ("embeddings", "query_id")}


def test_every_operator_is_registered_once():
    assert {int(n.split("_")[0][2:]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry_module.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "personal_data", "tokens"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    problem, _, _ = compare(spark, duck(sf), QUERIES[name], ORACLES[name], sf)
    assert problem is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs_over_all_documents(spark, sf, name):
    df = QUERIES[name](spark, sf)
    assert bad_shape(plan_text(df)) is None
    table, key = KEYED.get(name, ("documents", "doc_id"))
    want = {r[0] for r in spark.read.parquet(f"{sf}/{table}.parquet").select(key if key != "query_id" else "vec_id").collect()}
    ids = {r[0] for r in df.select(key).collect()}
    if name == "op6_benchmark_decontamination":
        assert ids and ids <= want
    else:
        assert ids == ({i for i in want if i % 100 == 0} if key == "query_id" else want)


def test_pipeline_by_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = [decontaminate.shingles(decontaminate.words_of(r.text.lower())) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    kept, marks = {}, []
    for row in sorted(docs):  # all languages of the table are accepted
        mark = simhash.fingerprint(row.text)
        linked = [g for g in marks if any((mark ^ m).bit_count() <= simhash.RADIUS for m in g)]
        marks = [g for g in marks if g not in linked] + [[mark] + [m for g in linked for m in g]]
        if not linked:
            kept[row.doc_id] = row.text
    for doc, text in list(kept.items()):
        own = decontaminate.shingles(decontaminate.words_of(text.lower()))
        if any(len(own & item) >= decontaminate.OVERLAP * len(item) for item in items):
            del kept[doc]
    tables = bpe.transducer(open(bpe.default_vocabulary(), encoding="utf-8").read())
    rows = corpus_pipeline.run(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(kept)
    for row in rows:
        text = "".join(tables.decode(row.ids))
        assert pii.base_spans(text) == []
        if not pii.base_spans(kept[row.doc_id]):
            assert text == kept[row.doc_id]
        assert row.n_tokens == len(row.ids) and row.ids == list(tables.encode(text))


def test_stages_on_odd_and_empty_tables(spark, sf):
    for docs in (edge_docs(spark), no_docs(spark)):
        names = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf)
            assert sorted(docs.columns) == sorted(names), name
        ids = [r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()]
        assert len(ids) == len(set(ids)) and None not in ids
