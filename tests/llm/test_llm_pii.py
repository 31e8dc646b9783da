import hashlib
import random
import re
import time

import numpy as np
import pytest
from fixtures import ROWS, edge_docs, no_docs, table_of

from flowlens.llm import pii


def plain_spans(text):
    found = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            found.append(("ip", m))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        odd, even = digits[-1::-2], digits[-2::-2]
        total = sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)
        if 14 <= len(digits) <= 19 and total % 10 == 0:
            found.append(("card", m))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append(("phone", m))
    spans = [(kind, m.start(), m.end()) for kind, m in found]
    return sorted(spans, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@pytest.mark.parametrize("alphabet", ["a@.b-1", "0123 -.", "+012() .-9", "1.", "ab@c.d e+0 12", "é1.2.3.4@x.y "])
def test_base_spans_equal_the_plain_rules(alphabet):
    rnd = random.Random(alphabet)
    for _ in range(3000):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "+1" + "(" * 200_000, "a@" * 50_000):
        pii.base_spans(text)
        pii.candidates(text)


def with_data(n):
    rnd = random.Random(n)
    kinds = [
        lambda: f"user{rnd.randint(1, 99)}@mail{rnd.randint(1, 9)}.example.com",
        lambda: ".".join(str(rnd.randint(1, 250)) for _ in range(4)),
        lambda: f"+1 ({rnd.randint(200, 999)}) {rnd.randint(200, 999)}-{rnd.randint(1000, 9999)}",
        lambda: f"{rnd.randint(256, 999)}.1.{rnd.randint(256, 999)}.4.5.6",
        lambda: f"version {rnd.randint(1, 9)}.{rnd.randint(1, 9)} of {rnd.randint(1000000, 9999999)} items",
        lambda: f"a@{rnd.randint(1, 9)}",
    ]
    return [f"word {rnd.choice(kinds)()} and {rnd.choice(kinds)()} more" for _ in range(n)]


def test_judge_is_right_on_unseen_rows_and_spares_clean_texts(spark):
    judge = pii.fit_judge(table_of(spark, with_data(1500)))
    assert {"email", "ip", "phone"} <= set(judge.thresholds)
    right = wrong = 0
    for text in with_data(400):
        base = pii.base_spans(text)
        for span in judge.chosen(text):
            good = any(s[0] == span[0] and pii.alike(s, span) >= pii.ALIKE for s in base)
            right, wrong = right + good, wrong + (not good)
    assert right > 300 and wrong <= 0.02 * right
    assert judge.chosen("We sold 12 of 30 in 2024, or 4.5 percent.") == []


def test_trees_score_as_the_fitted_model(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    rows = pii.training_rows(table_of(spark, with_data(300))).cache()
    data = rows.select("label", array_to_vector("features").alias("vector"), "features")
    model = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=3, maxDepth=3, seed=1).fit(data)
    judge = pii.Judge([pii._tree(t) for t in model.trees], list(model.treeWeights), {})
    got = model.transform(data).select("features", "rawPrediction").collect()
    own = judge.scores(np.array([r.features for r in got]))
    assert np.allclose(own, [r.rawPrediction[1] for r in got])


def test_edges(spark):
    docs = edge_docs(spark)
    found = pii.find(docs)
    rows = found.collect()
    assert found.columns == ["doc_id", "base", "spans"] and len(rows) == len(ROWS)
    by_id = {r.doc_id: [tuple(s) for s in r.base] for r in rows}
    assert by_id == {i: plain_spans(text or "") for i, text, *_ in ROWS}
    assert by_id[3] == by_id[4] == [] and len(by_id[8]) == 2
    assert [s[0] for s in by_id[10]] == ["email"]
    assert pii.find(no_docs(spark)).count() == 0


def test_redaction_keeps_columns_rows_and_clean_texts(spark):
    docs = edge_docs(spark)
    out = pii.redact(docs)
    assert out.schema == docs.schema
    before = sorted(docs.collect(), key=str)
    after = sorted(out.collect(), key=str)
    assert len(before) == len(after)
    texts = {r.doc_id: r for r in after}
    for row in before:
        if row.text is None or not plain_spans(row.text):
            assert texts[row.doc_id] == row
    assert texts[8].text.endswith("[IP] und [PHONE]") and texts[8].n_chars == len(texts[8].text)
    assert not any(pii.base_spans(r.text or "") for r in after)
    assert pii.redact(no_docs(spark)).count() == 0


def test_overlapping_spans_are_replaced_once():
    assert pii.redacted("ab12345cd", [("card", 2, 5), ("phone", 3, 7), ("ip", 7, 8)]) == "ab[CARD][IP]d"


def test_unusual_forms_are_selected_and_look_alikes_stay(spark):
    rnd = random.Random(3)
    planted = {
        "ip": "2001:0db8:85a3:0000:0000:8a2e:0370:7334",
        "email": "jane.roe [at] mail [dot] example [dot] org",
        "secret": "".join(rnd.choice("0123456789abcdef") for _ in range(40)),
    }
    texts = [f"reach host {planted['ip']} now", f"please ask {planted['email']}. Then wait", f"token = {planted['secret']} ends"]
    spared = ["look at home. Then the dot moved", "commit 0123456789abcdef0123456789abcdef of it", "12:30:45:10:11:12 and 1.2.3.4.5"]
    docs = table_of(spark, with_data(400) + texts + spared)
    judge = pii.fit_judge(docs)
    for (kind, own), text in zip(planted.items(), texts):
        assert (kind, text.index(own), text.index(own) + len(own)) in judge.chosen(text)
    assert not any(span[0] in ("secret", "email") for text in spared for span in judge.chosen(text))
    after = [r.text for r in pii.redact(docs).where("doc_id >= 400").orderBy("doc_id").collect()]
    assert after[:3] == ["reach host [IP] now", "please ask [EMAIL]. Then wait", "token = [SECRET] ends"]


def test_a_rare_kind_is_learned_from_the_whole_table(spark):
    rnd = random.Random(4)
    code = lambda: "".join(rnd.choice("0123456789abcdef") for _ in range(40))
    other = lambda: "QX" + "".join(rnd.choice("ABCDEFGH0123") for _ in range(22))
    texts = [f"token = {code()} ends" if i % 40 == 0 else f"part {other()} ends" if i % 40 == 1 else "words only" for i in range(4000)]
    judge = pii.fit_judge(table_of(spark, texts))
    assert "secret" in judge.thresholds
    unseen = f"part {code()} ends"
    assert judge.chosen(unseen) == [("secret", 5, 45)] and judge.chosen(f"part {other()} ends") == []


def test_a_long_spelled_address_is_found_whole():
    for local in ("a" * 50, "first.last+" * 12 + "x", "j"):
        for sign in ("[at]", " (at) ", "{AT}"):
            address = f"{local}{sign}example[dot]org"
            text = f"write to {address} please"
            whole = ("email", 9, 9 + len(address))
            assert whole in pii.candidates(text) and pii.clear(text, whole)
            assert all(s[1] == 9 for s in pii.candidates(text) if s[0] == "email")
    assert not [s for s in pii.candidates(" [at]example[dot]org") if s[0] == "email"]
    begin = time.perf_counter()
    pii.candidates(("a" * 1000 + " [at] ") * 1000)
    assert time.perf_counter() - begin < 10


def test_short_forms_of_addresses_are_proposed_and_names_are_not():
    for own in ("2001:db8::1", "fe80::1ff:fe23:4567:890a", "2001:0db8:85a3::8a2e:0370:7334"):
        for text in (own, f"see [{own}].", f"from {own}, to"):
            at = text.index(own)
            span = ("ip", at, at + len(own))
            assert span in pii.candidates(text) and pii.clear(text, span)
    for text in ("std::be::a", "abc::def 1", "a::b::c 2", "at 12:30:45", "1::2::3", "x2001:db8::1", "fade::cafe::1"):
        spans = [s for s in pii.candidates(text) if s[0] == "ip"]
        assert not any(pii.clear(text, s) for s in spans), (text, spans)


def test_every_candidate_counts_in_trees_and_thresholds(spark):
    """12,000 codes of which each comes once: training has them all, half of them held out, copies once."""
    code = lambda i: hashlib.sha1(str(i).encode()).hexdigest()
    texts = [f"token = {code(i)} ends" if i % 2 else f"part {code(i)} ends" for i in range(12_000)]
    docs = table_of(spark, texts + texts[:100])
    rows = pii.training_rows(docs).where("kind = 'secret'").collect()
    assert len(rows) == len({r.h for r in rows}) == 12_000 and sum(r.label for r in rows) == 6_000


def test_threshold_is_the_lowest_precise_score_of_all_held_out(spark):
    docs = table_of(spark, with_data(1500))
    judge, rows = pii.fit_judge(docs), pii.training_rows(docs).where("h % 2 != 0").collect()
    assert judge.thresholds
    for kind, threshold in judge.thresholds.items():
        held = [r for r in rows if r.kind == kind]
        scores = judge.of_kind[kind].scores(np.array([r.features for r in held]))
        precise = [s for s in set(scores) if np.mean([r.label for r, x in zip(held, scores) if x >= s]) >= pii.PRECISION]
        assert threshold == min(precise)
