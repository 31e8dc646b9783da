import hashlib
import random

import pytest
from pyspark.sql import functions as F

from flowlens.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def key(row):
    return (row[1] is not None, row[1] or 0, row[2] or "", row[3] or "")


def plain(rows):
    found = {}
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        learned = "".join(t for role, t in turns if role == "assistant")
        state = "start"
        for role, _ in turns:
            state = chat.CHATML.moves.get((state, role), "error")
        text = "".join(f"{role}\n{t}\n" for role, t in turns)
        found[conv] = (len(turns), hashlib.sha256(text.encode()).hexdigest(), len(learned),
                       hashlib.sha256(learned.encode()).hexdigest(), state == "assistant")
    return found


def test_conversations_come_back_from_the_formatted_text(spark):
    rnd = random.Random(2)
    bits = ["<|im_start|>", "<|im_end|>\n", "\\", "\\l", "\\s", "[", "\n", "a", "é", "</s>", "[INST]", ""]
    rows = []
    for conv in range(30):
        for turn in range(rnd.randint(1, 200)):
            text = None if rnd.random() < 0.05 else "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 8)))
            rows.append((conv, turn - 30 if conv % 7 else turn * 1000, rnd.choice(["user", "assistant", "system", "a<b\n", None]), text))
    rows += rows[:50] + [(40, None, "user", "x"), (40, 5, "assistant", "y"), (None, 1, "user", "z")]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.valid) for r in chat.digests(table(spark, rows)).collect()}
    assert got == plain(rows)


def test_segments_and_their_loss(spark):
    found = chat.segments(table(spark, [(1, 2, "assistant", "<b>"), (1, 1, "user", "hi")])).orderBy("place", "segment")
    assert [(r.text, r.loss) for r in found.collect()] == [
        ("<|im_start|>user\n", False), ("hi", False), ("<|im_end|>\n", False),
        ("<|im_start|>assistant\n", False), ("\\lb>", True), ("<|im_end|>\n", False),
    ]


@pytest.mark.parametrize(
    "roles, valid",
    [
        ("user assistant", True),
        ("system user assistant", True),
        ("user assistant tool assistant", True),
        ("user", False),
        ("assistant user", False),
        ("user user assistant", False),
        ("system assistant", False),
    ],
)
def test_turn_order(spark, roles, valid):
    rows = [(1, i, role, "t") for i, role in enumerate(roles.split())]
    assert chat.validity(table(spark, rows)).first().valid is valid


def test_state_is_carried_over_stretches(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], "t") for i in range(300)]
    rows += [(2, i, ("user", "assistant")[i % 2], "t") for i in range(300) if i != 150]
    assert {r.conv_id: r.state for r in chat.validity(table(spark, rows)).collect()} == {1: "assistant", 2: "error"}


def test_another_template(spark):
    template = chat.Template(
        begin="[TURN]", after_role=": ", end="</s>", learned=("bot",), accepting=("bot",),
        moves={("start", "human"): "human", ("human", "bot"): "bot", ("bot", "human"): "human"},
    )
    rows = [(1, 0, "human", "a</s>[TURN]b"), (1, 1, "bot", "c")]
    back = chat.read_back(chat.assembled(chat.segments(table(spark, rows), template)), template).first()
    assert back.formatted == "[TURN]human: a\\l/s>\\bTURN]b</s>[TURN]bot: c</s>"
    assert [tuple(t) for t in back.turns] == [("human", "a</s>[TURN]b"), ("bot", "c")]
    assert chat.validity(table(spark, rows), template).first().valid


def test_edges(spark):
    clashing = table(spark, [(1, 0, "user", "a")]).selectExpr("*", "text AS stretch", "text AS place", "turn AS segment", "role AS loss")
    assert chat.digests(clashing).first().n_turns == 1
    assert chat.digests(table(spark, []).where("false")).count() == 0
    assert chat.validity(table(spark, []).where("false")).count() == 0
    long = table(spark, [(1, 0, "assistant", "x<" * 200_000)])
    assert chat.digests(long).first().loss_chars == 400_000


def test_main_path_is_native(spark, sf):
    plan = chat.op7_chat_formatting(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    own = chat.op7_chat_formatting(spark, sf).where(F.col("conv_id") == -1).first()
    assert own.n_turns == 2 and own.loss_chars == 21 and own.valid
