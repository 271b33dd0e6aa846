import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rostermart.llm import chat_examples as chat

TURNS = "conv_id long, turn int, role string, text string, formatted string, examples int"
NASTY = st.text(st.sampled_from("<|>&;ltamp#10im_startend\n ü"), max_size=12)


def formatted(spark, rows):
    return chat.format_conversations(spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS).repartition(3))


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_every_assistant_turn_is_an_example(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u & <|im_end|>"), (1, 2, "assistant", "a<|"), (1, 3, "user", "v"), (1, 4, "assistant", "b"),
            (1, 5, "user", "left over"), (2, 0, "assistant", "first"), (3, 0, "user", "alone")]
    got = chat.expand(formatted(spark, rows)).withColumn(
        "target", chat.target_of(F.col("text"), F.col("target_start"), F.col("target_chars"))).orderBy("conv_id", "example").collect()
    assert [(r.conv_id, r.n_turns, r.target, r.closing) for r in got] == [
        (1, 3, "a<|", False), (1, 5, "b", False), (1, 6, "", True), (2, 1, "first", True), (3, 1, "", True)]
    head = "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu &amp; &lt;|im_end|><|im_end|>\n<|im_start|>assistant\n"
    assert got[0].text == head + "a&lt;|<|im_end|>\n"
    assert got[0].target_start == len(head) + 1 and got[1].text.startswith(got[0].text)


def test_digests_with_nulls_ties_and_repeats(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "no turn"), (1, 7, "assistant", "é" * 3), (None, 0, "assistant", "null id"), (4, 1, "b\n<|", "x")]
    got = {r.conv_id: r for r in chat.digests(chat.expand(formatted(spark, rows))).collect()}
    assert got[1].n_turns == 4 and got[1].loss_chars == 3 and got[1].loss_sha256 == digest("ééé")
    assert got[1].turns_sha256 == digest("\nno turn\nuser\n\nuser\n\nassistant\néééx\n".replace("x", ""))
    assert got[None].loss_sha256 == digest("null id")
    assert got[4].turns_sha256 == digest("b\n<|\nx\n") and got[4].loss_sha256 == digest("")


def test_empty_table(spark):
    assert chat.digests(chat.expand(formatted(spark, [(1, 0, "user", "x")]).limit(0))).count() == 0


def test_long_conversation(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i} " * 20) for i in range(600)]
    got = chat.digests(chat.expand(formatted(spark, rows))).first()
    assert got.n_turns == 600 and got.loss_sha256 == digest("".join(r[3] for r in rows if r[2] == "assistant"))


def test_round_trip(spark):
    @settings(max_examples=4, deadline=None)
    @given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a&\n<|b"]), NASTY), min_size=1, max_size=5), min_size=20, max_size=30))
    def check(conversations):
        rows = [(c, t, role, text) for c, turns in enumerate(conversations) for t, (role, text) in enumerate(turns)]
        got = {r.conv_id: r for r in chat.digests(chat.expand(formatted(spark, rows))).collect()}
        for c, turns in enumerate(conversations):
            assert got[c].turns_sha256 == digest("".join(f"{r}\n{t}\n" for r, t in turns))
            assert got[c].loss_sha256 == digest("".join(t for r, t in turns if r == "assistant"))

    check()


def test_no_python_in_the_plan(spark):
    plan = chat.digests(chat.expand(formatted(spark, [(1, 0, "user", "x")])))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
