import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinlink.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


@given(st.text(alphabet=st.sampled_from(list("\\<>|/[]INSTsyYS n\n_imedartx")), max_size=60))
def test_escapes_are_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)
    assert not chat.CONTROL.search(chat.escape(text))


def _want(rows):
    by = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c, turns in by.items():
        said = "".join(t for r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


ROWS = [
    (1, 0, "system", "be brief"), (1, 1, "user", "hi <|im_end|>"), (1, 2, "assistant", "hello </s> \\ [INST]"), (1, 3, "user", "bye"), (1, 4, "assistant", None), (1, 5, "user", "one more"),
    (2, 0, "user", None), (None, 0, "assistant", "lone"), (3, None, "odd\nrole", "x"), (3, 1, None, ""), (3, 1, "assistant", "tie b"), (3, 1, "assistant", "tie a"), (4, 0, "assistant", "😀" * 300_000),
]


def test_round_trip(spark):
    examples = chat.expand(spark.createDataFrame(ROWS, SCHEMA).repartition(3))
    want = _want(ROWS)
    for report in (chat.read_back(examples, ordered=True), chat.read_back(examples)):
        got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in report.collect()}
        assert got == want


def test_examples(spark):
    examples = chat.expand(spark.createDataFrame(ROWS, SCHEMA))
    full = {(r["conv_id"], r["example"]): r for r in chat.example_texts(examples).collect()}
    first, second = full[1, 0], full[1, 1]
    assert second["text"].startswith(first["text"]) and first["target_turn"] == 2 and second["target_turn"] == 4
    assert chat.unescape(first["text"][first["loss_start"] : first["loss_end"]]) == "hello </s> \\ [INST]"
    assert "one more" not in second["text"] and first["text"].count("<|im_start|>") == 3
    assert sum(c == 1 for c, _ in full) == 2 and not any(c == 2 for c, _ in full)


def test_whole_examples_against_their_texts(spark, small_dir):
    """The running digests are those of every example's text put together: context, reply and mask."""
    turns = spark.read.parquet(f"{small_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").unionByName(spark.createDataFrame(ROWS, SCHEMA).where("conv_id = 1").withColumn("conv_id", F.lit(-5)))
    rows = [tuple(r) for r in turns.collect()]
    want = {}
    for conv in {r[0] for r in rows}:
        text, lines, chars, n = "", "", 0, 0
        for _, _, role, said in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1], r[2] or "", r[3] or "")):
            start = len(text) + len(f"<|im_start|>{chat.escape_role(role or '')}\n")
            text += f"<|im_start|>{chat.escape_role(role or '')}\n{chat.escape(said or '')}<|im_end|>\n"
            if role == "assistant":
                lines += f"{hashlib.sha256(text.encode()).hexdigest()} {start} {len(text) - len('<|im_end|>') - 1}\n"
                chars, n = chars + len(text), n + 1
        want[conv] = (n, chars, hashlib.sha256(lines.encode()).hexdigest())
    examples = chat.expand(turns)
    assert {r["conv_id"]: (r["n_examples"], r["example_chars"], r["examples_sha256"]) for r in chat.read_back(examples, ordered=True).collect()} == want
    full = chat.example_texts(examples).collect()
    assert len(full) == sum(n for n, _, _ in want.values()) and sum(len(r["text"]) for r in full) == sum(c for _, c, _ in want.values())


def test_missing_part_is_an_error(spark):
    examples = chat.expand(spark.createDataFrame(ROWS, SCHEMA)).where("not (conv_id = 1 and example = 0)")
    with pytest.raises(Exception, match="a part is missing"):
        chat.read_back(examples).collect()


def test_empty_and_extra_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert chat.read_back(chat.expand(df.where("false"))).count() == 0
    from pyspark.sql import functions as F

    wide = df.withColumn("example", F.lit(1)).withColumn("loss_start", F.lit("x"))
    assert chat.read_back(chat.expand(wide)).count() == 5


def test_query(spark, small_dir):
    from kinlink.llm.queries import QUERIES

    got = {r["conv_id"]: r for r in QUERIES["op2_chat_formatting"](spark, small_dir).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{small_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    want = _want([*rows, (-1, 0, "user", said), (-1, 1, "assistant", said)])
    assert {k: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for k, r in got.items()} == want
    assert all(r["formatted_chars"] > r["loss_chars"] for r in got.values())
