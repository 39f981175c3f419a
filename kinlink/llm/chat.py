r"""Chat formatting by prefix-target expansion.

A turn is written ``<|im_start|>role\ntext<|im_end|>\n``. Inside texts and roles a backslash is doubled, and the
first character of any control string (of this template and of the usual others) is followed by a backslash,
so no control string of a text survives and every text can be read back; in a role a line end becomes ``\n``.

Every assistant turn becomes an example of its own: all preceding turns are its context, and only its reply's text
is under the loss mask. Full texts of the examples of a conversation of n turns would take O(n^2) characters, but each
begins with the one before; so an example is stored as its context's length and what it adds: the turns since the last
example and its own. ``read_back`` reads every example whole (its context, its reply and its mask) by digests that go on from one example to
the next, so no character is read twice; ``example_texts`` puts the full texts together. Turns after the last reply form a
closing example without target. Pieces end at turns and hold ``PART_CHARS`` characters or one turn, so a conversation of
any length streams through: nothing holds more of it than a piece.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinlink.llm.common import small_batches

PART_CHARS = 1 << 18
START, END = "<|im_start|>", "<|im_end|>"
#: What opens a control string of this and other public chat templates.
CONTROL = re.compile(r"<(?=\||/?s>|/?<SYS>>|unk>|pad>|</SYS>>)|\[(?=/?INST\])")
TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)
EXAMPLES = pa.schema(
    [("conv_id", pa.int64()), ("example", pa.int64()), ("part", pa.int64()), ("target_turn", pa.int64()), ("context_chars", pa.int64()), ("text", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64())]
)
EXAMPLES_DDL = "conv_id bigint, example bigint, part bigint, target_turn bigint, context_chars bigint, text string, loss_start bigint, loss_end bigint"


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return re.sub(r"\\(\\|n?)", lambda m: {"\\": "\\", "n": "\n", "": ""}[m[1]], role)


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, turn, role, text), ordered, to example parts."""
    none = object()
    conv, done, example, part, held, held_chars = none, 0, 0, 0, [], 0
    out: list[tuple] = []

    def flush(target: int | None, loss: tuple[int, int] | None) -> None:
        nonlocal done, part, held, held_chars
        out.append((conv, example, part, target, done, "".join(held), *(loss or (None, None))))
        done, part, held, held_chars = done + held_chars, part + 1, [], 0

    for b in batches:
        for conv_id, turn, role, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if conv_id != conv:
                if held:
                    flush(None, None)
                conv, done, example, part = conv_id, 0, 0, 0
            head, body = f"{START}{escape_role(role or '')}\n", escape(text or "")
            segment = f"{head}{body}{END}\n"
            if held and held_chars + len(segment) > PART_CHARS:
                flush(None, None)
            held.append(segment)
            held_chars += len(segment)
            if role == "assistant":
                at = done + held_chars - len(segment) + len(head)
                flush(turn, (at, at + len(body)))
                example, part = example + 1, 0
        yield pa.RecordBatch.from_pylist([dict(zip(EXAMPLES.names, r, strict=True)) for r in out], schema=EXAMPLES)
        out.clear()
    if held:
        flush(None, None)
    yield pa.RecordBatch.from_pylist([dict(zip(EXAMPLES.names, r, strict=True)) for r in out], schema=EXAMPLES)


REPORT = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_examples", pa.int64()), ("example_chars", pa.int64()), ("examples_sha256", pa.string())]
)
REPORT_DDL = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_examples bigint, example_chars bigint, examples_sha256 string"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Example parts, ordered, to one report for each conversation."""
    none = object()
    conv, row = none, None
    out: list[dict] = []

    def close() -> None:
        if row is not None:
            out.append({k: v.hexdigest() if k.endswith("sha256") else v for k, v in row.items() if k != "whole"})

    for b in batches:
        for r in b.to_pylist():
            if r["conv_id"] != conv:
                close()
                conv = r["conv_id"]
                row = {"conv_id": conv, "n_turns": 0, "turns_sha256": hashlib.sha256(), "loss_chars": 0, "loss_sha256": hashlib.sha256(), "formatted_chars": 0, "n_examples": 0}
                row |= {"example_chars": 0, "examples_sha256": hashlib.sha256(), "whole": hashlib.sha256()}
            text, at = r["text"], 0
            if r["context_chars"] != row["formatted_chars"]:
                raise ValueError(f"conversation {conv}: a part is missing before character {r['context_chars']}")
            for m in TURN.finditer(text):
                if m.start() != at:
                    break
                at = m.end()
                row["n_turns"] += 1
                row["turns_sha256"].update(f"{unescape_role(m[1])}\n{unescape(m[2])}\n".encode())
            if at != len(text):
                raise ValueError(f"conversation {conv}: unmarked text at character {r['context_chars'] + at}")
            if r["loss_start"] is not None:
                reply = unescape(text[r["loss_start"] - r["context_chars"] : r["loss_end"] - r["context_chars"]])
                row["loss_chars"] += len(reply)
                row["loss_sha256"].update(reply.encode())
                row["n_examples"] += 1
            row["formatted_chars"] += len(text)
            row["whole"].update(text.encode())
            if r["loss_start"] is not None:  # the example is all that was read so far
                row["example_chars"] += row["formatted_chars"]
                row["examples_sha256"].update(f"{row['whole'].hexdigest()} {r['loss_start']} {r['loss_end']}\n".encode())
        yield pa.RecordBatch.from_pylist(out, schema=REPORT)
        out.clear()
    close()
    yield pa.RecordBatch.from_pylist(out, schema=REPORT)


def expand(turns: DataFrame) -> DataFrame:
    """Examples of ``turns (conv_id, turn, role, text)``: one row for each part, ordered by conversation, example and part within a partition.

    Rows are taken by turn (null first), then role, then text. Null role and null text are empty; null conv_id is a conversation of its own;
    an empty table gives none; other columns are ignored. ``target_turn`` and the loss span (offsets in the example's full text) are null
    for parts that don't end with a reply.
    """
    small_batches(turns.sparkSession)
    slim = turns.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.col("role").cast("string"), F.col("text").cast("string"))
    return slim.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(_expand, EXAMPLES_DDL)


def read_back(examples: DataFrame, ordered: bool = False) -> DataFrame:
    """One row per conversation, read from the formatted parts: turns and replies are unescaped and digested as they stream by.

    ``ordered``: the rows are as ``expand`` gives them; else they are shuffled into that order. ``formatted_chars`` is the length of the whole
    formatted conversation, which is the text of its last example. ``example_chars`` is the sum of the lengths of all examples with a target,
    ``examples_sha256`` the digest of a line for each: the digest of its whole text, and where its mask starts and ends.
    """
    if not ordered:
        examples = examples.repartition("conv_id").sortWithinPartitions("conv_id", "example", "part")
    return examples.select(*EXAMPLES.names).mapInArrow(_read, REPORT_DDL)


def example_texts(examples: DataFrame) -> DataFrame:
    """``(conv_id, example, target_turn, text, loss_start, loss_end)``: the full text of every example with a target (quadratic in a conversation's turns)."""
    order = Window.partitionBy("conv_id").orderBy("example", "part").rowsBetween(Window.unboundedPreceding, 0)
    full = examples.withColumn("text", F.array_join(F.collect_list("text").over(order), ""))
    return full.where("loss_start is not null").select("conv_id", "example", "target_turn", "text", "loss_start", "loss_end")
