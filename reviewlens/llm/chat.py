"""Chat formatting by incremental rendering of a black-box template.

A template is a function from a list of (role, text) turns to a string. Successive
prefixes of a conversation are rendered; where one output extends the one before, the
new part is the span of the turn. Two probes in place of the turn's text show where
the text stands inside the span. An output that does not extend the one before means
that the template rewrites history: the conversation is marked, and has no spans.

Defined results: a null text is empty and a null role is the empty role; turns of equal
number stand in order of role and text, a null number first; a null conversation id
is a conversation; rows that repeat are turns of their own; an empty table gives no
rows. A conversation is one record: its turns meet in one task, one conversation at a
time, and rendering every prefix takes time with the square of its turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

Turn = tuple[str, str]

# Marks of the default template: a turn is "### role: text</turn>\n".
OPEN, ROLE_END, CLOSE = "### ", ": ", "</turn>\n"
_CONTROL = re.compile(r"\\|###|</turn>|: ")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|: )")
LEARNED_ROLE = "assistant"


def escape(text: str) -> str:
    """Put a backslash in front of control strings and backslashes."""
    return _CONTROL.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m.group(1), text)


def default_template(turns: Sequence[Turn]) -> str:
    return "".join(f"{OPEN}{escape(r)}{ROLE_END}{escape(t)}{CLOSE}" for r, t in turns)


@dataclass(frozen=True)
class Rendered:
    """An output, the (start, end) of each turn and of each turn's text in it."""

    output: str
    turns: list[tuple[int, int]]
    texts: list[tuple[int, int]]
    rewrites: bool


def locate(turns: Sequence[Turn], template: Callable[[Sequence[Turn]], str]) -> Rendered:
    """Render successive prefixes and find what each turn adds."""
    before, spans, texts = template([]), [], []
    for n, (role, text) in enumerate(turns, 1):
        output = template(turns[:n])
        if not output.startswith(before):
            return Rendered(template(turns), [], [], True)
        # Two texts without a common start or end show the frame around any text.
        probes = [template([*turns[: n - 1], (role, probe)])[len(before) :] for probe in "ab"]
        head = len(commonprefix(probes))
        tail = len(commonprefix([p[::-1] for p in probes]))
        spans.append((len(before), len(output)))
        texts.append((len(before) + head, len(output) - tail))
        before = output
    return Rendered(before, spans, texts, False)


def read_back(rendered: Rendered) -> list[Turn]:
    """The turns as the default template's output says them."""
    out = rendered.output
    return [
        (unescape(out[start + len(OPEN) : first - len(ROLE_END)]), unescape(out[first:last]))
        for (start, _), (first, last) in zip(rendered.turns, rendered.texts)
    ]


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[Turn]]]:
    """Conversations of a stream sorted by id, over the borders of batches."""

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(3)))

    for key, group in groupby(rows(), key=lambda r: r[0]):
        yield key, [(role, text) for _, role, text in group]


def _sorted_turns(conversations: DataFrame, key, turn, role, text) -> DataFrame:
    """(conv_id, role, text): a conversation in one partition, its turns in order."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select(
        F.col(key).alias("conv_id"), F.col(turn).alias("turn"),
        value(role).alias("role"), value(text).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text")


def format_conversations(
    conversations: DataFrame,
    template: Callable[[Sequence[Turn]], str] = default_template,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learned: str = LEARNED_ROLE,
) -> DataFrame:
    """(conv_id, formatted, n_turns, turn_spans, loss_spans, rewrites), one row each.

    Spans are start, end, start, end, … in code points of ``formatted``; the loss spans
    are the texts of the turns of role ``learned``, in order.
    """
    rows = _sorted_turns(conversations, key, turn, role, text)
    fields = (
        "formatted string, n_turns bigint, turn_spans array<bigint>, "
        "loss_spans array<bigint>, rewrites boolean"
    )
    schema = T.StructType([rows.schema["conv_id"], *T.StructType.fromDDL(fields)])

    def run(batches):
        for conv_id, turns in _conversations(batches):
            found = locate(turns, template)
            loss = [s for s, (who, _) in zip(found.texts, turns) if who == learned]
            yield _record(
                batches_type, names,
                [conv_id, found.output, len(turns), _flat(found.turns), _flat(loss), found.rewrites],
            )

    names = schema.names
    batches_type = [None, pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.bool_()]
    return _typed(rows, run, schema)


def conversation_digests(
    conversations: DataFrame, key="conv_id", turn="turn", role="role", text="text"
) -> DataFrame:
    """Turns and learned texts, read back from the default template's output.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, rewrites)
    """
    rows = _sorted_turns(conversations, key, turn, role, text)
    fields = (
        "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint, rewrites boolean"
    )
    schema = T.StructType([rows.schema["conv_id"], *T.StructType.fromDDL(fields)])
    kinds = [None, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
    names = schema.names

    def run(batches):
        for conv_id, turns in _conversations(batches):
            found = locate(turns, default_template)
            said = read_back(found)
            loss = "".join(t for r, t in said if r == LEARNED_ROLE)
            turn_text = "".join(f"{r}\n{t}\n" for r, t in said)
            yield _record(
                kinds, names,
                [
                    conv_id, len(said), _sha256(turn_text), len(loss), _sha256(loss),
                    len(found.output), found.rewrites,
                ],
            )

    return _typed(rows, run, schema)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _flat(spans: list[tuple[int, int]]) -> list[int]:
    return [x for span in spans for x in span]


def _record(kinds, names, values) -> pa.RecordBatch:
    columns = [pa.array([v], kind) for v, kind in zip(values, kinds)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _typed(rows: DataFrame, run, schema: T.StructType) -> DataFrame:
    """``run`` over sorted partitions; ids travel as text to fit any id type."""
    kind = schema["conv_id"].dataType
    text_schema = T.StructType([T.StructField("conv_id", T.StringType()), *schema.fields[1:]])
    as_text = rows.withColumn("conv_id", F.col("conv_id").cast("string"))

    def typed(batches):
        for batch in run(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.string()), *batch.columns[1:]], names=batch.schema.names
            )

    out = as_text.mapInArrow(typed, text_schema)
    return out.withColumn("conv_id", F.col("conv_id").cast(kind))
