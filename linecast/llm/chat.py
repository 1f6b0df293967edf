r"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as a whole, encoded once with offsets, and the
sorted spans of the assistant's texts are intersected with the token spans by
binary search. A token carries loss when it overlaps an assistant span; the
mask keeps the overlap in code points, so a token that reaches over the edge
of a text counts for the text's part only. Several byte-level tokens may share
one character; the mask's spans are merged, so no character counts twice.

Template, per turn: ``### role: text </turn>`` and a line feed. Inside texts and
roles a backslash goes before every backslash, every ``#`` and ``</turn>``, in
roles also before ``:``. An escaped string never looks like control text, and
dropping those backslashes restores the text exactly.

Turns are ordered by turn (nulls first), then role and text. Rows are dealt by
conversation and sorted; each task streams over its rows and holds one
conversation at a time.

Defined results: null text and null role count as empty; repeated turns are
kept; a null conv_id is a conversation of its own; an empty table gives an
empty table; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAD, COLON, END = "### ", ": ", " </turn>\n"
LOSS_ROLE = "assistant"

_CONTROL = re.compile(r"[\\#]|</turn>")
_CONTROL_OR_COLON = re.compile(r"[\\#:]|</turn>")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:[^\\#<:]|\\.|<(?!/turn>))*): ((?:[^\\#<]|\\.|<(?!/turn>))*) </turn>\n", re.DOTALL)

_encoders: dict[str, object] = {}


def _encoder(path: str):
    """One tokenizer per Python worker and vocabulary; control strings of the
    vocabulary are ordinary text."""
    if path not in _encoders:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        _encoders[path] = t
    return _encoders[path]


def escape(text: str, role: bool = False) -> str:
    return (_CONTROL_OR_COLON if role else _CONTROL).sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of the escaped assistant texts."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = HEAD + escape(role, True) + COLON, escape(text)
        if role == LOSS_ROLE and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        if not (m := _TURN.match(formatted, at)):
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def mask(offsets: list[tuple[int, int]], spans: list[tuple[int, int]]) -> tuple[list[bool], list[tuple[int, int]]]:
    """Loss per token, and the merged overlaps of token and turn spans."""
    ends = [e for _, e in spans]
    loss, kept = [], []
    for s, e in offsets:
        k = bisect_right(ends, s)  # the first span that ends after the token's start
        hit = False
        while k < len(spans) and spans[k][0] < e:
            a, b = max(s, spans[k][0]), min(e, spans[k][1])
            hit = True
            if kept and kept[-1][0] >= spans[k][0] and a <= kept[-1][1]:  # same turn, touching
                kept[-1] = (kept[-1][0], max(b, kept[-1][1]))
            else:
                kept.append((a, b))
            k += 1
        loss.append(hit)
    return loss, kept


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple[str, str]]]]:
    """(conv_id, turns) from rows sorted by conversation, over batch borders."""
    key, turns, any_row = None, [], False
    for b in batches:
        for conv, role, text in zip(b.column("conv").to_pylist(), b.column("role").to_pylist(), b.column("text").to_pylist()):
            if any_row and conv != key:
                yield key, turns
                turns = []
            key, any_row = conv, True
            turns.append((role, text))
    if any_row:
        yield key, turns


def format_conversations(rows: DataFrame, vocabulary: str, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv, ``formatted``, ``token_ids``,
    ``loss_mask`` (0/1 per token) and ``loss_spans`` (start, end in code points)."""
    narrow = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    kind = narrow.schema["conv"].dataType.simpleString()
    arrow_spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    names = ["conv", "formatted", "token_ids", "loss_mask", "loss_spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _encoder(vocabulary)
        kind_of: list[pa.DataType] = []

        def typed(it):
            for b in it:
                kind_of[:] = [b.schema.field("conv").type]
                yield b

        out: list[list] = [[] for _ in names]
        held = 0
        for conv, turns in _conversations(typed(batches)):
            text, spans = render(turns)
            enc = tokenizer.encode(text, add_special_tokens=False)
            loss, kept = mask(enc.offsets, spans)
            for col, value in zip(out, (conv, text, enc.ids, [int(x) for x in loss], [{"start": a, "end": b} for a, b in kept])):
                col.append(value)
            held += len(text)
            if held > 2_000_000:
                yield _batch(out, names, kind_of[0], arrow_spans)
                out, held = [[] for _ in names], 0
        if out[0]:
            yield _batch(out, names, kind_of[0], arrow_spans)

    dealt = narrow.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    schema = f"conv {kind}, formatted string, token_ids array<int>, loss_mask array<tinyint>, loss_spans array<struct<start:bigint,end:bigint>>"
    return dealt.mapInArrow(run, schema).withColumnRenamed("conv", conv_col)


def _batch(out: list[list], names: list[str], conv_type: pa.DataType, arrow_spans: pa.DataType) -> pa.RecordBatch:
    types = [conv_type, pa.string(), pa.list_(pa.int32()), pa.list_(pa.int8()), arrow_spans]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)


def read_back(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Digests of what the formatted text and its mask hold, parsed again."""
    kind = formatted.schema[conv_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, turn_hash, chars, loss_hash, length = [], [], [], [], []
            for text, spans in zip(b.column("formatted").to_pylist(), b.column("loss_spans").to_pylist()):
                turns = parse(text)
                loss = "".join(unescape(text[s["start"]:s["end"]]) for s in spans)
                n.append(len(turns))
                turn_hash.append(hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest())
                chars.append(len(loss))
                loss_hash.append(hashlib.sha256(loss.encode()).hexdigest())
                length.append(len(text))
            yield pa.RecordBatch.from_arrays(
                [b.column("conv"), pa.array(n, pa.int64()), pa.array(turn_hash, pa.string()), pa.array(chars, pa.int64()), pa.array(loss_hash, pa.string()), pa.array(length, pa.int64())],
                ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    narrow = formatted.select(F.col(conv_col).alias("conv"), "formatted", "loss_spans")
    return narrow.mapInArrow(run, f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long").withColumnRenamed("conv", conv_col)


def oracle_sql() -> str:
    """The digests of ``read_back`` for the table ``conversations`` and the probe conversation, in DuckDB SQL."""
    text = r"(len(regexp_extract_all(text, '\\|#|</turn>')))"
    role = r"(len(regexp_extract_all(role, '\\|#|:|</turn>')))"
    return rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       sum({len(HEAD) + len(COLON) + len(END)} + length(role) + {role} + length(text) + {text})::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""
