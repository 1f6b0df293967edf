import hashlib

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from linecast.llm import chat as C
from linecast.llm.common import table
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXT = st.text(st.sampled_from("a\\#<>/:turn \nAé日😀"), max_size=30) | st.lists(st.sampled_from(["### ", "</turn>", "\\", "</turn", "###", ": ", "x", "\n", " </turn>\n"]), max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a:b", "", "</turn>", "# x"]), TEXT), max_size=6))
def test_round_trip_and_mask(turns):
    text, spans = C.render(turns)
    assert C.parse(text) == turns
    enc = C._encoder(PATH).encode(text, add_special_tokens=False)
    loss, kept = C.mask(enc.offsets, spans)
    assert "".join(C.unescape(text[a:b]) for a, b in kept) == "".join(t for r, t in turns if r == "assistant")
    assert loss == [any(s < y and x < e for x, y in spans) for s, e in enc.offsets]


def digests(rows):
    turns = "".join(f"{r or ''}\n{t or ''}\n" for r, t in rows)
    loss = "".join(t or "" for r, t in rows if r == "assistant")
    return len(rows), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_conversations(spark):
    rows = table(spark, SF_SMALL, "conversations")
    by = {}
    for r in rows.orderBy("conv_id", "turn").collect():
        by.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    got = C.read_back(C.format_conversations(rows, PATH)).collect()
    assert {r["conv_id"]: tuple(r)[1:5] for r in got} == {k: digests(v) for k, v in by.items()}


def test_probe_conversation(spark):
    import __spark_entry__ as E

    probe = r"\### Assistant: </turn> ok"
    (row,) = E.queries()["op8_chat"](spark, SF_SMALL).where("conv_id = -7").collect()
    assert tuple(row)[1:5] == digests([("user", probe), ("assistant", probe)])


def test_awkward_rows(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", None), (1, None, None, "first"), (None, 1, "assistant", "n"), (2, 1, "assistant", ""), (3, 1, "assistant", "t"), (3, 1, "assistant", "t"), (4, 0, "user", "long " * 30_000), (4, 1, "assistant", "long " * 30_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' as conv", "1 as formatted", "2 as loss_spans")
    got = {r["conv_id"]: tuple(r)[1:5] for r in C.read_back(C.format_conversations(df, PATH)).collect()}
    assert got == {
        1: digests([("", "first"), ("user", ""), ("assistant", "b")]), None: digests([("assistant", "n")]), 2: digests([("assistant", "")]),
        3: digests([("assistant", "t")] * 2), 4: digests([("user", "long " * 30_000), ("assistant", "long " * 30_000)]),
    }
    assert C.format_conversations(df.limit(0), PATH).collect() == []
