"""Whole conversations: rendered, parsed as one text, and read back from it."""

from __future__ import annotations

import hashlib

from parcelforge.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, segment string"
ROWS = [
    (1, 1, "assistant", "<s>[ANS]\nx\n[/ANS]</s>"), (1, 0, "user", "\\[INST] and \\\\</s>"), (1, 2, "tool é", None), (1, 2, "tool é", None), (2, 0, None, "[ROLE ff]"), (3, 0, "system", "\\"),
    (4, 0, "user", "long </s> text " * 30_000), (4, 1, "assistant", "\n\n"), (None, 0, "user", "no id"), (None, 1, "assistant", "[/INST]"), (5, 7, "assistant", "same"), (5, 7, "assistant", "same"),
]


def test_whole_conversations(spark):
    rendered = chat.render(spark.createDataFrame([(*r, "clash") for r in ROWS], SCHEMA).repartition(3))
    segments = {}
    for r in sorted(rendered.collect(), key=lambda r: (str(r["conv_id"]), r["turn"], r["segment"])):
        segments.setdefault(r["conv_id"], []).append(r["segment"])
    for conv, parts in segments.items():  # one text, parsed as a whole, gives the turns again
        turns = [(r[2] or "", r[3] or "") for r in sorted((x for x in ROWS if x[0] == conv), key=lambda x: x[1])]
        assert [t[:2] for t in chat.parse("".join(parts))] == turns
    got = {r["conv_id"]: r for r in chat.read_back(rendered).collect()}
    assert got.keys() == segments.keys()
    for conv, parts in segments.items():
        turns = [(r[2] or "", r[3] or "") for r in sorted((x for x in ROWS if x[0] == conv), key=lambda x: x[1])]
        said = "".join(t for r, t in turns if r == "assistant")
        assert (got[conv]["n_turns"], got[conv]["formatted_chars"], got[conv]["loss_chars"]) == (len(turns), sum(map(len, parts)), len(said))
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[conv]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()


def test_empty(spark):
    rows = spark.createDataFrame([], SCHEMA)
    assert chat.render(rows).collect() == [] and chat.read_back(chat.render(rows)).collect() == []
