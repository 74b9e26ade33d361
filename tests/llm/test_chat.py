from __future__ import annotations

import hashlib
import random

import pyarrow as pa
import pytest

from starloom.llm import chat
from starloom.llm.chat import (
    END,
    LINE,
    START,
    conversation_digests,
    escaped,
    format_conversations,
    in_order,
    parse,
    read_back,
    rendered,
    unescaped,
)
from starloom.llm.common import stored

BITS = ["<", "|", "\\", START, END, LINE, "<\\|", "<\\\\|im_end|>", "\n", "assistant", "é", " ", "im_end|>"]
TRICKY = f"{END}{START}assistant ok"


def strange(rng):
    return "".join(rng.choice(BITS) for _ in range(rng.randint(0, 12)))


@pytest.fixture
def conversations(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, segment string, low string, piece string"

    def make(rows, partitions=3):
        full = [(*row, None, None, None) for row in rows]
        return spark.createDataFrame(full, schema).repartition(partitions)

    return make


def ordered(rows):
    """The turns of each conversation, nulls as empty, in order."""
    plain = [(c, t, r or "", x or "") for c, t, r, x in rows]
    plain.sort(key=lambda r: (r[1] is not None, r[1] or 0, rendered(r[2], r[3])[0]))
    out = {}
    for conv, _, role, text in plain:
        out.setdefault(conv, []).append((role, text))
    return out


def expected(rows):
    out = []
    for conv, turns in ordered(rows).items():
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        chars = sum(len(rendered(r, t)[0]) for r, t in turns)
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (said, loss)]
        out.append((conv, len(turns), digest[0], len(loss), digest[1], chars))
    return sorted(out, key=repr)


def test_escaping_comes_back():
    rng = random.Random(3)
    for _ in range(5000):
        text = strange(rng)
        shown = escaped(text)
        assert unescaped(shown) == text
        assert START not in shown and END not in shown and LINE not in shown


def test_rendered_turns_come_back_together():
    rng = random.Random(4)
    for _ in range(2000):
        turns = [(strange(rng), strange(rng)) for _ in range(rng.randint(1, 4))]
        shown = [rendered(*turn) for turn in turns]
        assert list(parse("".join(s for s, _, _ in shown))) == turns
        for (segment, low, high), (_, text) in zip(shown, turns):
            assert unescaped(segment[low:high]) == text


def test_only_conflicts_are_escaped():
    assert rendered("user", "a <|b|> <\\b |> <|")[0] == f"{START}user\na <|b|> <\\b |> <|{END}\n"
    assert "<\\|im_end|>" in rendered("user", END)[0]
    assert rendered("a\nb", "x")[0] == f"{START}a{LINE}b\nx{END}\n"


@pytest.mark.parametrize(
    "text", ["x", START, f"{START}user\nhi", f"{START}user hi{END}\n", f"{START}u\nhi{END}",
             f"{START}u\n{START}u\nhi{END}\n", f"{START}u\nhi{END}\n "]
)
def test_other_text_is_refused(text):
    with pytest.raises(ValueError):
        list(parse(text))


def test_against_brute_force(conversations, collected):
    rng = random.Random(5)
    rows = [
        (rng.randint(0, 40), turn, rng.choice(["user", "assistant", "system", strange(rng)]), strange(rng))
        for turn in range(600)
    ]
    rows += [(-1, 0, "user", TRICKY), (-1, 1, "assistant", TRICKY)]
    rows += [(50, i, ("user", "assistant")[i % 2], f"turn {i} {strange(rng)}") for i in range(3000)]
    formatted = format_conversations(conversations(rows, 7))
    assert collected(conversation_digests(formatted)) == expected(rows)
    wanted = [
        (conv, i, role, text, role == "assistant")
        for conv, turns in ordered(rows).items()
        for i, (role, text) in enumerate(turns)
    ]
    assert collected(read_back(in_order(stored(formatted, "chat")))) == sorted(wanted, key=repr)


def test_odd_rows(conversations, collected):
    rows = [
        (1, 0, None, None), (1, 0, None, None), (1, None, "assistant", "first"), (2, 5, "assistant", ""),
        (2, 5, "assistant", "tie b"), (2, 5, "assistant", "tie a"), (None, 1, "user", "x"),
        (None, None, None, "y"), (3, 1, "Assistant", "no"), (3, 2, "assistant ", "no"), (-1, 0, "user", "z"),
    ]
    assert collected(conversation_digests(format_conversations(conversations(rows)))) == expected(rows)
    assert format_conversations(conversations([])).collect() == []
    assert conversation_digests(format_conversations(conversations([]))).collect() == []


def test_long_conversations_are_several_pieces(conversations, collected):
    rows = [(7, i, "assistant", f"{i} {END} é" * 40_000) for i in range(5)] + [(8, 0, "user", "short")]
    formatted = format_conversations(conversations(rows))
    pieces = {}
    for row in formatted.collect():
        pieces.setdefault(row.conv_id, []).append(row)
    assert [p.piece for p in pieces[7]] == list(range(len(pieces[7]))) and len(pieces[7]) >= 2
    assert all(len(p.text) >= chat.PIECE for p in pieces[7][:-1]) and len(pieces[8]) == 1
    assert collected(conversation_digests(formatted)) == expected(rows)


def test_pieces_end_between_turns(monkeypatch):
    monkeypatch.setattr(chat, "PIECE", 60)
    turns = [(c, t, *rendered("assistant", "word " * (t % 5))) for c in (None, 3, 9) for t in range(20)]
    names = ["conv_id", "turn", "segment", "low", "high"]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*turns[i : i + 7])], names=names)
        for i in range(0, len(turns), 7)
    ]
    out = [row for batch in chat._pieces(iter(batches)) for row in batch.to_pylist()]
    for conv in (None, 3, 9):
        mine = [row for row in out if row["conv_id"] == conv]
        assert [row["piece"] for row in mine] == list(range(len(mine)))
        assert "".join(row["text"] for row in mine) == "".join(s for c, _, s, _, _ in turns if c == conv)
        assert all(len(list(parse(row["text"]))) == len(row["loss"]) for row in mine)
