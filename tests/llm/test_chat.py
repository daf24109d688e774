"""Chat formatting against plain Python, its round trip and its defined cases."""

from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from strata.llm.chat_format import CHUNK, END, PROBE_ID, PROBE_TEXT, SEP, START, chat_digests, format_chat, read_chat, with_probe

TURNS = "conv_id long, turn long, role string, text string"


def coded(text: str) -> str:
    """One backslash more in every run between ``<`` and ``|``."""
    out, i = [], 0
    while i < len(text):
        j = i + 1
        while text[i] == "<" and j < len(text) and text[j] == "\\":
            j += 1
        if text[i] == "<" and j < len(text) and text[j] == "|":
            out.append("<\\" + text[i + 1 : j])
            i = j
        else:
            out.append(text[i])
            i += 1
    return "".join(out)


def plain(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int, int]]]:
    out, spans, before = "", [], None
    for k, (role, text) in enumerate(turns):
        out += SEP if k and role == before else (END if k else "") + START + role + "\n"
        start = len(out)
        out += coded(text)
        if role == "assistant" and text:
            spans.append((k, start, len(out)))
        before = role
    return out + END, spans


def random_turns(seed: int, n: int) -> list[tuple[str, str]]:
    rng = random.Random(seed)
    parts = ["<", "|", "\\", "<|", "|>", "<\\|", START, SEP, END, "\n", " ", "é", "漢", "😀", "word", "", "assistant"]
    return [(rng.choice(["user", "assistant", "system"]), "".join(rng.choices(parts, k=rng.randint(0, 8)))) for _ in range(n)]


def test_format_and_round_trip(spark):
    convs = {k: random_turns(k, 1 + k % 9) for k in range(60)} | {1000: random_turns(5, 3 * CHUNK + 7)}
    rows = [(k, t, role, text) for k, turns in convs.items() for t, (role, text) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    read = {r.conv_id: r for r in read_chat(format_chat(spark.createDataFrame(rows, TURNS))).collect()}
    assert set(read) == set(convs)
    for k, turns in convs.items():
        text, spans = plain(turns)
        assert read[k].formatted == text
        assert [tuple(s) for s in read[k].loss_spans] == spans
        assert [(t.role, t.text) for t in read[k].turns] == turns
        assert read[k].loss_text == "".join(t for role, t in turns if role == "assistant")
        assert read[k].n_blocks == sum(i == 0 or turns[i - 1][0] != turns[i][0] for i in range(len(turns)))


def test_roles_are_read_back(spark):
    roles = ["we ird\n<|role|>", "", "a+b%20", "ключ", "assistant "]
    rows = [(1, k, role, f"t{k}") for k, role in enumerate(roles)]
    got = read_chat(format_chat(spark.createDataFrame(rows, TURNS))).collect()[0]
    assert [t.role for t in got.turns] == roles and got.loss_spans == []


def test_digests_with_the_probe(spark):
    rows = [(7, 1, "assistant", "answer"), (7, 0, "user", None), (7, 2, "assistant", "more")]
    got = {r.conv_id: r for r in chat_digests(with_probe(spark.createDataFrame(rows, TURNS))).collect()}

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    assert got[7].turns_sha256 == sha("user\n\nassistant\nanswer\nassistant\nmore\n")
    assert (got[7].n_turns, got[7].loss_chars, got[7].loss_sha256) == (3, 10, sha("answermore"))
    probe = got[PROBE_ID]
    assert (probe.n_turns, probe.loss_chars, probe.loss_sha256) == (2, len(PROBE_TEXT), sha(PROBE_TEXT))
    assert probe.formatted_chars == len(plain([("user", PROBE_TEXT), ("assistant", PROBE_TEXT)])[0])


def test_chat_defined_cases(spark):
    rows = [
        (1, None, "assistant", "first"), (1, 0, None, "no role"), (1, 0, None, "no role"), (1, 0, "user", "b"), (1, 0, "user", "a"),
        (None, 0, "user", "x"), (None, 0, "user", "x"), (2, 0, None, None), (3, 0, "assistant", "w " * 200_000),
    ]
    clashing = spark.createDataFrame(rows, TURNS).withColumns({"turns": F.lit("mine"), "formatted": F.lit(1), "alone": F.lit(2)})
    read = read_chat(format_chat(clashing)).collect()
    assert len(read) == 5
    one = next(r for r in read if r.conv_id == 1)
    assert [(t.role, t.text) for t in one.turns] == [("assistant", "first"), ("", "no role"), ("", "no role"), ("user", "a"), ("user", "b")]
    assert next(r for r in read if r.conv_id == 2).formatted == f"{START}\n{END}"
    assert len(next(r for r in read if r.conv_id == 3).loss_text) == 400_000
    assert format_chat(clashing.limit(0)).collect() == []
