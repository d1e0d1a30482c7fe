from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adoptrend.llm import chat_format
from adoptrend.llm.chat_format import PROBE, bracketed, escaped, read_back, spans, unescaped
from adoptrend.llm.queries import QUERIES, SQL
from tests.llm.fixtures import CLASHING
from tests.parity import compare, oracle

PIECES = st.lists(st.sampled_from([*chat_format.CONTROLS, "\\", "<", "[", "/", "]", ">", " ", "\n", "s", "INST]", "é", PROBE, PROBE * 3, "a"]), max_size=9).map("".join)
TURNS = st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), PIECES), PIECES), max_size=6)


@given(PIECES)
@settings(max_examples=300, deadline=None)
def test_escapes_come_back(text):
    out = escaped(text)
    assert unescaped(out) == text
    assert not any(c in out for c in chat_format.CONTROLS)


@given(TURNS)
@settings(max_examples=300, deadline=None)
def test_round_trip_and_spans(turns):
    out, found, rewritten = spans(turns, bracketed)
    assert rewritten is None and read_back(out) == turns
    assert [unescaped(out[a:b]) for _, _, a, b in found] == [t for _, t in turns]
    # spans follow each other from the beginning's mark to the end
    edges = [len(chat_format.BOS), *[e for _, e, _, _ in found]]
    assert [s for s, _, _, _ in found] == edges[:-1] and edges[-1] == len(out)


def test_other_templates():
    turns = [("system", "be brief"), ("user", "hi"), ("assistant", "yo"), ("user", "bye"), ("assistant", "so")]

    def closed(said):  # the end mark moves with the last turn
        return "".join(f"<{r}>{t}" for r, t in said) + "|end"

    out, found, rewritten = spans(turns, closed)
    assert rewritten is None and [out[a:b] for _, _, a, b in found] == [t for _, t in turns]
    assert [out[s:e] for s, e, _, _ in found[:-1]] == [f"<{r}>{t}" for r, t in turns[:-1]]

    def forgetful(said):  # earlier answers are left out
        return "".join(f"<{r}>{t}" for i, (r, t) in enumerate(said) if r != "assistant" or i == len(said) - 1)

    out, found, rewritten = spans(turns, forgetful)
    assert (out, found, rewritten) == (forgetful(turns), [], 3)
    assert spans(turns[:3], forgetful)[2] is None

    def late_system(said):  # the system's text stands in front of the last turn of the user
        last = max((i for i, (r, _) in enumerate(said) if r == "user"), default=-1)
        head = said[0][1] if said and said[0][0] == "system" else ""
        return "".join(f"<{r}>{head if i == last else ''}{t}" for i, (r, t) in enumerate(said) if r != "system")

    assert spans(turns, late_system)[2] == 3

    def stripped(said):
        return "".join(f"<{r}>{t.strip()}</{r}>" for r, t in said)

    out, found, rewritten = spans([("user", " a "), ("assistant", "  ")], stripped)
    assert rewritten is None and [out[a:b] for _, _, a, b in found] == ["a", ""]

    def dropping(said):  # no tool output at all
        return "".join(f"<{r}>{t}" for r, t in said if r != "tool")

    out, found, rewritten = spans([("user", "a"), ("tool", "b"), ("assistant", "c")], dropping)
    assert rewritten is None and [out[a:b] for _, _, a, b in found] == ["a", "", "c"]


ODD = [
    (1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "\\[SYS]\\"), (1, None, "system", "first"),
    (2, 0, None, None), (2, 0, "assistant", "b"), (2, 0, "assistant", "a"), (2, 0, "assistant", "a"),
    (3, 7, "tool[/ROLE]", "é漢😀"), (4, 0, "assistant", ""), (None, 0, "user", "x"), (2**60 + 1, 0, "assistant", "y" * 200_000),
    *[(5, i, "user" if i % 2 else "assistant", f"turn {i} ") for i in range(300)],
]


def test_odd_rows(spark):
    df = spark.createDataFrame(ODD, "conv_id long, turn long, role string, text string")
    for name, value in {**CLASHING, "turns": 1, "formatted": 2, "spans": 3}.items():
        df = df.withColumn(name, F.lit(value))
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat_format.digests(chat_format.chat_format(df)).collect()}
    want = {}
    for c in {r[0] for r in ODD}:
        turns = sorted((t is not None, t or 0, r or "", x or "") for i, t, r, x in ODD if i == c)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        whole = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        want[c] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got == want
    assert chat_format.digests(chat_format.chat_format(df.limit(0))).count() == 0


def test_agrees_with_sql(spark):
    folder = "/root/testdata/sf0.01"
    verdict, note = compare(spark, oracle(folder), "op13_chat_format", folder, QUERIES, SQL)
    assert verdict == "ok", note


@pytest.mark.parametrize("text", ["", "<s>[INST]a", "<s>[INST]a[/INST]", "<s> a", "<s>a</s>", "<s>[ROLE]a</s>"])
def test_what_the_template_cannot_have_written(text):
    with pytest.raises(ValueError):
        read_back(text)
