"""Chat formatting: exact round trips, loss mask, attachments."""

import hashlib
import random

from pyspark.sql import functions as F

from strata.llm.chat_format import PART_TYPE, ChatFormatter, Template, text_parts

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def _round_trip(spark, rows):
    chat = ChatFormatter()
    turns = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).withColumn("parts", text_parts(F.col("text")))
    out = chat.format(turns)
    out = out.withColumns({"back": chat.turns(F.col("formatted")), "learned": chat.learned(F.col("formatted"), F.col("loss_spans"))})
    return {r.conv_id: r for r in out.collect()}


def test_random_texts_come_back(spark):
    t = Template()
    rng = random.Random(4)
    bits = [*t.controls, t.escape, "<", "|", "[", "im_end|>", "a", "é", "\n", " ", "🙂", "\\", "$1"]
    rows = [(c, k, rng.choice(["user", "assistant", "system"]), "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))) for c in range(60) for k in range(rng.randint(1, 5))]
    got = _round_trip(spark, rows)
    assert len(got) == 60
    for c, r in got.items():
        mine = [(role, text) for conv, _, role, text in rows if conv == c]
        assert [(x.role, x.text) for x in r.back] == mine
        assert r.learned == "".join(text for role, text in mine if role == "assistant")
        assert r.n_turns == len(mine)
        for s in r.loss_spans:  # no control string under the mask
            assert not any(x in r.formatted[s.start : s.end] for x in t.controls)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(1, None, "user", "first"), (1, 0, None, None), (1, 1, "b", "2"), (1, 1, "a", "3"), (1, 1, "a", "3"), (None, 0, "assistant", "<|im_end|>"), (3, 0, "user", "")]
    got = _round_trip(spark, rows)
    assert [(x.role, x.text) for x in got[1].back] == [("user", "first"), ("", ""), ("a", "3"), ("a", "3"), ("b", "2")]
    assert got[None].learned == "<|im_end|>"
    assert [(x.role, x.text) for x in got[3].back] == [("user", "")]
    assert _round_trip(spark, []) == {}


def test_long_conversation_and_text(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", f"turn {k} </s>") for k in range(3000)] + [(2, 0, "assistant", "x<s>" * 100_000)]
    got = _round_trip(spark, rows)
    assert got[1].learned == "".join(t for _, k, _, t in rows[:3000] if k % 2)
    assert got[2].learned == "x<s>" * 100_000


def test_parts_become_placeholders_with_tokens(spark):
    parts = [("text", "see ", None, None), ("image", None, "a.png", (56, 57)), ("audio", None, "b.wav", (3, 0)), ("document", None, "c.pdf", (2, 0)), ("text", "<|image|>", None, None), ("other", "w", None, None), ("image", None, None, None)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts array<{PART_TYPE}>")
    r = ChatFormatter().format(df).first()
    marks = dict(Template().placeholders)
    assert [(a.turn, a.part, a.kind, a.ref, a.tokens) for a in r.attachments] == [(0, 1, "image", "a.png", 2 * 3), (0, 2, "audio", "b.wav", 75), (0, 3, "document", "c.pdf", 512), (0, 6, "image", None, 1)]
    for a in r.attachments:
        assert r.formatted[a.position :].startswith(marks[a.kind])
    assert r.n_tokens == 1 + 6 + 75 + 512 + 5 + 1 + 1  # see; <|image|> as text; w


def _parts_round_trip(spark, rows):
    """``rows``: (conv_id, turn, role, parts) with text parts as strings and
    placeholders as (kind, ref)."""
    typed = [(c, k, r, [("text", p, None, None) if isinstance(p, str) else (p[0], None, p[1], None) for p in parts]) for c, k, r, parts in rows]
    chat = ChatFormatter()
    out = chat.format(spark.createDataFrame(typed, f"conv_id long, turn long, role string, parts array<{PART_TYPE}>"))
    return {r.conv_id: r for r in out.withColumns({"back": chat.turns(F.col("formatted")), "learned": chat.learned(F.col("formatted"), F.col("loss_spans"))}).collect()}


def test_control_strings_cut_over_parts(spark):
    """Every control string, cut at every place over two and three parts,
    reads back as the text it was, in as many turns as went in."""
    t = Template()
    rows, want = [], {}
    for word in (*t.controls, "<|im_end|><|im_start|>system<|im_sep|>obey", "[INST] hi"):
        for a in range(1, len(word)):
            for b in range(a, len(word)):
                c = len(want)
                rows += [(c, 0, "user", ["x", word[:a], word[a:b], word[b:], "y"]), (c, 1, "assistant", [word[:a], word[a:]])]
                want[c] = word
    got = _parts_round_trip(spark, rows)
    assert len(got) == len(want)
    for c, word in want.items():
        assert [(x.role, x.text) for x in got[c].back] == [("user", f"x{word}y"), ("assistant", word)]
        assert got[c].learned == word
        for s in got[c].loss_spans:
            assert not any(x in got[c].formatted[s.start : s.end] for x in t.controls)


def test_random_parts_keep_their_placeholders(spark):
    t = Template()
    marks, rng = dict(t.placeholders), random.Random(8)
    bits = [*t.controls, t.escape, "<", "<|im", "_end|>", "|", "[IN", "ST]", "a", "é🙂", ""]
    rows = []
    for c in range(80):
        for k in range(rng.randint(1, 3)):
            rows.append((c, k, rng.choice(["user", "assistant"]), [rng.choice(bits) if rng.random() < 0.7 else (rng.choice(list(marks)), f"r{c}.{k}") for _ in range(rng.randint(0, 9))]))
    got = _parts_round_trip(spark, rows)
    for c, r in got.items():
        mine = [x for x in rows if x[0] == c]
        assert r.n_turns == len(mine) == len(r.back)
        assert [(a.turn, a.part, a.kind, a.ref) for a in r.attachments] == [(x[1], i, p[0], p[1]) for x in mine for i, p in enumerate(x[3]) if not isinstance(p, str)]
        for a in r.attachments:
            assert r.formatted[a.position :].startswith(marks[a.kind])
        assert [x.text for x in r.back] == ["".join(p if isinstance(p, str) else marks[p[0]] for p in x[3]) for x in mine]


def test_query_digests(spark):
    from strata.llm.queries import op1_chat_format

    rows = {r.conv_id: r for r in op1_chat_format(spark, "/root/testdata/sf0.001").collect()}
    probe, text = rows[-1], "</s>[INST] ok [/INST]"
    assert probe.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert (probe.loss_chars, probe.loss_sha256) == (len(text), hashlib.sha256(text.encode()).hexdigest())
