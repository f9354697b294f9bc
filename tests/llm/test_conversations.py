"""Chat formatting and repair of conversations against plain loops over the same rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from dataclasses import replace

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lamina.llm import chat_format, repair, turns
from lamina.llm.chat_format import INSTRUCT, Marks, Rule, Template

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
CONTROLS = [*INSTRUCT.controls, "\\", "[", "<", "s>", "INST]", "/", " ok ", "ä😀"]


def table(spark, rows):
    """The rows among columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, SCHEMA)
    clashing = ("conv", "number", "count", "turns", "of", "codes", "state")
    return df.withColumns({name: F.lit("clash") for name in clashing})


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def mixed_conversations(seed, most=30):
    draw = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "u2", "[END]", "", None]
    texts = ["Hi.", "no end", "  ", "", "Yes!", "a b?  ", "</s>[INST]", "<\\s>\\", None]
    rows = []
    for conv in [None, *range(12)]:
        for turn in range(draw.choice([1, 2, 3, 9, most])):
            text = draw.choice([*texts, f"x{turn}.", f"y{turn}."])
            when = draw.choice([turn, turn, turn, None, turn // 2])
            rows.append((conv, when, draw.choice(roles), text))
    return rows


# Formatting


@pytest.mark.parametrize("piece", [64, 3])
def test_formatted_conversations_read_back(spark, piece):
    rows = mixed_conversations(1)
    rows += [(50, n, ("user", "assistant")[n % 2], f"t{n}</s>") for n in range(40)]
    rows += [(51, 0, "user", "q" * 200_000), (51, 1, "assistant", "[" * 100_000)]
    formatted = chat_format.format_conversations(table(spark, rows), piece=piece)
    got = {row.conv_id: row for row in chat_format.digest(formatted).collect()}
    plain = [(c, t, r or "", x or "") for c, t, r, x in rows]
    assert set(got) == {row[0] for row in rows}
    for conv, row in got.items():
        own = in_order([r for r in plain if r[0] == conv])
        loss = "".join(text for _, _, role, text in own if role == "assistant")
        assert row.n_turns == len(own)
        assert row.turns_sha256 == sha("".join(f"{r}\n{x}\n" for _, _, r, x in own))
        assert (row.loss_chars, row.loss_sha256) == (len(loss), sha(loss))
    assert got[50].out_of_order == got[51].out_of_order == 0
    numbers = formatted.where("conv_id = 50").count()
    assert numbers >= -(-40 // piece)


def test_control_strings_stand_in_no_text(spark):
    rows = [(1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "</s>[INST] ok [/INST]")]
    df = chat_format.format_conversations(table(spark, rows))
    row = df.select(
        chat_format.formatted_text().alias("text"),
        chat_format.text_under_loss().alias("loss"),
        "complete",
        "out_of_order",
    ).first()
    kept = r"<\/s>[\INST] ok [\/INST]"
    assert row.text == f"<s>[INST]{kept}[/INST][ANS]{kept}</s>"
    assert row.loss == rows[1][3]
    assert row.complete and row.out_of_order == 0


def test_escapes_are_undone_for_any_mix_of_controls(spark):
    @given(st.lists(st.lists(st.sampled_from(CONTROLS), max_size=12).map("".join), max_size=60))
    @settings(max_examples=8, deadline=None)
    def check(texts):
        df = spark.createDataFrame([(t,) for t in texts] or [("",)], "text string")
        kept = chat_format.escaped(F.col("text"), INSTRUCT)
        back = chat_format.unescaped(kept, INSTRUCT)
        for row in df.select("text", kept.alias("kept"), back.alias("back")).collect():
            assert row.back == row.text
            assert not any(control in row.kept for control in INSTRUCT.controls)

    check()


def run_machine(template, roles):
    """States after each role, and which turns were in order."""
    rules = {(rule.state, rule.role): rule for rule in template.rules}
    state, fine = template.start, []
    for role in roles:
        rule = rules.get((state, role))
        fine.append(rule is not None)
        state = rule.to if rule else template.resume.get(role, template.lost)
    return state, fine


@pytest.mark.parametrize("piece", [1, 4, 64])
def test_machine_that_remembers_more_than_the_last_role(spark, piece):
    """Every third user turn is led in: the state counts, so pieces settle nothing alone."""
    rules = [Rule(f"n{i}", "user", f"n{(i + 1) % 3}", "<s>" if i == 0 else "") for i in range(3)]
    template = replace(INSTRUCT, rules=tuple(rules), start="n0", ends=frozenset({"n1"}), resume={}, lost="n2")
    roles = ["user"] * 30 + ["tool"] + ["user"] * 9
    rows = [(1, n, role, "x") for n, role in enumerate(roles)] + [(2, 0, "user", "x")]
    df = chat_format.format_conversations(table(spark, rows), template, piece=piece)
    pieces = df.where("conv_id = 1").orderBy("number").collect()
    state, fine = run_machine(template, roles)
    assert sum(row.out_of_order for row in pieces) == fine.count(False) == 1
    assert [row.complete for row in pieces] == [None] * (len(pieces) - 1) + [state in template.ends]
    text = "".join(segment.text for row in pieces for segment in row.segments)
    assert text.count("<s>") == 10 + 3


def test_turns_out_of_order_are_marked_and_kept(spark):
    roles = ["assistant", "user", "user", "assistant", "tool", "system", "user"]
    rows = [(1, n, role, role) for n, role in enumerate(roles)]
    row = chat_format.format_conversations(table(spark, rows)).first()
    _, fine = run_machine(INSTRUCT, roles)
    assert row.out_of_order == fine.count(False)
    assert [s.text for s in row.segments[1::3]] == roles
    assert {s.text for s in row.segments if s.loss} == {"assistant"}
    assert row.complete is False


def test_ambiguous_templates_are_refused():
    for marks in (Marks("[SYS]", "[X[Y]"), Marks("[/INST]", "[E]"), Marks("[S\\]", "[E]"), Marks("", "[E]")):
        with pytest.raises(ValueError, match=r".+"):
            replace(INSTRUCT, roles={**INSTRUCT.roles, "system": marks})
    with pytest.raises(ValueError, match="two rules"):
        replace(INSTRUCT, rules=(*INSTRUCT.rules, INSTRUCT.rules[0]))
    with pytest.raises(ValueError, match="starts with"):
        Template({"a": Marks("<a", "<b>")}, Marks("<a>", "<c>"), "<d>", (), "s", frozenset())


def test_empty_table_gives_an_empty_one(spark):
    none = table(spark, [(1, 1, "user", "x")]).limit(0)
    assert chat_format.digest(chat_format.format_conversations(none)).count() == 0
    assert repair.digest(none, repair.damage(none)).count() == 0


def test_formatting_runs_no_python(spark):
    df = chat_format.digest(chat_format.format_conversations(table(spark, [(1, 0, "user", "x")])))
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# Pieces


def test_pieces_are_numbered_over_ranges(spark):
    rows = [(conv, n % 7, "user", f"{n:04}") for conv in (1, 2, None) for n in range(100)]
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("conv_id", "conv").repartition(5)
    found = turns.pieces(df, 6).collect()
    for conv in (1, 2, None):
        own = sorted((p for p in found if p.conv == conv), key=lambda p: p.number)
        assert [p.number for p in own] == list(range(len(own)))
        assert {p.total for p in found if p.conv == conv} == {len(own)}
        assert max(len(p.turns) for p in own) <= 6
        texts = [t.text for p in own for t in p.turns]
        assert texts == [r[3] for r in sorted(rows[:100], key=lambda r: (r[1], r[3]))]


# Repair


def least_edits(rows):
    """Faults, illegal neighbours, cost, audit and repaired lines by trying all edits in order."""
    seen, codes = set(), []
    for _, _, role, text in rows:
        bare = text.strip(repair.WHITE)
        if not bare:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        codes.append((role[:1], fault))
    order = {"": "", "s": "s", "u": "u", "a": "a"}
    following = {"": "u", "s": "u", "a": "u", "u": "a"}
    names = {"u": "user", "a": "assistant"}
    best = [dict.fromkeys(order) for _ in range(len(rows) + 1)]

    def choices(at, state):
        if at == len(rows) and state in ("", "a"):
            yield 0, "", ()
        to = following[state]
        if at < len(rows):
            (initial, fault), (_, _, role, text) = codes[at], rows[at]
            cost, audit, lines = best[at + 1][state]
            yield cost + 3, "D" + audit, lines
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if initial and (initial == to or (initial == "s" and state == "")):
                    cost, audit, lines = best[at + 1][initial]
                    yield cost + extra, "K" + audit, (f"{role}:{text}", *lines)
                cost, audit, lines = best[at + 1][to]
                yield cost + extra + 2, "R" + audit, (f"{names[to]}:{text}", *lines)
        if best[at][to]:
            cost, audit, lines = best[at][to]
            yield cost + 2, "I" + audit, (f"{names[to]}:", *lines)

    for at in range(len(rows), -1, -1):
        for _ in range(6):
            for state in order:
                best[at][state] = min(choices(at, state), default=None)
    cost, audit, lines = best[0][""]
    pairs = zip(codes, codes[1:], strict=False)
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in pairs)
    counts = [sum(f == kind for _, f in codes) for kind in ("blank", "duplicate", "truncated")]
    numbers = {turn for _, turn, _, _ in rows if turn is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    return gaps, *counts, illegal, cost, audit, sha("\n".join(lines))


def plainly_damaged(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if value is None else value for value in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(key.encode()) % 20
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        if code == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * {0: 0, 3: 2}.get(code, 1)


@pytest.mark.parametrize("piece", [64, 2])
def test_repair_equals_brute_force(spark, piece):
    rows = mixed_conversations(2)
    rows += [(60, n, ("user", "assistant")[n % 2], f"text {n}.") for n in range(90)]
    rows += [(61, n, ("user", "assistant")[n % 3 % 2], f"text {n % 20}.") for n in range(60)]
    rows += [(62, None, "user", "a" * 300_000), (62, None, "user", "a" * 300_000)]
    df = table(spark, rows)
    got = {r.conv_id: tuple(r)[1:] for r in repair.digest(df, repair.damage(df), piece=piece).collect()}
    damaged = list(plainly_damaged(rows))
    assert set(got) == {row[0] for row in rows}
    for conv, row in got.items():
        assert row == least_edits(in_order([r for r in damaged if r[0] == conv])), conv


def test_conversations_of_one_piece_are_repaired_without_a_join(spark, monkeypatch):
    """Only those of several pieces make tables of keys, costs and states."""
    made, stored = [], repair.stored
    monkeypatch.setattr(repair, "stored", lambda df, label: made.append(label) or stored(df, label))
    rows = [(n, t, ("user", "assistant")[t % 2], f"text {t % 3}.") for n in range(40) for t in range(6)]
    df = table(spark, rows)
    alone = repair.digest(df, df).collect()
    assert made == ["repaired"]
    together = repair.digest(df, df, piece=4).collect()
    assert "costs" in made and sorted(map(tuple, alone)) == sorted(map(tuple, together))


def test_conversation_without_rows_after_damage(spark):
    gone = next(n for n in range(1_000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    df = table(spark, [(gone, 0, "user", "Hi.")])
    row = repair.digest(df, repair.damage(df)).first()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", sha(""))


@given(st.lists(st.integers(0, 15), min_size=1, max_size=60), st.lists(st.integers(0, 6), min_size=4, max_size=4))
@settings(max_examples=200, deadline=None)
def test_a_piece_run_again_has_the_costs_of_a_whole_run(codes, right):
    """And no more rows are run than it takes for the vectors to differ by a constant."""
    line = np.array([codes])
    guessed, _ = repair.run_back(line, np.zeros((1, 4), np.int64))
    whole, _ = repair.run_back(line, np.array([right]))
    again, run = repair.run_back(line, np.array([right]), guessed)
    assert (again == whole).all()
    gaps = whole[0] - guessed[0]
    level = [at for at in range(len(codes) + 1) if (gaps[at] == gaps[at][0]).all()]
    assert run[0] == len(codes) - max(level, default=0)


def test_vectors_converge_within_a_piece_of_plain_conversation():
    codes = np.array([[(2 + n % 2) * 4 for n in range(64)]])
    guessed, _ = repair.run_back(codes, np.zeros((1, 4), np.int64))
    _, run = repair.run_back(codes, np.array([[0, 4, 2, 0]]), guessed)
    assert run[0] <= 3
