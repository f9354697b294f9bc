r"""Structure of conversations repaired at the least cost: a Viterbi search in parallel.

A conversation is in order if the initials of its roles read `(s?(ua)+)?`. Rows may be kept
(cost 0), given the role user or assistant (2) or deleted (3), and an empty turn of user or
assistant may be inserted anywhere (2). Blank rows and repeated ones must be deleted, a
truncated row costs 1 more unless it is. Of the cheapest edits those whose initials come
first in ASCII are taken.

The search is the parallel Viterbi by rank convergence. Conversations are cut into pieces.
Each piece computes its costs backwards from a guessed vector (what the rest costs from each
state), all at once. In a fix-up pass, a piece whose guess differs from what the next piece
has found by more than a constant runs again from there, until its vectors differ from the
earlier ones by a constant only; all vectors before that one then differ by the same
constant, which changes no choice. Passes go on until no piece is left to run. The costs of
each piece, stitched in this way, drive the trace of the least edits through it for each
state it may be entered in, and the pieces are joined as maps of states. A conversation of
one piece has no others to wait for: it is repaired where its rows are, and nothing is joined.

Null roles and texts are one space. Rows are in the order of turn, role and text, nulls
first; rows that are equal in all of these are repeats of the first. A role without an
initial cannot be kept. Rows without a conversation are one conversation. An empty table
gives an empty one. Other columns are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.turns import PIECE, pieces, states_before
from lamina.sources import stored

# White space, the marks that end a text, and what edits cost.
WHITE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

# Initials of roles; 0 is any other. Faults of rows.
SYSTEM, USER, ASSISTANT = 1, 2, 3
BLANK, DUPLICATE, SHORT = 1, 2, 3
_FAULTS = 4
#: A code that leaves the costs as they are, for places without a row.
_NO_ROW = 16

# States by the last role so far: none, system, user, assistant.
_STATES = 4
_NEXT = (2, 2, 3, 2)
#: What the rest costs after the last row.
_FINAL = np.array([0, 4, 2, 0], np.int64)
_FAR = 1 << 40
#: Conversations of one piece that are repaired together.
ALONE = 512


def damage(convs: DataFrame) -> DataFrame:
    """The rows of `conversations` with a fault in about a fourth of them, by their hash."""
    number = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    code = F.crc32(number) % 20
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("role", "text"))
    rows = convs.select(
        "conv_id",
        "turn",
        F.when(code == 4, "user").otherwise(role).alias("role"),
        F.when(code == 1, "")
        .when(code == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text)
        .alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("times"),
    )
    return rows.where("times > 0").select(
        "conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("times")))
    ).drop("col")


def repair(
    rows: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    piece: int = PIECE,
) -> DataFrame:
    """A row a piece of each conversation, in a stored table.

    `conv_id`, `number`, the rows that are `blank`, `duplicate` and `truncated`, the `illegal`
    neighbours (the last row's with the next piece's first too), `cost` (the sum over the
    pieces is the conversation's), the edits' initials `audit`, and the repaired `turns`.
    """
    given = rows.select(
        F.col(conv_id).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
    )
    cut = pieces(given, piece)
    kind = cut.schema["conv"].dataType.simpleString()
    short, long = cut.where("total = 1"), cut.where("total > 1")
    repaired = _repaired_alone(short, kind)
    if not long.select("conv").isEmpty():
        repaired = repaired.unionAll(_repaired_together(long, kind))
    return stored(repaired.withColumnRenamed("conv", "conv_id"), "repaired")


_COUNTS = "blank bigint, duplicate bigint, truncated bigint, illegal bigint"
_TURNS = "turns array<struct<role:string,text:string>>"


def _repaired_alone(cut: DataFrame, kind: str) -> DataFrame:
    """Conversations of one piece, each from its own rows alone: nothing is joined."""
    marks = cut.select("conv", "number", "total", F.transform("turns", _mark).alias("marks"), "turns")
    coded = marks.select(
        "conv",
        "number",
        "total",
        F.transform("marks", lambda m, i: _code(m, i, F.lit(False))).alias("codes"),
        F.lit(None).cast("tinyint").alias("follow"),
        F.col("turns.role").alias("roles"),
        F.col("turns.text").alias("texts"),
    )
    return coded.mapInArrow(
        _alone_batches, f"conv {kind}, number int, {_COUNTS}, cost bigint, audit string, {_TURNS}"
    )


def _repaired_together(cut: DataFrame, kind: str) -> DataFrame:
    """Conversations of several pieces, whose costs and states go over from piece to piece."""
    costs = _converged(_guessed(_coded(cut)))
    shape = f"conv {kind}, number int, {_COUNTS}"
    traced = stored(
        costs.mapInArrow(
            _trace_batches,
            f"{shape}, left array<bigint>, base bigint, audits array<string>, after array<int>",
        ),
        "traced",
    )
    entered = _placed(states_before(traced.select("conv", "number", "after"), 0), "entered")
    chosen = traced.join(entered, _same_piece("entered")).select(
        "conv",
        "number",
        "blank",
        "duplicate",
        "truncated",
        "illegal",
        (F.col("base") + F.when(F.col("number") == 0, F.col("left")[0]).otherwise(0)).alias("cost"),
        F.element_at("audits", F.col("state") + 1).alias("audit"),
        "state",
    )
    texts = _placed(cut.select("conv", "number", "turns"), "texts")
    kept = [name for name in chosen.columns if name != "state"]
    edited = chosen.join(texts, _same_piece("texts")).select(
        *kept, "state", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts")
    )
    return edited.mapInArrow(_edit_batches, f"{shape}, cost bigint, audit string, {_TURNS}")


def digest(original: DataFrame, damaged: DataFrame, piece: int = PIECE) -> DataFrame:
    """A row a conversation of `original`, with what repairing `damaged` found and did.

    A digest is of the whole conversation, so its repaired pieces come together here.
    """
    parts = repair(damaged, piece=piece).select(
        F.col("conv_id").alias("of"),
        "blank",
        "duplicate",
        "truncated",
        "illegal",
        "cost",
        F.struct("number", "audit", F.transform("turns", _line).alias("lines")).alias("part"),
    )
    ordered = F.sort_array(F.collect_list("part"))
    sums = [F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated", "illegal", "cost")]
    whole = parts.groupBy("of").agg(
        *sums,
        F.array_join(F.transform(ordered, lambda p: p["audit"]), "").alias("audit"),
        F.array_join(F.flatten(F.transform(ordered, lambda p: p["lines"])), "\n").alias("all"),
    )
    # Distinct turns combine by conversation and turn before they are counted.
    turn = F.col("turn")
    gaps = damaged.groupBy(F.col("conv_id").alias("gaps_of")).agg(
        (F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn)).alias("gaps")
    )
    every = original.select("conv_id").distinct()
    joined = every.join(whole, F.col("conv_id").eqNullSafe(F.col("of")), "left").join(
        gaps, F.col("conv_id").eqNullSafe(F.col("gaps_of")), "left"
    )
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        "conv_id",
        *[F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.sha2(F.coalesce("all", F.lit("")), 256).alias("repaired_sha256"),
    )


def _line(turn: Column) -> Column:
    return F.concat(turn["role"], F.lit(":"), turn["text"])


def _placed(df: DataFrame, prefix: str) -> DataFrame:
    """The piece's columns under names of their own, for a join by `_same_piece`."""
    return df.withColumnsRenamed({"conv": f"{prefix}_of", "number": f"{prefix}_at"})


def _same_piece(prefix: str) -> Column:
    return F.col("conv").eqNullSafe(F.col(f"{prefix}_of")) & (
        F.col("number") == F.col(f"{prefix}_at")
    )


def _mark(turn: Column) -> Column:
    """What decides the code of a row: its initial, how its text ends, and a key of its rest."""
    bare = F.lit(WHITE)
    initial = F.substring(turn["role"], 1, 1)
    place = F.array_position(F.array(*map(F.lit, "sua")), initial)
    end = F.right(F.rtrim(turn["text"], bare), F.lit(1))
    whole = F.concat(F.length(turn["role"]), F.lit(":"), turn["role"], turn["text"])
    return F.struct(
        place.cast("int").alias("initial"),
        (end == "").alias("blank"),
        (~F.array_contains(F.array(*map(F.lit, ENDS)), end)).alias("short"),
        F.unhex(F.md5(whole)).alias("key"),
    )


def _code(m: Column, i: Column, elsewhere: Column) -> Column:
    """Initial and first fault of the row at place `i` of `marks`; `elsewhere` tells whether an
    earlier piece has it too."""
    here = F.array_position(F.transform("marks", lambda x: x["key"]), m["key"]) <= i
    fault = (
        F.when(m["blank"], BLANK)
        .when(here | elsewhere, DUPLICATE)
        .when(m["short"], SHORT)
        .otherwise(0)
    )
    return (m["initial"] * _FAULTS + fault).cast("tinyint")


def _coded(cut: DataFrame) -> DataFrame:
    """`conv`, `number`, `total`, `codes` (initial and first fault a row) and `follow`, the code
    of the next piece's first row. Built-in functions alone; texts go no further."""
    marked = stored(
        cut.select("conv", "number", "total", F.transform("turns", _mark).alias("marks")), "marks"
    )
    # A key that stands in several pieces is a duplicate in all but the first of them. A
    # piece has one row a key, and the earliest piece combines before it is shuffled.
    keys = F.array_distinct(
        F.transform(F.filter("marks", lambda m: ~m["blank"]), lambda m: m["key"])
    )
    held = stored(marked.select("conv", "number", F.explode(keys).alias("key")), "keys")
    firsts = (
        held.groupBy("conv", "key")
        .agg(F.min("number").alias("first"), F.max("number").alias("last"))
        .where("first < last")
        .select(F.col("conv").alias("of"), F.col("key").alias("known"), "first")
    )
    again = (
        held.join(firsts, F.col("conv").eqNullSafe(F.col("of")) & (F.col("key") == F.col("known")))
        .where("number > first")
        .groupBy("conv", "number")
        .agg(F.collect_list("key").alias("again"))
    )

    def code(m: Column, i: Column) -> Column:
        return _code(m, i, F.coalesce(F.array_contains("again", m["key"]), F.lit(False)))

    coded = stored(
        marked.join(_placed(again, "again"), _same_piece("again"), "left").select(
            "conv", "number", "total", F.transform("marks", code).alias("codes")
        ),
        "codes",
    )
    following = _placed(
        coded.select("conv", (F.col("number") - 1).alias("number"), F.col("codes")[0].alias("follow")),
        "next",
    )
    return coded.join(following, _same_piece("next"), "left").select(
        *_CODED
    )


# The costs of a piece. `right` is the vector its last row was run from, less its smallest
# entry; `left` that before its first row, likewise, and `base` what was taken away there.
# `vectors` holds those before each row and after the last, packed.
def _costs_schema(conv: str) -> str:
    return (
        f"conv {conv}, number int, total int, codes array<tinyint>, blank bigint, "
        "duplicate bigint, truncated bigint, illegal bigint, right array<bigint>, "
        "left array<bigint>, base bigint, vectors binary, moved boolean"
    )


def backwards(codes: np.ndarray, after: np.ndarray) -> np.ndarray:
    """What the rest costs before a row from each state, of many conversations at once.

    `codes` are those of the row, `after` the costs after it, a line each.
    """
    initial, fault = codes // _FAULTS, codes % _FAULTS
    usable = (fault != BLANK) & (fault != DUPLICATE)
    extra = np.where(fault == SHORT, TRUNCATED, 0)
    found = after + DELETE
    for state in range(_STATES):
        for role, leads in ((SYSTEM, 1), (USER, 2), (ASSISTANT, 3)):
            if _allowed(state, leads):
                kept = np.where(usable & (initial == role), after[:, leads] + extra, _FAR)
                found[:, state] = np.minimum(found[:, state], kept)
        to = _NEXT[state]
        rerole = np.where(usable, after[:, to] + REROLE + extra, _FAR)
        found[:, state] = np.minimum(found[:, state], rerole)
    user, assistant = found[:, 2].copy(), found[:, 3].copy()
    found[:, 2] = np.minimum(user, assistant + INSERT)
    found[:, 3] = np.minimum(assistant, user + INSERT)
    for state in (0, 1):
        found[:, state] = np.minimum(found[:, state], found[:, 2] + INSERT)
    return np.where((codes == _NO_ROW)[:, None], after, found)


def _allowed(state: int, leads: int) -> bool:
    """Whether a role that leads to this state may follow in `state`."""
    return leads == _NEXT[state] or (state == 0 and leads == 1)


def run_back(
    codes: np.ndarray, right: np.ndarray, earlier: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The costs before each row and after the last, and how many rows were run.

    `codes` has a line a piece, its rows at the right end. With the `earlier` costs a piece
    is run only until its vector differs from the earlier one by a constant.
    """
    lines, width = codes.shape
    table = np.zeros((lines, width + 1, _STATES), np.int64)
    table[:, width] = right
    run = np.zeros(lines, np.int64)
    open_lines = np.arange(lines)
    for place in range(width - 1, -1, -1):
        if earlier is not None:
            gap = table[open_lines, place + 1] - earlier[open_lines, place + 1]
            level = (gap == gap[:, :1]).all(axis=1)
            done = open_lines[level]
            table[done, : place + 1] = earlier[done, : place + 1] + gap[level, 0][:, None, None]
            open_lines = open_lines[~level]
            if not len(open_lines):
                break
        own = codes[open_lines, place]
        table[open_lines, place] = backwards(own, table[open_lines, place + 1])
        run[open_lines] += own != _NO_ROW
    return table, run


def _lined_up(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of many pieces with their ends at the right, and their lengths."""
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(sizes.max(initial=0))
    codes = np.full((len(sizes), width), _NO_ROW, np.int64)
    line = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    codes[line, place + (width - sizes)[line]] = flat
    return codes, sizes


def _guess_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        conv, number, count, lists, follow = batch.columns
        codes, sizes = _lined_up(lists)
        last = number.to_numpy() == count.to_numpy() - 1
        right = np.where(last[:, None], _FINAL, 0)
        table, _ = run_back(codes, right)
        faults = np.where(codes == _NO_ROW, 0, codes % _FAULTS)
        initials = np.where(codes == _NO_ROW, -1, codes // _FAULTS)
        after = follow.fill_null(_NO_ROW).to_numpy(zero_copy_only=False)
        after = np.where(after == _NO_ROW, -1, after // _FAULTS)
        pairs = np.column_stack([initials, after])
        one, two = pairs[:, :-1], pairs[:, 1:]
        legal = ((one == SYSTEM) & (two == USER)) | ((one == USER) & (two == ASSISTANT))
        legal |= (one == ASSISTANT) & (two == USER)
        illegal = ((one >= 0) & (two >= 0) & ~legal).sum(axis=1)
        counts = [pa.array((faults == kind).sum(axis=1)) for kind in (BLANK, DUPLICATE, SHORT)]
        found = _packed(table, sizes, np.zeros(len(sizes), bool))
        yield pa.RecordBatch.from_arrays(
            [conv, number, count, lists, *counts, pa.array(illegal), *found], names=_COSTS
        )


_CODED = "conv number total codes follow".split()
_COSTS = (
    "conv number total codes blank duplicate truncated illegal right left base vectors moved"
).split()


def _packed(table: np.ndarray, sizes: np.ndarray, moved: np.ndarray) -> list[pa.Array]:
    width = table.shape[1] - 1
    right, left = table[:, width], table[np.arange(len(sizes)), width - sizes]
    base = left.min(axis=1, initial=_FAR) if len(sizes) else np.zeros(0, np.int64)
    own = [row[width - size :].astype("<i4").tobytes() for row, size in zip(table, sizes, strict=True)]
    return [
        pa.array(list(right), pa.list_(pa.int64())),
        pa.array(list(left - base[:, None]), pa.list_(pa.int64())),
        pa.array(base, pa.int64()),
        pa.array(own, pa.binary()),
        pa.array(moved, pa.bool_()),
    ]


def _guessed(coded: DataFrame) -> DataFrame:
    schema = _costs_schema(coded.schema["conv"].dataType.simpleString())
    return stored(coded.mapInArrow(_guess_batches, schema), "guessed-costs")


def _fix_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with the vector `seen` that the next one has found; null if there is none."""
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        right, seen = rows["right"].to_pylist(), rows["seen"].to_pylist()
        stale = np.array([s is not None and s != r for s, r in zip(seen, right, strict=True)], bool)
        kept = rows.filter(pa.array(~stale)).drop_columns(["seen", "moved"])
        kept = kept.append_column("moved", pa.array(np.zeros(kept.num_rows, bool)))
        yield from kept.to_batches()
        again = rows.filter(pa.array(stale)).combine_chunks()
        if not again.num_rows:
            continue
        codes, sizes = _lined_up(again["codes"].combine_chunks())
        width = codes.shape[1]
        earlier = np.zeros((len(sizes), width + 1, _STATES), np.int64)
        for line, packed in enumerate(again["vectors"].to_pylist()):
            own = np.frombuffer(packed, "<i4").reshape(-1, _STATES)
            earlier[line, width + 1 - len(own) :] = own
            earlier[line, : width + 1 - len(own)] = own[0]
        table, _ = run_back(codes, np.array(again["seen"].to_pylist(), np.int64), earlier)
        before = np.array(again["left"].to_pylist(), np.int64)
        left = table[np.arange(len(sizes)), width - sizes]
        moved = (left - left.min(axis=1)[:, None] != before).any(axis=1)
        found = _packed(table, sizes, moved)
        same = [again[name].combine_chunks() for name in _COSTS[:8]]
        yield pa.RecordBatch.from_arrays([*same, *found], names=_COSTS)


def _converged(costs: DataFrame) -> DataFrame:
    """Fix-up passes over the costs until each piece was run from what the next one found.

    A pass joins pieces with their neighbours by conversation and number; no conversation
    is gathered. Only pieces whose first vector moved give work to another pass.
    """
    schema = costs.schema
    if costs.where("total > 1").isEmpty():
        return costs
    while True:
        found = _placed(
            costs.select("conv", (F.col("number") - 1).alias("number"), F.col("left").alias("seen")),
            "next",
        )
        joined = costs.join(found, _same_piece("next"), "left").select(*_COSTS, "seen")
        costs = stored(joined.mapInArrow(_fix_batches, schema), "costs")
        if costs.where("moved").isEmpty():
            return costs


def trace(codes: list[int], costs: np.ndarray, state: int, last: bool) -> tuple[str, int]:
    """The initials of the least edits of a piece entered in `state`, and the state it leads to.

    Of edits that lead to the least cost, the one with the first letter is taken: delete,
    insert, keep, give another role. Inserts after the last row are the next piece's.
    """
    table, edits, at = costs.tolist(), [], 0
    while at < len(codes) or last:
        here = table[at][state]
        if at < len(codes):
            initial, fault = divmod(codes[at], _FAULTS)
            after = table[at + 1]
            if here == after[state] + DELETE:
                edits.append("D")
                at += 1
                continue
        elif state in (0, 3):
            break
        to = _NEXT[state]
        if here == table[at][to] + INSERT:
            edits.append("I")
            state = to
            continue
        extra = TRUNCATED if fault == SHORT else 0
        leads = initial if initial and _allowed(state, initial) else None
        if leads is not None and here == after[leads] + extra:
            edits.append("K")
            state = leads
        else:
            edits.append("R")
            state = to
        at += 1
    return "".join(edits), state


def _trace_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = dict(zip(batch.schema.names, batch.columns, strict=True))
        audits, after = [], []
        rows = (columns[name].to_pylist() for name in ("number", "total", "codes", "vectors"))
        for number, count, codes, packed in zip(*rows, strict=True):
            costs = np.frombuffer(packed, "<i4").reshape(-1, _STATES)
            entered = range(_STATES) if number else (0,)
            found = [trace(codes, costs, state, number == count - 1) for state in entered]
            found *= _STATES // len(found)
            audits.append([edits for edits, _ in found])
            after.append([state for _, state in found])
        yield pa.RecordBatch.from_arrays(
            [columns[name] for name in _KEPT]
            + [pa.array(audits, pa.list_(pa.string())), pa.array(after, pa.list_(pa.int32()))],
            names=[*_KEPT, "audits", "after"],
        )


_KEPT = "conv number blank duplicate truncated illegal left base".split()


def _edit_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = dict(zip(batch.schema.names, batch.columns, strict=True))
        repaired = []
        rows = (columns[name].to_pylist() for name in ("audit", "state", "roles", "texts"))
        for audit, state, roles, texts in zip(*rows, strict=True):
            turns, at = [], 0
            for edit in audit:
                if edit == "K":
                    state = "sua".index(roles[at][0]) + 1
                    turns.append({"role": roles[at], "text": texts[at]})
                elif edit != "D":
                    state = _NEXT[state]
                    role = "user" if state == USER else "assistant"
                    turns.append({"role": role, "text": "" if edit == "I" else texts[at]})
                at += edit != "I"
            repaired.append(turns)
        kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        names = [n for n in batch.schema.names if n not in ("state", "roles", "texts")]
        yield pa.RecordBatch.from_arrays(
            [columns[name] for name in names] + [pa.array(repaired, kind)], names=[*names, "turns"]
        )


def _alone_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole conversations: their costs, the trace from the first state, and the edited turns."""
    for batch in batches:
        for start in range(0, batch.num_rows, ALONE):
            piece = batch.slice(start, ALONE)
            (costs,) = _guess_batches([piece.select(_CODED)])
            (traced,) = _trace_batches([costs])
            base, left, audits = (
                traced.column(name).to_pylist() for name in ("base", "left", "audits")
            )
            chosen = pa.RecordBatch.from_arrays(
                [
                    *traced.columns[:6],
                    pa.array([a + b[0] for a, b in zip(base, left, strict=True)], pa.int64()),
                    pa.array([found[0] for found in audits], pa.string()),
                    pa.array([0] * piece.num_rows, pa.int32()),
                    piece.column("roles"),
                    piece.column("texts"),
                ],
                names=[*_KEPT[:6], "cost", "audit", "state", "roles", "texts"],
            )
            yield from _edit_batches([chosen])
