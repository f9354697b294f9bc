"""Personal data: candidate spans, boosted trees, calibrated thresholds.

Four kinds are looked for. The base of each is a pattern with a check of its numbers; base
spans are always taken. Generators of high recall propose more spans, which may overlap:
spelled-out or bracketed addresses, numbers with other separators or without a plus sign,
cards in a row of numbers. Boosted trees score them by format and context, with the kind
among the features, and a threshold per kind, calibrated on documents that were not trained
on, selects what is added. Of added spans that overlap the likeliest is kept, and none
overlaps a base span.

The trees learn from samples of documents that are bounded by `TRAINING_DOCS`: one a kind,
of those with a base span of it, and two of those without any. Their base spans are
positive, also when they are written with other marks, each drawn for itself, and they are
negative with their numbers broken; proposals that are no base span are negative. There is
no least number of examples: a kind's calibration is of its own examples and of those of
all kinds, which weigh as `PRIOR` of them, so a kind with few of its own, or none, is judged
as all are. Without any positive example nothing is added.

Positions are code points, the end is exclusive. A null text is empty and has no span.
Rows are kept as they are, also repeated ones and null ids; an empty table gives no row.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from hashlib import sha256
from random import Random

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.sources import stored

# The kinds in the order of the results.
KINDS = ("email", "ip", "card", "phone")

TRAINING_DOCS = 3_000
TREES, DEPTH, RATE, BINS = 60, 3, 0.2, 32
PRECISION = 0.98
#: Examples of a kind that those of all kinds weigh as in its calibration.
PRIOR = 20.0
CONTEXT = 24
ROWS = 256

Span = tuple[str, int, int]

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_DIGITS = re.compile(r"[0-9]+")

# Proposals: everything that may be one of the kinds in another guise.
_AT = re.compile(
    r"(?<![\w.%+-])([\w.%+-]{1,64})\s{0,2}(?:@|[\[({<]\s?(?:at|@)\s?[\])}>]|\sat\s)\s{0,2}"
    r"([\w-]{1,63}(?:\s{0,2}(?:\.|[\[({<]\s?(?:dot|\.)\s?[\])}>]|\sdot\s)\s{0,2}[\w-]{1,63}){1,4})(?![\w-])",
    re.I,
)
# Whatever `_AT` matches holds one of these.
_MAY_BE_AT = re.compile(r"@|\bat\b", re.I)
_NUMBER = re.compile(r"(?<![\w.])[+(]?[0-9](?:[ ().,\[\]/_-]{0,3}[0-9]){6,23}(?![\w])")

_ROW = re.compile(r"[0-9](?:[ -]?[0-9]){19,}+")

_WORDS = {
    "email": re.compile(r"mail|contact|write|address|courriel|correo", re.I),
    "ip": re.compile(r"\bip\b|host|server|address|login|client", re.I),
    "card": re.compile(r"card|visa|credit|debit|carte|karte|tarjeta|pay", re.I),
    "phone": re.compile(r"phone|call|tel|mobile|fax|whatsapp|numero|nummer", re.I),
}


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _octets(parts: Iterable[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)


def _emails(text: str) -> Iterator[Span]:
    """Each at-sign with what may stand on both sides of it, in one pass."""
    bound, at = 0, text.find("@")
    while at >= 0:
        local = text[bound:at]
        start = bound + len(local.rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        bound = found.end() if found else at + 1
        if found:
            yield "email", start, bound
        at = text.find("@", bound)


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns whose numbers are right, by kind and start."""
    spans = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        for found in _IP.finditer(text):
            if _octets(found.groups()):
                spans.append(("ip", *found.span()))
        for found in _CARD.finditer(text):
            if found.end() - found.start() >= 13:
                digits = found[0].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    spans.append(("card", *found.span()))
        if "+" in text:
            for found in _PHONE.finditer(text):
                if 9 <= sum(map(len, _DIGITS.findall(found[0]))) <= 15:
                    spans.append(("phone", *found.span()))
    return spans


def proposals(text: str) -> list[Span]:
    """Spans that may be of a kind, generously; one span may be proposed for several."""
    spans: list[Span] = []
    if _MAY_BE_AT.search(text):
        spans += [("email", *found.span()) for found in _AT.finditer(text)]
    if _DIGIT.search(text):
        for found in _NUMBER.finditer(text):
            groups = _DIGITS.findall(found[0])
            n = sum(map(len, groups))
            if len(groups) == 4 and max(map(len, groups)) <= 3 and found[0][0] not in "+(":
                spans.append(("ip", *found.span()))
            if 13 <= n <= 19:
                spans.append(("card", *found.span()))
            if 9 <= n <= 15:
                spans.append(("phone", *found.span()))
        for found in _ROW.finditer(text):
            spans += _cards_in_row(text, *found.span())
    return spans


def _cards_in_row(text: str, start: int, end: int) -> Iterator[Span]:
    """Whole groups of a row of numbers that together have the digits of a card and its check."""
    groups = [found.span() for found in _DIGITS.finditer(text, start, end)]
    for first, (begin, _) in enumerate(groups):
        n = 0
        for a, b in groups[first:]:
            n += b - a
            if n > 19:
                break
            if n >= 13 and luhn(re.sub("[ -]", "", text[begin:b])):
                yield "card", begin, b


def features(text: str, span: Span) -> list[float]:
    """Format and context of a span as numbers."""
    kind, start, end = span
    inner = text[start:end]
    groups = _DIGITS.findall(inner)
    digits = "".join(groups)
    marks = [c for c in inner if not c.isalnum()]
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    near = before + " " + after
    sizes = [len(g) for g in groups] or [0]
    return [
        float(len(inner)),
        float(len(digits)),
        float(len(groups)),
        float(max(sizes)),
        float(min(sizes)),
        float(len(set(sizes))),
        float(len(marks)),
        float(len(set(marks))),
        float(inner.count(" ")),
        float(inner.count("-")),
        float(inner.count(".")),
        float(inner.count("@")),
        float("+" in inner),
        float("(" in inner),
        float(any(c.isalpha() for c in inner)),
        float(bool(re.search(r"\bdot\b|[\[({]\s?at", inner, re.I))),
        float(inner.rpartition(".")[2].strip(" ])}>").isalpha()),
        float(bool(digits) and luhn(digits)),
        float(len(groups) == 4 and _octets(groups)),
        float(digits[:1] in ("3", "4", "5", "6")),
        float(digits[:1] == "0"),
        float(before[-1:].isalnum()),
        float(after[:1].isalnum()),
        float(before[-1:] in ("$", "€", "£", "#", "=", "/")),
        float(bool(_WORDS[kind].search(near))),
        float(sum(c.isdigit() for c in near)),
        float("\t" in near or "|" in near),
        *[float(kind == other) for other in KINDS],
    ]


def _disguised(kind: str, value: str, rng: Random) -> str:
    """The same value with other marks than the base pattern takes, each drawn for itself."""
    if kind == "email":
        local, _, domain = value.rpartition("@")
        at, dot = _spelled("at", "@", rng), _spelled("dot", ".", rng)
        if at.strip() == "@" and dot == ".":
            at = " @ "
        return local + at + domain.replace(".", dot)
    if kind == "ip":
        mark = rng.choice(["[.]", "(.)", "-", " . ", "_", " ", ", ", ". ", "/"])
        return value.replace(".", mark)
    digits = re.sub(r"[^0-9]", "", value)
    if kind == "card":
        size = rng.choice([4, 4, 4, 5, 6])
        marks = [".", "_", "/", " . ", "  ", ", ", " - "]
        groups = [digits[i : i + size] for i in range(0, len(digits), size)]
        return rng.choice(marks).join(groups)
    mark = rng.choice(["-", ".", " ", "/", " - "])
    groups = [digits[:-7], digits[-7:-4], digits[-4:]]
    if rng.random() < 0.3:
        groups[0] = f"({groups[0]})"
    if rng.random() < 0.3:
        groups[1:] = ["".join(groups[1:])]
    return rng.choice(["", "", "", "00"]) + mark.join(group for group in groups if group != "()")


def _spelled(word: str, mark: str, rng: Random) -> str:
    """An at-sign or dot as a word or in brackets."""
    word = rng.choice([word, word.upper(), word.title(), mark])
    left, right = rng.choice(["[]", "()", "{}", "<>", "  "])
    if left == " ":
        return mark if word == mark and word == "." else f" {word} "
    space = rng.choice(["", " "])
    return f"{space}{left}{word}{right}{space}"


def _broken(kind: str, value: str, rng: Random) -> str:
    """A value that looks alike and is none."""
    digits = [i for i, c in enumerate(value) if c.isdigit()]
    if kind == "email":
        local, _, domain = value.rpartition("@")
        first, _, rest = domain.partition(".")
        words = re.sub(r"[^A-Za-z]+", " ", local).strip() or "it"
        if rng.random() < 0.5:
            return f"{words} @ {rng.randint(1, 99)}.{rng.randint(10, 99)}"
        return f"{words} @ {first}. {rest.partition('.')[0].title()}"
    changed = list(value)
    if kind == "ip":
        return ".".join(str(rng.randint(256, 999)) for _ in range(4))
    if kind == "card" and digits:
        i = rng.choice(digits)
        changed[i] = str((int(changed[i]) + rng.randint(1, 9)) % 10)
        return "".join(changed).replace(" ", ".")
    return ".".join(str(rng.randint(10, 9_999)) for _ in range(rng.randint(3, 6)))


def examples(text: str, seed: int) -> list[tuple[str, int, list[float]]]:
    """Kind, label and features of a text's proposals and of variants of its base spans."""
    base = set(base_spans(text))
    taken = Taken(base)
    found = [
        (span[0], int(span in base), features(text, span))
        for span in proposals(text)
        if span in base or not taken.meets(span)
    ]
    for n, (kind, start, end) in enumerate(sorted(base)):
        rng = Random(seed * 1_000 + n)
        for label, change in ((1, _disguised), (0, _broken)):
            value = change(kind, text[start:end], rng)
            near = text[max(0, start - 40) : start] + value + text[end : end + 40]
            at = min(start, 40)
            whole = (kind, at, at + len(value))
            if kind not in {k for k, s, e in proposals(near) if s < whole[2] and at < e}:
                continue
            found.append((kind, label, features(near, whole)))
    return found


class Taken:
    """The places that spans take, as sorted pieces that do not overlap."""

    def __init__(self, spans: Iterable[Span]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, start, end in sorted(spans, key=lambda s: s[1]):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meets(self, span: Span) -> bool:
        at = bisect_right(self.ends, span[1])
        return at < len(self.starts) and self.starts[at] < span[2]

    def add(self, span: Span) -> None:
        """Take the place of a span that meets nothing."""
        at = bisect_right(self.starts, span[1])
        self.starts.insert(at, span[1])
        self.ends.insert(at, span[2])


def _logistic(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)), without an overflow on either side."""
    small = np.exp(-np.abs(x))
    return np.where(x >= 0, 1.0, small) / (1 + small)


@dataclass
class Trees:
    """Boosted regression trees on binned features, calibrated for one kind."""

    edges: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    start: float = 0.0
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        columns = [np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(self.edges)]
        return np.stack(columns, axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        binned, total = self._binned(x), np.full(len(x), self.start)
        for columns, cuts, leaves in self.trees:
            at = np.zeros(len(x), int)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (binned[np.arange(len(x)), columns[at]] > cuts[at])
            total += leaves[at - (2**DEPTH - 1)]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        """The calibrated probability of each row."""
        return _logistic(self.scale * self.margin(x) + self.shift)

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, i], quantiles)) for i in range(x.shape[1])]
        binned = self._binned(x)
        share = np.clip(y.mean(), 0.01, 0.99)
        self.start = float(np.log(share / (1 - share)))
        margin = np.full(len(y), self.start)
        for _ in range(TREES):
            p = _logistic(margin)
            tree, at = self._grow(binned, y - p, p * (1 - p))
            self.trees.append(tree)
            margin += tree[2][at]

    @staticmethod
    def _grow(binned: np.ndarray, gradient: np.ndarray, hessian: np.ndarray):
        """A tree of fixed depth whose splits gain most; a node that gains nothing sends all left."""
        inner = 2**DEPTH - 1
        columns, cuts = np.zeros(inner, int), np.full(inner, BINS + 1)
        at = np.zeros(len(gradient), int)
        for node in range(inner):
            rows = np.flatnonzero(at == node)
            best = 1e-6
            g_all, h_all = gradient[rows].sum(), hessian[rows].sum()
            for column in range(binned.shape[1]) if len(rows) > 1 else ():
                bins = binned[rows, column]
                g = np.bincount(bins, gradient[rows], BINS + 1).cumsum()[:-1]
                h = np.bincount(bins, hessian[rows], BINS + 1).cumsum()[:-1]
                gain = g**2 / (h + 1) + (g_all - g) ** 2 / (h_all - h + 1) - g_all**2 / (h_all + 1)
                cut = int(gain.argmax())
                if gain[cut] > best:
                    best, columns[node], cuts[node] = gain[cut], column, cut
            at[rows] = 2 * node + 1 + (binned[rows, columns[node]] > cuts[node])
        leaf = at - inner
        g = np.bincount(leaf, gradient, 2**DEPTH)
        h = np.bincount(leaf, hessian, 2**DEPTH)
        return (columns, cuts, RATE * g / (h + 1)), leaf

    def calibrate(
        self, x: np.ndarray, y: np.ndarray, weights: np.ndarray, precision: float
    ) -> None:
        """Fit a logistic curve to the margins, and find the least threshold that is precise."""
        margin = self.margin(x)
        positive, negative = weights[y == 1].sum(), weights[y == 0].sum()
        smooth = np.where(y == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
        for _ in range(200):
            p = _logistic(self.scale * margin + self.shift)
            w, off = weights * (p * (1 - p) + 1e-9), weights * (smooth - p)
            a, b, c = (w * margin**2).sum() + 1e-3, (w * margin).sum(), w.sum() + 1e-3
            da, db = (off * margin).sum(), off.sum()
            determinant = a * c - b * b
            if determinant <= 0:
                break
            self.scale += 0.5 * (c * da - b * db) / determinant
            self.shift += 0.5 * (a * db - b * da) / determinant
        p = self.probability(x)
        order = np.argsort(-p, kind="stable")
        right = np.cumsum((weights * y)[order]) / np.cumsum(weights[order])
        good = np.flatnonzero((right >= precision) & (p[order] >= 0.5))
        if len(good):
            # Halfway to the first score that would be too many, and never below one half.
            last, below = good[-1], good[-1] + 1
            next_p = p[order[below]] if below < len(p) else 0.0
            self.threshold = float(max(0.5, (p[order[last]] + next_p) / 2))


#: Texts outside of this have no base span; only Spark looks at them.
_MAY_BE_BASE = (
    r"@|[0-9]\.[0-9]+\.[0-9]+\.[0-9]|[0-9](?:[\x20-]?[0-9]){12}|\+[0-9][\x20().0-9-]+[0-9]"
)
#: What texts without base spans must hold to be an example, of words and of numbers.
_CLEAN = (r"(?i)@|\bat\b", r"[0-9]{3}")


def _marked(docs: DataFrame) -> DataFrame:
    """`hash` of each distinct text and `marks`, a bit for each kind it has a base span of,
    and for texts without any a bit for each pattern of `_CLEAN`."""
    text = F.col("text")
    clean = [F.when(text.rlike(p), 1 << len(KINDS) + i).otherwise(0) for i, p in enumerate(_CLEAN)]
    rows = docs.select(F.col("text").cast("string").alias("text")).select(
        F.xxhash64("text").alias("hash"),
        (clean[0] + clean[1]).alias("clean"),
        F.when(text.rlike(_MAY_BE_BASE), text).alias("text"),
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [
                sum(1 << KINDS.index(k) for k in {s[0] for s in base_spans(text or "")}) or clean
                for text, clean in zip(
                    batch.column(2).to_pylist(), batch.column(1).to_pylist(), strict=True
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(marks, pa.int64())], names=["hash", "marks"]
            )

    seen = rows.where("clean > 0 or text is not null").mapInArrow(run, "hash long, marks long")
    return seen.where("marks > 0").distinct()


def _sample(docs: DataFrame, training_docs: int) -> DataFrame:
    """`text`, each once: for each mark the `training_docs` texts of the least hashes."""
    marked = stored(_marked(docs), "pii-marks")
    chosen = [
        marked.where(F.col("marks").bitwiseAND(F.lit(1 << bit)) > 0)
        .select("hash")
        .orderBy("hash")
        .limit(training_docs)
        for bit in range(len(KINDS) + len(_CLEAN))
    ]
    hashes = stored(reduce(DataFrame.unionAll, chosen).distinct(), "pii-sample")
    texts = docs.select(F.col("text").cast("string").alias("text"))
    # A few thousand hashes a mark; copies of a text combine before they are shuffled.
    own = texts.withColumn("hash", F.xxhash64("text")).join(F.broadcast(hashes), "hash")
    return own.groupBy("hash").agg(F.min("text").alias("text")).select("text")


def _bounded(found: DataFrame, most: int) -> DataFrame:
    """The `most` examples of the least hashes of text and example, which are the same on
    every run; long lists of one text do not push out others. Bounds what the driver holds."""
    return found.orderBy(F.xxhash64("number", "at"), "number", "at").limit(most)


def train(
    docs: DataFrame, training_docs: int = TRAINING_DOCS, precision: float = PRECISION
) -> dict[str, Trees]:
    """Trees calibrated for each kind, from up to `training_docs` texts with base spans of each
    kind, and as many without any, of those with an address's words and of those with numbers.

    The samples are drawn by a hash of the text, so they do not depend on the order of the
    rows, and a kind is learned however rare it is. Examples of one text are either trained
    on or calibrated on.
    """
    sample = _sample(docs, training_docs)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                number = int.from_bytes(sha256(text.encode()).digest()[:4], "little")
                for at, (kind, label, values) in enumerate(examples(text, number)):
                    rows.append((kind, label, number, at, values))
            if rows:
                kinds, labels, numbers, places, values = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(kinds, pa.string()),
                        pa.array(labels, pa.int64()),
                        pa.array(numbers, pa.int64()),
                        pa.array(places, pa.int64()),
                        pa.array(values, pa.list_(pa.float64())),
                    ],
                    names=["kind", "label", "number", "at", "values"],
                )

    schema = "kind string, label long, number long, at long, values array<double>"
    found = stored(sample.mapInArrow(run, schema), "pii-examples")
    parts = [
        _bounded(found.where(F.col("kind") == kind), 30 * training_docs).toPandas() for kind in KINDS
    ]
    every = pd.concat(parts).sort_values(["number", "label", "at", "kind"], kind="stable")
    fitted, checked = (every[part] for part in (every["number"] % 3 != 0, every["number"] % 3 == 0))
    # So few examples that a part lacks positive or negative ones serve for both.
    fitted, checked = (p if p["label"].nunique() == 2 else every for p in (fitted, checked))
    if every["label"].nunique() < 2:
        return {}
    trees = Trees()
    trees.fit(np.stack(fitted["values"].to_list()), fitted["label"].to_numpy(float))
    x, y = np.stack(checked["values"].to_list()), checked["label"].to_numpy(float)
    models = {}
    for kind in KINDS:
        own = (checked["kind"] == kind).to_numpy()
        models[kind] = Trees(trees.edges, trees.trees, trees.start)
        models[kind].calibrate(x, y, own + PRIOR / len(y), precision)
    return models


def added_spans(text: str, base: list[Span], models: dict[str, Trees]) -> list[Span]:
    """The proposals that pass their threshold and overlap nothing that is taken."""
    taken = Taken(base)
    asked = [span for span in proposals(text) if span[0] in models and not taken.meets(span)]
    scored = []
    for kind in KINDS:
        own = [span for span in asked if span[0] == kind]
        if own:
            x = np.array([features(text, span) for span in own])
            p = models[kind].probability(x)
            scored += [(-q, s) for q, s in zip(p, own, strict=True) if q >= models[kind].threshold]
    chosen = []
    for _, span in sorted(scored):
        if not taken.meets(span):
            chosen.append(span)
            taken.add(span)
    return chosen


def _joined(spans: Iterable[Span]) -> str:
    order = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in order)


def redact(text: str, spans: Iterable[Span]) -> str:
    """The text with each span replaced by its kind; spans that overlap become one."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find(docs: DataFrame, models: dict[str, Trees] | None = None) -> DataFrame:
    """`doc_id`, counts of the base spans by kind, their `base_sha256`, all `spans`, and the
    `redacted` text."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs) if models is None else models)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                piece = batch.slice(start, ROWS)
                counts, hashes, every, clean = [], [], [], []
                for text in piece.column(1).to_pylist():
                    base = base_spans(text)
                    spans = base + added_spans(text, base, shared.value)
                    counts.append([sum(s[0] == kind for s in base) for kind in KINDS])
                    hashes.append(sha256(_joined(base).encode()).hexdigest())
                    every.append(_joined(spans))
                    clean.append(redact(text, spans) if spans else text)
                table = np.array(counts, np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0),
                        *[pa.array(table[:, i]) for i in range(4)],
                        pa.array(hashes, pa.string()),
                        pa.array(every, pa.string()),
                        pa.array(clean, pa.string()),
                    ],
                    names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "redacted"],
                )

    schema = (
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long,"
        " base_sha256 string, spans string, redacted string"
    )
    return rows.mapInArrow(run, schema)
