"""Hard negatives against all products, and what the threshold saves."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.llm import hard_negatives
from lamina.llm.hard_negatives import Lists, Places, search

SCHEMA = "vec_id bigint, label int, embedding array<float>"


def brute(rows, anchors=lambda number: number % 100 == 0):
    rows = sorted(set(rows))
    vectors = np.array([vector for _, _, vector in rows], np.int64)
    found = []
    for at, (anchor, label, vector) in enumerate(rows):
        if not anchors(anchor):
            continue
        scores = (vectors @ np.array(vector, np.int64)).tolist()
        ranked = sorted(range(len(rows)), key=lambda i: (-scores[i], rows[i][0]))
        same = [i for i in ranked if i != at and rows[i][1] == label][:5]
        for i in same:
            fitting = [
                j
                for j in ranked
                if rows[j][1] != label and 30 * scores[i] <= 100 * scores[j] <= 90 * scores[i]
            ]
            for rank, j in enumerate(fitting[:10], start=1):
                found.append((anchor, rows[i][0], rank, rows[j][0], scores[i], scores[j]))
    return sorted(found)


def integers(vector, width):
    whole = [math.floor(256 * float(np.float32(x))) for x in vector]
    return tuple(whole + [0] * (width - len(whole)))


def mined(df, **settings):
    return sorted(map(tuple, hard_negatives.mine(df, F.col("vec_id") % 100 == 0, **settings).collect()))


def random_rows(n, width, labels, seed=0):
    draw = np.random.default_rng(seed)
    return [
        (i, int(draw.integers(labels)), [float(x) for x in draw.normal(size=width)]) for i in range(n)
    ]


@pytest.mark.parametrize("settings", [{}, {"block": 32, "slab": 2}])
def test_equals_all_products(spark, settings):
    rows = random_rows(500, 8, 4)
    expected = brute([(i, label, integers(v, 8)) for i, label, v in rows])
    assert expected
    assert mined(spark.createDataFrame(rows, SCHEMA), **settings) == expected


def test_ties_repeated_rows_and_rows_of_one_id(spark):
    rows = [(i, i % 2, [float(i % 3), 1.0]) for i in range(90)] + [(100, 0, [1.0, 1.0])]
    rows += rows[:40] * 3 + [(100, 0, [2.0, 1.0]), (100, 1, [1.0, 1.0]), (5, 0, [0.5, 0.5])]
    expected = brute([(i, label, integers(v, 2)) for i, label, v in rows])
    assert mined(spark.createDataFrame(rows, SCHEMA), block=16) == expected


def test_rows_that_take_no_part_and_short_vectors(spark):
    rows = random_rows(300, 4, 3, seed=2)
    rows = [(i, label, v[: 4 - i % 3]) for i, label, v in rows]
    odd = [
        (100, None, [1.0] * 4),
        (None, 1, [1.0] * 4),
        (200, 1, None),
        (201, 1, [1.0, None]),
        (300, 1, [float("nan")]),
        (400, 1, [float("-inf")]),
    ]
    extra = [(500, 2, []), (600, 0, [0.0] * 4)]
    expected = brute([(i, label, integers(v, 4)) for i, label, v in rows + extra])
    df = spark.createDataFrame(rows + odd + extra, SCHEMA).withColumns(
        {name: F.lit("clash") for name in ("id", "vector", "anchor", "score", "window", "rank")}
    )
    assert mined(df) == expected


def test_fewer_rows_than_asked_for(spark):
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.5, 9.0]), (3, 2, [0.2, 0.0])]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == [(0, 1, 1, 2, 65536, 32768)]


def test_empty_table_and_no_anchor(spark):
    df = spark.createDataFrame(random_rows(20, 2, 2), SCHEMA)
    assert mined(df.limit(0)) == []
    assert mined(df.where("vec_id > 0")) == []


def test_large_components_stay_exact_and_larger_ones_are_refused(spark):
    rows = [(i, i % 2, [1e6 + i, float(i), 3.0]) for i in range(120)]
    expected = brute([(i, label, integers(v, 3)) for i, label, v in rows])
    assert expected == mined(spark.createDataFrame(rows, SCHEMA))
    huge = spark.createDataFrame([(0, 1, [1e18]), (1, 1, [1e18])], SCHEMA)
    with pytest.raises(Exception, match="exceed 64 bits"):
        mined(huge)


def test_threshold_bounds_what_was_not_seen():
    vectors = np.random.default_rng(1).integers(-90, 90, (700, 6)).astype(np.float64)
    lists = Lists(vectors, np.arange(700))
    anchor = np.array([30.0, -5.0, 0.0, 80.0, -60.0, 1.0])
    seen, start = np.zeros(700, bool), 0
    for depth, threshold in zip(lists.depths, lists.thresholds(anchor[None])[0], strict=True):
        lists.newly_seen(anchor, start, depth, seen)
        start = depth
        if not seen.all():
            assert (vectors[~seen] @ anchor).max() <= threshold
    assert seen.all()


def test_search_ends_early_and_on_ties_only_strictly_below():
    vectors = np.zeros((4_000, 2))
    vectors[:, 0] = np.arange(4_000)
    places = Places(5, -np.inf, np.inf)
    lists = Lists(vectors, np.arange(4_000))
    anchor = np.array([1.0, 0.0])
    scored = search(lists, anchor, lists.thresholds(anchor[None])[0], [places])
    assert scored < 200
    assert places.ids.tolist() == [3999, 3998, 3997, 3996, 3995]
    tied = Lists(np.ones((4_000, 1)), np.arange(4_000)[::-1].copy())
    places = Places(5, -np.inf, np.inf)
    scored = search(tied, np.ones(1), tied.thresholds(np.ones((1, 1)))[0], [places])
    assert scored == 4_000
    assert places.ids.tolist() == [0, 1, 2, 3, 4]
