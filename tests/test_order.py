"""Lag and numbering over ranges, against plain Python."""

import random

import pytest

from tabscope.functions.order import in_ranges, lagged, numbered, running
from tabscope.operators import telemetry


def rows(seed):
    """A third of all rows in one group, gaps, repeats, nulls, and rows that are alike."""
    rng = random.Random(seed)
    made = [("hot", rng.choice([None, *range(0, 90, 3)]), rng.choice([None, 0.1, 0.5, 0.9])) for _ in range(400)]
    made += [(rng.choice(["a", "b", None, "z"]), rng.randint(0, 30), rng.random()) for _ in range(500)]
    made += [(f"one{k}", 0, 0.5) for k in range(60)] + [("same", 1, 0.5)] * 200
    rng.shuffle(made)
    return made


def ordered(made):
    low = lambda x: (x is not None, x if x is not None else 0)
    groups = {}
    for g, o, v in sorted(made, key=lambda r: (low(r[1]), low(r[2]))):
        groups.setdefault(g, []).append((o, v))
    return groups


@pytest.mark.parametrize("ranges", [1, 3, 64])
def test_against_plain_order(spark, ranges):
    made = rows(ranges)
    df = spark.createDataFrame(made, "g string, o int, v double")
    groups = ordered(made)
    found = [tuple(r) for r in lagged(df, ["g"], ["o", "v"], "v", "before", ranges).collect()]
    wanted = [(g, *row, own[i - 1][1] if i else None) for g, own in groups.items() for i, row in enumerate(own)]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    found = [tuple(r) for r in numbered(df, ["g"], ["o", "v"], "n", ranges).collect()]
    wanted = [(g, *row, i) for g, own in groups.items() for i, row in enumerate(own)]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    weighed = df.selectExpr("g", "o", "v", "coalesce(o, 0) + 1 AS w")
    found = [(*r[:3], r["upto"]) for r in running(weighed, ["g"], ["o", "v"], "w", "upto", ranges).collect()]
    wanted = [(g, *row, sum((o or 0) + 1 for o, _ in own[: i + 1])) for g, own in groups.items() for i, row in enumerate(own)]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)


def test_no_range_holds_a_hot_group(spark):
    """A group of a third of the rows, and rows that are all alike, lie over many ranges."""
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, -1, id) AS g", "0 AS o")
    sizes = in_ranges(df, ["g", "o"], 16).where("g = -1").groupBy("__range").count().collect()
    assert len(sizes) >= 5 and max(r["count"] for r in sizes) < 4000


def test_nothing(spark):
    df = spark.createDataFrame([], "g string, o int, v double")
    assert lagged(df, ["g"], ["o"], "v", "p").count() == numbered(df, ["g"], ["o"], "n").count() == 0
    assert running(df, ["g"], ["v"], "o", "s").count() == 0


def test_gate_over_a_long_run(spark):
    rng = random.Random(2)
    scores = [("long", 2 * k + 7 * (k // 100), round(rng.random(), 2)) for k in range(500)]
    scores += [("long", 10, 0.3), ("long", 10, 0.3), (None, 0, 0.2), (None, 1, 0.1)] + [(f"r{k}", 0, 0.1) for k in range(900)]
    df = spark.createDataFrame(scores, "run_id string, iteration int, score double")
    wanted = []
    for g, own in ordered(scores).items():
        for i, (iteration, score) in enumerate(own):
            before = own[i - 1][1] if i else None
            ok = score >= 0.6 or iteration >= 2 or (before is not None and score <= before)
            wanted.append((g, iteration, score, before, "quality_ok" if ok else "needs_reclean"))
    assert sorted(map(tuple, telemetry.quality_gate(df).collect()), key=repr) == sorted(wanted, key=repr)
