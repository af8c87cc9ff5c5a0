"""Source mixing against a plain resharing loop and a plain queue."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tabscope.llm import mixing
from tabscope.llm.queries import ORACLES, QUERIES


def resharing(sizes, weights, share=1.5, cap=2):
    """Deals the budget by weight, stops who is above and deals the excess again."""
    target, free = {}, dict(weights)
    budget = share * sum(sizes.values())
    while free:
        left = budget - sum(target.values())
        level = left / sum(free.values())
        above = [s for s in free if level * free[s] >= cap * sizes[s]]
        if not above:
            target |= {s: level * w for s, w in free.items()}
            break
        for s in above:
            target[s] = float(cap * sizes[s])
            del free[s]
    return target


CASES = [
    {"a": 100, "b": 100, "c": 100},
    {"a": 1, "b": 1000, "c": 5, "d": 70, "e": 900},
    {"a": 25457, "b": 19133, "c": 15044, "d": 22029, "e": 18565, "f": 19361, "g": 20670},
    {"a": 0, "b": 10, None: 7},
    {"only": 12},
    {None: 0},
]


@pytest.mark.parametrize("sizes", CASES)
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    found = mixing.source_targets(mixing.cycle_weights(rows)).collect()
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    assert {r["source"]: r["weight"] for r in found} == weights
    wanted = resharing(sizes, weights)
    for r in found:
        assert r["target"] == pytest.approx(wanted[r["source"]]), r


def test_taken_words(spark):
    rows = [(i, "x " * (i % 13), None if i % 5 == 0 else f"s{i % 3}", 1) for i in range(200)]
    rows += [(900, None, "s1", 1), (901, "", "s1", 1), (902, " \t\n", None, 1), (903, "y " * 4000, "s2", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, finish int")
    copies, order = mixing.mix(docs)
    found = copies.collect()
    targets = {r["source"]: (r["target"], r["source_size"]) for r in found}
    for source, (target, size) in targets.items():
        own = [r for r in found if r["source"] == source]
        assert sum(r["taken"] for r in own) == int(target)
        assert len(own) == 2 * len({r["id"] for r in own})
        assert size == sum(r["size"] for r in own) / 2
        # served one after the other, epoch after epoch
        place = 0
        for r in sorted(own, key=lambda r: (r["before"], r["size"])):
            assert r["before"] == place
            place += r["size"]
            assert r["taken"] == max(0, min(r["size"], int(target) - r["before"]))
    listed = order.collect()
    assert [r["finish"] for r in listed] == sorted(r["finish"] for r in listed)
    assert all(r["taken"] > 0 for r in listed)
    again = mixing.mix(docs.repartition(7))[0].select("id", "epoch", "before", "taken").collect()
    assert sorted(map(tuple, again)) == sorted((r["id"], r["epoch"], r["before"], r["taken"]) for r in found)


def test_words_and_empty(spark):
    texts = [("a b c", 2), ("", 0), (None, 0), (" \t\x0b x\x1fy ", 1)]
    df = spark.createDataFrame(texts, "text string, n bigint")
    assert all(r["n"] == r["w"] for r in df.withColumn("w", mixing.words(F.col("text"))).collect())
    empty = spark.createDataFrame([], "doc_id bigint, text string, source string")
    copies, order = mixing.mix(empty)
    assert copies.count() == 0 and order.count() == 0


REPEATED = [(1, "a b c", "s")] * 3 + [(1, "d e f", "s"), (2, "x y", "s"), (2, "x y", "t")]
REPEATED += [(None, "p q", "s")] * 2 + [(None, "r t", "s"), (None, "r t", None), (4, None, "t"), (4, None, "t")]
DOCS = "doc_id bigint, text string, source string"


def test_repeated_rows_stay_rows(spark, tmp_path):
    spark.createDataFrame(REPEATED, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted((tuple(r) for r in QUERIES["op6_mixing"](spark, str(tmp_path)).collect()), key=repr)
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
        wanted = con.execute(ORACLES["op6_mixing"]).fetchall()
    assert found == sorted(wanted, key=repr) and len(found) == len(REPEATED)
    assert all(taken <= 2 * size for _, size, _, _, taken in found)


def test_stage_takes_a_row_twice_at_most(spark):
    docs = spark.createDataFrame(REPEATED, DOCS)
    copies = Counter(tuple(r) for r in corpus_pipeline.mix_sources(spark, docs, "").collect())
    held = Counter(REPEATED)
    assert set(copies) <= set(held) and all(n <= 2 * held[r] for r, n in copies.items())
    words = sum(n * len((text or "").split()) for (_, text, _), n in copies.items())
    targets = {(r["source"], r["target"]) for r in mixing.mix(docs)[0].collect()}
    assert words >= sum(int(target) for _, target in targets)
