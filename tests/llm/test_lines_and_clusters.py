"""Line quality, Walsh-Hadamard clusters and fill-in-the-middle by brute force."""

import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabscope.llm import fillmiddle, linecrf, walshclusters
from tabscope.llm.queries import QUERIES
from tests.conftest import SF

# --- fill in the middle ------------------------------------------------------------------


def cut_by_hand(doc_id, text, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return len(units), "plain", None, None, text
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 50:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_fill_middle_by_hand(spark):
    texts = [None, "", "a", "\n", "\n\n\n", "a<P>b\nc", "x<S>", "<M>\n\n", "x\ny\nz", "é𝒳\r\n$1\\n\n<S\n", "<\nP>\n", " a\u0085b\nc\x00d"]
    texts += ["l%d é\n" % k * (k + 1) + "end" * (k % 2) for k in range(40)]
    texts += ["ab\n" * 300_000, "\n" * 500_000, "x" * 3_000_000, "x\n" + "y" * 2_000_000 + "\n𝒳"]
    rows = [(k, t, "clash", 5) for k, t in enumerate(texts)]
    rows += [(None, "x\ny\nz", "r", 1), *[(7, "x\ny\nz\n", "same", 1)] * 3]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, output string, n int")
    made = fillmiddle.transform(docs).withColumn("back", fillmiddle.restore("output", "form"))
    found = [tuple(r) for r in made.collect()]
    wanted = [(r[0], *cut_by_hand(r[0], r[1]), r[1] or "") for r in rows]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    assert {r[2] for r in found} == {"plain", "spm", "psm"}


def test_fill_middle_parameters(spark):
    docs = spark.createDataFrame([(k, "a b  c") for k in range(200)], "doc_id bigint, text string")
    made = fillmiddle.transform(docs, unit=r"\S+\s*", rate=50, spm_rate=0, seed=3)
    rows = made.withColumn("back", fillmiddle.restore("output", "form")).collect()
    assert all(r["n"] == 3 and r["back"] == "a b  c" for r in rows)
    assert {r["form"] for r in rows} == {"plain", "psm"} and 60 < sum(r["form"] == "plain" for r in rows) < 140
    assert fillmiddle.transform(docs.limit(0)).count() == 0


# --- clusters ----------------------------------------------------------------------------


def plain_nearest(vectors, centroids):
    found = []
    for v in vectors:
        gaps = [sum((int(a) - int(b)) ** 2 for a, b in zip(v, c)) for c in centroids]
        found.append((gaps.index(min(gaps)), min(gaps)))
    return found


def test_walsh_rows():
    rows = walshclusters.walsh(np.eye(64, dtype=np.int64)).T
    assert (rows @ rows.T == 64 * np.eye(64)).all()
    assert [(np.diff(r) != 0).sum() for r in rows] == list(range(64))  # coarse to fine


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 1 << 30), st.sampled_from([1, 2, 64, 1 << 20, 1 << 27]), st.integers(1, 20))
def test_search_is_exact(seed, size, number):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-size, size + 1, (40, 64)).astype(np.int32)
    centroids = rng.integers(-size, size + 1, (number, 64))
    centroids[-1] = centroids[0]  # a tie
    vectors[:number] = centroids[rng.permutation(number)]
    cluster, distance, _ = walshclusters.nearest(vectors, centroids)
    assert list(zip(cluster, distance)) == plain_nearest(vectors, centroids)


def test_search_leaves_out_far_centroids(spark):
    rng = np.random.default_rng(1)
    smooth = np.cumsum(rng.normal(0, 6, (16, 64)), 1).astype(np.int64)  # coarse coefficients tell them apart
    vectors = smooth[rng.integers(0, 16, 500)] + rng.integers(-2, 3, (500, 64))
    cluster, distance, work = walshclusters.nearest(vectors, smooth)
    assert list(zip(cluster, distance)) == plain_nearest(vectors, smooth)
    assert work < 0.3 * 500 * 16 * 64


def clusters_by_hand(rows, clusters, rounds):
    kept = [(i, [math.floor(64.0 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [max(-(1 << 27), min(1 << 27, x)) for x in v]) for i, v in kept]
    place = lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=place)[:clusters]]
    for step in range(rounds + 1):
        found = plain_nearest([v for _, v in kept], centroids)
        if step == rounds:
            break
        for k in range(len(centroids)):
            own = [v for (_, v), (c, _) in zip(kept, found) if c == k]
            if own:
                centroids[k] = [sum(x) // len(own) for x in zip(*own)]
    return [(i, c, d) for (i, _), (c, d) in zip(kept, found)], centroids


def test_clusters_by_hand(spark):
    rng = np.random.default_rng(5)
    rows = [(k, [float(x) for x in rng.normal(0, 0.2, 64) + (k % 5)]) for k in range(120)]
    rows += [(200, None), (201, []), (202, [1.0] * 63), (203, [None, *[1.0] * 63]), (204, [float("nan"), *[0.0] * 63]),
             (205, [float("inf"), *[0.0] * 63]), (206, [0.0] * 64), (207, [0.0] * 64), (207, [0.0] * 64), (208, [1e300, *[-1e9] * 63]),
             (None, [0.5] * 64), (209, [-0.001] * 64)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<double>, cluster string, distance int")
    for clusters, rounds in ((16, 3), (3, 1), (400, 2)):
        found, about = walshclusters.cluster(df, clusters=clusters, rounds=rounds)
        wanted, centroids = clusters_by_hand(rows, clusters, rounds)
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(wanted, key=repr)
        own = {}
        for _, c, d in wanted:
            own[c] = own.get(c, 0) + d
        total = sum(own.values())
        fits = lambda x: x if x < 1 << 63 else None
        assert {r["cluster"]: (r["centroid"], r["cluster_inertia"], r["inertia"]) for r in about.collect()} == {
            c: (centroids[c], fits(d), fits(total)) for c, d in own.items()}


def test_clusters_of_nothing(spark):
    for rows in ([], [(1, None), (2, [1.0])]):
        df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
        found, about = walshclusters.cluster(df)
        assert found.count() == about.count() == 0


# --- line quality ------------------------------------------------------------------------


def test_marginals_by_hand():
    """Against the sum over all labelings."""
    rng = random.Random(4)
    for n in range(1, 8):
        odds = [rng.uniform(-3, 3) for _ in range(n)]
        table = [[rng.uniform(-1, 1) for _ in "01"] for _ in "01"]
        mass, good = 0.0, [0.0] * n
        pairs = np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=n):
            weight = math.exp(sum(o * y for o, y in zip(odds, labels)) + sum(table[a][b] for a, b in zip(labels, labels[1:])))
            mass += weight
            for i, y in enumerate(labels):
                good[i] += weight * y
            for a, b in zip(labels, labels[1:]):
                pairs[a, b] += weight
        assert linecrf.marginals(odds, table) == pytest.approx([g / mass for g in good])
        found, expected = linecrf.Chains(np.array([n])).run(np.array(odds), np.array(table))
        assert found == pytest.approx([g / mass for g in good]) and expected == pytest.approx(pairs / mass)


def test_gradient_by_hand():
    """The chain's slope against differences of its likelihood."""
    rng = np.random.default_rng(2)
    sizes, rows = np.array([3, 1, 4]), rng.normal(size=(8, 2))
    labels = rng.integers(0, 2, 8).astype(float)

    def likelihood(w, table):
        odds, total, start = rows @ w, 0.0, 0
        for n in sizes:
            own, y = odds[start : start + n], labels[start : start + n].astype(int)
            weigh = lambda ys: sum(o * v for o, v in zip(own, ys)) + sum(table[a, b] for a, b in zip(ys, ys[1:]))
            total += weigh(y) - math.log(sum(math.exp(weigh(ys)) for ys in itertools.product((0, 1), repeat=int(n))))
            start += n
        return total

    w, table = rng.normal(size=2), rng.normal(size=(2, 2))
    good, pairs = linecrf.Chains(sizes).run(rows @ w, table)
    slope = rows.T @ (labels - good)
    for i in range(2):
        step = np.eye(2)[i] * 1e-5
        assert (likelihood(w + step, table) - likelihood(w - step, table)) / 2e-5 == pytest.approx(slope[i], abs=1e-4)
    seen = np.zeros((2, 2))
    for a, b in ((0, 1), (1, 2), (4, 5), (5, 6), (6, 7)):
        seen[int(labels[a]), int(labels[b])] += 1
    step = np.zeros((2, 2))
    step[0, 1] = 1e-5
    assert (likelihood(w, table + step) - likelihood(w, table - step)) / 2e-5 == pytest.approx((seen - pairs)[0, 1], abs=1e-4)


def line_figures_by_hand(line):
    kind = linecrf.kinds()
    of = [int(kind[ord(c)]) for c in line]
    shares = [of.count(k) / len(of) for k in range(8)]
    pairs = [sum(a == i and b == j for a, b in zip(of, of[1:])) / max(len(of) - 1, 1) for i in range(8) for j in range(8)]
    words = line.split()
    return shares, pairs, sum(a == b for a, b in zip(words, words[1:])) / max(len(words) - 1, 1), len(set(words)) / len(words)


def test_line_figures(monkeypatch):
    lines = ["The house, 12 rooms.", "de de de | x", "A", "¿É!! 中 𝒳", "A", "  two  spaces "]
    before = [None, *lines[:-1]]
    for size in (1 << 12, 2):
        monkeypatch.setattr(linecrf, "BLOCK_LINES", size)
        rows = np.concatenate(list(linecrf.LineFeatures().blocks(lines, before)))
        for line, row in zip(lines, rows):
            shares, pairs, same, distinct = line_figures_by_hand(line)
            assert row[:8] == pytest.approx(shares) and row[11:75] == pytest.approx(pairs)
            assert row[8] == pytest.approx(same) and row[9] == pytest.approx(distinct)


def quality_rows(rng, n):
    good = lambda: " ".join(rng.choice(["the", "river", "house", "green", "walks"]) for _ in range(rng.randint(5, 12))).capitalize() + "."
    bad = lambda: " | ".join(rng.choice(["home", "login", "cart"]) for _ in range(8))
    rows = []
    for k in range(n):
        label = k % 2
        lines = [good() if label or rng.random() < 0.25 else bad() for _ in range(rng.randint(2, 9))]
        if not label:
            lines.append(bad())
        rows.append((k, "\n".join(lines), label))
    return rows


def test_quality_held_out(spark):
    rows = quality_rows(random.Random(3), 400)
    docs = spark.createDataFrame([(i, t, 0.5, "s") for i, t, _ in rows], "id bigint, text string, score double, label string")
    known = spark.createDataFrame([(i, y) for i, _, y in rows[:300]], "id bigint, label int")
    model = linecrf.fit(docs, known)
    found = {r["id"]: r["score"] for r in linecrf.score(docs, model, "id").collect()}
    assert all((found[i] >= 0.7) == bool(y) for i, _, y in rows[300:])
    # a line's neighbours count: the same line is worth less between bad ones
    scorer = linecrf.Scorer(model)
    line, bad = rows[301][1].split("\n")[0], "home | login | cart | home"
    assert scorer.shares([line])[0] > scorer.shares([f"{bad}\n{line}\n{bad}"])[0]


def test_quality_of_odd_input(spark):
    rows = quality_rows(random.Random(5), 60)
    rows += [(60, None, 0), (61, "", 0), (62, " \n ", 1), (62, "the same id", 1), (63, "no label", None), (64, "label two", 2)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t, _ in rows] + [(None, "no id", "x", 1)], "doc_id bigint, text string, id string, score int")
    known = spark.createDataFrame([(i, y) for i, _, y in rows] + [(3, 0), (None, 1), (999, 1)], "id bigint, label int")
    model = linecrf.fit(docs.selectExpr("doc_id AS id", "text"), known)
    long_line, many = "The house is green. " * 40_000, "The house is green.\n" * 60_000
    more = spark.createDataFrame([(900, long_line, "x", 1), (901, many, "x", 1), (902, "\x00" * 5, "x", 1)], docs.schema)
    scored = [tuple(r) for r in linecrf.score(docs.unionByName(more), model).collect()]
    found = dict(scored)
    assert len(scored) == docs.count() + 3 and all(0 <= s <= 1 for _, s in scored)
    assert found[60] == found[61] == model.empty and 0 < model.empty < 1
    assert found[900] > 0.7 and found[901] > 0.7
    assert linecrf.score(docs.limit(0), model).count() == 0
    # one label, no label, no document: every text gets the share, and nothing fails
    for known_rows in ([(1, 1)], [], [(5000, 1), (5001, 0)]):
        none = linecrf.fit(docs.selectExpr("doc_id AS id", "text"), spark.createDataFrame(known_rows, "id bigint, label int"))
        assert none.weights is None
        assert {r["score"] for r in linecrf.score(docs, none).collect()} <= {none.share, none.empty}
    assert linecrf.fit(docs.limit(0).selectExpr("doc_id AS id", "text"), known).weights is None


def test_quality_query(spark):
    rows = QUERIES["op11_quality"](spark, SF).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [r for r in rows if r["held_out"] and labels.get(r["doc_id"]) is not None]
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count() and held
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.9 * len(held)
