"""Models and encoders: exact agreement where there is one, held-out accuracy elsewhere."""

import html
import os
import random
import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabscope.llm import bpe, crosspolytope, htmltext, langid, toxicity
from tests.conftest import SF

PATH = public_tokenizers.path("word_bpe_49k.json")


def documents(spark, name="documents"):
    return spark.read.parquet(f"{SF}/{name}.parquet")


# --- BPE ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Encoder(file.read())


LIBRARY = Tokenizer.from_file(PATH)
ODD = ["<|endoftext|>", "<|startoftext|>", "<|", "'s", "'RE", "İ", "Σς", "é", "́", "\x1c", "\x85", "​", "²", "½", "٣", "中", "🙂", "ﬁ", "K"]


def agrees(encoder, texts):
    ids, decoded = encoder.encode(texts)
    wanted = LIBRARY.encode_batch(texts, add_special_tokens=False)
    assert ids.to_pylist() == [w.ids for w in wanted]
    assert decoded.to_pylist() == [LIBRARY.decode(w.ids, skip_special_tokens=False) for w in wanted]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.lists(st.sampled_from([*ODD, "a", "th", "ing", " ", "\n", "!"]), max_size=20).map("".join)), min_size=1, max_size=4))
def test_any_text_as_the_library(encoder, texts):
    agrees(encoder, texts)


def test_long_and_repetitive_words(encoder):
    rng = random.Random(2)
    agrees(encoder, ["a" * 5000, "ab" * 3000, "!" * 500, "", " ", "".join(rng.choice("aon") for _ in range(4000))])
    agrees(encoder, ["".join(rng.choice("aeiothn") for _ in range(rng.randint(1, 20))) for _ in range(3000)])


def test_encoder_forgets(encoder, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 1)
    agrees(encoder, ["some words", "other words"])
    agrees(encoder, ["other words again"])


def test_slices_and_segments(encoder, monkeypatch):
    """Texts over many slices and segments, with every kind of cut inside them."""
    monkeypatch.setattr(bpe, "SLICE_CHARS", 7)
    monkeypatch.setattr(bpe, "SEGMENT", 3)
    monkeypatch.setattr(bpe, "CACHE_PIECES", 5)
    rng = random.Random(8)
    agrees(encoder, ["".join(rng.choice([*ODD, "a", "th", "ing", " ", "\n", "\t ", "!", "Word"]) for _ in range(200)) for _ in range(30)])
    agrees(encoder, ["", " ", "   \n  ", "x" * 100, " lead", "trail "])


def test_caches_stay_bounded(monkeypatch):
    """Everything that an encoder remembers, over many more new words than it may."""
    monkeypatch.setattr(bpe, "CACHE_PIECES", 20_000)
    monkeypatch.setattr(bpe, "CACHE_CHARS", 150_000)
    monkeypatch.setattr(bpe, "CACHE_PAIRS", 5_000)
    with open(PATH, encoding="utf-8") as file:
        encoder = bpe.Encoder(file.read())
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("aeioubcdfghklmnprst.") for _ in range(rng.randint(2, 9)))
    seen = []
    for _ in range(12):
        encoder.encode([" ".join(word() for _ in range(40_000))])
        seen.append((len(encoder.pieces), encoder.chars, len(encoder.known), len(encoder.flat)))
    # one segment may be learned over the bound: its pieces and at most as many words of each
    for k, bound in enumerate((20_000 + 3 * bpe.SEGMENT, 150_000 + 30 * bpe.SEGMENT, 5_000 + 8 * bpe.SEGMENT, 2 * 8 * (20_000 + 3 * bpe.SEGMENT))):
        assert max(s[k] for s in seen) <= bound
    assert len({s[0] for s in seen}) > 3  # it has forgotten again and again


def test_encoding_without_text(spark):
    docs = spark.createDataFrame([(1, "the house", 5), (1, "the house", 5), (None, None, 5)], "doc_id bigint, text string, ids int")
    plain = bpe.encode(docs, PATH, decode=False)
    assert plain.columns == ["id", "ids"]
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(
        [(r["id"], r["ids"]) for r in bpe.encode(docs, PATH).collect()], key=repr)


def test_encode_documents(spark):
    docs = documents(spark).withColumn("ids", F.lit(1))
    found = {r["id"]: r for r in bpe.encode(docs, PATH).collect()}
    for r in docs.select("doc_id", "text").collect():
        ids = LIBRARY.encode(r["text"], add_special_tokens=False).ids
        assert found[r["doc_id"]]["ids"] == ids
        assert found[r["doc_id"]]["decoded"] == LIBRARY.decode(ids, skip_special_tokens=False)
    some = spark.createDataFrame([(1, None), (1, None), (None, "")], "doc_id bigint, text string")
    assert [(r["ids"], r["decoded"]) for r in bpe.encode(some, PATH).collect()] == [([], "")] * 3
    assert bpe.encode(some.limit(0), PATH).count() == 0


# --- language -------------------------------------------------------------------------


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = langid.fit(docs.where(~held).selectExpr("doc_id AS id", "text", "lang"))
    found = langid.identify(docs.where(held), model).join(docs, F.col("id") == F.col("doc_id"))
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.95
    assert found.where("score < 0 OR score > 1").count() == 0
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 %%"), (4, "the"), (4, "the")], "doc_id bigint, text string")
    rows = langid.identify_rows(odd, model, "lang").collect()
    assert [r["lang"] for r in rows][:3] == ["und"] * 3 and rows[3]["lang"] != "und" and len(rows) == 5
    assert langid.identify(odd.limit(0), model).count() == 0


def test_language_with_few_labels(spark):
    none = spark.createDataFrame([], "id bigint, text string, lang string")
    odd = spark.createDataFrame([(1, "word")], "doc_id bigint, text string")
    assert langid.identify(odd, langid.fit(none)).first()["lang_pred"] == "und"
    one = spark.createDataFrame([(1, "ein wort", "de"), (2, None, "de")], "id bigint, text string, lang string")
    assert langid.identify(odd, langid.fit(one)).first()["lang_pred"] == "de"


def test_presence_kernel():
    presence = langid.Presence()
    held, known = presence.matrix(["ab", "ab ab", "1!", ""])
    assert known.tolist() == [True, True, False, False]
    assert held[0].sum() == 3 and held[1].sum() > 3 and held[3].sum() == 0
    assert langid.kernel(held[:1], held[:1])[0, 0] == pytest.approx(1)


def test_language_like_plain_python(spark):
    words = {"x1": "der und ein von zu mit", "x2": "the of and to in that", "x3": "le de un les et des"}
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(words[k].split()) for _ in range(30)), k) for i, k in enumerate(sorted(words) * 20)]
    model = langid.fit(spark.createDataFrame(rows, "id bigint, text string, lang string"))
    long = "the and that of " * 200_000
    others = [(100, "Und der EIN, von!", 1), (101, "les et des un", 1), (102, long, 1), (103, long, 1), (103, "qq", 1), (None, None, 1)]
    docs = spark.createDataFrame(others, "doc_id bigint, text string, lang int")
    docs = docs.selectExpr("*", "1 AS id", "2 AS lang_pred", "3 AS score", "4 AS held_out")  # names it returns itself
    found = {(r["id"], r["lang_pred"], round(r["score"], 4)) for r in langid.identify(docs, model).collect()}

    def plain(text):
        presence = langid.Presence()
        runs = re.sub(r"[^a-z]", " ", (text or "").lower())
        if not runs.strip():
            return "und", 0.0
        # every string of one to three letters by itself, its place found by hashing it alone
        places = set()
        for order in (1, 2, 3):
            for gram in {runs[k : k + order] for k in range(len(runs) - order + 1)}:
                held, _ = presence.matrix([gram])
                smaller = [presence.matrix([gram[k : k + n]])[0] for n in range(1, order) for k in range(order - n + 1)]
                places |= set(np.flatnonzero(held[0]))
                assert all(set(np.flatnonzero(x[0])) <= set(np.flatnonzero(held[0])) for x in smaller)
        row = np.zeros(langid.WIDTH)
        row[list(places)] = 1 / np.sqrt(len(places))
        outputs = row @ model.weights + model.bias
        return model.languages[int(np.argmax(outputs))], round(float(np.clip(outputs.max(), 0, 1)), 4)

    wanted = {(i, *plain(t)) for i, t, _ in others}
    assert {x[:2] for x in found} == {x[:2] for x in wanted}
    for i, name, score in found:
        assert any(w[:2] == (i, name) and abs(w[2] - score) < 1e-3 for w in wanted)
    assert {n for i, n, _ in found if i in (100, 101, 102)} == {"x1", "x3", "x2"}
    # a tie goes to the first language by name
    even = langid.Model(["b", "c"], np.zeros((langid.WIDTH, 2), np.float32), np.array([0.5, 0.5]))
    assert {r["lang_pred"] for r in langid.identify(docs.where("text IS NOT NULL"), even).collect()} == {"b"}


# --- toxicity -------------------------------------------------------------------------


def test_toxicity(spark):
    rng = random.Random(5)
    syllables = ["an", "er", "the", "on", "ish", "re", "ti", "lo", "ma", "su", "qui", "bar"]

    def text(toxic):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(20, 200))]
        for _ in range(2 + len(words) // 40 if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(["vexgrob", "zwolfik", "hjupdak"])
        return " ".join(words)

    rows = [(i, text(i % 4 == 0), int(i % 4 == 0)) for i in range(1600)]
    docs = spark.createDataFrame(rows, "id bigint, text string, toxic int")
    model = toxicity.fit(docs.where("id < 1200"), docs.where("id < 1200").selectExpr("id", "toxic AS label"))
    found = toxicity.score(docs.where("id >= 1200"), model, "id").join(docs, "id")
    rate = {r["toxic"]: r["rate"] for r in found.groupBy("toxic").agg(F.avg((F.col("score") >= 0.5).cast("int")).alias("rate")).collect()}
    assert rate[1] > 0.9 and rate[0] < 0.05
    odd = spark.createDataFrame([(1, None), (1, None), (2, "")], "id bigint, text string")
    scores = [r["score"] for r in toxicity.score(odd, model, "id").collect()]
    assert len(set(scores)) == 1 and 0 <= scores[0] < 0.5
    assert toxicity.score(odd.limit(0), model, "id").count() == 0
    # very long texts, repeated rows, and columns with the names that scores have
    long = text(0) + " "
    wide = [(1, long * 3000), (1, long * 3000), (2, long * 1500 + "vexgrob zwolfik hjupdak " * 40 + long * 1500)]
    wide = spark.createDataFrame(wide, "doc_id bigint, text string").selectExpr("*", "1 AS id", "2 AS score", "3 AS label")
    first, again, marked = [r["score"] for r in toxicity.score(wide, model).orderBy("id").collect()]
    assert first == again and 0 <= first <= 1 and 0 <= marked <= 1
    # what each window saves is what the two dictionaries' lengths say, window by window
    scorer, some = toxicity.Scorer(model), text(1)
    saved = []
    for window in toxicity.windows(toxicity.fold(some)):
        sizes = [len(c.compress(window + model.tail)) for c in toxicity.Scorer(model).pair]
        saved.append(sizes[0] - sizes[1])
    assert scorer.features(some)[0] == min(max(saved), 8) and scorer.features(some)[4] == float(max(saved) >= 2)
    assert toxicity.fit(docs.limit(0), docs.limit(0).selectExpr("id", "toxic AS label")).constant == 0.0
    nobody = toxicity.fit(docs, docs.where("toxic = 0").selectExpr("id", "toxic AS label"))
    assert [r["score"] for r in toxicity.score(odd, nobody, "id").collect()] == [0.0] * 3


# --- pages ----------------------------------------------------------------------------


PAGES = [
    ("<p>One &amp; <b>two</b>\n three<br>four</p><p>five", "One & two three four five"),
    ("<nav>menu</nav><article><h1>T</h1><p><b>x<br><p>y</article><footer>f</footer>", "T x y"),
    ("<article><p>a<div class='share'>no</div><aside>no</aside>b</article>rest", "a b"),
    ("<main>m<script>var t='</p>';</script><!-- no --><form>no</form><p hidden>no</p></main>", "m"),
    ("<body><div id=comments><p>no</div><div class='ad box'>no</div>yes &copy; &#65; &nosuch; &am</body>", "yes © A &nosuch; &am"),
    ("<article><section class=comments>no</section><p>a&nbsp;b</p></article>", "a b"),
    ("<a title='a > b'>in</a>line", "inline"),
    ("", ""),
    (None, ""),
    ("<", "<"),
    ("no markup at all", "no markup at all"),
]


LEGAL = [
    ('<article><p>one <svg class="i"/> two</p><p>three</p></article>', "one two three"),
    ("<article><p>one <math/>two</p><svg a='/'><text>no</text></svg><p>three</article>", "one two three"),
    ('<article><p class="notice">no<p>one<p>two</article>', "one two"),
    ('<article><p class="notice">no <b>no<h2>one</h2>two</article>', "one two"),
    ('<article><ul><li class="menu">no<li>one<ul><li class="share">no</ul>two</ul>three</article>', "one two three"),
    ('<article><li class="menu"><div>no<ul><li>no</ul>no</div><li>one</article>', "one"),
    ('<article><dl><dt hidden>no<dd>one<dd hidden>no<dt>two</dl></article>', "one two"),
    ('<article><table><tr hidden><td>no<td>no<tr><td hidden>no<td>one<table><tr><td>two</table>three<tbody><tr><td>four</table></article>', "one two three four"),
    ('<article><table><tr><td hidden><p>no<table><tr><td>no</table>no<td>one</table></article>', "one"),
]


@pytest.mark.parametrize("page, wanted", LEGAL)
def test_tags_left_out(page, wanted):
    assert " ".join(text for kind, text in htmltext.blocks(page) if kind == "main") == wanted


def test_pages(spark):
    rows = [(i, f"http://h{i}.org/p", page, "x") for i, (page, _) in enumerate(PAGES)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    found = {r["id"]: r["text"] for r in htmltext.extract(df).collect()}
    for i, (_, wanted) in enumerate(PAGES):
        assert found[i] == wanted, PAGES[i]
    assert htmltext.extract(df.limit(0)).count() == 0
    assert htmltext.extract(df.unionByName(df)).count() == 2 * len(PAGES)


def test_host_boilerplate(spark):
    rng = random.Random(8)
    line = "all rights reserved by the owners of this little site since ever"
    pages = []
    for i in range(30):
        own = " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(40))
        pages.append((i, "http://a.org/" if i % 3 else None, f"<div>{line}</div><div>{own}</div>", own))
    pages.append((99, "http://b.org/", f"<div>{line}</div>", line))
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string, own string").repartition(5)
    found = {r["id"]: r["text"] for r in htmltext.extract(df).collect()}
    assert found == {p[0]: p[3] for p in pages}
    copies = spark.createDataFrame([(1, "http://c.org", pages[0][2]), (2, "http://c.org", pages[0][2])], "page_id bigint, url string, html string")
    assert {r["text"] for r in htmltext.extract(copies).collect()} == {f"{line} {pages[0][3]}"}


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def extracted(spark, bodies, url="http://big.org/", parts=5):
    df = spark.createDataFrame([(i, url, b) for i, b in enumerate(bodies)], "page_id bigint, url string, html string")
    return {r["id"]: r["text"] for r in htmltext.extract(df.repartition(parts)).collect()}


def test_large_host(spark, monkeypatch):
    """Phrases that few pages share stay; what a share of them has goes, also where it is searched in groups."""
    monkeypatch.setattr(htmltext, "DEALT", 16, raising=False)
    rng = random.Random(3)
    line, quote, rare = prose(rng, 12), prose(rng, 10), prose(rng, 9)
    bodies, wanted = [], {}
    for i in range(100):
        own = prose(rng, 40)
        own += f" {quote}" if i % 10 == 0 else f" {rare}" if i in (3, 4) else ""
        bodies.append(f"<ul><li>Home<li>About us</ul><div>{own}</div>" + (f"<div>{line}</div>" if i % 4 == 0 else ""))
        wanted[i] = own
    assert extracted(spark, bodies) == wanted
    assert extracted(spark, bodies, None) == wanted


def test_near_copies_keep_the_article(spark):
    rng = random.Random(5)
    article, ends = prose(rng, 60), [prose(rng, 12) for _ in range(8)]
    cut = " ".join([*article.split()[:28], "other words", *article.split()[30:]])
    pair = [f"<div>{article}</div><p>{ends[0]}</p>", f"<div>{cut}</div><p>{ends[1]}</p>"]
    found = extracted(spark, pair)
    assert found == {0: f"{article} {ends[0]}", 1: f"{cut} {ends[1]}"}
    found = extracted(spark, pair + [f"<div>{prose(rng, 60)}</div>" for _ in range(6)])
    assert found[0] == f"{article} {ends[0]}" and found[1] == f"{cut} {ends[1]}"


def test_notices_inside_articles(spark):
    """What a share of the host's articles carries goes without any mark; quotes, headings and copies stay."""
    rng = random.Random(7)
    notice, advert, quote, few = (prose(rng, n) for n in (12, 9, 10, 11))
    bodies, wanted = [], {}
    for i in range(30):
        first, last = prose(rng, 40), prose(rng, 30)
        first += f" {quote}" if i % 6 == 0 and i else f" {few}" if i in (1, 2) else ""
        extra = f"<p>{advert}</p>" if i % 3 == 0 else ""
        bodies.append(f"<article><h2>References</h2><p>{first}</p><p>{notice}</p><p>{last}</p>{extra}</article>")
        wanted[i] = f"References {first} {last}"
    copy = prose(rng, 50)
    bodies += [f"<article><p>{copy}</p><p>{notice}</p></article>"] * 8
    wanted |= dict.fromkeys(range(30, 38), copy)
    assert extracted(spark, bodies) == wanted
    small = [f"<article><p>{prose(rng, 30)} {quote}</p></article>" for _ in range(4)]
    found = extracted(spark, small)
    assert all(f"<article><p>{found[i]}</p></article>" == small[i] for i in range(4))


def test_suffix_classes():
    rng = random.Random(1)
    words = [rng.choice("abc") for _ in range(400)]
    sizes = [150, 7, 243]
    ends = np.repeat(np.cumsum(sizes), sizes)
    order, rank = htmltext.classes_to(htmltext.word_keys(words), ends, 8)
    groups = {}
    for start, label in zip(order.tolist(), rank.tolist()):
        groups.setdefault(label, []).append("".join(words[start : start + 8]))
    assert all(len(set(g)) == 1 for g in groups.values())
    assert len({g[0] for g in groups.values()}) == len(groups)
    assert len(order) == 143 + 0 + 236


def test_registered_pages(spark):
    for r in documents(spark, "pages").limit(40).collect():
        text = " ".join(t for kind, t in htmltext.blocks(r["html"]) if kind == "main")
        body = r["html"].split("<article>")[1].split("</article>")[0]
        for tag in ("<p>", "</p>", "<h1>", "</h1>", "<br>"):
            body = body.replace(tag, " ")
        assert text == " ".join(html.unescape(body.replace("<b>", "").replace("</b>", "")).split())


# --- embeddings -----------------------------------------------------------------------


@pytest.mark.parametrize("limit", [7, 2048])
def test_embeddings(spark, limit, monkeypatch):
    monkeypatch.setattr(crosspolytope, "BLOCK", limit)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 48))
    rows = [b + rng.normal(scale=s, size=48) for b in base for s in (0, 0.05, 0.1, 0.2, 0.4)]
    rows += [rows[0], rows[0] * 1.0, [0.0] * 48, None, [], [float("nan")] * 48, [1.0] * 3, [1.0] * 3, [float("inf"), 1.0]]
    rows += [[None, 1.0], [1e300, 1e300], [1e300, 1.1e300], [-0.0, 2.0], [0.0, 2.0]]
    data = [(i, None if r is None else [None if x is None else float(x) for x in r], 1) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>, n int")
    found = {r["id"]: r for r in crosspolytope.near_duplicates(df).collect()}
    assert len(found) == len(data)
    good = [
        r is not None and len(r) > 0 and None not in r and np.isfinite(r).all() and np.any(np.array(r) != 0) for _, r, _ in data
    ]
    unit = [np.array(r) / np.abs(r).max() / np.linalg.norm(np.array(r) / np.abs(r).max()) if g else None for g, (_, r, _) in zip(good, data)]
    links = np.zeros(len(data), int)
    label = list(range(len(data)))
    pairs = [
        (a, b) for a in range(len(data)) for b in range(a)
        if good[a] and good[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9
    ]
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    for _ in range(len(data)):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    got = np.array([found[i]["n_links"] for i in range(len(data))])
    assert (got <= links).all() and got.sum() >= 0.97 * links.sum()
    same = np.array([found[i]["component_id"] == label[i] for i in range(len(data))])
    assert same.mean() > 0.97
    for i in range(200, len(data)):
        assert (got[i], found[i]["component_id"]) == (links[i], label[i]), i
    assert all(found[i]["kept"] == (found[i]["component_id"] == i) for i in range(len(data)))
    assert crosspolytope.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("dims", [1, 2, 3, 48, 64, 300])
def test_sketches_bound_cosines(dims):
    rng = np.random.default_rng(dims)
    base = rng.normal(size=(30, dims))
    base[0], base[1] = np.eye(dims)[0], -np.eye(dims)[0]
    rows = crosspolytope.unit(np.concatenate([base + rng.normal(scale=s, size=base.shape) for s in (0, 0.01, 0.1, 0.3)]))
    found = crosspolytope.buckets(rows)
    read = crosspolytope.Marks(crosspolytope.marks(rows, found), dims)
    assert np.array_equal(read.own, found)
    a, b = (x.ravel() for x in np.indices((len(rows), len(rows))))
    cosines = (rows[a] * rows[b]).sum(1)
    assert (read.highest(a, b) >= cosines).all()
    if dims >= 48:  # and tell most pairs apart
        assert (read.highest(a, b) < 0.9).sum() > 0.9 * (cosines < 0.6).sum()


@pytest.mark.skipif(not os.path.exists("/root/testdata/check_s/embeddings.parquet"), reason="needs the check tables")
def test_embeddings_of_the_check_table(spark):
    rows = spark.read.parquet("/root/testdata/check_s/embeddings.parquet").select("vec_id", "embedding")
    good = {r["vec_id"]: r["embedding"] for r in rows.collect() if r["embedding"] and None not in r["embedding"]}
    good = {i: v for i, v in good.items() if len(v) == 64 and np.isfinite(v).all() and np.any(v)}
    ids = np.array(list(good))
    units = crosspolytope.unit(np.array([good[i] for i in ids], np.float64))
    wanted = {int(i): int(((units @ u) >= 0.9).sum()) - 1 for i, u in zip(ids, units)}
    found = {r["id"]: r["n_links"] for r in crosspolytope.near_duplicates(rows).collect()}
    links = sum(wanted.values())
    assert links and all(found[i] <= wanted[i] for i in wanted)
    assert sum(found[i] for i in wanted) >= 0.999 * links


def test_rotation_keeps_lengths():
    rows = np.random.default_rng(0).normal(size=(5, 64))
    turned = crosspolytope.hadamard(rows)
    assert np.allclose((turned**2).sum(1), (rows**2).sum(1))
    assert np.allclose(crosspolytope.hadamard(turned), rows)
