"""The registered queries against SQL, and the pipeline against the operators it is made of."""

import hashlib
import random

import pytest
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tabscope.llm import langid
from tabscope.llm.common import written
from tabscope.llm.queries import ORACLES, QUERIES, language_model
from tests.conftest import SF, plan_of
from tests.llm.test_text_operators import plain_fingerprint, smallest_reachable
from tools.check import compare, connection


@pytest.mark.parametrize("name", list(ORACLES))
def test_against_sql(spark, name):
    verdict, _ = compare(spark, connection(SF), name, QUERIES[name], ORACLES[name], SF)
    assert verdict.startswith("ok"), verdict


def test_registered():
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())
    assert {n.split("_")[0] for n in QUERIES} == {"pipeline", *(f"op{k}" for k in range(1, 14))}


@pytest.mark.parametrize("name", ["op3_secrets", "op5_exact_dedup", "op6_mixing", "op13_fill_middle"])
def test_native(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def corpus(spark):
    rng = random.Random(6)
    docs = []
    for i in range(120):
        text = " ".join(rng.choice(["the", "of", "house", "river"] if i % 2 else ["der", "und", "haus", "fluss"]) + str(rng.randint(0, 300)) for _ in range(60))
        docs.append([i, text, "en" if i % 2 else "de", f"s{i % 4}" if i % 7 else None])
    docs += [[200 + i, docs[i][1], "en", "s1"] for i in range(10)]
    docs += [[300 + i, docs[i][1].replace("der", "Der") + " end", "en", "s2"] for i in range(20, 40)]
    docs += [[400, None, "en", "s1"], [401, "", None, "s1"], [402, "12 34", "de", None], [5, "again with the same id", "en", "s0"], list(docs[3])]
    rows = [(*d, len(d[1] or ""), 1, "k") for d in docs]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, finish int, id string")


def test_pipeline_by_hand(spark):
    """Every decision of the pipeline made again by plain Python, stage by stage."""
    docs = written(corpus(spark), "test")
    names, steps = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "test")
        steps[name] = docs
        if name != "bpe":
            assert docs.columns == names
    rows = [(r["doc_id"], r["text"], r["source"]) for r in corpus(spark).collect()]
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert sorted(rows, key=repr) == sorted(((r["doc_id"], r["text"], r["source"]) for r in steps["language_id"].collect()), key=repr)
    last = {}
    for r in rows:
        last[r[1]] = max(last.get(r[1], -1), r[0])
    rows = list({r[:2]: r for r in rows if last[r[1]] == r[0]}.values())
    assert sorted((r["doc_id"], r["text"]) for r in steps["exact_dedup"].collect()) == sorted(r[:2] for r in rows)
    rows.sort(key=lambda r: r[0])
    fps = [plain_fingerprint(r[1]) for r in rows]
    linked = [(a, b) for a in range(len(rows)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4]
    assert linked
    label = smallest_reachable(len(rows), linked)
    rows = [r for i, r in enumerate(rows) if label[i] == i]
    assert sorted((r["doc_id"], r["text"]) for r in steps["simhash_near_dedup"].collect()) == sorted(r[:2] for r in rows)
    mixed = steps["mixing"].collect()
    size = {r["doc_id"]: len(r["text"].split()) for r in mixed}
    assert {(r["doc_id"], r["text"]) for r in mixed} <= {r[:2] for r in rows}
    total = sum(len(r[1].split()) for r in rows)
    assert 1.4 * total < sum(size[r["doc_id"]] for r in mixed) < 1.5 * total + 61 * 6
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = []
    for r in mixed:
        ids = library.encode(r["text"], add_special_tokens=False).ids
        digest = hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        wanted.append((r["doc_id"], ids, digest))
    assert sorted((r["doc_id"], r["ids"], r["decoded_sha256"]) for r in steps["bpe"].collect()) == sorted(wanted)


def test_pipeline_of_nothing(spark, tmp_path):
    corpus(spark).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_unlabelled_documents_stay(spark):
    docs = spark.createDataFrame([(1, "word", None, "s"), (2, "12", None, "s")], "doc_id bigint, text string, lang string, source string")
    assert language_model(docs).languages == []
    assert [r["doc_id"] for r in corpus_pipeline.identify_language(spark, docs, SF).collect()] == [1]
    assert langid.UNKNOWN == "und"
