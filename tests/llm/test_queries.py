"""The registered queries: against DuckDB where SQL can say them, and the awkward cases of the pipeline."""

import ast
import os
import random

import pytest

import corpus_pipeline
from keytally.llm import oracle, queries
from tests.conftest import ROOT, SF_ORACLE, SF_SMALL
from tests.llm import test_jaccard_join, test_source_mix
from tests.llm.helpers import awkward_texts, documents, words
from tests.oracle_harness import compare, duckdb_con


@pytest.mark.parametrize("name", sorted(oracle.ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    result = compare(spark, name, SF_ORACLE, duckdb_con(SF_ORACLE))
    assert result["match"], result


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert [n for n in oracle.ORACLE_SQL if n not in queries.QUERIES] == []


def test_mix_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    test_source_mix.check(rows, queries.op7_source_mix(spark, SF_SMALL).collect(), 64)


def test_nothing_else_imports_the_package():
    for folder, _, files in os.walk(os.path.join(ROOT, "keytally")):
        for f in files:
            if f.endswith(".py") and os.path.basename(folder) != "llm":
                tree = ast.parse(open(os.path.join(folder, f)).read())
                names = [n.module or "" for n in ast.walk(tree) if isinstance(n, ast.ImportFrom)] + \
                        [a.name for n in ast.walk(tree) if isinstance(n, ast.Import) for a in n.names]
                assert not any("llm" in x.split(".") for x in names)


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    rng = random.Random(5)
    rows = awkward_texts()
    for i in range(60):
        base = words(rng, rng.randrange(20, 200))
        edited = base.split()
        edited[len(edited) // 2] = "edited"
        rows += [(1000 + 10 * i, base, "a"), (1001 + 10 * i, base.upper(), "b"), (1002 + 10 * i, " ".join(edited), rng.choice("abc"))]
    documents(spark, rows).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (None, 0, 1), (1000, 1, 0), (1010, 1, 0), (1021, None, 1)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages_against_brute_force(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns = docs.columns

    def run(k, docs):
        out = corpus_pipeline.STAGES[k][1](spark, docs, corpus)
        assert k == 4 or out.columns == columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
        return spark.createDataFrame(out.collect(), out.schema)

    kept = run(0, docs)
    assert kept.count() == docs.count()  # all ratings say good: nothing is rejected

    once = run(1, kept)
    texts = {}
    for r in kept.collect():
        key = (r.text or "").encode().lower()
        texts[key] = max(texts.get(key, -10), -1 if r.doc_id is None else r.doc_id)
    assert sorted((-1 if r.doc_id is None else r.doc_id, (r.text or "").encode().lower()) for r in once.collect()) \
        == sorted((i, t) for t, i in texts.items())

    apart = run(2, once)
    rows = [(r.doc_id, r.text) for r in once.collect()]
    want = {c for i, n, c in test_jaccard_join.brute(rows, 5, 80, 100) if n}
    wordless = [r for r in rows if not (r[1] or "").split()]
    got = apart.collect()
    assert sorted(str(r.doc_id) for r in got if (r.text or "").encode().split()) == sorted(map(str, want))
    assert len(got) == len(want) + sum(1 for r in rows if not (r[1] or "").encode().split()) and len(wordless) > 0

    mixed = run(3, apart)
    assert all(r.n_chars == len(r.text) for r in mixed.collect())
    have = {r.doc_id: (r.text or "") for r in got}
    assert {r.doc_id for r in mixed.collect()} <= set(have)

    packed = run(4, mixed)
    from tests.llm.test_best_fit import check_places
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in mixed.collect()}
    check_places(packed.collect(), 2048)


def test_pipeline_on_given_data(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 100


def test_pipeline_on_empty_tables(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_quality_stage_rejects_what_a_plain_recomputation_rejects(spark, tmp_path):
    """Poor and toxic labels: the ids that go are those whose tail probability is below ``SELECT_AT``."""
    from keytally.llm import quality
    rng = random.Random(6)
    kinds = ["w", "toxic", "junk"]
    rows = [(i, " ".join(f"{kinds[i % 3]}{rng.randrange(30)}" for _ in range(rng.randrange(5, 60))), "a") for i in range(150)]
    labels = [(i, 0 if i % 3 == 2 else 1, 1 if i % 3 == 1 else 0) for i in range(90)]
    docs = documents(spark, rows).repartition(3)
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    grades = spark.createDataFrame([(i, 0 if not q else 1 if t else 2) for i, q, t in labels], "doc_id long, grade int")
    model = quality.train(docs, grades)

    def tail(text):
        z = sum(float(model.weights[p]) for t in quality.tokens_of(text) for p in quality.places(t, model.bits))
        return quality.sigmoid(z - model.cuts[1])

    rejected = {i for i, text, _ in rows if tail(text) < quality.SELECT_AT}
    kept = {r.doc_id for r in corpus_pipeline.quality_stage(spark, docs, str(tmp_path)).collect()}
    assert {i for i, _, _ in rows} - kept == rejected
    assert len(rejected & {i for i in range(150) if i % 3}) > 90 and len(kept) > 40


def test_mixing_stage_takes_words_in_order_and_as_often_as_due(spark):
    rng = random.Random(7)
    rows = [(i, words(rng, rng.randrange(1, 400)), rng.choice("abbbb")) for i in range(120)]
    text, source, taken = {r[0]: r[1] for r in rows}, {r[0]: r[2] for r in rows}, {}
    for r in corpus_pipeline.mixing_stage(spark, documents(spark, rows).repartition(3), "").collect():
        rest = iter(text[r.doc_id].split())
        assert all(w in rest for w in r.text.split())  # words of the document in their order
        taken.setdefault(r.doc_id, []).append(len(r.text.split()))
    sizes = {s: sum(len(t.split()) for i, t in text.items() if source[i] == s) for s in "ab"}
    for s, want in test_source_mix.targets(sizes).items():
        got = sum(sum(n) for i, n in taken.items() if source[i] == s)
        assert abs(got - want) <= 2 * 64 + 0.01 * want
    for i, n in taken.items():
        assert len(n) <= 3 and all(k <= len(text[i].split()) for k in n)
