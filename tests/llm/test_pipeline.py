"""The pipeline against plain versions of its stages, and the registry's contract."""

import random

import pytest
import sentencepiece

import __spark_entry__
import corpus_pipeline
from tests.llm import brute
from tests.llm.test_language_id import PARTS, sentence

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    pick = random.Random(11)
    langs = sorted(PARTS)
    rows = [(i, sentence(pick, langs[i % 3], pick.randrange(15, 90)), langs[i % 3]) for i in range(150)]
    shared = sentence(pick, "xx", 30)
    rows += [(200 + i, sentence(pick, "xx", 50) + " " + shared, "xx") for i in range(5)]
    rows += [(300 + i, rows[i][1], rows[i][2]) for i in range(10)]
    item = sentence(pick, "yy", 20)
    rows += [(400, item + " " + sentence(pick, "yy", 30), "yy"), (401, "12 34 ...", "xx"), (402, None, "xx"), (403, "привет другой язык " * 9, None)]
    path = tmp_path_factory.mktemp("tables")
    docs = [(i, t, g, "s", len(t or "")) for i, t, g in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, "never seen words stand here")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), docs, [(1, item), (2, "never seen words stand here")]


def test_stages_as_brute_force(spark, folder):
    path, docs, items = folder
    texts = {i: t for i, t, *_ in docs}
    given = spark.read.parquet(f"{path}/documents.parquet")

    kept = corpus_pipeline.language(spark, given, path)
    assert kept.columns == COLUMNS
    ids = {r.doc_id for r in kept.collect()}
    assert set(texts) - ids == {401, 402, 403}
    texts = {i: texts[i] for i in ids}

    one = corpus_pipeline.near_duplicates(spark, kept, path)
    assert one.columns == COLUMNS
    of = brute.components([(i, brute.simhash(t)) for i, t in texts.items()])
    ids = {r.doc_id for r in one.collect()}
    assert ids == set(of.values())
    texts = {i: texts[i] for i in ids}

    cut = corpus_pipeline.repeated_passages(spark, one, path)
    assert cut.columns == COLUMNS
    want = brute.substring_dedup(texts.items())
    rows = cut.collect()
    assert {r.doc_id for r in rows} == {i for i, (n, gone, _) in want.items() if not gone or gone < n}
    assert any(want[r.doc_id][1] for r in rows)
    for r in rows:
        assert (brute.sha(r.text) == want[r.doc_id][2]) if want[r.doc_id][1] else r.text == texts[r.doc_id]
        assert r.n_chars == len(r.text)
    texts = {r.doc_id: r.text for r in rows}

    clean = corpus_pipeline.contamination(spark, cut, path)
    assert clean.columns == COLUMNS
    judged = brute.contamination(texts.items(), items)
    ids = {r.doc_id for r in clean.collect()}
    assert ids == {i for i, v in judged.items() if not v[3]} and 400 not in ids

    library = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.public_tokenizers.path("piece_bpe_32k.model"))
    final = corpus_pipeline.tokens(spark, clean, path).collect()
    assert {r.doc_id for r in final} == ids
    assert all(list(r.ids) == library.encode(r.text) and r.same for r in final)


def test_run_writes_and_rereads_each_stage(spark, folder):
    path, docs, _ = folder
    out = corpus_pipeline.run(spark, path)
    assert {"doc_id", "text", "ids", "n_tokens", "same"} <= set(out.columns)
    assert 140 < out.count() < len(docs)


def test_stages_take_empty_tables(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, path).count() == 0


def test_registry_has_one_query_for_each_operator():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_stages_keep_columns_with_names_of_their_own(spark, folder):
    path, docs, _ = folder
    names = ["n_words", "N_removed", "kept_text", "removed_spans", "bits", "least", "component_id", "score", "contaminated", "n_hit", "_llm_key"]
    given = spark.read.parquet(f"{path}/documents.parquet").selectExpr("*", *[f"concat('{n}', doc_id) as {n}" for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, given, path)
        assert out.columns == given.columns, name
        rows = out.select("doc_id", *names).collect()
        assert rows and all(tuple(r)[1:] == tuple(f"{n}{r.doc_id}" for n in names) for r in rows), name
