"""The pipeline's stages, each against a brute-force reading of its own input."""

import random

import pytest
from test_ngram_join import brute

import corpus_pipeline
from dimweave.llm import quality_rules, weak_labels
from dimweave.llm.common import WordHashes, table, work_folder, written

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into each stage and what comes out at the end."""
    folder, docs = work_folder(spark, "test"), table(spark, SF_DIR, "documents")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF_DIR), f"{folder}/{name}")
        frames.append(docs)
    return frames


def test_stages_keep_the_columns_of_documents(stages):
    assert all(f.dtypes == stages[0].dtypes for f in stages[:-1])
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "quality_rules", "ngram_jaccard_join", "mixing_to_weights", "byte_level_bpe",
    ]


def test_classifier_drops_what_it_rejects(spark, stages):
    labels = table(spark, SF_DIR, "labels")
    model = weak_labels.fit_model(stages[0].select("doc_id", "text"), labels, work_folder(spark, "test"))
    kept = {r.doc_id for r in weak_labels.score(stages[0], model).where("kept").collect()}
    assert {tuple(r) for r in stages[1].collect()} == {tuple(r) for r in stages[0].collect() if r.doc_id in kept}


def test_rules_drop_failed_documents(stages):
    before, after = {r.doc_id: r for r in stages[1].collect()}, {r.doc_id: r for r in stages[2].collect()}
    for doc, row in before.items():
        n, _, _, _, repeated = quality_rules.measure(row.text, WordHashes())[0]
        if n < 50 or 100 * repeated > 50 * n:
            assert doc not in after
        elif doc in after:
            lines = iter(row.text.split("\n"))
            assert all(line in lines for line in after[doc].text.split("\n"))  # some lines may have gone
            assert after[doc].n_chars == len(after[doc].text)


def test_one_of_each_group_stays(stages):
    found = brute([(r.doc_id, r.text) for r in stages[2].collect()])
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted({c for _, _, c in found})


def test_mix_repeats_whole_documents(stages):
    before = {r.doc_id: tuple(r) for r in stages[3].collect()}
    times = {}
    for r in stages[4].collect():
        assert tuple(r) == before[r.doc_id]
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert set(times.values()) <= {1, 2}
    words = {k: len(v[1].split()) for k, v in before.items()}
    assert sum(words[k] * n for k, n in times.items()) == pytest.approx(1.5 * sum(words.values()), rel=0.1)


def test_every_copy_is_encoded(stages):
    assert sorted(r.doc_id for r in stages[5].collect()) == sorted(r.doc_id for r in stages[4].collect())


def test_repeated_and_missing_ids(spark, tables):
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(80)) for _ in range(5)]
    rows = [(1, texts[0], "a", 9), (1, texts[0], "a", 9), (None, texts[1], None, 9), (None, texts[2], "b", 9), (2, texts[2] + " more", "b", 9), (2, texts[3], "a", 9), (None, None, None, 9)]
    folder = tables(documents=(rows, "doc_id long, text string, source string, key int"))
    docs = table(spark, folder, "documents")
    out = corpus_pipeline.near_duplicates(spark, docs, folder)
    assert out.dtypes == docs.dtypes
    kept = sorted((r.text or "").split(" ")[0] for r in out.collect())
    assert kept == sorted([*(t.split(" ")[0] for t in texts[:4]), ""])


def test_empty_tables(spark, tables):
    folder = tables(
        documents=([], "doc_id long, text string, lang string, source string, n_chars long"),
        labels=([], "doc_id long, quality int, toxic int"),
    )
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_a_task_of_the_last_stage_has_one_python_worker(spark, documents):
    """Encoding and decoding in one stage would keep a second worker per core in memory for the rest of the run."""
    sf_dir = documents([(1, "some words of a text", "a"), (2, None, "b")])
    encoded = corpus_pipeline.byte_level_bpe(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)
    assert encoded._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted(r.n_tokens for r in encoded.collect()) == [0, 5]
