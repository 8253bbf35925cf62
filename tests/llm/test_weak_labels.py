"""The classifier: held-out accuracy, accuracies found by expectation-maximisation, odd rows."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from dimweave.llm import common, weak_labels
from dimweave.llm.common import table, work_folder

SF_DIR = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


def test_posteriors_find_the_truth_behind_noisy_labellers():
    rng = np.random.default_rng(7)
    truth = rng.random(4000) < 0.3
    accuracy, coverage = [0.95, 0.9, 0.75, 0.7, 0.6], [0.3, 0.8, 0.9, 0.7, 0.9]
    votes = np.full((4000, 5), weak_labels.ABSTAIN)
    for j, (right, cast) in enumerate(zip(accuracy, coverage)):
        said = np.where(rng.random(4000) < right, truth, ~truth)
        votes[:, j] = np.where(rng.random(4000) < cast, said, weak_labels.ABSTAIN)
    found = weak_labels.posteriors(votes) > 0.5
    majority = ((votes == 1).sum(axis=1) - (votes == 0).sum(axis=1)) > 0
    assert (found == truth).mean() > 0.9
    assert (found == truth).mean() > (majority == truth).mean()


def test_held_out_labels(spark):
    docs, labels = table(spark, SF_DIR, "documents").select("doc_id", "text"), table(spark, SF_DIR, "labels")
    held = F.col("doc_id") % 4 == 0
    model = weak_labels.fit_model(docs, labels.where(~held), work_folder(spark, "test"))
    rows = weak_labels.score(docs, model).join(labels.where(held), "doc_id").collect()
    clean = [r.kept for r in rows if r.quality == 1 and r.toxic == 0]
    toxic = [r.kept for r in rows if r.quality == 1 and r.toxic == 1]
    poor = [r.kept for r in rows if r.quality == 0]
    assert np.mean(clean) > 0.98
    assert np.mean(toxic) < 0.2
    assert np.mean(poor) < 0.1


def test_sample_is_bounded_and_fits(spark):
    docs, labels = table(spark, SF_DIR, "documents").select("doc_id", "text"), table(spark, SF_DIR, "labels")
    rows = weak_labels.training_rows(docs, labels, work_folder(spark, "test"), 100)
    assert rows.count() == 100


def test_odd_rows(spark, tables):
    text = "Plain words that read like prose, one after the other. " * 5
    rows = [(1, None), (2, ""), (3, "worthless scum, you idiot " * 3), (4, "### *** %%% $$$ &&& " * 20), (5, text), (5, text), (None, text), (6, "w " * 60_000), (7, " | ; ")]
    docs = [(i, t, "en", "s", 0) for i, t in rows]
    folder = tables(
        documents=([(*d, "x") for d in docs], "doc_id long, text string, lang string, source string, n_chars long, kept string"),
        labels=([(3, 1, 1), (4, 0, 0), (5, 1, 0), (5, 1, 0), (None, 0, 1), (8, None, None), (2, None, 1)], LABELS),
    )
    found = weak_labels.op8_quality_classifier(spark, folder).collect()
    assert sorted((r.doc_id for r in found), key=str) == sorted((i for i, _ in rows), key=str)
    assert not any(r.kept for r in found if r.doc_id in (1, 2, 7))
    assert len({(r.low_quality, r.toxicity, r.kept) for r in found if r.doc_id == 5}) == 1


def test_without_labels_nothing_is_known_against_a_text(spark, tables):
    docs = [(1, "some words", "en", "s", 10), (2, None, "en", "s", None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    folder = tables(documents=(docs, schema), labels=([], LABELS))
    assert {r.doc_id: r.kept for r in weak_labels.op8_quality_classifier(spark, folder).collect()} == {1: True, 2: False}
    folder = tables(documents=([], schema), labels=([], LABELS))
    assert weak_labels.op8_quality_classifier(spark, folder).collect() == []


def test_training_rows_drop_what_earlier_stages_keep():
    assert common.per_worker("older", lambda: "large") == "large"
    batch = pa.RecordBatch.from_pydict({"text": ["some words", None], "quality": [1, None], "toxic": [0, 1]})
    (rows,) = weak_labels.feature_rows(iter([batch]))
    assert rows.num_rows == 2 and rows.column(0).to_pylist() == [1, None]
    assert common.per_worker("older", lambda: "made again") == "made again"
