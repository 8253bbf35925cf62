"""Hash-based history: change set, feed and snapshot on small cases."""

from collections import Counter
from datetime import datetime

import models
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dimweave import columns as C
from dimweave.functions import hashing
from dimweave.functions.versions import prepare_scd2
from dimweave.operators import apply, hash_scd2, joins
from dimweave.plans import load

LOAD = "2024-01-15 06:30:00"
NOW = datetime(2024, 1, 15, 6, 30)
OLD = datetime(2023, 1, 1)
KEYS = ["k1", "k2"]


def source(spark, rows):
    return spark.createDataFrame(rows, "k1 int, k2 string, a string, b int")


def target(spark, rows):
    """rows: k1, k2, a, b, is_current, version"""
    df = spark.createDataFrame(rows, "k1 int, k2 string, a string, b int, c boolean, v int")
    return (
        prepare_scd2(df, ["a", "b"], OLD)
        .withColumns({C.IS_CURRENT: F.col("c"), C.VERSION: F.col("v")})
        .drop("c", "v")
    )


ROWS = [
    (1, "x", "a", 1, True, 1),
    (1, "y", "a", 1, True, 3),
    (1, "y", "old", 1, False, 2),
    (2, "x", "a", None, True, 1),
    (3, "x", "gone", 1, False, 7),
    (4, "x", "unseen", 1, True, 1),
]
SOURCE = [
    (1, "x", "a", 1),  # same
    (1, "y", "A", 1),  # case is a change here
    (2, "x", "a", None),  # same
    (2, "y", "new", 1),  # new combination of known key parts
    (3, "x", "back", 1),  # history only
]


def test_changed_set(spark):
    changed = hash_scd2.scd2_hash_changed(
        source(spark, SOURCE), target(spark, ROWS), KEYS, ["a", "b"], LOAD
    )
    assert sorted((r.k1, r.k2, r.a) for r in changed.collect()) == [
        (1, "y", "A"), (2, "y", "new"), (3, "x", "back"),
    ]


def test_null_hash_of_a_current_row_is_a_change(spark):
    tgt = target(spark, ROWS[:1]).withColumn(C.ROW_HASH, F.lit(None).cast("string"))
    changed = hash_scd2.scd2_hash_changed(source(spark, SOURCE[:1]), tgt, KEYS, ["a", "b"], LOAD)
    assert changed.count() == 1


def test_other_hash_algorithm_finds_the_same_changes(spark):
    tgt = target(spark, ROWS).withColumn(C.ROW_HASH, hashing.row_hash(["a", "b"], hashing.XXH64))
    changed = hash_scd2.scd2_hash_changed(
        source(spark, SOURCE), tgt, KEYS, ["a", "b"], LOAD, hashing.XXH64
    )
    assert changed.count() == 3


def test_feed_expires_whole_keys_only(spark):
    """Key parts of the changed rows also occur in unchanged keys; those stay open."""
    tgt = target(spark, ROWS)
    changed = hash_scd2.scd2_hash_changed(source(spark, SOURCE), tgt, KEYS, ["a", "b"], LOAD)
    rows = hash_scd2.scd2_hash_feed(changed, tgt, KEYS, ["a", "b"], LOAD).collect()
    expires = [r for r in rows if r[C.MERGE_ACTION] == C.MERGE_EXPIRE]
    assert [(r.k1, r.k2, r.version, r.is_current, r.end_date, r.a, r.row_hash, r.effective_date)
            for r in expires] == [(1, "y", 3, False, NOW, None, None, None)]
    inserts = [r for r in rows if r[C.MERGE_ACTION] == C.MERGE_INSERT]
    assert sorted((r.k1, r.k2, r.version) for r in inserts) == [
        (1, "y", 4), (2, "y", 1), (3, "x", 8),
    ]
    assert {(r.effective_date, r.end_date, r.is_current) for r in inserts} == {(NOW, None, True)}


@pytest.mark.parametrize("staged", [False, True])
def test_snapshot(spark, tmp_path, staged):
    tgt = target(spark, ROWS)
    result = load.run_scd2_hash(
        source(spark, SOURCE), tgt, KEYS, ["a", "b"], LOAD,
        staged=staged, stage_dir=str(tmp_path),
    )
    snapshot = result.snapshot
    assert snapshot.columns == tgt.columns
    got = Counter((r.k1, r.k2, r.a, r.version, r.is_current, r.end_date) for r in snapshot.collect())
    assert got == Counter(
        [
            (1, "x", "a", 1, True, None),
            (1, "y", "a", 3, False, NOW),
            (1, "y", "old", 2, False, None),
            (1, "y", "A", 4, True, None),
            (2, "x", "a", 1, True, None),
            (2, "y", "new", 1, True, None),
            (3, "x", "gone", 7, False, None),
            (3, "x", "back", 8, True, None),
            (4, "x", "unseen", 1, True, None),
        ]
    )
    again = hash_scd2.scd2_hash_changed(source(spark, SOURCE), snapshot, KEYS, ["a", "b"], LOAD)
    assert again.count() == 0
    current = Counter((r.k1, r.k2) for r in joins.current_slice(snapshot, C.IS_CURRENT).collect())
    assert set(current.values()) == {1}


def test_two_current_rows_of_a_key_both_end(spark):
    rows = [(1, "x", "a", 1, True, 1), (1, "x", "b", 1, True, 2)]
    tgt = target(spark, rows)
    changed = hash_scd2.scd2_hash_changed(
        source(spark, [(1, "x", "c", 1)]), tgt, KEYS, ["a", "b"], LOAD
    ).limit(1)
    feed = hash_scd2.scd2_hash_feed(changed, tgt, KEYS, ["a", "b"], LOAD)
    snapshot = apply.apply_scd2_hash(tgt, feed, KEYS).collect()
    assert sorted((r.a, r.is_current, r.version) for r in snapshot) == [
        ("a", False, 1), ("b", False, 2), ("c", True, 3),
    ]


keys = st.one_of(st.none(), st.integers(0, 4))
cell = st.one_of(st.none(), st.sampled_from(["", "a", "A"]))


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(st.tuples(keys, cell), max_size=5, unique_by=lambda r: r[0]),
    st.lists(st.tuples(keys, cell, st.booleans()), max_size=8),
)
def test_snapshot_equals_model(spark, src_rows, tgt_rows):
    """Several current versions of a key, history only, and rows without a key included."""
    src = spark.createDataFrame(src_rows, "k int, a string")
    numbered = [(*r, i + 1) for i, r in enumerate(tgt_rows)]
    tgt = spark.createDataFrame(numbered, "k int, a string, c boolean, v int")
    tgt = prepare_scd2(tgt, ["a"], OLD).withColumns({C.IS_CURRENT: F.col("c"), C.VERSION: F.col("v")})
    tgt = tgt.drop("c", "v")
    got = load.run_scd2_hash(src, tgt, "k", ["a"], LOAD, staged=False).snapshot.collect()
    want = models.hash_history(src.collect(), tgt.collect(), "k", ["a"])
    assert Counter((r.k, r.a or "", r.version, r.is_current) for r in got) == Counter(want)
