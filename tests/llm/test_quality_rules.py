"""Quality rules against DuckDB's answer and hand cases."""

import random
from collections import Counter

import duckdb
import pytest
from compare import duck_side, spark_side
from hypothesis import given
from hypothesis import strategies as st

from dimweave.llm import quality_rules
from dimweave.llm.common import WordHashes


def plain(text):
    lines = [line.encode().split() for line in text.split("\n")]
    words = [w for own in lines for w in own]
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {i + d for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for d in (0, 1, 2)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            dups += line in seen
            seen.add(line)
    return len(words), len(b"".join(words).decode()), sum(text.count(c) for c in "#*$%&|<>"), dups, len(covered)


@given(st.text(alphabet="ab#é \n\t |", max_size=80))
def test_statistics(text):
    assert quality_rules.measure(text, WordHashes())[0] == plain(text)


def name(i):
    """A word without digits, which lines are compared without."""
    return "v" + "".join(chr(97 + int(d)) for d in str(i))


def sample(rng, footer="Read more on our site 1", n=400):
    words = [name(i) for i in range(4000)]
    rows = []
    for i in range(n):
        lines = [" ".join(rng.choices(words, k=12)) for _ in range(rng.randint(5, 9))]
        rows.append((i, "\n".join([*lines, footer.replace("1", str(i))]), "a.example"))
    for i in range(n, n + 40):  # almost nothing but the footer's kind of line
        rows.append((i, "\n".join([footer.replace("1", str(k)) for k in range(12)] + [f"only this is its own, {name(i)}"]), "a.example"))
    return rows


def run_both(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    left = spark_side(quality_rules.op4_quality_rules(spark, folder))
    right = duck_side(con, quality_rules.ORACLE_SQL)
    assert left[:2] == right[:2]
    assert left[2] == right[2]
    return left[2]


def test_boilerplate_and_depleted_documents(spark, documents):
    rows = sample(random.Random(2))
    rows += [(1000, None, None), (1001, "", "b"), (1002, "x " * 60, "b"), (1003, "word " * 3 + "y" * 100_000, None)]
    run_both(spark, documents(rows))
    found = {r.doc_id: r for r in quality_rules.op4_quality_rules(spark, documents(rows)).collect()}
    assert all(found[i].kept and found[i].n_removed_words == 6 for i in range(400))
    assert not any(found[i].kept for i in range(400, 440)) and found[400].n_removed_words == 72
    assert [found[i].base_failed for i in range(1000, 1004)] == [True] * 4


def test_copies_do_not_lose_their_own_lines(spark, documents):
    """Whole copies are one document; up to 30 documents may share lines besides."""
    text = "\n".join(" ".join(name(100 * i + j) for j in range(15)) for i in range(6))
    rows = [(i, text, "a") for i in range(200)] + [(500 + i, f"{text}\nand line number {name(i)}", "a") for i in range(29)]
    found = run_both(spark, documents(rows))
    assert len(found) == 229
    assert all(r.kept and not r.n_removed_words for r in quality_rules.op4_quality_rules(spark, documents(rows)).collect())


@pytest.mark.parametrize("own", [1, 6, 12, 40])
@pytest.mark.parametrize("shared", [20, 40])
def test_documents_that_share_many_lines_are_each_counted(spark, documents, shared, own):
    """Depleted documents: all but a line of their own is in 500 documents of the host."""
    rng = random.Random(3)
    same = [" ".join(name(100 * i + j) for j in range(12)) for i in range(shared)]
    rows = [(i, "\n".join([*same, " ".join([name(i), *(name(rng.randrange(10_000)) for _ in range(own - 1))])]), "a") for i in range(500)]
    found = quality_rules.op4_quality_rules(spark, documents(rows)).collect()
    assert all(r.n_removed_words == 12 * shared and not r.kept for r in found)


def test_hosts_with_frequent_lines_equal_sql(spark, documents):
    """Several shared lines, whole copies, documents of shared lines only, and hosts below the limits."""
    rng = random.Random(8)
    pool = [" ".join(name(100 * i + j) for j in range(12)) for i in range(12)]
    rows = []
    for i in range(300):
        lines = [*rng.sample(pool, rng.randint(2, 6)), *(" ".join(name(rng.randrange(10_000)) for _ in range(8)) for _ in range(rng.randint(0, 20)))]
        rows.append((i, "\n".join(rng.sample(lines, len(lines))), rng.choice(["a", "a", "b", None])))
    rows += [(1000 + i, rows[rng.randrange(40)][1], rng.choice(["a", "b"])) for i in range(200)]
    rows += [(2000 + i, "\n".join(pool[:6]), "c") for i in range(100)]
    run_both(spark, documents(rows))
    found = {r.doc_id: r for r in quality_rules.op4_quality_rules(spark, documents(rows)).collect()}
    assert any(r.n_removed_words for r in found.values()) and any(r.kept for r in found.values())
    assert all(found[2000 + i].kept for i in range(100))


def test_different_documents_of_shared_lines_only(spark, documents):
    pool = [" ".join(name(100 * i + j) for j in range(12)) for i in range(12)]
    rng = random.Random(4)
    rows = [(i, "\n".join(rng.sample(pool, 6)), "a") for i in range(300)]
    assert not any(r.kept for r in quality_rules.op4_quality_rules(spark, documents(rows)).collect())


def test_no_documents(spark, documents):
    assert quality_rules.op4_quality_rules(spark, documents([])).collect() == []


def test_clean_removes_lines_and_rejects(spark, tables, folder):
    rows = [(i, t, s, len(t), "extra") for i, t, s in sample(random.Random(2))] + [(None, None, "z", 5, "extra")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, kept string")
    out = quality_rules.clean(docs, folder)
    assert out.dtypes == docs.dtypes
    found = {r.doc_id: r for r in out.collect()}
    assert sorted(found) == list(range(400))
    for i, text, _, _, _ in rows[:400]:
        assert found[i].text == text.rsplit("\n", 1)[0]
        assert found[i].n_chars == len(found[i].text) and found[i].kept == "extra"


@pytest.mark.parametrize("columns", ["doc_id long, source string, text string, n_words string, removed long"])
def test_clashing_columns_are_replaced(spark, folder, columns):
    df = spark.createDataFrame([(1, "s", "a b", "old", 9)], columns)
    (row,) = quality_rules.apply_rules(df, folder).collect()
    assert row.n_words == 2 and not row.kept
