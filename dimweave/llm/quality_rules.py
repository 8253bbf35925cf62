"""Quality rules: statistics of each document, and lines that too many documents of a host share."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from dimweave.llm.common import WordHashes, column_of, hide, per_worker, slices, small, table, trim, windows, work_folder, written

#: Characters that prose hardly has.
SYMBOLS = re.compile(r"[#*$%&|<>]")

#: Words, less than which is no document; share of words in repeated windows, in percent, that is too much.
MIN_WORDS, MAX_REPEATED = 50, 50

#: A line is boilerplate of its host when more than LINE_DOCS documents and 1 in LINE_SHARE have it.
LINE_DOCS, LINE_SHARE = 30, 200

#: A document is depleted when less than this share of its words, in percent, remains.
MIN_REMAINING = 20

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_DIGITS = re.compile(rb"[0-9]+")


def line_key(words: list[bytes]) -> bytes:
    """The normal form of a line: A-Z lower, runs of digits as 0, one space between words."""
    return _DIGITS.sub(b"0", b" ".join(words).lower())


def line_hash(key: bytes) -> int:
    """The first 60 bits of MD5, which SQL can name as well: 15 hex digits."""
    return int.from_bytes(hashlib.md5(key, usedforsecurity=False).digest()[:8], "big") >> 4


def repeated_words(hashes: np.ndarray, width: int = 3) -> int:
    """Words that lie in a window of `width` words found at least twice."""
    grams = windows(hashes, width)
    if not len(grams):
        return 0
    order = np.argsort(grams, kind="stable")
    same = np.diff(grams[order].view(np.int64)) == 0
    twice = np.zeros(len(grams), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(hashes) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + width, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def measure(text: str, hashes: WordHashes) -> tuple[tuple[int, ...], dict[int, int]]:
    """The statistics of a text, and the words of its lines by the hash of the line's normal form.

    A line that repeats inside the document counts all its words, and the document once.
    """
    lines = [(line, line.split()) for line in text.encode("utf-8", "replace").split(b"\n")]
    words = [w for _, own in lines for w in own]
    seen: set[bytes] = set()
    repeats, by_line = 0, {}
    for line, own in lines:
        if not own:
            continue
        repeats += line in seen
        seen.add(line)
        key = line_hash(line_key(own))
        by_line[key] = by_line.get(key, 0) + len(own)
    chars = len(b"".join(words).decode("utf-8"))
    stats = (len(words), chars, len(SYMBOLS.findall(text)), repeats, repeated_words(hashes.of(words)))
    return stats, by_line


def copy_hash(lines: dict[int, int]) -> int:
    """A hash of all of a document's lines in normal form: only documents of the same lines share it."""
    return line_hash(b"".join(key.to_bytes(8, "big") for key in sorted(lines)))


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Other columns of `df` with the statistics, `_copy` and `_lines`: (hash, words) of each distinct line."""
    lines = StructType([StructField(n, LongType()) for n in ("hash", "words")])
    others = hide(df, text, *STATS, "_copy", "_lines").schema
    rest = others.names
    numbers = [StructField(n, LongType()) for n in (*STATS, "_copy")]
    schema = StructType([*others.fields, *numbers, StructField("_lines", ArrayType(lines))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = per_worker("hashes", WordHashes)
        for batch in slices(batches, text):
            found = [measure(t or "", hashes) for t in column_of(batch, text).to_pylist()]
            ends = np.cumsum([0, *(len(x) for _, x in found)]).astype(np.int32)
            flat = pa.StructArray.from_arrays(
                [
                    pa.array([k for _, x in found for k in x], pa.int64()),
                    pa.array([n for _, x in found for n in x.values()], pa.int64()),
                ],
                ["hash", "words"],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *(column_of(batch, c) for c in rest),
                    *(pa.array([s[i] for s, _ in found], pa.int64()) for i in range(len(STATS))),
                    pa.array([copy_hash(x) for _, x in found], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), flat),
                ],
                [*rest, *STATS, "_copy", "_lines"],
            )
        trim()

    return df.mapInArrow(run, schema)


def frequent_lines(measured: DataFrame, host: str, line_docs: int, line_share: int) -> DataFrame:
    """(host, hash) of the lines that more documents of the host have than the limits allow.

    Counted are distinct documents, those with the line and those of the host alike. Documents of the
    very same lines (see copy_hash) are one document, so that a text which is often copied whole does not
    lose its own lines; documents that differ in any line count each, however many lines they share.
    """
    named = F.col(f"`{host}`").alias("_host")
    docs = measured.select(named, "_copy").distinct().groupBy("_host").agg(F.count(F.lit(1)).alias("n_docs"))
    each = measured.select(named, "_copy", F.explode("_lines").alias("l")).select("_host", "l.hash", "_copy")
    counted = each.distinct().groupBy("_host", "hash").agg(F.count(F.lit(1)).alias("n"))
    over = counted.where(F.col("n") > line_docs).alias("c")
    return (
        over.join(docs.alias("d"), F.col("c._host").eqNullSafe(F.col("d._host")))
        .where(F.col("n") * line_share > F.col("n_docs"))
        .select("c._host", "hash")
    )


def judge(
    measured: DataFrame, folder: str, host: str, line_docs: int, line_share: int, min_remaining: int
) -> DataFrame:
    """Rows of statistics() with n_removed_words, removed (hashes of lines above the limits), base_failed, kept."""
    lines = written(frequent_lines(measured, host, line_docs, line_share), f"{folder}/lines")
    own = measured.select("_row", F.col(f"`{host}`").alias("_host"), F.explode("_lines").alias("l")).alias("o")
    same = (F.col("o.l.hash") == F.col("f.hash")) & F.col("o._host").eqNullSafe(F.col("f._host"))
    removed = own.join(small(lines).alias("f"), same).groupBy("_row")
    removed = removed.agg(F.sum("o.l.words").alias("n_removed_words"), F.collect_list("o.l.hash").alias("removed"))
    few = F.col("n_words") < MIN_WORDS
    base = few | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    remaining = F.col("n_words") - F.col("n_removed_words")
    return (
        measured.drop("_lines", "_copy")
        .join(removed, "_row", "left")
        .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0).cast("long")))
        .withColumn("base_failed", base)
        .withColumn("kept", ~F.col("base_failed") & (100 * remaining >= min_remaining * F.col("n_words")))
    )


RESULTS = (*STATS, "_copy", "_lines", "_row", "n_removed_words", "removed", "base_failed", "kept")


def apply_rules(
    df: DataFrame,
    folder: str,
    host: str = "source",
    text: str = "text",
    line_docs: int = LINE_DOCS,
    line_share: int = LINE_SHARE,
    min_remaining: int = MIN_REMAINING,
) -> DataFrame:
    """Rows of `df` (without `text`) with statistics, n_removed_words, base_failed and kept.

    base_failed: fewer than MIN_WORDS words, or over MAX_REPEATED % of them in 3-word windows that
    repeat. A document is depleted when lines above the limits (see frequent_lines) hold all but
    min_remaining % of its words; kept is false for it and for those that failed.

    A null text has no words and fails; a null host is a host of its own; repeated rows get equal
    results; columns with the name of a result are replaced. The measures are written to `folder`
    once. Shuffled are hashes only; the count of a line that a third of all documents have is summed
    in each task first, and the join back to such lines can be split by adaptive execution.
    """
    measured = statistics(hide(df, *RESULTS), text).withColumn("_row", F.monotonically_increasing_id())
    measured = written(measured, f"{folder}/measured")
    return judge(measured, folder, host, line_docs, line_share, min_remaining).drop("_row", "removed")


def without_lines(text: str, removed: set[int]) -> str:
    """A text without the lines whose normal form has one of these hashes."""

    def stays(line: str) -> bool:
        words = line.encode("utf-8", "replace").split()
        return not words or line_hash(line_key(words)) not in removed

    return "\n".join(filter(stays, text.split("\n")))


def clean(
    df: DataFrame,
    folder: str,
    line_docs: int = LINE_DOCS,
    line_share: int = LINE_SHARE,
    min_remaining: int = MIN_REMAINING,
) -> DataFrame:
    """The rows of `df` (doc_id, text, source, ...) that are kept, without lines above the limits.

    Columns are those of `df`; n_chars, if it is one, follows the text. The rows are written to `folder`
    with a number each, by which verdicts find them again.
    """
    names = [f"_{i}" for i in range(len(df.columns))]
    at = dict(zip(df.columns, names))
    rows = written(df.toDF(*names).withColumn("_row", F.monotonically_increasing_id()), f"{folder}/rows")
    measured = statistics(rows.select("_row", F.col(at["source"]).alias("source"), at["text"]), at["text"])
    measured = written(measured, f"{folder}/measured")
    judged = judge(measured, folder, "source", line_docs, line_share, min_remaining)
    bad = small(written(judged.where(~F.col("kept")).select("_row"), f"{folder}/bad"))
    less = judged.where(F.col("kept") & F.col("removed").isNotNull()).select("_row", "removed")
    less = small(written(less, f"{folder}/less"))
    kept = rows.join(bad, "_row", "left_anti").join(less, "_row", "left").drop("_row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at["text"]):
            pairs = zip(column_of(batch, at["text"]).to_pylist(), column_of(batch, "removed").to_pylist())
            texts = pa.array([t if r is None else without_lines(t, set(r)) for t, r in pairs], pa.string())
            yield pa.RecordBatch.from_arrays([texts if c == at["text"] else column_of(batch, c) for c in names], names)

    cleaned = kept.mapInArrow(run, StructType([kept.schema[c] for c in names]))
    if "n_chars" in at:
        kind = kept.schema[at["n_chars"]].dataType
        cleaned = cleaned.withColumn(at["n_chars"], F.length(at["text"]).cast(kind))
    return cleaned.toDF(*df.columns)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return apply_rules(docs, work_folder(spark, "rules")).drop("source")


#: The same in DuckDB, with whole MD5 values for hashes.
ORACLE_SQL = """
WITH words AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), placed AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words
), grams AS (
  SELECT a.doc_id, a.i, a.word AS x, b.word AS y, c.word AS z
  FROM placed a JOIN placed b ON a.doc_id = b.doc_id AND b.i = a.i + 1
  JOIN placed c ON a.doc_id = c.doc_id AND c.i = a.i + 2
), twice AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, x, y, z) AS n FROM grams) WHERE n > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT i + d) AS n_repeat_words
  FROM twice, (SELECT unnest([0, 1, 2]) AS d) GROUP BY doc_id
), raw_lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM words
), lines AS (
  SELECT doc_id, source, line, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS w FROM raw_lines
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
), dups AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY doc_id
), keyed AS (
  SELECT doc_id, source, sum(len(w)) AS words,
         md5(regexp_replace(translate(array_to_string(w, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '0', 'g')) AS h
  FROM lines GROUP BY ALL
), hashed AS (SELECT doc_id, source, h, sum(words) AS words FROM keyed GROUP BY ALL
), sets AS (SELECT doc_id, md5(string_agg(h, '' ORDER BY h)) AS lineset FROM hashed GROUP BY doc_id
), seen AS (
  SELECT source, h, count(DISTINCT lineset) AS n FROM hashed JOIN sets USING (doc_id) GROUP BY ALL
), hosts AS (
  SELECT source, count(DISTINCT coalesce(lineset, '')) AS n_docs FROM documents LEFT JOIN sets USING (doc_id) GROUP BY source
), removed AS (
  SELECT doc_id, sum(words) AS n_removed_words
  FROM hashed a JOIN seen b ON a.h = b.h AND a.source IS NOT DISTINCT FROM b.source
  JOIN hosts c ON a.source IS NOT DISTINCT FROM c.source
  WHERE n > {line_docs} AND n * {line_share} > n_docs GROUP BY doc_id
), counted AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_removed_words, 0) AS n_removed_words
  FROM words LEFT JOIN dups USING (doc_id) LEFT JOIN repeated USING (doc_id) LEFT JOIN removed USING (doc_id)
), judged AS (
  SELECT *, n_words < {min_words} OR 100 * n_repeat_words > {max_repeated} * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_removed_words::BIGINT AS n_removed_words, base_failed,
       NOT base_failed AND 100 * (n_words - n_removed_words) >= {min_remaining} * n_words AS kept
FROM judged
""".format(
    line_docs=LINE_DOCS, line_share=LINE_SHARE, min_words=MIN_WORDS, max_repeated=MAX_REPEATED, min_remaining=MIN_REMAINING
)
