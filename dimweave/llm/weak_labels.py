"""Quality classifier: overlapping heuristic labellers, their accuracies by expectation-maximisation, and a hashed
linear scorer trained on the posterior labels."""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from dimweave.llm.common import column_of, forget, hide, per_worker, slices, table, trim, work_folder, written

#: Labelled documents the model is fitted on at most (those of smallest hash), and hashed features.
SAMPLE, FEATURES = 16_000, 1 << 20

#: Passes of expectation-maximisation and of the scorer's descent, its step and its penalty on weights.
EM_ROUNDS, ROUNDS, STEP, PENALTY = 50, 150, 0.3, 1e-4

#: Words whose features a task remembers while it makes training rows: as many as a small sample's texts share.
KNOWN = 50_000

#: First letters of a word that are features besides it: inflected words share them.
STEMS = (4, 5, 7)

#: Rows that must have a feature before it gets a weight, and how telling it must be.
SUPPORT, DEVIATION = 3, 4.0

#: A feature is a sign of toxic text if at least MINED labelled documents have it, and MINED_SHARE of them are toxic.
MINED, MINED_SHARE = 3, 0.95

#: A document is rejected when either scorer gives it more than this.
REJECT = 0.4

#: Words that insult in English; other languages' are mined from the labels.
INSULTS = frozenset("loser idiot pathetic scum worthless moron trash clown disgusting stupid".split())

BAD, GOOD, ABSTAIN = 1, 0, -1
SYMBOLS = "#*$%&|<>!?"
_WORD = re.compile(r"\w+")
_LOWER, _UPPER, _DIGIT = re.compile(r"[^\W\d_A-ZÀ-Þ]+"), re.compile(r"[A-ZÀ-Þ]+"), re.compile(r"\d+")
#: Shapes of words as prose has them, with the signs that may follow them.
PLAIN = frozenset(w + sign for w in ("x", "X", "Xx") for sign in ("", ".", ",", ";", ":"))


def shapes_of(text: str) -> Counter[str]:
    """How often a text's tokens have each shape: runs of capitals as X, of other letters as x, of digits as 0."""
    return Counter(_DIGIT.sub("0", _UPPER.sub("X", _LOWER.sub("x", text))).split())


def labels_of(text: str, words: list[str], distinct: set[str], shapes: Counter[str]) -> list[int]:
    """Votes on low quality (BAD) of the labellers that look at the text: symbols, capitals, repetition,
    variety, cells, prose; then that of the insults on toxic text."""
    n, tokens = len(words), max(1, shapes.total())
    if not n:
        return [ABSTAIN] * 7
    symbols = sum(map(text.count, SYMBOLS)) / n
    capitals = sum(k for s, k in shapes.items() if s[0] == "X" and "x" not in s) / tokens
    repeats = sum(map(eq, words, words[1:])) / n
    variety = len(distinct) / n
    cells = text.count(" | ") / n
    prose = sum(k for s, k in shapes.items() if s in PLAIN) / tokens
    return [
        BAD if symbols > 0.5 else GOOD if symbols < 0.1 else ABSTAIN,
        ABSTAIN if n < 3 else BAD if capitals > 0.6 else GOOD if capitals < 0.2 else ABSTAIN,
        ABSTAIN if n < 3 else BAD if repeats > 0.4 else GOOD if repeats < 0.1 else ABSTAIN,
        ABSTAIN if n < 50 else BAD if variety < 0.1 else GOOD if variety > 0.3 else ABSTAIN,
        BAD if cells > 0.2 else GOOD if cells < 0.02 else ABSTAIN,
        ABSTAIN if n < 20 else GOOD if prose > 0.8 and symbols < 0.1 else BAD if prose < 0.3 else ABSTAIN,
        BAD if not INSULTS.isdisjoint(distinct) else ABSTAIN,
    ]


def feature(name: str) -> int:
    return xxh3_64_intdigest(name.encode("utf-8", "replace")) % FEATURES


def word_names(word: str) -> list[str]:
    """Names of a word's features; the first is its own, others it shares."""
    return [f"w {word}", *[f"{n} {word[:n]}" for n in STEMS]]


class Memo(dict):
    """A function's values for the arguments met last; emptied at `limit`."""

    def __init__(self, value, limit: int = 250_000):
        super().__init__()
        self.value, self.limit = value, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        found = self[key] = self.value(key)
        return found


class Document:
    """What the model sees of a text: distinct words, distinct shapes of tokens, votes."""

    def __init__(self, text: str):
        words, shapes = _WORD.findall(text.lower()), shapes_of(text)
        self.words, self.shapes = set(words), shapes.keys()
        self.votes = labels_of(text, words, self.words, shapes)

    def style(self) -> list[str]:
        """Names of the features of its style."""
        return [*[f"s {x[:12]}" for x in self.shapes], *[f"v {i} {v}" for i, v in enumerate(self.votes[:-1])]]


def posteriors(votes: np.ndarray) -> np.ndarray:
    """Probability that each row is bad, from its labellers' votes (rows x labellers of BAD, GOOD, ABSTAIN).

    Given the truth, labellers vote independently, each with its own chances of the three votes for
    good and for bad rows; expectation-maximisation finds those chances and the share of bad rows. The
    first column is the hand-made labels: the start follows them where they vote, and a prior as heavy
    as all rows says that they err in 1 of 100. Others start as right more often than wrong.
    """
    n, m = votes.shape
    if not n:
        return np.empty(0)
    cast = np.stack([votes == v for v in (GOOD, BAD, ABSTAIN)], axis=2).astype(float)
    lean = (votes[:, 1:] == BAD).sum(axis=1) - (votes[:, 1:] == GOOD).sum(axis=1)
    known = votes[:, 0] != ABSTAIN
    bad = np.where(np.where(known, votes[:, 0] == BAD, lean > 0), 0.95, 0.05)
    prior = np.full((2, m, 3), 0.1)
    share_known = known.mean()
    prior[0, 0] += n * np.array([0.99 * share_known, 0.01 * share_known, 1 - share_known])
    prior[1, 0] += n * np.array([0.01 * share_known, 0.99 * share_known, 1 - share_known])
    for _ in range(EM_ROUNDS):
        share = np.clip(bad.mean(), 1e-6, 1 - 1e-6)
        chances = []
        for weight, before in zip((1 - bad, bad), prior):
            counts = np.einsum("i,ijv->jv", weight, cast) + before
            chances.append(np.log(counts / counts.sum(axis=1, keepdims=True)))
        odds = np.log(share / (1 - share)) + np.einsum("ijv,jv->i", cast, chances[1] - chances[0])
        bad = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return bad


def sums(rows: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """For each feature the summed weights of the rows that have it, some rows at a time."""
    total = np.zeros(FEATURES)
    for at in range(0, len(rows), 500):
        part = rows[at : at + 500]
        each = np.repeat(weights[at : at + 500], [len(x) for x in part]).astype(float)
        total += np.bincount(np.concatenate(part), weights=each, minlength=FEATURES)
    return total


def fit_linear(rows: list[np.ndarray], truth: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic scorer of rows with these present features.

    Full-batch descent with a step of each weight's own (AdaGrad), over the features that SUPPORT rows
    have and whose share of bad rows is DEVIATION standard deviations off the usual one.
    """
    n = len(rows)
    weights, bias = np.zeros(FEATURES), 0.0
    if not n:
        return weights, bias
    share = np.clip(truth.mean(), 0.01, 0.99)
    seen = sums(rows, np.ones(n))
    excess = sums(rows, truth) - share * seen
    telling = np.flatnonzero((seen >= SUPPORT) & (np.abs(excess) > DEVIATION * np.sqrt(seen * share * (1 - share))))
    place = np.full(FEATURES, -1, np.int32)
    place[telling] = np.arange(len(telling))
    found = [p[p >= 0] for p in (place[x] for x in rows)]
    ids, row = np.concatenate(found), np.repeat(np.arange(n, dtype=np.int32), [len(x) for x in found])
    own = np.zeros(len(telling))
    squares, bias_square = np.full(len(telling), 1e-8), 1e-8
    for _ in range(ROUNDS):
        z = bias + np.bincount(row, weights=own[ids], minlength=n)
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - truth) / n
        slope = np.bincount(ids, weights=error[row], minlength=len(telling)) + PENALTY * own
        squares += slope**2
        own -= STEP * slope / np.sqrt(squares)
        bias_square += error.sum() ** 2
        bias -= STEP * error.sum() / np.sqrt(bias_square)
    weights[telling] = own
    return weights, float(bias)


def fit(
    words: list[np.ndarray], style: list[np.ndarray], votes: np.ndarray, quality: np.ndarray, toxic: np.ndarray
) -> tuple[tuple[np.ndarray, float], tuple[np.ndarray, float]]:
    """The scorers of low quality (by style) and of toxic text (by words).

    quality and toxic are the labels (1, 0, or -1: unknown). They vote like the other labellers do, and
    so does the presence of words that are mined as signs of toxic text.
    """
    of_toxic = sums(words, toxic == 1)
    mined = (of_toxic >= MINED) & (of_toxic >= MINED_SHARE * sums(words, toxic >= 0))
    hits = np.array([mined[x].sum() for x in words])
    signs = np.where(hits > 2, BAD, np.where(hits == 0, GOOD, ABSTAIN))
    poor = posteriors(np.column_stack([np.where(quality < 0, ABSTAIN, 1 - quality), votes[:, :-1]]))
    hurt = posteriors(np.column_stack([np.where(toxic < 0, ABSTAIN, toxic), votes[:, -1], signs]))
    return fit_linear(style, poor), fit_linear(words, hurt)


FEATURE_ROWS = "quality long, toxic long, words binary, style binary, votes array<int>"


def feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """FEATURE_ROWS of labelled texts. What earlier stages keep in the worker goes first, the memo at the end."""
    forget()
    memo = Memo(lambda w: np.array([feature(x) for x in word_names(w)], np.uint32).tobytes(), KNOWN)
    for batch in slices(batches, "text"):
        words, style, votes = [], [], []
        for text in column_of(batch, "text").to_pylist():
            found = Document(text or "")
            words.append(b"".join([memo[w] for w in found.words]))
            style.append(np.array([feature(x) for x in found.style()], np.uint32).tobytes())
            votes.append(found.votes)
        yield pa.RecordBatch.from_arrays(
            [
                column_of(batch, "quality"),
                column_of(batch, "toxic"),
                pa.array(words, pa.binary()),
                pa.array(style, pa.binary()),
                pa.array(votes, pa.list_(pa.int32())),
            ],
            ["quality", "toxic", "words", "style", "votes"],
        )
    batch = words = style = votes = memo = None
    trim()


def training_rows(df: DataFrame, labels: DataFrame, folder: str, sample: int) -> DataFrame:
    """Features, votes and labels of at most `sample` labelled documents, those of smallest hash.

    A document labelled twice counts with its worse labels, a doc_id that many rows have with one text.
    """
    picked = (
        labels.where("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").cast("long").alias("quality"), F.max("toxic").cast("long").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    picked = written(picked, f"{folder}/picked")
    rows = df.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # `sample` rows of three numbers
    labelled = [F.first(c).alias(c) for c in ("quality", "toxic")]
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), *labelled)

    return written(rows.mapInArrow(feature_rows, FEATURE_ROWS), f"{folder}/training")


Model = list[tuple[float, dict[int, float]]]


def fit_model(df: DataFrame, labels: DataFrame, folder: str, sample: int = SAMPLE) -> Model:
    """Bias and weights (by feature) of the scorers of low quality and of toxic text.

    The sample is the only thing that meets in one task; its bound is `sample`. Without labelled
    documents all weights are 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        words, style, votes, quality, toxic = [], [], [], [], []
        for batch in batches:
            words += [np.frombuffer(x, np.uint32) for x in column_of(batch, "words").to_pylist()]
            style += [np.frombuffer(x, np.uint32) for x in column_of(batch, "style").to_pylist()]
            votes += column_of(batch, "votes").to_pylist()
            quality += column_of(batch, "quality").fill_null(-1).to_pylist()
            toxic += column_of(batch, "toxic").fill_null(-1).to_pylist()
        if not votes:
            return
        fitted = fit(words, style, np.array(votes), np.array(quality), np.array(toxic))
        for scorer, (weights, bias) in enumerate(fitted):
            ids = np.flatnonzero(weights)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([scorer] * (len(ids) + 1), pa.int64()),
                    pa.array([-1, *ids.tolist()], pa.int64()),
                    pa.array([bias, *weights[ids].tolist()], pa.float64()),
                ],
                ["scorer", "feature", "weight"],
            )
        words = style = None
        trim()

    rows = training_rows(df, labels, folder, sample)
    fitted = rows.coalesce(1).mapInArrow(run, "scorer long, feature long, weight double")
    found = fitted.collect()  # 2 * FEATURES at most
    model: Model = [(0.0, {}), (0.0, {})]
    for scorer in (0, 1):
        weights = {r.feature: r.weight for r in found if r.scorer == scorer}
        model[scorer] = (weights.pop(-1, 0.0), weights)
    return model


def score(df: DataFrame, model: Model, text: str = "text", reject: float = REJECT) -> DataFrame:
    """Add low_quality and toxicity (0 to 1) and kept: neither is above `reject`, and the text has a word.

    Each row is judged by itself over its whole text. Null and empty texts are not kept, repeated rows
    are judged alike, columns with the name of a result are replaced.
    """
    number = uuid.uuid4().hex
    shared = df.sparkSession.sparkContext.broadcast(model)  # features with a weight, FEATURES of each scorer at most
    others = hide(df, "low_quality", "toxicity", "kept").schema
    rest = others.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (bias, style), (toxic_bias, toxic) = shared.value
        fitted = bool(bias or style or toxic_bias or toxic)  # if not, nothing is known against a text
        styles = Memo(lambda name: style.get(feature(name), 0.0))

        def scores() -> Memo:
            """Weights of words; stems, which many words share, have a memo of their own."""
            stems = Memo(lambda name: toxic.get(feature(name), 0.0))

            def weigh(word: str) -> float:
                own, *names = word_names(word)
                return toxic.get(feature(own), 0.0) + sum([stems[n] for n in names])

            return Memo(weigh)

        memo = per_worker("weights", scores, number)
        for batch in slices(batches, text):
            rows = []
            for value in column_of(batch, text).to_pylist():
                found = Document(value or "")
                rows.append((
                    bias + sum([styles[n] for n in found.style()]),
                    toxic_bias + sum(map(memo.__getitem__, found.words)),
                    bool(found.words),
                ))
            poor, hurt, some = (np.array(x) for x in zip(*rows))
            poor, hurt = (1 / (1 + np.exp(-np.clip(x, -30, 30))) for x in (poor, hurt))
            kept = some & ((poor <= reject) & (hurt <= reject) if fitted else True)
            yield pa.RecordBatch.from_arrays(
                [*(column_of(batch, c) for c in rest), pa.array(poor), pa.array(hurt), pa.array(kept, pa.bool_())],
                [*rest, "low_quality", "toxicity", "kept"],
            )
        trim()

    held = [f"`{f.name}` {f.dataType.simpleString()}" for f in others]
    schema = ", ".join([*held, "low_quality double, toxicity double, kept boolean"])
    return df.mapInArrow(run, schema)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores and verdict for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_model(docs, table(spark, sf_dir, "labels"), work_folder(spark, "classifier"))
    return score(docs, model).drop("text")
