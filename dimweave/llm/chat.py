"""Chat formatting: reply trees to root-to-leaf paths, the best branches of each tree, one text per path."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimweave.llm.common import column_of, table, work_folder, written

#: A turn is START role SEPARATOR text END; inside role and text the strings of CONTROL are escaped.
START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = (START, SEPARATOR, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ESCAPE = "\\"

_CONTROL = re.compile("|".join(re.escape(c) for c in sorted(CONTROL, key=len, reverse=True)))
_ESCAPED = re.compile(r"\\(\\?)")


def escape(text: str) -> str:
    """Double each backslash, then part the first character of each control string from its rest by one.

    What remains contains no control string: none has a backslash, so neither step can make one, and a
    pass finds all, as `<<SYS>>` and `<</SYS>>` are the only ones in which another could begin.
    """
    text = text.replace(ESCAPE, ESCAPE * 2)
    return _CONTROL.sub(lambda m: f"{m[0][0]}{ESCAPE}{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: Sequence[tuple[str, str]], learned: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and where (code points, end excluded) the loss mask lies in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{SEPARATOR}", escape(text)
        if role == learned:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += head, body, END
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns = []
    for turn in formatted.split(START)[1:]:
        role, text = turn[: -len(END)].split(SEPARATOR)
        turns.append((unescape(role), unescape(text)))
    return turns


def best_paths(
    messages: DataFrame, folder: str, score: Column | None = None, branches: int | None = None
) -> DataFrame:
    """(leaf, node, place) of the best `branches` (all, if None) root-to-leaf paths of each tree.

    `messages` has tree, node (any types; node unique in the whole table) and parent (null: a root).
    Branches rank by mean score of their messages, then length, then node of the leaf.

    Self-joins by pointer doubling: round k joins each node that has one 2**k above it with that one, so
    paths of n messages take log2(n) rounds on columns of ids, and short ones drop out early. The rounds'
    tables are written, which ends their lineage; expanding the chosen leaves replays them, and its size
    is that of the chosen paths. A parent that is missing makes its child a root; nodes on or under a
    cycle reach no root and belong to no path.
    """
    value = F.lit(0.0) if score is None else score.cast("double")
    nodes = written(messages.select("tree", "node", "parent", value.alias("total")), f"{folder}/nodes")
    known = nodes.select(F.col("node").alias("known"))
    state = nodes.join(known, F.col("parent") == F.col("known"), "left").select(
        "node", F.col("known").alias("up"), "total", F.lit(1).cast("long").alias("depth")
    )
    state = reached = written(state, f"{folder}/up0")
    ups, most, done = [], nodes.count(), []
    while (under := reached.where("up IS NOT NULL")).limit(1).count() and 1 << len(ups) <= most:
        ups.append(under.select("node", "up"))
        done.append(reached.where("up IS NULL"))
        above = state.select(
            F.col("node").alias("at"), F.col("up").alias("next"), F.col("total").alias("t"), F.col("depth").alias("d")
        )
        reached = under.join(above, F.col("up") == F.col("at")).select(
            "node",
            F.col("next").alias("up"),
            (F.col("total") + F.col("t")).alias("total"),
            (F.col("depth") + F.col("d")).alias("depth"),
        )
        reached = state = written(reached, f"{folder}/up{len(ups)}")
        for rooted in done:
            state = state.unionByName(rooted)
    parents = nodes.where("parent IS NOT NULL").select(F.col("parent").alias("node")).distinct()
    leaves = state.where("up IS NULL").join(parents, "node", "left_anti").drop("up")
    if branches is not None:
        rank = Window.partitionBy("tree").orderBy(F.desc(F.col("total") / F.col("depth")), F.desc("depth"), "node")
        leaves = leaves.join(nodes.select("node", "tree"), "node").withColumn("rank", F.row_number().over(rank))
        leaves = leaves.where(F.col("rank") <= branches)
    path = leaves.select(F.col("node").alias("leaf"), "node", "depth", F.lit(0).cast("long").alias("above"))
    for k, up in enumerate(ups):
        path = written(path, f"{folder}/path{k}")
        further = path.join(up, "node").select(
            "leaf", F.col("up").alias("node"), "depth", (F.col("above") + (1 << k)).alias("above")
        )
        path = path.unionByName(further)
    return path.select("leaf", "node", (F.col("depth") - F.col("above")).alias("place"))


def format_paths(messages: DataFrame, paths: DataFrame, learned: str = "assistant") -> DataFrame:
    """(tree, leaf, formatted, loss): one row per path; loss lists the spans of `learned` texts.

    `messages` also has role and text, of which null is empty. A conversation becomes one string, so it
    meets in one task; that row is the only thing whose size follows a conversation's length.
    """
    turn = F.struct("place", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = (
        paths.join(messages.select("tree", "node", "role", "text"), "node")
        .groupBy("leaf")
        .agg(F.first("tree").alias("tree"), F.sort_array(F.collect_list(turn)).alias("turns"))
        .select("tree", "leaf", "turns.role", "turns.text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                turns = zip(column_of(part, "role").to_pylist(), column_of(part, "text").to_pylist())
                done = [render(list(zip(r, t)), learned) for r, t in turns]
                spans = [[{"start": a, "end": b} for a, b in s] for _, s in done]
                yield pa.RecordBatch.from_arrays(
                    [
                        column_of(part, "tree"),
                        column_of(part, "leaf"),
                        pa.array([f for f, _ in done], pa.string()),
                        pa.array(spans, span),
                    ],
                    ["tree", "leaf", "formatted", "loss"],
                )

    kinds = dict(whole.dtypes)
    schema = f"tree {kinds['tree']}, leaf {kinds['leaf']}, formatted string, loss array<struct<start: long, end: long>>"
    return whole.mapInArrow(run, schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """(tree, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) read from formatted texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(column_of(batch, "formatted"), column_of(batch, "loss")):
                text, spans = text.as_py(), spans.as_py()
                turns = parse(text)
                whole = hashlib.sha256()
                for role, said in turns:
                    whole.update(f"{role}\n{said}\n".encode())
                loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
                learned = hashlib.sha256(loss.encode()).hexdigest()
                rows.append((len(turns), whole.hexdigest(), len(loss), learned, len(text)))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "tree"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["tree", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    kind = dict(formatted.dtypes)["tree"]
    digests = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.mapInArrow(run, f"tree {kind}, {digests}")


def linear_trees(rows: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as reply trees in which each row answers the one before.

    Rows of equal turn follow in order of role and text; repeated rows are turns of their own; rows
    without conv_id form one conversation.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = rows.withColumn("place", F.row_number().over(order))
    node = F.struct("conv_id", "place")
    before = F.struct("conv_id", (F.col("place") - 1).alias("place"))
    return placed.select(
        F.col("conv_id").alias("tree"),
        node.alias("node"),
        F.when(F.col("place") > 1, before).alias("parent"),
        "role",
        "text",
    )


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one whose texts are control strings, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    folder = work_folder(spark, "chat")
    messages = written(linear_trees(rows.unionByName(planted)), f"{folder}/messages")
    formatted = format_paths(messages, best_paths(messages, folder, branches=1))
    return read_back(formatted).withColumnRenamed("tree", "conv_id")
