"""Prefix trie of conversations by fixed-length block hashing.

A conversation is cut into blocks of BLOCK turns. Conversations are grouped by the digests of what they hold
up to the end of each block, so that those which share a block become one row, whatever their number. Turns
are looked at only within these distinct blocks, and regrouped only where several of them follow the same
start, that is where siblings diverge; the one block after a start is a chain of nodes as it stands.

Digests are two 64-bit hashes; that of a prefix is the exclusive or of its turns' hashes with their places,
so it can be summed by block and in any order. All steps are DataFrame operations but the ordered digests
and numbers, which stream through sorted partitions.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimweave.llm.common import column_of, table, work_folder, written

#: Turns of a block.
BLOCK = 4

#: Blocks over which a window runs; beyond it come the offsets of such runs.
RUN = 1024

#: Ids that one piece of an unfinished list holds.
PIECE = 50_000

NODE = ["pa", "pb"]


def numbered(rows: DataFrame, folder: str) -> DataFrame:
    """(conv_id, place, ha, hb, bytes) of (conv_id, turn, role, text): places count from 1 by turn, role and text.

    Nulls come first and count as empty; rows without conv_id have no conversation and are left out. Rows are
    sorted in ranges, so a conversation may be longer than a task can hold; its ranges' lengths are summed then.
    """
    role, text = F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    whole = rows.where(F.col("conv_id").isNotNull()).select("conv_id", "turn", role, text)
    keys = ["conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("_tie")]
    order = ["conv_id", "turn", "role", "text", "_tie"]
    dealt = whole.select(*keys).repartitionByRange(*order).sortWithinPartitions(*order)
    narrow = dealt.select(
        "conv_id",
        F.xxhash64("role", "text").alias("ha"),
        F.xxhash64("text", F.lit(1), "role").alias("hb"),
        F.octet_length("text").cast("long").alias("bytes"),
    )

    def count(batches):
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            ids = column_of(batch, "conv_id").to_numpy()
            if not len(ids):
                continue
            first = np.flatnonzero(np.diff(ids, prepend=ids[0] - 1))
            at = np.arange(1, len(ids) + 1) - np.repeat(first, np.diff(first, append=len(ids)))
            if ids[0] == last:
                at[: first[1] if len(first) > 1 else None] += seen
            last, seen = ids[-1], at[-1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(ids), part), pa.int32()), pa.array(at, pa.int64())],
                [*batch.schema.names, "part", "at"],
            )

    counted = narrow.mapInArrow(count, "conv_id long, ha long, hb long, bytes long, part int, at long")
    counted = written(counted, f"{folder}/counted")
    parts = counted.groupBy("conv_id", "part").agg(F.max("at").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A range ends inside one conversation at most: no more rows than ranges.
    offsets = parts.withColumn("offset", F.sum("n").over(before)).where("offset > 0").drop("n")
    placed = counted.join(F.broadcast(offsets), ["conv_id", "part"], "left")
    return placed.select("conv_id", (F.col("at") + F.coalesce("offset", F.lit(0))).alias("place"), "ha", "hb", "bytes")


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def _xor_all(turns: Column, field: str, start: Column) -> Column:
    return F.aggregate(turns, start, lambda x, turn: _xor(x, turn[field]))


def _blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, level, turns, sa, sb, ea, eb): each block with the digests of the prefixes that start and end it."""
    turn = F.struct("place", F.xxhash64("place", "ha", "hb").alias("a"), F.xxhash64("hb", "place", "ha").alias("b"), "bytes")
    level = F.floor((F.col("place") - 1) / BLOCK).alias("level")
    cut = turns.groupBy("conv_id", level).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    run = F.floor(F.col("level") / RUN).alias("run")
    own = [_xor_all(F.col("turns"), i, F.lit(0).cast("long")).alias(f"x{i}") for i in "ab"]
    cut = cut.select("*", run, *own)
    inside = Window.partitionBy("conv_id", "run").orderBy("level")
    cut = cut.select("*", *[F.bit_xor(f"x{i}").over(inside).alias(f"r{i}") for i in "ab"])
    sums = cut.groupBy("conv_id", "run").agg(*[F.bit_xor(f"x{i}").alias(f"o{i}") for i in "ab"])
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv_id", "run", *[F.bit_xor(f"o{i}").over(before).alias(f"o{i}") for i in "ab"]).where("run > 0")
    cut = cut.join(sums, ["conv_id", "run"], "left")
    ends = [_xor(F.col(f"r{i}"), F.coalesce(F.col(f"o{i}"), F.lit(0))) for i in "ab"]
    starts = [_xor(end, F.col(f"x{i}")).alias(f"s{i}") for end, i in zip(ends, "ab")]
    return cut.select("conv_id", "level", "turns", *starts, *[end.alias(f"e{i}") for end, i in zip(ends, "ab")])


def _steps() -> Column:
    """The nodes along a block: depth, digest, parent's digest and bytes of the last text."""

    def node(turn: Column, i: Column) -> Column:
        at = [_xor_all(F.slice("turns", F.lit(1), i + 1), k, F.col(f"s{k}")) for k in "ab"]
        up = [_xor(digest, turn[k]).alias(f"u{k}") for digest, k in zip(at, "ab")]
        return F.struct(turn["place"].alias("depth"), at[0].alias("pa"), at[1].alias("pb"), *up, turn["bytes"].alias("bytes"))

    return F.transform("turns", node)


def _nodes(distinct: DataFrame) -> DataFrame:
    """(depth, pa, pb, ua, ub, bytes, conv_id, n_convs): nodes below the root from the distinct blocks."""
    row = F.struct(*distinct.columns)
    starts = distinct.groupBy("level", "sa", "sb").agg(F.count(F.lit(1)).alias("n"), F.first(row).alias("only"))
    alone = starts.where("n = 1").select("only.*")
    forks = distinct.join(alone.select("level", "ea", "eb"), ["level", "ea", "eb"], "left_anti")
    along = ["step.depth", "step.pa", "step.pb", "step.ua", "step.ub", "step.bytes"]
    chains = alone.select("conv_id", "n_convs", F.explode(_steps()).alias("step")).select(*along, "conv_id", "n_convs")
    turns = forks.select("conv_id", "n_convs", F.explode(_steps()).alias("step")).select(*along, "conv_id", "n_convs")
    firsts = [F.first(c).alias(c) for c in ("ua", "ub", "bytes")]
    met = turns.groupBy("depth", *NODE).agg(*firsts, F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"))
    return chains.unionByName(met)


def _subtrees(distinct: DataFrame, blocks: DataFrame, nodes: DataFrame, folder: str) -> DataFrame:
    """(pa, pb, n_leaves, saved_tokens) of each node below the root.

    A node belongs to the distinct block of its smallest member, which names the block too. Blocks of one
    smallest member follow each other down to that conversation's end: such a chain has one sum, which counts
    for all blocks above it, and running sums inside. So a block learns what lies below it, and within a
    block the nodes that belong to it are summed from its end. No path is followed step by step.
    """
    level = F.floor((F.col("depth") - 1) / BLOCK).alias("level")
    own = nodes.select("conv_id", level, "depth", "saved", "leaf").groupBy("conv_id", "level")
    own = own.agg(
        F.sum("saved").alias("saved"), F.sum("leaf").alias("leaves"),
        F.collect_list(F.struct("depth", "saved", "leaf")).alias("own"),
    )
    owned = distinct.join(own, ["conv_id", "level"], "left").na.fill(0, ["saved", "leaves"])
    owned = written(owned, f"{folder}/owned")
    run = F.floor(F.col("level") / RUN)
    chains = owned.groupBy("conv_id").agg(
        F.min("level").alias("top"), F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")
    )
    above = blocks.select("conv_id", "level", "ea", "eb").join(chains, "conv_id").where("level < top")
    # What lies further down the same chain, by runs of blocks.
    runs = owned.groupBy("conv_id", run.alias("run")).agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    later = Window.partitionBy("conv_id").orderBy(F.desc("run")).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv_id", "run", *[F.sum(c).over(later).alias(f"later_{c}") for c in ("saved", "leaves")])
    below = Window.partitionBy("conv_id", "run").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, -1)
    inside = owned.select("conv_id", "level", run.alias("run"), "ea", "eb", "saved", "leaves").join(
        runs.where("later_leaves IS NOT NULL"), ["conv_id", "run"], "left"
    )
    sums = [
        (F.coalesce(F.sum(c).over(below), F.lit(0)) + F.coalesce(F.col(f"later_{c}"), F.lit(0))).alias(c)
        for c in ("saved", "leaves")
    ]
    parts = above.select("ea", "eb", "saved", "leaves").unionByName(inside.select("ea", "eb", *sums))
    under = parts.groupBy("ea", "eb").agg(F.sum("saved").alias("under_saved"), F.sum("leaves").alias("under_leaves"))
    steps = owned.join(under, ["ea", "eb"], "left").select("*", F.explode(_steps()).alias("step"))

    def rest(field: str, base: str) -> Column:
        kept = F.filter(F.coalesce("own", F.array()), lambda o: o["depth"] >= F.col("step.depth"))
        return F.aggregate(kept, F.coalesce(F.col(base), F.lit(0)).cast("long"), lambda x, o: x + o[field])

    sums = steps.select("step.pa", "step.pb", rest("saved", "under_saved").alias("s"), rest("leaf", "under_leaves").alias("l"))
    return sums.groupBy(*NODE).agg(F.sum("l").alias("n_leaves"), F.sum("s").alias("saved_tokens"))


def listed(rows: DataFrame, folder: str) -> DataFrame:
    """(pa, pb, ends_sha256) of (pa, pb, conv_id): SHA-256 of a node's ids in ascending order, joined by commas.

    Ids are sorted in ranges over all nodes. A list inside a range is hashed there; those at its edges may go
    on in the next one and leave their text in pieces, which are hashed in order. No list is held whole.
    """
    dealt = rows.select(*NODE, "conv_id").repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")

    def hashed(batches):
        first, node, ids = True, None, []

        def done(node, ids, edge):
            text = ",".join(map(str, ids))
            if edge:
                return (*node, None, ids[0], text)
            return (*node, hashlib.sha256(text.encode()).hexdigest(), None, None)

        for batch in batches:
            out = []
            rows = zip(*(c.to_pylist() for c in batch.columns))
            for a, b, conv in rows:
                if (a, b) != node:
                    if node is not None:
                        out.append(done(node, ids, first))
                        first = False
                    node, ids = (a, b), []
                elif len(ids) >= PIECE:
                    # A list of this length is finished from its pieces, wherever it ends.
                    out.append(done(node, ids, True))
                    ids, first = [], True
                ids.append(conv)
            yield _lists(out)
        if node is not None:
            yield _lists([done(node, ids, True)])

    found = written(dealt.mapInArrow(hashed, LISTS), f"{folder}/lists")
    pieces = found.where("ends_sha256 IS NULL").repartition(*NODE).sortWithinPartitions(*NODE, "start")

    def finished(batches):
        node, sha = None, None
        for batch in batches:
            out = []
            for row in batch.select(["pa", "pb", "text"]).to_pylist():
                if (row["pa"], row["pb"]) != node:
                    if node is not None:
                        out.append((*node, sha.hexdigest()))
                    node, sha = (row["pa"], row["pb"]), hashlib.sha256(row["text"].encode())
                else:
                    sha.update(b"," + row["text"].encode())
            yield _ends(out)
        if node is not None:
            yield _ends([(*node, sha.hexdigest())])

    whole = found.where("ends_sha256 IS NOT NULL").select(*NODE, "ends_sha256")
    return whole.unionByName(pieces.mapInArrow(finished, "pa long, pb long, ends_sha256 string"))


LISTS = "pa long, pb long, ends_sha256 string, start long, text string"


def _lists(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()]
    columns = list(zip(*rows)) if rows else [()] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["pa", "pb", "ends_sha256", "start", "text"]
    )


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 3
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.int64(), pa.string()])], ["pa", "pb", "ends_sha256"]
    )


def trie(turns: DataFrame, conversations: DataFrame, folder: str) -> DataFrame:
    """The nodes of the prefix trie of `turns` (conv_id, place, ha, hb, bytes); `conversations` has every conv_id once.

    Places run from 1 without gaps; ha and hb stand for a turn, bytes is the size of its text. Conversations
    without turns end at the root. A node (pa, pb is its digest, 0, 0 the root's) has depth, conv_id (its
    smallest member, whose first `depth` turns it is), parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256 (see `listed`). No conversations, no nodes.
    """
    blocks = written(_blocks(turns), f"{folder}/blocks")
    firsts = [F.first(c).alias(c) for c in ("turns", "sa", "sb")]
    distinct = blocks.groupBy("level", "ea", "eb").agg(
        *firsts, F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")
    )
    distinct = written(distinct, f"{folder}/distinct")
    nodes = written(_nodes(distinct), f"{folder}/nodes")

    children = nodes.groupBy(F.col("ua").alias("pa"), F.col("ub").alias("pb")).agg(F.count(F.lit(1)).alias("n_children"))
    children = written(children, f"{folder}/children")
    saved = ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")
    leaf = F.col("n_children").isNull().cast("long").alias("leaf")
    facts = written(nodes.join(children, NODE, "left").select(nodes["*"], "n_children", saved, leaf), f"{folder}/facts")

    last = blocks.groupBy("conv_id").agg(F.max_by(F.struct("ea", "eb"), "level").alias("end"))
    none = F.lit(0).cast("long")
    ends = conversations.join(last, "conv_id", "left").select(
        "conv_id", F.coalesce("end.ea", none).alias("pa"), F.coalesce("end.eb", none).alias("pb")
    )
    ends = listed(ends, folder)

    sums = facts.agg(F.sum("leaf"), F.sum("saved")).first()
    everything = conversations.agg(F.min("conv_id"), F.count(F.lit(1))).first()
    root = conversations.sparkSession.createDataFrame(
        [(0, everything[0], None, everything[1], sums[0] or 1, sums[1] or 0, 0, 0)] if everything[1] else [],
        "depth long, conv_id long, parent_conv_id long, n_convs long, n_leaves long, saved_tokens long, pa long, pb long",
    )
    root = root.join(children, NODE, "left")

    # The root's conv_id needs no join; other parents meet their children by digest, which AQE may split.
    parents = nodes.select(F.col("pa").alias("ua"), F.col("pb").alias("ub"), F.col("conv_id").alias("parent_conv_id"))
    first = facts.where("depth = 1").withColumn("parent_conv_id", F.lit(everything[0]).cast("long"))
    deeper = facts.where("depth > 1").join(parents, ["ua", "ub"])
    below = first.unionByName(deeper).join(_subtrees(distinct, blocks, facts, folder), NODE)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", *NODE]
    found = root.select(*columns).unionByName(below.select(*columns)).join(ends, NODE, "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return found.na.fill(0, ["n_children"]).withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))


def rebuilt(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Conversations that begin with up to 8 turns of their group's first one, as the query states it.

    Conversation c takes the first h = crc32(c) % 9 turns of c - c % 5 (% as in SQL), then its own after h.
    """
    h = (F.crc32(F.col("conv_id").cast("string")) % 9).alias("h")
    plan = conversations.select("conv_id", "n", h, (F.col("conv_id") - F.col("conv_id") % 5).alias("base"))
    bases = conversations.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    plan = plan.join(bases, "base", "left").withColumn("lent", F.least("h", F.coalesce("n_base", F.lit(0))))
    heads = turns.where("place <= 8").withColumnRenamed("conv_id", "base")
    lent = heads.join(plan, "base").where("place <= lent")
    own = turns.join(plan.select("conv_id", "h", "lent"), "conv_id").where("place > h")
    own = own.withColumn("place", F.col("place") - F.col("h") + F.col("lent"))
    columns = ["conv_id", "place", "ha", "hb", "bytes"]
    return lent.select(*columns).unionByName(own.select(*columns))


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, rebuilt so that groups of five share beginnings."""
    folder = work_folder(spark, "trie")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = written(numbered(rows, folder), f"{folder}/turns")
    conversations = written(turns.groupBy("conv_id").agg(F.max("place").alias("n")), f"{folder}/conversations")
    again = written(rebuilt(turns, conversations), f"{folder}/rebuilt")
    return trie(again, conversations.select("conv_id"), folder).drop(*NODE)


#: The same from the text of every prefix. An unsigned crc32 in SQL: eight shifts for each byte.
ORACLE_SQL = """
WITH placed AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
    xor(list_reduce([4294967295] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT),
      lambda crc, byte: list_reduce([xor(crc, byte)] || range(8),
        lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM placed)),
joined AS (
  SELECT c.conv_id, 0 AS own, p.place, p.role, p.text FROM convs c JOIN placed p ON p.conv_id = c.base AND p.place <= c.h
  UNION ALL
  SELECT c.conv_id, 1, p.place, p.role, p.text FROM convs c JOIN placed p ON p.conv_id = c.conv_id AND p.place > c.h),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS depth,
    strlen(text) AS bytes, sha256(sha256(role) || sha256(text)) AS digest FROM joined),
paths AS (
  SELECT conv_id, depth, bytes, sha256(string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM turns
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
ended AS (SELECT *, lead(node) OVER (PARTITION BY conv_id ORDER BY depth) AS child,
    lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM paths),
nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, count(DISTINCT child) AS n_children,
    any_value(parent) AS parent, (count(*) - 1) * any_value(bytes) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (child IS NULL), '')) AS ends_sha256
  FROM ended GROUP BY node, depth),
subtrees AS (
  SELECT p.node, sum(n.saved)::BIGINT AS saved_tokens, count(*) FILTER (n.n_children = 0) AS n_leaves
  FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.node)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens,
  n.ends_sha256
FROM nodes n JOIN subtrees s USING (node) LEFT JOIN nodes u ON u.node = n.parent
"""
