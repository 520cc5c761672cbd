"""Prefix tries of conversations, with subtree totals by centroid decomposition.

A node is a distinct sequence of first turns. Its fingerprint is the exclusive or of the
hashes of its turns and their positions, so the prefixes of one very long conversation are
running sums over blocks that different tasks work on. A node is named by its smallest
member and its depth: a conversation then owns one stretch of nodes on its path, from the
depth where it leaves all smaller conversations.

Nodes of one member are chains with one leaf and need no sums. The others form a forest of
parent edges whose subtree totals come from a centroid decomposition: in each component
the nodes with more than half of its nodes below them form a path from the top, whose
deepest node is the centroid. The total of what is at or below the centroid is added to
that path; then the centroid goes, the parts below its children and the part above become
components of their own, each with at most half of the nodes. After as many rounds as the
node count has binary digits nothing is left, however deep the trie is.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import BROADCAST_KEYS, column, rank_within, thin_rows
from corpusmill.session import materialize

BLOCK_BITS = 10
# Nodes with this share of all rows are broadcast; there are at most as many as its inverse.
HOT_SHARE = 1 / 100_000


class Trie(NamedTuple):
    """Nodes with their totals, and the node at which each conversation ends."""

    nodes: DataFrame
    ends: DataFrame


def looked_up(df: DataFrame, table: DataFrame, keys: list[str], how: str = "inner", rows: int | None = None) -> DataFrame:
    """``df`` with the columns of ``table``, which has one row for each value of ``keys``.

    Up to a million rows of ``table`` are broadcast, so that no key draws its rows into one
    task; a larger table is joined by a shuffle, whose skewed partitions Spark splits.
    ``rows`` tells how many rows ``table`` has at most; else they are counted.
    """
    few = (table.limit(BROADCAST_KEYS + 1).count() if rows is None else rows) <= BROADCAST_KEYS
    return df.join(F.broadcast(table) if few else table, keys, how)


def ordered_turns(
    df: DataFrame,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """``conv, pos, digest, chars`` of every turn, ``pos`` from 1 by turn (null first).

    Null role or text counts as empty. Turns of one number are in the order of the digest of
    role and text; repeated rows are turns of their own. Rows without a conversation id
    belong to no conversation and are left out. Ids are whole numbers.
    """
    role, text = (F.coalesce(column(name), F.lit("")) for name in (role_column, text_column))
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = thin_rows(
        df.filter(column(conv_column).isNotNull()),
        None,
        "turns",
        conv=column(conv_column).cast("bigint"),
        turn=column(turn_column),
        digest=F.sha2(told.cast("binary"), 256),
        chars=F.length(text).cast("bigint"),
    )
    order = ["turn", "digest", "row"]
    ranged = materialize(turns.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id()), "turn-ranges")
    placed = rank_within(ranged, ["conv"], order, F.col("part"), "place")
    return materialize(placed.select("conv", (F.col("place") + 1).alias("pos"), "digest", "chars"), "turn-places")


def with_borrowed_heads(turns: DataFrame, family: int = 100, choices: int = 6) -> tuple[DataFrame, DataFrame]:
    """Turns of conversations that begin like the first of their family, and all ids (``conv``).

    Conversation ``c`` starts with the first ``h = crc32(c) % choices`` turns of conversation
    ``c - c % family`` (all if it has fewer, none if it is absent) and goes on with its own
    turns after its first ``h``.
    """
    base, h = F.col("conv") - F.col("conv") % family, F.crc32(F.col("conv").cast("string").cast("binary")) % choices
    sizes = materialize(turns.groupBy("conv").agg(F.max("pos").alias("n")), "turn-counts")
    firsts = sizes.filter(F.col("conv") % family == 0).select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    heads = sizes.select("conv", base.alias("base"), h.alias("h")).join(firsts, "base", "left")
    heads = materialize(heads.withColumn("k", F.least("h", F.coalesce("base_n", F.lit(0)))), "heads")
    shared = turns.filter((F.col("conv") % family == 0) & (F.col("pos") < choices))
    shared = shared.select(F.col("conv").alias("base"), "pos", "digest", "chars")
    borrowed = heads.join(shared, "base").filter(F.col("pos") <= F.col("k")).select("conv", "pos", "digest", "chars")
    # Only conversations whose first one is too short move up.
    short = heads.filter("k < h").select("conv", (F.col("h") - F.col("k")).alias("missing"))
    own = looked_up(turns.filter(F.col("pos") > h), short, ["conv"], "left")
    own = own.select("conv", (F.col("pos") - F.coalesce("missing", F.lit(0))).alias("pos"), "digest", "chars")
    return own.unionByName(borrowed), sizes.select("conv")


def _paths(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """``conv, d, a, b, chars``: the fingerprint of each prefix, the empty one included."""
    lane = [F.xxhash64("pos", "digest", F.lit(i)).alias(n) for i, n in enumerate("ab")]
    rows = turns.select("conv", F.col("pos").alias("d"), "chars", *lane, F.shiftright(F.col("pos") - 1, BLOCK_BITS).alias("block"))
    blocks = rows.groupBy("conv", "block").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    upto = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = blocks.select("conv", "block", *[F.bit_xor(n).over(upto).alias(f"base_{n}") for n in "ab"]).filter("block > 0")
    inside = Window.partitionBy("conv", "block").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.select("conv", "d", "chars", "block", *[F.bit_xor(n).over(inside).alias(n) for n in "ab"])
    whole = looked_up(summed, bases, ["conv", "block"], "left")
    prefixes = whole.select("conv", "d", *[F.col(n).bitwiseXOR(F.coalesce(f"base_{n}", F.lit(0))).alias(n) for n in "ab"], "chars")
    roots = convs.selectExpr("conv", "0L AS d", "0L AS a", "0L AS b", "0L AS chars")
    return materialize(prefixes.withColumn("d", F.col("d").cast("bigint")).unionByName(roots), "paths")


def _owned(paths: DataFrame) -> DataFrame:
    """``conv, d, owner, n, chars``: the smallest member and the member count of each prefix's node."""
    key = ["d", "a", "b"]
    nodes = materialize(paths.groupBy(*key).agg(F.min("conv").alias("owner"), F.count("*").alias("n")), "nodes")
    hot = nodes.filter(F.col("n") > max(1.0, paths.count() * HOT_SHARE))
    crowded = paths.join(F.broadcast(hot), key)
    others = paths.join(F.broadcast(hot.select(*key)), key, "left_anti").join(nodes, key)
    return materialize(crowded.unionByName(others).drop("a", "b"), "owners")


def _split(active: DataFrame, sizes: DataFrame, parts: int, borrowed: DataFrame) -> DataFrame:
    """Every row of ``active`` with its component's centroid and the total at and below that.

    ``under`` tells rows below the centroid, ``child`` who owns the centroid's child above them.
    """
    top = ["top", "top_d"]
    sized = looked_up(active, sizes, top, rows=parts).withColumn("heavy", 2 * F.col("size") > F.col("all")).drop("all")
    deepest = F.max_by(F.struct(F.col("conv").alias("c"), F.col("d").alias("c_d"), F.col("size").alias("c_size")), "d")
    centroids = sized.filter("heavy").groupBy(*top).agg(deepest.alias("at")).select(*top, "at.*")
    rows = looked_up(sized, centroids, top, rows=parts)
    known = F.col("start") <= F.col("c_d") + 1
    near = rows.filter(known | (F.col("d") <= F.col("c_d")))
    near = near.withColumn("child", F.col("conv")).withColumn("above", F.when(F.col("start") <= F.col("c_d"), F.col("conv")).otherwise(F.col("parent")))
    far = rows.filter(~known & (F.col("d") > F.col("c_d"))).withColumn("at_d", F.col("c_d") + 1)
    far = far.join(borrowed, ["conv", "at_d"]).drop("at_d")
    placed = near.unionByName(far)
    placed = placed.withColumn("under", (F.col("d") > F.col("c_d")) & (F.col("above") == F.col("c"))).drop("above")
    placed = placed.withColumn("is_c", (F.col("conv") == F.col("c")) & (F.col("d") == F.col("c_d")))
    totals = placed.filter("under OR is_c").groupBy(*top).agg(
        F.sum("leaves").alias("t_leaves"), F.sum("saved").alias("t_saved")
    )
    return looked_up(placed, totals, top, rows=parts)


def _rolled_up(forest: DataFrame, borrowed: DataFrame) -> DataFrame:
    """``conv, d, n_leaves, saved_tokens``: own values summed over each node's subtree."""
    active = forest.select(
        "*", F.lit(0).cast("bigint").alias("sum_leaves"), F.lit(0).cast("bigint").alias("sum_saved"),
        F.col("root").alias("top"), F.lit(0).cast("bigint").alias("top_d"),
    ).drop("root")
    done = []
    # Each round leaves at most half of a component's nodes together.
    while True:
        sizes = active.groupBy("top", "top_d").agg(F.max("size").alias("all"))
        parts = sizes.count()
        if not parts:
            break
        split = materialize(_split(active, sizes, parts, borrowed), "split")
        gain = [(F.col(f"sum_{v}") + F.when(F.col("heavy"), F.col(f"t_{v}")).otherwise(0)).alias(f"sum_{v}") for v in ("leaves", "saved")]
        done.append(split.filter("is_c").select("conv", "d", *gain))
        active = split.filter("NOT is_c").select(
            "conv", "d", "start", "parent", "leaves", "saved", *gain,
            (F.col("size") - F.when(F.col("heavy"), F.col("c_size")).otherwise(0)).alias("size"),
            F.when(F.col("under"), F.col("child")).otherwise(F.col("top")).alias("top"),
            F.when(F.col("under"), F.col("c_d") + 1).otherwise(F.col("top_d")).alias("top_d"),
        )
    if not done:
        return forest.select("conv", "d", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    whole = reduce(DataFrame.unionByName, done)
    return whole.withColumnsRenamed({"sum_leaves": "n_leaves", "sum_saved": "saved_tokens"})


def prefix_trie(turns: DataFrame, convs: DataFrame) -> Trie:
    """The trie of conversations given as ``conv, pos, digest, chars`` and all their ids.

    Nodes: ``conv_id`` (smallest member), ``depth, parent_conv_id`` (null at the root),
    ``n_convs`` (members), ``n_children, n_leaves`` (nodes without children in the subtree),
    ``saved_tokens`` (characters of last turns that the subtree's nodes share, counted once
    less than their members). Ends: ``conv_id, end_conv_id, end_depth``. Conversations without
    turns end at the root; without conversations there are no nodes.
    """
    owned = _owned(_paths(turns, convs))
    own = F.col("owner") == F.col("conv")
    # A conversation's own stretch: where it starts, who owns the node above, the last shared depth.
    spans = materialize(
        owned.groupBy("conv").agg(
            F.min(F.when(own, F.col("d"))).alias("start"),
            F.max_by("owner", F.when(~own, F.col("d"))).alias("parent"),
            F.max(F.when(F.col("n") > 1, F.col("d"))).alias("last"),
            F.max_by("owner", "d").alias("end_conv_id"), F.max("d").alias("end_depth"),
        ),
        "spans",
    )
    starts = spans.filter("start IS NOT NULL").select("conv", F.col("start").alias("d"), F.col("parent").alias("above"), F.lit(True).alias("first"))
    nodes = owned.filter(own).join(starts, ["conv", "d"], "left").select(
        "conv", "d", "n", "chars",
        F.when(F.col("d") == 0, None).when(F.col("first"), F.col("above")).otherwise(F.col("conv")).alias("parent"),
    )
    nodes = materialize(nodes, "trie-nodes")
    children = nodes.filter("d > 0").groupBy(F.col("parent").alias("conv"), (F.col("d") - 1).alias("d")).agg(
        F.count("*").alias("n_children"), F.count_if(F.col("n") == 1).alias("alone")
    )
    counted = nodes.join(children, ["conv", "d"], "left").fillna(0, ["n_children", "alone"])
    counted = materialize(counted, "trie-children")
    shared = owned.filter("n > 1")
    # Nodes of the forest below a prefix: what its members own from there on.
    reach = looked_up(shared, spans.filter("start <= last").select("conv", "start", "last"), ["conv"])
    below = F.col("last") - F.greatest("start", "d") + 1
    sizes = reach.groupBy(F.col("owner").alias("conv"), "d").agg(F.sum(below).alias("size"))
    forest = counted.filter("n > 1").join(sizes, ["conv", "d"])
    span = spans.filter("start <= last").select("conv", "start", F.col("parent").alias("above"))
    root = nodes.filter("d = 0").select("conv").first()
    forest = looked_up(forest.drop("parent"), span, ["conv"]).select(
        "conv", "d", "start", F.col("above").alias("parent"), "size",
        (F.when(F.col("n_children") == 0, 1).otherwise(0) + F.col("alone")).alias("leaves"),
        ((F.col("n") - 1) * F.col("chars")).alias("saved"),
        F.lit(root and root[0]).cast("bigint").alias("root"),
    )
    forest = materialize(forest, "forest")
    # Who owns a conversation's path above its own stretch, and the node over that.
    above = looked_up(shared, spans.filter("start <= last").select("conv", "start"), ["conv"]).filter("d < start")
    above = materialize(above.select("conv", "d", "owner"), "above")
    borrowed = above.select("conv", F.col("d").alias("at_d"), F.col("owner").alias("child")).join(
        above.select("conv", (F.col("d") + 1).alias("at_d"), F.col("owner").alias("above")), ["conv", "at_d"]
    )
    sums = _rolled_up(forest, materialize(borrowed, "borrowed"))
    plain = counted.join(sums, ["conv", "d"], "left").select(
        F.col("conv").alias("conv_id"), F.col("d").alias("depth"), F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), "n_children",
        F.coalesce("n_leaves", F.lit(1)).cast("bigint").alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).cast("bigint").alias("saved_tokens"),
    )
    return Trie(plain, spans.select(F.col("conv").alias("conv_id"), "end_conv_id", "end_depth"))


def _joined(rows: Column) -> Column:
    return F.array_join(rows, ",")


def with_end_digests(trie: Trie) -> DataFrame:
    """The nodes with ``ends_sha256``: of the ids that end there, ascending, joined by commas.

    Ids are joined in stretches of 65,536 numbers before they meet at their node. The digest
    needs one string for each node, so a node's list must fit into a string (2 GB).
    """
    ends = trie.ends.withColumn("stretch", F.shiftright("conv_id", 16))
    own = F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string"))
    parts = ends.groupBy("end_conv_id", "end_depth", "stretch").agg(_joined(own).alias("part"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("stretch", "part"))), lambda p: p["part"])
    lists = parts.groupBy(F.col("end_conv_id").alias("conv_id"), F.col("end_depth").alias("depth")).agg(_joined(ordered).alias("ids"))
    digest = F.sha2(F.coalesce("ids", F.lit("")).cast("binary"), 256)
    return trie.nodes.join(lists, ["conv_id", "depth"], "left").withColumn("ends_sha256", digest).drop("ids")
