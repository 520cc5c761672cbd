"""Links between documents of similar word shingles, by filters under several token orders.

Linked documents share tokens of their prefixes under any global order of the tokens, so
a link must pass the filters of all orders:

* the order of the token hashes: the first fifth of each set and a tenth more is compared,
  and a document that shares too few of these tokens with others has no link at all;
* an order that puts tokens found in one group only first, then rare before frequent ones,
  hashes breaking ties;
* the same with ties broken by another hash.

Pairs that meet under both of the latter are verified on their whole sets. Documents of equal
sets are one from the start. Before the last two orders, documents that agree in the
smallest token under some order are compared with a few leaders of their group, and links
found so far join them to groups: only pairs of different groups are searched for. Of
these, pairs over a rare token become rows; families that share a frequent one are compared
in blocks that give back links only, so near copies do not become all their pairs.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm import words as w
from corpusmill.llm.common import column, narrowed, rank_within
from corpusmill.llm.components import components
from corpusmill.session import materialize

SHINGLE = 5
PERCENT = 80
KEY_ORDERS = 2
LEADERS = 32
HOT_ROWS = 1_000
SALTS = 64
# Tokens of at most so many documents are paired; documents of others meet in blocks.
LIGHT = 16
BLOCK = 256


def _extra(size):
    """Tokens that two prefixes under the first order share beyond none; grows with the size."""
    return 1 + size // 10


def _least_partner(size, percent: int):
    return -(-size * percent // 100)


def _sets(percent: int):
    """Sets of all texts as size, digest and prefix under the order of hashes."""

    def run(batches):
        for batch in batches:
            for first, texts in w.pieces(batch.column("text")):
                hashes, bounds = w.shingles(w.words(texts, fold=True), SHINGLE)
                sizes = np.diff(bounds)
                digests = [hashlib.md5(hashes[a:b].tobytes()).digest() for a, b in zip(bounds, bounds[1:])]  # noqa: B905
                # A text's shingles are sorted by hash, so its prefix comes first.
                take = np.minimum(sizes, sizes - _least_partner(sizes, percent) + _extra(sizes))
                at = np.repeat(bounds[:-1] - (np.cumsum(take) - take), take) + np.arange(take.sum())
                part = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("text_key"),
                        pa.array(sizes),
                        pa.array(digests, pa.binary()),
                        w.lists(hashes[at].view(np.int64), np.concatenate([[0], np.cumsum(take)])),
                    ],
                    names=["id", "text_key", "n", "set_key", "prefix"],
                )

    return run


def _tokens(batches):
    """Whole sets, with the smallest token under some further orders."""
    for batch in batches:
        for first, texts in w.pieces(batch.column("text")):
            hashes, bounds = w.shingles(w.words(texts, fold=True), SHINGLE)
            part = batch.slice(first, len(texts))
            keys = [np.minimum.reduceat(w.mixed(hashes, 100 + k), bounds[:-1]) for k in range(KEY_ORDERS)]
            flat = np.stack(keys, 1).view(np.int64).ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("cid"),
                    part.column("n"),
                    w.lists(hashes.view(np.int64), bounds),
                    w.lists(flat, np.arange(len(texts) + 1) * KEY_ORDERS),
                ],
                names=["cid", "n", "tokens", "keys"],
            )


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    return int(np.count_nonzero(a[at] == b))


def _led(percent: int):
    """Compare each row with the latest leaders of its group; rows come sorted by group and size.

    Gives verified links, and each row that became a leader as a link with itself.
    """

    def run(batches):
        group, leaders = None, []
        for batch in batches:
            a, b = [], []
            tokens = batch.column("tokens")
            offsets, flat = tokens.offsets.to_numpy(), tokens.values.to_numpy().view(np.uint64)
            for i, (key, cid, salt) in enumerate(
                zip(batch.column("key").to_pylist(), batch.column("cid").to_pylist(), batch.column("salt").to_pylist(), strict=True)
            ):
                if (key, salt) != group:
                    group, leaders = (key, salt), []
                own = flat[offsets[i] : offsets[i + 1]]
                leaders = [x for x in leaders if 100 * len(x[1]) >= percent * len(own)]
                for k, (other, theirs) in enumerate(leaders):
                    common = len(own) if other == cid else _shared(own, theirs)
                    if 100 * common >= percent * (len(own) + len(theirs) - common):
                        a.append(cid)
                        b.append(other)
                        leaders.append(leaders.pop(k))  # a leader that has followers is kept longer
                        break
                else:
                    a.append(cid)
                    b.append(cid)
                    leaders = [*leaders[-LEADERS + 1 :], (cid, own.copy())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), batch.column("key")], names=["a", "b", "key"]
            )

    return run


def _early_links(sets: DataFrame, percent: int) -> DataFrame:
    """Verified links ``a, b`` among documents that agree in a smallest token."""
    keyed = sets.select("cid", F.explode("keys").alias("key"))
    # More rows than this share of all can have few keys only, so the list is small.
    most = max(HOT_ROWS, sets.count() * KEY_ORDERS // 2000)
    hot = materialize(keyed.groupBy("key").agg(F.count("*").alias("rows")).filter(F.col("rows") > most).select("key"), "hot-keys")
    rows = sets.select("cid", "n", "tokens", F.explode("keys").alias("key"))
    spread = rows.join(F.broadcast(hot.withColumn("hot", F.lit(True))), "key", "left").withColumn(
        "salt", F.when(F.col("hot"), F.pmod("cid", F.lit(SALTS))).otherwise(0).cast("int")
    )
    schema = "a bigint, b bigint, key bigint"

    def grouped(df):
        ordered = df.repartition("key", "salt").sortWithinPartitions("key", "salt", "n", "cid")
        return ordered.select("cid", "tokens", "key", "salt").mapInArrow(_led(percent), schema)

    first = materialize(grouped(spread), "links")
    if hot.isEmpty():
        return first.filter("a <> b").select("a", "b")
    # The parts of a hot group meet through their leaders.
    leaders = first.filter("a = b").join(F.broadcast(hot), "key", "left_semi").select(F.col("a").alias("cid"), "key").distinct()
    again = grouped(leaders.join(sets.select("cid", "n", "tokens"), "cid").withColumn("salt", F.lit(0)))
    return first.unionByName(materialize(again, "links")).filter("a <> b").select("a", "b")


def _open_documents(sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Sets that may link to another group, with their prefixes ``first`` and ``second`` under two orders.

    Tokens of one group only come first, so a set that has enough of them is closed.
    """
    sized = sets.join(groups.select(F.col("node").alias("cid"), F.col("root")), "cid", "left")
    sized = materialize(sized.select("cid", "n", F.coalesce("root", "cid").alias("comp"), "tokens"), "grouped-sets")
    by_token = Window.partitionBy("h")
    across = (
        sized.select("cid", "n", "comp", F.explode("tokens").alias("h"))
        .withColumns({"df": F.count("*").over(by_token), "x": F.min("comp").over(by_token), "y": F.max("comp").over(by_token)})
        .filter("x < y")
        .groupBy("cid", "n", "comp")
        .agg(F.collect_list(F.struct("df", "h")).alias("across"))
    )
    least = F.ceil(F.col("n") * percent / 100).cast("int")
    slots = F.col("n") - least + 1 - (F.col("n") - F.size("across"))
    other = F.transform("across", lambda x: F.struct(x["df"].alias("df"), F.xxhash64(x["h"]).alias("k"), x["h"].alias("h")))
    prefix = lambda ordered: F.transform(F.slice(ordered, 1, F.col("slots")), lambda x: x["h"])
    found = across.withColumn("slots", slots.cast("int")).filter("slots > 0").select(
        "cid", "n", "comp", prefix(F.array_sort("across")).alias("first"), prefix(F.array_sort(other)).alias("second")
    )
    found = materialize(found, "open-prefixes")
    return materialize(found.join(narrowed(sized.select("cid", "tokens"), materialize(found.select("cid"), "open-ids")), "cid"), "open")


def _verified(joined: DataFrame, percent: int) -> DataFrame:
    """Rows whose prefixes meet under the second order and whose sets are similar."""
    common = F.size(F.array_intersect("ta", "tb"))
    near = joined.filter(F.arrays_overlap("sa", "sb"))
    return near.filter(100 * common >= percent * (F.size("ta") + F.size("tb") - common)).select("a", "b")


def _light_links(rows: DataFrame, open_: DataFrame, percent: int) -> DataFrame:
    """Links over tokens of few documents: their pairs grow with the documents only."""
    a = rows.select("h", F.col("cid").alias("a"), F.col("comp").alias("ca"), F.col("n").alias("na"))
    b = rows.select("h", F.col("cid").alias("b"), F.col("comp").alias("cb"), F.col("n").alias("nb"))
    fits = (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb"))
    fits = fits & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    pairs = materialize(a.join(b, "h").filter(fits).select("a", "b").distinct(), "candidates")
    sets = open_.select("cid", "second", "tokens")
    return _verified(pairs.join(sets.toDF("a", "sa", "ta"), "a").join(sets.toDF("b", "sb", "tb"), "b"), percent)


def _linked_in_blocks(percent: int):
    """Links between different groups in each pair of blocks; rows come sorted by pair.

    Holds one pair of blocks. A link that joins groups joined already is left out.
    """

    def links(docs):
        root = {d["comp"]: d["comp"] for d in docs}

        def top(x):
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        holders: dict[int, list[int]] = {}
        within = docs[0]["i"] == docs[0]["j"]
        for n, doc in enumerate(docs):
            asked = set()
            for token in doc["first"]:
                asked.update(holders.setdefault(token, []))
                holders[token].append(n)
            for m in sorted(asked, reverse=True):
                other = docs[m]
                if (
                    (within or other["block"] != doc["block"])
                    and top(other["comp"]) != top(doc["comp"])
                    and 100 * other["n"] >= percent * doc["n"]  # sorted by size
                    and not doc["second"].isdisjoint(other["second"])
                ):
                    common = _shared(doc["tokens"], other["tokens"])
                    if 100 * common >= percent * (doc["n"] + other["n"] - common):
                        root[top(doc["comp"])] = top(other["comp"])
                        yield doc["cid"], other["cid"]

    def run(batches):
        pair, docs = None, []
        for batch in batches:
            tokens = batch.column("tokens")
            offsets, flat = tokens.offsets.to_numpy(), tokens.values.to_numpy().view(np.uint64)
            rows = batch.drop_columns(["tokens"]).to_pylist()
            found = []
            for k, row in enumerate(rows):
                if (row["root"], row["i"], row["j"]) != pair:
                    found.extend(links(docs) if docs else ())
                    pair, docs = (row["root"], row["i"], row["j"]), []
                row["second"], row["tokens"] = frozenset(row["second"]), flat[offsets[k] : offsets[k + 1]].copy()
                docs.append(row)
            yield pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})
        found = list(links(docs)) if docs else []
        yield pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return run


def _heavy_links(rows: DataFrame, open_: DataFrame, percent: int) -> DataFrame:
    """Links over tokens of many documents: families, in blocks sorted by size.

    Documents that share such a token are of one family. A task gets two blocks whose sizes
    allow links, so a family of any size is spread and no pair becomes a row.
    """
    hub = F.min("cid").over(Window.partitionBy("h"))
    families = components(rows.select(F.col("cid").alias("a"), hub.alias("b")).filter("a <> b"))
    member = families.select(F.col("node").alias("cid"), "root").join(open_.select("cid", "n"), "cid")
    ranked = rank_within(member, ["root"], ["n", "cid"], F.col("n"), "place")
    placed = materialize(ranked.select("cid", "root", F.floor(F.col("place") / BLOCK).cast("int").alias("block"), "n"), "families")
    blocks = placed.groupBy("root", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    i = blocks.select("root", F.col("block").alias("i"), "high")
    j = blocks.select("root", F.col("block").alias("j"), "low")
    pairs = i.join(j, "root").filter((F.col("i") <= F.col("j")) & (100 * F.col("high") >= percent * F.col("low")))
    sides = pairs.select("root", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    docs = placed.select("cid", "root", "block").join(sides, ["root", "block"]).join(open_, "cid")
    ordered = docs.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "n", "cid")
    return ordered.mapInArrow(_linked_in_blocks(percent), "a bigint, b bigint")


def _late_links(sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Verified links between different groups, candidates sharing prefixes under two orders."""
    open_ = _open_documents(sets, groups, percent)
    by_token = Window.partitionBy("h")
    rows = open_.select("cid", "n", "comp", F.explode("first").alias("h")).withColumns(
        {"held": F.count("*").over(by_token), "x": F.min("comp").over(by_token), "y": F.max("comp").over(by_token)}
    )
    rows = materialize(rows.filter("x < y").drop("x", "y"), "prefix-rows")
    light = materialize(_light_links(rows.filter(F.col("held") <= LIGHT), open_, percent), "light-links")
    heavy = rows.filter(F.col("held") > LIGHT)
    if heavy.isEmpty():
        return light
    return light.unionByName(materialize(_heavy_links(heavy, open_, percent), "heavy-links"))


def link_groups(
    df: DataFrame, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``df``: ``doc_id, n_shingles, component_id, text_key``.

    Words are lower-cased (A-Z); a text's set is its distinct five-word shingles, or its
    whole sequence if it has fewer words. Two texts are linked when their sets agree in at
    least ``percent`` of their union; ``component_id`` is the smallest id reachable by links.
    Null, empty and blank texts have no set and no link. Repeated rows are linked with each
    other. Null ids take part in links but are never the smallest id; a group of null ids
    alone has the component null. An empty table gives no rows. Texts may be of any length.
    """
    docs = df.select(column(id_column).alias("id"), F.coalesce(column(text_column), F.lit("")).alias("text"))
    docs = docs.withColumn("text_key", F.xxhash64("text"))
    keys = f"id {dict(docs.dtypes)['id']}, text_key bigint"
    read = docs.mapInArrow(_sets(percent), f"{keys}, n bigint, set_key binary, prefix array<bigint>")
    stored = materialize(read.withColumn("row", F.monotonically_increasing_id()), "sets")
    thin = stored.drop("prefix").filter("n > 0")
    classes = materialize(
        thin.groupBy("set_key", "n").agg(
            F.min("row").alias("cid"), F.min("id").alias("low"), F.min(F.struct("row", "id", "text_key")).alias("first")
        ),
        "classes",
    )

    # First order. Eight bytes stand for the set here: rows of equal sets are one.
    short = F.conv(F.hex(F.substring("set_key", 1, 7)), 16, 10).cast("bigint")
    by_token = Window.partitionBy("h")
    shared = (
        stored.select(short.alias("k"), F.explode("prefix").alias("h"))
        .withColumns({"x": F.min("k").over(by_token), "y": F.max("k").over(by_token)})
        .filter("x < y")
        .groupBy("k")
        .agg(F.count("*").alias("shared"))
    )
    partner = F.floor((F.col("n") * percent + 99) / 100)
    enough = F.col("shared") >= 1 + F.floor(partner / 10)
    open_ = materialize(
        classes.withColumn("k", short).join(shared, "k").filter(enough)
        .select("cid", "n", F.col("first.id").alias("id"), "first.text_key"),
        "open-classes",
    )
    # Null ids can't be joined; their texts alone name them.
    near = narrowed(docs.select("id", "text_key", "text"), open_.select("text_key").distinct())
    leaders = near.join(open_, (near["id"].eqNullSafe(open_["id"])) & (near["text_key"] == open_["text_key"]))
    leaders = leaders.select("cid", "n", near["text"]).dropDuplicates(["cid"])
    sets = materialize(
        leaders.mapInArrow(_tokens, "cid bigint, n bigint, tokens array<bigint>, keys array<bigint>"), "open-sets"
    )
    early = materialize(_early_links(sets, percent), "early-links")
    groups = components(early)
    late = materialize(_late_links(sets, groups, percent), "late-links")
    if not late.isEmpty():
        groups = components(groups.toDF("a", "b").unionByName(late))

    placed = classes.join(groups, F.col("cid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cid"))
    placed = materialize(placed.select("set_key", "root", "low"), "placed")
    lowest = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    of_set = materialize(placed.join(lowest, "root").select("set_key", "component_id"), "components-of-sets")
    linked = thin.join(of_set, "set_key").select("id", "n", "component_id", "text_key")
    alone = stored.filter("n = 0").select("id", "n", F.col("id").alias("component_id"), "text_key")
    return linked.unionByName(alone).select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", "text_key")


def one_of_each(df: DataFrame, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``df``, with all columns, whose id is the smallest of their group.

    Texts without words all stay. Rows of one id and text are one document and stay once;
    in a group of null ids alone every document stays.
    """
    groups = materialize(link_groups(df, percent, id_column, text_column), "groups")
    gone = groups.filter("doc_id > component_id or doc_id is null and component_id is not null")
    gone = materialize(gone.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct(), "dropped")
    keyed = df.withColumns({"_id": column(id_column), "_key": F.xxhash64(F.coalesce(column(text_column), F.lit("")))})
    kept = narrowed(keyed, gone.filter("_id is not null"), "left_anti")
    nulls = gone.filter("_id is null").select("_key")
    if not nulls.isEmpty():
        lost = narrowed(kept.filter("_id is null"), materialize(nulls, "dropped-nulls"), "left_anti")
        kept = kept.filter("_id is not null").unionByName(lost.select(*[column(c) for c in kept.columns]))
    repeated = groups.filter("n_shingles > 0").groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).filter("n > 1")
    if not repeated.isEmpty():
        bare = kept.filter(F.coalesce(column(text_column), F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
        blank = kept.filter(~F.coalesce(column(text_column), F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
        kept = bare.dropDuplicates(["_id", "_key"]).unionByName(blank)
    return kept.select(*[column(c) for c in df.columns])
