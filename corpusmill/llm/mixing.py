"""Mixing sources to target weights by hierarchical budgets.

A token budget runs down a tree (such as domain, language, source) in proportion to the
weights of siblings. A node can use the tokens of its leaves as often as epochs are
allowed; what it can't use goes to its siblings first, and what all siblings can't use
goes to the siblings of their parent. Leaves under a weight of 0 can use none. Each leaf repeats its documents for whole epochs and
takes a prefix, by tokens, of one further epoch's seeded order.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import WORD, column, thin_rows
from corpusmill.session import materialize

EPOCHS = 4
# Leaves beyond this number meet the documents in a shuffle instead of a broadcast.
BROADCAST_LEAVES = 50_000
_BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def _weight(value: Column, weights: dict[str, float]) -> Column:
    known = F.lit(1.0)
    for name, weight in weights.items():
        known = F.when(value == name, float(weight)).otherwise(known)
    return known


def _filled(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Divide each parent's ``budget`` over its children by ``weight``, none above its ``cap``.

    Sorted by cap over weight, children whose cap is reached come first; the others divide
    what is left by weight. A child of weight 0 gets nothing.
    """
    siblings = Window.partitionBy(*parent)
    by_need = siblings.orderBy("need", "name")
    usable = F.when(F.col("weight") > 0, F.col("cap")).otherwise(0.0)
    sized = nodes.withColumn("cap", usable).withColumn(
        "need", F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(0.0)
    )
    before = F.coalesce(F.sum("cap").over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_need.rowsBetween(0, Window.unboundedFollowing))
    full = F.col("cap") * rest <= F.col("weight") * (F.col("budget") - before)
    marked = sized.withColumn("full", full)
    spent = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(siblings)
    share = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(siblings)
    given = F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * (F.col("budget") - spent) / share)
    return marked.withColumn("given", given)


def budgets(leaves: DataFrame, levels: list[str], weights: list[dict[str, float]], budget: float, epochs: int) -> DataFrame:
    """``leaves`` (``levels``, ``tokens``) with ``budget``: whole tokens that each leaf may give."""
    weighed = [_weight(F.col(name), own) > 0 for name, own in zip(levels, weights, strict=True)]
    # What a weight of 0 anywhere above shuts out is no room for its ancestors either.
    able = leaves.withColumn("cap", F.when(reduce(and_, weighed), F.col("tokens").cast("double") * epochs).otherwise(0.0))
    usable = able.agg(F.sum("cap").alias("cap")).first()["cap"] or 0.0
    above, parent = None, []
    for depth, name in enumerate(levels):
        path = levels[: depth + 1]
        nodes = able.groupBy(*path).agg(F.sum("cap").alias("cap"))
        nodes = nodes.join(above, parent) if parent else nodes.withColumn("budget", F.lit(float(min(budget, usable))))
        nodes = nodes.withColumns({"weight": _weight(F.col(name), weights[depth]), "name": F.col(name)})
        above = materialize(_filled(nodes, parent).select(*path, F.col("given").alias("budget")), "budgets")
        parent = path
    return leaves.join(above.withColumn("budget", F.floor(F.col("budget") + 1e-6).cast("bigint")), levels)


def _order(seed: int, epoch: Column, ident: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), ident).cast("binary"))


def _name(value: Column) -> Column:
    """A level's value as text; null is a name of its own."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("null"))


def _plan(df, levels, weights, budget, epochs, seed, id_column, tokens):
    """Thin rows, and per leaf its whole epochs and the place up to which one more is taken."""
    names = [f"level{i}" for i in range(len(levels))]
    named = [{f"={k}": v for k, v in w.items()} for w in weights]
    thin = thin_rows(
        df, None, "mix-rows",
        **{n: _name(v) for n, v in zip(names, levels, strict=True)},
        tokens=tokens, ident=F.coalesce(column(id_column).cast("string"), F.lit("")),
    )
    leaves = materialize(thin.groupBy(*names).agg(F.sum("tokens").alias("tokens")), "leaves")
    total = leaves.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    amount = budget * total if isinstance(budget, float) else float(budget)
    given = materialize(
        budgets(leaves, names, named, amount, epochs).select(
            *names, "tokens", "budget",
            F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.greatest("tokens", F.lit(1)))).otherwise(0).cast("bigint").alias("epochs"),
        ),
        "leaf-budgets",
    )
    rest = given.select(*names, "epochs", (F.col("budget") - F.col("epochs") * F.col("tokens")).alias("left"))
    some = rest.filter("left > 0")
    side = F.broadcast(some) if some.count() <= BROADCAST_LEAVES else some
    keyed = thin.join(side, names).withColumn("key", _order(seed, F.col("epochs"), F.col("ident")))
    keyed = keyed.withColumn("bucket", F.substring("key", 1, _BUCKET_DIGITS))
    # Running tokens inside a bucket of the order, on top of the buckets before it.
    sums = keyed.groupBy(*names, "bucket").agg(F.sum("tokens").alias("sum"))
    earlier = Window.partitionBy(*names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(*names, "bucket", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy(*names, "bucket").orderBy("key", "ident")  # rows of one id together
    placed = keyed.withColumn("inside", F.sum("tokens").over(inside)).join(bases, [*names, "bucket"])
    cuts = (
        placed.filter("base + inside <= left").groupBy(*names).agg(F.max(F.struct("key", "ident")).alias("cut"))
    )
    return names, materialize(rest.join(cuts, names, "left"), "leaf-cuts")


def mixed(
    df: DataFrame,
    levels: list[Column],
    weights: list[dict[str, float]],
    budget: int | float,
    epochs: int = EPOCHS,
    seed: int = 42,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows of ``df`` taken, with all columns, and ``epoch`` (from 0): a row for each use.

    ``levels`` gives a row's path from the root, ``weights`` the weights of each level's
    values (1 where none is given). ``budget`` is a number of words, or a float for a
    multiple of the words there are. A leaf takes whole epochs while its budget holds one
    and then the longest prefix of the next epoch's order whose words fit.

    Texts without words use no budget: they come with every epoch, and with the last one
    where the order puts them inside its prefix. Rows of one id in a leaf are taken
    together. Null ids count as one id, a null level value is a node of its own, null texts
    have no words. An empty table gives no rows. Every leaf is spread over buckets of
    the order, so a leaf may hold any share of the rows; texts are not shuffled unless
    there are more leaves than ``BROADCAST_LEAVES``.
    """
    tokens = word_count(column(text_column))
    names, cuts = _plan(df, levels, weights, budget, epochs, seed, id_column, tokens)
    leaf = {f"_mix_{n}": _name(v) for n, v in zip(names, levels, strict=True)}
    chosen = cuts.select(*[F.col(n).alias(f"_mix_{n}") for n in names], F.col("epochs").alias("_mix_epochs"), F.col("cut").alias("_mix_cut"))
    side = F.broadcast(chosen) if cuts.count() <= BROADCAST_LEAVES else chosen
    ident = F.coalesce(column(id_column).cast("string"), F.lit(""))
    here = F.struct(_order(seed, F.col("_mix_epochs"), ident).alias("key"), ident.alias("ident"))
    more = F.coalesce(here <= F.col("_mix_cut"), F.lit(False)).cast("bigint")
    uses = df.withColumns(leaf).join(side, list(leaf)).withColumn("_mix_uses", F.col("_mix_epochs") + more)
    taken = uses.filter("_mix_uses > 0").withColumn("_mix_epoch", F.explode(F.sequence(F.lit(0), F.col("_mix_uses").cast("int") - 1)))
    return taken.select(*[column(c) for c in df.columns], F.col("_mix_epoch").alias("epoch"))
