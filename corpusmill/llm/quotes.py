"""Conversations in reply order, with quoted passages linked to their originals and removed.

Lines are parsed for their quote level. Consecutive lines of one level, without blank
lines, form a passage; its words are hashed and looked up among the passages that earlier
messages of the conversation wrote themselves. The originals found give each message its
parent, the parents give threads, and the messages are returned thread by thread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import column, numbered, rank_within
from corpusmill.session import materialize

# The quote mark at the start of a line, and the line that announces a quote.
MARKS = r"^[ \t]*(?:>[ \t]*)+"
QUOTED_LINE = r"(?m)^[ \t]*>.*(?:\n|\z)"
ANNOUNCEMENT = r"(?m)^On [^\n]* wrote:[ \t]*\n(?=[ \t]*>)"
_TURNS = 1024


def _coarse(turn: Column) -> Column:
    return F.floor(turn / F.lit(_TURNS))


def passages(messages: DataFrame) -> DataFrame:
    """``row, conv, turn, level, hash`` of every passage of ``row, conv, turn, text``."""
    body = F.regexp_replace("text", ANNOUNCEMENT, "")
    lines = messages.select("row", "conv", "turn", F.posexplode(F.split(body, "\n", -1)).alias("n", "line"))
    marks = F.regexp_extract("line", MARKS, 0)
    lines = lines.select(
        "row", "conv", "turn", "n",
        F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
        F.trim(F.regexp_replace(F.regexp_replace("line", MARKS, ""), r"\s+", " ")).alias("words"),
    )
    # A window over one message: never larger than its text.
    by_line = Window.partitionBy("row").orderBy("n")
    starts = (
        (F.col("words") == "")
        | F.lag("words", 1, "").over(by_line).eqNullSafe("")
        | (F.lag("level").over(by_line) != F.col("level"))
    )
    runs = lines.withColumn("run", F.sum(starts.cast("int")).over(by_line)).filter("words != ''")
    inside = F.transform(F.array_sort(F.collect_list(F.struct("n", "words"))), lambda x: x["words"])
    return runs.groupBy("row", "conv", "turn", "level", "run").agg(
        F.md5(F.lower(F.array_join(inside, " ")).cast("binary")).alias("hash")
    ).drop("run")


def _last_before(originals: DataFrame, quotes: DataFrame) -> DataFrame:
    """Quotes with ``source``: the latest earlier original of the same conversation and hash.

    Turns are cut into stretches; a window sorts one stretch of one passage, and one row
    per stretch carries the last original of the stretches before.
    """
    key = ["conv", "hash", "coarse"]
    said = originals.select("conv", "hash", "turn", "row", F.lit(0).alias("level"))
    events = said.unionByName(quotes.select("conv", "hash", "turn", "row", "level"))
    events = events.withColumn("coarse", _coarse(F.col("turn")))
    mine = F.when(F.col("level") == 0, F.struct("turn", "row"))
    stretch = Window.partitionBy(*key).orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    earlier = (
        Window.partitionBy("conv", "hash").orderBy("coarse").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = events.groupBy(*key).agg(F.max(mine).alias("last")).select(
        F.col("conv").alias("c"), F.col("hash").alias("h"), F.col("coarse").alias("k"),
        F.max("last").over(earlier).alias("carried"),
    )
    found = events.withColumn("near", F.max(mine).over(stretch)).filter("level > 0")
    return found.join(
        carried,
        F.col("conv").eqNullSafe(F.col("c")) & (F.col("hash") == F.col("h")) & (F.col("coarse") == F.col("k")),
    ).select("row", "level", F.coalesce("near", "carried").alias("source")).filter("source is not null")


def parents(messages: DataFrame) -> DataFrame:
    """``row, parent``: whom a message answers, for those that quote an earlier message.

    The quotes of the lowest level that has any original decide; among their originals
    the one with most quoted passages wins, then the latest.
    """
    found = materialize(passages(messages), "passages")
    quotes = found.filter("level > 0")
    asked = quotes.select("conv", "hash").distinct()
    originals = found.filter("level = 0").alias("o").join(
        asked.alias("q"),
        F.col("o.conv").eqNullSafe(F.col("q.conv")) & (F.col("o.hash") == F.col("q.hash")),
        "left_semi",
    )
    votes = _last_before(originals, quotes).groupBy("row", "level", "source").agg(F.count("*").alias("votes"))
    choice = F.struct("level", -F.col("votes"), -F.col("source.turn"), -F.col("source.row"))
    return votes.groupBy("row").agg(F.min_by("source.row", choice).alias("parent"))


def _roots(links: DataFrame) -> DataFrame:
    """``row, root, depth`` of rows that have a parent, by doubling the steps looked ahead."""
    ahead = materialize(links.select("row", F.col("parent").alias("root"), F.lit(1).alias("depth")), "threads")
    while True:
        further = ahead.select(F.col("row").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        joined = ahead.join(further, "root", "left")
        ahead = materialize(
            joined.select(
                "row",
                F.coalesce("next", "root").alias("root"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "threads",
        )
        if ahead.filter("moved").isEmpty():
            return ahead.drop("moved")
        ahead = ahead.drop("moved")


def reply_ordered(
    df: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per message: ``conv_id, turn, role, text, parent_turn, thread_turn, depth, position``.

    ``text`` is without quoted lines and without the lines that announce them; ``parent_turn``
    is null for a message that starts a thread. A conversation is ordered by the turn that
    starts each thread, then by turn, so that a reply never comes before its parent;
    ``position`` counts from 0. Null text is an empty message. A null turn comes after all
    others, null conversations form one conversation. Repeated rows stay, one after the
    other. An original must be of an earlier turn, so equal turns never answer each other.
    A quote without an original is removed and links nothing. An empty table gives no rows.
    """
    last = F.lit(2**62)
    messages = numbered(
        df.select(
            column(conversation).alias("conv"),
            F.coalesce(column(turn).cast("bigint"), last).alias("turn"),
            column(turn).alias("turn_given"),
            column(role).alias("role"),
            F.coalesce(column(text), F.lit("")).alias("text"),
        ),
        "row",
        "messages",
    )
    links = materialize(parents(messages), "parents")
    threads = _roots(links).join(links, "row")
    turns = messages.select("row", "turn")
    threads = threads.join(turns.toDF("root", "root_turn"), "root").join(turns.toDF("parent", "parent_turn"), "parent")
    joined = messages.join(threads, "row", "left").withColumns(
        {"root_turn": F.coalesce("root_turn", "turn"), "root": F.coalesce("root", "row")}
    )
    placed = rank_within(
        materialize(joined, "threaded"), ["conv"], ["root_turn", "root", "turn", "row"], _coarse(F.col("root_turn")), "position"
    )
    plain = F.regexp_replace(F.regexp_replace("text", ANNOUNCEMENT, ""), QUOTED_LINE, "")
    return placed.select(
        F.col("conv").alias("conv_id"),
        F.col("turn_given").alias("turn"),
        "role",
        F.trim(F.regexp_replace(plain, r"^\s+|\s+\z", "")).alias("text"),
        F.nullif("parent_turn", last).cast("bigint").alias("parent_turn"),
        F.nullif("root_turn", last).cast("bigint").alias("thread_turn"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
        "position",
    )


def as_mail(df: DataFrame) -> DataFrame:
    """Conversations written as mail: each turn quotes what it answers, which quotes in turn.

    A turn answers the turn before it, every fourth the one three before; used to give
    :func:`reply_ordered` tables that hold no quotes yet.
    """
    by_turn = Window.partitionBy("conv_id").orderBy("turn")
    own = F.coalesce(F.col("text"), F.lit(""))
    mark = lambda c, m: F.regexp_replace(c, "(?m)^", m)
    back = F.when(F.col("turn") % 4 == 3, 3).otherwise(1)
    near, far = F.lag(own, 1).over(by_turn), F.lag(own, 3).over(by_turn)
    told = F.when(back == 3, far).otherwise(near)
    older = F.when((back == 1) & (F.col("turn") % 4 == 2), F.lag(own, 2).over(by_turn))
    return df.withColumn(
        "text",
        F.concat(
            own,
            F.coalesce(F.concat(F.lit("\n\nOn the day before you wrote:\n"), mark(told, "> ")), F.lit("")),
            F.coalesce(F.concat(F.lit("\n"), mark(older, "> > ")), F.lit("")),
        ),
    )
