"""Reply trees to chat texts: root-to-leaf paths, ranked branches, one conversation per chosen path.

Messages point to the message they answer. Self-joins that double the distance give every message its root, its depth and
the score of its path in about log2(depth) rounds; the same tables, read backwards, give the messages on the paths of the
chosen leaves. So no path is built for a leaf that is not chosen, and what is shuffled is ids and counts, not texts. Each
round is stored, which keeps lineage short. Everything is joins and SQL functions.

Leaves of a tree are ranked by the mean score of their path, then by depth, then by id; ``branches`` of them are chosen.

The template is ``<|im_start|>role``, newline, text, ``<|im_end|>``, newline. Control strings inside of roles and texts
are escaped: every ``<`` with any number of backslashes and a ``|`` gets one more backslash, which is undone by taking
one away. In roles, backslash and newline are escaped too. The loss mask is a list of (start, length) in code points of
the formatted text and covers the texts of ``assistant``, without their markers.

A conversation is one text in the end, so it is put together in one task; nothing else is.

Defined results: a NULL text is empty, a NULL role is the empty role, a NULL score counts as 0; a link to a missing
message, to itself or to a message that is not earlier is no link, so such a message is a root and there are no cycles;
rows that repeat an id count once, the first by content; NULL ids are left out (there is nothing to answer to); an empty
table gives no conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

# The markers of a turn.
START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    plain = F.coalesce(role, F.lit(""))
    return escape(F.replace(F.replace(plain, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(text: Column) -> Column:
    parts = F.split(unescape(text), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\")


def _links(messages: DataFrame) -> DataFrame:
    """(id, up, score): one row per message, up NULL for roots. ``messages``: id, parent, place, score."""
    first = messages.where("id is not null").groupBy("id").agg(F.min(F.struct("place", "parent", "score")).alias("m"))
    nodes = first.select("id", "m.place", "m.parent", F.coalesce("m.score", F.lit(0.0)).cast("double").alias("score"))
    parents = nodes.select(F.col("id").alias("up"), F.col("place").alias("up_place"))
    # roots have no part in the join, where they would all meet in the task of the NULL key
    joined = nodes.where("parent is not null").join(parents, F.col("parent") == F.col("up"), "left")
    earlier = F.when(F.col("up_place") < F.col("place"), F.col("up")).alias("up")
    roots = nodes.where("parent is null").select("id", F.lit(None).cast(nodes.schema["id"].dataType).alias("up"), "score")
    return joined.select("id", earlier, "score").unionByName(roots)


def _climb(links: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(id, root, steps, total) of every message, and tables k = 0, 1, ... with the message 2^k steps above (id, up).

    Table k holds the messages that are that deep; the others have met their root and take no further part, so all tables
    together have as many rows as there are messages, times the log of their mean depth.
    """
    nowhere = F.lit(None).cast(links.schema["id"].dataType)
    done = links.where("up is null").select("id", F.col("id").alias("root"), F.lit(0).cast("long").alias("steps"), F.col("score").alias("total"))
    level = links.where("up is not null").select("id", "up", F.lit(1).cast("long").alias("steps"), F.col("score").alias("total"))
    tables = []
    while not level.isEmpty():
        tables.append(level.select("id", "up"))
        names = ("a_id", "a_up", "a_root", "a_steps", "a_total")
        above = done.select("id", nowhere, "root", "steps", "total").toDF(*names).unionByName(
            level.select("id", "up", nowhere, "steps", "total").toDF(*names)
        )
        climbed = stored(
            level.join(above, F.col("up") == F.col("a_id")).select(
                "id", F.col("a_up").alias("up"), F.col("a_root").alias("root"),
                (F.col("steps") + F.col("a_steps")).alias("steps"), (F.col("total") + F.col("a_total")).alias("total"),
            ),
            "climbed",
        )
        done = done.unionByName(climbed.where("root is not null").drop("up"))
        level = climbed.where("up is not null").drop("root")
    return done, tables


def chosen_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(leaf, root, rank, id, depth): the messages of the ``branches`` best paths of each tree; depth counts from 0.

    ``messages`` has id, parent, place (what comes earlier is lower) and score.
    """
    links = stored(_links(messages), "links")
    whole, tables = _climb(links)
    answered = links.where("up is not null").select(F.col("up").alias("id")).distinct()
    leaves = whole.join(answered, "id", "left_anti").select("id", "root", "steps", (F.col("total") / (F.col("steps") + 1)).alias("mean"))
    # the best leaves of a tree by repeated maxima, which are partial aggregates; a tree may have any number of leaves
    order = F.struct("mean", "steps", "id")
    best, left = None, leaves
    for rank in range(1, branches + 1):
        top = left.groupBy("root").agg(F.max(order).alias("m")).select("root", F.lit(rank).alias("rank"), "m.id", "m.steps")
        top = stored(top, "leaves")
        best = top if best is None else best.unionByName(top)
        if rank < branches:
            left = left.join(top.select("id"), "id", "left_anti")
    path = best.select(F.col("id").alias("leaf"), "root", "rank", "id", F.col("steps").alias("depth"))
    for k, jump in enumerate(tables):
        step = jump.select(F.col("id").alias("j_id"), "up")
        above = path.join(step, F.col("id") == F.col("j_id")).select(
            "leaf", "root", "rank", F.col("up").alias("id"), (F.col("depth") - 2**k).alias("depth")
        )
        path = stored(path.unionByName(above), "paths")
    return path


def format_turns(turns: DataFrame) -> DataFrame:
    """(key, formatted, loss) from (key, at, role, text): one row per key, turns in the order of ``at``."""
    role = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    text = escape(F.col("text"))
    pieces = turns.select(
        "key", "at", role.alias("head"), text.alias("body"),
        (F.coalesce("role", F.lit("")) == "assistant").alias("learn"),
    ).withColumn("piece", F.concat("head", "body", F.lit(END + "\n")))
    before = F.sum(F.length("piece")).over(Window.partitionBy("key").orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce(before, F.lit(0)) + F.length("head")
    placed = pieces.withColumn(
        "span", F.when(F.col("learn"), F.struct(start.cast("long").alias("start"), F.length("body").cast("long").alias("length")))
    ).select("key", "at", "piece", "span")
    gathered = placed.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("at", "piece", "span"))).alias("rows"))
    return gathered.select(
        "key",
        F.array_join(F.transform("rows", lambda r: r.piece), "").alias("formatted"),
        F.filter(F.transform("rows", lambda r: r.span), lambda s: s.isNotNull()).alias("loss"),
    )


def format_reply_trees(messages: DataFrame, branches: int = 1) -> DataFrame:
    """One row per chosen path: root, leaf, rank, formatted, loss.

    ``messages`` has id, parent, place, score, role and text.
    """
    paths = chosen_paths(messages.select("id", "parent", "place", "score"), branches)
    texts = messages.where("id is not null").groupBy(F.col("id").alias("t_id")).agg(
        F.min(F.struct("place", "parent", "score", "role", "text")).alias("m")
    )
    turns = paths.join(texts, F.col("id") == F.col("t_id")).select(
        F.struct("root", "leaf", "rank").alias("key"), F.col("depth").alias("at"), "m.role", "m.text"
    )
    return format_turns(turns).select("key.root", "key.leaf", "key.rank", "formatted", "loss")


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text) and ``learned`` (all text under the loss mask, unescaped) to formatted rows."""
    blocks = F.filter(F.split("formatted", r"<\|im_end\|>\n", -1), lambda x: x != "")
    body = F.transform(blocks, lambda x: F.substr(x, F.lit(len(START) + 1)))
    turns = F.transform(
        body,
        lambda x: F.struct(
            unescape_role(F.substring_index(x, "\n", 1)).alias("role"),
            unescape(F.substr(x, F.instr(x, "\n") + 1)).alias("text"),
        ),
    )
    learned = F.transform("loss", lambda s: unescape(F.substr("formatted", (s.start + 1).cast("int"), s.length.cast("int"))))
    return formatted.withColumn("turns", turns).withColumn("learned", F.array_join(learned, ""))


def conversation_trees(conversations: DataFrame) -> DataFrame:
    """Messages of linear conversations (conv_id, turn, role, text): each turn answers the one before.

    A turn is known by its place in the order of turn (NULL first), role and text; rows that are equal stay apart.
    """
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = conversations.select("conv_id", "turn", "role", "text").withColumn("place", F.row_number().over(in_order))
    conv = F.struct(F.col("conv_id").isNull().alias("none"), F.coalesce("conv_id", F.lit(0)).alias("conv"))
    # an id that is never NULL, so that turns without a conversation form one of their own
    return placed.select(
        F.struct(conv.alias("c"), F.col("place").alias("n")).alias("id"),
        F.when(F.col("place") > 1, F.struct(conv.alias("c"), (F.col("place") - 1).alias("n"))).alias("parent"),
        "place", F.lit(0.0).alias("score"), "role", "text",
    )


def conversation_digests(conversations: DataFrame) -> DataFrame:
    """One row per conversation, read back from its formatted text: counts and digests of turns and of the loss mask."""
    back = read_back(format_reply_trees(conversation_trees(conversations)))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return back.select(
        F.when(~F.col("root.c.none"), F.col("root.c.conv")).alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
