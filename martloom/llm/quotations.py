"""Reply order from quotations: who quotes whom, and the conversations without their quotes.

Lines that start with quote marks (``>``, ``> >``) belong to quoted passages of that level. Every
passage is normalised and hashed, and so is what each message says itself, as a whole and line by
line; equal hashes link the passage to the message that said it first, in the same conversation if
there is one, else anywhere. The least nested linked passage names the message replied to, and
following these links gives each message its root and depth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import stored

MARKS = r"^(?:[ \t]*>)+ ?"
SPACE = r"[\x20\x09-\x0D]+"


def normal(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, SPACE, " ")))


def as_mail(turns: DataFrame) -> DataFrame:
    """The turns (conv_id, turn, text) as mails: each quotes the turn before it and what that one
    quoted of its own predecessor; every third turn quotes only the first line."""
    turns = turns.select("conv_id", "turn", "text")
    said = turns.groupBy("conv_id", "turn").agg(F.min("text").alias("said"))

    def before(steps: int) -> DataFrame:
        return said.select(
            F.col("conv_id").alias(f"c{steps}"),
            (F.col("turn") + steps).alias(f"t{steps}"),
            F.col("said").alias(f"said{steps}"),
        )

    def quoted(text: Column, marks: str) -> Column:
        return F.concat(F.lit(marks), F.replace(text, F.lit("\n"), F.lit("\n" + marks)), F.lit("\n"))

    joined = turns
    for steps in (1, 2):
        side = before(steps)
        on = (turns["conv_id"] == side[f"c{steps}"]) & (turns["turn"] == side[f"t{steps}"])
        joined = joined.join(side, on, "left")
    last = F.when(F.col("turn") % 3 == 2, F.element_at(F.split("said1", "\n"), 1)).otherwise(F.col("said1"))
    mail = F.concat(
        F.coalesce(quoted(F.col("said2"), "> > "), F.lit("")),
        F.coalesce(quoted(last, "> "), F.lit("")),
        F.coalesce("text", F.lit("")),
    )
    return joined.select("conv_id", "turn", mail.alias("text"))


def parsed(messages: DataFrame) -> DataFrame:
    """row, conv_id, turn, own (the text without quotes), passages (level, whole, first line)."""
    rows = messages.select(
        messages["conv_id"].cast("long"),
        messages["turn"].cast("long"),
        F.split(F.coalesce(messages["text"], F.lit("")), "\n").alias("_lines"),
    )

    def read(line: Column) -> Column:
        marks = F.regexp_extract(line, MARKS, 0)
        return F.struct(
            F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
            F.substring(line, F.length(marks) + 1, F.length(line)).alias("said"),
        )

    lines = rows.withColumn("_read", F.transform("_lines", read)).drop("_lines")
    # Places where the level changes; a passage runs from one to the next.
    edges = F.filter(
        F.sequence(F.lit(0), F.size("_read") - 1),
        lambda i: (i == 0) | (F.get("_read", i)["level"] != F.get("_read", i - 1)["level"]),
    )
    marked = lines.withColumn("_edges", edges)
    runs = F.transform(
        "_edges",
        lambda e, k: F.struct(
            F.get("_read", e)["level"].alias("level"),
            F.transform(
                F.slice("_read", e + 1, F.coalesce(F.get("_edges", k + 1), F.size("_read")) - e),
                lambda line: line["said"],
            ).alias("lines"),
        ),
    )
    passages = F.transform(
        F.filter("_runs", lambda r: r["level"] > 0),
        lambda r: F.struct(
            r["level"].alias("level"),
            normal(F.array_join(r["lines"], " ")).alias("whole"),
            normal(F.get(r["lines"], F.lit(0))).alias("first"),
        ),
    )
    own = F.flatten(
        F.transform(F.filter("_runs", lambda r: r["level"] == 0), lambda r: r["lines"])
    )
    return marked.withColumn("_runs", runs).select(
        F.monotonically_increasing_id().alias("row"),
        "conv_id",
        "turn",
        F.array_join(own, "\n").alias("own"),
        F.filter(passages, lambda p: p["whole"] != "").alias("passages"),
    )


def first_said(messages: DataFrame) -> DataFrame:
    """conv_id, turn, said: hashes of each parsed message's own text and of its lines."""
    whole = normal(F.regexp_replace("own", "\n", " "))
    texts = F.concat(F.array(whole), F.transform(F.split("own", "\n"), normal))
    hashes = F.array_distinct(F.transform(F.filter(texts, lambda t: t != ""), lambda t: F.xxhash64(t)))
    return messages.select("conv_id", "turn", F.explode(hashes).alias("said"))


def links(messages: DataFrame) -> DataFrame:
    """row, place, level, to_conv, to_turn of every passage with an earlier original.

    A passage is looked up whole, then by its first line. Originals are reduced to the first
    message per conversation and hash, and per hash, before any join, so a sentence that many
    messages say or quote makes one row on that side.
    """
    said = first_said(messages).where("turn is not null and conv_id is not null")
    local = said.groupBy("conv_id", "said").agg(F.min("turn").alias("local_turn"))
    anywhere = said.groupBy("said").agg(F.min(F.struct("conv_id", "turn")).alias("origin"))
    quotes = messages.select("row", "conv_id", "turn", F.posexplode("passages").alias("place", "p"))
    asked = quotes.select(
        "row", "conv_id", "turn", "place", F.col("p.level").alias("level"),
        F.posexplode(F.array(F.xxhash64("p.whole"), F.xxhash64("p.first"))).alias("how", "said"),
    )
    met = asked.join(local, ["conv_id", "said"], "left").join(anywhere, "said", "left")
    here = F.col("local_turn") < F.col("turn")
    me = F.struct("conv_id", "turn")
    other = F.col("origin.conv_id") != F.col("conv_id")
    target = F.when(here, F.struct("conv_id", F.col("local_turn").alias("turn"))).when(
        other & (F.col("origin") < me), F.col("origin")
    )
    # Own conversation before others, the whole passage before its first line.
    rank = F.struct(F.coalesce(~here, F.lit(True)).alias("far"), "how", target.alias("to"))
    best = (
        met.withColumn("rank", F.when(target.isNotNull(), rank))
        .groupBy("row", "place", "level").agg(F.min("rank").alias("best"))
    )
    return best.where("best is not null").select(
        "row", "place", "level", F.col("best.to.conv_id").alias("to_conv"), F.col("best.to.turn").alias("to_turn")
    )


def rooted(replies: DataFrame) -> DataFrame:
    """node, root, depth of every node of the replies (node, parent); parents must be nodes, and
    smaller ones. Each round doubles the length of the ways known, and only nodes that have not
    reached their root yet take part in it."""
    root = F.col("parent").isNull()
    nodes = replies.select(
        "node",
        F.coalesce("parent", "node").alias("up"),
        F.when(root, 0).otherwise(1).cast("long").alias("steps"),
        root.alias("done"),
    )
    known = stored(nodes)
    finished, open_ = [known.where("done")], known.where("not done")
    while not open_.isEmpty():
        above = open_
        for part in finished:
            above = above.union(part)
        above = above.toDF("above", "up2", "steps2", "done2")
        moved = stored(
            open_.join(above, open_["up"] == above["above"]).select(
                "node",
                F.col("up2").alias("up"),
                (F.col("steps") + F.col("steps2")).alias("steps"),
                F.col("done2").alias("done"),
            )
        )
        finished.append(moved.where("done"))
        open_ = moved.where("not done")
    whole = finished[0]
    for part in finished[1:]:
        whole = whole.union(part)
    return whole.select("node", F.col("up").alias("root"), F.col("steps").alias("depth"))


def reply_order(messages: DataFrame) -> DataFrame:
    """Every message without quotes, with what it replies to, its root and its depth below it.

    Output: conv_id, turn, own, n_passages, n_linked, reply_conv, reply_turn, root_conv, root_turn,
    depth; sorting by root, depth, conv_id, turn gives conversations in reply order. A null text is
    empty. Messages with a null conv_id or turn are originals of nothing and roots of themselves;
    repeated rows stay and count as one original; an empty table gives an empty one. Other columns
    are ignored.
    """
    rows = stored(parsed(messages))
    found = links(rows)
    per_row = stored(
        found.groupBy("row").agg(
            F.count("*").alias("n_linked"),
            # The least nested passage; of several, the latest message.
            F.min(
                F.struct("level", (-F.col("to_conv")).alias("c"), (-F.col("to_turn")).alias("t"))
            ).alias("best"),
        )
    )
    linked = rows.join(per_row, "row", "left").select(
        "conv_id", "turn", "own", F.size("passages").cast("long").alias("n_passages"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        (-F.col("best.c")).alias("reply_conv"), (-F.col("best.t")).alias("reply_turn"),
    )
    linked = stored(linked)
    known = linked.where("conv_id is not null and turn is not null")
    parent = F.when(F.col("reply_conv").isNotNull(), F.struct(F.col("reply_conv").alias("conv_id"), F.col("reply_turn").alias("turn")))
    replies = known.groupBy(F.struct("conv_id", "turn").alias("node")).agg(F.max(parent).alias("parent"))
    tops = rooted(replies)
    on = (linked["conv_id"] == tops["node.conv_id"]) & (linked["turn"] == tops["node.turn"])
    return linked.join(tops, on, "left").select(
        *linked.columns,
        F.coalesce("root.conv_id", "conv_id").alias("root_conv"),
        F.coalesce("root.turn", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0).cast("long")).alias("depth"),
    )
