"""Quotation linking for chat logs.

Lines that begin with ``>`` marks are quoted, one level a mark.  Consecutive
lines of one level are a passage; a quoted passage is normalised (case, marks,
punctuation and space left out) and hashed.  Hashes are joined to the earliest
message that says the passage unquoted, in the same conversation or else in the
other one of smallest conv_id (conversations are not ordered in time).  A message says
each of its passages, each line and each run of consecutive lines; runs are made
only where a quoted passage begins with their first line, in that passage's length.
A message replies to what its first quoted level-one passage links to, or else
to the message before it; threads follow the explicit links to their first
message.  Rows come with a reply order and text without quotes.  DataFrame
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import stored


def level(line: Column) -> Column:
    """Number of quote marks before the line's text."""
    marks = F.regexp_extract(line, r"^[ \t]*((?:>[ \t]*)*)", 1)
    return F.char_length(marks) - F.char_length(F.translate(marks, ">", ""))


def unquoted(line: Column) -> Column:
    return F.regexp_replace(line, r"^[ \t]*(?:>[ \t]*)+", "")


def normal(text: Column) -> Column:
    """Lower case, runs of anything but letters and digits as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def passages(text: Column) -> Column:
    """array<struct<level, text>>: the text's lines, consecutive ones of one level joined."""
    lines = F.transform(F.split(text, "\r?\n"), lambda x: F.struct(level(x).alias("level"), unquoted(x).alias("text")))
    empty = F.array().cast("array<struct<level:int,text:string>>")

    def add(acc, x):
        last = F.element_at(acc, -1)
        same = (F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["level"] == x["level"])
        return F.when(same, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
            last["level"].alias("level"), F.concat(last["text"], F.lit("\n"), x["text"]).alias("text"))))).otherwise(
            F.concat(acc, F.array(x)))

    plain = F.array(F.struct(F.lit(0).alias("level"), text.alias("text")))
    return F.when(text.isNull(), empty).when(~text.contains(">"), plain).otherwise(F.aggregate(lines, empty, add))


def lines(text: Column) -> Column:
    """The normalised lines that aren't empty."""
    return F.filter(F.transform(F.split(text, "\r?\n"), normal), lambda x: x != "")


def runs(text: Column, first: Column, lengths: Column) -> Column:
    """Hashes of the runs of so many lines that begin with a line of hash ``first``."""
    def of(said):
        starts = F.filter(F.sequence(F.lit(1), F.size(said)), lambda i: F.xxhash64(F.get(said, i - 1)) == first)
        return F.flatten(F.transform(starts, lambda i: F.transform(
            F.filter(lengths, lambda n: i + n - 1 <= F.size(said)), lambda n: F.xxhash64(F.array_join(F.slice(said, i, n), " ")))))
    return F.array_distinct(F.flatten(F.transform(F.array(lines(text)), of)))


def link_quotations(messages: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                    text: str = "text") -> DataFrame:
    """(conv_id, turn, role, body, n_quotes, n_linked, reply_conv, reply_turn, quoted, thread_conv,
    thread_turn, depth) for every row of ``messages``.

    ``body`` is the text without quoted lines; ``quoted`` lists the links (level,
    conv_id, turn); thread_* is the first message of the thread, depth the number
    of quote links to it: (thread_conv, thread_turn, conv_id, turn) orders replies after
    what they answer.  Quotes of passages that no earlier message of the conversation
    and no message of another one says, and empty ones, stay unlinked; so do lines
    quoted only in part.  Links between conversations may close a circle: its
    smallest (conv_id, turn) begins the thread.  Null texts have no passages; a null conv_id or turn
    neither links nor is linked to; rows that repeat a (conv_id, turn) get equal
    links; other columns are not read; an empty table gives an empty result."""
    rows = stored(messages.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"),
        passages(F.col(text).cast("string")).alias("passages")), "messages")
    each = (rows.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
            .select("conv_id", "turn", F.posexplode("passages").alias("place", "p"))
            .select("conv_id", "turn", "place", "p.level", F.when(F.col("p.level") > 0, F.col("p.text")).alias("passage"), F.explode(F.array_distinct(F.when(
                F.col("p.level") == 0, F.concat(F.array(normal(F.col("p.text"))), F.transform(F.split("p.text", "\r?\n"), normal)))
                .otherwise(F.array(normal(F.col("p.text")))))).alias("words"))
            .where("words <> ''").withColumn("hash", F.xxhash64("words")))
    quoted = stored(each.where("level > 0").withColumn("lines", lines(F.col("passage"))), "quoted")
    # only passages that someone quotes are looked for; the earliest sayer is an aggregate
    several = F.size("lines") > 1
    wanted = (quoted.select("hash", F.lit(True).alias("whole"), F.lit(None).cast("int").alias("n"))
              .unionByName(quoted.where(several).select(F.xxhash64(F.get("lines", F.lit(0))).alias("hash"), F.lit(False).alias("whole"), F.size("lines").alias("n")))
              .groupBy("hash").agg(F.max("whole").alias("whole"), F.collect_set("n").alias("lengths")))
    found = stored(each.where("level = 0").select("conv_id", "turn", "place", "hash").join(wanted, "hash"), "said")
    begun = (found.where(F.size("lengths") > 0)
             .join(rows.select("conv_id", "turn", "passages"), ["conv_id", "turn"])
             .select("conv_id", "turn", F.explode(runs(F.get("passages", F.col("place"))["text"], F.col("hash"), F.col("lengths"))).alias("hash")))
    said = (found.where("whole").select("conv_id", "turn", "hash")
            .unionByName(begun.join(quoted.where(several).select("hash").distinct(), "hash", "left_semi").select("conv_id", "turn", "hash")))
    here = stored(said.groupBy("hash", "conv_id").agg(F.min("turn").alias("own_turn")), "sayers")
    first = here.groupBy("hash").agg(F.min(F.struct("conv_id", F.col("own_turn").alias("turn"))).alias("first"))
    second = (here.join(first, "hash").where("conv_id <> first.conv_id")
              .groupBy("hash").agg(F.min(F.struct("conv_id", F.col("own_turn").alias("turn"))).alias("second")))
    linked = (quoted.drop("passage", "lines").join(here, ["hash", "conv_id"], "left").join(first, "hash", "left").join(second, "hash", "left")
              .withColumn("to", F.when(F.col("own_turn") < F.col("turn"), F.struct("conv_id", F.col("own_turn").alias("turn")))
                          .when(F.col("first.conv_id") != F.col("conv_id"), F.col("first")).otherwise(F.col("second"))))
    links = (linked.groupBy("conv_id", "turn")
             .agg(F.countDistinct("place").cast("long").alias("n_quotes"),
                  F.countDistinct(F.when(F.col("to").isNotNull(), F.col("place"))).cast("long").alias("n_linked"),
                  F.min(F.when(F.col("to").isNotNull(), F.struct("level", "place", "to"))).alias("best"),
                  F.array_sort(F.collect_set(F.when(F.col("to").isNotNull(), F.struct(
                      "level", F.col("to.conv_id").alias("conv_id"), F.col("to.turn").alias("turn"))))).alias("quoted")))
    links = stored(links.select("conv_id", "turn", "n_quotes", "n_linked", "quoted", F.col("best.to").alias("to")), "links")
    threads = _threads(links.where("to is not null").select(F.struct("conv_id", "turn").alias("node"), "to"))
    body = F.array_join(F.transform(F.filter("passages", lambda p: p["level"] == 0), lambda p: p["text"]), "\n")
    out = (rows.join(links, ["conv_id", "turn"], "left")
           .join(threads.select("node.conv_id", "node.turn", "root", "depth"), ["conv_id", "turn"], "left"))
    return out.select(
        "conv_id", "turn", "role", F.when(F.size("passages") > 0, body).alias("body"),
        F.coalesce("n_quotes", F.lit(0).cast("long")).alias("n_quotes"), F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"),
        F.coalesce("to.conv_id", F.when(F.col("turn") > 0, F.col("conv_id"))).alias("reply_conv"),
        F.coalesce("to.turn", F.when(F.col("turn") > 0, F.col("turn") - 1)).alias("reply_turn"),
        F.coalesce("quoted", F.array().cast(dict(links.dtypes)["quoted"])).alias("quoted"),
        F.coalesce("root.conv_id", "conv_id").alias("thread_conv"), F.coalesce("root.turn", "turn").alias("thread_turn"),
        F.coalesce("depth", F.lit(0).cast("long")).alias("depth"))


def _threads(links: DataFrame) -> DataFrame:
    """(node, root, depth): links followed to their end, twice as far each round.  Inside a
    conversation a link leads to an earlier message; where links between conversations close
    a circle, its smallest message is the end, and its own link is not followed."""
    def followed(now: DataFrame, most: int) -> tuple[DataFrame, DataFrame | None]:
        """Everything followed, or after over ``most`` steps the rows that still move."""
        steps = 1
        while True:
            next_ = now.select(F.col("node").alias("root"), F.col("root").alias("further"), F.col("depth").alias("more"), F.col("least").alias("other"))
            step = stored(now.join(next_, "root", "left").select(
                "node", F.coalesce("further", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.least("least", "other").alias("least"), F.col("further").isNotNull().alias("moved")), "threads")
            moving = step.where("moved")
            if moving.isEmpty():
                return now, None
            now, steps = step.drop("moved"), 2 * steps
            if steps > most:
                return now, moving

    start = stored(links.select("node", F.col("to").alias("root"), F.lit(1).cast("long").alias("depth"), F.least("node", "to").alias("least")), "threads")
    now, moving = followed(start, start.select("node").distinct().count())
    if moving is not None:
        # as many steps as links end on a circle, and from there the least of all on it has been met
        ends = moving.select(F.col("root").alias("node")).distinct()
        cut = now.join(ends, "node", "left_semi").select(F.col("least").alias("node")).distinct()
        start = stored(start.join(cut, "node", "left_anti"), "threads")
        now, _ = followed(start, start.count() * 2 + 2)
    return now.drop("least")
