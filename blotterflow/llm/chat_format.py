"""Chat formatting by perspective rotation.

Every participant of a conversation is the assistant once. In that rendering their
turns are the assistant's, the other speakers are users under their names, and system
turns stay system turns. Each turn becomes ``<|assistant|>`` (or ``<|system|>``, or
``<|user|> name:``), a line feed, the text, ``<|end|>`` and a line feed. The mask covers
what the assistant is to learn: the text and ``<|end|>`` of its turns.

A rendering is a row for each part: turns are numbered in their order and cut after every
``PART``, so that a conversation of any length, with whatever turn numbers, is no group of
unbounded size. For that, turns are dealt out by ranges of their order, and places in a
task become places in the conversation. Parts in order of ``part`` make up the whole rendering; ``begin`` says where a part starts in it, and ``spans`` are
places in the part, in characters. Sums over parts are counted before they are ordered.

Cases: a null text is empty. A turn without a role is a user without a name; it is a
participant under the empty name. Null turns stand first. Turns of equal
number are ordered by role and text; rows that repeat conversation, turn, role and text
are one turn. Rows without conversation are one conversation without id. A conversation
of system turns only has no rendering. An empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotterflow.llm.tables import discard, stored

PART = 256
#: So many characters of a text are read for dealing out turns; their order is by all.
HEAD = 64
SYSTEM = "system"
OWN_HEAD, SYSTEM_HEAD, USER_HEAD, USER_END, END = "<|assistant|>\n", "<|system|>\n", "<|user|> ", ":\n", "<|end|>"


def rotate_perspectives(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv_id, perspective, part, begin, n_turns, rendered and spans of every rendering."""
    has = F.col(conversation).isNotNull()
    given = turns.select(
        F.when(has, F.concat(F.lit("c"), F.col(conversation).cast("string"))).otherwise("").alias("conv_key"),
        F.col(conversation).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    # repeated rows are gone before the shuffle
    order = ["conv_key", "turn", "role"]
    dealt = given.distinct().repartitionByRange(*order, F.substring("text", 1, HEAD)).sortWithinPartitions(*order, "text")
    written = stored(dealt.withColumn("row", F.monotonically_increasing_id()), "turns")
    placed = written.withColumn("task", F.shiftright("row", 33))
    # a conversation's rows in one task have numbers in a row; short rows tell what stands before them
    runs = placed.groupBy("conv_key", "task").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_key").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.col("first") - F.coalesce(F.sum("n").over(earlier), F.lit(0))
    runs = stored(runs.select("conv_key", "task", zero.alias("zero")), "runs")
    numbered = placed.join(runs, ["conv_key", "task"]).withColumn("part", F.floor((F.col("row") - F.col("zero")) / PART))
    said = F.array_sort(F.collect_list(F.struct("row", "role", "text"))).alias("turns")
    parts = stored(numbered.groupBy("conv_key", "part").agg(F.any_value("conv_id").alias("conv_id"), said), "parts")
    discard(written, runs)

    def size(t):
        """The length of a turn that is another speaker's; an own turn is shorter by the difference of heads."""
        head = F.when(t["role"] == SYSTEM, len(SYSTEM_HEAD)).otherwise(len(USER_HEAD) + len(USER_END) + F.length(t["role"]))
        return head + F.length(t["text"]) + len(END) + 1

    lengths = parts.select(
        "conv_key",
        "part",
        F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + size(t)).alias("length"),
        F.transform("turns", lambda t: t["role"]).alias("roles"),
    )
    speakers = lengths.select("conv_key", F.explode(F.array_distinct("roles")).alias("perspective"))
    speakers = speakers.where(F.col("perspective") != SYSTEM).distinct()
    # short rows from here on: one for each part and rendering
    own = F.size(F.filter("roles", lambda r: r == F.col("perspective")))
    saved = len(USER_HEAD) + len(USER_END) + F.length("perspective") - len(OWN_HEAD)
    sized = lengths.join(speakers, "conv_key").select(
        "conv_key", "perspective", "part", (F.col("length") - own * saved).alias("length")
    )
    before = Window.partitionBy("conv_key", "perspective").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = sized.select("conv_key", "perspective", "part", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("begin"))

    def head(t):
        return (
            F.when(t["role"] == F.col("perspective"), OWN_HEAD)
            .when(t["role"] == SYSTEM, SYSTEM_HEAD)
            .otherwise(F.concat(F.lit(USER_HEAD), t["role"], F.lit(USER_END)))
        )

    pieces = F.transform(
        "turns",
        lambda t: F.struct(
            head(t).alias("head"), F.concat(t["text"], F.lit(END)).alias("body"), (t["role"] == F.col("perspective")).alias("own")
        ),
    )
    seen = parts.join(begins, ["conv_key", "part"]).withColumn("pieces", pieces)
    rendered = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "")
    start = F.struct(F.lit(0).alias("at"), F.expr("array()").cast("array<struct<begin:int,end:int>>").alias("spans"))

    def step(s, p):
        begin = s["at"] + F.length(p["head"])
        end = begin + F.length(p["body"])
        span = F.struct(begin.alias("begin"), end.alias("end"))
        return F.struct(
            (end + 1).alias("at"), F.when(p["own"], F.concat(s["spans"], F.array(span))).otherwise(s["spans"]).alias("spans")
        )

    return seen.select(
        "conv_id",
        "perspective",
        "part",
        "begin",
        F.size("turns").alias("n_turns"),
        rendered.alias("rendered"),
        F.aggregate("pieces", start, step, lambda s: s["spans"]).alias("spans"),
    )
