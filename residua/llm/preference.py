"""Preference formatting: the common beginning of a chosen and a rejected conversation once, then both completions with masks.

Conversations stay rows, one per turn: pairs, turns and positions are joined on (pair, turn), so a conversation of any length spreads over
the cluster. The longest common prefix ends before the first turn at which role or text differ or one side has no turn.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from residua.functions.materialize import materialize
from residua.functions.running import sketch_rows
from residua.llm.common import column


@dataclass(frozen=True)
class PreferenceFormat:
    """``format`` renders pairs of conversations, ``reply_pairs`` makes pairs from single conversations, ``format_single`` does both.

    head, tail  what stands before and after a turn's text; {role} is its role
    learn       roles whose turns of a completion carry loss

    Defined results: rows without conversation or turn take no part; a row that repeats conversation and turn counts once, the least by role and
    text; null roles and texts render as empty but differ from empty ones in comparison; a pair with an unknown conversation, or
    with equal ones, gives no row; repeated pairs count once; other columns do not matter; empty tables give an empty table.
    """

    head: str = "<|{role}|>\n"
    tail: str = "\n"
    learn: tuple[str, ...] = ("assistant",)

    def turns(self, rows: DataFrame) -> DataFrame:
        kept = rows.select(*[column(c).alias(c) for c in ("conv_id", "turn", "role", "text")]).where("conv_id is not null and turn is not null")
        once = kept.groupBy("conv_id", "turn").agg(F.min(F.struct("role", "text")).alias("least"))
        return once.select("conv_id", "turn", "least.role", "least.text")

    def render(self, role: Column, text: Column) -> Column:
        head = F.replace(F.lit(self.head), F.lit("{role}"), F.coalesce(role, F.lit("")))
        return F.concat(head, F.coalesce(text, F.lit("")), F.lit(self.tail))

    def format(self, rows: DataFrame, pairs: DataFrame) -> DataFrame:
        """One row per rendered turn: pair_id, part (prompt, chosen, rejected), turn, role, rendered, loss (0 or 1).

        The prompt is there once per pair and carries no loss; a completion's turns follow it by ``turn``.
        """
        turns = materialize(self.turns(rows), "turns")
        sides = pairs.select("pair_id", F.explode(F.array(F.struct(F.lit("chosen").alias("side"), F.col("chosen").alias("conv_id")), F.struct(F.lit("rejected").alias("side"), F.col("rejected").alias("conv_id")))).alias("s"))
        sides = sides.select("pair_id", "s.side", "s.conv_id").distinct()
        placed = materialize(sides.join(turns, "conv_id"), "pair-turns")
        # two sides with equal rows, or a difference
        both = placed.groupBy("pair_id", "turn").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("role", "text")).alias("lo"), F.max(F.struct("role", "text")).alias("hi"))
        differ = both.where((F.col("n") < 2) | ~F.col("lo").eqNullSafe(F.col("hi")))
        split = differ.groupBy("pair_id").agg(F.min("turn").alias("split"))
        known = placed.groupBy("pair_id").agg(F.max(F.when(F.col("side") == "chosen", 1).otherwise(0)).alias("c"), F.max(F.when(F.col("side") == "rejected", 1).otherwise(0)).alias("r")).where("c = 1 and r = 1")
        split = materialize(split.join(known.select("pair_id"), "pair_id"), "splits")
        cut = placed.join(split, "pair_id").where((F.col("turn") >= F.col("split")) | (F.col("side") == "chosen"))
        part = F.when(F.col("turn") < F.col("split"), F.lit("prompt")).otherwise(F.col("side"))
        loss = (F.col("part") != "prompt") & F.coalesce(F.col("role").isin(*self.learn), F.lit(False))
        out = cut.withColumn("part", part).withColumn("loss", loss.cast("int")).withColumn("rendered", self.render(F.col("role"), F.col("text")))
        return out.select("pair_id", "part", "turn", "role", "rendered", "loss")

    def reply_pairs(self, rows: DataFrame, reply: str = "assistant") -> tuple[DataFrame, DataFrame]:
        """Pairs for a table of single conversations with integer ids: each that has a reply is chosen once, up to its last reply.

        Its rejected side takes the last reply of the next conversation in order of ids that has one; the last takes the first's. By the id's
        remainder by 3 it stands in place of the last reply (0), of all replies (1), or of the first, where the rejected side ends (2).
        Returned are the turns of both sides under names of their own, and the pairs; an only conversation with a reply has no pair.
        """
        turns = materialize(self.turns(rows), "turns")
        replies = turns.where(F.col("role") == reply).groupBy("conv_id").agg(F.min("turn").alias("first"), F.max("turn").alias("last"), F.max_by("text", "turn").alias("own"))
        replies = materialize(replies, "replies")
        # the next id: inside a range of ids by a window, from range to range through one row per range
        placed = sketch_rows(replies.count()).place(replies.select("conv_id"), "conv_id")
        inside = placed.withColumn("next", F.lead("conv_id").over(Window.partitionBy("_bucket").orderBy("conv_id")))
        ranges = Window.orderBy("_bucket")
        start = F.min("start").over(ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        after = F.coalesce(F.lead("start").over(ranges), start)
        ends = placed.groupBy("_bucket").agg(F.min("conv_id").alias("start")).select("_bucket", after.alias("after"))
        paired = inside.join(F.broadcast(ends), "_bucket").select("conv_id", F.coalesce("next", "after").alias("next")).where("conv_id != next")
        others = replies.select(F.col("conv_id").alias("next"), F.col("own").alias("other"))
        kind = F.pmod("conv_id", F.lit(3))
        begin, end = F.when(kind == 0, F.col("last")).otherwise(F.col("first")), F.when(kind == 2, F.col("first")).otherwise(F.col("last"))
        swap = paired.join(replies, "conv_id").join(others, "next").select("conv_id", "last", begin.alias("begin"), end.alias("end"), "other")
        swap = materialize(swap, "swaps")
        both = turns.join(swap, "conv_id").where("turn <= last")
        name = F.col("conv_id").cast("string")
        other = name_of_rejected(name)
        text = F.when((F.col("role") == reply) & (F.col("turn") >= F.col("begin")), F.col("other")).otherwise(F.col("text"))
        chosen = both.select(name.alias("conv_id"), "turn", "role", "text")
        rejected = both.where("turn <= end").select(other.alias("conv_id"), "turn", "role", text.alias("text"))
        return chosen.unionByName(rejected), swap.select(F.col("conv_id").alias("pair_id"), name.alias("chosen"), other.alias("rejected"))

    def format_single(self, rows: DataFrame, reply: str = "assistant") -> DataFrame:
        """``format`` of the ``reply_pairs`` of ``rows``; a conversation without a pair, or whose two sides are equal, is one row of part
        unpaired, without turn, and with loss 0."""
        made = materialize(self.format(*self.reply_pairs(rows, reply)), "preferences")
        known = rows.select(*[column(c).alias(c) for c in ("conv_id", "turn")]).where("conv_id is not null and turn is not null")
        ids = known.select(F.col("conv_id").alias("pair_id")).distinct()
        rest = ids.join(made.select("pair_id").distinct(), "pair_id", "left_anti")
        none = [F.lit(None).cast(made.schema[c].dataType).alias(c) for c in ("turn", "role", "rendered")]
        return made.unionByName(rest.select("pair_id", F.lit("unpaired").alias("part"), *none, F.lit(0).alias("loss")))


def name_of_rejected(name: Column) -> Column:
    return F.concat(name, F.lit(" rejected"))
