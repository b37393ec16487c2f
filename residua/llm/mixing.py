"""Mixing sources to target weights: shared-out targets, then pivotal dependent rounding of the documents' copies.

Every document of a source has the same expected number of copies, target / source size. Its whole part is taken; what is
left is a probability that pivotal rounding turns into 0 or 1. Two fractional documents exchange *words*: at random, mass moves
from one to the other until one probability is whole, so that the words they contribute together stay the same and every
document keeps its expectation. Documents meet in blocks of bounded size, each block passes its one unfinished document
to the next level, and so on: a reduction tree in which a source of any size spreads over all tasks. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from residua.functions.materialize import materialize
from residua.llm.common import Filter, column, word_count

RESULT = ("size", "source_size", "target", "copies", "taken")


@dataclass(frozen=True)
class SourceMix:
    """``targets`` shares the words out, ``plan`` decides every document's copies, ``apply`` repeats the documents.

    weights   by rank of the source in code point order (null last), repeating
    share     total target, as a multiple of all words
    most      a source's target is at most this multiple of its words; the excess is shared again by weight
    block     documents that meet in one task of the tree, on average
    seed      of the draws; draws depend on the document, not on partitions, so reruns agree

    Defined results: a null text has size 0 and takes nothing; a null source is a source of its own; rows that agree in id, source
    and size are told apart by number only; an empty table gives an empty table; other columns do not matter.
    """

    key: str = "doc_id"
    text: str = "text"
    source: str = "source"
    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    most: float = 2.0
    block: int = 64
    seed: int = 20

    def sizes(self, docs: DataFrame) -> DataFrame:
        return docs.select(column(self.key).alias("doc_id"), column(self.source).alias("source"), word_count(column(self.text)).alias("size"))

    def targets(self, sizes: DataFrame) -> DataFrame:
        """One row per source: its words, its documents, its target. Sources are few; their shares are settled in rounds."""
        per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
        rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
        weight = F.element_at(F.array(*[F.lit(float(w)) for w in self.weights]), (rank % len(self.weights) + 1).cast("int"))
        table = materialize(per.withColumn("weight", weight), "sources")
        left = self.share * (table.agg(F.sum("source_size")).first()[0] or 0)
        capped: Column = F.lit(False)
        level = 0.0
        while True:  # at least one source more is capped in each round
            row = table.agg(
                F.sum(F.when(capped, self.most * F.col("source_size"))).alias("held"),
                F.sum(F.when(~capped, F.col("weight"))).alias("weights"),
                F.count(F.when(capped, 1)).alias("n"),
            ).first()
            if not row["weights"]:
                break
            level = (left - (row["held"] or 0.0)) / row["weights"]
            above = capped | (F.col("weight") * level > self.most * F.col("source_size"))
            if table.where(above).count() == row["n"]:
                break
            # as the level only rises, a source that was capped stays capped
            capped = F.col("weight") * level > self.most * F.col("source_size")
        target = F.when(capped, self.most * F.col("source_size")).otherwise(F.col("weight") * level)
        return table.withColumn("target", target.cast("double"))

    def plan(self, docs: DataFrame) -> DataFrame:
        """One row per input row: doc_id, source, size, source_size, target, copies, taken."""
        sizes = materialize(self.sizes(docs), "sizes")
        targets = self.targets(sizes).select(F.col("source").alias("_s"), "source_size", "n", "target")
        # rows that agree in everything are counted, then numbered: the order of files and tasks plays no part
        rows = sizes.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("m"))
        rows = rows.withColumn("number", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m")))).drop("m")
        # sources are few: one small row each
        rows = rows.join(F.broadcast(targets), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
        ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
        whole = F.floor(ratio + 1e-12)
        part = F.greatest(ratio - whole, F.lit(0.0))
        rows = rows.withColumn("whole", whole).withColumn("p", F.when(part < 1e-12, 0.0).otherwise(part))
        rows = rows.withColumn("draw", F.xxhash64(F.lit(self.seed), "doc_id", "size", "number"))
        open_ = (F.col("p") > 0) & (F.col("size") > 0)
        decided = [rows.where(~open_).withColumn("extra", F.lit(0).cast("long"))]
        units = rows.where(open_)
        most = targets.agg(F.max("n")).first()[0] or 0
        level = 0
        while most > 0:
            groups = F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(self.block ** (level + 1))))
            met = units.withColumn("block", F.pmod(F.xxhash64(F.lit(level), "draw"), groups))
            done = materialize(self._rounds(met, final=most <= 1), f"mix-{level}")
            decided.append(done.where("p in (0, 1)").withColumn("extra", F.col("p").cast("long")))
            units = done.where("p > 0 and p < 1")
            if most <= 1:
                break
            most = -(-most // self.block)
            level += 1
        out = decided[0].drop("p")
        for part_ in decided[1:]:
            out = out.unionByName(part_.select(*out.columns))
        copies = F.col("whole") + F.col("extra")
        return out.select("doc_id", "source", "size", "source_size", "target", copies.cast("long").alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))

    def _rounds(self, units: DataFrame, final: bool) -> DataFrame:
        """Settle each block: its documents in order of draw, one unfinished document carried along."""
        fields = ["draw", "doc_id", "number", "size", "whole", "p"]
        listed = F.sort_array(F.collect_list(F.struct(*fields)))
        blocks = units.groupBy("source", "source_size", "n", "target", "block").agg(listed.alias("units"))
        kind = units.select(F.struct(*fields).alias("u")).schema["u"].dataType.simpleString()
        start = F.struct(F.lit(None).cast(kind).alias("open"), F.array().cast(f"array<{kind}>").alias("done"))

        def meet(state: Column, new: Column) -> Column:
            old = state["open"]
            si, sj, pi, pj = old["size"].cast("double"), new["size"].cast("double"), old["p"], new["p"]
            gain, loss = F.least(si * (1 - pi), sj * pj), F.least(si * pi, sj * (1 - pj))  # words to or from the old one
            u = uniform(F.xxhash64(F.lit(self.seed + 1), old["draw"], new["draw"], old["p"], new["p"]))
            up = u * (gain + loss) < loss
            moved = F.when(up, gain).otherwise(-loss)
            pi2, pj2 = settled(pi + moved / si), settled(pj - moved / sj)
            a, b = old.withField("p", pi2), new.withField("p", pj2)
            a_done, b_done = pi2.isin(0.0, 1.0), pj2.isin(0.0, 1.0)
            null = F.lit(None).cast(kind)
            paired = F.struct(
                F.when(~a_done, a).when(~b_done, b).otherwise(null).alias("open"),
                F.concat(state["done"], F.when(a_done & b_done, F.array(a, b)).when(a_done, F.array(a)).otherwise(F.array(b))).alias("done"),
            )
            first = F.struct(new.alias("open"), state["done"].alias("done"))
            return F.when(old.isNull(), first).otherwise(paired)

        rest = F.filter(F.array("end.open"), lambda unit: unit.isNotNull())
        ended = blocks.withColumn("end", F.aggregate("units", start, meet)).withColumn("unit", F.explode(F.concat("end.done", rest)))
        out = ended.select("source", "source_size", "n", "target", *[F.col(f"unit.{f}").alias(f) for f in fields])
        if final:  # a source's last document has no partner left: the nearer whole number keeps the source near its target
            out = out.withColumn("p", F.when(F.col("p") < 0.5, 0.0).otherwise(1.0))
        return out

    def apply(self, docs: DataFrame) -> DataFrame:
        """``docs`` with every row repeated as often as the mix takes it; columns as before.

        Where several rows agree in id, source and size, their copies are dealt out evenly, the remainder to the first by content.

        Documents of a source differ by one copy at most. Two bitmaps hold which have the one and which do not; a document that only one of
        them knows stays where it is, and only the others, and rows that agree, travel to their line of the plan.
        """
        plan = self.plan(docs).groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("m"))
        plan = materialize(plan.select(F.col("doc_id").alias("d"), F.col("source").alias("s"), F.col("size").alias("z"), "copies", "m"), "mix-plan")
        sure, rows = self._told_apart(docs, plan)
        rows = rows.select("row", "id", "from", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("body"))
        on = F.col("id").eqNullSafe(F.col("d")) & F.col("from").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))
        met = rows.join(plan, on)
        single = met.where("m = 1").withColumn("take", F.col("copies"))
        several = met.where("m > 1").withColumn("n", F.row_number().over(Window.partitionBy("d", "s", "z").orderBy("body")))
        extra = (F.col("n") <= F.col("copies") % F.col("m")).cast("long")
        several = several.withColumn("take", F.floor(F.col("copies") / F.col("m")) + extra).drop("n")
        taken = sure.select("row", "take").unionByName(single.select("row", "take")).unionByName(several.select("row", "take")).where("take > 0")
        return taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("take").cast("long")))).select("row.*")

    def _told_apart(self, docs: DataFrame, plan: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(row, take) of the documents that the bitmaps decide; (row, id, from, text) of all others."""
        # sources are few: one small row each
        least = plan.where("m = 1").groupBy(F.col("s").alias("of")).agg(F.min("copies").alias("least"))
        least = materialize(least, "mix-least")
        more = F.when(F.col("m") == 1, F.col("copies") - F.col("least")).alias("more")
        known = plan.join(F.broadcast(least), F.col("s").eqNullSafe(F.col("of")), "left").select(F.xxhash64("d", "s").alias("place"), more)
        known = materialize(known, "mix-places")
        without = Filter(known.where("more IS NULL OR more != 1").select("place"))
        with_one = Filter(known.where("more IS NULL OR more != 0").select("place"))
        # the input travels as one column, so no name of its own can clash
        whole = F.struct(*[column(c) for c in docs.columns]).alias("row")
        rows = docs.select(whole, column(self.key).alias("id"), column(self.source).alias("from"), column(self.text).alias("text"))
        rows = with_one.mark(without.mark(rows.withColumn("place", F.xxhash64("id", "from")), "place", "less"), "place", "more").drop("place")
        sure = rows.where("less != more").join(F.broadcast(least), F.col("from").eqNullSafe(F.col("of")))
        sure = sure.withColumn("take", F.col("least") + F.col("more").cast("long"))
        return sure, rows.where("less AND more")


def uniform(hashed: Column) -> Column:
    """A number in [0, 1) from a 64-bit hash."""
    return F.shiftrightunsigned(hashed, 11).cast("double") / float(1 << 53)


def settled(p: Column) -> Column:
    """Whole, if rounding noise is all that is missing."""
    return F.when(p < 1e-9, 0.0).when(p > 1 - 1e-9, 1.0).otherwise(p)
