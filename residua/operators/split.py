"""Deterministic stratified split with exact per-class quotas.

Rows are ordered by ``md5(seed:key)`` within their class and the quotas cut that order. Ranking every row
would shuffle the table; instead the quotas are turned into one cut-off hash per class. Hashes are uniform, so the
hash at a rank is known up to a narrow bracket: one scan counts the hashes below the brackets and ranks only those
inside (about the square root of the rows). Assigning a row is then a comparison with its class's cut-offs: no
shuffle, independent of partitioning, repeatable on retry.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from residua.functions.columns import label_text
from residua.functions.lookup import lookup_join
from residua.functions.materialize import materialize
from residua.functions.repeats import apart

LITERAL_CLASSES = 64
BRACKET_SIGMAS = 6.0
HASH_DIGITS = 32
EDGE_DIGITS = 12
MAX_WIDENINGS = 16
_ABOVE = 9  # region of hashes above the last bracket


def hash_order(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


@dataclass(frozen=True)
class SplitModel:
    """Cut-off hashes per class: up to ``test_cut`` is test, up to ``val_cut`` validation, the rest train."""

    label: str
    key: str
    seed: int
    cuts: tuple[tuple[str, str, str], ...] | None
    table: DataFrame | None = None
    table_rows: int = 0

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``split``."""
        placed = self._placed(df)
        h = F.col("_hash")
        named = F.when(h <= F.col("_test_cut"), "test").when(h <= F.col("_val_cut"), "val").otherwise("train")
        return placed.withColumn("split", named).drop("_hash", "_test_cut", "_val_cut")

    def rows(self, df: DataFrame, split: str) -> DataFrame:
        """Rows of one split: a range of hashes per class, cheaper to test than computing every row's split name."""
        h, test_cut, val_cut = F.col("_hash"), F.col("_test_cut"), F.col("_val_cut")
        inside = {"test": h <= test_cut, "val": (h <= val_cut) & (h > test_cut), "train": h > val_cut}[split]
        kept = self._placed(df).filter(inside).drop("_hash", "_test_cut", "_val_cut")
        return kept.withColumn("split", F.lit(split))

    def _placed(self, df: DataFrame) -> DataFrame:
        """Rows with their hash and the cut-offs of their class."""
        text, h = label_text(self.label), hash_order(F.col(self.key), self.seed)
        if self.cuts is not None:
            test_cut, val_cut = (
                F.element_at(F.create_map(*[F.lit(x) for cut in self.cuts for x in (cut[0], cut[at])]), text)
                for at in (1, 2)
            )
            return df.withColumns({"_hash": h, "_test_cut": test_cut, "_val_cut": val_cut})
        hashed = df.withColumns({"_class": text, "_hash": h})
        cuts = self.table.withColumnsRenamed({"test_cut": "_test_cut", "val_cut": "_val_cut"})
        return lookup_join(hashed, cuts, ["_class"], self.table_rows).drop("_class")


def quotas(df: DataFrame, label: str, test_size: float, val_size: float) -> DataFrame:
    """Per class: rows, test rows and validation rows. Sizes round up; classes share by largest remainder."""
    classes = df.groupBy(label_text(label).alias("_class")).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()
    with_test = _largest_remainder(
        classes.withColumn("rows", F.sum("n").over(everything)).withColumn(
            "draws", F.ceil(F.col("rows") * F.lit(test_size))
        ),
        share=F.col("n"),
        whole=F.col("rows"),
        name="n_test",
    )
    rest = with_test.withColumns({"left": F.col("n") - F.col("n_test"), "rest": F.col("rows") - F.col("draws")})
    with_val = _largest_remainder(
        rest.withColumn("draws", F.ceil(F.col("rest") * F.lit(val_size / (1.0 - test_size)))),
        share=F.col("left"),
        whole=F.col("rest"),
        name="n_val",
    )
    return with_val.select("_class", "n", "n_test", "n_val")


def _largest_remainder(classes: DataFrame, share: Column, whole: Column, name: str) -> DataFrame:
    exact = F.col("draws") * share / whole
    by_remainder = Window.orderBy(F.col("_remainder").desc(), F.col("_class"))
    spare = F.col("draws") - F.sum("_floor").over(Window.partitionBy())
    floored = classes.withColumn("_floor", F.floor(exact)).withColumn("_remainder", exact - F.col("_floor"))
    granted = F.col("_floor") + F.when(F.row_number().over(by_remainder) <= spare, 1).otherwise(0)
    return floored.withColumn(name, granted).drop("_floor", "_remainder")


@dataclass(frozen=True)
class StratifiedSplit:
    """70 / 15 / 15 by default. ``key`` must be present and unique; it decides the order inside each class.

    Both are checked; the check for repeated keys groups their fingerprints, and ``check_keys=False`` leaves it out for keys known unique.
    """

    label: str = "label"
    key: str = "record_index"
    test_size: float = 0.15
    val_size: float = 0.15
    seed: int = 42
    literal_classes: int = LITERAL_CLASSES
    sigmas: float = BRACKET_SIGMAS
    check_keys: bool = True

    def fit(self, df: DataFrame) -> SplitModel:
        rows = df.select(self.label, self.key)
        missing = rows.filter(F.col(self.key).isNull()).count()
        if missing:
            raise ValueError(f"{missing} rows have no {self.key}: the split orders rows by it")
        if self.check_keys:
            parts = apart(rows, [self.key])
            doubtful = rows if parts is None else parts[1]
            repeated = doubtful.groupBy(self.key).count().filter("count > 1").first()
            if repeated is not None:
                raise ValueError(f"{self.key} {repeated[0]!r} stands in {repeated[1]} rows: quotas need unique keys")
        shares = quotas(rows, self.label, self.test_size, self.val_size)
        collected = shares.limit(self.literal_classes + 1).collect()
        if not collected:
            raise ValueError("cannot split an empty table")
        few = len(collected) <= self.literal_classes
        if few:
            n_classes, n_rows, smallest = len(collected), sum(r["n"] for r in collected), min(r["n"] for r in collected)
        else:
            shares = materialize(shares, "quotas")
            n_classes, n_rows, smallest = shares.agg(F.count("n"), F.sum("n"), F.min("n")).first()
        self._check(n_classes, n_rows, smallest)

        sigmas = self.sigmas
        for _ in range(MAX_WIDENINGS):
            if few:
                cuts = self._cuts_from_literals(rows, collected, sigmas)
            else:
                cuts = self._cuts_from_table(rows, shares, n_classes, sigmas)
            if cuts is not None:
                return cuts
            sigmas *= 8  # a bracket missed its rank: widen until it holds, soon the whole range of hashes
        raise ValueError("no cut-off found for a quota; do rows repeat their key?")

    def _check(self, n_classes: int, n_rows: int, smallest: int) -> None:
        if smallest < 2:
            raise ValueError("every class needs at least 2 rows to be split")
        n_test = math.ceil(n_rows * self.test_size)
        if min(n_test, n_rows - n_test) < n_classes:
            raise ValueError(f"{n_rows} rows are too few to give every one of {n_classes} classes a test row")

    def _cuts_from_literals(self, rows: DataFrame, shares: list, sigmas: float) -> SplitModel | None:
        brackets = {r["_class"]: _brackets(r["n"], (r["n_test"], r["n_test"] + r["n_val"]), sigmas) for r in shares}
        hashed = self._hashed(rows)
        region, key = F.lit(_ABOVE), F.lit("")
        for name, edges in brackets.items():
            of_class = F.col("_class") == name
            class_region, class_key = _region(edges)
            region = F.when(of_class, class_region).otherwise(region)
            key = F.when(of_class, class_key).otherwise(key)
        ranks = {r["_class"]: (r["n_test"], r["n_test"] + r["n_val"]) for r in shares}
        wanted = F.lit(None).cast("array<bigint>")
        for name, pair in ranks.items():
            wanted = F.when(F.col("_class") == name, F.array(*[F.lit(r).cast("bigint") for r in pair])).otherwise(wanted)
        found = {(r["_class"], r["rank"]): r["h"] for r in self._at_ranks(hashed, region, key, wanted).collect()}
        cuts = []
        for name, pair in ranks.items():
            hashes = ["" if rank == 0 else found.get((name, rank)) for rank in pair]
            if not all(h is not None and (h or rank == 0) for h, rank in zip(hashes, pair, strict=True)):
                return None
            cuts.append((name, *hashes))
        return SplitModel(self.label, self.key, self.seed, tuple(cuts))

    def _cuts_from_table(self, rows: DataFrame, shares: DataFrame, n_classes: int, sigmas: float) -> SplitModel | None:
        """Many classes: the brackets are columns of the class table, joined to the rows."""
        ends = {"test": F.col("n_test"), "val": F.col("n_test") + F.col("n_val")}
        edges = {
            f"{end}_{side}": _edge(F.col("n"), rank, sigmas * sign)
            for end, rank in ends.items()
            for side, sign in (("lo", -1), ("hi", 1))
        }
        table = shares.withColumns({**edges, "n_test_val": ends["val"]})
        joined = lookup_join(self._hashed(rows), table, ["_class"], n_classes)
        p = F.substring("h", 1, EDGE_DIGITS)
        inside = p.between(F.col("test_lo"), F.col("test_hi")) | p.between(F.col("val_lo"), F.col("val_hi"))
        # between the brackets only the count matters; "~" sorts after every hash digit
        outside = F.when(p < F.col("test_lo"), F.lit("")).when(p < F.col("val_lo"), F.concat("test_hi", F.lit("~")))
        region = F.when(p <= F.col("val_hi"), 0).otherwise(_ABOVE)
        key = F.when(inside, F.col("h")).when(p <= F.col("val_hi"), outside).otherwise("")
        found = self._at_ranks(joined, region, key, F.array("n_test", "n_test_val"), ("n_test", "n_test_val"))
        at = shares.join(found, "_class", "left").groupBy("_class", "n_test", "n_val").agg(
            F.max(F.when(F.col("rank") == F.col("n_test"), F.col("h"))).alias("test_cut"),
            F.max(F.when(F.col("rank") == F.col("n_test") + F.col("n_val"), F.col("h"))).alias("val_cut"),
        )
        complete = F.length("test_cut") == HASH_DIGITS
        cuts = materialize(
            at.select(
                "_class",
                F.when(F.col("n_test") == 0, F.lit("")).when(complete, F.col("test_cut")).alias("test_cut"),
                F.when(F.col("n_test") + F.col("n_val") == 0, F.lit(""))
                .when(F.length("val_cut") == HASH_DIGITS, F.col("val_cut"))
                .alias("val_cut"),
            ),
            "split",
        )
        if cuts.filter(F.col("test_cut").isNull() | F.col("val_cut").isNull()).isEmpty():
            return SplitModel(self.label, self.key, self.seed, None, cuts, n_classes)
        return None

    def _hashed(self, rows: DataFrame) -> DataFrame:
        return rows.select(label_text(self.label).alias("_class"), hash_order(F.col(self.key), self.seed).alias("h"))

    @staticmethod
    def _at_ranks(
        hashed: DataFrame, region: Column, key: Column, wanted: Column, class_columns: tuple[str, ...] = ()
    ) -> DataFrame:
        """(_class, rank, h): the hash at each wanted rank; hashes outside the brackets are only counted.

        ``wanted`` is read off the class or the ``class_columns``, after counting.
        """
        counted = (
            hashed.select("_class", region.cast("int").alias("region"), key.alias("h"), *class_columns)
            .groupBy("_class", "region", "h")
            .agg(F.count(F.lit(1)).alias("c"), *[F.max(c).alias(c) for c in class_columns])
        )
        order = Window.partitionBy("_class").orderBy("region", "h").rowsBetween(Window.unboundedPreceding, 0)
        ranked = counted.withColumn("upto", F.sum("c").over(order))
        hits = F.filter(wanted, lambda r: (r > F.col("upto") - F.col("c")) & (r <= F.col("upto")))
        return ranked.select("_class", F.explode(hits).alias("rank"), "h")


def _edge(n: Column, rank: Column, sigmas: float) -> Column:
    """Hash prefix about ``sigmas`` standard deviations away from where the rank is expected."""
    f = rank / n
    moved = f + F.lit(sigmas) * (F.sqrt(f * (F.lit(1.0) - f) / n) + F.lit(1.0) / n)
    place = F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), moved)) * F.lit(float(16**EDGE_DIGITS - 1)))
    return F.lower(F.lpad(F.hex(place.cast("bigint")), EDGE_DIGITS, "0"))


def _brackets(n: int, ranks: tuple[int, int], sigmas: float) -> list[tuple[str, str]]:
    """Disjoint prefix ranges expected to hold the hashes at ``ranks``: hashes are uniform, so ranks are predictable."""
    ranges = []
    for rank in ranks:
        f = rank / n
        spread = sigmas * (math.sqrt(f * (1.0 - f) / n) + 1.0 / n)
        ranges.append((max(0.0, f - spread), min(1.0, f + spread)))
    if ranges[1][0] <= ranges[0][1]:
        ranges = [(ranges[0][0], ranges[1][1])]
    scale = 16**EDGE_DIGITS - 1
    return [tuple(f"{math.floor(x * scale):0{EDGE_DIGITS}x}" for x in r) for r in ranges]


def _region(edges: list[tuple[str, str]]) -> tuple[Column, Column]:
    """Region number in hash order and the hash itself inside a bracket."""
    p = F.substring("h", 1, EDGE_DIGITS)
    region, key = F.lit(_ABOVE), F.lit("")
    for i, (lo, hi) in reversed(list(enumerate(edges))):
        region = F.when(p < lo, 2 * i).when(p <= hi, 2 * i + 1).otherwise(region)
        key = F.when(p.between(F.lit(lo), F.lit(hi)), F.col("h")).otherwise(key)
    return region, key


def split_counts(df: DataFrame) -> DataFrame:
    """Rows per split and in total."""
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("rows")).unionByName(
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("total").alias("split"), "rows")
    )


def split_invariants(df: DataFrame, key: str) -> DataFrame:
    """One row of violations, all zero for a proper split: rows without a split, keys in two splits, lost rows."""
    per_key = df.groupBy(key).agg(
        F.min("split").alias("first"), F.max("split").alias("last"), F.count(F.lit(1)).alias("rows")
    )
    return per_key.agg(
        F.count_if(F.col("first").isNull()).alias("unassigned"),
        F.count_if(F.col("first") != F.col("last")).alias("in_two_splits"),
        F.sum(F.col("rows") - 1).alias("repeated_keys"),
        F.count(F.lit(1)).alias("keys"),
    )
