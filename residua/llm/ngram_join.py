"""N-gram Jaccard join over prefix trees.

A document is the set of its word n-grams' hashes in one global order, rare n-grams first and the most frequent last: frequencies come
from a sixteenth of the different sets, chosen by hash, which only the order depends on. Two sets of a given similarity must share one of the
first few n-grams of either (the prefix), so the prefix n-grams are the branches over which the forest is dealt out to the cluster. Inside
a branch, the set with the fewest rare n-grams is the hub, as it lies in the middle of a group of near copies; all others are matched
with it, and only documents that do not already hang together are matched with each other: the links that this leaves out join documents
that are joined anyhow, so the groups are exact, and a branch with a third of all rows stays linear. Sets to be matched with one probe are stored in a trie; its traversal shares the overlap of common beginnings and
prunes a subtree as soon as the remaining length cannot reach the bound.

Documents with equal sets are one node from the start. Sets are compared by 60-bit n-gram hashes and 64-bit set hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from residua.functions.lookup import lookup_join
from residua.functions.materialize import materialize
from residua.llm.common import FILTER_BITS, Filter, column, slices, word_hashes
from residua.llm.components import components

#: Most n-grams that are put behind the others for their frequency: 8 bytes each, broadcast.
LATE = 1 << 22
#: One of so many different sets is looked at for the frequencies.
SAMPLE = 16
#: Bytes of text whose arrays a task holds at a time; small enough for the processor's caches.
SLICE = 500_000
#: Copies of a branch's hub among which its members are dealt out, where there are too many branches to broadcast.
SALTS = 8
#: Members that meet one probe in one task.
CHUNK = 128
#: Bits of an n-gram's hash; the four bits above them say how frequent it is.
HASH_BITS = 60
PLAIN = np.uint64((1 << HASH_BITS) - 1)
RANK_BITS = np.uint64(64 - HASH_BITS)
#: Ranked n-grams that travel as one row.
PACKED = 1 << 16


@dataclass(frozen=True)
class NgramJoin:
    """``classes`` gives every document its set size and class; ``groups`` the classes' components; ``join`` both for all rows.

    n          words of an n-gram; shorter documents have their whole word sequence as the one element
    percent    least 100 * intersection / union of a link, 1 to 100
    often      an n-gram that so many of the looked-at sets have goes behind rarer ones (more, if there were over ``LATE``)

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. Defined results: a null, empty or wordless text has an empty set, is linked
    with nothing, and is its own component; rows are the nodes, so repeated rows link like any others; a row
    without id takes part, and its component is the smallest id reachable, null if there is none; an empty table gives
    an empty table.
    """

    key: str = "doc_id"
    text: str = "text"
    n: int = 3
    percent: int = 90
    often: int = 2

    def required(self, a, b):
        """Least intersection of sets of sizes a and b that makes a link: 100 i >= percent * (a + b - i)."""
        return -(-(self.percent * (a + b)) // (100 + self.percent))

    def prefix(self, size: int) -> int:
        """So many first elements; similar sets share one of them."""
        return size - -(-self.percent * size // 100) + 1 if size else 0

    def _sets(self, docs: DataFrame, make, schema: str, late=None, keep=None) -> DataFrame:
        """``make(sets, keys)`` gives the columns of one slice; sets are sorted uint64 arrays in the global order."""
        n = self.n
        rows = docs.select(column(self.key).alias("_key"), column(self.text).alias("_text"))
        names = [f.name for f in T._parse_datatype_string(schema).fields]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, texts in slices(batches, "_text", SLICE):
                sets = ngram_sets(texts, n, None if late is None else late.value)
                yield pa.RecordBatch.from_arrays(make(sets, batch.column("_key")), names=names)

        return rows.mapInArrow(run, schema)

    def classes(self, docs: DataFrame) -> DataFrame:
        """(key, n_shingles, class, set) of every row; class is null for an empty set, set for all but the looked-at sets. A written table."""
        kind = docs.select(column(self.key)).schema[0].dataType.simpleString()

        def make(sets, keys):
            names = [set_hash(s) for s in sets]
            chosen = [s.view(np.int64) if c is not None and c % SAMPLE == 0 else s[:0].view(np.int64) for s, c in zip(sets, names, strict=True)]
            return [keys, pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.int64()), list_array(chosen)]

        return materialize(self._sets(docs, make, f"key {kind}, n_shingles long, class long, set array<long>"), "ngram-classes")

    def groups(self, docs: DataFrame, classes: DataFrame) -> DataFrame:
        """(node, component) of all classes that are linked to another class."""
        spark, prefix = docs.sparkSession, self.prefix
        looked_at = classes.where("size(set) > 0").dropDuplicates(["class"])
        counts = looked_at.select(F.explode("set").alias("token")).groupBy("token").count()
        counts = materialize(counts.where(F.col("count") >= self.often), "often")
        # Of those the most frequent, LATE at most: the counts above a level are few because they add up to all that was looked at.
        level = self.often
        while counts.where(F.col("count") >= level).count() > LATE:
            level *= 2
        late = spark.sparkContext.broadcast(ranked(counts.where(F.col("count") >= level)))

        def branches(sets, keys):
            seen: dict[int, np.ndarray] = {}  # a class once per slice
            for x in sets:
                if len(x):
                    seen.setdefault(set_hash(x), x)
            firsts = [x[: prefix(len(x))].view(np.int64) for x in seen.values()]
            # few rare elements first, then by name
            order = [min(int(np.searchsorted(x, PLAIN, "right")), (1 << 24) - 1) << 32 | c & 0xFFFFFFFF for c, x in seen.items()]
            return [pa.array(list(seen), pa.int64()), pa.array([len(x) for x in seen.values()], pa.int64()), pa.array(order, pa.int64()), list_array(firsts)]

        # a set's name does not depend on the order of its elements
        begun = materialize(self._sets(docs, branches, "class long, size long, middle long, firsts array<long>", late), "prefixes")
        postings = begun.select("class", "size", "middle", F.posexplode("firsts").alias("place", "token"))
        shared = postings.groupBy("token").agg(F.min_by("class", "middle").alias("hub"), F.min("class").alias("one"), F.max("class").alias("other"))
        shared = materialize(shared.where("one != other").select("token", "hub"), "branches")
        found = Filter(shared.select("token")).keep(postings.drop("middle"), "token")
        members = lookup_join(found, shared, ["token"], shared.count(), SALTS).where("hub is not null")
        members = materialize(members.dropDuplicates(["token", "class"]), "members")
        own = members.where("class = hub").select("token", F.col("size").alias("sa"), F.col("place").alias("pa"))
        others = members.where("class != hub").select("token", "hub", "class", F.col("size").alias("sb"), F.col("place").alias("pb"))
        pairs = others.join(own, "token").where(self._may_reach()).select(F.col("hub").alias("probe"), F.col("class").alias("member")).distinct()
        first = self._links(docs, self._plausible(pairs, members), late)
        found = materialize(components(first), "groups")
        # What does not hang together yet: all members against those outside the hub's group.
        labelled = members.join(found.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
        hubs = found.select(F.col("node").alias("hub"), F.col("component").alias("main"))
        labelled = materialize(labelled.join(hubs, "hub", "left").withColumn("main", F.coalesce("main", "hub")), "labelled")
        outside = labelled.where("component != main and class != hub")
        a = outside.select("token", F.col("class").alias("probe"), F.col("component").alias("ca"), F.col("size").alias("sa"), F.col("place").alias("pa"))
        # hubs are done with; two outsiders meet once
        b = labelled.where("class != hub").select("token", F.col("class").alias("member"), F.col("component").alias("cb"), F.col("main").alias("mb"), F.col("size").alias("sb"), F.col("place").alias("pb"))
        once = (F.col("cb") == F.col("mb")) | (F.col("probe") < F.col("member"))
        met = a.join(b, "token").where((F.col("ca") != F.col("cb")) & once & self._may_reach())
        pairs = met.select(F.least("probe", "member").alias("probe"), F.greatest("probe", "member").alias("member")).distinct()
        second = self._links(docs, self._plausible(pairs, members), late)
        return components(first.unionByName(second))

    @staticmethod
    def _bound() -> Column:
        """Most elements two sets can share, that have one at places pa and pb and sizes sa and sb."""
        return F.least("pa", "pb") + F.least(F.col("sa") - F.col("pa"), F.col("sb") - F.col("pb"))

    def _may_reach(self) -> Column:
        """Sizes and places allow a link, and the element lies in the shorter prefix that is enough for the smaller of two sets.

        The smaller set of a pair shares the more of its elements: its first size - ceil(2 percent size / (100 + percent)) + 1
        elements hold one that both prefixes have.
        """
        percent = self.percent
        short = lambda size: F.col(size) - F.ceil(F.lit(2 * percent) * F.col(size) / (100 + percent) - F.lit(1e-9)) + 1
        first = F.when(F.col("sa") <= F.col("sb"), F.col("pa") < short("sa")).otherwise(F.col("pb") < short("sb"))
        return first & ((100 + percent) * self._bound() >= percent * (F.col("sa") + F.col("sb")))

    def _plausible(self, pairs: DataFrame, members: DataFrame) -> DataFrame:
        """The pairs whose prefixes share enough, as a written table.

        Of two prefixes, the one that ends earlier in the order has met all it can share up to there: the intersection is at most
        the shared prefix elements and what follows that prefix in its set.
        """
        a = members.select(F.col("class").alias("probe"), "token", F.col("size").alias("sa"))
        b = members.select(F.col("class").alias("member"), "token", F.col("size").alias("sb"))
        met = materialize(pairs, "pairs").join(b, "member").join(a, ["probe", "token"])
        shared = met.groupBy("probe", "member").agg(F.count(F.lit(1)).alias("c"), F.max("sa").alias("sa"), F.max("sb").alias("sb"))
        after = F.ceil(F.lit(self.percent) * F.greatest("sa", "sb") / 100 - F.lit(1e-9)) - 1
        enough = (100 + self.percent) * (F.col("c") + after) >= self.percent * (F.col("sa") + F.col("sb"))
        return materialize(shared.where(enough).select("probe", "member"), "plausible")

    def _links(self, docs: DataFrame, pairs: DataFrame, late) -> DataFrame:
        """The pairs (probe, member) that are similar enough, as a written table (a, b)."""
        spark = docs.sparkSession
        wanted = pairs.select(F.col("probe").alias("class")).unionByName(pairs.select(F.col("member").alias("class")))
        low, word = F.col("class").bitwiseAND((1 << FILTER_BITS) - 1), F.col("w")
        bits = wanted.select(F.shiftright(low, 6).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), low.bitwiseAND(63).cast("int")).alias("bit"))
        found = bits.groupBy(word).agg(F.bit_or("bit").alias("bits")).toArrow()  # 2**(FILTER_BITS - 6) rows at most
        filled = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
        filled[found["w"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
        mask = spark.sparkContext.broadcast(filled)

        def chosen(sets, keys):
            seen: set[int] = set()
            cls, kept = [], []
            for s in sets:
                if len(s) and (c := set_hash(s)) not in seen:
                    seen.add(c)
                    at = c & ((1 << FILTER_BITS) - 1)
                    if int(mask.value[at >> 6]) >> (at & 63) & 1:
                        cls.append(c)
                        kept.append(s.view(np.int64))
            return [pa.array(cls, pa.int64()), list_array(kept)]

        sets = self._sets(docs, chosen, "class long, set array<long>", late)
        sets = materialize(sets.join(materialize(wanted.distinct(), "wanted"), "class", "left_semi").dropDuplicates(["class"]), "sets")
        sizes = materialize(pairs.groupBy("probe").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks")), "probes")
        dealt = lookup_join(pairs, sizes, ["probe"], sizes.count()).withColumn("chunk", F.pmod(F.xxhash64("member"), F.col("chunks")))
        members = dealt.join(sets.select(F.col("class").alias("member"), F.col("set").alias("other")), "member")
        members = members.select(F.col("probe").alias("hub"), F.col("chunk").alias("part"), "member", "other")
        probes = sizes.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        probes = probes.join(sets.select(F.col("class").alias("probe"), F.col("set").alias("own")), "probe").select("probe", "chunk", "own")
        percent = self.percent

        def match(probe: pa.Table, member: pa.Table) -> pa.Table:
            a, b = [], []
            if probe.num_rows and member.num_rows:
                name = probe.column("probe")[0].as_py()
                tree = PrefixTree([as_set(s) for s in member.column("other")])
                near = tree.similar(as_set(probe.column("own")[0]), percent)
                names = member.column("member").to_numpy()
                b = [int(names[i]) for i in near]
                a = [name] * len(b)
            return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

        linked = probes.groupBy("probe", "chunk").cogroup(members.groupBy("hub", "part")).applyInArrow(match, "a long, b long")
        return materialize(linked, "near")

    def join(self, docs: DataFrame) -> DataFrame:
        """One row per row of ``docs``: the key, n_shingles, component_id (smallest key reachable, its own included)."""
        classes = self.classes(docs)
        rows = classes.drop("set")
        groups = materialize(self.groups(docs, classes), "class-groups")
        ids = rows.where("class is not null").groupBy("class").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("copies"))
        named = ids.join(groups.withColumnRenamed("node", "class"), "class", "left")
        # a row that stands alone is its own component
        named = named.where("component is not null or copies > 1").select("class", "first", F.coalesce("component", "class").alias("component"))
        named = materialize(named, "class-components")
        least = named.groupBy("component").agg(F.min("first").alias("component_id"))
        known = materialize(named.join(materialize(least, "least"), "component").select("class", "component_id"), "components")
        out = lookup_join(rows, known, ["class"], known.count())
        return out.select(F.col("key").alias(self.key), "n_shingles", F.coalesce("component_id", "key").alias("component_id"))

    def distinct(self, docs: DataFrame) -> DataFrame:
        """``docs`` with one row of each component: the smallest by id, nulls last, then by text hash; rows without a set all stay, once per id and text."""
        # the input travels as one column, so no name of its own can clash
        whole = F.struct(*[column(c) for c in docs.columns]).alias("row")
        rows = docs.select(whole, column(self.key).alias("id"), column(self.text).alias("text"), F.xxhash64(column(self.text)).alias("body"))
        texts = rows.select("body", "text")
        bare = replace(self, key="body", text="text")
        classes = bare.classes(texts)
        groups = materialize(bare.groups(texts, classes).withColumnRenamed("node", "class"), "class-groups")
        # equal texts have equal sets, so a text's hash names its class
        named = classes.where("class is not null").select(F.col("key").alias("body"), "class").distinct()
        named = named.join(groups, "class", "left").select("body", F.coalesce("component", "class").alias("component"))
        named = materialize(named, "text-components")
        n = named.count()
        placed = lookup_join(rows.select("id", "body"), named, ["body"], n).where("component is not null")
        best = placed.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "body")).alias("best"))
        best = materialize(best.select("best.id", "best.body"), "kept")
        marked = rows.select("row", "id", "body")
        known = best.select(F.col("id").alias("best_id"), F.col("body").alias("best_body"))
        same = (F.col("body") == F.col("best_body")) & F.col("id").eqNullSafe(F.col("best_id"))
        chosen = Filter(best.select("body")).keep(marked, "body").join(known, same, "left_semi").dropDuplicates(["id", "body"])
        bare_texts = materialize(classes.where("class is null").select(F.col("key").alias("body")).distinct(), "bare-texts")
        unset = Filter(bare_texts).keep(marked, "body").join(bare_texts, "body", "left_semi").select("row", "id", "body")
        nameless = unset.where("id is null")
        unset = unset.where("id is not null").dropDuplicates(["id", "body"])
        return chosen.unionByName(unset).unionByName(nameless).select("row.*")


def ranked(often: DataFrame) -> np.ndarray:
    """The tokens of (token, count) in order, each with the binary logarithm of its count in the four bits below its hash.

    They reach the driver as packed numbers, 8 bytes a token and no object per token.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            rank = np.clip(np.log2(batch.column("count").to_numpy().astype(float)), 1, 15).astype(np.uint64)
            waiting.append(batch.column("token").to_numpy().view(np.uint64) << RANK_BITS | rank)
            size += len(rank)
            if size >= PACKED:
                yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(waiting).tobytes()], pa.binary())], names=["packed"])
                waiting, size = [], 0
        if size:
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(waiting).tobytes()], pa.binary())], names=["packed"])

    found = often.select("token", "count").mapInArrow(pack, "packed binary").toArrow().column("packed")
    out = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(x.as_buffer(), np.uint64) for x in found)])
    out.sort()
    return out


def ngram_sets(texts: list[bytes], n: int, late: np.ndarray | None) -> list[np.ndarray]:
    """The set of each text, sorted; elements of ``late`` (see ``ranked``) get their rank above their hash, which sorts them behind rarer ones."""
    flat, counts = word_hashes([t.lower() for t in texts])
    out, at = [], 0
    value = np.zeros(max(len(flat) - n + 1, 0), np.uint64)
    for k in range(n):
        value = value * np.uint64(0x9FB21C651E98DF25) + flat[k : k + len(value)]
    value = mixed(value)
    for count in counts.tolist():
        if count >= n:
            ordered = np.sort(value[at : at + count - n + 1])
            fresh = np.ones(len(ordered), bool)
            np.not_equal(ordered[1:], ordered[:-1], out=fresh[1:])
            out.append(ordered[fresh])
        elif count:
            short = np.uint64(0)
            with np.errstate(over="ignore"):
                for h in flat[at : at + count]:
                    short = short * np.uint64(0xD6E8FEB86659FD93) + h
                out.append(mixed(np.array([short + np.uint64(count)])))
        else:
            out.append(np.zeros(0, np.uint64))
        at += count
    if late is not None and len(late):
        for i, s in enumerate(out):
            found = late[np.minimum(np.searchsorted(late, s << RANK_BITS), len(late) - 1)]
            last = found >> RANK_BITS == s
            if last.any():
                out[i] = np.sort(np.where(last, s | found << np.uint64(HASH_BITS), s))
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread hashes evenly over ``HASH_BITS`` bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(32))) & PLAIN


def set_hash(s: np.ndarray) -> int | None:
    """A 64-bit name of a set, whatever its order; null for the empty set."""
    import xxhash

    if not len(s):
        return None
    plain = s & PLAIN
    if s[-1] > PLAIN:
        plain = np.sort(plain)
    value = xxhash.xxh3_64_intdigest(plain.tobytes())
    return value - (1 << 64) if value >> 63 else value


def list_array(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64), pa.int64()))


def as_set(value: pa.ListScalar) -> np.ndarray:
    return value.values.to_numpy().view(np.uint64)


class PrefixTree:
    """Sorted sets as a trie: in lexicographic order, each set is the path it shares with the one before, and a branch of its own."""

    STEP = 64  # elements of a branch that are matched before the bound is looked at again

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].byteswap().tobytes())
        self.shared = [0] * len(sets)  # elements a set shares with its predecessor in the order
        for k in range(1, len(sets)):
            a, b = sets[self.order[k - 1]], sets[self.order[k]]
            m = min(len(a), len(b))
            differ = a[:m] != b[:m]
            self.shared[k] = int(differ.argmax()) if differ.any() else m

    def similar(self, probe: np.ndarray, percent: int) -> list[int]:
        """Numbers of the sets that have the given Jaccard similarity with ``probe``."""
        found = []
        # path[d], place[d]: overlap and place in the probe after d elements of the current path, as deep as it was followed
        longest = max((len(s) for s in self.sets), default=0)
        path, place = np.zeros(longest + 1, np.int64), np.zeros(longest + 1, np.int64)
        depth = 0
        for k, i in enumerate(self.order):
            s = self.sets[i]
            needed = -(-percent * (len(s) + len(probe)) // (100 + percent))
            depth = min(depth, self.shared[k])  # what the paths have in common is not matched again
            while True:
                if path[depth] + min(len(s) - depth, len(probe) - place[depth]) < needed:
                    break  # nothing below this node can reach the bound for a set of this length
                if depth == len(s):
                    if path[depth] >= needed:
                        found.append(i)
                    break
                step = s[depth : depth + self.STEP]
                at = np.searchsorted(probe, step)
                hit = (at < len(probe)) & (probe[np.minimum(at, len(probe) - 1)] == step)
                path[depth + 1 : depth + 1 + len(step)] = path[depth] + np.cumsum(hit)
                place[depth + 1 : depth + 1 + len(step)] = at + hit
                depth += len(step)
        return found
