"""URL filter over a sorted digest array.

The list of rules and host words is an image of four arrays: ascending 64-bit xxhash digests, verdicts, offsets, and the full
strings. A task maps an image into memory, hashes all strings of a batch of URLs that may stand in the list, finds them
by binary search over the whole batch at once, and compares every hit with the stored string, so a collision changes nothing.

A list of up to ``limit`` bytes is one image, which is broadcast. A larger one is dealt out by digest: then the different strings
to be looked up travel to the images, in a stream behind each image, and hits come back by joins.
"""

from __future__ import annotations

import mmap
import re
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from residua.functions.lookup import lookup_join
from residua.functions.materialize import materialize
from residua.llm.common import column, packed, unpacked, worker_cache

COMPUTED = ("host", "path", "rule", "word", "verdict")
ALLOW, BLOCK = "allow", "block"
#: Bytes of an image besides an entry's string: digest, offset, verdict.
ENTRY_BYTES = 17
#: Strings to be looked up that one copy of an image serves, where images are dealt out.
PROBES = 4_000_000
WORD_ENDS = re.compile(r"[.\-]")


@dataclass(frozen=True)
class UrlFilter:
    """``build`` makes the list, ``judge`` gives every URL its host, path, longest rule, blocked word and verdict.

    default   verdict of a URL that neither a rule nor a word decides
    limit     most bytes of an image that is broadcast

    Entries are strings with a verdict. One with a slash is a rule, host before the first slash and path from there on: it fits
    its host and all subdomains if the URL's path starts with the rule's, and the longest wins (of equally long ones that with the longer
    host). One without a slash is a word between the dots and hyphens of a host; where no rule fits, a blocked word blocks.
    Compared byte by byte, after A-Z of the host are lower-cased.

    Defined results: a null URL or one without ``://`` has an empty host and path and gets the default; null and empty entries are
    left out; an entry with two verdicts blocks; verdicts other than ``allow`` block; repeated rows get equal results; hosts and paths
    of any length are judged whole; an empty table or list gives no rules. Computed columns replace input columns of the same name.
    """

    url: str = "url"
    default: str = ALLOW
    limit: int = 64_000_000

    def build(self, entries: DataFrame) -> UrlList:
        """``entries`` has the columns entry and verdict."""
        rows = entries.select("entry", (F.coalesce("verdict", F.lit(BLOCK)) != ALLOW).alias("blocks")).where("entry != ''")
        rows = materialize(rows.groupBy("entry").agg(F.max("blocks").alias("blocks")), "url-entries")
        size = F.octet_length("entry") + ENTRY_BYTES
        slash = F.instr("entry", "/")
        rule = F.when(slash > 0, slash - 1)
        # lengths of the rules' hosts and paths say which parts of a URL are worth a look
        found = rows.agg(
            F.coalesce(F.sum(size), F.lit(0)).alias("bytes"),
            F.collect_set(rule).alias("hosts"),
            F.collect_set(F.char_length("entry") - rule).alias("paths"),
            F.coalesce(F.max(slash == 0), F.lit(False)).alias("words"),
        ).first()
        parts = max(1, -(-found["bytes"] // self.limit))
        digest = F.xxhash64(F.col("entry").cast("binary"))
        images = rows.withColumn("part", F.pmod(digest, F.lit(parts))).groupBy("part").applyInArrow(image, "part long, image binary")
        probe = Probe(self.default, tuple(sorted(found["hosts"])), tuple(sorted(found["paths"])), found["words"])
        return UrlList(self.url, materialize(images, "url-images"), parts, probe)


@dataclass(frozen=True)
class Probe:
    """What is looked up for a URL, and what follows from the entries found: lengths of the rules' hosts and paths, whether there are words."""

    default: str
    hosts: tuple[int, ...]
    paths: tuple[int, ...]
    words: bool

    def candidates(self, host: str, path: str) -> list[str]:
        """The strings of a URL that may stand in the list: its host from a label on with a beginning of its path, and words."""
        out = set()
        for n in self.hosts:
            at = len(host) - n
            if at == 0 or (at > 0 and host[at - 1] == "."):
                out.update(host[at:] + path[:k] for k in self.paths if k <= len(path))
        if self.words:
            out.update(w for w in WORD_ENDS.split(host) if w)
        return list(out)

    def decide(self, found: dict[str, bool]) -> tuple[str | None, str | None, str]:
        """Rule, word and verdict, given the fitting entries and whether they block."""
        rules = [e for e in found if "/" in e]
        if rules:
            rule = max(rules, key=lambda e: (len(e), e.index("/")))
            return rule, None, BLOCK if found[rule] else ALLOW
        words = sorted(e for e, blocks in found.items() if blocks)
        return None, words[0] if words else None, BLOCK if words else self.default


@dataclass(frozen=True)
class UrlList:
    url: str
    images: DataFrame
    parts: int
    probe: Probe

    def judge(self, pages: DataFrame) -> DataFrame:
        """All rows and columns, with host, path, rule, word and verdict."""
        host, path = host_and_path(column(self.url))
        rows = packed(pages, COMPUTED, host=host, path=path)
        judged = self._broadcast(rows) if self.parts == 1 else self._dealt(rows)
        return unpacked(judged, COMPUTED)

    def _broadcast(self, rows: DataFrame) -> DataFrame:
        found = self.images.collect()  # one image of ``limit`` bytes at most, or none
        shared = rows.sparkSession.sparkContext.broadcast(bytes(found[0]["image"]) if found else pack([], []))
        name, decide, candidates = uuid.uuid4().hex, self.probe.decide, self.probe.candidates
        schema = T.StructType([rows.schema["row"], *[T.StructField(n, T.StringType()) for n in COMPUTED]])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cache = worker_cache("url filter")
            if name not in cache:
                cache.clear()
                cache[name] = Digests(shared.value)
            digests = cache[name]
            for batch in batches:
                hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
                asked = [candidates(h, p) for h, p in zip(hosts, paths, strict=True)]
                known = digests.verdicts([e for one in asked for e in one])
                made = [decide({e: known[e] for e in one if e in known}) for one in asked]
                arrays = [batch.column("host"), batch.column("path"), *[pa.array([m[k] for m in made], pa.string()) for k in range(3)]]
                yield pa.RecordBatch.from_arrays([batch.column("row"), *arrays], names=["row", *COMPUTED])

        return rows.mapInArrow(run, schema)

    def _dealt(self, rows: DataFrame) -> DataFrame:
        candidates, decide, parts = self.probe.candidates, self.probe.decide, self.parts
        sites = materialize(rows.select("host", "path").distinct(), "url-sites")

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out: tuple[list, list, list] = ([], [], [])
                for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True):
                    asked = candidates(h, p)
                    for values, more in zip(out, ([h] * len(asked), [p] * len(asked), asked), strict=True):
                        values.extend(more)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in out], names=["host", "path", "entry"])

        asked = materialize(sites.mapInArrow(ask, "host string, path string, entry string"), "url-candidates")
        wanted = asked.select("entry").distinct()
        wanted = materialize(wanted.withColumn("part", F.pmod(F.xxhash64(F.col("entry").cast("binary")), F.lit(parts))), "url-wanted")
        copies = max(1, -(-wanted.count() // (PROBES * parts)))
        salt = F.pmod(F.hash("entry"), F.lit(copies))
        copied = self.images.select("part", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"), "image", F.lit(None).cast("string").alias("entry"))
        stream = copied.unionByName(wanted.select("part", salt.alias("copy"), F.lit(None).cast("binary").alias("image"), "entry"))
        stream = stream.repartition(parts * copies, "part", "copy").sortWithinPartitions("part", "copy", F.col("image").isNull())

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            digests = None
            for batch in batches:
                images, entries = batch.column("image"), batch.column("entry")
                starts = [i for i, there in enumerate(images.is_valid().to_pylist()) if there]
                for a, b in zip([0, *starts], [*starts, batch.num_rows], strict=True):
                    if a in starts:
                        digests = Digests(images[a].as_py())
                    strings = [e for e in entries.slice(a, b - a).to_pylist() if e is not None]
                    known = digests.verdicts(strings) if digests else {}
                    yield pa.RecordBatch.from_arrays([pa.array(list(known), pa.string()), pa.array(list(known.values()), pa.bool_())], names=["entry", "blocks"])

        hits = materialize(stream.mapInArrow(find, "entry string, blocks boolean"), "url-hits")
        met = lookup_join(asked, hits, ["entry"], hits.count()).where("blocks is not null")
        # few entries fit one site: nested rules of its host, and its words
        fitting = met.groupBy("host", "path").agg(F.collect_list(F.struct("entry", "blocks")).alias("found"))

        def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                made = [decide({f["entry"]: f["blocks"] for f in one}) for one in batch.column("found").to_pylist()]
                arrays = [pa.array([m[k] for m in made], pa.string()) for k in range(3)]
                yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("path"), *arrays], names=list(COMPUTED))

        settled = materialize(fitting.mapInArrow(settle, ", ".join(f"{n} string" for n in COMPUTED)), "url-verdicts")
        judged = lookup_join(rows, settled, ["host", "path"], settled.count())
        return judged.withColumn("verdict", F.coalesce("verdict", F.lit(self.probe.default)))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null or without ``://``; only A-Z are lower-cased."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*+", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + 1), r"^[^?#]*+", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit("")), F.coalesce(path, F.lit(""))


def xxh64(strings: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(s) for s in strings), np.uint64, len(strings))


def pack(strings: list[bytes], blocks: list[bool]) -> bytes:
    """The image of a list: its length, digests in ascending order, offsets, verdicts, strings."""
    digests = xxh64(strings)
    order = np.argsort(digests, kind="stable")
    ordered = [strings[i] for i in order]
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in ordered])]).astype(np.int64)
    verdicts = np.array(blocks, np.uint8)[order] if len(order) else np.zeros(0, np.uint8)
    return b"".join([np.int64(len(order)).tobytes(), digests[order].tobytes(), offsets.tobytes(), verdicts.tobytes(), *ordered])


def image(rows: pa.Table) -> pa.Table:
    made = pack([e.encode() for e in rows.column("entry").to_pylist()], rows.column("blocks").to_pylist())
    return pa.table({"part": pa.array([rows.column("part")[0].as_py()], pa.int64()), "image": pa.array([made], pa.binary())})


class Digests:
    """An image mapped into memory from a file that has no name any more, so nothing is left behind."""

    def __init__(self, packed_list: bytes):
        with tempfile.TemporaryFile() as file:
            file.write(packed_list)
            file.flush()
            self.memory = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        n = int(np.frombuffer(self.memory, np.int64, 1)[0])
        self.keys = np.frombuffer(self.memory, np.uint64, n, 8)
        self.offsets = np.frombuffer(self.memory, np.int64, n + 1, 8 + 8 * n)
        self.blocks = np.frombuffer(self.memory, np.uint8, n, 16 + 16 * n)
        self.strings = 16 + 17 * n

    def verdicts(self, strings: list[str]) -> dict[str, bool]:
        """Of the strings that are in the list, whether they block."""
        asked = list(dict.fromkeys(strings))
        raw = [s.encode() for s in asked]
        digests = xxh64(raw)
        first, last = np.searchsorted(self.keys, digests, "left"), np.searchsorted(self.keys, digests, "right")
        found = {}
        for i in np.flatnonzero(last > first):
            for k in range(first[i], last[i]):  # more than one entry only where digests collide
                a, b = self.strings + self.offsets[k], self.strings + self.offsets[k + 1]
                if self.memory[a:b] == raw[i]:
                    found[asked[i]] = bool(self.blocks[k])
        return found
