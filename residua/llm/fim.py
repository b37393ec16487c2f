"""Fill-in-middle transformation: documents cut at line ends into prefix, middle and suffix, and rearranged.

One match of the repeated unit against the whole text keeps every repetition of its group, so the ends of that group
are all line ends at once: their number is n, and both cuts are two of them. Nothing iterates over lines. The units are matched
without going back, as no line can be matched in another way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from residua.llm.common import column, packed, slices, unpacked

COMPUTED = ("n", "form", "prefix_chars", "middle_chars")
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: A line with its end, or the last one without; once begun it is not given back.
UNIT = r"((?>[^\n]*+\n|[^\n]++))"
#: Repetitions that one match keeps.
LINES = 500_000


@dataclass(frozen=True)
class FillInMiddle:
    """``apply`` gives every document its rearranged text, ``restore`` takes it back, ``digest`` gives checksums of both.

    marks     what stands before prefix, suffix and middle
    seed      drawn with the document's key: four numbers from the SHA-256 of ``seed:key``
    rate      per cent of documents that are rearranged
    spm       per cent of those whose suffix comes first

    Defined results: null and empty texts are plain with n = 0, and come out empty; texts that hold a mark stay plain; a null key is drawn
    as the empty string; equal keys and texts give equal results; a text of any length is matched whole (of over
    ``LINES`` lines, by so many at a time: the library keeps some 150 bytes a repetition); an empty table gives an empty table. Computed columns replace input columns of the same name.
    """

    key: str = "doc_id"
    text: str = "text"
    marks: tuple[str, str, str] = ("<P>", "<S>", "<M>")
    seed: int = 7
    rate: int = 100
    spm: int = 50

    def apply(self, docs: DataFrame, to: str = "fim") -> DataFrame:
        """All rows and columns, with n, form, prefix_chars, middle_chars and the rearranged text in ``to``."""
        return self._run(docs, {to: lambda cut: cut.output})

    def digest(self, docs: DataFrame) -> DataFrame:
        """All rows and columns, with n, form, prefix_chars, middle_chars, and the SHA-256 of output and rebuilt text."""
        rebuilt = lambda cut: sha256(self.rebuilt(cut.output, cut.form))
        return self._run(docs, {"output_sha256": lambda cut: sha256(cut.output), "restored_sha256": rebuilt})

    def restore(self, docs: DataFrame, output: str = "fim", form: str = "form", to: str = "restored") -> DataFrame:
        """All rows and columns, with the text that ``output`` was made of; null output or form gives null."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, texts in slices(batches, "output"):
                forms, there = batch.column("form").to_pylist(), batch.column("output").is_valid().to_pylist()
                made = [self.rebuilt(t.decode(), f) if ok and f is not None else None for t, f, ok in zip(texts, forms, there, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(made, pa.string())], names=["row", to])

        rows = packed(docs, [to], output=column(output), form=column(form))
        return unpacked(rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField(to, T.StringType())])), [to])

    def _run(self, docs: DataFrame, columns: dict) -> DataFrame:
        names = [*COMPUTED, *columns]
        rows = packed(docs, names, key=column(self.key).cast("string"), text=column(self.text))
        kinds = [T.LongType(), T.StringType(), T.LongType(), T.LongType(), *[T.StringType()] * len(columns)]
        schema = T.StructType([rows.schema["row"], *[T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, texts in slices(batches, "text"):
                made: list[tuple] = []
                for key, text in zip(batch.column("key").to_pylist(), texts, strict=True):
                    cut = self.cut(text.decode(), key or "")
                    made.append((cut.n, cut.form, cut.prefix_chars, cut.middle_chars, *[f(cut) for f in columns.values()]))
                arrays = [pa.array(c, pa.string() if k == T.StringType() else pa.int64()) for c, k in zip(zip(*made, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("row"), *arrays], names=["row", *names])

        return unpacked(rows.mapInArrow(run, schema), names)

    def cut(self, text: str, key: str) -> Cut:
        ends = line_ends(text)
        n = len(ends)
        drawn = hashlib.sha256(f"{self.seed}:{key}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(drawn[k : k + 8], 16) for k in range(0, 32, 8))
        if not n or any(m in text for m in self.marks) or h3 % 100 >= self.rate:
            return Cut(n, PLAIN, None, None, text)
        place = lambda k: ends[k - 1] if k else 0
        first, second = sorted((place(h1 % (n + 1)), place(h2 % (n + 1))))
        prefix, middle, suffix = text[:first], text[first:second], text[second:]
        p, s, m = self.marks
        if h4 % 100 < self.spm:
            return Cut(n, SPM, len(prefix), len(middle), f"{s}{suffix}{p}{prefix}{m}{middle}")
        return Cut(n, PSM, len(prefix), len(middle), f"{p}{prefix}{s}{suffix}{m}{middle}")

    def rebuilt(self, output: str, form: str) -> str:
        """The text that ``output`` was made of. Its parts hold no mark, so the first of each mark is the one that was put in."""
        if form == PLAIN:
            return output
        p, s, m = self.marks
        one, two = (p, s) if form == PSM else (s, p)
        front, middle = output.removeprefix(one).split(two, 1)[0], None
        back, middle = output[len(one) + len(front) + len(two) :].split(m, 1)
        return front + middle + back if form == PSM else back + middle + front


@dataclass(frozen=True)
class Cut:
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: str


def line_ends(text: str) -> list[int]:
    """Places behind all lines of a text, from one match."""
    import regex

    if text.count("\n") < LINES:
        return regex.fullmatch(UNIT + "*", text).ends(1)
    ends: list[int] = []
    stretch = regex.compile(f"{UNIT}{{1,{LINES}}}+")
    while not ends or ends[-1] < len(text):
        ends += stretch.match(text, ends[-1] if ends else 0).ends(1)
    return ends


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
