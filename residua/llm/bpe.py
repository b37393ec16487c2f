"""BPE encoding by backtracking over longest matches, and decoding through an offset table.

An Aho-Corasick automaton finds, for every position of a word, the longest token that starts there. The encoder takes the
longest match, and accepts it only if it can stand beside the token before it: two tokens are compatible if the merge rules
applied to their joined text give exactly these two. If not, it tries the next shorter token, and steps back when none
is left; a position once found useless is not tried again, so the work is linear in the word. The result is what the
merge rules give. Vocabulary and merges come from a tokenizer file; its path is a parameter.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from residua.llm.common import column, packed, slices, unpacked, worker_cache

COMPUTED = ("n_tokens", "ids", "ids_sha256", "decoded_sha256")
#: Words whose tokens a worker remembers; the memory is emptied when it is full.
REMEMBERED = 200_000
#: Characters beyond those whose case, composition and category all Unicode versions in use agree on.
NEWER = re.compile("[^\x00-\u0557]")


@dataclass(frozen=True)
class BpeEncoder:
    """``encode`` gives every document its token ids, ``digest`` their checksums, ``decode`` text from ids.

    Defined results: null and empty texts have no tokens; texts of any length are encoded whole; equal rows get equal
    results; an empty table gives an empty table. Strings of special tokens in a text become those tokens.
    """

    path: str
    text: str = "text"

    def _shared(self, df: DataFrame):
        with open(self.path, encoding="utf-8") as f:  # read once on the driver; a vocabulary has a fixed size
            return df.sparkSession.sparkContext.broadcast(f.read())

    def encode(self, docs: DataFrame) -> DataFrame:
        """All rows and columns, with ``n_tokens`` and ``ids``."""
        return self._run(docs, ["n_tokens", "ids"])

    def digest(self, docs: DataFrame) -> DataFrame:
        """All rows and columns, with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``."""
        return self._run(docs, ["n_tokens", "ids_sha256", "decoded_sha256"])

    def _run(self, docs: DataFrame, wanted: list[str]) -> DataFrame:
        base = packed(docs, COMPUTED, text=column(self.text))
        kinds = {"n_tokens": T.LongType(), "ids": T.ArrayType(T.IntegerType())}
        schema = T.StructType([base.schema["row"], *[T.StructField(n, kinds.get(n, T.StringType())) for n in wanted]])
        shared, path = self._shared(docs), self.path

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codec = worker_codec(path, shared)
            for batch, texts in slices(batches, "text"):
                made: dict[str, list] = {n: [] for n in wanted}
                for text in texts:
                    words, decoded = codec.words(text.decode())
                    joined = " ".join(words)
                    made["n_tokens"].append(joined.count(" ") + 1 if words else 0)
                    if "ids" in made:
                        made["ids"].append(list(map(int, joined.split())))
                    else:
                        made["ids_sha256"].append(sha256(joined))
                        made["decoded_sha256"].append(sha256(" ".join(decoded)))
                arrays = [batch.column("row")]
                arrays += [pa.array(made[n], type={"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}.get(n, pa.string())) for n in wanted]
                yield pa.RecordBatch.from_arrays(arrays, names=["row", *wanted])

        return unpacked(base.mapInArrow(run, schema), wanted)

    def decode(self, docs: DataFrame, ids: str = "ids", to: str = "decoded") -> DataFrame:
        """All rows and columns, with the text of ``ids``: the tokens' strings, joined by a space; null ids give null."""
        base = packed(docs, [to], ids=column(ids))
        shared, path = self._shared(docs), self.path

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codec = worker_codec(path, shared)
            for batch in batches:
                texts = [None if x is None else codec.decode(x) for x in batch.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", to])

        return unpacked(base.mapInArrow(run, T.StructType([base.schema["row"], T.StructField(to, T.StringType())])), [to])


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def worker_codec(path: str, shared) -> Codec:
    cache = worker_cache("bpe")
    if path not in cache:
        cache[path] = Codec(json.loads(shared.value))
        gc.freeze()  # the tables stay: later collections need not visit them
    return cache[path]


class Codec:
    """The tables of one tokenizer file: automaton, pair compatibility, pieces of each token, offsets for decoding."""

    def __init__(self, spec: dict):
        import ahocorasick
        import regex

        model = spec["model"]
        self.spec = {k: v for k, v in spec.items() if k != "model"}
        self.own = None
        self.suffix = model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.letters = {b: c for b, c in enumerate(letters)}
        # one character per basic symbol: a byte's letter, or the same with the word's end
        last = {c: chr(0xE000 + k) for k, c in enumerate(letters)}
        self.last = last
        plain = lambda token: token[: -len(self.suffix) - 1] + last[token[-len(self.suffix) - 1]] if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix) else token
        self.ids = {plain(t): i for t, i in model["vocab"].items()}
        self.length = [0] * (max(self.ids.values()) + 1)
        for token, i in self.ids.items():
            self.length[i] = len(token)
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.order: dict[int, int] = {}  # rank of the merge that makes a token; basic symbols come before all merges
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            left, right = self.ids[plain(a)], self.ids[plain(b)]
            made = self.ids[plain(a) + plain(b)]
            self.rank[left, right] = rank
            if made not in self.parts:
                self.parts[made], self.order[made] = (left, right), rank
        self.automaton = ahocorasick.Automaton()
        for token, i in self.ids.items():
            self.automaton.add_word(token, i)
        self.automaton.make_automaton()
        self.shorter: dict[int, int | None] = {}
        self.compatible: dict[tuple[int, int], bool] = {}
        self.string = {i: t for t, i in self.ids.items()}
        self._offsets(spec)
        special = [t for t in spec["added_tokens"] if t["special"]]
        self.special = {t["content"]: t["id"] for t in special}
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if special else None
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.piece = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.space = regex.compile(r"\p{White_Space}+")
        self.word_ids = Remembered(self.word)
        self.word_text = Remembered(lambda word: self.decode(map(int, self.word_ids[word].split(" "))))

    def _offsets(self, spec: dict) -> None:
        """All token strings in one text, token i from ``offset[i]`` to ``offset[i + 1]``."""
        strings = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.offset, parts, at = [0], [], 0
        for i in range(max(strings) + 1):
            parts.append(strings.get(i, ""))
            at += len(parts[-1])
            self.offset.append(at)
        self.table = "".join(parts)

    def decode(self, ids: Iterable[int]) -> str:
        table, offset = self.table, self.offset
        return " ".join([table[offset[i] : offset[i + 1]] for i in ids])

    def words(self, text: str) -> tuple[list[str], list[str]]:
        """Per white-space separated word, special tokens apart: its ids, and its decoded tokens, each joined by spaces."""
        if not self.cut or "<|" not in text:
            return self._plain(text)
        ids: list[str] = []
        decoded: list[str] = []
        for k, part in enumerate(self.cut.split(text)):
            made = ([str(self.special[part])], [self.decode([self.special[part]])]) if k % 2 else self._plain(part)
            ids += made[0]
            decoded += made[1]
        return ids, decoded

    def _plain(self, text: str) -> tuple[list[str], list[str]]:
        if NEWER.search(text):
            text = self.library().normalizer.normalize_str(text)
        else:
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            # letter by letter, so that a sigma does not depend on its place
            text = text.replace("Σ", "σ").lower()
        odd = any(c in text for c in "\x1c\x1d\x1e\x1f")  # white space for str.split, not for the pattern
        words = [w for w in self.space.split(text) if w] if odd else text.split()
        return list(map(self.word_ids.__getitem__, words)), list(map(self.word_text.__getitem__, words))

    def word(self, word: str) -> str:
        """Ids of a word, joined by spaces."""
        pieces = [p for p, _ in self.library().pre_tokenizer.pre_tokenize_str(word)] if NEWER.search(word) else [word] if word.isalpha() else self.piece.findall(word)
        if len(pieces) == 1:
            return " ".join(map(str, self.encode_piece(pieces[0])))
        return " ".join([self.word_ids[p] if p.isalpha() else " ".join(map(str, self.encode_piece(p))) for p in pieces])

    def library(self):
        """The tokenizer library's own rules of letters and cases, for scripts whose tables differ between Unicode versions."""
        if self.own is None:
            from tokenizers import Tokenizer

            self.own = Tokenizer.from_str(json.dumps({**self.spec, "model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": []}))
            self.own.pre_tokenizer = self.cutter(next(p for p in self.spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        return self.own

    @staticmethod
    def cutter(split: dict):
        from tokenizers import Regex, pre_tokenizers

        return pre_tokenizers.Split(Regex(split["pattern"]["Regex"]), split["behavior"].lower(), invert=split["invert"])

    def encode_piece(self, piece: str) -> list[int]:
        """Tokens of one piece: longest compatible matches, with backtracking."""
        symbols = piece.encode().decode("latin-1").translate(self.letters)
        if self.suffix:
            symbols = symbols[:-1] + self.last[symbols[-1]]
        whole = self.ids.get(symbols)
        if whole is not None and self._self_made(whole):
            return [whole]
        n, length, compatible = len(symbols), self.length, self.compatible
        longest: list[int | None] = [None] * n
        for end, i in self.automaton.iter(symbols):  # ends only rise: the last match of a start is its longest
            longest[end + 1 - length[i]] = i
        tokens: list[int] = []
        open_ = [True] * (n + 1)
        at, token, before = 0, longest[0], None
        while at < n:
            while token is not None:
                if open_[at + length[token]]:
                    if before is None:
                        break
                    fits = compatible.get((before, token))
                    if fits is None:
                        fits = self._fits(before, token)
                    if fits:
                        break
                token = self._next_shorter(token)
            if token is None:  # nothing can follow from here: never come back, and shorten the token before
                open_[at] = False
                if not tokens:
                    raise ValueError(f"no tokens spell {piece!r}")
                token = tokens.pop()
                before = tokens[-1] if tokens else None
                at -= length[token]
            else:
                tokens.append(token)
                before = token
                at += length[token]
                token = longest[at] if at < n else None
        return tokens

    def _next_shorter(self, token: int) -> int | None:
        """The longest token that is a proper beginning of this one."""
        if token not in self.shorter:
            text = self.string[token]
            self.shorter[token] = next((self.ids[text[:k]] for k in range(len(text) - 1, 0, -1) if text[:k] in self.ids), None)
        return self.shorter[token]

    def _self_made(self, token: int) -> bool:
        """Whether the merges give this token for its own text: its two parts must fit until its own merge joins them."""
        if token not in self.parts:
            return True
        left, right = self.parts[token]
        return self._stays_apart(left, right, self.order[token]) and self._self_made(left) and self._self_made(right)

    def _fits(self, left: int, right: int) -> bool:
        if len(self.compatible) > 1_000_000:
            self.compatible.clear()
        found = self.compatible[left, right] = self._stays_apart(left, right, 1 << 60)
        return found

    def _stays_apart(self, left: int, right: int, until: int) -> bool:
        """Whether no merge of a rank below ``until`` crosses the border while both tokens form.

        Seen at any time of the merging, the border lies between a token on the right edge of the left one and a token on
        the left edge of the right one. From the finished tokens back in time, the token merged last comes apart first.
        The pair at the border must not have a rule that would have acted before the next merge on either side: of equal
        ranks, the merge further left acts first.
        """
        order = self.order
        limit, left_first = until, False
        while True:
            rank = self.rank.get((left, right))
            # the border's merge acts before the later one if its rank is lower, or equal and it lies further left
            if rank is not None and (rank < limit or rank == limit and not left_first):
                return False
            lo, ro = order.get(left, -1), order.get(right, -1)
            if lo < 0 and ro < 0:
                return True
            if lo > ro:
                limit, left_first, left = lo, True, self.parts[left][1]
            elif ro > lo:
                limit, left_first, right = ro, False, self.parts[right][0]
            else:  # same rule on both sides: the right one was made last
                limit, left_first, right = ro, False, self.parts[right][0]


class Remembered(dict):
    """Strings worked out once; forgotten all together when there are too many."""

    def __init__(self, make: Callable[[str], str]):
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> str:
        made = self.make(word)
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = made
        return made


def byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies: printable Latin-1 stands for itself, the others follow from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = [], 256
    for b in range(256):
        letters.append(chr(b) if b in printable else chr(extra))
        extra += b not in printable
    return letters
