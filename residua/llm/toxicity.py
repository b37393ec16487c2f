"""Toxicity: a lexicon trie met by Levenshtein automata, and context windows that tell quotation from abuse.

From labelled rows, terms (whole words, or beginnings that many words share) are learned that occur in toxic texts only or almost only; they form a
trie. A word of a text runs through the product of the trie and the Levenshtein automaton of its entries, worked out state by state as
words need it, so misspelled terms are caught at the price of one look-up per letter. A hit in quotation marks, or near words of
reporting, counts apart from a plain one. A logistic model of these counts, fitted on the same rows, gives the score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from residua.functions.materialize import materialize
from residua.llm.common import column, packed, slices, unpacked

QUOTES = "\"'«»„“”‘’‹›`"
#: Words of reporting speech near a term.
REPORTING = frozenset("said says called calls wrote word term quote quoted quotes sagte nannte schrieb wort zitat dit appelé écrit mot citation dijo llamó escribió palabra cita".split())
FEATURES = 6


@dataclass(frozen=True)
class Toxicity:
    """``fit`` learns lexicon and weights from labelled rows, ``score`` judges every document.

    sample     labelled rows that are used at most, those with the smallest hash of their id: the bound of the fit
    least      toxic labelled texts a term must occur in
    purity     least share of toxic ones among the labelled texts with a term
    entries    terms of the lexicon at most, the most frequent first
    window     words to either side of a hit that are its context

    Defined results: null and empty texts have no hits; without labels of both kinds the lexicon is empty and every score is the share of
    toxic labels (0 if there are none); equal texts get equal scores; labels that are null are left out; an id with labels of both kinds
    counts as toxic; an empty table gives an empty table.
    """

    key: str = "doc_id"
    text: str = "text"
    sample: int = 20_000
    least: int = 5
    purity: float = 0.95
    entries: int = 2_000
    window: int = 6

    def fit(self, docs: DataFrame, labels: DataFrame, on: str = "doc_id", label: str = "toxic") -> ToxicityModel:
        known = labels.select(column(on).alias("_id"), column(label).cast("int").alias("_toxic")).where("_id is not null and _toxic is not null")
        chosen = known.groupBy("_id").agg(F.max("_toxic").alias("_toxic")).orderBy(F.xxhash64("_id"), "_id").limit(self.sample)
        chosen = materialize(chosen, "toxic-sample")
        # at most ``sample`` small rows
        rows = docs.select(column(self.key).alias("_key"), column(self.text).alias("_text")).join(F.broadcast(chosen), F.col("_key") == F.col("_id"))
        rows = materialize(rows.select("_id", "_toxic", "_text"), "toxic-rows")
        n = {r[0]: r[1] for r in rows.groupBy("_toxic").count().collect()}
        toxic, clean = n.get(1, 0), n.get(0, 0)
        share = toxic / (toxic + clean) if toxic + clean else 0.0
        if not toxic or not clean:
            return ToxicityModel(self, [], np.zeros(FEATURES), share)
        terms = rows.mapInArrow(count_terms, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        weight = clean / toxic  # as if both kinds were equally frequent
        pure = terms.where((F.col("toxic") >= self.least) & (F.col("toxic") * weight >= self.purity * (F.col("toxic") * weight + F.col("clean"))))
        lexicon = stems({r[0]: r[1] for r in pure.select("term", "toxic").collect()}, self.entries)  # terms of a bounded sample
        model = ToxicityModel(self, lexicon, np.zeros(FEATURES), share)
        seen = rows.select(F.col("_text"), F.col("_toxic")).mapInArrow(model.counter(["_toxic"]), "_toxic int, hits array<double>").toPandas()
        x, y = np.array(seen["hits"].to_list(), float).reshape(-1, FEATURES), seen["_toxic"].to_numpy(float)
        return ToxicityModel(self, lexicon, *logistic(x, y))


@dataclass(frozen=True)
class ToxicityModel:
    settings: Toxicity
    lexicon: list[str]
    weights: np.ndarray = field(repr=False)
    base: float

    def counter(self, carried: list[str], scored: bool = False):
        lexicon, window, weights, base = self.lexicon, self.settings.window, self.weights, self.base

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scanner = Scanner(lexicon, window)
            for batch, texts in slices(batches, "_text"):
                hits = np.array([scanner.features(t.decode()) for t in texts])
                arrays = [batch.column(c) for c in carried]
                if scored:
                    score = np.full(len(hits), base) if not weights.any() else sigmoid(hits @ weights + base)
                    arrays += [pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
                else:
                    arrays.append(pa.array(hits.tolist(), pa.list_(pa.float64())))
                yield pa.RecordBatch.from_arrays(arrays, names=[*carried, *(["score", "predicted"] if scored else ["hits"])])

        return run

    def score(self, docs: DataFrame) -> DataFrame:
        """All rows and columns, with ``score`` from 0 to 1 and ``predicted`` (1 from 0.5 on)."""
        made = ["score", "predicted"]
        base = packed(docs, made, _text=column(self.settings.text))
        schema = T.StructType([base.schema["row"], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
        return unpacked(base.mapInArrow(self.counter(["row"], scored=True), schema), made)


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with each word ('$' at its end) and each beginning of three letters and more, per label."""
    for batch, texts in slices(batches, "_text"):
        counts = {0: Counter(), 1: Counter()}
        for text, toxic in zip(texts, batch.column("_toxic").to_pylist(), strict=True):
            words = set(cores(text.decode().lower()))
            terms = {w[:k] for w in words for k in range(3, min(len(w), 16) + 1)}
            counts[1 if toxic else 0].update(terms)
            counts[1 if toxic else 0].update([w + "$" for w in words if 3 <= len(w) <= 16])
        names = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([counts[1][t] for t in names], pa.int64()), pa.array([counts[0][t] for t in names], pa.int64())], names=["term", "toxic", "clean"])


def cores(text: str) -> list[str]:
    """Runs of letters and digits."""
    return "".join([c if c.isalnum() else " " for c in text]).split()


def stems(toxic: dict[str, int], most: int) -> list[str]:
    """The lexicon of pure terms: from each shortest pure beginning on, as far as one longer term still covers nearly all of its texts."""
    longer: dict[str, list[str]] = {}
    for t in toxic:
        longer.setdefault(t[:-1], []).append(t)
    found = {}
    for t in toxic:
        if t[:-1] in toxic or t.endswith("$") and t[:-1] in toxic:
            continue
        queue = [t]
        while queue:
            at = queue.pop()
            nexts = [c for c in longer.get(at, []) if toxic[c] >= 0.2 * toxic[at]]
            near = [c for c in nexts if toxic[c] >= 0.95 * toxic[at]]
            if near:
                queue.append(max(near, key=lambda c: (toxic[c], c)))
            elif len(at.rstrip("$")) >= 4 or at.endswith("$"):
                found[at] = toxic[at]
            elif nexts:
                queue += nexts
            else:
                found[at] = toxic[at]
    return sorted(found, key=lambda t: (-found[t], t))[:most]


class Scanner:
    """The product of the lexicon trie and its entries' Levenshtein automata, determinised as words ask for states.

    A state maps trie nodes to the fewest edits that lead there. An entry of 5 to 7 letters allows one edit, a longer one two.
    """

    def __init__(self, lexicon: list[str], window: int):
        self.window = window
        self.children: list[dict[str, int]] = [{}]
        self.allowed = [0]  # most edits of any entry below a node
        self.entry: list[tuple[bool, int] | None] = [None]  # whole word, edits
        for entry in lexicon:
            whole, letters = entry.endswith("$"), entry.rstrip("$")
            edits = 0 if len(letters) < 5 else 1 if len(letters) < 8 else 2
            node = 0
            self.allowed[0] = max(self.allowed[0], edits)
            for c in letters:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.allowed.append(0)
                    self.entry.append(None)
                node = self.children[node][c]
                self.allowed[node] = max(self.allowed[node], edits)
            old = self.entry[node]
            self.entry[node] = (whole and (old is None or old[0]), edits)
        self.reset()

    def reset(self) -> None:
        start = self._closed({0: 0})
        self.states: dict[tuple, int] = {start: 0}
        self.nodes = [start]
        self.moves: list[dict[str, int]] = [{}]
        self.codes: dict[str, int] = {}

    def _closed(self, reached: dict[int, int]) -> tuple:
        """With the nodes that a letter missing in the word leads to."""
        queue = list(reached.items())
        while queue:
            node, edits = queue.pop()
            if edits > reached.get(node, 99):
                continue
            for child in self.children[node].values():
                if edits + 1 <= self.allowed[child] and edits + 1 < reached.get(child, 99):
                    reached[child] = edits + 1
                    queue.append((child, edits + 1))
        return tuple(sorted(reached.items()))

    def _move(self, state: int, letter: str) -> int:
        reached: dict[int, int] = {}
        for node, edits in self.nodes[state]:
            if edits + 1 <= self.allowed[node]:  # a letter too many
                reached[node] = min(edits + 1, reached.get(node, 99))
            for c, child in self.children[node].items():
                cost = edits + (c != letter)
                if cost <= self.allowed[child]:
                    reached[child] = min(cost, reached.get(child, 99))
        key = self._closed(reached)
        if key not in self.states:
            self.states[key] = len(self.nodes)
            self.nodes.append(key)
            self.moves.append({})
        self.moves[state][letter] = self.states[key]
        return self.states[key]

    def word(self, word: str) -> int:
        """0: no entry; 1: an entry as it stands; 2: one with edits."""
        state, best = 0, 99
        for letter in word:
            to = self.moves[state].get(letter)
            state = self._move(state, letter) if to is None else to
            if not self.nodes[state]:
                break
            for node, edits in self.nodes[state]:
                entry = self.entry[node]
                if entry and not entry[0] and edits <= entry[1]:
                    best = min(best, edits)
        else:
            for node, edits in self.nodes[state]:
                entry = self.entry[node]
                if entry and edits <= entry[1]:
                    best = min(best, edits)
        return 0 if best == 99 else 1 if best == 0 else 2

    def code(self, token: str) -> int:
        """Best hit of a token's runs of letters and digits."""
        found = self.codes.get(token)
        if found is None:
            if len(self.codes) > 300_000 or len(self.nodes) > 100_000:
                self.reset()
            kinds = [self.word(w) for w in cores(token)]
            found = self.codes[token] = 1 if 1 in kinds else 2 if 2 in kinds else 0
        return found

    def features(self, text: str) -> list[float]:
        if not self.entry[1:]:
            return [0.0] * FEATURES
        tokens = text.lower().split()
        known = self.codes
        hits = [(i, c) for i, t in enumerate(tokens) if (c := known[t] if t in known else self.code(t))]
        counts = [0, 0, 0, 0]  # plain and quoted, as it stands and with edits
        for i, c in hits:
            counts[2 * (c - 1) + self._quoted(tokens, i)] += 1
        plain = counts[0] + counts[2]
        return [*np.log1p(counts).tolist(), float(bool(hits)), 100.0 * plain / (100 + len(tokens))]

    def _quoted(self, tokens: list[str], at: int) -> int:
        """Whether marks open before and close after within the window, or a word of reporting stands in it."""
        before, after = tokens[max(0, at - self.window) : at + 1], tokens[at : at + self.window + 1]
        opened = any(t[:1] in QUOTES for t in before)
        closed = any(t.rstrip(".,;:!?")[-1:] in QUOTES and len(t) > 1 for t in after)
        return int(opened and closed or any(t.strip(".,;:!?") in REPORTING for t in before + after))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Weights and constant of a ridge logistic model, by Newton steps."""
    design = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(design.shape[1])
    penalty = np.diag([ridge] * x.shape[1] + [1e-6])
    for _ in range(rounds):
        p = sigmoid(design @ w)
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + penalty, design.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])
