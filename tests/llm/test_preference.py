import random
from collections import defaultdict

import pytest

from residua.functions.running import sketch_rows
from residua.llm.preference import PreferenceFormat


def brute(rows, pairs):
    conversations = defaultdict(dict)
    for c, t, role, text in rows:
        if c is not None and t is not None:
            key = lambda x: ((x[0] is not None, x[0] or ""), (x[1] is not None, x[1] or ""))
            old = conversations[c].get(t)
            conversations[c][t] = min([x for x in (old, (role, text)) if x is not None], key=key)
    out = []
    for p, a, b in set(pairs):
        ca, cb = conversations.get(a), conversations.get(b)
        if not ca or not cb:
            continue
        turns = sorted(set(ca) | set(cb))
        split = next((t for t in turns if ca.get(t, 0) != cb.get(t, 0)), None)
        if split is None:
            continue
        show = lambda x: f"<|{x[0] or ''}|>\n{x[1] or ''}\n"
        out += [(p, "prompt", t, ca[t][0], show(ca[t]), 0) for t in ca if t < split]
        for part, own in (("chosen", ca), ("rejected", cb)):
            out += [(p, part, t, own[t][0], show(own[t]), int(own[t][0] == "assistant")) for t in own if t >= split]
    return sorted(out, key=repr)


ROWS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"), (1, 3, "user", "more"), (1, 4, "assistant", "yes"),
    (2, 0, "system", "be kind"), (2, 1, "user", "hi"), (2, 2, "assistant", "go away"),
    (3, 0, "user", "hi"), (3, 1, "assistant", None), (4, 0, "user", "hi"), (4, 1, "assistant", ""),
    (5, 0, "user", "alone"), (6, 0, None, "x"), (6, 2, "assistant", "gap"), (7, 0, None, "x"), (7, 1, "assistant", "z"),
    (1, 2, "assistant", "hello"), (None, 0, "user", "x"), (2, None, "user", "x"), (8, 0, "user", "hi"), (8, 0, "assistant", "hi"),
]
SCHEMA = "conv_id long, turn long, role string, text string, loss int"


def test_by_brute_force(spark):
    rows = spark.createDataFrame([(*r, 1) for r in ROWS], SCHEMA)
    pairs = [(10, 1, 2), (11, 3, 4), (12, 1, 1), (13, 5, 99), (14, 6, 7), (10, 1, 2), (15, 8, 3), (16, 2, 1)]
    out = PreferenceFormat().format(rows, spark.createDataFrame(pairs, "pair_id long, chosen long, rejected long"))
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute(ROWS, pairs)


def single(rows):
    """Sides of the pairs of single conversations, by plain Python: turns and pairs for ``brute``."""
    conversations = defaultdict(dict)
    for c, t, role, text in rows:
        if c is not None and t is not None:
            key = lambda x: ((x[0] is not None, x[0] or ""), (x[1] is not None, x[1] or ""))
            old = conversations[c].get(t)
            conversations[c][t] = min([x for x in (old, (role, text)) if x is not None], key=key)
    replies = {c: sorted(t for t in own if own[t][0] == "assistant") for c, own in conversations.items()}
    order = sorted(c for c, found in replies.items() if found)
    turns, pairs = [], []
    for c, after in zip(order, order[1:] + order[:1]):
        if c == after:
            continue
        own, first, last, other = conversations[c], replies[c][0], replies[c][-1], conversations[after][replies[after][-1]][1]
        begin, end = {0: (last, last), 1: (first, last), 2: (first, first)}[c % 3]
        turns += [(str(c), t, *own[t]) for t in own if t <= last]
        turns += [(f"{c} rejected", t, own[t][0], other if own[t][0] == "assistant" and t >= begin else own[t][1]) for t in own if t <= end]
        pairs.append((c, str(c), f"{c} rejected"))
    return conversations, turns, pairs


def judged(rows):
    conversations, turns, pairs = single(rows)
    out = brute(turns, pairs)
    return sorted(out + [(c, "unpaired", None, None, None, 0) for c in conversations if c not in {r[0] for r in out}], key=repr)


def formatted(spark, rows):
    out = PreferenceFormat().format_single(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA))
    assert out.columns == ["pair_id", "part", "turn", "role", "rendered", "loss"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_pairs_of_single_conversations(spark):
    got = formatted(spark, ROWS)
    assert got == judged(ROWS)
    # only 5 has no reply
    assert {r[0] for r in got if r[1] == "unpaired"} == {5}
    assert [r[2] for r in got if r[0] == 1 and r[1] == "rejected"] == [2, 3, 4]


@pytest.mark.parametrize("seed", range(3))
def test_pairs_of_random_conversations(spark, seed):
    """Gaps in the ids, negative ids, conversations without a reply, equal replies, replies of several turns."""
    rng = random.Random(seed)
    rows = [
        (c, t, rng.choice(["user", "assistant", "assistant", None]), rng.choice(["a", "b", "c", "", None]))
        for c in rng.sample(range(-40, 400), 40)
        for t in sorted(rng.sample(range(12), rng.randint(1, 7)))
    ]
    got = formatted(spark, rows)
    assert got == judged(rows)
    assert {r[1] for r in got} == {"prompt", "chosen", "rejected", "unpaired"}


def test_next_conversation_across_ranges(spark, monkeypatch):
    """The order of ids cut into several ranges gives the same pairs."""
    monkeypatch.setattr("residua.llm.preference.sketch_rows", lambda n: sketch_rows(n, 7))
    rows = [(3 * c + c % 2, t, ("user", "assistant")[t % 2], f"{c} {t}") for c in range(30) for t in range(4)]
    assert formatted(spark, rows) == judged(rows)


def test_only_even_ids(spark):
    rows = [(c, t, ("user", "assistant")[t], f"text {c}") for c in (0, 2, 4, 6) for t in (0, 1)]
    assert {r[0] for r in formatted(spark, rows) if r[1] == "rejected"} == {0, 2, 4, 6}


def test_one_conversation(spark):
    assert formatted(spark, [(7, 0, "user", "hi"), (7, 1, "assistant", "yes")]) == [(7, "unpaired", None, None, None, 0)]


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    turns, pairs = PreferenceFormat().reply_pairs(none)
    assert PreferenceFormat().format(turns, pairs).count() == 0
    assert PreferenceFormat().format_single(none).count() == 0
