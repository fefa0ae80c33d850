"""Operators on conversations, against SQL and brute force on small tables."""

from __future__ import annotations

import hashlib
import random

import duckdb
import numpy as np
import pytest

from pyspark.sql import functions as F
from shopgrain.llm import conversation_repair, oracle_conversations, prefix_trie

from .test_queries import canonical

SCHEMA = "conv_id long, turn long, role string, text string, id string, row long, piece int, gaps string"
ROLES = ["system", "user", "assistant", "tool", "", None]
TEXTS = ["Yes.", "No!", "why", "", " \t", None, "How so? ", "a b", "é́ 😀.", "x:y\nz."]


def table(spark, rows):
    """Rows with further columns whose names are those of the operators'."""
    return spark.createDataFrame([(*r, "i", 1, 2, "g") for r in rows], SCHEMA)


def by_sql(query, df):
    duck = duckdb.connect()
    duck.register("conversations", df.toArrow())
    return canonical(duck.execute(query).to_arrow_table())


def made(seed, n, roles=ROLES, texts=TEXTS):
    """Conversations with nulls, ties, repeated rows, gaps, and many that begin alike."""
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(n)]:
        for turn in range(rng.choice([1, 1, 2, 3, 5, 9])):
            turn = rng.choice([turn, turn, turn, turn, turn + 3, None])
            rows.append((conv, turn, rng.choice(roles), rng.choice(texts)))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return table(spark, made(1, 130)).cache()


def test_repair_equals_sql_on_odd_rows(odd):
    damaged = conversation_repair.damaged(odd)
    expected = by_sql(oracle_conversations.OP11, odd)
    for long in (conversation_repair.LONG, 3):  # the second takes the path for long conversations
        found = conversation_repair.repaired(damaged, there=F.col("there"), long=long)
        assert canonical(found.toArrow()) == expected


def brute_repair(rows):
    """All sequences of edits: the least (cost, audit), and the repaired lines."""
    best = None

    def go(i, state, cost, audit, lines, inserted):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(rows) and state in ("", "a") and (best is None or (cost, audit) < best[:2]):
            best = cost, audit, lines
        legal = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        names = {"u": "user", "a": "assistant"}
        for to in set(legal) & {"u", "a"}:
            if inserted < 3:
                go(i, to, cost + 2, audit + "I", (*lines, names[to] + ":"), inserted + 1)
        if i == len(rows):
            return
        role, text = rows[i]
        body = text.strip(" \t\n\x0b\x0c\r")
        go(i + 1, state, cost + 3, audit + "D", lines, 0)
        if not body or rows[i] in rows[:i]:
            return
        cut = body[-1] not in ".!?"
        if role[:1] and role[:1] in legal:
            go(i + 1, role[:1], cost + cut, audit + "K", (*lines, f"{role}:{text}"), 0)
        for to in set(legal) & {"u", "a"}:
            go(i + 1, to, cost + 2 + cut, audit + "R", (*lines, f"{names[to]}:{text}"), 0)

    go(0, "", 0, "", (), 0)
    return best[0], best[1], hashlib.sha256("\n".join(best[2]).encode()).hexdigest()


@pytest.mark.parametrize("chunk", [1, 2, 3, 128])
def test_repair_is_the_cheapest(monkeypatch, chunk):
    monkeypatch.setattr(conversation_repair, "CHUNK", chunk)
    rng = random.Random(chunk)
    for _ in range(400):
        rows = [
            (rng.choice(["system", "user", "user", "assistant", "tool", ""]), rng.choice(["", "a.", "b!", "c", "d?", "e "]))
            for _ in range(rng.randint(0, 6))
        ]
        conversation = conversation_repair._Conversation(1)
        for turn, (role, text) in enumerate(rows):
            conversation.add(turn, role, text, None)
        assert conversation.result()[6:] == brute_repair(rows)


def test_repair_of_long_conversations(spark):
    """A third of all rows in one conversation, decided in many chunks, next to short ones."""
    rng = random.Random(5)
    rows = [(7, i, rng.choice(ROLES[:4]), rng.choice(["Yes.", "no", f"t{i}.", f"u{i}"])) for i in range(1500)]
    rows += [(8 + i // 3, i % 3, rng.choice(ROLES[:3]), f"{i}.") for i in range(3000)]
    df = table(spark, rows)
    found = canonical(conversation_repair.repaired(df, long=1000).toArrow())
    assert found == canonical(conversation_repair.repaired(df).toArrow())
    whole = conversation_repair._Conversation(7)
    for _, turn, role, text in rows[:1500]:
        whole.add(turn, role, text, None)
    at = found[0].index("repaired_sha256")
    (row,) = [r for r in found[1] if r[found[0].index("conv_id")] == 7]
    assert row[at] == whole.result()[-1]


def test_repair_without_rows(spark, odd):
    assert conversation_repair.repaired(odd.limit(0)).count() == 0
    (row,) = conversation_repair.repaired(table(spark, [(3, None, "user", "x")]), there=F.lit(False)).collect()
    assert tuple(row) == (3, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())


@pytest.mark.parametrize(("block", "piece_bits"), [(64, 14), (1, 0), (2, 1), (3, 3), (64, 2)])
def test_trie_equals_sql_on_odd_rows(odd, block, piece_bits):
    """Small blocks and pieces make every path of the operator meet these rows."""
    found = prefix_trie.trie(prefix_trie.rebuilt(odd), block, piece_bits)
    assert canonical(found.toArrow()) == by_sql(oracle_conversations.OP13, odd)


@pytest.mark.parametrize(("block", "piece_bits"), [(2, 2), (3, 1)])
def test_trie_of_copies(spark, block, piece_bits):
    """Conversations that are often copies or beginnings of each other."""
    df = table(spark, made(3, 200, ["user"], ["a", "a", "a b"])).where("turn is not null")
    found = prefix_trie.trie(prefix_trie.rebuilt(df), block, piece_bits)
    assert canonical(found.toArrow()) == by_sql(oracle_conversations.OP13, df)


def test_prefixes_as_they_are(spark, odd):
    rows = [(1, 0, "u", "a b"), (1, 1, "a", "c"), (2, 0, "u", "a b"), (3, 0, "u", "a b"), (3, 1, "a", "d e f")]
    found = {(r.conv_id, r.depth): r for r in prefix_trie.prefixes(table(spark, rows)).collect()}
    assert set(found) == {(1, 0), (1, 1), (1, 2), (3, 2)}
    root, first = found[1, 0], found[1, 1]
    assert (root.n_convs, root.n_children, root.n_leaves, root.saved_tokens, root.parent_conv_id) == (3, 1, 2, 4, None)
    assert (first.n_children, first.saved_tokens, found[3, 2].parent_conv_id) == (2, 4, 1)
    assert first.ends_sha256 == hashlib.sha256(b"2").hexdigest()
    assert prefix_trie.prefixes(odd.limit(0)).count() == 0


def test_range_minima():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 7, 64, 100):
        values = rng.integers(-1, 4, n)
        minima = prefix_trie.RangeMinima(values)
        at, bound = rng.integers(0, n, 50), rng.integers(0, 4, 50)
        left, right = minima.left(at, bound), minima.right(at, bound)
        for i, b, lo, hi in zip(at, bound, left, right, strict=True):
            expected_lo, expected_hi = i, i
            while expected_lo > 0 and values[expected_lo] >= b:
                expected_lo -= 1
            while expected_hi + 1 < n and values[expected_hi + 1] >= b:
                expected_hi += 1
            assert (lo, hi) == (expected_lo, expected_hi)
            assert minima.least(np.array([lo]), np.array([hi]))[0] == values[lo : hi + 1].min()
