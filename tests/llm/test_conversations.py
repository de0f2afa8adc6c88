"""Conversation repair and the prefix trie: registered queries against DuckDB on edge cases, the edit search
against dynamic programming, real outputs."""

from __future__ import annotations

import random

import duckdb
import pytest

from framecut.llm import catalog, conversation_repair, prefix_trie
from framecut.llm.oracle import ORACLE_SQL
from tests.conftest import SF001

#: Extra columns named like the operators' own.
SCHEMA = ("conv_id long, turn long, role string, text string, digest int, block int, depth int, cost int, audit string, "
          "present boolean, f1 int, kind int, copy int")
CLASH = (1, 2, 3, 4, "K", False, 5, 6, 7)


def _rows():
    rng = random.Random(7)
    roles, texts = ("system", "user", "assistant", "tool", "", None), ("Yes.", "No!", "what", "", " \n", None, "Hm. ")
    rows = []
    for conv in (*range(20, 64), 1000, 1005, -5, -21, None):
        n = rng.randrange(1, 9)
        rows += [(conv, t, rng.choice(roles[:3] if conv and conv % 2 else roles), rng.choice(texts)) for t in range(n)]
    # the same opening in many conversations, with and without a base
    for conv in (*range(100, 125), *range(203, 210)):
        rows += [(conv, 0, "user", "Hello."), (conv, 1, "assistant", "Good day."), (conv, 2, "user", f"Ask {conv % 3}.")]
    rows += [(300, None, "user", "No turn."), (300, 5, "user", "late"), (300, 5, "user", "late"), (300, 5, "a", "tie"),
             (300, 9, "assistant", "x" * 200_000 + "."), (301, None, None, None), (None, None, None, None)]
    rows += [(320, t, "user" if t % 2 else "assistant", f"w{t % 7} " * (t % 5) + ".") for t in range(700)]
    rows += rows[:9]
    rng.shuffle(rows)
    return rows


def _table(spark, folder, rows):
    (spark.createDataFrame([(*r, *CLASH) for r in rows], SCHEMA).repartition(5)
     .write.parquet(f"{folder}/conversations.parquet"))
    return folder


def _compare(spark, folder, name):
    found = getattr(catalog, name)(spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{folder}/conversations.parquet/*.parquet')")
    want = con.execute(ORACLE_SQL[name])
    columns = sorted(c[0] for c in want.description)
    assert sorted(found.columns) == columns
    got = found.select(*columns).collect()
    place = [[c[0] for c in want.description].index(c) for c in columns]
    expected = [tuple(r[k] for k in place) for r in want.fetchall()]
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    return got


@pytest.mark.parametrize("name", ["op11_conversation_repair", "op12_prefix_trie"])
def test_query_on_edge_cases(spark, scratch, name):
    assert len(_compare(spark, _table(spark, scratch, _rows()), name)) > 80


@pytest.mark.parametrize("name", ["op11_conversation_repair", "op12_prefix_trie"])
def test_query_on_empty_table(spark, scratch, name):
    folder = _table(spark, scratch, [])
    assert getattr(catalog, name)(spark, folder).collect() == []


def _by_row(rows):
    """(cost, audit) of the cheapest repair, state by state."""
    def with_inserts(best):
        for state in list(best) * 3 + list(range(4)) * 3:
            if state in best:
                cost, audit = best[state]
                to = conversation_repair.STEP[state]
                best[to] = min(best.get(to, (10 ** 9, "")), (cost + 3, audit + "I"))
        return best

    best = with_inserts({0: (0, "")})
    for initial, fault in rows:
        after = {}
        for state, (cost, audit) in best.items():
            ways = [(state, 4, "D")]
            if fault in (0, 3):
                ways.append((conversation_repair.STEP[state], 3 + fault, "R"))
                to = conversation_repair.keeps(state, initial)
                ways += [(to, fault, "K")] if to >= 0 else []
            for to, more, label in ways:
                after[to] = min(after.get(to, (10 ** 9, "")), (cost + more, audit + label))
        best = with_inserts(after)
    return min(best[s] for s in (0, 3) if s in best)


def test_edits_are_the_cheapest_and_least():
    rng = random.Random(3)
    for n in [*(rng.randrange(0, 12) for _ in range(1500)), 400, 401]:
        rows = [(rng.choice((0, 1, 1, 2, 2, 3)), rng.choice((0, 0, 0, 1, 2, 3))) for _ in range(n)]
        assert conversation_repair.edits(bytes(4 * i + f for i, f in rows)) == _by_row(rows)


def test_repaired_turns_are_a_dialogue(spark):
    turns = spark.createDataFrame(
        [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "user", "Hi."), (1, 3, "assistant", " "),
         (1, 4, "assistant", "Bye"), (2, 0, "assistant", "")], "conv_id long, turn long, role string, text string")
    got = sorted(map(tuple, conversation_repair.repaired_turns(turns).collect()))
    assert got == [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Bye")]


def test_products_compose():
    base = prefix_trie.BASES[0]
    turns = [prefix_trie.Product(k * 7919 + 3, base) for k in range(9)]

    def product(some):
        out = prefix_trie.Product()
        for t in some:
            out = out * t
        return out

    whole, head = product(turns), product(turns[:4])
    rest = whole.since(head, product(turns[4:]).shift)
    assert rest.hash == product(turns[4:]).hash and (head * rest).hash == whole.hash


def test_colliding_products_are_taken_again(spark, monkeypatch):
    # with base 1 a product is a sum, so turns in another order collide
    turns = [(c, k, "user", t) for c, order in ((20, "ab"), (40, "ba"), (60, "ab")) for k, t in enumerate(order)]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    want = sorted(map(tuple, prefix_trie.prefix_trie(table).collect()), key=repr)
    monkeypatch.setattr(prefix_trie, "BASES", (1, prefix_trie.BASES[0]))
    assert sorted(map(tuple, prefix_trie.prefix_trie(table).collect()), key=repr) == want
    monkeypatch.setattr(prefix_trie, "BASES", (1,))
    with pytest.raises(RuntimeError):
        prefix_trie.prefix_trie(table)


def test_one_conversation_exchange_per_pass(spark):
    turns = conversation_repair.damaged(spark.read.parquet(f"{SF001}/conversations.parquet"))
    plan = conversation_repair.audits(turns, "present")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
