import re
from collections import Counter

import numpy as np
import oracle
import pytest

from daybook.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    docs = [tuple(v or "" for v in r) for r in rows]  # (text, lang, source)
    out = []
    for lang in {d[1] for d in docs}:
        mine = [(TERM.findall(t.translate(LOWER)), s) for t, la, s in docs if la == lang]
        held = Counter(w for words, _ in mine for w in set(words))
        kept = sorted(w for w, n in held.items() if n >= least)
        counts = {s: Counter() for _, s in mine}
        for words, s in mine:
            counts[s].update(words)
        counts[None] = sum(counts.values(), Counter())
        total = {s: sum(c[w] for w in kept) + 2 * len(kept) for s, c in counts.items()}
        p = {s: {w: 1 + 10**9 * (c[w] + 2) // total[s] for w in kept} for s, c in counts.items()}

        def price(a, b):
            return (a - b) ** 2 // (a + b)

        for s in counts:
            if s is None:
                continue
            pairs = [(sum(price(p[s][w], p[o][w]) for w in kept), o) for o in counts if o not in (s, None)]
            terms = [(price(p[s][w], p[None][w]), w) for w in kept if counts[s][w] and p[s][w] > p[None][w]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda f: (-f[0], f[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:limit])]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_against_brute_force(frame, monkeypatch):
    monkeypatch.setattr(divergence, "STRIP", 30)
    dice = np.random.default_rng(5)
    words = np.array([f"{a}{b}" for a in ["ba", "Čo", "du", "élan", "F", "ß"] for b in ["", "la", "mi", "No", "é", "x-y", "7q"] for _ in range(1)])
    rows = []
    for i in range(700):
        source = None if i % 50 == 0 else f"s{min(int(dice.exponential(12)), 90)}" if i % 3 else "hot"
        text = None if i % 41 == 0 else " ".join(dice.choice(words, dice.integers(0, 30), p=np.arange(1, len(words) + 1) / np.arange(1, len(words) + 1).sum()))
        rows.append((text, [None, "aa", "bb"][min(2, i % 7)], source))
    rows += [("alone", "cc", "x"), (None, "cc", "y"), ("7 % .", "dd", None)]
    df = frame([(i, t, la, s, None) for i, (t, la, s) in enumerate(rows)])
    assert len({s for _, _, s in rows}) > 40
    assert rows_of(divergence.divergence(df)) == brute(rows, 10, 10)


def test_more_groups_than_a_block(frame, monkeypatch):
    monkeypatch.setattr(divergence, "STRIP", 7)
    rows = [(f"w{chr(97 + i % 26)} both w{chr(97 + i * i % 23)}", "en", f"host{i % 150}") for i in range(1200)]
    df = frame([(i, t, la, s, None) for i, (t, la, s) in enumerate(rows)])
    assert rows_of(divergence.divergence(df)) == brute(rows, 10, 10)


def test_odd_documents_and_an_empty_table(odd, empty):
    rows = [(r.text, r.lang, r.source) for r in odd.collect()]
    assert rows_of(divergence.divergence(odd, least_docs=2)) == brute(rows, 2, 10)
    assert divergence.divergence(empty).collect() == []


def test_slices_end_between_terms(monkeypatch):
    monkeypatch.setattr(divergence, "SLICE", 5)
    text = "Abc déf-ghijklmnopqrstuvwxyz 12x " * 700 + "z" * 10_000
    words = [w.decode() for part in divergence._words(text.encode(), divergence._folding()) for w in part]
    assert words == TERM.findall(text.translate(LOWER))


@pytest.mark.parametrize("terms", [1, 3, 64, 65, 130])
def test_walk_prices_every_term_once(terms):
    dice = np.random.default_rng(terms)
    blocks, dense = [], []
    for _ in range(2):
        zero = dice.integers(1, 50, 64)
        full = np.repeat(zero[:, None], terms, axis=1)
        rows, cols = np.nonzero(dice.random((64, terms)) < 0.01)
        full[rows, cols] = dice.integers(50, 10**9, len(rows))
        blocks.append((zero, rows, cols, full[rows, cols]))
        dense.append(full)
    sums, reached = divergence.joint_walk(*blocks, terms)
    base = divergence._prices(blocks[0][0][:, None], blocks[1][0][None, :])
    want = divergence._prices(dense[0][:, None, :], dense[1][None, :, :]).sum(axis=2)
    assert (sums + (terms - reached) * base == want).all()


def test_same_as_sql(spark, sf):
    want = oracle.duck_bag(oracle.connect(sf), divergence.ORACLE_SQL)
    assert oracle.difference(oracle.spark_bag(divergence.divergence(spark.read.parquet(f"{sf}/documents.parquet"))), want) == ""
