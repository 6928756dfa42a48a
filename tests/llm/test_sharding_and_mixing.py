"""Rendezvous hashing and raking against plain Python."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import oracle
import pytest

from daybook.llm import queries, raking
from daybook.llm import rendezvous as R


def shard(key, n):
    draw = lambda i: (int(hashlib.md5(f"{key}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
    return min(range(n), key=lambda i: -math.log(draw(i)))


def test_documents_get_the_shard_of_their_key(documents):
    rows = R.shards(documents).collect()
    texts = {r.doc_id: r.text.encode() for r in documents.collect()}
    slots = defaultdict(list)
    for r in rows:
        t = texts[r.doc_id]
        assert (r.size, r.text_crc32, r.law) == (len(t) + 1, zlib.crc32(t), "key")
        assert r.shard == shard(r.doc_id, 8) and r.grown_shard in (r.shard, 8) and r.grown_shard == shard(r.doc_id, 9)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(rows) == len(texts)


def test_weights_are_followed_and_few_records_move(spark):
    from pyspark.sql import functions as F

    keys = spark.range(20_000)
    got = keys.select(R.shard_of(F.col("id"), [1, 2, 0, 1]).alias("s"), R.shard_of(F.col("id"), [1, 2, 0, 1, 1]).alias("g")).collect()
    share = Counter(r.s for r in got)
    assert share[2] == 0 and abs(share[1] / 20_000 - 0.5) < 0.02 and abs(share[0] / 20_000 - 0.25) < 0.02
    moved = [r for r in got if r.s != r.g]
    assert all(r.g == 4 for r in moved) and abs(len(moved) / 20_000 - 0.2) < 0.02
    with pytest.raises(ValueError):
        R.shard_of(F.col("id"), [0, 0])


def test_odd_documents_are_sharded(odd, empty):
    rows = R.shards(odd).collect()
    assert len(rows) == 12 and {r.size for r in rows if r.doc_id == 1} == {1}
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert len({r.shard for r in rows if r.doc_id is None}) == 1 and R.shards(empty).count() == 0


def test_mix_matches_sql(spark, sf):
    con = oracle.connect(sf)
    assert oracle.difference(oracle.spark_bag(queries.op9_mixing(spark, sf)), oracle.duck_bag(con, raking.ORACLE_SQL)) == ""


def test_targets_are_met(frame):
    rows = [(i, "word " * (1 + i % 7), "en" if i % 3 else "de", "abc"[i % 5 % 3], None) for i in range(600)]
    docs = frame(rows)
    targets = {"source": {"a": 0.2, "b": 0.3, "c": 0.5}, "lang": {"en": 0.5, "de": 0.5}, "topic": {"prose": 1.0}}
    out = raking.mixed(docs, targets=targets).collect()
    mass = Counter()
    for r in out:
        for value in (r.source, r.lang):
            mass[value] += r["mix_tokens_"] * r["mix_probability"]
    total = mass["en"] + mass["de"]
    assert all(abs(mass[k] / total - v) < 1e-6 for d in ("source", "lang") for k, v in targets[d].items())
    assert max(r["mix_probability"] for r in out) == 1.0 and len(out) == 600
    sampled = raking.sample(docs, targets=targets)
    assert sampled.columns == docs.columns and {r.doc_id for r in sampled.collect()} == {r.doc_id for r in out if r["mix_kept_"]}
    other = raking.mixed(docs, targets={"source": {"a": 1.0, "(other)": 1.0}, "lang": {"en": 1.0}}).collect()
    assert all(r["mix_probability"] == 0 for r in other if r.lang == "de")
    got = Counter()
    for r in other:
        got[r.source == "a"] += r["mix_tokens_"] * r["mix_probability"]
    assert abs(got[True] - got[False]) < 1e-6 * got[True]


def test_odd_documents_are_mixed(odd, empty):
    rows = raking.decisions(odd).collect()
    assert len(rows) == 12 and {r.source for r in rows if r.doc_id == 1} == {"(none)"}
    assert len({(r.probability, r.kept) for r in rows if r.doc_id == 9}) == 1
    assert raking.decisions(empty).count() == 0 and raking.sample(empty).count() == 0
