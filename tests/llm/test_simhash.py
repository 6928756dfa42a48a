"""Pigeonring links against all pairs, fingerprints against their definition."""

import random
import re

import pytest
import xxhash

from daybook.llm import simhash as S
from daybook.llm.graph import components


def groups(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {n: find(n) for n in nodes}


def defined(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    size = min(3, len(words))
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("max_bits, bucket_rows, n", [(3, 1024, 200), (3, 3, 40), (2, 2, 40), (1, 2, 40), (0, 2, 10)])
def test_links_connect_what_all_pairs_connect(spark, max_bits, bucket_rows, n):
    # small buckets send the members through every chain length
    rnd = random.Random(max_bits)
    base = [rnd.getrandbits(64) for _ in range(8)]
    fps = set()
    for _ in range(n):
        x = rnd.choice(base)
        for _ in range(rnd.randint(0, 6)):
            x ^= 1 << rnd.randrange(64)
        fps.add(x)
    want = groups(fps, lambda a, b: (a ^ b).bit_count() <= max_bits)
    df = spark.createDataFrame([(S._signed(f),) for f in fps], "fp bigint")
    got = {}
    for r in components(S.links(df, max_bits, bucket_rows)).collect():
        got.setdefault(r.root, set()).add(r.node % (1 << 64))
    wanted = {}
    for node, root in want.items():
        wanted.setdefault(root, set()).add(node)
    assert {frozenset(g) for g in got.values()} == {frozenset(g) for g in wanted.values() if len(g) > 1}


def test_chains_cover_every_difference():
    rnd = random.Random(1)
    for _ in range(200):
        differ = sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 3)))
        for length in range(1, 5):
            assert any(differ & m == 0 for i in range(4) for m in (S.chain_masks(3, i, length) if length < 3 else [0]))


def test_documents_against_all_pairs(documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    fps = {i: defined(t) for i, t in texts.items()}
    want = groups(fps, lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.near_duplicates(documents).collect()}
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in fps}


def test_odd_documents(odd, empty):
    rows = S.near_duplicates(odd).collect()
    assert len(rows) == 12
    by = {r.doc_id: r for r in rows}
    assert {by[i].fingerprint for i in (1, 2, 3)} == {"0" * 16} and by[3].component_id == 1
    assert by[7].component_id == 6 and by[9].component_id == by[5].component_id
    assert [r.component_id for r in rows if r.doc_id is None].count(1) == 1
    kept = S.unique(odd)
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert kept.columns == odd.columns and len(set(ids)) == len(ids) and "7" not in ids and "9" not in ids
    assert S.near_duplicates(empty).count() == 0 and S.unique(empty).count() == 0


def test_long_paths_are_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "u bigint, v bigint")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
