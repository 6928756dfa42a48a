"""SimHash near-duplicates, candidates found by pigeonring filtering.

A fingerprint of 64 bits is cut into ``max_bits + 1`` segments on a ring.  If two
fingerprints differ in at most ``max_bits`` bits, some segment starts a chain in which
the first l segments together differ in at most l - 1 bits, for every l (the
proportional budget ``floor(l * max_bits / segments)``).  Candidates therefore share a key
that blanks out l - 1 bits of such a chain:

* length 1: one whole segment;
* length 2: that segment and the next one but for one bit; and so on;
* full length: everything but ``max_bits`` bits, so members of one key are links.

Short chains give few keys but large buckets, so only the members of buckets above
``bucket_rows`` go on to the next length.  Buckets are compared inside a task, chain
budgets first, then the whole distance, and give one link per member instead of all pairs.
Nothing is lost at any length: what is too large for one is decided by the next.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import fresh, stored
from daybook.llm.graph import components

BITS = 64
SEED = 42
#: Shingles hashed at once: bounds a task's memory on very long texts.
CHUNK = 1 << 16
#: Largest bucket compared inside a task.
BUCKET_ROWS = 1024


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The 64-bit fingerprint of a UTF-8 text, as an unsigned number; 0 without any word.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased; a text with fewer words than
    ``shingle`` has one shingle of all of them.  Repeated shingles count each time.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1].tolist()
    ends = ends[size - 1 :].tolist()
    digest, total = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), CHUNK):
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[at : at + CHUNK], ends[at : at + CHUNK])], "<u8")
        total += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(starts), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(x.as_py(), shingle) for x in batch.column(2)], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(prints)], ["doc_id", "mark", "fp"])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, mark, fp): mark is the text's hash, fp a signed 64-bit number; a null text has no words."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("mark"), text.cast("binary").alias("text"))
    return rows.mapInArrow(partial(_fingerprints, shingle=shingle), "doc_id bigint, mark bigint, fp bigint")


def segments(max_bits: int) -> list[list[int]]:
    """Bit positions of each segment, as even as can be."""
    cuts = [round(i * BITS / (max_bits + 1)) for i in range(max_bits + 2)]
    return [list(range(a, b)) for a, b in zip(cuts, cuts[1:])]


def chain_masks(max_bits: int, start: int, length: int) -> list[int]:
    """Masks of a chain of ``length`` segments from ``start``, with ``length - 1`` bits blanked.

    The first l segments have at most l - 1 of the blanks, for every l.
    """
    ring = segments(max_bits)
    ring = ring[start:] + ring[:start]
    where = {bit: i for i, bits in enumerate(ring[:length]) for bit in bits}
    whole = sum(1 << bit for bit in where)
    masks = []
    for blanks in combinations([b for b in where if where[b]], length - 1):
        used = [where[b] for b in blanks]
        if all(sum(u < n for u in used) < n for n in range(2, length + 1)):
            masks.append(whole - sum(1 << b for b in blanks))
    return masks


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _linked(fps: np.ndarray, key: np.ndarray, start: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside equal keys (sorted), one per member that has any: (member, smallest of its group)."""
    ring = segments(max_bits)
    masks = np.array([sum(1 << b for b in bits) for bits in ring], np.uint64)
    label = np.arange(len(fps))
    at, step, left, right = label, 1, [], []
    while True:
        at = at[at + step < len(fps)]
        at = at[key[at] == key[at + step]]
        if not len(at):
            break
        differ, near, used = fps[at] ^ fps[at + step], np.ones(len(at), bool), 0
        first = start[at]
        for n in range(1, max_bits + 1):  # the chain's first n segments within their budget
            used = used + np.bitwise_count(differ & masks[(first + n - 1) % len(ring)])
            near &= used <= n - 1
        near &= np.bitwise_count(differ) <= max_bits
        left.append(at[near])
        right.append(at[near] + step)
        step += 1
    if left:
        a, b = np.concatenate(left), np.concatenate(right)
        while len(a):
            low = np.minimum(label[a], label[b])
            if (label[a] == low).all() and (label[b] == low).all():
                break
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            label = label[label]
    member = np.flatnonzero(label != np.arange(len(fps)))
    return fps[member], fps[label[member]]


def _bucket_links(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Rows (start, mask, masked, fp) sorted by mask and masked; a bucket may span batches."""
    rest = None
    for batch in batches:
        rows = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)])
        rows = rows if rest is None else np.concatenate((rest, rows))
        if not len(rows):
            continue
        new = np.concatenate(([True], (rows[1:, 1:3] != rows[:-1, 1:3]).any(axis=1)))
        cut = np.flatnonzero(new)[-1]
        rest, done, key = rows[cut:], rows[:cut], np.cumsum(new)[:cut]
        if cut:
            yield _as_batch(_linked(np.ascontiguousarray(done[:, 3]).view(np.uint64), key, done[:, 0], max_bits))
    if rest is not None and len(rest):
        yield _as_batch(_linked(np.ascontiguousarray(rest[:, 3]).view(np.uint64), np.zeros(len(rest)), rest[:, 0], max_bits))


def _as_batch(links: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in links], ["u", "v"])


def links(fps: DataFrame, max_bits: int = 3, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(u, v): links that join all fingerprints (column fp, distinct) at ``max_bits`` or fewer differing bits.

    Not every pair: each bucket gives a spanning set, and all buckets together
    connect exactly what all pairs would connect.
    """
    spark, ring = fps.sparkSession, max_bits + 1
    if max_bits == 0:
        return spark.createDataFrame([], "u bigint, v bigint")
    members, found = fps.select("fp", F.explode(F.lit(list(range(ring)))).alias("start")), []
    for length in range(1, ring + 1):
        masks = {i: [_signed(m) for m in chain_masks(max_bits, i, length)] for i in range(ring)}
        if length <= 2:
            of = F.create_map(*[x for i, m in masks.items() for x in (F.lit(i), F.lit(m))])
            keyed = members.select("start", F.explode(of[F.col("start")]).alias("mask"), "fp")
        else:  # tens of thousands of masks, whatever the input: a constant table
            listed = spark.createDataFrame([(i, m) for i, ms in masks.items() for m in ms], "start int, mask bigint")
            keyed = members.join(F.broadcast(listed), "start").select("start", "mask", "fp")
        keyed = keyed.select("start", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("masked"), "fp")
        if length == ring:
            least = keyed.groupBy("mask", "masked").agg(F.min("fp").alias("v"))
            found.append(keyed.join(least, ["mask", "masked"]).select(F.col("fp").alias("u"), "v").where("u <> v").distinct())
            break
        large = stored(
            keyed.groupBy("mask", "masked").count().where(F.col("count") > bucket_rows).select("mask", "masked"), "large-buckets"
        )
        some = not large.isEmpty()
        small = keyed.join(large, ["mask", "masked"], "left_anti") if some else keyed
        found.append(
            small.select("start", "mask", "masked", "fp")
            .repartition("mask", "masked")
            .sortWithinPartitions("mask", "masked", "fp")
            .mapInArrow(partial(_bucket_links, max_bits=max_bits), "u bigint, v bigint")
        )
        if not some:
            break
        members = stored(keyed.join(large, ["mask", "masked"], "left_semi").select("fp", "start").distinct(), "large-members")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def grouped(docs: DataFrame, shingle: int = 3, max_bits: int = 3, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, mark, fp, keeper) per row of ``docs``: keeper is the component's row with the smallest
    doc_id, a struct (nameless, doc_id, mark)."""
    prints = stored(fingerprints(docs, shingle), "simhash")
    row = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "mark")
    nodes = prints.groupBy("fp").agg(F.min(row).alias("least"))
    reached = components(links(nodes.select("fp"), max_bits, bucket_rows))
    named = nodes.join(reached, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = stored(named, "simhash-nodes")
    of = named.groupBy("root").agg(F.min("least").alias("keeper"))
    of = named.join(of, "root").select(F.col("fp").alias("node"), "keeper")
    return prints.join(of, F.col("fp") == F.col("node")).drop("node")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id reachable over links, the document itself included.
    Equal fingerprints are one node, so thousands of copies cost one.  Null and empty texts have
    fingerprint zero and link like any other; a null doc_id never names a component unless
    the component has no other (then it is null); repeated rows come out as often as they came
    in; an empty table gives no rows; other columns are not looked at.
    """
    return grouped(docs, shingle, max_bits, bucket_rows).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("keeper")["doc_id"].alias("component_id"),
    )


def unique(docs: DataFrame, shingle: int = 3, max_bits: int = 3, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``docs`` with one document of each component: the one that names it.  All columns kept.

    Rows that repeat a doc_id and a text are one document, of which the row with the smallest hash of all its
    columns stays; among rows that share a doc_id (or have none) the one with the smallest text hash counts.  Null and
    empty texts are texts like any other; an empty table gives no rows.  Only rows that are
    repeated are grouped, so that other texts are not shuffled for it.
    """
    own = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "mark")
    names = [fresh(n, docs) for n in ("id__", "mark__", "row__")]
    a, b, r = names
    key = lambda column: F.coalesce(column.cast("bigint"), F.lit(-(1 << 63)))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    gone = grouped(docs, shingle, max_bits, bucket_rows).where(~own.eqNullSafe(F.col("keeper")))
    gone = stored(gone.select(key(F.col("doc_id")).alias(a), F.col("mark").alias(b)).distinct(), "simhash-gone")
    keyed = docs.withColumns({a: key(F.col("doc_id")), b: F.xxhash64(F.col("text").cast("string"))})
    row = F.xxhash64(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
    repeats = keyed.groupBy(a, b).agg(F.count("*").alias("n"), F.min(row).alias(r)).where("n > 1").drop("n")
    repeats = stored(repeats.join(gone, [a, b], "left_anti"), "simhash-repeats")
    left_out = gone.unionByName(repeats.select(a, b))
    single = keyed.join(left_out, [a, b], "left_anti").select(*columns)
    # what is left of a group is alike in every column
    first = keyed.withColumn(r, row).join(repeats, names, "left_semi").dropDuplicates([a, b]).select(*columns)
    return single.unionByName(first)
