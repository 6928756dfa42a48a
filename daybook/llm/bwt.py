"""Repeated byte strings by minimiser anchors and prefix doubling.

No Burrows-Wheeler transform is built, no shard's own suffix order and no common-prefix array: anchors
and doubling stand in for merged shard transforms, since an interleave over the corpus would be in one task
and only windows with a repeated anchor can repeat.  The rows are the same.

The question is which strings of ``length`` bytes start at two places or more.  Three steps:

1. **Shards of what can repeat.**  In every window of ``length`` bytes the smallest hash of its
   ``gram``-byte strings is its anchor.  Equal windows have equal anchors, so a window whose anchor occurs once cannot
   repeat.  Runs of windows with one repeated anchor, and the bytes they cover, are the texts
   that are compared; equal texts are kept once with their number.
2. **Doubling.**  The texts of a group of anchors are joined, and all their suffixes are sorted by their first 8 bytes
   into blocks of equal prefixes.  A block of prefixes twice as long is a pair of blocks, its own and
   that of the suffix further on; the pairs are sorted again at every doubling.  Blocks of one
   suffix are settled and leave.  At ``length`` bytes the remaining blocks are the repeated strings.
3. **Back to the texts.**  Windows in repeated intervals become removed spans of each document.

An anchor with very many different texts around it is not put into one task: its windows
are counted by a 128-bit key instead, over all executors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import stored

LENGTH, GRAM = 200, 50
#: Bytes handled at once inside a task; longer texts are taken in overlapping pieces.
PIECE = 1 << 18
#: Windows per text of a transform at most (longer runs are cut).
RUN = 512
#: Bytes of texts merged at once, and the number of texts around one anchor that go into one task.
MERGED_BYTES, ANCHOR_TEXTS = 1 << 20, 1 << 12
#: The bitmap that prunes windows has so many bits per anchor in it (to the next power of two), within these powers (32 MB
#: at most); what it lets through is decided exactly.
BITMAP_SHARE, BITMAP_LEAST, BITMAP_MOST = 64, 20, 28
#: Texts of transforms remembered by a task, so that a copy's bytes are not handed on twice.
SEEN = 1 << 18
BASE = 0x9E3779B97F4A7C15


_POWERS: list[np.ndarray] = []


def _powers() -> list[np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64; made once per process."""
    for base in (BASE, pow(BASE, -1, 1 << 64)) if not _POWERS else ():
        out = np.full(PIECE + 4 * RUN + LENGTH, base, np.uint64)
        out[0] = 1
        _POWERS.append(np.cumprod(out))
    return _POWERS


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes at each place."""
    up, down = _powers()
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])))
    out = (sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    return out


def sliding(data: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The best of each ``width`` neighbours, by doubling."""
    reach = 1
    while 2 * reach <= width:
        data = best(data[:-reach], data[reach:])
        reach *= 2
    left = width - reach
    return best(data[: len(data) - left], data[left:])


class Windows:
    """Anchors of all windows of several texts in a row."""

    def __init__(self, texts: list[bytes], length: int, gram: int):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts])
        self.begin = np.cumsum(sizes) - sizes
        n = len(self.data) - length + 1
        self.row = np.repeat(np.arange(len(texts)), sizes)
        self.valid = np.zeros(0, bool)
        if n > 0:
            self.hashes = gram_hashes(self.data, gram)
            self.anchor = sliding(self.hashes, length - gram + 1, np.minimum)
            self.valid = self.row[:n] == self.row[length - 1 :]

    def anchors(self, length: int, gram: int) -> np.ndarray:
        """The hash at each place that is the anchor of some window."""
        if not self.valid.any():
            return np.zeros(0, np.uint64)
        width = length - gram + 1
        held = np.concatenate((np.zeros(width - 1, np.uint64), np.where(self.valid, self.anchor, 0).astype(np.uint64), np.zeros(width - 1, np.uint64)))
        return self.hashes[self.hashes == sliding(held, width, np.maximum)]

    def runs(self, bitmap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First window and number of windows of each run with one anchor that is in the bitmap."""
        if not self.valid.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        held = self.valid & _held(bitmap, self.anchor)
        at = np.flatnonzero(held)
        if not len(at):
            return at, at
        new = np.concatenate(([True], (np.diff(at) != 1) | (self.anchor[at[1:]] != self.anchor[at[:-1]]) | (self.row[at[1:]] != self.row[at[:-1]])))
        first = np.flatnonzero(new)
        long = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
        first = np.flatnonzero(new | (long % RUN == 0))
        return at[first], np.diff(np.append(first, len(at)))


def pieces(texts: list[bytes | None], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts in groups of about PIECE bytes, longer ones in pieces that share no window: (rows, offsets, pieces)."""
    rows, offsets, parts, size = [], [], [], 0
    for i, text in enumerate(texts):
        for a in range(0, max(len(text or b"") - length + 1, 0), PIECE):
            part = text[a : a + PIECE + length - 1]
            if parts and size + len(part) > PIECE:
                yield rows, offsets, parts
                rows, offsets, parts, size = [], [], [], 0
            rows.append(i)
            offsets.append(a)
            parts.append(part)
            size += len(part)
    if parts:
        yield rows, offsets, parts


def _anchors(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, parts in pieces(batch.column(0).to_pylist(), length):
            anchor, n = np.unique(Windows(parts, length, gram).anchors(length, gram), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(n)], ["anchor", "n"])


def _held(bitmap: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    bit = anchors & np.uint64(64 * len(bitmap) - 1)
    return (bitmap[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def _found(batch: pa.RecordBatch, bitmap: np.ndarray, length: int, gram: int) -> Iterator[tuple]:
    """(windows, pieces, rows, offsets, first windows, numbers of windows) of each group of texts with any run."""
    for rows, offsets, parts in pieces(batch.column(batch.num_columns - 1).to_pylist(), length):
        made = Windows(parts, length, gram)
        first, n = made.runs(bitmap)
        if len(first):
            yield made, parts, np.array(rows), np.array(offsets), first, n


def _text_hashes(whole: bytes, first: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(whole[a:b]) for a, b in zip(first.tolist(), ends.tolist())], np.uint64).view(np.int64)


RUNS = "id bigint, mark bigint, anchor bigint, text_hash bigint, first int, windows int"


def _runs(batches: Iterator[pa.RecordBatch], shared, length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Where each run is and the hash of the text it covers."""
    bitmap = np.frombuffer(shared.value, np.uint64)
    for batch in batches:
        ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for made, parts, rows, offsets, first, n in _found(batch, bitmap, length, gram):
            which = made.row[first]
            place = first + offsets[which] - made.begin[which]
            hashes = _text_hashes(b"".join(parts), first, first + n + length - 1)
            columns = [ids[rows[which]], marks[rows[which]], made.anchor[first].view(np.int64), hashes, place.astype(np.int32), n.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "mark", "anchor", "text_hash", "first", "windows"])


TEXTS = "anchor bigint, text_hash bigint, n bigint, windows int, bytes binary"


def _texts(batches: Iterator[pa.RecordBatch], shared, wanted, length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """The texts of runs with a wanted anchor, each once per task."""
    bitmap, second, seen = np.frombuffer(shared.value, np.uint64), np.frombuffer(wanted.value, np.uint64), set()
    for batch in batches:
        for made, parts, _, _, first, n in _found(batch, bitmap, length, gram):
            chosen = _held(second, made.anchor[first])
            first, n, whole, texts, keep = first[chosen], n[chosen], b"".join(parts), [], []
            ends = first + n + length - 1
            hashes = _text_hashes(whole, first, ends)
            for i, key in enumerate(hashes.tolist()):
                if key not in seen:
                    if len(seen) > SEEN:
                        seen.clear()
                    seen.add(key)
                    keep.append(i)
                    texts.append(whole[first[i] : ends[i]])
            if keep:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(made.anchor[first[keep]].view(np.int64)), pa.array(hashes[keep]), pa.array(np.zeros(len(keep), np.int64)),
                        pa.array(n[keep].astype(np.int32)), pa.array(texts, pa.binary()),
                    ],
                    ["anchor", "text_hash", "n", "windows", "bytes"],
                )


def _refined(block: np.ndarray, alive: np.ndarray, depth: int, step: int, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of prefixes ``depth + step`` long from those ``depth`` long.

    ``alive``: places whose block has other members; only they are refined.  A place whose continuation is
    settled, or which has no room for the longer prefix, is settled too.
    """
    at = alive[room[alive] >= depth + step]
    at = at[block[at + step] >= 0]
    out = np.full(len(block), -1, np.int64)
    if len(at):
        pair = (block[at].astype(np.uint64) << np.uint64(32)) | block[at + step].astype(np.uint64)
        order = np.argsort(pair)
        ranked = pair[order]
        new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
        number = np.cumsum(new) - 1
        shared = np.bincount(number)[number] > 1
        out[at[order[shared]]] = number[shared]
        at = np.sort(at[order[shared]])
    return out, at


def repeated_windows(texts: list[bytes], counts: np.ndarray, windows: np.ndarray, length: int) -> list[np.ndarray]:
    """Which windows of each text start at two places or more, counting a text as often as it occurs."""
    data = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    n = int(ends[-1])
    room = np.repeat(ends, sizes) - np.arange(n)
    whose = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(n) - np.repeat(ends - sizes, sizes)
    packed = np.zeros(n, np.uint64)
    for i in range(8):
        packed = (packed << np.uint64(8)) | data[i : n + i]
    whole = np.flatnonzero(room >= 8)
    order = whole[np.argsort(packed[whole])]
    number = np.cumsum(np.concatenate(([True], packed[order[1:]] != packed[order[:-1]]))) - 1
    block = np.full(n, -1, np.int64)
    shared = np.bincount(number)[number] > 1
    block[order[shared]] = number[shared]
    alive, depth = np.sort(order[shared]), 8
    while depth < length and len(alive):
        step = min(depth, length - depth)
        block, alive = _refined(block, alive, depth, step, room)
        depth += step
    starts = alive[place[alive] < windows[whose[alive]]] if depth >= length else alive[:0]
    again = np.zeros(n, bool)
    if len(starts):
        interval = block[starts]
        again[starts] = np.bincount(interval, counts[whose[starts]])[interval] > 1
    out = []
    for i, (end, size) in enumerate(zip(ends.tolist(), sizes.tolist())):
        own = again[end - size : end - size + int(windows[i])]
        out.append(np.ones(len(own), bool) if counts[i] > 1 else own)
    return out


def _stretches(flags: np.ndarray) -> tuple[list[int], list[int]]:
    """First and number of each run of true."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return edge[::2].tolist(), (edge[1::2] - edge[::2]).tolist()


REPEATED = "anchor bigint, text_hash bigint, starts array<int>, lengths array<int>"


def _merged(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows (anchor, text_hash, n, windows, bytes) sorted by both; an anchor's texts may span batches.

    A text has several rows, of which one at least has its bytes, and occurs as often as their sum says.
    """
    held: list[list] = []
    types = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
    names = ["anchor", "text_hash", "starts", "lengths"]

    def out(rows: list[list]) -> pa.RecordBatch:
        rows = [r for r in rows if r[2]]  # the bitmap lets through texts that nobody asked for
        if not rows:
            return pa.RecordBatch.from_arrays([pa.array([], t) for t in types], names)
        flags = repeated_windows([r[4] for r in rows], np.array([r[2] for r in rows]), np.array([r[3] for r in rows]), length)
        # texts that occur more than once repeat as a whole, which their number tells without a merge
        found = [(r[0], r[1], *_stretches(f)) for r, f in zip(rows, flags) if r[2] == 1 and f.any()]
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate(types)], names)

    size = 0
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if held and row[:2] == (held[-1][0], held[-1][1]):
                held[-1][2] += row[2]
                if held[-1][4] is None and row[4] is not None:
                    held[-1][4] = row[4]
                    size += len(row[4])
                continue
            if size > MERGED_BYTES and row[0] != held[-1][0]:
                yield out(held)
                held, size = [], 0
            held.append(list(row))
            size += len(row[4] or b"")
    if held:
        yield out(held)


def _keys(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(anchor, text_hash, n, place, key) of every window."""
    for batch in batches:
        for anchor, text_hash, n, windows, text in zip(*[c.to_pylist() for c in batch.columns]):
            keys = [xxhash.xxh3_128_digest(text[i : i + length]) for i in range(windows)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x] * windows, pa.int64()) for x in (anchor, text_hash, n)] + [pa.array(range(windows), pa.int32()), pa.array(keys)],
                ["anchor", "text_hash", "n", "place", "key"],
            )


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            removed, runs, at, digest = 0, 0, 0, hashlib.sha256()
            for start, n in sorted((s["start"], s["n"]) for s in spans or []):
                end = start + n + length - 1
                if start > at or not runs:
                    digest.update(text[at:start])
                    runs += 1
                    removed += end - start
                elif end > at:
                    removed += end - at
                at = max(at, end)
            digest.update(text[at:])
            rows.append((len(text), removed, runs, digest.hexdigest()))
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate([pa.int64()] * 3 + [pa.string()])]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _bitmap(anchors: DataFrame) -> bytes:
    """The last bits of the anchors as a bitmap; the driver sees at most one row per word of it.

    Anchors are the smallest of many hashes, so their first bits are nearly all zero and tell little.
    """
    bits = min(max((BITMAP_SHARE * anchors.count() - 1).bit_length(), BITMAP_LEAST), BITMAP_MOST)
    word = F.expr(f"shiftright(anchor & {(1 << bits) - 1}L, 6)")
    one = F.expr("shiftleft(1L, cast(anchor & 63 AS int))")
    words = anchors.groupBy(word.alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    bitmap = np.zeros(1 << (bits - 6), np.uint64)
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return bitmap.tobytes()


def repeated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, anchor_texts: int = ANCHOR_TEXTS) -> DataFrame:
    """(id, mark, spans): for each document, stretches (start, n) of windows that occur elsewhere too."""
    spark = docs.sparkSession
    anchors = docs.select("text").mapInArrow(partial(_anchors, length=length, gram=gram), "anchor bigint, n bigint")
    twice = anchors.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
    twice = stored(twice, "bwt-twice")
    shared = spark.sparkContext.broadcast(_bitmap(twice))
    of = {"shared": shared, "length": length, "gram": gram}
    found = stored(docs.mapInArrow(partial(_runs, **of), RUNS), "bwt-runs")
    counts = found.groupBy("anchor", "text_hash").agg(F.count("*").alias("n"), F.max("windows").alias("windows"))
    counts = stored(counts, "bwt-counts")
    whole = counts.where("n > 1").select(
        "anchor", "text_hash", F.array(F.lit(0)).alias("starts"), F.array("windows").alias("lengths")
    )
    # only around anchors with a text that occurs once is anything left to find out
    groups = counts.groupBy("anchor").agg(F.count("*").alias("texts"), F.min("n").alias("least")).where("least = 1")
    # a single text that occurs once: its anchor is in it twice, or is one that the bitmap let through
    groups = stored(groups.join(twice, "anchor", "left_semi"), "bwt-groups")
    wanted = spark.sparkContext.broadcast(_bitmap(groups))
    # counts and bytes meet in one shuffle; a text's bytes come once per task that saw it
    texts = counts.join(groups.select("anchor"), "anchor", "left_semi").select(
        "anchor", "text_hash", "n", "windows", F.lit(None).cast("binary").alias("bytes")
    )
    texts = texts.unionByName(docs.mapInArrow(partial(_texts, wanted=wanted, **of), TEXTS))
    around = stored(groups.where(f"texts > {anchor_texts}").select("anchor"), "bwt-frequent")
    frequent = not around.isEmpty()
    usual = texts.join(around, "anchor", "left_anti") if frequent else texts
    merged = usual.repartition("anchor").sortWithinPartitions("anchor", "text_hash")
    merged = merged.select("anchor", "text_hash", "n", "windows", "bytes").mapInArrow(partial(_merged, length=length), REPEATED)
    merged = whole.unionByName(merged)
    if frequent:
        keys = "anchor bigint, text_hash bigint, n bigint, place int, key binary"
        held = texts.join(around, "anchor", "left_semi").groupBy("anchor", "text_hash")
        held = held.agg(F.sum("n").alias("n"), F.max("windows").alias("windows"), F.first("bytes", ignorenulls=True).alias("bytes"))
        keyed = stored(held.where("n > 0").mapInArrow(partial(_keys, length=length), keys), "bwt-keys")
        again = keyed.groupBy("anchor", "key").agg(F.sum("n").alias("times")).where("times > 1")
        more = keyed.where("n = 1").join(again, ["anchor", "key"]).groupBy("anchor", "text_hash")
        more = more.agg(F.collect_set("place").alias("starts"))
        merged = merged.unionByName(more.withColumn("lengths", F.transform("starts", lambda _: F.lit(1))))
    merged = stored(merged, "bwt-intervals")
    stretches = F.zip_with("starts", "lengths", lambda s, n: F.struct((s + F.col("first")).alias("start"), n.alias("n")))
    return (
        found.select("id", "mark", "anchor", "text_hash", "first")
        .join(merged, ["anchor", "text_hash"])
        .groupBy("id", "mark")
        .agg(F.flatten(F.collect_list(stretches)).alias("spans"))
    )


def deduplicated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, anchor_texts: int = ANCHOR_TEXTS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per row of ``docs`` (doc_id, text).

    Removed are the bytes covered by any string of ``length`` bytes that starts anywhere else too, the
    same document included; strings never cross documents.  Null texts are empty; texts below
    ``length`` bytes keep all; a row repeated is a document of its own, so both lose what they share;
    an empty table gives no rows; other columns are not looked at.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("id"),
        F.xxhash64(text).alias("mark"),
        text.cast("binary").alias("text"),
    )
    spans = repeated(rows.select("id", "mark", "text"), length, gram, anchor_texts)
    joined = rows.join(spans, ["id", "mark"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(
        partial(_cut, length=length), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    )
