"""Benchmark decontamination by template canonicalisation.

Texts and benchmark items become sequences of template tokens: words in lower case, and typed
placeholders for numbers, names and units, whose values are kept as slots.  Windows of
template tokens are hash-joined.  What matches along one diagonal (the same shift between
item and document) must fill the item's slots consistently: equal values in the item have equal values
in the document.  So a question whose numbers or persons were exchanged is still found.  A
capitalised word that begins a sentence or line may be a name or not, and is read both ways.
"""

from __future__ import annotations

import math
import re
import string
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import stored, without

#: Template tokens per window; items of fewer tokens are one window of their own length.
WINDOW = 8
#: Items of fewer template tokens than this are too common to be looked for inside sentences: they match
#: whole sentences or lines that have the same words.
LEAST_ITEM = 4
#: Matched item tokens that make a leak, or this share of a shorter item.
LEAST_TOKENS, LEAST_SHARE = 12, 0.8
#: Share of an item's repeated slot values that must be filled as they were the first time.
CONSISTENT = 0.5
#: Bits of the benchmark's window hashes in the bitmap that prunes document windows (2 MB).
BITMAP_BITS = 24
#: Copies of the benchmark's windows in the join, so that one passage's rows go to several tasks.
SALTS = 8
PIECE, TOKENS, VOCABULARY = 1 << 21, 1 << 19, 1 << 20
#: Windows, in all their readings, that are hashed at once.
READINGS = 1 << 21

#: Marks stripped from words, and units (after a number only).
MARKS = string.punctuation + "“”„‘’«»…–—·•¿¡"
UNITS = frozenset(
    "% mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers "
    "mg g kg t lb lbs oz gram grams kilogram kilograms ton tons pound pounds ounce ounces ml l cl dl liter liters litre litres gallon gallons "
    "s sec ms min h hr hrs second seconds minute minutes hour hours day days week weeks month months year years "
    "usd eur gbp dollar dollars euro euros cent cents percent mph kmh hz khz mhz ghz kb mb gb tb w kw v a j kj cal kcal n pa k c f".split()
)
#: Number words (English, German, French, Spanish), without those that are articles or units too.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen half twice first third fourth fifth sixth "
    "seventh eighth ninth tenth quarter null eins zwei drei vier fünf sechs sieben acht neun zehn elf zwölf dreizehn vierzehn fünfzehn sechzehn "
    "siebzehn achtzehn neunzehn zwanzig dreißig vierzig fünfzig sechzig siebzig achtzig neunzig hundert tausend "
    "deux trois quatre cinq sept huit neuf dix onze douze treize quatorze quinze seize vingt trente quarante cinquante soixante cent mille "
    "dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince dieciséis diecisiete dieciocho diecinueve veinte treinta "
    "cuarenta cincuenta sesenta ochenta noventa cien ciento mil".split()
)
NUMBER, MEASURE = re.compile(r"\d[\d.,:/-]*"), re.compile(r"(\d[\d.,]*)([^\W\d_]{1,3}|%)")
LINE, END = "\x01", "\x02"
LITERAL, NUM, NAME, UNIT, QUANTITY, DROPPED = range(6)
KINDS = np.array([f"<{x}>" for x in ("literal", "number", "name", "unit", "quantity", "")])
PLACEHOLDERS = np.array([0] + [xxhash.xxh64_intdigest(k.encode()) for k in KINDS[1:]], np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary(dict):
    """word -> number; for each number the hash of its core, its kind and whether it ends a sentence."""

    def __init__(self):
        super().__init__()
        self.cores, self.rows, self.made = [], [], 0
        self.code = np.zeros(0, np.uint64)
        self.kind = self.ends = np.zeros(0, np.int8)

    def __missing__(self, word: str) -> int:
        core = word.strip(MARKS)
        if word == "%":
            core = word
        lower = core.lower()
        if not core or word in (LINE, END):
            kind = DROPPED
        elif core[0].isdigit() and NUMBER.fullmatch(core):
            kind = NUM
        elif core[0].isdigit() and (m := MEASURE.fullmatch(lower)) and m[2] in UNITS:
            kind = QUANTITY
        elif lower in NUMBER_WORDS or ("-" in lower and all(part in NUMBER_WORDS for part in lower.split("-"))):
            kind = NUM
        elif len(core) > 1 and core[0].isupper() and core[1:].islower():
            kind = NAME  # unless it begins a sentence
        else:
            kind = LITERAL
        ends = word in (LINE, END) or word.rstrip("\"'”’»)")[-1:] in (".", "!", "?", ":")
        self.rows.append((xxhash.xxh64_intdigest(lower.encode("utf-8", "replace")), kind, ends, lower in UNITS))
        self.cores.append(core)
        self[word] = len(self.rows) - 1
        return len(self.rows) - 1

    def arrays(self) -> None:
        if self.made < len(self.rows):
            self.code = np.array([r[0] for r in self.rows], np.uint64)
            self.kind, self.ends, self.unit = (np.array([r[i] for r in self.rows], np.int8) for i in (1, 2, 3))
            self.made = len(self.rows)

    def numbers(self, text: str) -> np.ndarray:
        """The words of a text, line ends among them, and END."""
        parts, a = [], 0
        while a < len(text):
            b = a + PIECE
            while b < len(text) and not text[b].isspace():
                b += 1
            words = text[a:b].replace("\n", f" {LINE} ").split()
            parts.append(np.fromiter(map(self.__getitem__, words), np.int64, len(words)))
            a = b
        return np.concatenate([np.array([self[LINE]]), *parts, np.array([self[END]])])


class Template:
    """The template tokens of several texts in a row.

    A capitalised word that begins a sentence is a token of its own that is ``either`` literal or a
    name; ``joined``: where a name follows it, both are one name ("Tom Smith has", but "So Tom has").
    """

    def __init__(self, words: Vocabulary, texts: list[np.ndarray], joined: bool = False):
        words.arrays()
        raw = np.concatenate(texts)
        row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        kind, initial = words.kind[raw], np.concatenate(([True], words.ends[raw[:-1]].astype(bool)))
        either = (kind == NAME) & initial
        followed = either & np.append((kind == NAME)[1:] & ~initial[1:], False)
        self.joined, self.followed = joined, np.bincount(row[followed], minlength=len(texts)) > 0
        if joined:
            either &= ~followed
        kind = np.where(either, LITERAL, kind)
        kept = np.flatnonzero(kind != DROPPED)
        self.kind, self.word, self.row = kind[kept], raw[kept], row[kept]
        self.raw, self.kept = raw, kept
        together = np.concatenate(([False], (np.diff(kept) == 1))) & np.concatenate(([False], self.row[1:] == self.row[:-1]))
        after = np.concatenate(([LITERAL], self.kind[:-1]))
        self.kind = np.where(together & (after == NUM) & (words.unit[self.word] == 1) & (self.kind == LITERAL), UNIT, self.kind)
        more = together & (self.kind == NAME) & (after == NAME) & ~initial[kept]  # a name of several words is one slot
        first = np.flatnonzero(~more)
        self.last = np.append(first[1:], len(more))
        self.first, self.all_words, self.word_row = first, self.word, self.row
        self.kind, self.row = self.kind[first], self.row[first]
        self.either = either[kept][first] & (self.kind == LITERAL)
        exact = words.code[self.word[first]]
        self.exact, self.code = exact, np.where(self.kind == LITERAL, exact, PLACEHOLDERS[self.kind])
        self.words = words

    def windows(self, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(first token, hash, reading) of each window of ``size`` tokens within one text.

        Each word that is either literal or a name is read both ways, whatever the others are: bit i
        of a reading tells that token i is a name.  Windows without any literal word are hashed with their
        values: they are no evidence unless they agree word for word.
        """
        n = len(self.code) - size + 1
        if n <= 0:
            return
        slots = np.concatenate(([0], np.cumsum(self.kind != LITERAL)))
        slots = slots[size:] - slots[:-size]
        hashed = np.zeros(n, np.uint64)
        for i in range(size):
            hashed *= BASE
            hashed += self.code[i : n + i]
        every = np.flatnonzero(self.row[:n] == self.row[size - 1 :])
        yield every, self._finished(every, hashed[every], slots[every], size), np.zeros(len(every), np.int64)
        open_ = np.concatenate(([0], np.cumsum(self.either)))
        ways = np.left_shift(1, (open_[size:] - open_[:-size])[every])
        every, ways = every[ways > 1], ways[ways > 1]
        power = np.array([pow(int(BASE), size - 1 - i, 1 << 64) for i in range(size)], np.uint64)
        for at in np.split(every, np.flatnonzero(np.diff(np.cumsum(ways) // READINGS)) + 1):
            h, filled, reading = hashed[at], slots[at], np.zeros(len(at), np.int64)
            for i in range(size):
                both = np.flatnonzero(self.either[at + i])
                if len(both):
                    first = at[both]
                    as_name = h[both] + (PLACEHOLDERS[NAME : NAME + 1] - self.code[first + i]) * power[i]
                    at, h = np.append(at, first), np.append(h, as_name)
                    filled, reading = np.append(filled, filled[both] + 1), np.append(reading, reading[both] | 1 << i)
            named = reading > 0
            at, reading = at[named], reading[named]
            yield at, self._finished(at, h[named], filled[named], size), reading

    def sentences(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(first token, hash) of each run of ``size`` words that is whole sentences or lines."""
        n = len(self.all_words) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        # whether a sentence or line ended since the word before
        ended = np.concatenate(([0], np.cumsum(self.words.ends[self.raw])))[self.kept]
        starts = np.concatenate(([True], np.diff(ended) > 0))
        stops = np.append(starts[1:], True)
        at = np.flatnonzero(starts[:n] & stops[size - 1 :] & (self.word_row[:n] == self.word_row[size - 1 :]))
        hashed = np.full(len(at), size, np.uint64)
        for i in range(size):
            hashed = hashed * BASE + self.words.code[self.all_words[at + i]]
        hashed ^= hashed >> np.uint64(31)
        hashed *= np.uint64(0x94D049BB133111EB)
        hashed ^= hashed >> np.uint64(30)
        return np.searchsorted(self.first, at, side="right") - 1, hashed

    def _finished(self, at: np.ndarray, hashed: np.ndarray, filled: np.ndarray, size: int) -> np.ndarray:
        bare = np.flatnonzero(filled == size)
        if len(bare):
            exact = np.zeros(len(bare), np.uint64)
            for i in range(size):
                exact = exact * BASE + self.exact[at[bare] + i]
            hashed[bare] = ~exact
        hashed ^= hashed >> np.uint64(29)
        hashed *= np.uint64(0xBF58476D1CE4E5B9)
        hashed ^= hashed >> np.uint64(32)
        return hashed

    def value(self, token: int) -> str:
        """Kind and words of a placeholder; a word that is ``either`` ends with LINE."""
        words = " ".join(self.words.cores[w] for w in self.all_words[self.first[token] : self.last[token]])
        return f"{KINDS[NAME]}{words}{LINE}" if self.either[token] else f"{KINDS[self.kind[token]]}{words}"

    def run(self, at: int, step: int, reach: int) -> list[str]:
        """The values of the placeholders from a token on or back, at most ``reach``, up to the next literal word."""
        out = []
        while len(out) < reach and 0 <= at < len(self.kind) and self.kind[at] != LITERAL and self.row[at] == self.row[at - step]:
            out.append(self.value(at))
            at += step
        return out

    def needed(self) -> int:
        """Literal words that must agree where placeholders are most of what does; a word that may be a name counts less."""
        literal, either = int((self.kind == LITERAL).sum()), int(self.either.sum())
        return max(1, math.ceil(LEAST_SHARE * (literal - either)), math.ceil(literal / 2))

    def slots(self, at: int, size: int, reading: int) -> list[str | None]:
        """The value of each placeholder of a window, None for literal words."""
        return [None if self.kind[at + i] == LITERAL and not reading >> i & 1 else self.value(at + i) for i in range(size)]


def templates(texts: list[str | None], words: Vocabulary) -> Iterator[tuple[list[int], Template]]:
    """Templates of groups of texts: (rows, template), and once more joined for those where that differs."""

    def made(rows: list[int], parts: list[np.ndarray]) -> Iterator[tuple[list[int], Template]]:
        yield rows, (template := Template(words, parts))
        again = np.flatnonzero(template.followed).tolist()
        if again:
            yield [rows[i] for i in again], Template(words, [parts[i] for i in again], joined=True)

    rows, parts, size = [], [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        if len(words) > VOCABULARY and not rows:
            words.__init__()
            words.clear()
        rows.append(i)
        parts.append(words.numbers(text))
        size += len(parts[-1])
        if size >= TOKENS:
            yield from made(rows, parts)
            rows, parts, size = [], [], 0
    if rows:
        yield from made(rows, parts)


ITEM = "item_id bigint, item_joined boolean, place int, hash bigint, slots array<string>, size int, tokens int, needed int, before array<string>, after array<string>"


def _item_windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    words = Vocabulary()
    for batch in batches:
        ids, out = batch.column(0).to_pylist(), []
        for i, text in enumerate(batch.column(1).to_pylist()):
            for _, template in templates([text], words):
                tokens = len(template.code)
                size, needed = min(window, tokens), template.needed()
                if tokens >= LEAST_ITEM:
                    for at, hashed, reading in template.windows(size):
                        for a, h, r in zip(at.tolist(), hashed.view(np.int64).tolist(), reading.tolist()):
                            runs = template.run(a - 1, -1, tokens), template.run(a + size, 1, tokens)
                            out.append((ids[i], template.joined, a, h, template.slots(a, size, r), size, tokens, needed, *runs))
                elif tokens and not template.joined:
                    # the whole item, word for word; its size, below 0, tells it from windows
                    length = len(template.all_words)
                    _, hashed = template.sentences(length)
                    out.append((ids[i], False, 0, int(hashed.view(np.int64)[0]), [None] * tokens, -length, tokens, needed, [], []))
        yield _batch(out, ITEM)


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}
    fields = [f.split() for f in ddl.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)], [name for name, _ in fields]
    )


def _hit(bitmap: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    bit = hashed >> np.uint64(64 - BITMAP_BITS)
    return (bitmap[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


FOUND = "doc_id bigint, mark bigint, joined boolean, at int, hash bigint, slots array<string>, size int, before array<string>, after array<string>"


def _document_windows(batches: Iterator[pa.RecordBatch], shared, sizes: list[int], reach: int) -> Iterator[pa.RecordBatch]:
    words, bitmap = Vocabulary(), shared.value
    for batch in batches:
        ids, marks, out = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
        for rows, template in templates(batch.column(2).to_pylist(), words):
            begin = np.searchsorted(template.row, np.arange(len(rows)))
            for size in sizes:
                if size < 0:
                    at, hashed = template.sentences(-size) if not template.joined else (begin[:0], begin[:0].astype(np.uint64))
                    for a, h in zip(at[_hit(bitmap, hashed)].tolist(), hashed[_hit(bitmap, hashed)].view(np.int64).tolist()):
                        row = int(template.row[a])
                        out.append((ids[rows[row]], marks[rows[row]], False, a - int(begin[row]), h, [], size, [], []))
                    continue
                for at, hashed, reading in template.windows(size):
                    hit = _hit(bitmap, hashed)
                    for a, h, r in zip(at[hit].tolist(), hashed[hit].view(np.int64).tolist(), reading[hit].tolist()):
                        row = int(template.row[a])
                        runs = template.run(a - 1, -1, reach), template.run(a + size, 1, reach)
                        out.append((ids[rows[row]], marks[rows[row]], template.joined, a - int(begin[row]), h, template.slots(a, size, r), size, *runs))
            if len(out) > 1 << 14:
                yield _batch(out, FOUND)
                out = []
        yield _batch(out, FOUND)


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, mark, item_id, item_tokens, matched_tokens, at_token, slots, consistent, verbatim): leaks only.

    One row per document and item of which it holds at least LEAST_TOKENS tokens along one diagonal (or
    LEAST_SHARE of a shorter item) with consistent slots; of several places the longest, then the first.
    Windows with fewer literal words than placeholders count for this if their values agree too.  Otherwise, and
    with the placeholders next to what matches, LEAST_SHARE of the whole item and of its literal words
    must agree, so that number-heavy items are found with other numbers.
    ``verbatim``: every slot has the item's own value.  ``mark`` is the text's hash, so
    documents that share a null or repeated doc_id stay apart; rows that repeat both are one document.
    Items of fewer than LEAST_ITEM tokens are found where the same words are whole sentences or lines.
    Null and empty texts and items match nothing; empty tables give no rows; other columns are not looked at.

    The bitmap that prunes document windows has a fixed size; the join after it is exact.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = stored(items.mapInArrow(partial(_item_windows, window=window), ITEM), "decontam-items")
    sizes = {r["size"]: r["tokens"] for r in items.groupBy("size").agg(F.max("tokens").alias("tokens")).collect()}  # at most ``window``
    bit = F.shiftrightunsigned("hash", 64 - BITMAP_BITS)
    filled = items.groupBy(F.shiftright(bit, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - BITMAP_BITS}) & 63 AS int))")).alias("bits")
    )
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    for row in filled.collect():  # at most one row per word of the bitmap
        bitmap[row["word"]] = row["bits"] % (1 << 64)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("mark"),
        F.col("text").cast("string").alias("text"),
    )
    found = rows.mapInArrow(partial(_document_windows, shared=spark.sparkContext.broadcast(bitmap), sizes=list(sizes), reach=max(sizes.values(), default=0)), FOUND)
    found = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "mark", "at"), F.lit(SALTS)).cast("int"))
    wanted = items.withColumnsRenamed({c: f"item_{c}" for c in ("slots", "before", "after")}).withColumn("salt", F.explode(F.lit(list(range(SALTS)))))
    filling = F.zip_with(
        "item_slots", "slots", lambda item, doc: F.struct(item.alias("item"), doc.alias("doc"))
    )
    # a word that may be a name and is the same in both agrees as a literal word too: no slot
    filling = F.filter(
        F.transform(filling, lambda p, i: F.struct((F.col("place") + i).alias("token"), p["item"].alias("item"), p["doc"].alias("doc"))),
        lambda p: p["item"].isNotNull() & ~(p["item"].endswith(LINE) & (p["item"] == p["doc"])),
    )
    word = lambda v: F.rtrim(v, F.lit(LINE))
    filling = F.transform(filling, lambda p: F.struct(p["token"].alias("token"), word(p["item"]).alias("item"), word(p["doc"]).alias("doc")))
    held = F.size(F.filter("item_slots", lambda v: v.isNotNull()))
    strong = (2 * held <= F.col("size")) | (held == F.col("size")) | ~F.exists(filling, lambda p: p["item"] != p["doc"])
    literals = F.transform("item_slots", lambda v, i: F.when(v.isNull(), F.col("place") + i))

    def run(name: str, step: int, start: Column) -> Column:
        """What the placeholders beside a window are filled with, as long as their kinds agree."""
        kind = lambda v: F.substring_index(v, ">", 1)
        pairs = F.zip_with(f"item_{name}", name, lambda item, doc: F.struct(item.alias("item"), doc.alias("doc")))
        end = F.array_position(F.transform(pairs, lambda p: F.coalesce(kind(p["item"]) == kind(p["doc"]), F.lit(False))), False)
        pairs = F.slice(pairs, 1, F.when(end == 0, F.size(pairs)).otherwise(end - 1).cast("int"))
        return F.transform(pairs, lambda p, i: F.struct((start + step * i).alias("token"), p["item"].alias("item"), p["doc"].alias("doc")))

    span = lambda first, end: F.struct(first.cast("int").alias("first"), end.cast("int").alias("end"))
    matches = found.join(wanted, ["hash", "size", "salt"]).withColumns({"filling": filling, "strong": strong, "literals": literals})
    end = F.col("place") + F.when(F.col("size") < 0, F.col("tokens")).otherwise(F.col("size"))
    matches = matches.withColumns({"back": run("before", -1, F.col("place") - 1), "on": run("after", 1, F.col("place") + F.col("size")), "end": end})
    # a group has one row per item token and reading at most: the windows of one diagonal
    together = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    lines = matches.groupBy(
        "doc_id", "mark", "item_id", "tokens", "needed", "item_joined", "joined", (F.col("at") - F.col("place")).alias("shift")
    ).agg(
        F.array_sort(F.collect_set(F.when(F.col("strong"), span(F.col("place"), F.col("end"))))).alias("spans"),
        together(F.when(F.col("strong"), F.col("filling"))).alias("slots"),
        F.array_sort(F.collect_set(span(F.col("place") - F.size("back"), F.col("end") + F.size("on")))).alias("all_spans"),
        together(F.concat("back", "filling", "on")).alias("all_slots"),
        F.size(F.array_compact(F.array_distinct(F.flatten(F.collect_list("literals"))))).alias("literals"),
    )

    def judged(spans: str, slots: str) -> Column:
        covered = F.aggregate(
            spans,
            F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
            lambda s, x: F.struct(
                F.greatest(s["end"], x["end"]).alias("end"), (s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(s["end"], x["first"]))).alias("n")
            ),
            lambda s: s["n"],
        )
        # item values that come more than once must be filled as they were the first time
        first = lambda p: F.filter(slots, lambda q: q["item"] == p["item"])[0]
        repeats = F.filter(slots, lambda p: first(p)["token"] < p["token"])
        agreeing = F.filter(repeats, lambda p: first(p)["doc"] == p["doc"])
        return F.struct(
            covered.alias("matched_tokens"),
            (F.get(spans, F.lit(0))["first"] + F.col("shift")).alias("at_token"),
            F.size(slots).alias("slots"),
            F.when(F.size(repeats) > 0, F.size(agreeing) / F.size(repeats)).otherwise(F.lit(1.0)).alias("consistent"),
            (~F.exists(slots, lambda p: p["item"] != p["doc"])).alias("verbatim"),
        )

    share = F.ceil(LEAST_SHARE * F.col("tokens")).cast("int")
    enough = F.least(F.lit(LEAST_TOKENS), share)
    lines = lines.withColumns({"some": judged("spans", "slots"), "whole": judged("all_spans", "all_slots")})
    by_some = (F.col("some.matched_tokens") >= enough) & (F.col("some.consistent") >= CONSISTENT)
    by_whole = (F.col("whole.matched_tokens") >= share) & (F.col("literals") >= F.col("needed")) & (F.col("whole.consistent") >= CONSISTENT)
    told = ("matched_tokens", "at_token", "slots", "consistent", "verbatim")
    return (
        lines.select("*", F.when(by_whole, F.col("whole")).when(by_some, F.col("some")).alias("line"))
        .where("line IS NOT NULL")
        .groupBy("doc_id", "mark", "item_id")
        .agg(
            F.max_by(
                F.struct("line", F.col("tokens").alias("item_tokens")),
                F.struct("line.matched_tokens", ~F.col("item_joined"), ~F.col("joined"), -F.col("shift")),
            ).alias("best")
        )
        .select("doc_id", "mark", "item_id", "best.item_tokens", *[f"best.line.{c}" for c in told])
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without those that leak an item, all columns kept.

    Null and empty texts leak nothing; repeated rows stay or go together, since the decision depends on doc_id and
    text alone; without items, or documents, nothing goes.
    """
    return without(docs, leaks(docs, benchmark, window))
