"""Language identification by interpolated Kneser-Ney character models in sorted arrays.

Training counts character 4-grams of all documents of each language.  Lower orders count distinct left
neighbours, as Kneser and Ney have it, and are interpolated with absolute discounts.  A model
is a few sorted arrays of packed n-grams (four 16-bit characters are one 64-bit number)
with their probabilities; a lookup is a binary search.  The language is the one with the
lowest cross-entropy per character.

Calibration uses the training documents' own scores: the temperature at which the
likelihood ratios predict the labels best gives ``score``; a low score is rejected, and so is a
cross-entropy far above what the language's documents of that length have.  What they have is taken from
medians over distinct texts, which junk among them moves little while it is the smaller part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import stored, without

ORDER = 4
#: Characters handled at once inside a task; longer texts are taken in pieces.
PIECE = 1 << 20
#: N-grams of each order kept of a language at most (the most frequent), and of all languages together: bounds the
#: model that is broadcast.  What is not kept goes to the back-off of its context; no language is ever lost.
MAX_GRAMS, MAX_ALL = 200_000, 4_000_000
#: Distinct n-grams a task gathers before it hands them on.
FLUSH = 1 << 20
#: A cross-entropy this many (median absolute, scaled to standard) deviations above its language's median is rejected.
MAX_DEVIATIONS = 8.0
#: A calibrated score below this is rejected: the guess is more likely wrong than right.
LEAST_SCORE = 0.5
#: Steps a bit in which cross-entropies are counted for the medians, and standard deviations a median absolute one.
STEPS, SCALE = 256, 1.4826
#: Bits per character that count as one deviation at least.
LEAST_SPREAD = 0.1
UNDETERMINED = "und"
BLANK, ASTRAL, CUT = 0x20, 0xFFFE, 0xFFFF
TEMPERATURES = [2.0**-i for i in range(13)]


_FOLD: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """Character -> itself if a letter, else blank; made once per process."""
    if not _FOLD:
        _FOLD.append(np.array([c if chr(c).isalpha() else BLANK for c in range(0x10000)], np.uint16))
    return _FOLD[0]


def codes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Folded characters of several texts in a row and where each begins.

    Letters are lower-cased, runs of anything else become one blank, and each text starts with
    ORDER - 1 blanks.  Characters beyond 16 bits are one letter if they are letters.
    """
    cut = chr(CUT)
    raw = np.frombuffer(cut.join([t.replace(cut, " ").lower() for t in ["", *texts]]).encode("utf-32-le", "surrogatepass"), "<u4")
    at = raw == CUT
    big = raw > CUT
    out = _fold()[np.minimum(raw, CUT)]
    if big.any():
        kinds, which = np.unique(raw[big], return_inverse=True)
        out[big] = np.array([ASTRAL if chr(c).isalpha() else BLANK for c in kinds], np.uint16)[which]
    out[at] = CUT
    keep = (out != BLANK) | np.concatenate(([True], (out[:-1] != BLANK) & (out[:-1] != CUT)))[: len(out)]
    out = out[keep]
    repeats = np.where(out == CUT, ORDER - 1, 1)
    starts = np.cumsum(repeats) - repeats
    starts = starts[out == CUT]
    out = np.repeat(np.where(out == CUT, BLANK, out).astype(np.uint16), repeats)
    return out, starts


def grams_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed n-grams of all texts, the text each belongs to, and the number of each text's."""
    codes, starts = codes_of(texts)
    ends = np.concatenate((starts[1:], [len(codes)]))
    counts = np.maximum(ends - starts - (ORDER - 1), 0)
    wide = codes.astype(np.uint64)
    packed = np.zeros(max(0, len(codes) - ORDER + 1), np.uint64)
    for i in range(ORDER):
        packed = (packed << np.uint64(16)) | wide[i : len(codes) - ORDER + 1 + i]
    whose = np.repeat(np.arange(len(texts)), ends - starts)[ORDER - 1 :] if len(codes) >= ORDER else np.zeros(0, int)
    inside = np.ones(len(packed), bool)
    for i in range(1, ORDER):  # n-grams that begin in the text before
        spot = starts[1:] - i
        inside[spot[(spot >= 0) & (spot < len(packed))]] = False
    return packed[inside], whose[inside], counts


def pieces(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Whole texts in groups of about PIECE characters, longer ones in pieces: (rows, pieces)."""
    rows, parts, size = [], [], 0
    for i, text in enumerate(texts):
        text = text or ""
        for a in range(0, max(len(text), 1), PIECE):
            part = text[a : a + PIECE]
            rows.append(i)
            parts.append(part)
            size += len(part)
            if size >= PIECE:
                yield rows, parts
                rows, parts, size = [], [], 0
    if rows:
        yield rows, parts


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, which = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(which, np.concatenate(counts), len(found)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, (keys, counts) in held.items():
            key, n = _summed(keys, counts)
            for a in range(0, len(key), FLUSH // 8):
                part = slice(a, a + FLUSH // 8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(key[part])), pa.array(key[part].view(np.int64)), pa.array(n[part])], ["lang", "gram", "n"]
                )
        held.clear()

    for batch in batches:
        langs = batch.column(0).to_pylist()
        for rows, parts in pieces(batch.column(1).to_pylist()):
            by: dict[str, list[str]] = {}
            for row, part in zip(rows, parts):
                by.setdefault(langs[row], []).append(part)
            for lang, texts in by.items():
                key, n = np.unique(grams_of(texts)[0], return_counts=True)
                keys, counts = held.setdefault(lang, ([], []))
                keys.append(key)
                counts.append(n)
                if sum(map(len, keys)) > FLUSH // 2:
                    key, n = _summed(keys, counts)
                    held[lang] = ([key], [n])
        if sum(len(k) for keys, _ in held.values() for k in keys) > FLUSH:
            yield from out()
    yield from out()


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all documents with a language and a text."""
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(F.col("lang").cast("string"), F.col("text").cast("string"))
    return rows.mapInArrow(_count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _orders(counts: DataFrame) -> DataFrame:
    """(lang, k, gram, n) of every order: occurrences of the longest n-grams, distinct left neighbours of shorter ones."""
    below, out = counts.select("lang", "gram", "n"), None
    for k in range(ORDER, 0, -1):
        if k < ORDER:
            shorter = F.col("gram").bitwiseAND(F.lit((1 << 16 * k) - 1))
            below = below.groupBy("lang", shorter.alias("gram")).agg(F.count("*").alias("n"))
        level = below.select("lang", F.lit(k).alias("k"), "gram", "n")
        out = level if out is None else out.unionByName(level)
    return out


def _kept(levels: DataFrame, most: int) -> DataFrame:
    """``levels`` with ``kept``: the ``most`` most frequent of each language and order, of equally frequent ones by hash."""
    sizes = levels.groupBy("lang", "k", "n").agg(F.count("*").alias("grams"))
    down = Window.partitionBy("lang", "k").orderBy(F.desc("n"))
    room = F.greatest(F.lit(most) - (F.sum("grams").over(down) - F.col("grams")), F.lit(0))
    share = F.least(F.lit(1.0), room / F.col("grams"))
    by = sizes.select(F.col("lang").alias("l"), F.col("k").alias("o"), F.col("n").alias("m"), share.alias("share"))
    same = (F.col("lang") == F.col("l")) & (F.col("k") == F.col("o")) & (F.col("n") == F.col("m"))
    chance = F.pmod(F.xxhash64("gram"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return levels.join(by, same).select("lang", "k", "gram", "n", (chance < F.col("share")).alias("kept"))


def model_parts(counts: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(lang, k, gram, own) of the n-grams kept and (lang, k, context, rest) of their contexts.

    Discounts, totals and continuation counts are those of all n-grams; ``rest`` is what a context leaves to its
    back-off: its discounts and the share of what is not kept.
    """
    levels = stored(_orders(counts), "langid-orders")
    ones, twos = (F.sum(F.when(F.col("n") == i, 1).otherwise(0)) for i in (1, 2))
    share = F.when((ones > 0) & (twos > 0), F.least(F.greatest(ones / (ones + 2 * twos), F.lit(0.1)), F.lit(0.9))).otherwise(0.5)
    discounts = levels.groupBy("lang", "k").agg(share.alias("discount"))
    judged = _kept(levels, most).join(discounts, ["lang", "k"])
    judged = judged.withColumn("context", F.shiftrightunsigned("gram", 16))
    left = F.col("n") - F.col("discount")
    contexts = judged.groupBy("lang", "k", "context").agg(
        F.sum("n").alias("total"),
        ((F.max("discount") * F.count("*") + F.sum(F.when(F.col("kept"), 0.0).otherwise(left))) / F.sum("n")).alias("rest"),
        F.max("kept").alias("used"),
    )
    contexts = stored(contexts.where("used"), "langid-contexts")
    grams = judged.where("kept").join(contexts.select("lang", "k", "context", "total"), ["lang", "k", "context"])
    return grams.select("lang", "k", "gram", (left / F.col("total")).alias("own")), contexts.select("lang", "k", "context", "rest")


class CharModel:
    """One language: for each order its n-grams and contexts, sorted, with their parts of the probability."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        order = np.argsort(grams)
        key, n = grams[order], counts[order].astype(np.float64)
        self.levels = {}
        for k in range(ORDER, 0, -1):
            ones, twos = (n == 1).sum(), (n == 2).sum()
            discount = float(np.clip(ones / (ones + 2 * twos), 0.1, 0.9)) if ones and twos else 0.5
            context, first = np.unique(key >> np.uint64(16), return_index=True)
            total = np.add.reduceat(n, first)
            kinds = np.diff(np.append(first, len(key)))
            own = (n - discount) / np.repeat(total, kinds)
            self.levels[k] = (key, own, context, discount * kinds / total)
            # the next lower order counts the distinct characters to the left
            key, n = np.unique(key & np.uint64((1 << 16 * (k - 1)) - 1), return_counts=True)
            n = n.astype(np.float64)
        whole = self.levels[ORDER][0]
        self.known, self.bits = whole, self.unknown_bits(whole)

    @classmethod
    def of_orders(cls, levels: dict[int, tuple[np.ndarray, ...]]) -> CharModel:
        """From (n-grams, own, contexts, rest) of each order, in any order."""
        model = cls.__new__(cls)
        model.levels = {}
        for k, (gram, own, context, rest) in levels.items():
            by, of = np.argsort(gram), np.argsort(context)
            model.levels[k] = (gram[by], own[by], context[of], rest[of])
        model.known = model.levels[ORDER][0]
        model.bits = model.unknown_bits(model.known)
        return model

    def parts(self) -> tuple:
        """The arrays alone, to be broadcast."""
        return self.levels, self.known, self.bits

    @classmethod
    def of(cls, parts: tuple) -> CharModel:
        model = cls.__new__(cls)
        model.levels, model.known, model.bits = parts
        return model

    def unknown_bits(self, grams: np.ndarray) -> np.ndarray:
        """-log2 probability of the last character of each n-gram, by interpolation from the unigram up."""
        p = np.full(len(grams), 1.0 / (1 << 16))
        for k in range(1, ORDER + 1):
            key, own, context, rest = self.levels[k]
            gram = grams & np.uint64((1 << 16 * k) - 1)
            at, seen = _find(context, gram >> np.uint64(16))
            spot, there = _find(key, gram)
            p = np.where(seen, np.where(there, own[spot], 0.0) + rest[at] * p, p)
        return -np.log2(p)

    def cost(self, grams: np.ndarray) -> np.ndarray:
        at, seen = _find(self.known, grams)
        out = self.bits[at]
        if not seen.all():
            out[~seen] = self.unknown_bits(grams[~seen])
        return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def train(docs: DataFrame, max_grams: int = MAX_GRAMS, max_all: int = MAX_ALL) -> dict[str, CharModel]:
    """A model per language of ``docs``.

    The driver holds at most ``max_grams`` n-grams of each language and order, and about ``max_all`` of each order whatever the
    number of languages; everything the probabilities are made of is counted by Spark.
    """
    counts = stored(gram_counts(docs), "langid-counts")
    n = counts.select("lang").distinct().count()
    if not n:
        return {}
    grams, contexts = model_parts(counts, max(1, min(max_grams, max_all // n)))
    rows, rests, models = grams.toArrow(), contexts.toArrow(), {}
    for lang in sorted(pc.unique(rows["lang"]).to_pylist()):
        levels = {}
        for k in range(1, ORDER + 1):
            own, rest = (t.filter(pc.and_(pc.equal(t["lang"], lang), pc.equal(t["k"], k))) for t in (rows, rests))
            levels[k] = (own["gram"].to_numpy().view(np.uint64), own["own"].to_numpy(), rest["context"].to_numpy().view(np.uint64), rest["rest"].to_numpy())
        models[lang] = CharModel.of_orders(levels)
    return models


def _entropies(texts: list[str | None], models: list[CharModel]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters, whether there is any letter, and bits under each model, of each text."""
    size, bits = np.zeros(len(texts), np.int64), np.zeros((len(texts), len(models)))
    letters = np.zeros(len(texts), bool)
    for rows, parts in pieces(texts):
        grams, whose, counts = grams_of(parts)
        row = np.array(rows)
        np.add.at(size, row, counts)
        np.logical_or.at(letters, row[whose[(grams & np.uint64(0xFFFF)) != BLANK]], True)
        kinds, which = np.unique(grams, return_inverse=True)
        for k, model in enumerate(models):
            np.add.at(bits[:, k], row, np.bincount(whose, model.cost(kinds)[which], len(parts)))
    return size, letters, bits


def _score(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    models = [CharModel.of(parts) for parts in shared.value]
    for batch in batches:
        size, letters, bits = _entropies(batch.column(batch.num_columns - 1).to_pylist(), models)
        per = bits / np.maximum(size, 1)[:, None]
        listed = pa.ListArray.from_arrays(np.arange(len(size) + 1, dtype=np.int32) * len(models), per.ravel())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(size), pa.array(letters), listed],
            [*batch.schema.names[:-1], "n", "letters", "entropies"],
        )


def _medians(counted: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The median of a whole-numbered column with ``docs`` occurrences of each value, and the sum of these, by ``keys``."""
    summed = counted.groupBy(*keys, F.col(value).alias("value")).agg(F.sum("docs").alias("docs"))
    whole = Window.partitionBy(*keys)
    so_far = F.sum("docs").over(whole.orderBy("value"))
    passed = summed.withColumn("passed", 2 * so_far >= F.sum("docs").over(whole))
    return passed.groupBy(*keys).agg(F.min(F.when(F.col("passed"), F.col("value"))).alias("median"), F.sum("docs").alias("docs"))


def _usual(counted: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, docs, median and spread of the cross-entropies that ``counted`` (lang, band, step, docs) has."""
    middle = _medians(counted, keys, "step")
    # one row per language, or language and band of length
    apart = counted.join(F.broadcast(middle.select(*keys, F.col("median").alias("middle"))), keys)
    spread = _medians(apart.withColumn("apart", F.abs(F.col("step") - F.col("middle"))), keys, "apart")
    spread = spread.select(*keys, (SCALE * F.col("median") / STEPS).alias("spread"))
    return middle.join(spread, keys).select(*keys, "docs", ((F.col("median") + 0.5) / STEPS).alias("median"), "spread")


def held_out() -> Column:
    """Documents never trained on: crc32 of the id as text divides by 5 (a null id counts as empty)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def identified(docs: DataFrame, max_grams: int = MAX_GRAMS, max_deviations: float = MAX_DEVIATIONS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, lang): held_out, lang_pred, score, rejected, entropy, n, mark.

    Learns from all documents with a language that are not held out.  ``und`` for texts that are null or
    have no letter, and for all if nothing can be learned; equally good languages go to the
    first by name.  ``score`` is the calibrated probability of the prediction, 0 for ``und``.  ``rejected``: ``und``, a score
    below LEAST_SCORE, or a cross-entropy more than ``max_deviations`` deviations above the median of its language's
    training documents of about that length, each distinct text counted once; bands of fewer than 30, or
    that lie as a whole beyond what the language has, are judged by the whole language with twice the deviations.
    ``mark`` is the text's hash.  Repeated rows come out
    as often as they came in; an empty table gives no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        held_out().alias("held_out"),
        F.col("lang").cast("string").alias("lang"),
        F.xxhash64(F.col("text").cast("string")).alias("mark"),
        F.col("text").cast("string").alias("text"),
    )
    models = train(rows.where("NOT held_out"), max_grams)
    names = list(models)
    if not names:
        return rows.select(
            "doc_id", "held_out", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"),
            F.lit(None).cast("double").alias("entropy"), F.lit(0).cast("bigint").alias("n"), "mark",
        )
    schema = "doc_id bigint, held_out boolean, lang string, mark bigint, n bigint, letters boolean, entropies array<double>"
    shared = spark.sparkContext.broadcast([model.parts() for model in models.values()])
    scored = stored(rows.mapInArrow(partial(_score, shared=shared), schema), "langid-scores")
    best = F.array_min("entropies")
    scored = scored.withColumns(
        {
            "best": best,
            "guess": F.element_at(F.lit(names), F.array_position("entropies", best).cast("int")),
            "band": F.floor(F.log2(F.greatest("n", F.lit(1)))).cast("int"),
        }
    )
    training = scored.where("letters AND NOT held_out AND lang IS NOT NULL")
    chance = lambda t, of: F.pow(2.0, (F.col("best") - of) * F.col("n") * t) / F.aggregate(
        "entropies", F.lit(0.0), lambda s, e: s + F.pow(2.0, (F.col("best") - e) * F.col("n") * t)
    )
    truth = F.get("entropies", F.array_position(F.lit(names), F.col("lang")).cast("int") - 1)
    fits = training.agg(
        *[F.avg(F.log(F.greatest(chance(F.lit(t), truth), F.lit(1e-12)))).alias(f"t{i}") for i, t in enumerate(TEMPERATURES)]
    ).first()
    quality = [x if x is not None else float("-inf") for x in fits]
    temperature = TEMPERATURES[int(np.argmax(quality))]
    # languages x bands of length: bounded whatever the input, hence the broadcasts
    steps = F.floor(F.col("best") * STEPS).cast("bigint").alias("step")
    texts = training.where("lang = guess").select("lang", "band", steps, "mark").distinct()
    counted = stored(texts.groupBy("lang", "band", "step").agg(F.count("*").alias("docs")), "langid-usual")
    usual = _usual(counted, ["lang", "band"]).select(F.col("lang").alias("of"), F.col("band").alias("of_band"), "docs", "median", "spread")
    all_bands = _usual(counted, ["lang"]).select(F.col("lang").alias("l"), F.col("median").alias("all_median"), F.col("spread").alias("all_spread"))
    wide = 2 * max_deviations * F.greatest("all_spread", F.lit(LEAST_SPREAD))
    beyond = F.coalesce(F.col("median") > F.col("all_median") + wide, F.lit(False))
    few = F.coalesce(F.col("docs"), F.lit(0)) < 30
    limit = (
        F.when(beyond, F.col("all_median") + wide)
        .when(few, F.greatest("all_median", F.coalesce("median", "all_median")) + wide)
        .otherwise(F.col("median") + max_deviations * F.greatest("spread", F.lit(LEAST_SPREAD)))
    )
    score = chance(F.lit(temperature), F.col("best"))
    return (
        scored.join(F.broadcast(usual), (F.col("guess") == F.col("of")) & (F.col("band") == F.col("of_band")), "left")
        .join(F.broadcast(all_bands), F.col("guess") == F.col("l"), "left")
        .select(
            "doc_id",
            "held_out",
            F.when(F.col("letters"), F.col("guess")).otherwise(UNDETERMINED).alias("lang_pred"),
            F.when(F.col("letters"), score).otherwise(0.0).alias("score"),
            (~F.col("letters") | (score < LEAST_SCORE) | F.coalesce(F.col("best") > limit, F.lit(False))).alias("rejected"),
            F.when(F.col("letters"), F.col("best")).alias("entropy"),
            "n",
            "mark",
        )
    )


def accepted(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the rejected ones, all columns kept.

    Null, empty and letterless texts are rejected; repeated rows stay or go together, since the decision depends on
    doc_id and text alone; an empty table gives no rows.
    """
    return without(docs, identified(docs, **options).where("rejected"))
