"""Secret scan: fixed patterns, and novelty against a zstandard dictionary of the corpus.

The patterns find assignments, access keys and long hex runs.  Beyond them, strings that
follow a sensitive word are judged by what they cost: the bytes that zstandard, primed
with the corpus' most frequent identifiers, needs for the surrounding text with the string beyond
those for that text without it.  Words and identifiers cost little; a string that costs about as
much as its own symbols in random order cannot be derived from anything around it and is
reported.  Strings made of word-like parts also need pairs of letters unlike the dictionary's.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import stored
from daybook.operators.tables import behind, boundaries

#: Words in the dictionary, most frequent last, and the bytes they may take together: bounds the broadcast.
DICTIONARY_WORDS, DICTIONARY_BYTES = 8192, 1 << 17
#: Distinct words a task counts before it hands the counts on.
FLUSH = 1 << 19
#: Characters around a candidate that count as its surroundings, and how far behind a sensitive word it may begin.
BEFORE, AFTER, REACH = 512, 128, 64
#: A candidate is incompressible from NOVELTY bytes a character, and LEAST_BYTES, or if it costs no less than its own
#: shuffles but for 1 - NOVELTY of the bytes that a random string of its alphabet and length takes.
NOVELTY, LEAST_BYTES, SHUFFLES = 0.8, 10, 3
#: Share of the symbols' possible entropy that a random string has at least.
LEAST_ENTROPY = 0.6
#: Bits a letter after the one before it from which word-like strings are random; 4.7 if all letters are alike.
LETTER_BITS = 6.0
LEVEL = 9

#: The base patterns and their shortest matches, in the order of the report.
BASE = (
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)
KINDS = [kind for kind, *_ in BASE] + ["novel"]
#: What makes the text behind it sensitive: names of secrets, and kinds of keys before "key".
SENSITIVE = ("password", "passwd", "passphrase", "passcode", "secret", "token", "credential", "bearer", "authorization", "apikey", "accesskey", "privatekey")
KEYED = ("api", "private", "access", "signing", "signature", "encryption", "decryption", "master", "shared", "session", "client", "account", "service", "deploy", "license", "auth", "ssh", "hmac", "root", "storage", "webhook")
CONTEXT = re.compile("|".join(SENSITIVE) + "|(?<![a-z0-9])pwd(?![a-z0-9])|(?:" + "|".join(KEYED) + r")[ _.\-]+key", re.ASCII)
#: Candidates below SHORT characters hold letters and digits and are not made of word-like parts.
LEAST, SHORT = 8, 16
#: Bytes by which what a short candidate and its shuffles cost may differ by chance.
SLACK = 2
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=\-]{{{LEAST},}}")
ALPHABETS = tuple((re.compile(pattern), size) for pattern, size in (("[0-9+/_=-]+", 10), ("[0-9a-f+/_=-]+|[0-9A-F+/_=-]+", 16), ("[a-z+/_=-]+|[A-Z+/_=-]+", 26), ("[A-Z2-7=]+", 32), ("[a-z0-9+/_=-]+|[A-Z0-9+/_=-]+", 36)))
WORDLIKE = re.compile(r"(?:[A-Z]?[a-z]{2,}+|[A-Z]{2,}+|(?<![0-9])[0-9]{1,4}+(?![0-9])|[+/_=\-]++)++")
LETTERS, DIGIT = re.compile("[A-Z]?[a-z]+|[A-Z]+"), re.compile("[0-9]")
# matches of 24 and more are the runs of [0-9a-f]+ that pass, without a match for every shorter run
LONG_HEX = re.compile(r"[0-9a-f]{24,}")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, leftmost and non-overlapping within a kind."""
    out = []
    if "=" in text or ":" in text:
        _, pattern, group, least = BASE[0]
        out += [(m.start(), 0, m.end()) for m in pattern.finditer(text) if len(m[group]) >= least]
    if "AKIA" in text:
        _, pattern, group, least = BASE[1]
        out += [(m.start(), 1, m.end()) for m in pattern.finditer(text) if len(m[group]) >= least]
    out += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(out)


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the strings that begin within REACH of a sensitive word, each once."""
    low = text.lower()
    if "key" not in low and "pwd" not in low and not any(word in low for word in SENSITIVE):
        return
    if len(low) != len(text):  # lower-casing some letters changes a text's length
        low = "".join(c.lower() if c < "\x80" else c for c in text)
    seen = set()
    for word in CONTEXT.finditer(low):
        # a candidate may begin up to REACH behind the word and be of any length
        at = word.end()
        while (m := CANDIDATE.search(text, at, at + REACH + LEAST)) and m.start() <= word.end() + REACH:
            start, end = CANDIDATE.match(text, m.start()).span()
            at = end
            if start not in seen and (end - start >= SHORT or _mixed(text[start:end])):
                seen.add(start)
                yield start, end


def _mixed(found: str) -> bool:
    """Whether a short string holds letters and digits and is not made of word-like parts."""
    return DIGIT.search(found) is not None and LETTERS.search(found) is not None and not WORDLIKE.fullmatch(found)


def random_bytes(found: str) -> float:
    """What a random string of the same alphabet and length takes; 0 if the symbols are too few or too uneven for one."""
    size = next((n for pattern, n in ALPHABETS if pattern.fullmatch(found)), 64)
    n = len(found)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(found).values())
    return n * math.log2(size) / 8 if entropy >= LEAST_ENTROPY * math.log2(min(size, n)) else 0.0


class Novelty:
    """Marginal compressed bytes with one dictionary."""

    def __init__(self, dictionary: bytes):
        held = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if dictionary else None
        self.coder = zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False)
        runs = [run.lower() for run in LETTERS.findall(dictionary.decode("utf-8", "replace"))]
        self.pairs = Counter(p for run in runs for p in zip(run, run[1:]))
        self.firsts = Counter(c for run in runs for c in run[:-1])

    def marginal(self, text: str, start: int, end: int) -> tuple[int, int]:
        """Bytes beyond those of the surroundings, of the string and of the cheapest of its SHUFFLES.

        A shuffle has the string's symbols and so its frame, table and literal costs, but nothing in it can be derived.
        Other occurrences of the string in its surroundings do not count.
        """
        found = text[start:end]
        before = text[max(0, start - BEFORE - len(found)) : start].replace(found, " ")[-BEFORE:]
        after = text[end : end + AFTER + len(found)].replace(found, " ")[:AFTER]
        size = lambda s: len(self.coder.compress((before + after + s).encode("utf-8", "replace")))
        mixer = random.Random(found)
        return size(found) - size(""), min(size("".join(mixer.sample(found, len(found)))) for _ in range(SHUFFLES)) - size("")

    def letter_bits(self, found: str) -> float:
        """Mean surprise of a letter after the one before it, by the dictionary's words."""
        runs = [run.lower() for run in LETTERS.findall(found)]
        bits = [-math.log2((self.pairs[p] + 0.5) / (self.firsts[p[0]] + 13)) for run in runs for p in zip(run, run[1:])]
        return sum(bits) / len(bits) if bits else 0.0

    def incompressible(self, text: str, start: int, end: int) -> bool:
        found, (bytes_, shuffled) = text[start:end], self.marginal(text, start, end)
        if bytes_ >= max(LEAST_BYTES if len(found) >= SHORT else 0, NOVELTY * len(found)):
            return True  # not even by single characters
        most = random_bytes(found)
        short = len(found) < SHORT
        if not most or shuffled - bytes_ > max(SLACK if short else 0, (1 - NOVELTY) * most):
            return False
        return short or ALPHABETS[1][0].fullmatch(found) is not None or not WORDLIKE.fullmatch(found) or self.letter_bits(found) >= LETTER_BITS

    def spans(self, text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Incompressible strings that begin within REACH of a sensitive word and touch no base span."""
        return [
            (start, 3, end)
            for start, end in candidates(text)
            if not any(a < end and start < b for a, _, b in taken) and self.incompressible(text, start, end)
        ]


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their number, and the candidates with none."""
    held: Counter = Counter()
    judged: set[str] = set()

    def out() -> pa.RecordBatch:
        words, counts = [*held, *judged], [*held.values(), *[0] * len(judged)]
        columns = [pa.array(words, pa.string()), pa.array(counts, pa.int64()), pa.array([False] * len(held) + [True] * len(judged))]
        held.clear()
        judged.clear()
        return pa.RecordBatch.from_arrays(columns, ["word", "n", "judged"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            held.update(w for w in text.split() if 4 <= len(w) <= 40)
            judged.update(text[a:b] for a, b in candidates(text) if b - a <= 40)  # longer ones are in no word
            if len(held) + len(judged) > FLUSH:
                yield out()
    if held or judged:
        yield out()


def dictionary(docs: DataFrame, words: int = DICTIONARY_WORDS) -> bytes:
    """The most frequent words (4 to 40 characters) of all texts as dictionary content, at most DICTIONARY_BYTES.

    Words are counted in all documents; one that a single document repeats counts each time.  Words
    that hold what is judged in any document are left out, however many copies there are: a
    secret must not be derived from itself.  Ties go by the word, so the content is the same in every run.
    """
    counts = docs.where("text IS NOT NULL").select(F.col("text").cast("string")).mapInArrow(_words, "word string, n bigint, judged boolean")
    # written once, as the words and the candidates among them are looked at apart
    counts = stored(counts.groupBy("word", "judged").agg(F.sum("n").alias("n")).where("judged OR n > 1"), "secret-words")
    parts = F.explode(F.regexp_extract_all("word", F.lit(f"({CANDIDATE.pattern})"), F.lit(1)))
    judged = counts.where("judged").select(F.col("word").alias("part"))
    holding = counts.where(f"NOT judged AND length(word) >= {LEAST}").select("word", parts.alias("part"))
    holding = holding.join(judged, "part", "left_semi").select("word").distinct()
    counts = stored(counts.where("NOT judged").join(holding, "word", "left_anti").select("word", "n"), "secret-dictionary")
    # the last word chosen is found by counting; the driver sees the chosen ones only
    order = ["n DESC", "word"]
    (last,) = boundaries(counts, order, [words])
    top = (counts if last is None else counts.where(~behind(order, last))).collect()
    top.sort(key=lambda r: (r["n"], [-ord(c) for c in r["word"]]))
    return "\n".join(r["word"] for r in top).encode()[-DICTIONARY_BYTES:]


SCHEMA = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_novel bigint, base_sha256 string, spans string"


def _scan(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    novelty = Novelty(shared.value)
    told = lambda spans: ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)
    for batch in batches:
        counts, digests, joined = [], [], []
        for text in batch.column(1).to_pylist():
            base = base_spans(text)
            every = sorted(base + novelty.spans(text, base))
            counts.append([sum(kind == k for _, kind, _ in every) for k in range(4)])
            digests.append(hashlib.sha256(told(base).encode()).hexdigest())
            joined.append(told(every))
        columns = [pa.array([c[k] for c in counts], pa.int64()) for k in range(4)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *columns, pa.array(digests, pa.string()), pa.array(joined, pa.string())],
            ["doc_id", "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"],
        )


def scan(docs: DataFrame, words: int = DICTIONARY_WORDS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts by kind, digest of the base spans, all spans.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind (assign, access, hex,
    novel), comma-joined; base spans are never dropped, novel ones do not overlap them.  A null text is
    empty and has no span; repeated rows come out as often as they came in; an empty table
    gives no rows; other columns are not looked at.  Each text is scanned whole.
    """
    content = docs.sparkSession.sparkContext.broadcast(dictionary(docs, words))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    return rows.mapInArrow(partial(_scan, shared=content), SCHEMA)
