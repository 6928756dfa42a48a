"""Token counts by a whole-token shortcut.

A vocabulary string that encodes alone as one token is one token wherever it stands as a pre-token.  Which
strings do is proved on the driver once, by encoding every vocabulary string alone.  Tasks cut texts into
pre-tokens, count those of the proved table directly and merge only the rest, each different one once a task.

Cutting is done by the vocabulary's own pattern in Python's regular expressions.  Where both agree is
proved too: every assigned character that never composes with another is cut in three surroundings by the library
and by the pattern.  Texts with any other character, or with one for which the two differ, are
normalised and cut by the library.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from daybook.llm.common import slices

#: Tokens a document may have.
LIMIT = 2048
#: Characters cut at once; longer texts are taken in slices that end before white space.
SLICE = 1 << 20
#: Different merged pre-tokens a task remembers at most before it starts over.
REMEMBERED = 1 << 19
#: A vocabulary file larger than this is refused: it goes to every task.
MAX_FILE = 64 << 20
#: The one cutting pattern that has a form in Python's expressions (fixed values; the second is the first without
#: ``\p``: letters are word characters but digits and underscore, and four control characters are no white space).
LIBRARY_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PYTHON_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|[_\x1c-\x1f])+"
#: Where a text may be cut in two: no pre-token and no composition reaches over these in any vocabulary that drops them.
BLANKS = re.compile(r"[ \t\n\r]")


def _python_cut(text: str) -> list[str]:
    return re.findall(PYTHON_PATTERN, text.lower())


def _library_cut(tokenizer: Tokenizer, text: str) -> list[str]:
    """The library's pre-tokens as it has them: one character per byte."""
    if tokenizer.normalizer is not None:
        text = tokenizer.normalizer.normalize_str(text)
    return [part for part, _ in tokenizer.pre_tokenizer.pre_tokenize_str(text)]


def spelled(word: str) -> str:
    """A pre-token's bytes, spelled with the vocabulary's character for each; visible ASCII is itself."""
    if word.isascii() and word.isprintable() and " " not in word:
        return word
    return "".join(part for part, _ in ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(word))


def _has_python_form(spec: dict) -> bool:
    """Whether the file cuts by LIBRARY_PATTERN after composing, joining white space and lower-casing."""
    wanted = [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ]
    cutters = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    return (
        (spec.get("normalizer") or {}).get("normalizers") == wanted
        and len(cutters) == 2
        and cutters[0] == {"type": "Split", "pattern": {"Regex": LIBRARY_PATTERN}, "behavior": "Removed", "invert": True}
        and cutters[1].get("type") == "ByteLevel"
        and not cutters[1].get("add_prefix_space")
        and not cutters[1].get("use_regex")
    )


def _surroundings(chars: str) -> str:
    return "".join(f"a{c}a !{c}! 1{c}1\n" for c in chars)


def _unproved(tokenizer: Tokenizer, chars: str) -> str:
    """Those of ``chars`` that the library and the pattern treat differently; halves are tried apart."""
    text = _surroundings(chars)
    if spelled("\n".join(_python_cut(text))).split(spelled("\n")) == _library_cut(tokenizer, text):
        return ""
    if len(chars) == 1:
        return chars
    middle = len(chars) // 2
    return _unproved(tokenizer, chars[:middle]) + _unproved(tokenizer, chars[middle:])


def _settled() -> list[str]:
    """Assigned characters that are their own composed form next to whatever stands beside them."""
    known = [c for c in map(chr, range(0x110000)) if unicodedata.category(c) not in ("Cn", "Cs", "Co")]
    # the second halves of what composes; Hangul syllables compose by rule
    seconds = {chr(int(d[1], 16)) for c in known if len(d := unicodedata.decomposition(c).split()) == 2 and d[0][0] != "<"}
    seconds |= {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}
    return [c for c in known if not unicodedata.combining(c) and c not in seconds and unicodedata.is_normalized("NFC", c)]


def agreeing_characters(tokenizer: Tokenizer) -> list[tuple[int, int]]:
    """Ranges of code points that pattern and library treat alike; empty if ASCII is not among them."""
    # numbers that are no decimal digits are word characters to one side and not to the other;
    # a final sigma is lower-cased by its surroundings
    plain = [c for c in _settled() if c != "Σ" and c.isnumeric() == c.isdecimal()]
    size = 1024
    bad = "".join(_unproved(tokenizer, "".join(plain[a : a + size])) for a in range(0, len(plain), size))
    if any(c.isascii() for c in bad):
        return []
    ranges: list[tuple[int, int]] = []
    for c in sorted(set(map(ord, plain)) - set(map(ord, bad))):
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1] = (ranges[-1][0], c)
        else:
            ranges.append((c, c))
    return ranges


def whole_tokens(tokenizer: Tokenizer) -> list[str]:
    """Vocabulary strings, as pre-tokens, that encode alone as the one token they are."""
    suffix = tokenizer.model.end_of_word_suffix or ""
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    # the character that stands for each byte, read off the library
    byte_of: dict[str, bytes] = {}
    for c in map(chr, range(0x80)):
        byte_of[spelled(c)] = c.encode()
    for c in map(chr, range(0x80, 0x800)):
        for b, s in zip(c.encode(), spelled(c)):
            byte_of[s] = bytes([b])
    found = []
    for string, number in tokenizer.get_vocab().items():
        if not string.endswith(suffix) or string in special:
            continue
        try:
            word = b"".join(byte_of[s] for s in string[: len(string) - len(suffix)]).decode()
        except (KeyError, UnicodeDecodeError):
            continue  # bytes beyond two-byte characters' need no entry: such strings are merged like any other
        if word and tokenizer.encode(word, add_special_tokens=False).ids == [number] and _library_cut(tokenizer, word) == [spelled(word)]:
            found.append(word)
    return found


class Counter(dict):
    """Spelled pre-token -> its number of tokens: the proved ones from the start, others merged when first asked for."""

    def __init__(self, tokenizer: Tokenizer, proved: list[str], spell: Callable[[str], str] | None = None):
        super().__init__(dict.fromkeys(proved, 1))
        self.model, self.proved, self.spell = tokenizer.model, proved, spell

    def __missing__(self, word: str) -> int:
        n = len(self.model.tokenize(self.spell(word) if self.spell else word))
        if len(self) > len(self.proved) + REMEMBERED:
            self.clear()
            self.update(dict.fromkeys(self.proved, 1))
        self[word] = n
        return n


def counter_of(source: str, proved: list[str], ranges: list[tuple[int, int]]) -> Callable[[str], tuple[int, int]]:
    """A function text -> (pre-tokens, tokens), special strings counted as the one token they are."""
    tokenizer = Tokenizer.from_str(source)
    spec = json.loads(source)
    plain, by_spelling = Counter(tokenizer, proved, spelled), Counter(tokenizer, [spelled(w) for w in proved])
    special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
    split = re.compile("|".join(map(re.escape, special))).split if special else (lambda text: [text])
    agreeing = re.compile("[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in ranges) + "]*") if ranges else None
    find = re.compile(PYTHON_PATTERN).findall

    def count(text: str) -> tuple[int, int]:
        parts = split(text)
        pretokens = tokens = len(parts) - 1
        for part in parts:
            for piece in slices(part, BLANKS, SLICE) if ranges else (part,):
                if agreeing is not None and (piece.isascii() or agreeing.fullmatch(piece)):
                    words, counts = find(piece.lower()), plain
                else:
                    words, counts = _library_cut(tokenizer, piece), by_spelling
                pretokens += len(words)
                tokens += sum(map(counts.__getitem__, words))
        return pretokens, tokens

    return count


def _count(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    count = counter_of(*shared.value)
    for batch in batches:
        found = [count(text.as_py() or "") for text in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), *(pa.array(column, pa.int64()) for column in (list(zip(*found)) or [[], []]))],
            ["doc_id", "n_bytes", "n_pretokens", "n_tokens"],
        )


def token_counts(docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens), n_pretokens.

    ``vocabulary`` is the path, on the driver, of a ``tokenizers`` JSON file with a BPE model over bytes.  Counts are those of
    the library without begin, end or added tokens; special strings inside a text are one token each, as is its
    default.  A null text counts as empty (0 bytes, 0 tokens); repeated rows and null ids come out as often
    as they came in; whole texts are counted whatever their length; an empty table gives no rows; other columns are not looked at.
    """
    with open(vocabulary, encoding="utf-8") as file:
        source = file.read(MAX_FILE + 1)
    if len(source) > MAX_FILE:
        raise ValueError(f"{vocabulary}: larger than {MAX_FILE} characters")
    spec = json.loads(source)
    if spec["model"].get("type") != "BPE" or spec.get("truncation") or spec.get("padding"):
        raise ValueError(f"{vocabulary}: not a BPE vocabulary without truncation and padding")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
        raise ValueError(f"{vocabulary}: added tokens that depend on their surroundings")
    tokenizer = Tokenizer.from_str(source)
    ranges = agreeing_characters(tokenizer) if _has_python_form(spec) else []
    # bounded by MAX_FILE, whatever the corpus
    shared = docs.sparkSession.sparkContext.broadcast((source, whole_tokens(tokenizer), ranges))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("bigint").alias("n_bytes"),
    )
    schema = "doc_id bigint, n_bytes bigint, n_pretokens bigint, n_tokens bigint"
    counted = rows.mapInArrow(partial(_count, shared=shared), schema)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "n_pretokens")
