import public_tokenizers
import pytest
from tokenizers import Tokenizer

from daybook.llm import tokencount

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def counted(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in df.collect()), key=repr)


def by_library(library, docs, limit=tokencount.LIMIT):
    out = []
    for row in docs.select("doc_id", "text").collect():
        text = row.text or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        out.append((row.doc_id, len(text.encode()), n, n > limit))
    return sorted(out, key=repr)


TEXTS = [
    "It's THE Dog's, we've they'll I'M don't'sun 'S",
    "snake_case __init__ a_1 1_a 12345 ½ ² Ⅷ ٣٤ 一二三 0x1F",
    "été été Å Å 각 각 क़",
    "ΟΔΥΣΣΕΥΣ Σ σς İstanbul ﬁ ﬀ ß ẞ ŉ",
    "a<|endoftext|>b <|startoftext|><|endoftext|> <|ENDOFTEXT|> <|endoftext|",
    "\x00\x1c\x1d\x85\xa0​ 　 x\x0by\x0cz",
    "👩‍👩‍👧 🏳️‍🌈 naïve— “quotes” … ¿qué? 日本語 العربية हिन्दी \U0001e900",
    "aaaaaaaaaa" * 3000 + " " + "!?" * 3000,
    "word " * 5000,
    "",
    "   \n\t ",
]


def test_same_as_the_library_on_odd_texts(frame, library):
    docs = frame([(i, t, None, None, None) for i, t in enumerate(TEXTS)])
    assert counted(tokencount.token_counts(docs, VOCABULARY)) == by_library(library, docs)


def test_same_as_the_library_on_every_kind_of_character(frame, library):
    step = 97
    chars = [c for c in map(chr, range(1, 0x30000)) if not 0xD800 <= ord(c) < 0xE000]
    texts = ["".join(f"{c}{d} x{c} " for c, d in zip(chars[i::step], chars[i + 1 :: step])) for i in range(0, step, 8)]
    docs = frame([(i, t, None, None, None) for i, t in enumerate(texts)])
    assert counted(tokencount.token_counts(docs, VOCABULARY)) == by_library(library, docs)


def test_odd_documents_and_an_empty_table(odd, empty, library):
    assert counted(tokencount.token_counts(odd, VOCABULARY, limit=100)) == by_library(library, odd, 100)
    assert tokencount.token_counts(empty, VOCABULARY).collect() == []


def test_given_documents(documents, library):
    assert counted(tokencount.token_counts(documents, VOCABULARY)) == by_library(library, documents)


def test_slices_and_forgetting_change_nothing(library, monkeypatch):
    monkeypatch.setattr(tokencount, "SLICE", 7)
    monkeypatch.setattr(tokencount, "REMEMBERED", 2)
    with open(VOCABULARY, encoding="utf-8") as file:
        source = file.read()
    count = tokencount.counter_of(source, tokencount.whole_tokens(library), tokencount.agreeing_characters(library))
    for text in TEXTS:
        assert count(text)[1] == len(library.encode(text, add_special_tokens=False).ids)


def test_most_characters_need_no_library(library):
    ranges = tokencount.agreeing_characters(library)
    held = lambda c: any(a <= ord(c) <= b for a, b in ranges)
    assert all(held(chr(c)) for c in range(128)) and all(map(held, "éüßñ—“…日本语العربية한글🏳"))
    assert not any(map(held, "\u0301Σ½\u0378"))
    assert sum(b - a + 1 for a, b in ranges) > 100_000


def test_proved_strings_are_one_token_inside_texts(library):
    proved = tokencount.whole_tokens(library)
    assert len(proved) > 30_000
    for word in proved[::997]:
        assert len(library.encode(f"\n{word} ", add_special_tokens=False).ids) == 1


def test_vocabularies_cut_by_another_pattern(frame):
    path = public_tokenizers.path("byte_bpe_50k.json")
    other = Tokenizer.from_file(path)
    docs = frame([(i, t, None, None, None) for i, t in enumerate(TEXTS)])
    assert counted(tokencount.token_counts(docs, path)) == by_library(other, docs)
