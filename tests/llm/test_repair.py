import hashlib
import itertools
import random
import re
import zlib

import pytest

from daybook.llm import repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, shard string"
BLANK = " \t\n\x0b\x0c\r"


def damage(rows):
    """The rows of one conversation after damage, in order, by the contract's words."""
    out = []
    for conv, turn, role, text in rows:
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        fate = zlib.crc32(name.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if fate == 1:
            text = ""
        if fate == 2:
            text = re.sub("[.!?]", "", text)
        if fate == 4:
            role = "user"
        out += [(turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        shown = text.strip(BLANK)
        if not shown:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        elif shown[-1] not in ".!?":
            out.append("truncated")
        else:
            out.append("")
        seen.add((role, text))
    return out


def all_edits(rows, kinds):
    """Every edit list with at most one insertion (two cost more than deleting four rows)."""
    n = len(rows)
    options = []
    for (_, role, _), kind in zip(rows, kinds):
        own = [("D", None, 2)]
        if kind not in ("blank", "duplicate"):
            extra = 5 if kind == "truncated" else 0
            own += [("K", role, extra), ("R", "user", 1 + extra), ("R", "assistant", 1 + extra)]
        options.append(own)
    for chosen in itertools.product(*options):
        steps = [(label, new, cost, i) for i, (label, new, cost) in enumerate(chosen)]
        yield steps
        for at in range(n + 1):
            for new in ("user", "assistant"):
                yield [*steps[:at], ("I", new, 5, None), *steps[at:]]


def brute(rows):
    kinds = faults(rows)
    best = None
    for steps in all_edits(rows, kinds):
        kept = [(new, "" if i is None else rows[i][2]) for _, new, _, i in steps if new is not None]
        if any(not new for new, _ in kept) or not re.fullmatch("(s?(ua)+)?", "".join(new[0] for new, _ in kept)):
            continue
        found = (sum(s[2] for s in steps), "".join(s[0] for s in steps), "\n".join(f"{r}:{t}" for r, t in kept))
        if best is None or found[:2] < best[:2]:
            best = found
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [(a[1][:1], b[1][:1]) for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
        sum(p not in (("s", "u"), ("u", "a"), ("a", "u")) for p in pairs),
        best[0],
        best[1],
        hashlib.sha256(best[2].encode()).hexdigest(),
    )


def result(df):
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    dice = random.Random(7)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    texts = ["Yes.", "no", "Really?  ", "", " \t", None, "ha ha", "Go!\n", "über…", "Yes."]
    out = []
    for conv in range(120):
        for turn in range(dice.choice([1, 2, 3, 4])):
            out.append((conv, dice.choice([turn, turn, turn * 3, None]), dice.choice(roles), dice.choice(texts)))
    out += [(None, 0, "user", "Hi."), (None, None, "assistant", "Ho."), (500, 5, None, None)]
    return out


def grouped(rows):
    out = {}
    for row in rows:
        out.setdefault(row[0], []).append(row)
    return out


def test_against_every_edit_list(spark, rows):
    small = {c: r for c, r in grouped(rows).items() if len(damage(r)) <= 4}
    df = spark.createDataFrame([(*r, "taken") for rs in small.values() for r in rs], SCHEMA)
    want = sorted(((conv, *brute(damage(rs))) for conv, rs in small.items()), key=repr)
    assert len(want) > 80 and any(w[-2] == "" for w in want)
    assert result(repair.repair(df)) == want


def test_blocks_change_nothing(spark):
    dice = random.Random(3)
    rows = [(c, t, dice.choice(["user", "assistant", "system"]), dice.choice(["A.", "B?", "c", f"{t}."]), "") for c in (1, 2, 3) for t in range(40)]
    rows += [(4, t, "user", f"{t}.", "") for t in range(3)]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = result(repair.repair(df))
    assert result(repair.repair(df, block=4)) == whole
    for conv, *found in whole:  # costs and audits against a plain recursion over suffixes
        codes = damage([r[:4] for r in rows if r[0] == conv])
        assert found[5:7] == list(plain(codes, faults(codes)))


def plain(rows, kinds):
    """(cost, audit) by the least suffix of every place, with at most two insertions in a row."""
    n = len(rows)
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {(n, q): (0, "") for q in ("", "a")}
    for i in range(n, -1, -1):
        for _ in range(2 if i == n else 1):
            for q in ("", "s", "u", "a"):
                found = [best[(i, q)]] if (i, q) in best else []
                if i < n:
                    extra = 5 if kinds[i] == "truncated" else 0
                    ways = [("D", q, 2)]
                    if kinds[i] not in ("blank", "duplicate"):
                        ways += [("K", after.get((q, rows[i][1][:1])), extra)]
                        ways += [("R", after.get((q, r)), 1 + extra) for r in "ua"]
                    found += [(c + best[(i + 1, to)][0], e + best[(i + 1, to)][1]) for e, to, c in ways if to is not None and (i + 1, to) in best]
                if found:
                    best[(i, q)] = min(found)
        for _ in range(2):
            for (q, r), to in after.items():
                if r != "s" and (i, to) in best:
                    found = (5 + best[(i, to)][0], "I" + best[(i, to)][1])
                    best[(i, q)] = min(best.get((i, q), found), found)
    return best[(0, "")]


def test_searches_agree_on_random_codes():
    dice = random.Random(11)
    letters = [chr(repair.FIRST + i) for i in range(16)]
    for _ in range(300):
        codes = "".join(dice.choices(letters, k=dice.randint(1, 12)))
        cut = sorted(dice.sample(range(len(codes) + 1), k=min(2, len(codes))))
        parts = [p for p in (codes[a:b] for a, b in zip([0, *cut], [*cut, len(codes)])) if p]
        blocks = [repair.crossings(p, i == 0, i == len(parts) - 1) for i, p in enumerate(parts)]
        assert repair.joined(blocks) == repair.repaired(codes)


def test_empty_table_and_repeated_rows(spark):
    assert repair.repair(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, 1, "user", "Hello there."), (1, 1, "user", "Hello there.")] * 2
    df = spark.createDataFrame([(*r, "") for r in rows], SCHEMA)
    assert result(repair.repair(df)) == [(1, *brute(damage(rows)))]
    long = "word " * 400_000 + "."
    df = spark.createDataFrame([(9, 1, "user", long, ""), (9, 2, "assistant", long, "")], SCHEMA)
    assert result(repair.repair(df)) == [(9, *brute(damage([(9, 1, "user", long), (9, 2, "assistant", long)])))]
