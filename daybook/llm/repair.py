"""Conversation repair: the cheapest edits that make the roles alternate, by Dijkstra's search from both ends.

A conversation of n rows is a lattice of n + 1 layers of four states (nothing yet, after a system, user or
assistant row).  Keep, Rerole and Delete lead to the next layer, Insert to another state of the same one.  One heap
searches from the first layer, one from the last; they go on past their first meeting until no path of the best cost can
cross between them unseen.  Of all cheapest paths the one whose edits' initials come first in ASCII is walked from its start.

What a row does to the lattice is one of 16 codes (its fault and its role's initial), so texts stay out of the search.
Conversations are cut into blocks of at most BLOCK rows; long ones are searched block by block,
for each pair of states at the block's ends, and once more over the blocks.  Only the
last step, hashing a conversation's repaired text, reads its rows one after the other, holding none of them.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import stored

#: Rows of one conversation that are searched at once (a power of two).
BLOCK = 1024
#: Different conversations whose audit a task remembers at most.
REMEMBERED = 1 << 14
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
FINE, BLANK, DUPLICATE, CUT = range(4)
INITIALS = "sua"
BLANKS = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
#: The role that must come next, as a state, and the states in which a conversation may end.
EXPECTED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
FINAL = (START, ASSISTANT)
NAMES = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}
#: Codes are letters from here on: four for each fault, by initial (system, user, assistant, any other).
FIRST = ord("A")

Edge = tuple[str, int, tuple[int, int]]


def parts_of(code: str) -> tuple[int, int]:
    """(fault, state after the row's own role, or START if it is no legal role) of a code."""
    fault, initial = divmod(ord(code) - FIRST, 4)
    return fault, (initial + 1) % 4


def _moves(code: str, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of a row in a state."""
    fault, role = parts_of(code)
    found = [("D", DELETE, state)]
    if fault not in (BLANK, DUPLICATE):
        extra = TRUNCATED if fault == CUT else 0
        if role == EXPECTED[state] or (role == SYSTEM and state == START):
            found.append(("K", KEEP + extra, role))
        found.append(("R", REROLE + extra, EXPECTED[state]))
    return found


#: code -> state -> (edit, cost, next state), and code -> next state -> (edit, cost, state).
MOVES = {code: {state: _moves(code, state) for state in EXPECTED} for code in map(chr, range(FIRST, FIRST + 16))}
BACK = {
    code: {after: [(edit, cost, state) for state in EXPECTED for edit, cost, to in ways[state] if to == after] for after in EXPECTED}
    for code, ways in MOVES.items()
}


def cheapest(
    start: tuple[int, int], ends: list[tuple[int, int]], out: Callable[[tuple], list[Edge]], into: Callable[[tuple], list[Edge]]
) -> tuple[int, str, tuple[int, int]] | None:
    """(cost, least audit, end) of the cheapest path; nodes are (layer, state), and edges of cost 0 lead to a later layer.

    ``out`` and ``into`` give a node's edges as (label, cost, other node).  No label of a node's edges may be the
    beginning of another's, so that the least audit can be walked edge by edge.
    """
    settled: tuple[dict, dict] = ({}, {})  # exact costs from the start and to an end
    tried: tuple[dict, dict] = ({start: 0}, dict.fromkeys(ends, 0))
    heaps = ([(0, start)], [(0, end) for end in ends])
    heapq.heapify(heaps[1])
    best = min((0 for end in ends if end == start), default=None)
    edges_of = (out, into)
    while heaps[0] and heaps[1]:
        if best is not None and heaps[0][0][0] + heaps[1][0][0] > best:
            break  # whatever is left costs more on every crossing
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        cost, node = heapq.heappop(heaps[side])
        if node in settled[side]:
            continue
        settled[side][node] = cost
        for _, price, other in edges_of[side](node):
            reached = cost + price
            if reached < tried[side].get(other, reached + 1):
                tried[side][other] = reached
                heapq.heappush(heaps[side], (reached, other))
            beyond = tried[1 - side].get(other)
            if beyond is not None and (best is None or reached + beyond < best):
                best = reached + beyond
    if best is None:
        return None
    forward, back = settled[0], {**settled[1], **{end: 0 for end in ends}}

    def goes_on(node: tuple[int, int], price: int, other: tuple[int, int]) -> bool:
        """Whether an edge out of a node of the forward side lies on a cheapest path."""
        reached = forward[node] + price
        return back.get(other) == best - reached or (other in live and forward[other] == reached)

    live: set[tuple[int, int]] = set()
    for node in sorted(forward, key=lambda v: (forward[v], v[0]), reverse=True):
        if back.get(node) == best - forward[node] or any(goes_on(node, price, other) for _, price, other in out(node)):
            live.add(node)
    node, left, audit = start, best, []
    while not (left == 0 and node in ends):
        options = [
            (label, price, other)
            for label, price, other in out(node)
            if back.get(other) == left - price or (other in live and forward[other] == best - left + price)
        ]
        label, price, node = min(options)
        audit.append(label)
        left -= price
    return best, "".join(audit), node


def block_path(codes: str, start: int, ends: tuple[int, ...], last: bool) -> tuple[int, str, tuple[int, int]] | None:
    """The cheapest way through some rows from one state to one of others.  Rows are inserted after the final row only in the ``last`` block."""
    n = len(codes)

    def out(node: tuple[int, int]) -> list[Edge]:
        layer, state = node
        found = [("I", INSERT, (layer, EXPECTED[state]))] if layer < n or last else []
        if layer < n:
            found += [(label, cost, (layer + 1, after)) for label, cost, after in MOVES[codes[layer]][state]]
        return found

    def into(node: tuple[int, int]) -> list[Edge]:
        layer, state = node
        found = [("I", INSERT, (layer, s)) for s in EXPECTED if EXPECTED[s] == state] if layer < n or last else []
        if layer > 0:
            found += [(label, cost, (layer - 1, s)) for label, cost, s in BACK[codes[layer - 1]][state]]
        return found

    return cheapest((0, start), [(n, s) for s in ends], out, into)


def repaired(codes: str) -> tuple[int, str]:
    """(cost, audit) of a conversation that is one block."""
    cost, audit, _ = block_path(codes, START, FINAL, True)
    return cost, audit


def crossings(codes: str, first: bool, last: bool) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, audit) of every way through one block of a longer conversation."""
    found = []
    for before in [START] if first else list(EXPECTED):
        for after in EXPECTED:
            path = block_path(codes, before, (after,), last)
            if path is not None:
                found.append((before, after, path[0], path[1]))
    return found


def joined(blocks: list[list[tuple[int, int, int, str]]]) -> tuple[int, str]:
    """(cost, audit) of a conversation from its blocks' crossings: the same search, with blocks as rows."""

    def out(node: tuple[int, int]) -> list[Edge]:
        layer, state = node
        return [(audit, cost, (layer + 1, b)) for a, b, cost, audit in blocks[layer] if a == state] if layer < len(blocks) else []

    def into(node: tuple[int, int]) -> list[Edge]:
        layer, state = node
        return [(audit, cost, (layer - 1, a)) for a, b, cost, audit in blocks[layer - 1] if b == state] if layer > 0 else []

    cost, audit, _ = cheapest((0, START), [(len(blocks), s) for s in FINAL], out, into)
    return cost, audit


def illegal_pairs(codes: str) -> int:
    """Neighbours whose initials are not su, ua or au."""
    roles = [parts_of(c)[1] for c in codes]
    return sum((a, b) not in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)) for a, b in zip(roles, roles[1:]))


SOLVED = ["name", "codes", "befores", "afters", "costs", "audits", "blank", "duplicate", "truncated", "illegal"]

# --- on Spark -------------------------------------------------------------------------------------------------------


def damage_of(conv_id: Column, turn: Column) -> Column:
    """0 to 19: what befalls a row, by its conversation and turn (a null is one space)."""
    text = F.concat(F.coalesce(conv_id.cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(turn.cast("string"), F.lit(" ")))
    return (F.crc32(text.cast("binary")) % 20).cast("int")


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after damage: 0 drops a row, 1 empties it, 2 takes its full stops, 3 repeats it, 4 makes it the user's.

    A null role or text is one space.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), damage_of(F.col("conv_id"), F.col("turn")).alias("fate"))
    fate, text = F.col("fate"), F.col("text")
    text = F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text)
    rows = rows.where(fate != 0).withColumns({"text": text, "role": F.when(fate == 4, "user").otherwise(F.col("role"))})
    copies = F.explode(F.array_repeat(F.lit(0), F.when(fate == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", "role", "text", copies.alias("copy")).drop("copy")


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``seq``, which orders all of them by conversation, turn (nulls first), role and text.

    Ranges of the whole order are dealt to tasks, so the rows of one large conversation go to many; what
    the driver samples for them is a beginning of the text only.
    """
    what = F.concat("role", F.lit("\x00"), "text")
    dealt = rows.repartitionByRange("conv_id", "turn", F.substring(what, 1, 64))
    return dealt.sortWithinPartitions("conv_id", "turn", what).withColumn("seq", F.monotonically_increasing_id())


def _codes(rows: DataFrame) -> DataFrame:
    """(conv_id, seq, code) of placed rows."""
    shown = F.rtrim(F.col("text"), F.lit(BLANKS))
    last = F.substring(shown, -1, 1)
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1)) - 1
    initial = F.when((F.col("role") == "") | (initial < 0), 3).otherwise(initial)
    light = rows.select(
        "conv_id", "seq", "role", F.sha2("text", 256).alias("mark"), (shown == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"), initial.alias("initial")
    )
    # the first row with a role and text; joined by place, which no key can make hot
    firsts = light.groupBy("conv_id", "role", "mark").agg(F.min("seq").alias("first")).select("first")
    both = light.join(firsts, F.col("seq") == F.col("first"), "left")
    fault = F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), DUPLICATE).when(F.col("cut"), CUT).otherwise(FINE)
    return both.select("conv_id", "seq", F.char(FIRST + 4 * fault + F.col("initial")).alias("code"))


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Crossings of each block (a whole conversation has one), its faults and illegal pairs."""
    known: dict[str, tuple[int, str]] = {}  # conversations alike in their codes are searched once
    for batch in batches:
        name, codes, first, last = (batch.column(c) for c in ("name", "codes", "first", "last"))
        codes, ways = codes.to_pylist(), []
        for text, begins, finishes in zip(codes, first.to_pylist(), last.to_pylist()):
            if begins and finishes:
                if text not in known:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[text] = repaired(text)
                ways.append([(START, START, *known[text])])
            else:
                ways.append(crossings(text, begins, finishes))
        kinds = ((0, pa.int32()), (1, pa.int32()), (2, pa.int64()), (3, pa.string()))
        listed = [pa.array([[way[i] for way in found] for found in ways], pa.list_(kind)) for i, kind in kinds]
        letters = ["".join(chr(FIRST + 4 * fault + i) for i in range(4)) for fault in (BLANK, DUPLICATE, CUT)]
        faults = [[sum(map(text.count, letter)) for text in codes] for letter in letters]
        numbers = [pa.array(column, pa.int64()) for column in (*faults, [illegal_pairs(text) for text in codes])]
        yield pa.RecordBatch.from_arrays([name, pa.array(codes, pa.string()), *listed, *numbers], SOLVED)


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations of several blocks, which come one after the other in order: (conv, cost, audit, illegal pairs between blocks)."""
    held: list[dict] = []

    def out() -> pa.RecordBatch:
        cost, audit = joined([list(zip(r["befores"], r["afters"], r["costs"], r["audits"])) for r in held])
        between = sum(illegal_pairs(a["codes"][-1] + b["codes"][0]) for a, b in zip(held, held[1:]))
        return pa.RecordBatch.from_arrays(
            [pa.array([held[0]["conv"]], pa.string()), pa.array([cost], pa.int64()), pa.array([audit]), pa.array([between], pa.int64())],
            ["conv", "cost", "audit", "illegal"],
        )

    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["conv"] != row["conv"]:
                yield out()
                held.clear()
            held.append(row)
    if held:
        yield out()


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's repaired rows, which come in order after a row that holds the audit."""
    conv, audit, at, state, digest, empty, started = None, "", 0, START, hashlib.sha256(), True, False
    found: list[tuple[str | None, str]] = []

    def add(role: str, text: str) -> None:
        nonlocal empty
        digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
        empty = False

    def insertions() -> None:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state, at = EXPECTED[state], at + 1
            add(NAMES[state], "")

    for batch in batches:
        for key, seq, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if seq < 0:  # the next conversation
                if started:
                    insertions()
                    found.append((conv, digest.hexdigest()))
                conv, audit, at, state, digest, empty, started = key, text, 0, START, hashlib.sha256(), True, True
                continue
            insertions()
            edit, at = audit[at], at + 1
            if edit == "K":
                state = (INITIALS.index(role[0]) + 1) % 4
                add(role, text)
            elif edit == "R":
                state = EXPECTED[state]
                add(NAMES[state], text)
        if found:
            yield _hashes(found)
            found = []
    if started:
        insertions()
        found.append((conv, digest.hexdigest()))
        yield _hashes(found)


def _hashes(found: list[tuple[str | None, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], pa.string()), pa.array([h for _, h in found])], ["conv", "repaired_sha256"])


def repair(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per conv_id of ``conversations`` (conv_id, turn, role, text), damaged and repaired: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    All rows without a conv_id are one conversation.  Rows of one turn are taken by role, then text (both after damage), equal ones being
    interchangeable; null turns come first and count neither for gaps nor as a turn.  A null role or text is one space; a role without a first character
    is never legal.  Where the damage leaves no row, counts are 0, the audit is empty and the hash is that of the empty string.
    Conversations of more than ``block`` rows are searched in blocks, with the same result.  An empty table gives no
    rows; other columns are not looked at.
    """
    rows = stored(placed(damaged(conversations)), "repair-rows")
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null")).alias("conv")
    codes = _codes(rows).select(key, "seq", "code")
    # consecutive rows share seq but for its low bits, so a block is bounded by how it is named
    blocks = codes.groupBy("conv", F.call_function("div", F.col("seq"), F.lit(block).cast("bigint")).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("seq", "code"))).alias("rows")
    )
    ends = Window.partitionBy("conv")
    text = F.array_join(F.transform("rows", lambda r: r["code"]), "").alias("codes")
    blocks = blocks.select("conv", "block", text, (F.min("block").over(ends) == F.col("block")).alias("first"), (F.max("block").over(ends) == F.col("block")).alias("last"))
    schema = (
        "name struct<conv:string,block:bigint,whole:boolean>, codes string, befores array<int>, afters array<int>, costs array<bigint>, audits array<string>, "
        "blank bigint, duplicate bigint, truncated bigint, illegal bigint"
    )
    named = blocks.select(F.struct("conv", "block", (F.col("first") & F.col("last")).alias("whole")).alias("name"), "codes", "first", "last")
    solved = stored(named.mapInArrow(_solve, schema).select("name.*", *SOLVED[1:]), "repair-blocks")
    counted = ["blank", "duplicate", "truncated", "illegal"]
    single = solved.where("whole").select("conv", F.get("costs", F.lit(0)).alias("cost"), F.get("audits", F.lit(0)).alias("audit"))
    several = solved.where("NOT whole").select("conv", "block", "codes", "befores", "afters", "costs", "audits")
    several = several.repartition("conv").sortWithinPartitions("conv", "block").mapInArrow(_join, "conv string, cost bigint, audit string, illegal bigint")
    plans = stored(single.withColumn("illegal", F.lit(0).cast("bigint")).unionByName(several), "repair-plans")

    heads = plans.select("conv", F.lit(-1).cast("bigint").alias("seq"), F.lit("").alias("role"), F.col("audit").alias("text"))
    in_order = heads.unionByName(rows.select(key, "seq", "role", "text")).repartition("conv").sortWithinPartitions("conv", "seq")
    hashes = in_order.mapInArrow(_hash, "conv string, repaired_sha256 string")

    span = (F.max("turn").cast("decimal(38,0)") - F.min("turn").cast("decimal(38,0)") + 1 - F.countDistinct("turn")).try_cast("bigint")
    gaps = rows.groupBy(key).agg(F.coalesce(span, F.lit(0)).alias("gaps"))
    ids = conversations.select("conv_id", key).distinct()
    facts = ids.unionByName(gaps, True).unionByName(solved.select("conv", *counted), True).unionByName(plans, True).unionByName(hashes, True)
    return facts.groupBy("conv").agg(
        F.max("conv_id").alias("conv_id"),
        F.coalesce(F.max("gaps"), F.lit(0).cast("bigint")).alias("gaps"),
        *[F.coalesce(F.sum(c), F.lit(0).cast("bigint")).alias(c) for c in counted],
        F.coalesce(F.max("cost"), F.lit(0).cast("bigint")).alias("cost"),
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    ).drop("conv")
