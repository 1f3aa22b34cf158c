"""Repair of conversations: the cheapest edits to a legal order of roles, by an auction algorithm for shortest paths."""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanledger.llm.common import WordCache, map_rows
from spanledger.session import materialize

# fixed values: costs of edits, letters of edits in the audit, roles that edits may give
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}

#: What is left to say: anything, after a system row, after a user row, after an assistant row. The role sequence
#: ``(s?(ua)+)?`` may end where nothing was said and after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
_AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The one role that an edit can give in each state.
_GIVEN = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
STATES = 4
#: More than any cost.
FAR = 1 << 60


@dataclass(frozen=True)
class RepairParams:
    """``piece_bits``: a piece of a conversation has at most 2**piece_bits rows; ``fan_bits``: as many pieces, to that power of two,
    are joined into one in each step over long conversations."""

    piece_bits: int = 7
    fan_bits: int = 6


def arcs_of(code: str, state: int) -> list[tuple[str, int, int, int]]:
    """Edits of one row in a state: letter, rows read, next state, cost. ``code``: the role's initial (s, u, a, other), capital if
    the row is truncated; ``-`` if it must be deleted; empty after the last row. Letters in ASCII order."""
    given = _AFTER[state, _GIVEN[state]]
    arcs = [("I", 0, given, INSERT)]
    if code:
        arcs.insert(0, ("D", 1, state, DELETE))
    if code and code != "-":
        extra = TRUNCATED if code.isupper() else 0
        kept = _AFTER.get((state, code.lower()))
        if kept is not None:
            arcs.append(("K", 1, kept, extra))
        arcs.append(("R", 1, given, REROLE + extra))
    return arcs


class Lattice:
    """Nodes (row, state) of one piece, node ``row * STATES + state``. After its last row come arcs to one target, at the cost that
    the rest of the conversation has from each state; within a piece that is not the last, nothing is inserted after its last row,
    as the next piece does that. Nodes without a way to the target have no arcs.

    An auction: the path starts at the origin. At its end node i, if price(i) < least of cost(i, j) + price(j) over arcs, the price is
    raised to that least bid and the path gives up i; otherwise the path goes on to the best j. Prices stay feasible, so when
    the path reaches the target it is a shortest one and price(origin) - price(target) is its length, and every arc of any
    shortest path is tight: price(i) = cost(i, j) + price(j). All cycles cost something, so the path never meets itself. Prices of one
    run are feasible for the next origin, which starts with them; the first starts with what the rows cost at least."""

    def __init__(self, codes: str, rest: tuple[int, ...], last: bool):
        self.codes, self.target = codes, (len(codes) + 1) * STATES
        self.arcs: list[list[tuple[str, int, int]]] = [[] for _ in range(self.target + 1)]
        self.prices = [0] * (self.target + 1)
        reached, floor = {self.target}, min(rest)
        for row in range(len(codes), -1, -1):
            code = codes[row] if row < len(codes) else ""
            nodes = range(row * STATES, row * STATES + STATES)
            for state, node in enumerate(nodes):
                if code or last:
                    self.arcs[node] = [(x, (row + read) * STATES + to, c) for x, read, to, c in arcs_of(code, state)]
                if not code and rest[state] < FAR:
                    self.arcs[node].append(("", self.target, rest[state]))
            for _ in nodes:
                reached.update(n for n in nodes if any(j in reached for _, j, _ in self.arcs[n]))
            for node in nodes:
                self.arcs[node] = [arc for arc in self.arcs[node] if arc[1] in reached]
            floor += min((c for n in nodes for x, _, c in self.arcs[n] if x not in ("I", "")), default=0)
            for node in nodes:
                self.prices[node] = floor

    def distance(self, origin: int) -> int:
        """Length of a shortest path from a state before the first row; ``FAR`` if the target cannot be reached."""
        prices, arcs, target, path = self.prices, self.arcs, self.target, [origin]
        if not arcs[origin]:
            return FAR
        while (end := path[-1]) != target:
            bid, to = min((cost + prices[other], other) for _, other, cost in arcs[end])
            if prices[end] < bid:
                prices[end] = bid
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
        return prices[origin] - prices[target]

    def trace(self, origin: int) -> tuple[list[str], int]:
        """Of the shortest paths the one with the least letters: the letters for each row (insertions before it, then its own; the
        last entry holds those after the last row) and the state after the last row. Tight arcs alone may lead astray, so nodes from which tight
        arcs reach the target are marked first."""
        self.distance(origin)
        prices, arcs = self.prices, self.arcs
        good = {self.target}
        for row in range(len(self.codes), -1, -1):
            nodes = range(row * STATES, row * STATES + STATES)
            for _ in nodes:
                good.update(n for n in nodes if any(j in good and prices[n] == c + prices[j] for _, j, c in arcs[n]))
        letters, node, state = [""], origin, origin
        while node != self.target:
            state = node % STATES
            letter, node = min((x, j) for x, j, c in arcs[node] if j in good and prices[node] == c + prices[j])
            letters[-1] += letter
            if letter not in ("I", ""):
                letters.append("")
        return letters, state


#: Costs after the last row: legal ends are free.
END = (0, FAR, FAR, 0)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage that crc32(``conv_id:turn``) % 20 decides; nulls as one space in texts and keys."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    chance = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), blank)
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(chance == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), blank)).alias("role"),
        F.when(chance == 1, "").when(chance == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(chance == 3, 2).otherwise(1).alias("_copies"), (chance == 0).alias("_dropped"),
    ).filter("NOT _dropped").withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_copies")))).drop(
        "_copies", "_dropped", "_copy"
    )


def _sort_key() -> list[Column]:
    """conv (text, empty for a null id), turn, digest (stands for role and text, whose lengths keep them apart)."""
    digest = F.unhex(F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256))
    return [F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), F.col("turn"), digest.alias("digest")]


def marked_rows(rows: DataFrame) -> DataFrame:
    """conv, turn, digest, at, initial, fault, code of every row, without its text. ``at`` numbers all rows by conversation and turn
    (nulls first; equal turns by digest); long conversations lie in several partitions. Stored, so that later steps see one numbering."""
    spoken = F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", "")
    initial = F.substring("role", 1, 1)
    narrow = rows.select(
        *_sort_key(), F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
        (F.length(spoken) == 0).alias("blank"), (~F.substring(spoken, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )
    # equal rows, however many, may be dealt over several partitions
    sort = ["conv", "turn", "digest", "tie"]
    numbered = (
        narrow.withColumn("tie", F.rand(5)).repartitionByRange(*sort).sortWithinPartitions(*sort).drop("tie")
        .withColumn("at", F.monotonically_increasing_id())
    )
    stored = materialize(numbered, "conversation-rows")
    first = stored.groupBy("conv", "digest").agg(F.min("at").alias("first"))
    fault = F.when(F.col("blank"), "b").when(F.col("at") > F.col("first"), "d").when(F.col("truncated"), "t").otherwise("")
    code = F.when(fault.isin("b", "d"), "-").when(fault == "t", F.upper("initial")).otherwise(F.col("initial"))
    marked = stored.join(first, ["conv", "digest"]).select(
        "conv", "turn", "digest", "at", "initial", fault.alias("fault"), code.alias("code")
    )
    return materialize(marked, "conversation-marks")


def pieces_of(marked: DataFrame, params: RepairParams) -> DataFrame:
    """conv, number (from 1), total, codes, turn and digest of the first row, illegal (pairs within the piece and with the row before
    it). The windows run over pieces, not rows."""
    row = F.struct("at", "code", "initial", "turn", "digest")
    joined = marked.groupBy("conv", F.shiftright("at", params.piece_bits).alias("piece")).agg(
        # at most 2**piece_bits short rows
        F.array_sort(F.collect_list(F.struct("at", "code", "initial"))).alias("rows"), F.min(row).alias("head")
    )
    by_place = Window.partitionBy("conv").orderBy("piece")
    initials = F.array_join("rows.initial", "")
    before = F.coalesce(F.lag(F.element_at("rows", -1)["initial"]).over(by_place), F.lit(""))
    said = F.concat(before, initials)
    # every start of a legal pair matches once
    illegal = (F.length(said) - 1 - F.regexp_count(said, F.lit("(?=su|ua|au)"))).cast("long")
    return materialize(
        joined.select(
            "conv", F.row_number().over(by_place).cast("long").alias("number"),
            F.count("*").over(Window.partitionBy("conv")).alias("total"), F.array_join("rows.code", "").alias("codes"),
            F.col("head.turn").alias("turn"), F.col("head.digest").alias("digest"), illegal.alias("illegal"),
        ),
        "conversation-pieces",
    )


def scan(values: DataFrame, params: RepairParams, combine, hand, start: list[int]) -> DataFrame:
    """For an associative ``combine`` of the values (conv, number, value) of a conversation's pieces: what each piece is given from
    the others (conv, number, given), where the whole conversation is given ``start`` and ``hand(values, given)`` deals what a run of
    pieces is given to them. Runs of 2**fan_bits pieces are combined, then runs of runs, then dealt back the same way, so no task
    sees more than one run at a time."""

    def runs(level: DataFrame) -> DataFrame:
        run = F.shiftright(F.col("number") - 1, params.fan_bits) + 1
        return level.groupBy("conv", run.alias("run")).agg(F.array_sort(F.collect_list(F.struct("number", "value"))).alias("own"))

    def joined(batches):
        for batch in batches:
            for conv, run, own in zip(*(c.to_pylist() for c in batch.columns)):
                yield conv, run, combine([x["value"] for x in own])

    def dealt(batches):
        for batch in batches:
            for conv, own, given in zip(*(c.to_pylist() for c in batch.columns)):
                for x, own_given in zip(own, hand([x["value"] for x in own], given)):
                    yield conv, x["number"], own_given

    levels = [values]
    while not levels[-1].filter("number > 1").isEmpty():
        levels.append(materialize(map_rows(runs(levels[-1]), joined, "conv string, number bigint, value array<bigint>"), "runs"))
    given = levels[-1].select("conv", "number", F.array(*map(F.lit, start)).cast("array<bigint>").alias("given"))
    for level in reversed(levels[:-1]):
        parents = runs(level).join(given.withColumnRenamed("number", "run"), ["conv", "run"]).select("conv", "own", "given")
        given = materialize(map_rows(parents, dealt, "conv string, number bigint, given array<bigint>"), "given")
    return given


#: Costs of a legal end from each state, with insertions.
ENDINGS = [Lattice("", END, True).distance(state) for state in range(STATES)]


def costs_between(codes: str) -> list[int]:
    """Least costs of a piece from each state (rows) to each state (columns)."""
    ways = [Lattice(codes, tuple(0 if s == t else FAR for s in range(STATES)), False) for t in range(STATES)]
    return [way.distance(s) for s in range(STATES) for way in ways]


def _after(costs: list[int], rest: list[int]) -> list[int]:
    return [min(min(FAR, costs[s * STATES + t] + rest[t]) for t in range(STATES)) for s in range(STATES)]


def _both(first: list[int], second: list[int]) -> list[int]:
    columns = [_after(first, second[t::STATES]) for t in range(STATES)]
    return [columns[t][s] for s in range(STATES) for t in range(STATES)]


def _rests(costs: list[list[int]], rest: list[int]) -> list[list[int]]:
    out = []
    for own in reversed(costs):
        out.append(rest)
        rest = _after(own, rest)
    return out[::-1]


def _entries(exits: list[list[int]], entry: list[int]) -> list[list[int]]:
    out = []
    for own in exits:
        out.append(entry)
        entry = [own[entry[0]]]
    return out


def edited_pieces(pieces: DataFrame, params: RepairParams) -> DataFrame:
    """conv, number, letters (of each row and after the last, joined by commas), cost (of the conversation, with its first piece).

    Most conversations are one piece and are solved alone. Of the others, pieces first give their costs from state to state;
    a scan backwards gives each the cost of what follows it, with which it is solved from every state; a scan forwards over the states in
    which these solutions end tells in which state each piece begins."""

    def alone(batches):
        def solve(codes):
            lattice = Lattice(codes, END, True)
            return ",".join(lattice.trace(START)[0]), lattice.distance(START)

        solved = WordCache(solve, 20_000)
        for batch in batches:
            for conv, codes in zip(*(c.to_pylist() for c in batch.columns)):
                letters, cost = solved[codes]
                yield conv, 1, letters, cost

    ddl = "conv string, number bigint, letters string, cost bigint"
    single = map_rows(pieces.filter("total = 1").select("conv", "codes"), alone, ddl)
    several = pieces.filter("total > 1")
    if several.isEmpty():
        return single

    def between(batches):
        for batch in batches:
            for conv, number, codes in zip(*(c.to_pylist() for c in batch.columns)):
                yield conv, number, costs_between(codes)

    def traced(batches):
        for batch in batches:
            for conv, number, total, codes, rest in zip(*(c.to_pylist() for c in batch.columns)):
                last = number == total
                lattice = Lattice(codes, END if last else tuple(rest), last)
                ways = [lattice.trace(s) for s in range(STATES)]
                cost = lattice.distance(START) if number == 1 else 0
                yield conv, number, [state for _, state in ways], [",".join(x) for x, _ in ways], cost

    valued = "conv string, number bigint, value array<bigint>"
    costs = materialize(map_rows(several.select("conv", "number", "codes"), between, valued), "piece-costs")
    rests = scan(costs, params, lambda own: reduce(_both, own), _rests, ENDINGS)
    known = several.join(rests, ["conv", "number"]).select("conv", "number", "total", "codes", "given")
    ways = materialize(map_rows(known, traced, f"{valued}, ways array<string>, cost bigint"), "piece-ways")
    exits = ways.select("conv", "number", "value")
    entries = scan(exits, params, lambda own: [reduce(lambda s, f: f[s], own, s) for s in range(STATES)], _entries, [START])
    picked = ways.join(entries, ["conv", "number"]).select(
        "conv", "number", F.get("ways", F.get("given", F.lit(0)).cast("int")).alias("letters"), "cost"
    )
    return single.unionByName(picked)


def edited_lines(role: str, text: str, letters: str, state: int) -> tuple[list[str], int]:
    """Lines ``role:text`` that the edits of one row give, and the state after them."""
    lines = []
    for letter in letters:
        if letter == "D":
            continue
        given = _GIVEN[state]
        initial = role[0] if letter == "K" else given
        lines.append({"I": f"{ROLES[given]}:", "K": f"{role}:{text}", "R": f"{ROLES[given]}:{text}"}[letter])
        state = _AFTER[state, initial]
    return lines, state


def _repaired(batches: Iterator[pa.RecordBatch], keep_text: bool) -> Iterator[tuple]:
    """Per conversation, streaming: rows come by conversation in order, each piece's edits before the piece's first row."""
    conv, held = None, None

    class Conversation:
        def __init__(self):
            self.queue, self.letters, self.place, self.state = deque(), [], 0, START
            self.audit, self.cost, self.illegal = [], 0, 0
            self.digest, self.any, self.lines = hashlib.sha256(), False, []

        def say(self, role, text, letters):
            self.audit.append(letters)
            lines, self.state = edited_lines(role, text, letters, self.state)
            for line in lines:
                self.digest.update(("\n" if self.any else "").encode() + line.encode())
                self.any = True
                if keep_text:
                    self.lines.append(line)

        def row(self, role, text):
            if self.place >= len(self.letters) - 1:
                self.letters, self.place = self.queue.popleft().split(","), 0
            self.say(role, text, self.letters[self.place])
            self.place += 1

        def result(self):
            self.say("", "", self.letters[-1])
            found = (self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())
            return (*found, self.lines) if keep_text else found

    for batch in batches:
        for own, role, text, letters, cost, illegal in zip(*(c.to_pylist() for c in batch.columns)):
            if held is None or own != conv:
                if held is not None:
                    yield conv, *held.result()
                conv, held = own, Conversation()
            if letters is not None:
                held.queue.append(letters)
                held.cost += cost
                held.illegal += illegal
            else:
                held.row(role, text)
    if held is not None:
        yield conv, *held.result()


def repair(rows: DataFrame, params: RepairParams = RepairParams(), keep_text: bool = False) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text): gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256;
    with ``keep_text`` also repaired (lines ``role:text``).

    Rows are taken by turn, nulls first; rows of one turn by a digest of role and text, so that equal rows stay adjacent. A null id is
    a conversation. Roles that do not begin with s, u or a (empty ones too) are kept nowhere. Every row is solved in a piece of bounded size; a long
    conversation is many pieces over many tasks. Only the hash, and the audit as one string, run through a conversation as a
    whole: one task reads its rows in order, holding a batch at a time (all lines with ``keep_text``).
    """
    rows = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    marked = marked_rows(rows)
    pieces = pieces_of(marked, params)
    edits = (
        pieces.join(edited_pieces(pieces, params), ["conv", "number"])
        .select("conv", "turn", "digest", "number", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
                "letters", "cost", "illegal")
    )
    none = [F.lit(None).cast(k).alias(c) for c, k in (("letters", "string"), ("cost", "long"), ("illegal", "long"))]
    # an edit before the row it begins with: no number comes last
    lines = rows.select(*_sort_key(), F.lit((1 << 62)).alias("number"), "role", "text", *none)
    streamed = (
        lines.unionByName(edits).repartition("conv").sortWithinPartitions("conv", "turn", "digest", "number")
        .select("conv", "role", "text", "letters", "cost", "illegal")
    )
    ddl = "conv string, illegal bigint, cost bigint, audit string, repaired_sha256 string"
    ddl += ", repaired array<string>" if keep_text else ""
    solved = map_rows(streamed, lambda batches: _repaired(batches, keep_text), ddl)
    wide = F.max("turn").cast("decimal(20,0)") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = marked.groupBy("conv").agg(
        F.least(F.coalesce(wide, F.lit(0)), F.lit((1 << 63) - 1)).cast("long").alias("gaps"),
        *[F.count_if(F.col("fault") == f).alias(name) for f, name in (("b", "blank"), ("d", "duplicate"), ("t", "truncated"))],
    )
    return counts.join(solved, "conv").select(
        F.when(F.col("conv") != "", F.col("conv")).cast("long").alias("conv_id"), *counts.columns[1:], *solved.columns[1:]
    )


def repair_damaged(conversations: DataFrame, params: RepairParams = RepairParams()) -> DataFrame:
    """Result of ``repair`` on the damaged rows, for every conv_id of ``conversations``; where no row is left: zeros, an empty
    audit, the hash of nothing. Nulls in texts and keys count as one space; an empty table gives an empty one; other columns are not read."""
    found = repair(damaged(conversations), params)
    ids = conversations.select(F.col("conv_id").cast("long").alias("_conv")).distinct()
    nothing = {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    return ids.join(found, F.col("_conv").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("_conv").alias("conv_id"),
        *[F.coalesce(F.col(c), F.lit(nothing.get(c, 0))).alias(c) for c in found.columns[1:]],
    )
