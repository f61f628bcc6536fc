"""Conversation structure repair by an auction for shortest paths.

A conversation is a lattice of levels, one for each turn and one behind the last, with four states each: nothing yet, after
the system turn, after a user turn, after an assistant turn.  Arcs keep, rerole or delete the turn and go to the next
level, or insert an empty turn and stay; their costs are whole numbers.  The auction holds a price at each node, never above
an arc's cost plus the price at its end.  From the origin it extends a path to the end of the cheapest arc while that costs no more
than the price, else it raises the price and contracts the path by a node.  When the path has reached the destination, prices
along it are distances; tight arcs, those whose cost is exactly the difference of prices, are then traced with the least letter first.

A conversation's turns are read as one letter each.  Long ones are cut into blocks: the prices that a block's auction settles
at its first level are the terminal costs of the block before it, so work grows with the length and memory with
one letter a turn.  Texts aren't gathered: they pass a task in order and go straight into the digest.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campanile.llm.ship import ship

#: Costs of the edits; a truncated turn that isn't deleted costs one more.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Turns of one auction, and of conversations whose solutions are remembered.
BLOCK, SHORT = 16, 64
#: States, and where a turn of a role leads.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
_NEXT = {"s": {START: AFTER_SYSTEM}, "u": {START: AFTER_USER, AFTER_SYSTEM: AFTER_USER, AFTER_ASSISTANT: AFTER_USER},
         "a": {AFTER_USER: AFTER_ASSISTANT}}
#: An inserted or reroled turn is the one of user and assistant that may come next.
_MADE = (AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER)
ROLE_OF = {AFTER_SYSTEM: "system", AFTER_USER: "user", AFTER_ASSISTANT: "assistant"}
_FAR = 1 << 60
#: What a conversation may end with: nothing, or an assistant turn.
_ENDS = (0, _FAR, _FAR, 0)

#: Letters of turns: the role's initial (``.`` for any other), a capital if it must be deleted, the next letter of ``suav`` if truncated.
TURNS = {"s": ("s", False, False), "u": ("u", False, False), "a": ("a", False, False), ".": (".", False, False),
         "S": ("s", True, False), "U": ("u", True, False), "A": ("a", True, False), ",": (".", True, False),
         "1": ("s", False, True), "2": ("u", False, True), "3": ("a", False, True), "4": (".", False, True)}
_PLAIN, _DELETED, _CUT = "sua.", "SUA,", "1234"


class Auction:
    """One block of turns with the costs behind its last level; ``last`` if no block follows."""

    def __init__(self, turns: str, ends: tuple[int, ...], last: bool):
        self.base = min(ends)  # prices rise from the least cost behind the block, not from the start of the conversation's
        self.turns, self.ends, self.last = turns, tuple(e - self.base for e in ends), last
        self.prices = [0] * (4 * len(turns) + 5)
        self.goal = 4 * len(turns) + 4
        self.settled = {self.goal}

    def arcs(self, node: int):
        """``letter, cost, end`` of the arcs of a node, letters ascending; the arc behind the last level has none."""
        level, state = divmod(node, 4)
        if level == len(self.turns):
            if self.ends[state] < _FAR // 2:
                yield "", self.ends[state], self.goal
            if self.last:
                yield "I", INSERT, 4 * level + _MADE[state]
            return
        role, deleted, cut = TURNS[self.turns[level]]
        extra = TRUNCATED if cut else 0
        yield "D", DELETE, node + 4
        yield "I", INSERT, 4 * level + _MADE[state]
        if not deleted:
            kept = _NEXT.get(role, {}).get(state)
            if kept is not None:
                yield "K", extra, 4 * level + 4 + kept
            yield "R", REROLE + extra, 4 * level + 4 + _MADE[state]

    def settle(self, origin: int) -> int:
        """Bid until a path from ``origin`` reaches a settled node; the cost from there to the end."""
        path = [origin]
        prices = self.prices
        while (node := path[-1]) not in self.settled:
            best, end = min((cost + prices[to], to) for _, cost, to in self.arcs(node)) if node != self.goal else (0, node)
            if prices[node] < best:
                prices[node] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(end)
        self.settled.update(path)
        return prices[origin]

    def trace(self, state: int) -> tuple[str, int]:
        """The least word of edits along tight arcs from a state of the first level, and the state it ends in."""
        node, word = state, []
        self.settle(node)
        while True:
            for letter, cost, end in self.arcs(node):
                # A price may still be below the distance: the arc is tight only if it is so once its end is settled.
                if self.prices[node] == cost + self.prices[end] and self.prices[node] == cost + self.settle(end):
                    break
            if end == self.goal:
                return "".join(word), node % 4
            word.append(letter)
            node = end


def repair_turns(turns: str, block: int = BLOCK) -> tuple[int, str]:
    """Cost and edits of the cheapest repair; of equally cheap ones the least in ASCII."""
    cuts = range(0, max(len(turns), 1), block)
    ends = {cuts[-1]: _ENDS}
    for at in reversed(cuts[1:]):
        auction = Auction(turns[at:at + block], ends[at], at == cuts[-1])
        ends[at - block] = tuple(auction.settle(state) + auction.base for state in range(4))
    state, words, cost = START, [], 0
    for at in cuts:
        auction = Auction(turns[at:at + block], ends[at], at == cuts[-1])
        if at == 0:
            cost = auction.settle(START) + auction.base
        word, state = auction.trace(state)
        words.append(word)
    return cost, "".join(words)


@lru_cache(1 << 14)
def _short(turns: str) -> tuple[int, str]:
    return repair_turns(turns)


def illegal_pairs(turns: str) -> int:
    """Neighbours whose initials aren't system and user, user and assistant, or assistant and user."""
    initials = [TURNS[c][0] for c in turns]
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage, as the crc32 of conversation and turn deals it; nulls in texts and roles are one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"),
                                (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20).alias("kind"))
    rows = rows.filter("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again"))
    return rows.drop("again")


def _turn_letter(role: Column, fault: Column) -> Column:
    place = F.position(F.substring(role, 1, 1), F.lit("sua"))
    # An empty role is found at place 1, so it is told apart first.
    place = F.when((role == "") | (place == 0), 4).otherwise(place)
    letters = F.when(fault.isin("blank", "duplicate"), _DELETED).when(fault == "truncated", _CUT).otherwise(_PLAIN)
    return F.substring(letters, place, F.lit(1))


def faults(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, digest, letter, n`` of ``rows(conv_id, turn, role, text)``: equal rows of a turn are one of ``n``.

    A row's first fault counts: blank, duplicate of an earlier row's role and text, truncated.  Of equal rows the
    first of the least turn is no duplicate: where a turn holds several, ``duplicates`` of them are.
    """
    last = F.expr(r"right(trim(TRAILING ' \u0009\u000A\u000B\u000C\u000D' FROM text), 1)")
    light = rows.select("conv_id", "turn", "role", F.md5(F.col("text").cast("binary")).alias("digest"), (last == "").alias("blank"),
                        (~last.isin(".", "!", "?")).alias("cut"))
    light = light.groupBy("conv_id", "turn", "role", "digest", "blank", "cut").agg(F.count("*").alias("n"))
    # Fixed-width sums keep this a hash aggregation: a null turn comes first, else the least does.
    firsts = light.groupBy("conv_id", "role", "digest").agg(F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("no_turn"))
    firsts = firsts.select(F.col("conv_id").alias("f_conv"), F.col("role").alias("f_role"), F.col("digest").alias("f_digest"),
                           F.when(~F.col("no_turn"), F.col("least")).alias("f_turn"))
    # Matched on key and place, so a hot conversation's rows are spread over all tasks.
    met = light.join(firsts, light["conv_id"].eqNullSafe(firsts["f_conv"]) & light["turn"].eqNullSafe(firsts["f_turn"])
                     & (light["role"] == firsts["f_role"]) & (light["digest"] == firsts["f_digest"]), "left")
    first = F.col("f_digest").isNotNull()
    one = F.when(F.col("blank"), "blank").when(F.col("cut"), "truncated")
    duplicates = F.when(F.col("blank"), 0).otherwise(F.col("n") - F.when(first, 1).otherwise(0)).cast("bigint")
    again = F.when(F.col("blank"), "blank").otherwise("duplicate")
    return met.select("conv_id", "turn", "role", "digest", "n", duplicates.alias("duplicates"), F.when(F.col("blank"), F.col("n")).otherwise(0).cast("bigint").alias("blanks"),
                      F.when(~F.col("blank") & F.col("cut") & first, 1).otherwise(0).cast("bigint").alias("truncated"),
                      F.when(first, _turn_letter(F.col("role"), one)).otherwise("").alias("first_letter"),
                      _turn_letter(F.col("role"), again).alias("next_letter"))


def _by_conversation(batches, names: tuple[str, ...]):
    """``new, rows`` of consecutive rows, where ``new`` says that another conversation starts."""
    before = ()
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in names]
        for row in zip(*columns):
            yield (row[0],) != before, row
            before = (row[0],)


def _solve(batches):
    """Per conversation, from its sorted turns: the letters of its turns, pairs, cost and edits."""
    names = ("conv_id", "first_letter", "next_letter", "n")
    out: list[tuple] = []

    def closed(conv, parts):
        turns = "".join(parts)
        cost, audit = _short(turns) if len(turns) <= SHORT else repair_turns(turns)
        return conv, illegal_pairs(turns), cost, audit

    def pack():
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                                          names=["conv_id", "illegal", "cost", "audit"])

    parts: list[str] | None = None
    conv = None
    for new, (conv_id, first, following, n) in _by_conversation(batches, names):
        if new:
            if parts is not None:
                out.append(closed(conv, parts))
            conv, parts = conv_id, []
        parts.append(first + following * (n - len(first)))
        if len(out) >= 4096:
            yield pack()
            out.clear()
    if parts is not None:
        out.append(closed(conv, parts))
    yield pack()


class _Digest:
    """SHA-256 of the repaired turns, fed turn by turn along the edits."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.hash, self.any = audit, 0, START, hashlib.sha256(), False

    def _write(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.any else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.any = True

    def _inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.state = _MADE[self.state]
            self._write(ROLE_OF[self.state], "")
            self.at += 1

    def turn(self, role: str, text: str) -> None:
        self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = _NEXT[role[0]][self.state]
            self._write(role, text)
        elif edit == "R":
            self.state = _MADE[self.state]
            self._write(ROLE_OF[self.state], text)

    def end(self) -> str:
        self._inserted()
        return self.hash.hexdigest()


def _digests(batches):
    """Per conversation: the digest of its repaired turns; the row with the edits comes before its turns."""
    out: list[tuple] = []

    def pack():
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.string())],
                                          names=["conv_id", "repaired_sha256"])

    digest, conv = None, None
    for new, (conv_id, audit, role, text) in _by_conversation(batches, ("conv_id", "audit", "role", "text")):
        if new:
            if digest is not None:
                out.append((conv, digest.end()))
            conv, digest = conv_id, _Digest(audit)
        else:
            digest.turn(role, text)
        if len(out) >= 4096:
            yield pack()
            out.clear()
    if digest is not None:
        out.append((conv, digest.end()))
    yield pack()


def repair(rows: DataFrame, originals: DataFrame | None = None) -> DataFrame:
    """One row for each conversation of ``rows(conv_id, turn, role, text)`` and of ``originals(conv_id)``.

    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.  Turns are taken in order, null
    turns first; rows of one turn by role, then by a digest of their text, so equal ones are neighbours.  A null conv_id is a conversation
    of its own.  A null role or text is one space.  A turn whose role has another initial than s, u or a, an empty one too, can't be kept as it is.
    A conversation of ``originals`` without rows has zeros, no edits and the digest of the empty string.  Other columns
    are ignored; an empty table gives no rows.  A conversation's edits and its digest are one value each, so its
    turns pass one task, in order: a letter of each is held, texts are not.
    """
    ship(rows.sparkSession)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), text("role"), text("text"))
    marked = faults(rows)
    counts = marked.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        F.sum("blanks").alias("blank"), F.sum("duplicates").alias("duplicate"), F.sum("truncated").alias("truncated"))
    place = ("conv_id", "turn", "role", "digest")
    solved = marked.select(*place, "first_letter", "next_letter", "n").repartition("conv_id").sortWithinPartitions(*place).select(
        "conv_id", "first_letter", "next_letter", "n").mapInArrow(_solve, "conv_id bigint, illegal bigint, cost bigint, audit string")
    nothing = F.lit(None).cast("string")
    turns = rows.select("conv_id", F.lit(1).alias("part"), "turn", "role", F.md5(F.col("text").cast("binary")).alias("digest"), nothing.alias("audit"), "text")
    heads = solved.select("conv_id", F.lit(0).alias("part"), F.lit(None).cast("bigint").alias("turn"), nothing.alias("role"),
                          nothing.alias("digest"), "audit", nothing.alias("text"))
    hashed = heads.unionByName(turns).repartition("conv_id").sortWithinPartitions("conv_id", "part", "turn", "role", "digest").select(
        "conv_id", "audit", "role", "text").mapInArrow(_digests, "conv_id bigint, repaired_sha256 string")
    zero = lambda *names: [F.lit(0).cast("bigint").alias(n) for n in names]
    wide = [
        counts.select("conv_id", "gaps", "blank", "duplicate", "truncated", *zero("illegal", "cost"), nothing.alias("audit"), nothing.alias("repaired_sha256")),
        solved.select("conv_id", *zero("gaps", "blank", "duplicate", "truncated"), "illegal", "cost", "audit", nothing.alias("repaired_sha256")),
        hashed.select("conv_id", *zero("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), nothing.alias("audit"), "repaired_sha256")]
    every = rows if originals is None else originals
    ids = every.select(F.col("conv_id").cast("bigint").alias("conv_id"), *zero("gaps", "blank", "duplicate", "truncated", "illegal", "cost"),
                       nothing.alias("audit"), nothing.alias("repaired_sha256"))
    whole = wide[0].unionByName(wide[1]).unionByName(wide[2]).unionByName(ids).groupBy("conv_id").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.max("audit").alias("audit"), F.max("repaired_sha256").alias("repaired_sha256"))
    return whole.withColumns({"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))})
