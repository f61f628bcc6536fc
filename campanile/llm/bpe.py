"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming decoding.

A text is cut by the tokenizer's pattern; each piece is encoded by itself.  The transducer
reads a piece byte by byte.  For every place where a token may still begin, it knows which
token ends there: in byte-level BPE a row of tokens is an encoding exactly if every two
neighbours are, so the last token of each prefix is unique.  Tokens that all live places
agree on are emitted at once; a place stays live only while some token continues what was
read since, so the lookahead is bounded by the longest token.  States and transitions are
made when they have been met a few times, and kept; until then the live places are
followed without making a state.  The tables are dropped when they are full, as they can always be made again.

Decoding feeds the ids to an incremental UTF-8 state machine chunk by chunk; it gives out the bytes of whole characters
and holds back those of an unfinished one.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from struct import pack
from threading import Timer

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campanile.llm.ship import bound_blocks, ship
from campanile.llm.words import batches

#: Kept states, pieces and neighbour tests; a full table is dropped and begun anew.
MAX_STATES, MAX_PIECES, MAX_PAIRS = 50_000, 150_000, 150_000
#: A move is made when it was wanted so many times before.
OFTEN = 4
#: Bytes of a rest that is settled from its end, and the mark of a place that isn't decided yet.
SHORT, OPEN = 128, object()
#: Ids that the decoder takes at once.
CHUNK = 4096


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: per line a token in base64 and its rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def merge_all(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Byte-pair encoding by its definition: join the neighbours of lowest rank, leftmost first, until none is left."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            break
        i = min(found)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


class Transducer:
    """Encodes pieces; ``step`` follows one byte from a state and returns the next state and the tokens emitted."""

    START = 0

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self._longest = max(map(len, ranks), default=0)
        self._never = len(ranks) + max(ranks.values(), default=0)
        # The tokens as a trie: per byte the token that ends there, or -1, and the nodes below, if any.
        self._root: dict[int, tuple[int, dict | None]] = {}
        for token, rank in ranks.items():
            node = self._root
            for byte in token[:-1]:
                ending, below = node.get(byte, (-1, None))
                if below is None:
                    below = {}
                    node[byte] = ending, below
                node = below
            node[token[-1]] = rank, node.get(token[-1], (-1, None))[1]
        self._pairs: dict[int, bool] = {}
        self._spines: dict[int, tuple[list, list]] = {}
        self._reset()

    def _reset(self) -> None:
        # A state: the last token emitted and the bytes read since; beside it, per place among them, the
        # token that ends there.
        self._states = [(-1, b"")]
        self._places: list[tuple] = [()]
        self._number = {self._states[0]: 0}
        self._moves: dict[int, tuple[int, tuple[int, ...]]] = {}
        self._ends: dict[int, tuple[int, ...]] = {}
        self._met: dict[int, int] = {}
        self._lives: dict[int, list[tuple[int, dict]]] = {}

    def _live(self, state: int) -> list[tuple[int, dict]]:
        """Places of a state where a token may still begin, each with its nodes in the trie."""
        live = self._lives.get(state)
        if live is None:
            pending, ends = self._states[state][1], (self._states[state][0], *self._places[state])
            live = [(p, self._below(pending[p:])) for p in range(len(pending) + 1) if ends[p] is not None]
            live = self._lives[state] = [(p, node) for p, node in live if node is not None]
        return live

    def _edges(self, token: int) -> tuple[list, list]:
        """The parts that stood at the token's right and left edge while it was merged, each with the rank that ended it."""
        known = self._spines.get(token)
        if known is None:
            data = self.token[token]
            parts = [data[i:i + 1] for i in range(len(data))]
            right, left = [[parts[-1], None]], [[parts[0], None]]
            while len(parts) > 1:
                found = [(self.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.ranks]
                if not found:
                    break
                rank, i = min(found)
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
                for edge, part in ((right, parts[-1]), (left, parts[0])):
                    if edge[-1][0] != part:
                        edge[-1][1] = rank
                        edge.append([part, None])
            pack_ = lambda edge: [(part, self._never if rank is None else rank) for part, rank in edge]
            known = self._spines[token] = (pack_(right), pack_(left)) if len(parts) == 1 else ([], [])
        return known

    def _neighbours(self, left: int, right: int) -> bool:
        """Whether ``left, right`` (or ``right`` alone, at the start) is what its bytes are encoded to.

        Merges go by rising rank, so the two stay apart unless some part at the one's right edge joins a part at
        the other's left edge before either has been merged into its own token.
        """
        if left < 0:
            return bool(self._edges(right)[0])
        known = self._pairs.get(left << 32 | right)
        if known is None:
            if len(self._pairs) >= MAX_PAIRS:
                self._pairs.clear()
            ending, beginning = self._edges(left)[0], self._edges(right)[1]
            known = bool(ending and beginning)
            for one, until in ending if known else ():
                for two, till in beginning:
                    rank = self.ranks.get(one + two)
                    if rank is not None and rank < until and rank <= till:
                        known = False
            self._pairs[left << 32 | right] = known
        return known

    def _below(self, part: bytes) -> dict | None:
        """The nodes below ``part``; None if no token begins with it and goes on."""
        node = self._root
        for byte in part:
            node = node.get(byte, (-1, None))[1]
            if node is None:
                break
        return node

    def _chain(self, ends: tuple, place: int) -> list[int]:
        """Tokens from the first pending byte to ``place``."""
        out = []
        while place:
            out.append(ends[place - 1])
            place -= len(self.token[out[-1]])
        return out[::-1]

    def _make(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        last, pending = self._states[state]
        ends = self._places[state]
        read = pending + bytes((byte,))
        ending, ranks, size = None, self.ranks, len(read)
        for start in range(size):
            before = ends[start - 1] if start else last
            if before is not None:
                right = ranks.get(read[start:])
                if right is not None and self._neighbours(before, right):
                    ending = right
                    break
        ends = (*ends, ending)
        emitted: tuple[int, ...] = ()
        if self._below(read) is None:  # no token can begin at the first place any more
            live = [p for p in range(1, size) if ends[p - 1] is not None and self._below(read[p:]) is not None]
            if ending is not None:
                live.append(size)
            chains = {p: self._chain(ends, p) for p in live}
            common = []
            for tokens in zip(*chains.values()):
                if tokens.count(tokens[0]) < len(tokens):
                    break
                common.append(tokens[0])
            if common:
                emitted, last = tuple(common), common[-1]
                cut = sum(len(self.token[t]) for t in common)
                kept = dict.fromkeys(range(cut + 1, size + 1))
                for p, chain in chains.items():
                    for token in reversed(chain[len(common):]):
                        kept[p] = token
                        p -= len(self.token[token])
                read, ends = read[cut:], tuple(kept.values())
        number = self._number.get((last, read))
        if number is None:
            number = self._number[last, read] = len(self._states)
            self._states.append((last, read))
            self._places.append(ends)
        return number, emitted

    def step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        move = self._moves.get(state << 8 | byte)
        if move is None:
            move = self._moves[state << 8 | byte] = self._make(state, byte)
        return move

    def finish(self, state: int) -> tuple[int, ...]:
        """Tokens of the bytes still pending when the piece ends."""
        tokens = self._ends.get(state)
        if tokens is None:
            ends = self._places[state]
            tokens = self._ends[state] = tuple(self._chain(ends, len(ends)))
        return tokens

    def _settle(self, read: bytes, ends: list, end: int):
        """The token that ends at ``end``, the longest that may follow the one before it; decides what it needs and no more."""
        ranks, pairs = self.ranks, self._pairs
        for start in range(max(0, end - self._longest), end):
            right = ranks.get(read[start:end])
            if right is not None:
                before = ends[start]
                if before is OPEN:
                    before = self._settle(read, ends, start)
                if before is not None:
                    good = pairs.get(before << 32 | right) if before >= 0 else None
                    if self._neighbours(before, right) if good is None else good:
                        ends[end] = right
                        return right
        ends[end] = None
        return None

    def _run(self, state: int, rest: bytes) -> list[int]:
        """Tokens of the pending bytes and ``rest``, without new states.

        A short rest is settled from its end, so most places are never looked at; through a long one all live
        places are followed at once.
        """
        last, pending = self._states[state]
        if len(rest) <= SHORT:
            read, ends = pending + rest, [last, *self._places[state], *[OPEN] * len(rest)]
            self._settle(read, ends, len(read))
            return self._chain(ends[1:], len(read))
        ends = [last, *self._places[state]]
        pairs, root = self._pairs, self._root
        # A live place is a number and the nodes that may follow, and moves by one look-up a byte.
        live = self._live(state)
        for end, byte in enumerate(rest, len(pending) + 1):
            ending, still = None, []
            for start, node in live:
                hit = node.get(byte)
                if hit is None:
                    continue
                right, below = hit
                if right >= 0 and ending is None:
                    before = ends[start]
                    good = pairs.get(before << 32 | right) if before >= 0 else None
                    if self._neighbours(before, right) if good is None else good:
                        ending = right
                if below is not None:
                    still.append((start, below))
            if ending is not None:
                still.append((end, root))
            ends.append(ending)
            live = still
        return self._chain(tuple(ends[1:]), len(ends) - 1)

    def encode(self, piece: bytes) -> list[int]:
        """Follows known moves; a move is made when it has been met ``OFTEN`` times."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self._states) > MAX_STATES:
            self._reset()
        state, out, moves = self.START, [], self._moves
        for i, byte in enumerate(piece):
            key = state << 8 | byte
            move = moves.get(key)
            if move is None:
                met = self._met.get(key, 0)
                if met < OFTEN:
                    if len(self._met) >= MAX_STATES:
                        self._met.clear()
                    self._met[key] = met + 1
                    return out + self._run(state, piece[i:])
                move = self.step(state, byte)
            state = move[0]
            if move[1]:
                out.extend(move[1])
        out.extend(self.finish(state))
        return out


class Encoder:
    """Texts to ids, packed as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer = Transducer(ranks)
        # White space as Unicode defines it; Python's own class also holds the separators 1C to 1F.
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        # Two generations of pieces: what is used again moves to the young one.
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        packed = self._old.get(piece)
        if packed is None:
            ids = self.transducer.encode(piece.encode("utf-8"))
            packed = pack(f"<{len(ids)}I", *ids)
        if len(piece) <= 64:
            if len(self._young) >= MAX_PIECES:
                self._old, self._young = self._young, {}
            self._young[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        found, piece = self._young.get, self._piece
        return b"".join([found(p) or piece(p) for p in self.pattern.findall(text)])


def _utf8_moves() -> list[bytes]:
    """Per state and byte the next state of the UTF-8 machine; ``ILL`` where the byte can't follow.

    State 0 is between characters; 1 to 3 wait for that many more bytes; 4 to 7 come after E0, ED, F0 and F4, whose
    second byte is bounded further.
    """
    moves = [bytearray([ILL]) * 256 for _ in range(8)]
    for state, first, last, to in ((0, 0x00, 0x7F, 0), (0, 0xC2, 0xDF, 1), (0, 0xE0, 0xE0, 4), (0, 0xE1, 0xEC, 2), (0, 0xED, 0xED, 5),
                                   (0, 0xEE, 0xEF, 2), (0, 0xF0, 0xF0, 6), (0, 0xF1, 0xF3, 3), (0, 0xF4, 0xF4, 7),
                                   (1, 0x80, 0xBF, 0), (2, 0x80, 0xBF, 1), (3, 0x80, 0xBF, 2),
                                   (4, 0xA0, 0xBF, 1), (5, 0x80, 0x9F, 1), (6, 0x90, 0xBF, 2), (7, 0x80, 0x8F, 2)):
        moves[state][first:last + 1] = bytes([to]) * (last + 1 - first)
    return [bytes(m) for m in moves]


#: Marks of a move: the byte can't follow; the character that is unfinished began within the token.
ILL, FRESH = 255, 8
UTF8_MOVES = _utf8_moves()
#: What a first byte adds to its character, by the state that it leads to.
_FIRST_BITS = (0x7F, 0x1F, 0x0F, 0x07, 0x0F, 0x0F, 0x07, 0x07)


class Utf8Stream:
    """Incremental decoding of bytes: ``feed`` returns the characters that are complete, ``close`` the rest.

    Ill-formed bytes become U+FFFD, one for each character begun and broken off and for each byte that begins none.
    """

    def __init__(self):
        self.state, self.point = 0, 0

    def feed(self, data: bytes) -> str:
        out = []
        for byte in data:
            to = UTF8_MOVES[self.state][byte]
            if to == ILL and self.state:
                out.append("\ufffd")
                self.state = 0
                to = UTF8_MOVES[0][byte]
            if to == ILL:
                out.append("\ufffd")
                continue
            self.point = self.point << 6 | byte & 0x3F if self.state else byte & _FIRST_BITS[to]
            self.state = to
            if not to:
                out.append(chr(self.point))
        return "".join(out)

    def close(self) -> str:
        rest, self.state = "\ufffd" if self.state else "", 0
        return rest


class StreamDecoder:
    """Incremental decoding of ids: ``feed`` returns the bytes of whole characters, ``close`` those of an unfinished one.

    The UTF-8 machine is moved by tokens; where a token leads from a state is found byte by byte once and kept.  Between
    characters it goes on at the next token that doesn't end between characters again.
    """

    def __init__(self, token: list[bytes]):
        self.token, self.state, self.held = token, 0, b""
        self._moves: dict[int, int] = {}  # at most eight for each token
        self._cuts = np.array([self._leads(data, 0) & 7 > 0 for data in token], bool)  # tokens that end within a character

    @staticmethod
    def _leads(data: bytes, state: int) -> int:
        """The next state, plus ``FRESH`` if its character began within ``data``."""
        fresh = 0
        for byte in data:
            to = UTF8_MOVES[state][byte]
            if to == ILL:  # a broken character ends before this byte
                state, to = 0, UTF8_MOVES[0][byte]
            fresh = fresh if state else FRESH
            state = 0 if to == ILL else to
        return state | fresh

    def feed(self, ids: list[int] | np.ndarray) -> bytes:
        numbers = np.asarray(ids, np.int64)
        ids, cuts = numbers.tolist(), iter(np.flatnonzero(self._cuts[numbers]).tolist())
        state, moves, place = self.state, self._moves, 0
        whole = -1 if state else 0  # ids before ``whole`` are whole characters; -1: not even what is held is
        while place < len(ids):
            if not state:
                place = whole = next((c for c in cuts if c >= place), len(ids))
                if place == len(ids):
                    break
            key = ids[place] << 3 | state
            move = moves.get(key, -1)
            if move < 0:
                move = moves[key] = self._leads(self.token[key >> 3], state)
            place, state = place + 1, move & 7
            if not state:
                whole = place
            elif move & FRESH:
                whole = place - 1
        self.state = state
        if whole < 0:
            self.held += b"".join(map(self.token.__getitem__, ids))
            return b""
        data = self.held + b"".join(map(self.token.__getitem__, ids[:whole]))
        self.held = b"".join(map(self.token.__getitem__, ids[whole:]))
        return data

    def close(self) -> bytes:
        rest, self.state, self.held = self.held, 0, b""
        return rest


def tokens_by_rank(ranks: dict[bytes, int]) -> list[bytes]:
    token = [b""] * (max(ranks.values(), default=-1) + 1)
    for data, rank in ranks.items():
        token[rank] = data
    return token


def decode_stream(ids: Iterable[int], token: list[bytes]) -> Iterator[str]:
    """Text of a stream of ids, given out as soon as characters are complete."""
    machine = Utf8Stream()
    for i in ids:
        if text := machine.feed(token[i]):
            yield text
    if text := machine.close():
        yield text


class Kept:
    """One object that a Python worker keeps between tasks, until none has used it for ``SECONDS``.

    Workers are used again by whatever runs next, so what they keep would add to its memory.
    """

    SECONDS = 5.0

    def __init__(self):
        self.key, self.value, self.timer = None, None, None

    def take(self, key, make):
        """The object made for ``key``, here until it is put back."""
        if self.timer is not None:
            self.timer.cancel()
        value = self.value if self.key == key else None
        self.key = self.value = None
        return make() if value is None else value

    def put(self, key, value) -> None:
        self.key, self.value = key, value
        self.timer = Timer(self.SECONDS, self.drop)
        self.timer.daemon = True
        self.timer.start()

    def drop(self) -> None:
        self.key = self.value = None


_KEPT = Kept()


def _encode(blocks, shared, pattern: str):
    key = len(shared.value), pattern, hash(frozenset(shared.value.items()))
    encoder = _KEPT.take(key, lambda: Encoder(shared.value, pattern))
    for block in batches(blocks):
        ids = [encoder.encode(t or "") for t in block.column("text").to_pylist()]
        rest = [c for c in block.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([block.column(c) for c in rest] + [pa.array(ids, pa.binary())], names=[*rest, "ids"])
    _KEPT.put(key, encoder)


def _decode(blocks, shared, names: list[str]):
    """Columns ``names`` and the decoded bytes, chunk by chunk: a row's ids are fed to the machine ``CHUNK`` at a time."""
    decoder = StreamDecoder(shared.value)
    for block in batches(blocks):
        out = []
        for packed in block.column("ids").to_pylist():
            ids = np.frombuffer(packed or b"", "<u4")
            parts = [decoder.feed(ids[at:at + CHUNK]) for at in range(0, len(ids), CHUNK)]
            out.append(b"".join([*parts, decoder.close()]))
        yield pa.RecordBatch.from_arrays([block.column(c) for c in names] + [pa.array(out, pa.binary())], names=[*names, "decoded"])


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *keep: str) -> DataFrame:
    """``keep`` columns of ``docs(text, ...)`` with ``ids``: the whole text's tokens as little-endian 32-bit integers.

    Special tokens are ordinary text.  A null text counts as empty and has no ids.  The vocabulary is a
    broadcast of fixed size; every byte must be a token of it.
    """
    spark = docs.sparkSession
    ship(spark)
    bound_blocks(spark)
    shared = spark.sparkContext.broadcast(ranks)
    frame = docs.select(*keep, F.col("text").cast("string").alias("text"))
    out = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema if f.name != "text"] + ["ids binary"])
    return frame.mapInArrow(lambda b: _encode(b, shared, pattern), out)


def decode(encoded: DataFrame, ranks: dict[bytes, int], *keep: str) -> DataFrame:
    """``keep`` columns of ``encoded(ids, ...)`` with ``decoded``, the bytes of the tokens; null ids give no bytes."""
    spark = encoded.sparkSession
    ship(spark)
    bound_blocks(spark)
    shared = spark.sparkContext.broadcast(tokens_by_rank(ranks))
    frame = encoded.select(*dict.fromkeys([*keep, "ids"]))
    # Ids go to the workers once, whether they are kept or not.
    names = [c for c in frame.columns if c != "ids"] + ["ids"] * ("ids" in keep)
    out = ", ".join([f"`{c}` {frame.schema[c].dataType.simpleString()}" for c in names] + ["decoded binary"])
    return frame.mapInArrow(lambda b: _decode(b, shared, names), out)
