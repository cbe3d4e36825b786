"""Byte-level BPE as a lazily determinised transducer, and a streaming decoder.

Merges are compiled into a trie of tokens and the relation "b may follow a":
merging the bytes of a and b gives back a and b. A sequence of tokens is the
encoding of its bytes exactly if every neighbouring pair may follow each
other, so the encoder is a transducer that guesses where tokens end. Its
deterministic form is built state by state as texts ask for it: a state is the
set of guesses still alive, and a token leaves as soon as all of them agree on
it, which the length of the longest token bounds.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, functions as F

from lendsight.llm.words import Memo

#: States and finished pieces that a worker keeps; beyond it starts afresh.
MAX_STEPS = 300_000
MAX_PIECES = 150_000
MAX_STRETCHES = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base64 and its rank on each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def merge_bytes(data: bytes, ranks: dict[bytes, int], stop: int = 1) -> list[bytes]:
    """Plain merging: join the pair of least rank, the leftmost first, until none or ``stop`` parts are left."""
    parts = [data[i: i + 1] for i in range(len(data))]
    while len(parts) > stop:
        joined = [ranks.get(parts[i] + parts[i + 1]) for i in range(len(parts) - 1)]
        known = [r for r in joined if r is not None]
        if not known:
            break
        at = joined.index(min(known))
        parts[at: at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Transducer:
    """Encodes one piece of bytes at a time.

    A guess is (node of the trie, token before it, tokens taken but not sent).
    State numbers are those of ``guesses``; ``steps`` has (next state, tokens
    sent) by state and byte, ``ends`` the tokens sent when a piece ends there.

    The token before a node matters only for the tokens below that node. Where
    they are few, it is replaced by the first token seen that allows the same
    of them, which lets states meet again; a guess that allows none is dropped.
    """

    FEW = 24

    def __init__(self, ranks: dict[bytes, int], max_steps: int = MAX_STEPS):
        self.ranks, self.max_steps = ranks, max_steps
        self.tokens = {rank: token for token, rank in ranks.items()}
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary has no token for the bytes {missing[:5]}")
        self.child: dict[int, int] = {}
        self.token_at: dict[int, int] = {}
        self.below: dict[int, list[int]] = {}
        #: Tokens that merging never makes; such a piece as a whole is still its token.
        self.whole: dict[bytes, int] = {}
        self.halves: dict[bytes, list[bytes]] = {}
        nodes = 1
        for token, rank in ranks.items():
            halves = merge_bytes(token, ranks, stop=2)
            if len(halves) > 2:
                self.whole[token] = rank
                continue
            self.halves[token] = halves
            node = 0
            for byte in token:
                step = node << 8 | byte
                if step not in self.child:
                    self.child[step] = nodes
                    nodes += 1
                node = self.child[step]
                self.below.setdefault(node, []).append(rank)
            self.token_at[node] = rank
        self.below = {node: below for node, below in self.below.items() if len(below) <= self.FEW}
        self.ending = Memo(lambda token: self._spine(token, -1), len(ranks))
        self.starting = Memo(lambda token: self._spine(token, 0), len(ranks))
        self.reset()

    def reset(self) -> None:
        self.guesses: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.steps: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.ends: dict[int, tuple[int, ...]] = {}
        self.follows = Memo(self._may_follow, self.max_steps)
        self.alike: dict[tuple, int] = {}
        self.stand_in = Memo(self._stand_in, self.max_steps)
        self.start = self._number(((0, -1, ()),))

    def _spine(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """The parts of a token that touch its end (side -1) or start (side 0), from one byte up to the token.

        Each comes with the rank of the merge that uses it up.
        """
        spine, used = [], len(self.ranks) * 2
        part = self.tokens[token]
        while True:
            spine.append((part, used))
            if len(part) == 1:
                return spine[::-1]
            used, part = self.ranks[part], self.halves[part][side]

    def _may_follow(self, pair: tuple[int, int]) -> bool:
        """Whether merging the two tokens' bytes gives them back.

        Merges happen in the order of rank. A merge across the border comes
        first, and spoils the pair, if its rank is below that of the merges
        that next use up the part on its left and the part on its right; of
        equal ranks the leftmost comes first.
        """
        if pair[0] < 0:
            return True
        left, right = self.ending[pair[0]], self.starting[pair[1]]
        never = len(self.ranks) * 2
        i = j = 0
        while True:
            (before, on_left), (after, on_right) = left[i], right[j]
            across = self.ranks.get(before + after)
            if across is not None and across < on_left and across <= on_right:
                return False
            if on_left <= on_right:
                if on_left == never:
                    return True
                i += 1
            else:
                j += 1

    def _stand_in(self, at: tuple[int, int]) -> int | None:
        """The token that stands for another before a node, None if no token below the node may follow."""
        node, before = at
        allowed = tuple([self.follows[before, token] for token in self.below[node]])
        return self.alike.setdefault((node, allowed), before) if True in allowed else None

    def _number(self, state: tuple) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.guesses)
            self.guesses.append(state)
        return self.numbers[state]

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        alive = []
        for node, before, unsent in self.guesses[state]:
            node = self.child.get(node << 8 | byte)
            if node is None:
                continue
            token = self.token_at.get(node)
            if token is not None and self.follows[before, token]:
                alive.append((0, token, (*unsent, token)))
            if node in self.below:
                before = self.stand_in[node, before]
            if before is not None:
                alive.append((node, before, unsent))
        sent = []
        while all(unsent and unsent[0] == alive[0][2][0] for _, _, unsent in alive):
            sent.append(alive[0][2][0])
            alive = [(node, before, unsent[1:]) for node, before, unsent in alive]
        return self._number(tuple(sorted(alive))), tuple(sent)

    def encode(self, piece: bytes) -> list[int]:
        if piece in self.whole:
            return [self.whole[piece]]
        if len(self.steps) > self.max_steps:
            self.reset()
        state, out, steps = self.start, [], self.steps
        for byte in piece:
            step = steps.get(state << 8 | byte)
            if step is None:
                step = steps[state << 8 | byte] = self._step(state, byte)
            state, sent = step
            if sent:
                out += sent
        if state not in self.ends:
            # One guess has just ended a token: the encoding of what was read.
            self.ends[state] = next((unsent for node, _, unsent in self.guesses[state] if node == 0), ())
        out += self.ends[state]
        return out


class TextEncoder:
    """Texts to ids: pieces by the pattern, each encoded by itself."""

    #: White space beside white space. Without it a piece never reaches across a space, and a text can be cut at spaces.
    WIDE = regex.compile(r"\s\s")

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer = Transducer(ranks)
        self.pattern = regex.compile(pattern)
        self.pieces = Memo(self._encode_piece, MAX_PIECES)
        self.stretches = Memo(self._encode_stretch, MAX_STRETCHES)

    def _encode_piece(self, piece: str) -> bytes:
        ids = self.transducer.encode(piece.encode())
        return pack(f"<{len(ids)}I", *ids)

    def _encode_stretch(self, stretch: str) -> bytes:
        pieces = self.pattern.findall(stretch)
        return self.pieces[pieces[0]] if len(pieces) == 1 else b"".join([self.pieces[x] for x in pieces])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.WIDE.search(text):
            return self._encode_stretch(text)
        first, *rest = text.split(" ")
        return self.stretches[first] + b"".join([self.stretches[" " + x] for x in rest])


class Utf8Stream:
    """Incremental UTF-8 decoding: bytes of a character not yet complete are held between calls.

    The automaton has a state for each number of continuation bytes still
    due, together with the range that the next one must lie in. Bytes that are
    no UTF-8 become U+FFFD.
    """

    def __init__(self):
        self.held = b""

    @staticmethod
    def _begin(byte: int) -> tuple[int, int, int]:
        """State after a first byte: continuation bytes due and the range of the next."""
        if 0xC2 <= byte <= 0xDF:
            return 1, 0x80, 0xBF
        if 0xE0 <= byte <= 0xEF:
            return 2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF
        if 0xF0 <= byte <= 0xF4:
            return 3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF
        return 0, 0, 0

    def _unfinished(self, data: bytes) -> int:
        """Length of the incomplete but so far valid character at the end."""
        for back in range(1, min(3, len(data)) + 1):
            if data[-back] >= 0xC0:
                due, low, high = self._begin(data[-back])
                for byte in data[len(data) - back + 1:]:
                    if not due or not low <= byte <= high:
                        return 0
                    due, low, high = due - 1, 0x80, 0xBF
                return back if due else 0
            if data[-back] < 0x80:
                return 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data) - self._unfinished(data)
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


class TextDecoder:
    """Ids to texts, some thousand tokens at a time."""

    STRIDE = 1 << 14

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {rank: token for token, rank in ranks.items()}

    def decode(self, ids: bytes) -> str:
        stream, out = Utf8Stream(), []
        numbers = np.frombuffer(ids, dtype="<u4")
        for at in range(0, len(numbers), self.STRIDE):
            out.append(stream.feed(b"".join(map(self.tokens.__getitem__, numbers[at: at + self.STRIDE].tolist()))))
        return "".join(out) + stream.finish()


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> TextEncoder:
    return TextEncoder(read_ranks(path), pattern)


@lru_cache(maxsize=2)
def _decoder(path: str) -> TextDecoder:
    return TextDecoder(read_ranks(path))


def encode_text(text: Column, path: str, pattern: str) -> Column:
    """Ids of a whole text as binary, four bytes an id, little-endian; a NULL text is empty.

    The rank file at ``path`` must exist on every executor. The transducer
    lives as long as its Python worker, so its states serve later tasks too.
    """

    @F.arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        encoder = _encoder(path, pattern)
        return pa.array([encoder.encode(t or "") for t in texts.to_pylist()], pa.binary())

    return encode.asNondeterministic()(text)


def decode_ids(ids: Column, path: str) -> Column:
    """The text of ids made by ``encode_text``; NULL ids give an empty text, unknown ids an error."""

    @F.arrow_udf("string")
    def decode(batch: pa.Array) -> pa.Array:
        decoder = _decoder(path)
        return pa.array([decoder.decode(x or b"") for x in batch.to_pylist()], pa.string())

    return decode.asNondeterministic()(ids)


def round_trip(text: Column, path: str, pattern: str) -> Column:
    """Struct of ids, as from ``encode_text``, and the text that ``decode_ids`` makes of them, in one Python worker."""

    @F.arrow_udf("struct<ids:binary,text:string>")
    def both(texts: pa.Array) -> pa.Array:
        encoder, decoder = _encoder(path, pattern), _decoder(path)
        ids = [encoder.encode(t or "") for t in texts.to_pylist()]
        columns = [pa.array(ids, pa.binary()), pa.array([decoder.decode(x) for x in ids], pa.string())]
        return pa.StructArray.from_arrays(columns, ["ids", "text"])

    return both.asNondeterministic()(text)
