"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a byte string the BPE encoding ends with one certain token, and the encoding of
a string follows from the last tokens of its prefixes. A token ``t`` that ends at byte ``i`` is the last
one exactly if it may stand behind the last token of the prefix before it, that is if merging the
two tokens' bytes gives the two tokens again (``Vocabulary.adjacent``). ``PrefixTable`` stores the last
token of each prefix, so appending bytes extends the table without touching it, and an edit
re-encodes from the edit on until the table meets old entries again.

Texts are cut by a pattern first and every match is encoded separately; the ids of the matches met
last are cached. The caches are bounded in bytes, belong to a task and are dropped with it, and change no
result; a worker keeps only the vocabulary, as flat tables.

Defined results: null and empty texts have no tokens; texts of any length are encoded whole; bytes
that the pattern leaves out are not encoded; special tokens are ordinary text. Repeated rows are
encoded alike. Other columns are ignored.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.words import release

CACHE_BYTES = 96 << 20  # of cached pieces, in two generations, for the time of a task
PIECE_BYTES = 260  # what a cached piece takes beside its text and ids
KNOWN_PAIRS = 1 << 17  # some 15 MB
MOVES = 1 << 17  # remembered falls of the automaton, some 15 MB
PAIR = 1 << 32
ROWS = 1000  # encoded at a time
_NONE: dict[int, bool] = {}


class Vocabulary:
    """Token bytes by rank, the merge that makes each token, and which tokens may be neighbours."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {r: t for t, r in ranks.items()}
        self.longest = max(map(len, ranks), default=0)
        size = max(self.bytes, default=-1) + 1
        self.lengths = [len(self.bytes.get(r, b"")) for r in range(size)] + [0]  # the last one is of token -1
        self.codes = [r.to_bytes(4, "little") for r in range(size)]
        self._build_automaton(size)
        # the two tokens that a token is merged from, -1 for tokens that no merge makes
        self.left, self.right = [-1] * size, [-1] * size
        self.merged: dict[int, int] = {}  # PAIR * left + right: the merged token
        self.forget()
        for rank in sorted(self.bytes):
            token = self.bytes[rank]
            # the last merge of a token joins two lower tokens that stay apart without it
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut], rank), ranks.get(token[cut:], rank)
                if left < rank and right < rank and self._stay_apart(left, right):
                    self.left[rank], self.right[rank] = left, right
                    self.merged[PAIR * left + right] = rank
                    break

    def _build_automaton(self, size: int) -> None:
        """States are the prefixes of tokens; after any bytes the state is their longest such suffix.

        ``moves`` leads from 256 * state + byte to a state, ``longest_at`` holds the longest token that ends a
        state, and ``shorter`` the next shorter one that ends a token. Moves that fall back to a shorter suffix
        are found over ``fall`` and remembered up to a bound.
        """
        self.moves: dict[int, int] = {}
        token_at, by_depth = [-1], [[] for _ in range(self.longest + 1)]
        for token, rank in self.ranks.items():
            state = 0
            for depth, byte in enumerate(token):
                key, fresh = state << 8 | byte, len(token_at)
                state = self.moves.setdefault(key, fresh)
                if state == fresh:
                    token_at.append(-1)
                    by_depth[depth].append(key)
            token_at[state] = rank
        self.fall, self.longest_at, self.shorter = [0] * len(token_at), list(token_at), [-1] * size
        moves = dict(self.moves)
        for keys in by_depth:
            for key in keys:
                state, above = moves[key], key >> 8
                back = self._fallback(self.fall[above], key & 255, moves) if above else 0
                self.fall[state] = back
                if token_at[state] >= 0:
                    self.shorter[token_at[state]] = self.longest_at[back]
                else:
                    self.longest_at[state] = self.longest_at[back]
        self.most_moves = len(self.moves) + MOVES

    def _fallback(self, state: int, byte: int, moves: dict[int, int]) -> int:
        while state and (state << 8 | byte) not in moves:
            state = self.fall[state]
        return moves.get(state << 8 | byte, 0)

    def _move(self, state: int, byte: int) -> int:
        found = self.moves.get(state << 8 | byte)
        if found is None:
            found = self._fallback(state, byte, self.moves)
            if len(self.moves) < self.most_moves:
                self.moves[state << 8 | byte] = found
        return found

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """From a file of lines with a base64 token and its rank."""
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})

    def adjacent(self, left: int, right: int) -> bool:
        """Whether the encoding of the two tokens' joined bytes is just these two."""
        row = self.known[left]
        if right not in row:
            if self.pairs >= KNOWN_PAIRS:
                self.forget()
            if self.known[left] is _NONE:
                self.known[left] = {}
            row, self.pairs = self.known[left], self.pairs + 1
            row[right] = self._stay_apart(left, right)
        return row[right]

    def forget(self) -> None:
        """Drop what is known of pairs: left: right: may they be neighbours."""
        if not hasattr(self, "known"):
            self.known = [_NONE] * len(self.left)
        self.known[:] = [_NONE] * len(self.left)
        self.pairs = 0

    def _stay_apart(self, left: int, right: int) -> bool:
        """Undo merges on both sides of the seam, latest first; a merge across it must lose.

        ``bound`` tells which merge was undone last: a merge across the seam of lower rank would
        have come before it. Of equal ranks the merge further left comes first, so the right side's
        merge loses to an equal one across the seam and the left side's wins.
        """
        merged, lefts, rights = self.merged.get, self.left, self.right
        bound = PAIR
        while True:
            across = merged(PAIR * left + right)
            if across is not None and across < bound:
                return False
            if left > right:
                if rights[left] >= 0:
                    bound, left = left, rights[left]
                elif lefts[right] >= 0:
                    bound, right = right + 1, lefts[right]
                else:
                    return True
            elif lefts[right] >= 0:
                bound, right = right + 1, lefts[right]
            elif rights[left] >= 0:
                bound, left = left, rights[left]
            else:
                return True

    def last_tokens(self, data: bytes, last: list[int]) -> None:
        """Extend ``last``, the last tokens of the first prefixes of ``data``, to all prefixes.

        At each end the tokens that end there are tried from the longest to the shortest; the prefix before
        them is always complete.
        """
        moves, known, lengths, longest_at, shorter = (
            self.moves.get, self.known, self.lengths, self.longest_at, self.shorter
        )
        first, state = len(last), 0
        for byte in data[max(0, first - self.longest):first]:
            state = self._move(state, byte)
        try:
            for end in range(first, len(data)):
                key = state << 8 | data[end]
                state = moves(key)
                if state is None:
                    state = self._move(key >> 8, key & 255)
                token = longest_at[state]
                at = end - lengths[token]
                while at >= 0:
                    before = last[at]
                    fits = known[before].get(token)
                    if fits is None:
                        fits = self.adjacent(before, token)
                    if fits:
                        break
                    token = shorter[token]
                    at = end - lengths[token]
                last.append(token)
        except IndexError:  # no token has length zero, and the prefix that ends here has no last token yet
            raise ValueError("the vocabulary lacks a single byte") from None

    def tokens(self, last: list[int]) -> list[int]:
        """The encoding, read backwards from the last tokens of all prefixes."""
        out, end, lengths = [], len(last), self.lengths
        while end:
            token = last[end - 1]
            out.append(token)
            end -= lengths[token]
        return out[::-1]


class PrefixTable:
    """The last token of every prefix of a byte string, kept exact under appends and edits."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data = vocabulary, b""
        self.last: list[int] = []  # the token at whose end the prefix of i + 1 bytes ends
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.vocabulary.last_tokens(self.data, self.last)

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` in place of bytes start to end; returns how many entries were computed.

        Entries before ``start`` stay. Behind the edit an entry looks at the longest token's bytes
        only, so once that many entries in a row are as before, all later ones are, too.
        """
        old, keep = self.last[end:], self.vocabulary.longest
        tail = self.data[end:]
        self.data = self.data[:start] + new
        del self.last[start:]
        self.vocabulary.last_tokens(self.data, self.last)
        behind = same = 0
        while same < keep and behind < len(tail):
            self.append(tail[behind:behind + 1])
            same = same + 1 if self.last[-1] == old[behind] else 0
            behind += 1
        self.data += tail[behind:]
        self.last += old[behind:]
        return len(new) + behind

    def tokens(self) -> list[int]:
        return self.vocabulary.tokens(self.last)


class Pieces(dict):
    """The ids of pieces as bytes, encoded when first asked for.

    When the young generation has used half of the bytes, it becomes the old one; a piece met again
    there is taken over, so frequent pieces stay.
    """

    def __init__(self, vocabulary: Vocabulary, limit: int = CACHE_BYTES):
        super().__init__()
        self.vocabulary, self.limit = vocabulary, limit // 2
        self.old: dict[str, bytes] = {}
        self.used = 0

    def __missing__(self, piece: str) -> bytes:
        out = self.old.get(piece)
        if out is None:
            out = self._encode(piece.encode())
        if len(piece) <= 256:
            self.used += len(piece) + len(out) + PIECE_BYTES
            if self.used > self.limit:
                self.old = dict(self)
                self.clear()
                self.used = 0
            self[piece] = out
        return out

    def _encode(self, data: bytes) -> bytes:
        whole = self.vocabulary.ranks.get(data)
        if whole is not None:
            return self.vocabulary.codes[whole]
        last: list[int] = []
        self.vocabulary.last_tokens(data, last)
        codes = self.vocabulary.codes
        return b"".join([codes[t] for t in self.vocabulary.tokens(last)])


class Codec:
    """Encoding and decoding of texts with a cache of pieces."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary = vocabulary(path)
        self.split = regex.compile(pattern).findall
        self.pieces = Pieces(self.vocabulary)
        self.table = self.vocabulary.bytes

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per worker process, as it takes a second to read."""
    return Vocabulary.read(path)


def encode(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id column, n_tokens, ids, decoded) of every row; ids as little-endian 32-bit numbers.

    ``path`` names a rank file that every executor can open (it is installed there).
    """

    def over(batches):
        coder = Codec(path, pattern)
        try:
            for batch in batches:
                for first in range(0, len(batch), ROWS):
                    part = batch.slice(first, ROWS)
                    ids = [coder.encode(t) for t in part.column("text").to_pylist()]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("id"), pa.array([len(i) // 4 for i in ids], pa.int64()),
                         pa.array(ids, pa.binary()), pa.array(map(coder.decode, ids), pa.binary())],
                        names=["id", "n_tokens", "ids", "decoded"],
                    )
        finally:
            coder.vocabulary.forget()
            release()

    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(over, f"id {kind}, n_tokens long, ids binary, decoded binary")
    return out.withColumnRenamed("id", id_col)
