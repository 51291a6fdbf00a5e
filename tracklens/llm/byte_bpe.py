"""Byte-level BPE in linear time by backtracking (operator 10).

Bytes are mapped to Latin-1 characters, so that the trie of an Aho-Corasick automaton over
the vocabulary finds the longest token at a place. A piece is covered from the left with the
longest token first, going back to shorter ones where two neighbours don't fit. Two tokens
fit if merging their joined bytes by rank yields just these two; that is remembered per
pair. A cover whose neighbours all fit is what merging the whole piece by rank gives, and a
place once found to be no token boundary never is one, so each is tried once.
"""

import array
import base64
import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.llm.storage import encoded, text_batches

REMEMBERED = 250_000  # words, as many older words, pieces, and pairs of tokens, kept per worker
TOGETHER = 1 << 20    # bytes of text whose ids and decoded bytes are held at once, apart from a longer text
NEVER = 1 << 60  # above any rank
_GAP = re.compile(r"(?<=\S) (?=\S)")  # re takes all for space that regex does, and quicker


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file: base64 and number per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge neighbours of the lowest rank, leftmost first, until none can be."""
    parts = [piece[k:k + 1] for k in range(len(piece))]
    costs = [ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
    while costs and (low := min(costs)) < NEVER:
        at = costs.index(low)
        parts[at] += parts.pop(at + 1)
        del costs[at]
        for k in range(max(at - 1, 0), min(at + 1, len(costs))):
            costs[k] = ranks.get(parts[k] + parts[k + 1], NEVER)
    return [ranks[x] for x in parts]


class Encoder:
    """Encodes and decodes with one vocabulary; keeps what it has seen within bounds."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.token = {rank: token for token, rank in ranks.items()}
        self.size = {rank: len(token) for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.shorter = {rank: next((ranks[token[:k]] for k in range(len(token) - 1, 0, -1) if token[:k] in ranks), -1)
                        for token, rank in ranks.items()}  # the longest token that this one starts with
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.fits: dict[int, bool] = {}  # by both ranks in one number, which takes less room than a pair

    def _fit(self, left: int, right: int) -> bool:
        if len(self.fits) >= REMEMBERED:
            self.fits.clear()
        fit = merged(self.token[left] + self.token[right], self.ranks) == [left, right]
        self.fits[left << 32 | right] = fit
        return fit

    def _first(self, letters: str, at: int) -> int:
        """The longest token at a place, -1 without any."""
        part = letters[at:at + self.longest]
        size, get = self.automaton.longest_prefix(part), self.automaton.get
        rank = -1
        while size and rank < 0:  # a path of the trie may end inside a token
            rank = get(part[:size], -1)
            size -= 1
        return rank

    def piece(self, piece: bytes) -> list[int]:
        """Ids of one piece of text."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        letters, size, shorter, known = piece.decode("latin-1"), self.size, self.shorter, self.fits
        closed = bytearray(len(piece) + 1)  # places found to be no token boundary
        ids, at, rank = array.array("I"), 0, self._first(letters, 0)
        while True:
            while rank >= 0:
                after = at + size[rank]
                if not closed[after]:
                    fit = not ids or known.get(ids[-1] << 32 | rank)
                    if fit is None:
                        fit = self._fit(ids[-1], rank)
                    if fit:
                        break
                rank = shorter[rank]
            if rank >= 0:
                ids.append(rank)
                at = after
                if at == len(piece):
                    return ids.tolist()
                rank = self._first(letters, at)
            elif ids:
                closed[at] = 1
                rank = ids.pop()
                at -= size[rank]
                rank = shorter[rank]
            else:
                return merged(piece, self.ranks)

    def _word(self, word: str) -> bytes:
        """Ids of a word with the space before it: pieces of the pattern, one by one."""
        out = []
        for piece in self.pattern.findall(word):
            ids = self.pieces.get(piece)
            if ids is None:
                ids = array.array("I", self.piece(piece.encode())).tobytes()
                if len(piece) < 64:
                    if len(self.pieces) >= REMEMBERED:
                        self.pieces.clear()
                    self.pieces[piece] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian uint32.

        A single space between two other characters always starts a piece, so a text is cut
        there, and the ids of such words are remembered. Once too many are known, only
        those met again before as many others are known stay.
        """
        if len(self.words) > REMEMBERED:
            self.older, self.words = self.words, {}
        words, older, out = self.words, self.older, []
        first, *rest = _GAP.split(text)
        out.append(self._word(first))
        for word in rest:
            ids = words.get(word)
            if ids is None:
                ids = older.get(word)
                if ids is None:
                    ids = self._word(" " + word)
                if len(word) < 64:
                    words[word] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, memoryview(ids).cast("I")))


@lru_cache(maxsize=2)
def byte_encoder(path: str, pattern: str) -> Encoder:
    """One encoder per worker process, so that its memory serves task after task."""
    return Encoder(read_ranks(path), pattern)


def _batches(batches, encoder: Encoder, decode: bool):
    """Batches of (doc_id, ids[, decoded]), each of about ``TOGETHER`` bytes of text."""
    for batch in text_batches(batches, most=TOGETHER):
        ids = [encoder.encode(x.decode()) for x in encoded(batch)]
        columns = [batch.column("doc_id"), pa.array(ids, pa.binary())]
        if decode:
            columns.append(pa.array([encoder.decode(x) for x in ids], pa.binary()))
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][:len(columns)])


def tokens(docs: DataFrame, *, path: str, pattern: str, decode: bool = False) -> DataFrame:
    """(doc_id, ids[, decoded]) for each row of ``docs`` (doc_id, text).

    ``ids``: binary, little-endian uint32, as merging each match of ``pattern`` by the ranks
    of the vocabulary file ``path`` gives them, without special tokens. ``decoded``: bytes of
    the ids. A null text counts as empty and has no ids. A very long text is encoded whole, in
    memory of a few bytes per byte of its longest word and its ids; repeated rows each have a
    row. Other columns play no part.
    """
    def run(batches):
        yield from _batches(batches, byte_encoder(path, pattern), decode)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, ids binary" + ", decoded binary" * decode)
