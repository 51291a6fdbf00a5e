"""Whole texts to token ids with the tokenizers library, remembering words already seen."""

import array
import re
from functools import lru_cache
from itertools import accumulate

from tokenizers import Tokenizer

REMEMBERED = 700_000  # words, and pieces of words, kept per worker
TOGETHER = 1 << 20    # bytes of text whose unknown words are encoded together


@lru_cache(maxsize=2)
def word_encoder(path: str) -> "WordEncoder":
    """One encoder per worker process, so that its memory serves task after task.

    Its ids are those of the library's plain call, ``Tokenizer.from_file(path)`` and
    ``encode(text, add_special_tokens=False)``: a text that holds an added token gets its id.
    """
    return WordEncoder(path, added_tokens=True)


class WordEncoder:
    """Encodes by words between ASCII white space.

    Only for tokenizers whose normalizer and pre-tokenizer never join or keep such white
    space; then a text's ids are those of its words, one after another. Words are normalised
    and cut by the library's own steps, its model sees each piece of a word once.

    With ``added_tokens`` the file's added tokens are found in texts, as the library does by
    default; else special ones are read like any other text. Words that hold one, also within
    a longer word, are left to the library.
    """

    def __init__(self, path: str, *, added_tokens: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_tokens
        added = [x for x in self.tokenizer.get_added_tokens_decoder().values() if added_tokens or not x.special]
        # one with white space goes beyond words, one found after normalising can look otherwise in a word
        self.whole = any(x.content.encode().split() != [x.content.encode()] for x in added)
        self.each = any(x.normalized for x in added)
        self.added = re.compile("|".join(re.escape(x.content) for x in added) or r"(?!)")
        self.kind = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = array.array(self.kind, [x.id for x in self.tokenizer.model.tokenize(piece)]).tobytes()
            self.pieces[piece] = ids
        return ids

    def _word(self, word: str) -> bytes:
        return array.array(self.kind, self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _learn(self, missing: list[bytes]) -> None:
        """Encode words not yet known, many together."""
        for at in range(0, len(missing), 2000):
            batch = missing[at:at + 2000]
            text = b" ".join(batch).decode()
            if self.each or self.added.search(text) or len(text.split()) != len(batch) or max(map(len, batch)) > 1000:
                batch = self._apart(batch)
                text = b" ".join(batch).decode()
            if batch:
                self._learn_plain(batch, text)

    def _apart(self, batch: list[bytes]) -> list[bytes]:
        """Encode words that hold other white space or an added token, or are long, alone; the others."""
        plain = []
        for word in batch:
            text = word.decode()
            if len(text.split()) == 1 and len(text) < 1000 and not self.each and not self.added.search(text):
                plain.append(word)
            else:
                self.words[word] = self._word(text)
        return plain

    def _learn_plain(self, batch: list[bytes], text: str) -> None:
        normal = self.tokenizer.normalizer.normalize_str(text)
        parts = normal.split(" ")
        if len(parts) != len(batch):
            self.words.update({w: self._word(w.decode()) for w in batch})
            return
        ends = list(accumulate(map(len, parts), lambda end, size: end + size + 1))
        known, found, row, end = self.pieces, [[] for _ in batch], 0, ends[0]
        own = found[0]
        for piece, (_, stop) in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal):
            while stop > end:
                row += 1
                end, own = ends[row], found[row]
            ids = known.get(piece)
            own.append(self._piece(piece) if ids is None else ids)
        self.words.update(zip(batch, map(b"".join, found), strict=True))

    def _groups(self, texts: list[bytes]):
        """The words of some texts at a time, about ``TOGETHER`` bytes."""
        group, size = [], 0
        for text in texts:
            group.append(text.split())
            size += len(text)
            if size >= TOGETHER:
                yield group
                group, size = [], 0
        if group:
            yield group

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian integers of the kind's width.

        Once too many words are known, only those seen since the last time are kept.
        """
        if self.whole:
            return [self._word(text.decode()) for text in texts]
        out = []
        for group in self._groups(texts):
            wanted = set().union(*group)
            missing = wanted.difference(self.words)
            if len(self.words) + len(missing) > REMEMBERED:
                self.older, self.words = self.words, {}
                missing = wanted
            if len(self.pieces) > REMEMBERED:
                self.pieces = {}
            known = missing & self.older.keys()
            self.words.update({w: self.older[w] for w in known})
            self._learn(sorted(missing - known))
            get = self.words.__getitem__
            out += [b"".join(map(get, words)) for words in group]
        return out
