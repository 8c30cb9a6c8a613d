"""Token ids of whole texts under a word-end BPE of the tokenizers library, word by word.

The tokenizer drops white space and never lets a piece cross it, so a text's ids are those of its
words in a row. Words repeat, so a worker keeps the ids of words it has met. Words of printable
ASCII and Latin-1 letters are cut into pieces here (their lower case and normal form are plain
per-character maps) and each distinct piece goes through the library's model; any other word goes
through the library's whole chain. A piece is a word too, with the same ids, so both are kept once. Strings that look like special tokens are ordinary text.
"""

from __future__ import annotations

import functools
import os
import re
from array import array
from collections.abc import Iterable

import numpy as np

END_ID = 2  # closes every document
KEEP = 1_200_000  # words and pieces together that a worker remembers: some 200 bytes each

PLAIN = re.compile(r"[\x21-\x7E¡-ÿ]+").fullmatch
#: Latin-1 in lower case, line feeds as spaces.
LOWER = bytes(range(256)).decode("latin-1").lower().replace("\n", " ").encode("latin-1")
SIGNS = frozenset(bytes([b]) for b in range(0x21, 0x7F) if not chr(b).isalnum())
#: Fixed value: the pattern by which the tokenizer file cuts words, for lower-case Latin-1: runs of
#: letters, single digits, runs of anything else.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^a-zªµºß-öø-ÿ0-9²³¹¼-¾]+").findall


def _byte_letters() -> dict[int, str]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds(dict):
    """word -> its ids as unsigned 16-bit integers (little-endian, as on all machines Spark runs on).

    Words of Latin-1 texts are lower-case bytes. Words are kept in two halves: when the younger one is
    full it becomes the older one, from which words that are met again go back to the younger.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        super().__init__({"": b"", b"": b""})
        self.older: dict[bytes | str, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        if self.tokenizer.get_vocab_size() > 65536:
            raise ValueError("ids do not fit 16 bits")
        self.model = self.tokenizer.model
        self.letters = _byte_letters()

    def _piece(self, piece: bytes) -> bytes:
        if piece.isascii():
            mapped = piece.decode()
        else:
            mapped = piece.decode("latin-1").encode().decode("latin-1").translate(self.letters)
        return array("H", [token.id for token in self.model.tokenize(mapped)]).tobytes()

    def _cut(self, word: bytes | str) -> bytes:
        if isinstance(word, bytes):
            if word[-1:] in SIGNS and word[:-1].isalpha():  # as most other words are
                return self[word[:-1]] + self[word[-1:]]
            text = word.decode("latin-1")
            if PLAIN(text):
                pieces = PIECES(text)
                return self._piece(word) if len(pieces) == 1 else b"".join([self[p.encode("latin-1")] for p in pieces])
        else:
            if PLAIN(word):
                return self[word.lower().encode("latin-1")]
            text = word
        return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: bytes | str) -> bytes:
        found = self.older.get(word)
        if found is None:
            if isinstance(word, bytes) and word.isalpha():  # the most frequent case, without further calls
                found = array("H", [token.id for token in self.model.tokenize(word.decode())]).tobytes()
            else:
                found = self._cut(word)
        self[word] = found
        return found

    def of(self, text: str) -> bytes:
        """The ids of a whole text with the end id."""
        if len(self) > KEEP // 2:
            self.older = {}  # goes before the younger half is copied
            self.older = dict(self)
            self.clear()
            self[""] = self[b""] = b""
        try:
            words = text.encode("latin-1").translate(LOWER).split(b" ")
        except UnicodeEncodeError:
            words = text.replace("\n", " ").split(" ")
        parts = list(map(self.__getitem__, words))
        parts.append(END_ID.to_bytes(2, "little"))
        return b"".join(parts)


@functools.lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One per worker."""
    return WordIds(path)


def as_array(ids: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(ids), "<u2")
