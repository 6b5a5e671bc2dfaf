"""Token ids of a public tokenizer, word by word with a bounded memory.

The tokenizer drops white space and never joins characters across it, so a text's ids are
those of its parts between spaces and line ends, one after another. Words repeat, so their ids are kept.
"""

from __future__ import annotations

import re
import unicodedata
from array import array

import numpy as np

#: Bytes that words and pieces with their ids may take per Python worker; then all are dropped.
KEPT_BYTES = 160 << 20
#: Longer words and pieces are worked out each time: they hardly ever come again.
KEPT_LENGTH = 40
#: What an entry takes besides its two strings' contents: both objects and the place in the table.
_ENTRY = 150
#: Marks that are a piece of their own behind a word of letters.
_MARKS = frozenset(".,;:!?")

_LATIN = re.compile("[\x00-ɏ]*")


class WordIds(dict):
    """word -> its ids as little-endian 16-bit bytes, worked out when first asked for.

    What is kept is bounded by bytes, `kept`, not by entries: texts without spaces are one
    long word each.
    """

    def __init__(self, path: str, kept: int = KEPT_BYTES):
        import regex
        from tokenizers import Tokenizer

        super().__init__()
        self._tokenizer = Tokenizer.from_file(path)
        if self._tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit into 16 bits")
        self._model, self._kept = self._tokenizer.model, kept
        self._pieces: dict[str, bytes] = {}
        self.held = 0
        # fixed value: the tokenizer file's own split pattern
        self._split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
        self._bytes = _byte_letters()

    def __missing__(self, word: str) -> bytes:
        if "<|" in word or not _LATIN.fullmatch(word):
            found = array("H", self._tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        else:
            plain = word.lower() if word.isascii() else unicodedata.normalize("NFC", word).lower()
            known = self._pieces
            if plain.isalpha():
                found = known.get(plain) or self._piece(plain)
            elif plain[-1:] in _MARKS and plain[:-1].isalpha():
                head, mark = plain[:-1], plain[-1]
                found = (known.get(head) or self._piece(head)) + (known.get(mark) or self._piece(mark))
            else:
                found = b"".join([known.get(p) or self._piece(p) for p in self._split(plain)])
        if len(word) <= KEPT_LENGTH:
            self._keep(self, word, found)
        return found

    def _keep(self, store: dict[str, bytes], key: str, found: bytes) -> None:
        size = 4 * len(key) + len(found) + _ENTRY
        if self.held + size > self._kept:
            self.clear(), self._pieces.clear()
            self.held = 0
        store[key] = found
        self.held += size

    def _piece(self, piece: str) -> bytes:
        letters = piece.encode().decode("latin-1").translate(self._bytes)
        found = array("H", [t.id for t in self._model.tokenize(letters)]).tobytes()
        if len(piece) <= KEPT_LENGTH:
            self._keep(self._pieces, piece, found)
        return found

    def of_text(self, text: str | None) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, (text or "").replace("\n", " ").split(" "))), dtype="<u2")


def _byte_letters() -> dict[int, str]:
    """byte -> the printable letter that stands for it in byte-level vocabularies.

    Printable bytes stand for themselves, the others count up from 256.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(256 + i) for i, b in enumerate(others)}
