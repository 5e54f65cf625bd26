"""Token ids by a public BPE file, with a bounded cache of the pieces between spaces.

Both supported pre-tokenisers never join a character that isn't white space with the space after it, so a text can be cut
before each such space and each distinct piece encoded once. Pieces that are plainly one word, perhaps with punctuation
after it, go straight to the library's BPE model, all others through its whole pipeline. A text with the string of an added
token, such as <|endoftext|>, isn't cut: the library takes it whole, with the token's own id. The ids equal those of the
whole text by the library's default encoding every way.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Iterable

_CUT = re.compile(r"(?<=\S)(?= )")
_AMBIGUOUS = re.compile(r"\s\s")
_PLAIN = re.compile(r"( ?)([^\W\d_]*)([!-&(-/:-@\[-`{-~]*)")


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes for the code points from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PieceEncoder:
    """``encode_many(texts)`` gives each text's ids as little-endian unsigned 32-bit bytes; no special tokens are added to those
    in the text.

    ``spaces_matter`` is False for vocabularies whose normaliser lower-cases and drops white space.
    """

    def __init__(self, path: str, spaces_matter: bool, most: int = 250_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.spaces_matter, self.most = spaces_matter, most
        self.cache: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        if not self.spaces_matter:
            return text.replace("\n", " ").split(" ")
        if "\x00" in text or _AMBIGUOUS.search(text):
            return _CUT.split(text)
        return text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")

    def _part(self, word: str) -> bytes:
        """Ids of one pre-token."""
        if (ids := self.parts.get(word)) is None:
            mapped = word.replace(" ", "Ġ") if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
            ids = self.parts[word] = array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()
        return ids

    def _piece(self, piece: str) -> bytes:
        m = _PLAIN.fullmatch(piece)
        if m and "<|" not in piece and (piece.isascii() or m[2].isalpha() or not m[2]):
            space, word, marks = m.groups()
            if not word:
                word, marks = (space if self.spaces_matter else "") + marks, ""
                return self._part(word) if word else b""
            if self.spaces_matter:
                return self._part(space + word) + (self._part(marks) if marks else b"")
            if word.isascii() or ("Σ" not in word and "İ" not in word and unicodedata.is_normalized("NFC", word)):
                return self._part(word.lower()) + (self._part(marks) if marks else b"")
        return self._whole(piece)

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode_many(self, texts: Iterable[str]) -> list[bytes]:
        cache, out = self.cache, []
        if len(cache) > self.most:
            cache.clear()
            self.parts.clear()
        get = cache.__getitem__
        for text in texts:
            if any(t in text for t in self.added):
                out.append(self._whole(text))
                continue
            split = self.pieces(text)
            for p in set(split).difference(cache):
                cache[p] = self._piece(p)
            out.append(b"".join(map(get, split)))
        return out


_ENCODERS: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, spaces_matter: bool, most: int = 200_000) -> PieceEncoder:
    """One encoder for each Python worker, with a cache of about ``most`` pieces."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    key = (path, spaces_matter)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(path, spaces_matter, most)
    return _ENCODERS[key]
