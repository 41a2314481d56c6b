"""Exact ids of a ``tokenizers`` file, computed word by word with two bounded caches.

Both vocabularies in use split a text into pre-tokens before merging, and never across ASCII white
space. So the ids of a text are the ids of its words, one after the other, and a word met before
needs no second run of the library. Words that are new go through the library's own
normaliser, pre-tokeniser and model.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable

import numpy as np

# Bytes of the young half of the words' cache, and of that of the parts that words consist of; a
# full half becomes the old one. Up to 250 MB a worker.
CACHE_BYTES = 100_000_000
PART_BYTES = 20_000_000
# What an entry takes besides its key and ids, and the longest key that is kept.
ENTRY_BYTES = 160
KEY_BYTES = 96

# Words of these characters are the same in every Unicode normal form in use, and their letters
# and digits are known without tables; all others go through the library.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(f" ?[!-~{_LETTERS}]+")
_WORD_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+")
_BYTE_PARTS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^ {_LETTERS}0-9]+"
)


def byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write each byte as a letter: itself if visible, else 256 and up."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return {b: chr(b if b in visible else next(hidden)) for b in range(256)}


def _spelled() -> dict[int, str]:
    """Plain characters in the letters of their bytes."""
    letters = byte_letters()
    return {c: "".join(letters[b] for b in chr(c).encode()) for c in (*range(128), *range(192, 256))}


_BYTE_LETTERS = _spelled()


# White space that is neither one blank nor one line break between two words.
_ODD_SPACE = re.compile(r"\s\s|[^\S \n]|^\s|\s$")
_ODD_PAIRS = (b"  ", b" \n", b"\n ", b"\n\n")
_ODD_BYTES = b"\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
# How white space outside of ASCII starts in UTF-8; other characters may start so, too.
_WIDE_SPACE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a", b"\xe2\x80", b"\xe2\x81", b"\xe3\x80")
# Places where a byte-level pattern certainly starts a new pre-token.
_SAFE_CUT = re.compile(r"(?<=\S)(?= \S)")

_encoders: dict[tuple[str, bool], Encoder] = {}


def has_odd_space(text: str, data: bytes) -> bool:
    if data[:1] in b" \n" or data[-1:] in b" \n" or any(p in data for p in _ODD_PAIRS):
        return True
    if len(data.translate(None, _ODD_BYTES)) < len(data):
        return True
    return any(p in data for p in _WIDE_SPACE) and bool(_ODD_SPACE.search(text))


class Cache:
    """Ids by piece of text; a young half that holds ``most`` bytes becomes the old one.

    Long pieces are not kept: they rarely come back.
    """

    def __init__(self, make: Callable[[str], bytes], lead: str = "", most: int = CACHE_BYTES):
        self.make, self.lead, self.most = make, lead, most
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.held = 0

    def _new(self, piece: bytes) -> bytes:
        found = self.old.get(piece) or self.make(self.lead + piece.decode())
        if len(piece) <= KEY_BYTES:
            self.held += len(piece) + len(found) + ENTRY_BYTES
            if self.held > self.most:
                self.old, self.young = self.young, {}
                self.held = len(piece) + len(found) + ENTRY_BYTES
            self.young[piece] = found
        return found

    def one(self, piece: bytes) -> bytes:
        return self.young.get(piece) or self._new(piece)

    def all(self, pieces: list[bytes]) -> list[bytes]:
        found = list(map(self.young.get, pieces))
        if not all(found):
            found = [f or self._new(p) for f, p in zip(found, pieces, strict=True)]
        return found


class Encoder:
    """``ids(text)`` equals ``encode(text, add_special_tokens=False).ids`` as unsigned ids.

    As in the library, strings of special tokens in a text get their ids, unless ``plain``: then
    they are ordinary text.
    """

    def __init__(self, path: str, plain: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.specials = [] if plain else [t.content.lower() for t in added]
        # White space counts for a byte-level vocabulary and not for one with word ends.
        self.keeps_space = self.tokenizer.normalizer is None
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.merge = self.tokenizer.model.tokenize
        self.parts = Cache(self._merged, most=PART_BYTES)
        # Words after a blank have it in their first id; the rest start a line or text.
        self.words = Cache(self._split_word, " " if self.keeps_space else "")
        self.first_words = Cache(self._split_word)

    def _merged(self, part: str) -> bytes:
        return array(self.code, [t.id for t in self.merge(part)]).tobytes()

    def _split_word(self, word: str) -> bytes:
        # Most words are letters, some with a mark behind them: two parts at most.
        body, tail = (word[:-1], word[-1]) if word[-1] in ",." else (word, "")
        letters = body[1:] if body[:1] == " " else body
        if letters.isalpha() and letters.isascii():
            spaced = len(letters) < len(body)
            plain = letters if self.keeps_space else letters.lower()
            known = self.words if spaced or not self.keeps_space else self.first_words
            # The same word may be known without its mark or capital.
            found = known.young.get(plain.encode()) or self._merged("Ġ" + plain if spaced else plain)
            return found + self._part(tail) if tail else found
        if _PLAIN.fullmatch(word):
            parts = (
                _BYTE_PARTS.findall(word)
                if self.keeps_space
                else _WORD_PARTS.findall(word.lower())
            )
            if not word.isascii():
                parts = [p.translate(_BYTE_LETTERS) for p in parts]
            elif self.keeps_space:
                parts = [p.replace(" ", "Ġ") for p in parts]
        else:
            plain = word if self.keeps_space else self.tokenizer.normalizer.normalize_str(word)
            parts = [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(plain)]
        return b"".join(map(self._part, parts))

    def _part(self, part: str) -> bytes:
        return self.parts.one(part.encode())

    def ids(self, text: str) -> np.ndarray:
        if self.specials and "<" in text:
            small = text.lower()
            if any(s in small for s in self.specials):
                # Rare: the library cuts at them, before or after its normaliser.
                return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)
        data = text.encode()
        if not self.keeps_space:
            found = self.words.all(data.split())
        elif not data:
            found = []
        elif has_odd_space(text, data):
            found = self.first_words.all([p.encode() for p in _SAFE_CUT.split(text)])
        else:
            (line_break,) = self.first_words.all([b"\n"])
            found = []
            for line in data.split(b"\n"):
                first, *rest = line.split(b" ")
                found += self.first_words.all([first])
                found += self.words.all(rest)
                found.append(line_break)
            found.pop()
        return np.frombuffer(b"".join(found), self.dtype)


def encoder(path: str, plain: bool = False) -> Encoder:
    """The encoder of a file, one for each Python worker."""
    if (path, plain) not in _encoders:
        _encoders[path, plain] = Encoder(path, plain)
    return _encoders[path, plain]
