"""Token ids of whole texts with a vocabulary file of the tokenizers library.

``WordTokenizer.ids(text)`` equals ``Tokenizer.encode(text, add_special_tokens=False)``
for a vocabulary whose pre-tokenizer never joins text across white space
(word_bpe_49k.json: white space is dropped). It encodes each distinct word once and keeps
the result in a cache of bounded size, since the library's own time goes to normalising and
splitting the same words again and again.

* A text holding the string of an added token, or a control character that Python
  splits at and the vocabulary doesn't (U+001C to U+001F), is encoded whole.
* White-space delimited pieces of letters of ASCII and Latin-1, digits and ASCII punctuation are
  lower-cased and cut here as the vocabulary's own split pattern does, whole stretches of text at once, so
  `The`, `the,` and `the.` share one encoded unit; any other piece is given to the library as it is.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

VOCABULARY = "word_bpe_49k.json"
END_ID = 2

_PLAIN = "\x21-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff"
_OTHER = re.compile(f"[^\\s{_PLAIN}]")
# Neighbouring pieces that each hold such a character; tried where a piece begins.
_OTHER_PIECE = f"[{_PLAIN}]*+[^\\s{_PLAIN}]\\S*+"
_OTHER_PIECES = re.compile(f"(?<!\\S){_OTHER_PIECE}(?:\\s++{_OTHER_PIECE})*+")
# The split pattern of the vocabulary file (a fixed value), its classes cut down to
# the characters of _PLAIN.
_UNITS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\\sa-z\xdf-\xf6\xf8-\xff0-9]+")
# A letter always ends a unit where punctuation other than ' follows.
_AFTER_LETTER = re.compile("([!-&(-/:-@\\[-`{-~])(?<=[a-z\xdf-\xf6\xf8-\xff].)")
_SPLIT_ONLY_HERE = ("\x1c", "\x1d", "\x1e", "\x1f")


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Place of a vocabulary file on this machine (every executor has the package)."""
    import public_tokenizers

    return public_tokenizers.path(name)


class _Cache(dict):
    """Word -> bytes of its ids, for the first ``limit`` short words met; others are
    encoded each time."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, word: str) -> bytes:
        got = self.make(word)
        if len(self) < self.limit and len(word) <= 64:
            self[word] = got
        return got


class WordTokenizer:
    """Encoder with a cache of at most ``limit`` words (about 200 bytes each)."""

    def __init__(self, name: str = VOCABULARY, limit: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.t = Tokenizer.from_file(vocabulary_path(name))
        self.model = self.t.model
        to_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_level = {c: to_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}
        self.size = self.t.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if self.size <= 65536 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.added = tuple(x.content for x in self.t.get_added_tokens_decoder().values())
        self.words = _Cache(self._word, limit)

    def _encode(self, text: str) -> bytes:
        return np.array(self.t.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _unit(self, unit: str) -> bytes:
        """A normalised and split unit of _PLAIN characters: straight to the BPE model."""
        if not unit.isascii():
            unit = unit.translate(self.byte_level)
        return array(self.code, [x.id for x in self.model.tokenize(unit)]).tobytes()

    def _word(self, word: str) -> bytes:
        """A lower-cased word of _PLAIN characters, mostly one unit, or any other piece."""
        if word.isascii() and word.isalpha():
            return array(self.code, [x.id for x in self.model.tokenize(word)]).tobytes()
        if _OTHER.search(word) is not None:
            return self._encode(word)
        units = _UNITS.findall(word)
        return self._unit(word) if len(units) == 1 else b"".join([self.words[u] for u in units])

    def _plain(self, text: str) -> bytes:
        """Pieces of _PLAIN characters and the white space between them."""
        return b"".join(map(self.words.__getitem__, _AFTER_LETTER.sub(r" \1", text.lower()).split()))

    def raw(self, text: str) -> bytes:
        """The ids as little-endian integers of ``self.dtype``, one after another."""
        if any(c in text for c in _SPLIT_ONLY_HERE) or any(a in text for a in self.added):
            return self._encode(text)
        if _OTHER.search(text) is None:
            return self._plain(text)
        out, at = [], 0
        for other in _OTHER_PIECES.finditer(text):
            out.append(self._plain(text[at:other.start()]))
            out += map(self.words.__getitem__, other[0].split())
            at = other.end()
        return b"".join([*out, self._plain(text[at:])])

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.raw(text), self.dtype)


_MADE: dict[str, WordTokenizer] = {}


def tokenizer(name: str = VOCABULARY) -> WordTokenizer:
    """One encoder per Python worker and vocabulary."""
    if name not in _MADE:
        _MADE[name] = WordTokenizer(name)
    return _MADE[name]
