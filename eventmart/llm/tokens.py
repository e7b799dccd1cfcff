"""Token ids of whole texts, fast: the tokenizer encodes each distinct piece of text once.

Neither tokenizer kind here lets a token reach across the cuts made below, so a text's ids are the ids
of its pieces laid end to end.  A task keeps the pieces it has met, up to a bound.

* ``words`` (lower case, white space dropped): pieces are the lower-cased runs between white space.
* ``bytes`` (white space kept): a piece starts at a space after which no white space follows, so that
  each run of white space lies in one piece, as the tokenizer's own pattern needs it.

A new piece of letters goes straight to the tokenizer's model, one of letters before a point or comma in
two parts, and any other through the whole tokenizer.  Texts for which cuts might differ (rare white space or
separators, text that is not in Unicode normal form, spaces before other white space) are encoded whole, and so are
those that hold the string of an added token, which is that token's id; with ``literal`` such a special string is
ordinary text.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa

#: Pieces met lately that one task keeps; as many older ones are kept beside them, about 240 MB in all.
MAX_PIECES = 600_000
#: Signs that may end a piece of letters and are tokens apart from it: ASCII signs but the apostrophe.
_ENDS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: White space other than single line breaks between other signs.
_OTHER_SPACE = re.compile(r"[\t\x0B-\r ]|\n\n|^\n|\n$")
_ODD_WORDS = "\x1c\x1d\x1e\x1f"
_SIGMA = "\u03a3"
_WIDE_SPACES = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACE_PAIRS = ("  ", " \n", " \t", " \r", " \x0b", " \x0c")


def texts_of(column: pa.Array, rows: int = 200) -> Iterator[str | None]:
    """A string column's values, a few at a time as Python strings."""
    pa.default_memory_pool().release_unused()
    for i in range(0, len(column), rows):
        yield from column.slice(i, rows).to_pylist()


def _byte_signs() -> dict[int, str]:
    """The tokenizers' printable sign for each byte: itself if printable, else the next one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Pieces(dict):
    """Ids of each piece met so far, as little-endian unsigned 32-bit integers; a new one is encoded on the way.

    ``lead`` is the sign before every piece; ``bare`` has pieces that follow a line break."""

    def __init__(self, tokenizer, lead: str, bare: Pieces | None = None):
        super().__init__()
        self.tokenizer, self.model, self.lead = tokenizer, tokenizer.model, lead
        self.bare = self if bare is None else bare
        self.older: dict[str, bytes] = {}
        self.signs = _byte_signs()
        self.start = "".join(self.signs[b] for b in lead.encode())

    def age(self) -> None:
        """Forget the older pieces; those met since become the older ones."""
        self.older = dict(self)
        self.clear()

    def __missing__(self, piece: str) -> bytes:
        out = self.older.get(piece)
        if out is None:
            if piece.isascii():
                signs = piece if piece.isalpha() else None
            else:  # below U+0530 letters are letters in every version of Unicode
                signs = piece.encode().decode("latin-1").translate(self.signs) if piece.isalpha() and max(piece) < "\u0530" else None
            if signs is not None:
                out = array("I", [t.id for t in self.model.tokenize(self.start + signs)]).tobytes()
            elif (core := piece.rstrip(_ENDS)) != piece and core.isalpha():
                out = self[core] + self.end(piece[len(core):])
            elif "\n" in piece and not _OTHER_SPACE.search(piece):
                # single line breaks between words; the whole is hardly met again, so it is not kept
                first, *rest = piece.split("\n")
                return self[first] + b"".join([self.end("\n") + self.bare[x] for x in rest])
            else:
                out = array("I", self.tokenizer.encode(self.lead + piece, add_special_tokens=False).ids).tobytes()
        self[piece] = out
        return out

    @cache  # noqa: B019  one object a Python worker, and few endings
    def end(self, signs: str) -> bytes:
        return array("I", self.tokenizer.encode(signs, add_special_tokens=False).ids).tobytes()

    __hash__ = object.__hash__


class Encoder:
    def __init__(self, path: str, kind: str, literal: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = literal
        added = [t for t in self.tokenizer.get_added_tokens_decoder().values() if not (literal and t.special)]
        # a piece is lower-cased before it is encoded, and some tokens are looked for in the normalized text
        self.added = re.compile("|".join(re.escape(t.content) for t in added), re.IGNORECASE) if added else None
        self.words = kind == "words"
        self.bare = Pieces(self.tokenizer, "")
        self.known = self.bare if self.words else Pieces(self.tokenizer, " ", self.bare)
        self.stores = (self.bare,) if self.words else (self.bare, self.known)

    def forget(self) -> None:
        """Let go of all pieces, as a task that ends should: workers live on for other work."""
        for pieces in self.stores:
            pieces.clear()
            pieces.older = {}

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _pieces(self, text: str) -> list[str] | None:
        """The pieces of a text; None for a text that has to be encoded whole."""
        if self.added and self.added.search(text):
            return None
        plain = text.isascii()
        if not self.words:
            odd = any(x in text for x in _SPACE_PAIRS) or not plain and any(x in text for x in _WIDE_SPACES)
            return None if odd else text.split(" ")
        if any(x in text for x in _ODD_WORDS) or not plain and _SIGMA in text:
            return None
        low = text.lower()
        if not plain and not (unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", low)):
            return None
        return low.split()

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; a null text has none."""
        get = self.known.__getitem__
        for text in texts:
            text = text or ""
            if sum(map(len, self.stores)) > MAX_PIECES:
                for store in self.stores:
                    store.age()
            pieces = self._pieces(text)
            if pieces is None:
                yield self._whole(text)
            elif self.words:
                yield b"".join(map(get, pieces))
            else:                                        # the first piece follows no space
                yield (self.bare[pieces[0]] if pieces[0] else b"") + b"".join(map(get, pieces[1:]))


@cache
def encoder(path: str, kind: str, literal: bool = False) -> Encoder:
    """One encoder a Python worker and setting."""
    return Encoder(path, kind, literal)
