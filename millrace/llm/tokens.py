"""Token ids of whole texts by the tokenizers library, with repeated text parts encoded once.

The pre-tokenising pattern of byte-level vocabularies always begins a new match at a blank
that follows a non-blank, and at the last blank of a run of white space. So a text whose
white space has no blank between other white space can be cut before every blank, and each
part is encoded alone. Parts recur (words do), so a bounded table of parts keeps their ids.
Any other text, and one that holds the string of an added token, is encoded whole. Both give
the library's ids.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from public_tokenizers import PATTERN

STRETCH = 2_000_000

# A blank inside or at the end of a longer run of white space: not a place to cut.
_INNER_BLANK = re.compile(r"\s \s|\s \Z")
# ASCII signs that are neither letters, digits nor white space: a run of them is one piece.
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_PIECES = regex.compile(PATTERN)
# Letters of Latin scripts, all of them below U+0250: a word of these is one piece.
_WORD = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+$"


def cuttable(text: str) -> bool:
    return _INNER_BLANK.search(text) is None


def byte_letters() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte: itself where
    the byte is a printable Latin-1 character, else the next free one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class PartEncoder:
    """Ids of texts as little-endian bytes of `dtype`; keeps at most 2 * `keep` parts.

    Two generations: when the younger table is full it becomes the older one, and parts
    found there move back to the younger. Nothing depends on what is kept but speed. With
    `special` the strings of special tokens in a text are these tokens, as the library has it by
    default; else they are ordinary text.
    """

    def __init__(self, tokenizer_path: str, dtype: str = "<u2", keep: int = 400_000, special: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.encode_special_tokens = not special
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if special or not t.special]
        self.model = self.tokenizer.model
        if hasattr(self.model, "_resize_cache"):
            self.model._resize_cache(0)  # parts come once here, the library's own table only costs time
        self.dtype = dtype
        self.code = {2: "H", 4: "I"}[np.dtype(dtype).itemsize]
        if sys.byteorder != "little":
            raise RuntimeError("ids are written as the machine has them: little-endian only")
        if np.dtype(dtype).itemsize < 4 and self.tokenizer.get_vocab_size() > 1 << (8 * np.dtype(dtype).itemsize):
            raise ValueError(f"the vocabulary does not fit {dtype}")
        self.keep = keep
        self.letters = byte_letters()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _merged(self, piece: str) -> list[int]:
        """Ids of one piece of the pattern by the library's merges."""
        return [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))]

    def forget(self) -> None:
        """Drop the tables: idle Python workers of an executor should hold little."""
        self.young, self.old = {}, {}

    def _known(self, parts: list[str]) -> list[bytes]:
        """Ids of a blank and each of different parts, from the tables or anew."""
        if len(self.young) > self.keep:
            self.old, self.young = self.young, {}
        young, old, tokenize = self.young, self.old.get, self.model.tokenize
        found, fresh, ids, ends = list(map(young.get, parts)), [], [], []
        for i in [i for i, held in enumerate(found) if held is None]:
            part = parts[i]
            if (held := old(part)) is not None:
                young[part] = found[i] = held
                continue
            if part.isascii() and part.isalpha():
                ids += [t.id for t in tokenize("\u0120" + part)]
            elif part.isalpha() and max(part) < "\u0250":
                ids += [t.id for t in tokenize("\u0120" + part.encode().decode("latin-1").translate(self.letters))]
            else:
                for piece in _PIECES.findall(" " + part):
                    ids += self._merged(piece)
            fresh.append(i)
            ends.append(len(ids))
        raw, at, width = array(self.code, ids).tobytes(), 0, np.dtype(self.dtype).itemsize
        for i, end in zip(fresh, ends, strict=True):
            young[parts[i]] = found[i] = raw[at : end * width]
            at = end * width
        return found

    def _cut(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that can be cut. Their different parts are split into a word and the signs
        behind it, which are two pieces; a part of another form is a word as it is. Different words
        are looked up, and the ids laid out in the order of the parts. The first part of a text
        has no blank before it and goes by itself."""
        split = split_parts(texts)
        words, signs = split_signs(split.parts)
        words, signs = words.dictionary_encode(), signs.dictionary_encode()
        units = self._known(words.dictionary.to_pylist())
        units += [self._signs(x) for x in signs.dictionary.to_pylist()]
        after = len(units)
        units += [self._whole(x) if x else b"" for x in split.heads]
        units.append(b"")
        pairs = np.column_stack([words.indices.to_numpy(), signs.indices.to_numpy() + len(words.dictionary)])
        alone = np.column_stack([np.arange(len(split.heads)) + after, np.full(len(split.heads), len(units) - 1)])
        return self._laid(units, np.concatenate([pairs, alone])[split.own].ravel(), 2 * split.first)

    def _signs(self, signs: str) -> bytes:
        return array(self.code, self._merged(signs)).tobytes() if signs else b""

    def _laid(self, ids: list[bytes], own: np.ndarray, first: np.ndarray) -> list[bytes]:
        table = np.frombuffer(b"".join(ids), self.dtype)
        counts = np.array([len(x) for x in ids]) // np.dtype(self.dtype).itemsize
        at, ends = gathered(counts, own)
        tokens = table[at]
        cuts = [0, *ends[first[1:] - 1].tolist(), len(at)]
        return [tokens[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """Ids of each text; null and empty texts have none."""
        out: list[bytes] = []
        held: list[str] = []
        places: list[int] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if held:
                for i, ids in zip(places, self._cut(held), strict=True):
                    out[i] = ids
            held.clear()
            places.clear()
            size = 0

        for text in texts:
            out.append(b"")
            if text and (any(a in text for a in self.added) or not cuttable(text)):
                out[-1] = self._whole(text)
            elif text:
                held.append(text)
                places.append(len(out) - 1)
                size += len(text)
                if size >= STRETCH:
                    flush()
        flush()
        return out


def gathered(counts: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For lists of `counts` elements, stored end to end: the elements of the lists `own` in their
    order, and where each list ends among them."""
    begin = np.cumsum(counts) - counts
    sizes = counts[own]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(begin[own] - (ends - sizes), sizes) + np.arange(total), ends


@dataclass
class Parts:
    """The different parts of some texts that have a blank before them, and the different heads,
    which begin a text. `own` numbers the part at each place, heads behind all others; `first`
    are the places of heads."""

    parts: pa.LargeStringArray
    heads: list[str]
    own: np.ndarray
    first: np.ndarray


def split_parts(texts: list[str]) -> Parts:
    """All parts of texts, cut before every blank."""
    lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
    flat, first = lists.values.dictionary_encode(), lists.offsets.to_numpy()[:-1]
    own = flat.indices.to_numpy()
    heads = pc.take(flat.dictionary, flat.indices.take(pa.array(first))).dictionary_encode()
    inner = np.ones(len(own), bool)
    inner[first] = False
    used = np.zeros(len(flat.dictionary), bool)
    used[own[inner]] = True
    number = (np.cumsum(used) - 1)[own]
    number[first] = heads.indices.to_numpy() + int(used.sum())
    return Parts(flat.dictionary.filter(pa.array(used)), heads.dictionary.to_pylist(), number, first)


def are_words(stems: pa.Array) -> pa.Array:
    return pc.match_substring_regex(stems, _WORD)


def split_signs(parts: pa.LargeStringArray) -> tuple[pa.Array, pa.Array]:
    """Words and the ASCII signs behind them; a part of another form is a word without signs."""
    stems = pc.utf8_rtrim(parts, characters=_SIGNS)
    words = pc.if_else(are_words(stems), stems, parts)
    sizes = pc.binary_length(words).to_numpy()
    ends = np.frombuffer(parts.buffers()[1], np.int64)[parts.offset + 1 : parts.offset + len(parts) + 1]
    lengths = pc.binary_length(parts).to_numpy() - sizes
    behind = np.concatenate([[0], np.cumsum(lengths)])
    at = np.repeat(ends - lengths - behind[:-1], lengths) + np.arange(behind[-1])
    raw = np.frombuffer(parts.buffers()[2] or b"", np.uint8)[at]
    return words, pa.LargeStringArray.from_buffers(len(parts), pa.py_buffer(behind.astype(np.int64)), pa.py_buffer(raw))
