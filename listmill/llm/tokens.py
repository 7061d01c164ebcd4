"""Token ids of whole texts, found once per distinct word and piece of the table.

A tokenizer whose tokens never cross a place where a text is cut gives, word by word, the
ids that it gives for the whole text. Words repeat, so most of them are looked up.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from itertools import chain
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

# Words that are encoded at once.
SLICE = 1 << 14
# Punctuation behind words whose ids are remembered.
TAILS = 1 << 12

# Words that both byte-level vocabularies cut in the same simple way: letters up to U+00FF,
# then punctuation without an apostrophe. All others take the tokenizer's own way.
_PLAIN = re.compile(r"([A-Za-zªµºÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


def read_file(name_or_path: str) -> bytes:
    """A vocabulary file: of the public tokenizers, or any path with a folder."""
    path = name_or_path if "/" in name_or_path else public_tokenizers.path(name_or_path)
    with open(path, "rb") as file:
        return file.read()


def byte_letters() -> dict[int, str]:
    """The character by which a byte-level vocabulary writes each byte.

    Printable bytes stand for themselves, the others for the characters from U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = sorted(set(range(256)) - set(plain))
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


_LETTERS = byte_letters()


def load(data: bytes, special: bool) -> Tokenizer:
    """A tokenizer; ``special`` says whether it knows its special tokens inside texts."""
    tokenizer = Tokenizer.from_buffer(data)
    tokenizer.encode_special_tokens = not special
    return tokenizer


def word_encoder(
    tokenizer: Tokenizer, before: str = "", lower: bool = False
) -> Callable[[list[str]], list[list[int]]]:
    """Ids of words without white space inside, each with ``before`` in front of it.

    Plain words go to the merges directly, which leaves out the work of normalizing
    and of keeping offsets.
    """
    tokenize, plain = tokenizer.model.tokenize, _PLAIN.fullmatch
    first = "".join(_LETTERS[b] for b in before.encode())
    # few and frequent, unlike the words that they end
    tails: dict[str, list[int]] = {}

    def tail_ids(tail: str) -> list[int]:
        ids = tails.get(tail)
        if ids is None:
            if len(tails) >= TAILS:
                tails.clear()
            ids = tails[tail] = [t.id for t in tokenize(tail)]
        return ids

    def encode(words: list[str]) -> list[list[int]]:
        found: list = []
        rest = []
        for word in words:
            m = plain(word)
            if m is None:
                rest.append(len(found))
                found.append(None)
                continue
            head, tail = m.groups()
            if lower:
                head = head.lower()
            if not head.isascii():
                head = head.encode().decode("latin-1").translate(_LETTERS)
            ids = [t.id for t in tokenize(first + head)]
            if tail:
                ids += tail_ids(tail)
            found.append(ids)
        others = [before + words[i] for i in rest]
        for i, e in zip(rest, tokenizer.encode_batch(others, add_special_tokens=False), strict=True):
            found[i] = e.ids
        return found

    return encode


class Words(NamedTuple):
    """The words of texts, made once for all encoders: each distinct one, which of them the words
    are, and where each text's begin, the last one's end behind them."""

    distinct: list[str]
    indices: pa.Array
    ends: np.ndarray

    @classmethod
    def of(cls, words: pa.ListArray) -> Words:
        found = words.flatten().dictionary_encode()
        ends = np.asarray(words.offsets) - words.offsets[0].as_py()
        return cls(found.dictionary.to_pylist(), found.indices, ends)


class WordIds:
    """Ids of words by an encoder, remembered up to about ``limit`` words.

    The older half goes when there are that many, so words that come again and again stay.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], limit: int = 1 << 18):
        self.encode, self.limit = encode, limit
        # ids as the bytes of 32-bit integers, which take a third of a list
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _of_distinct(self, words: list[str]) -> pa.ListArray:
        """A list of ids for every word, of which there is none twice."""
        if len(self.known) > self.limit // 2:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        found = list(map(known.get, words))
        new = []
        for at, ids in enumerate(found):
            if ids is None:
                word = words[at]
                ids = older.get(word)
                if ids is None:
                    new.append(at)
                else:
                    found[at] = known[word] = ids
        for start in range(0, len(new), SLICE):
            part = new[start : start + SLICE]
            lists = self.encode([words[at] for at in part])
            data = array("i", chain.from_iterable(lists)).tobytes()
            begin = 0
            for at, ids in zip(part, lists, strict=True):
                end = begin + 4 * len(ids)
                found[at] = known[words[at]] = data[begin:end]
                begin = end
        ends = np.zeros(len(found) + 1, np.int32)
        np.cumsum(np.fromiter(map(len, found), np.int32, len(found)) // 4, out=ends[1:])
        ids = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(found))])
        return pa.ListArray.from_arrays(pa.array(ends), ids)

    def of_words(self, words: pa.Array) -> pa.ListArray:
        """A list of ids for every word."""
        distinct = words.dictionary_encode()
        return self._of_distinct(distinct.dictionary.to_pylist()).take(distinct.indices)

    def of_texts(self, words: pa.ListArray | Words) -> pa.ListArray:
        """A list of ids for every list of words."""
        words = words if isinstance(words, Words) else Words.of(words)
        lists = self._of_distinct(words.distinct).take(words.indices)
        ends = np.asarray(lists.offsets)
        return pa.ListArray.from_arrays(pa.array(ends[words.ends], pa.int32()), lists.flatten())


def filled(texts: pa.Array) -> pa.Array:
    """Texts with null as empty."""
    return pc.fill_null(texts, "")
