"""The pieces into which a word vocabulary splits words, so that equal pieces of different words are worked on once.

A vocabulary of the rule RULE lower-cases a word and merges each of its pieces apart. Words of visible ASCII characters
and of the Latin-1 and Russian letters are split here by that rule: these letters are composed already and mean the same
in every version of Unicode. Other words, words with an added token, and all words of a vocabulary with another rule stay
whole. The values of a word are those of all its pieces, in turn.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Fixed value: the splitting rule of the vocabularies whose words are split here.
RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LOW = "a-zß-öø-ÿа-я"
_PIECE = re.compile(rf"\n|'s|'t|'re|'ve|'m|'ll|'d|[{_LOW}]+|[0-9]|[^\n0-9{_LOW}]+")
_PLAIN = "^[!-~À-ÖØ-öø-ÿА-я]+$"
#: Values of so many pieces are remembered by a worker; beyond it those not used in the same step are forgotten.
CACHE_PIECES = 800_000

#: (pieces of plain words, whole other words) -> all their values one after the other, and how many each has.
Values = Callable[[list[str], list[str]], tuple[np.ndarray, np.ndarray]]


def ragged(flat: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The ranges first[i] : first[i] + count[i] of `flat`, one after the other."""
    end = np.cumsum(count)
    return flat[np.arange(end[-1] if len(end) else 0) + np.repeat(first - (end - count), count)]


class Pieces:
    """Remembers the values of pieces."""

    def __init__(self, path: str, values: Values):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.fine = (steps[0].get("pattern") or {}).get("Regex") == RULE and '"Lowercase"' in json.dumps(spec.get("normalizer"))
        self.added = [x["content"] for x in spec.get("added_tokens") or []]
        self.values = values
        self._forget()

    def _forget(self) -> None:
        # A newline ends each plain word's pieces and has no value.
        self.place = {"\n": 0}
        self.flat, self.first = np.zeros(0, np.uint32), np.zeros(2, np.int64)

    def _learn(self, plain: list[str], whole: list[str]) -> None:
        flat, sizes = self.values(plain, whole)
        self.place.update(zip(plain + whole, range(len(self.place), len(self.place) + len(plain) + len(whole)), strict=True))
        self.flat = np.concatenate([self.flat, flat.astype(np.uint32)])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])

    def _split(self, words: pa.Array) -> tuple[list[str], list[str], np.ndarray]:
        """The plain words' pieces, a newline after each word's; the other words; and which words are plain."""
        if not self.fine:
            return [], words.to_pylist(), np.zeros(len(words), bool)
        plain = pc.match_substring_regex(words, _PLAIN)
        for x in self.added:
            plain = pc.and_(plain, pc.invert(pc.match_substring(words, x)))
        low = pc.utf8_lower(words.filter(plain)).to_pylist()
        return _PIECE.findall("\n".join([*low, ""])), words.filter(pc.invert(plain)).to_pylist(), plain.to_numpy(zero_copy_only=False)

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The values of all words, and for each word where its values begin and how many there are."""
        parts, whole, plain = self._split(words)
        new, other = set(parts) - self.place.keys(), set(whole) - self.place.keys()
        if len(self.place) + len(new) + len(other) > CACHE_PIECES:
            self._forget()
            new, other = set(parts) - {"\n"}, set(whole)
        if new or other:
            self._learn(list(new), list(other))
        slot = np.fromiter(map(self.place.__getitem__, [*parts, *whole]), np.int64, len(parts) + len(whole))
        sizes = self.first[slot + 1] - self.first[slot]
        at = np.concatenate([[0], np.cumsum(sizes)])
        begin, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        ends = at[np.flatnonzero(slot[: len(parts)] == 0)]
        begin[plain] = np.concatenate([[0], ends[:-1]])[: len(ends)]
        size[plain] = ends - begin[plain]
        begin[~plain], size[~plain] = at[len(parts) : -1], sizes[len(parts) :]
        return ragged(self.flat, self.first[slot], sizes), begin, size
