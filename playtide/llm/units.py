"""Token ids of texts by way of their units: pieces of text that a tokenizer never joins, each encoded once and then looked up."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import chain, islice

import numpy as np

from playtide.llm.common import ranges

#: Bytes a worker may spend on units it remembers before it starts afresh, and what one takes besides its characters.
MOST_BYTES, UNIT_BYTES = 200 << 20, 200


class _Index(dict):
    """Numbers new keys in the order they come."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def in_a_row(encoded: Iterable[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    found = list(encoded)
    lengths = np.array([len(x) for x in found], np.int64)
    return np.fromiter(chain.from_iterable(found), np.int32, int(lengths.sum())), lengths


class UnitTable:
    """``encode_many`` gives the ids of a list of units, in a row, and how many each has; ``split`` cuts a text into units."""

    def __init__(self, split: Callable[[str], list[str]], encode_many: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.split, self.encode_many = split, encode_many
        self._clear()

    def _clear(self) -> None:
        self.index, self.ids = _Index(), np.zeros(0, np.int32)
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.held = 0

    def forget(self) -> None:
        """Start afresh if too much is remembered; what one call adds is bounded by its texts."""
        if self.held > MOST_BYTES:
            self._clear()

    def learn(self, known: int) -> None:
        """Encode the units numbered from ``known`` on."""
        new = list(islice(self.index, known, None))
        if new:
            ids, lengths = self.encode_many(new)
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.ids = np.concatenate([self.ids, ids])
            self.held += sum(map(len, new)) + UNIT_BYTES * len(new)

    def tokens(self, flat: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the numbered units in a row, and how many lie between the borders."""
        lengths = self.lengths[flat]
        sums = np.concatenate([[0], np.cumsum(lengths)])
        return self.ids[ranges(self.starts[flat], lengths)], np.diff(sums[borders])

    def encode(self, docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each text has."""
        self.forget()
        units = [self.split(x) for x in docs]
        known = len(self.index)
        flat = np.fromiter(map(self.index.__getitem__, chain.from_iterable(units)), np.int64)
        self.learn(known)
        return self.tokens(flat, np.cumsum([0, *(len(x) for x in units)]))
