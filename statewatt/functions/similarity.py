"""Token-sorted name similarity: the scoring kernel used inside Spark tasks.

Similarity is 100 * 2 * LCS / (len1 + len2) on token-sorted text, the
normalised insert/delete similarity.
"""

from __future__ import annotations

import numpy as np


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence, bit-parallel: one step per character of b."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    open_bits = full
    for ch in b:
        hit = open_bits & masks.get(ch, 0)
        open_bits = ((open_bits + hit) | (open_bits - hit)) & full
    return len(a) - open_bits.bit_count()


def similarity(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 100.0 if total == 0 else 200 * lcs_length(a, b) / total


WORD = 64
_CARRY = np.uint64(WORD - 1)


class ChoiceBlock:
    """A block of token-sorted choices that scores a name against all at once.

    A choice is as many machine words as its characters need, and choices of
    the same number of words lie side by side: a name costs one pass of a few
    array operations per character and word over the whole block.
    """

    def __init__(self, texts: list[str], ordinals: list[int]) -> None:
        self.ordinals = np.asarray(ordinals, dtype=np.int64)
        self.lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        words = np.maximum(1, -(-self.lengths // WORD))
        self.groups: list[tuple[np.ndarray, int, dict[str, np.ndarray]]] = []
        for n in np.unique(words):
            members = np.flatnonzero(words == n)
            masks: dict[str, np.ndarray] = {}
            for column, row in enumerate(members):
                for place, ch in enumerate(texts[row]):
                    if ch not in masks:
                        masks[ch] = np.zeros((n, len(members)), dtype=np.uint64)
                    masks[ch][place // WORD, column] |= np.uint64(1 << place % WORD)
            self.groups.append((members, int(n), masks))

    @staticmethod
    def _shared(text: str, width: int, words: int, masks: dict[str, np.ndarray]) -> np.ndarray:
        """Longest common subsequences of the text and each choice of a group."""
        open_bits = np.full((words, width), ~np.uint64(0), dtype=np.uint64)
        for ch in text:
            mask = masks.get(ch)
            if mask is None:
                continue
            carry = np.zeros(width, dtype=np.uint64)
            for w in range(words):
                bits = open_bits[w]
                hit = bits & mask[w]
                total = bits + hit + carry
                if w + 1 < words:
                    carry = ((bits & hit) | ((bits | hit) & ~total)) >> _CARRY
                open_bits[w] = total | (bits & ~mask[w])
        # bits past the end of a choice are in no mask and stay set, as a carry
        # that runs into them is put back by the second term
        return np.bitwise_count(~open_bits).sum(axis=0, dtype=np.int64)

    def scores(self, text: str) -> np.ndarray:
        out = np.empty(len(self.lengths))
        for members, words, masks in self.groups:
            shared = self._shared(text, len(members), words, masks)
            total = self.lengths[members] + len(text)
            out[members] = np.where(total > 0, 200 * shared / np.maximum(total, 1), 100.0)
        return out

    def best(self, text: str, threshold: float) -> tuple[int, float] | None:
        """Position and score of the best choice at or above the threshold;
        the lowest ordinal wins a tie."""
        scores = self.scores(text)
        if not len(scores) or (top := scores.max()) < threshold:
            return None
        tied = np.flatnonzero(scores == top)
        return int(tied[np.argmin(self.ordinals[tied])]), float(top)
