"""Counts over whole texts, for a slice of them at a time."""

from __future__ import annotations

import numpy as np

from .batches import SPACED, Texts, Words, mix, range_hashes, window_hashes

SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
REPEAT_WINDOW = 8
_NEWLINE = 0x0A


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values between consecutive bounds."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _same(groups: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item its place among the distinct (group, hash) pairs, and how often each pair occurs."""
    _, place, counts = np.unique(hashes + mix(groups), return_inverse=True, return_counts=True)
    return place, counts


def repeat_words(words: Words, hashes: np.ndarray, size: int = REPEAT_WINDOW) -> np.ndarray:
    """Words inside windows of ``size`` words that the text has twice or more."""
    windows = window_hashes(hashes, size)
    text_of = words.text_of
    begin = np.arange(len(windows))
    begin = begin[text_of[begin] == text_of[begin + size - 1]] if len(windows) else begin
    place, counts = _same(text_of[begin], windows[begin])
    begin = begin[counts[place] > 1]
    change = np.zeros(len(hashes) + 1, dtype=np.int64)
    change[begin] += 1  # each begins once
    change[begin + size] -= 1
    return sums(np.cumsum(change[:-1]) > 0, words.first)


def duplicate_lines(texts: Texts, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those of them that equal an earlier line of the text."""
    breaks = np.flatnonzero(texts.data == _NEWLINE)
    starts = np.unique(np.concatenate([texts.bounds[:-1], breaks + 1]))
    starts = starts[starts < len(texts.data)]
    line_of = np.searchsorted(starts, words.starts, "right") - 1
    worded = np.unique(line_of)
    ends = np.append(starts[1:], len(texts.data))
    last = ends[worded] - (texts.data[ends[worded] - 1] == _NEWLINE) if len(worded) else worded
    hashes = range_hashes(texts.data, starts[worded], last) if len(worded) else np.zeros(0, np.uint64)
    text_of = np.searchsorted(texts.bounds, starts[worded], "right") - 1
    place, _ = _same(text_of, hashes)
    first = np.zeros(len(worded), dtype=bool)
    first[np.unique(place, return_index=True)[1]] = True
    n = np.bincount(text_of, minlength=len(texts))
    return n, n - np.bincount(text_of, weights=first, minlength=len(texts)).astype(np.int64)


def base_counts(texts: Texts) -> dict[str, np.ndarray]:
    """``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words`` of each text."""
    words = Words.of(texts, SPACED)
    begins = (texts.data & 0xC0) != 0x80
    return {
        "n_words": words.counts,
        "word_chars": sums(begins & SPACED[texts.data], texts.bounds),
        "n_symbols": sums(SYMBOLS[texts.data], texts.bounds),
        "n_dup_lines": duplicate_lines(texts, words)[1],
        "n_repeat_words": repeat_words(words, words.hashes()),
    }
