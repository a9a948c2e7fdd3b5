"""Counts of whole texts: words, symbols, letters, repeated lines and passages; some texts at a time in numpy."""

from __future__ import annotations

import numpy as np

from ludoscope.llm.words import Words, blank, byte_spans, mix

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
# Leading bytes of U+00C0 to U+FFFF.
_LETTER[0xC3:0xF0] = True


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _lines(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those of them equal to an earlier line of the text."""
    n = len(words.count)
    feeds = np.flatnonzero(words.data == 10)
    begin = np.unique(np.concatenate((words.bounds[:-1], feeds + 1)))
    begin = begin[begin < len(words.data)]
    doc = np.searchsorted(words.bounds, begin, side="right") - 1
    end = np.append(begin[1:], len(words.data))
    end = np.where(np.isin(end - 1, feeds) & (end - 1 >= begin), end - 1, end)
    filled = np.searchsorted(words.begin, end) > np.searchsorted(words.begin, begin)
    begin, end, doc = begin[filled], end[filled], doc[filled]
    value = mix(byte_spans(words.data, begin, end) ^ mix(doc.astype(np.uint64) + np.uint64(1)))
    _, once = np.unique(value, return_index=True)
    lines = np.bincount(doc, minlength=n)
    return lines, lines - np.bincount(doc[once], minlength=n)


def _repeated(words: Words, size: int = WINDOW) -> np.ndarray:
    """Words inside windows of ``size`` words that their text holds twice or more."""
    starts, value = words.windows(size)
    if not len(starts):
        return np.zeros(len(words.count), dtype=np.int64)
    value = mix(value ^ mix(words.doc[starts].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(value)
    value = value[order]
    same = value[1:] == value[:-1]
    twice = np.zeros(len(starts), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    step = np.zeros(len(words.hash) + 1, dtype=np.int64)
    np.add.at(step, starts[twice], 1)
    np.add.at(step, starts[twice] + size, -1)
    covered = np.cumsum(step[:-1]) > 0
    return np.bincount(words.doc[covered], minlength=len(words.count))


def _lengths(words: Words) -> np.ndarray:
    head = (words.data & 0xC0) != 0x80
    return _per_text(head & ~blank(words.data), words.bounds)


def _stutter(words: Words) -> np.ndarray:
    """Words equal to the word before."""
    again = np.flatnonzero((words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1]))
    return np.bincount(words.doc[again], minlength=len(words.count))


_COUNTERS = {
    "n_words": lambda w: w.count,
    "word_chars": _lengths,
    "n_symbols": lambda w: _per_text(_SYMBOL[w.data], w.bounds),
    "n_repeat_words": _repeated,
    "n_stutter": _stutter,
    "n_letters": lambda w: _per_text(_LETTER[w.data], w.bounds),
}
COUNTS = (*_COUNTERS, "n_lines", "n_dup_lines")


def counted(words: Words, name: str) -> np.ndarray:
    """One of the COUNTS of some texts, worked out once."""
    if name not in words.memo:
        if name in ("n_lines", "n_dup_lines"):
            words.memo["n_lines"], words.memo["n_dup_lines"] = _lines(words)
        else:
            words.memo[name] = _COUNTERS[name](words)
    return words.memo[name]
