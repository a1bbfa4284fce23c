"""Words of UTF-8 texts, found on bytes.

White space of the contracts is ASCII, so cutting bytes gives the same
words as cutting code points.
"""

from __future__ import annotations

import numpy as np

SEGMENT = 1 << 20                 # bytes looked at at a time


def is_blank(b: np.ndarray) -> np.ndarray:
    """Which bytes are white space: 0x20 and 0x09 to 0x0D."""
    return (b == 0x20) | ((b >= 0x09) & (b <= 0x0D))


def word_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the words of ``text``, segment by segment."""
    b = np.frombuffer(text, np.uint8)
    starts, ends = [], []
    before = True                                     # white space, or the edge of the text
    for a in range(0, len(b), SEGMENT):
        blank = is_blank(b[a:a + SEGMENT])
        turned = np.flatnonzero(np.diff(blank, prepend=before)) + a
        into = turned[~blank[turned - a]]
        starts.append(into)
        ends.append(turned[blank[turned - a]])
        before = bool(blank[-1])
    if not before:
        ends.append(np.array([len(b)]))
    none = np.zeros(0, np.int64)
    return np.concatenate(starts or [none]).astype(np.int64), np.concatenate(ends or [none]).astype(np.int64)


def code_points(text: bytes) -> int:
    """Code points of whole UTF-8 sequences."""
    b = np.frombuffer(text, np.uint8)
    return len(b) - int(np.count_nonzero((b & 0xC0) == 0x80))
