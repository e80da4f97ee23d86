"""Positional Burrows-Wheeler transform of a collection of short strings, built column by column."""

from __future__ import annotations

import numpy as np


def equal_windows(data: np.ndarray, begin: np.ndarray, sizes: np.ndarray, shift: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, class) of the windows of ``length`` bytes that other strings have at the same column.

    String i is ``data[begin[i] : begin[i] + sizes[i]]``; its byte at ``shift[i]`` is in column 0.
    Columns are taken from the last to the first. A round puts one symbol of every string in front
    of its suffix: a stable sort by that symbol keeps the suffixes of the column in order, and the
    common prefix of two neighbours is one more than the least one between the suffixes they
    extend. Strings come in at their last column, with an empty suffix, and go after their first.
    Neighbours that share ``length`` symbols hold one window.
    """
    base = begin + shift
    left, right = -shift, sizes - shift - 1
    entering = np.argsort(-right, kind="stable")
    enters_at = right[entering]
    order, shared = np.zeros(0, np.int64), np.zeros(0, np.int16)
    found = [(np.zeros(0, np.int64),) * 3]
    classes = came = 0
    for column in range(int(right.max(initial=-1)), int(left.min(initial=0)) - 1, -1):
        upto = int(np.searchsorted(-enters_at, -column, "right"))
        new, came = entering[came:upto], upto
        here = np.concatenate([new, order])
        shared = np.concatenate([np.zeros(len(new) + 1, np.int16), shared[1:], np.zeros(1, np.int16)])[: len(here) + 1]
        inside = left[here] <= column
        symbol = np.zeros(len(here), np.uint8)
        symbol[inside] = data[base[here[inside]] + column] + 1
        perm = np.argsort(symbol, kind="stable")[len(here) - int(inside.sum()) :]
        symbol = symbol[perm]
        order = here[perm]
        next_shared = np.zeros(len(perm), np.int16)
        if len(perm) > 1:
            least = np.minimum.reduceat(shared, perm + 1)[:-1] + 1
            next_shared[1:] = np.where(symbol[1:] == symbol[:-1], least, 0)
        shared = next_shared
        alike = shared >= length
        if alike.any():
            own = np.cumsum(~alike) + classes
            member = alike | np.append(alike[1:], False)
            found.append((order[member], column - left[order[member]], own[member]))
            classes = int(own[-1]) + 1
    return tuple(map(np.concatenate, zip(*found, strict=True)))
