"""Edit distance within a limit, over texts or lists of words."""

from __future__ import annotations

from collections.abc import Sequence


def _trim(a: Sequence, b: Sequence) -> tuple[Sequence, Sequence]:
    """Both without their common beginning and end, which cost nothing in an alignment."""
    n = min(len(a), len(b))
    i = 0
    if a[:n] == b[:n]:
        i = n
    else:
        step = 1 << max(0, n.bit_length() - 1)
        while step:
            if i + step <= n and a[i : i + step] == b[i : i + step]:
                i += step
            step >>= 1
    n -= i
    j, step = 0, 1 << max(0, n.bit_length() - 1) if n else 0
    while step:
        if j + step <= n and a[len(a) - j - step : len(a) - j] == b[len(b) - j - step : len(b) - j]:
            j += step
        step >>= 1
    return a[i : len(a) - j], b[i : len(b) - j]


def banded_distance(a: Sequence, b: Sequence, limit: int) -> int:
    """Levenshtein distance of ``a`` and ``b``, or ``limit + 1`` if it is more than ``limit``.

    Bit-parallel over a band: column j of the table is kept only in the 2 limit + 1 rows next to the diagonal, as the bits
    of two integers that hold where the value steps up and down; the window slides one row a column. Cells outside the band
    cannot be part of a path of ``limit`` edits.
    """
    if limit < 0:
        return 0 if a == b else limit + 1
    a, b = _trim(a, b)
    if len(a) < len(b):
        a, b = b, a
    m, n = len(a), len(b)
    if m - n > limit:
        return limit + 1
    if not n:
        return m
    limit_of = limit
    limit = min(limit, m)  # a band wider than the table gains nothing
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | (1 << i)
    width = 2 * limit + 2
    full = (1 << width) - 1
    # the band's lowest bit stands for row j - limit; the bit above the diagonal row of the last column is the top one
    top, side = 1 << (width - 1), 1 << (width - 2)
    up = full ^ ((1 << (width - limit - 1)) - 1)
    down = 0
    score, most, shift = limit, limit + n - (m - limit), limit + 1 - width
    for j in range(n):
        rows = where.get(b[j], 0)
        match = (rows << -shift if shift < 0 else rows >> shift) & full
        shift += 1
        diagonal = ((((match & up) + up) & full) ^ up) | match | down
        plus = down | (full ^ (diagonal | up))
        minus = diagonal & up
        if j < m - limit:
            score += not diagonal & top
        else:
            score += bool(plus & side) - bool(minus & side)
            side >>= 1
        if score > most:
            return limit_of + 1
        half = diagonal >> 1
        up = minus | (full ^ (half | plus))
        down = half & plus
    return score if score <= limit_of else limit_of + 1


def within(a: Sequence, b: Sequence, limit: int) -> int:
    """The same by bands that widen fourfold, so that close pairs cost little even under a high limit."""
    band = min(16, limit)
    while True:
        found = banded_distance(a, b, band)
        if found <= band or band >= limit:
            return found if found <= limit else limit + 1
        band = min(limit, 4 * band)
