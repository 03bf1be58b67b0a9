"""Alive-to-dead session rule as a combinable summary (numpy, no Spark).

Rule per device, events in (event time, seq) order, statuses other than
ALIVE and DEAD ignored: with no open session an ALIVE opens one at its time;
further ALIVEs keep the first start; a DEAD closes the open session and emits
``(start, dead time)``; a DEAD with no open session is ignored. After a DEAD
the device starts afresh.

A contiguous piece of a device's sequence is summarised by
``(has_dead, head, first_dead, tail)``:

* ``head``: first ALIVE before the piece's first DEAD (first ALIVE at all when
  the piece has no DEAD);
* ``first_dead``: time of the first DEAD;
* ``tail``: first ALIVE after the last DEAD (``head`` when there is no DEAD):
  the start of the session still open at the end of the piece;

plus the sessions closed by the piece's second and later DEADs, which depend
on nothing outside the piece. Two adjacent summaries combine associatively
(:func:`combine`); that is what lets a device's sequence be cut at any point:
across partitions of a range-sorted table, or across micro-batches (the
stream state is ``tail``).
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

ALIVE = 1
DEAD = 2
NULL = np.iinfo(np.int64).min  # missing time (times are epoch microseconds)


class Piece(NamedTuple):
    has_dead: bool
    head: int
    first_dead: int
    tail: int


def _coalesce(a: int, b: int) -> int:
    return a if a != NULL else b


def combine(a: Piece, b: Piece) -> tuple[Piece, tuple[int, int] | None]:
    """Summary of ``a`` followed by ``b``, and the session closed at the seam
    (``b``'s first DEAD closing a session opened in ``a`` or in ``b``'s head)."""
    if not a.has_dead and not b.has_dead:
        h = _coalesce(a.head, b.head)
        return Piece(False, h, NULL, h), None
    if not a.has_dead:
        return Piece(True, _coalesce(a.head, b.head), b.first_dead, b.tail), None
    if not b.has_dead:
        return Piece(True, a.head, a.first_dead, _coalesce(a.tail, b.head)), None
    start = _coalesce(a.tail, b.head)
    seam = (start, b.first_dead) if start != NULL else None
    return Piece(True, a.head, a.first_dead, b.tail), seam


class Summaries(NamedTuple):
    # per group
    has_dead: np.ndarray
    head: np.ndarray
    first_dead: np.ndarray
    tail: np.ndarray
    # sessions closed inside a group
    session_group: np.ndarray
    session_start: np.ndarray
    session_end: np.ndarray


def summarize(gid: np.ndarray, t: np.ndarray, code: np.ndarray) -> Summaries:
    """Summaries of consecutive groups of a sorted event array.

    ``gid``: group number per row, 0-based, non-decreasing, no gaps; rows of a
    group are in (time, seq) order. ``t``: epoch microseconds. ``code``: ALIVE
    or DEAD. Vectorised: a handful of passes over the arrays.
    """
    n = len(t)
    if n == 0:
        e = np.empty(0, dtype=np.int64)
        return Summaries(np.empty(0, dtype=bool), e, e, e, e, e, e)
    n_groups = int(gid[-1]) + 1
    dead = code == DEAD
    alive = code == ALIVE
    first_row = np.empty(n, dtype=bool)
    first_row[0] = True
    np.not_equal(gid[1:], gid[:-1], out=first_row[1:])
    starts = np.flatnonzero(first_row)
    ends = np.r_[starts[1:] - 1, n - 1]
    cum = np.cumsum(dead, dtype=np.int64)
    before = cum - dead  # DEADs strictly before the row (global)
    seg = before - before[starts][gid]  # DEADs before the row within its group
    seg_first = first_row.copy()
    seg_first[1:] |= seg[1:] != seg[:-1]
    sid = np.cumsum(seg_first) - 1
    n_segs = int(sid[-1]) + 1
    seg_no = seg[seg_first]
    seg_gid = gid[seg_first]

    first_alive = np.full(n_segs, NULL, dtype=np.int64)
    ai = np.flatnonzero(alive)
    if ai.size:
        u, idx = np.unique(sid[ai], return_index=True)
        first_alive[u] = t[ai[idx]]
    dead_t = np.full(n_segs, NULL, dtype=np.int64)
    di = np.flatnonzero(dead)
    dead_t[sid[di]] = t[di]  # at most one DEAD per segment: its last row

    head_sid = sid[starts]
    last_sid = sid[ends]
    n_dead = cum[ends] - before[starts]
    has_dead = n_dead > 0
    head = first_alive[head_sid]
    first_dead = dead_t[head_sid]
    tail = np.where(dead_t[last_sid] == NULL, first_alive[last_sid], NULL)

    inner = (seg_no >= 1) & (dead_t != NULL) & (first_alive != NULL)
    assert head.shape[0] == n_groups
    return Summaries(
        has_dead,
        head,
        first_dead,
        tail,
        seg_gid[inner].astype(np.int64),
        first_alive[inner],
        dead_t[inner],
    )
