"""Edges in the plane on a whole-number grid: split where they meet, winding numbers on either side, boundaries linked to rings.

Coordinates are whole numbers below 2^29 in size, so every test of sides is exact in 64 bits. Crossings are rounded to the grid and splitting is
repeated until no edge meets another but at its ends. Of a directed edge the area lies to the left.
"""

from __future__ import annotations

import numpy as np

LIMIT = 1 << 29


def merge(p: np.ndarray, q: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges p to q with multiplicities m, each upward (or to the right), equal ones added up, those that cancel dropped."""
    turn = (p[:, 1] > q[:, 1]) | ((p[:, 1] == q[:, 1]) & (p[:, 0] > q[:, 0]))
    a, b, m = np.where(turn[:, None], q, p), np.where(turn[:, None], p, q), np.where(turn, -m, m)
    rows, at = np.unique(np.concatenate((a, b), axis=1), axis=0, return_inverse=True)
    total = np.zeros(len(rows), np.int64)
    np.add.at(total, at.reshape(-1), m)
    keep = (total != 0) & (rows[:, :2] != rows[:, 2:]).any(axis=1)
    return rows[keep, :2], rows[keep, 2:], total[keep]


def side(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Above 0 where c lies to the left of a to b."""
    return (b[:, 0] - a[:, 0]) * (c[:, 1] - a[:, 1]) - (b[:, 1] - a[:, 1]) * (c[:, 0] - a[:, 0])


def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) for each value lo .. hi of each row."""
    n = hi - lo + 1
    row = np.repeat(np.arange(len(lo)), n)
    return row, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + lo[row]


def _within(groups: np.ndarray, rows: np.ndarray, block: int = 2_000_000):
    """Pairs of rows of equal group, in blocks."""
    order = np.argsort(groups, kind="stable")
    g, r = groups[order], rows[order]
    end = np.searchsorted(g, g, side="right")
    n = end - np.arange(len(g)) - 1
    done = np.cumsum(n)
    start = 0
    while start < len(g):
        stop = max(int(np.searchsorted(done, (done[start - 1] if start else 0) + block, side="right")), start + 1)
        k = n[start:stop]
        i = np.repeat(np.arange(start, stop), k)
        j = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k) + i + 1
        yield r[i], r[j]
        start = stop


def _close_pairs(a: np.ndarray, b: np.ndarray):
    """Pairs of edges whose boxes touch, by way of square bins; a pair may come more than once."""
    lo, hi = np.minimum(a, b), np.maximum(a, b)
    k = max(int(np.sqrt(len(a) / 4)), 1)
    size = np.maximum((hi.max(axis=0) - lo.min(axis=0)) // k + 1, 1)
    l, h = (lo - lo.min(axis=0)) // size, (hi - lo.min(axis=0)) // size
    row, x = _spread(l[:, 0], h[:, 0])
    again, y = _spread(l[row, 1], h[row, 1])
    row, x = row[again], x[again]
    for i, j in _within(x * (k + 1) + y, row):
        meet = ((lo[i] <= hi[j]) & (lo[j] <= hi[i])).all(axis=1)
        yield i[meet], j[meet]


def node(p: np.ndarray, q: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The edges split where they meet."""
    a, b, m = merge(p, q, m)
    while len(a):
        at, points = [], []

        def cut(edge, point, where):
            # a point that is an end of the edge does not split it
            where = where & (point != a[edge]).any(axis=1) & (point != b[edge]).any(axis=1)
            at.append(edge[where])
            points.append(point[where])

        for i, j in _close_pairs(a, b):
            si, ti, sj, tj = side(a[i], b[i], a[j]), side(a[i], b[i], b[j]), side(a[j], b[j], a[i]), side(a[j], b[j], b[i])
            cross = (np.sign(si) * np.sign(ti) < 0) & (np.sign(sj) * np.sign(tj) < 0)
            if cross.any():
                i1, j1 = i[cross], j[cross]
                t = sj[cross].astype(np.longdouble) / (sj[cross] - tj[cross]).astype(np.longdouble)
                x = a[i1] + np.rint(t[:, None] * (b[i1] - a[i1])).astype(np.int64)
                every = np.ones(len(i1), bool)
                cut(i1, x, every)
                cut(j1, x, every)
            for e, f, s, end in ((i, j, si, a), (i, j, ti, b), (j, i, sj, a), (j, i, tj, b)):
                lo, hi = np.minimum(a[e], b[e]), np.maximum(a[e], b[e])
                cut(e, end[f], (s == 0) & ((end[f] >= lo) & (end[f] <= hi)).all(axis=1))
        edge = np.concatenate(at) if at else np.zeros(0, np.int64)
        if not len(edge):
            break
        point = np.concatenate(points)
        every = np.arange(len(a))
        edge, point = np.concatenate((edge, every, every)), np.concatenate((point, a, b))
        along = ((point - a[edge]) * (b[edge] - a[edge])).sum(axis=1)
        order = np.lexsort((along, edge))
        edge, point = edge[order], point[order]
        same = edge[1:] == edge[:-1]
        a, b, m = merge(point[:-1][same], point[1:][same], m[edge[:-1][same]])
    return a, b, m


def _above(a: np.ndarray, b: np.ndarray, m: np.ndarray, mid: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Multiplicities added up of the edges (upward, none level) that a ray to the right meets from the middles (twice the coordinates) of the edges `own`."""
    out = np.zeros(len(mid), np.int64)
    if not len(mid) or not len(a):
        return out
    strips = max(len(a) // 32, 1)
    base, top = 2 * a[:, 1].min(), 2 * b[:, 1].max()
    size = max((top - base) // strips + 1, 1)
    row, strip = _spread((2 * a[:, 1] - base) // size, (2 * b[:, 1] - base) // size)
    order = np.argsort(strip, kind="stable")
    row, strip = row[order], strip[order]
    mine = (mid[:, 1] - base) // size
    lo, hi = np.searchsorted(strip, mine, side="left"), np.searchsorted(strip, mine, side="right")
    step = max(1, int(2_000_000 // max((hi - lo).max(initial=1), 1)))
    for s in range(0, len(mid), step):
        l, h = lo[s : s + step], hi[s : s + step]
        k, at = _spread(l, h - 1)
        e, k = row[at], k + s
        hit = (2 * a[e, 1] <= mid[k, 1]) & (mid[k, 1] < 2 * b[e, 1]) & (e != own[k])
        e, k = e[hit], k[hit]
        left = side(2 * a[e], 2 * b[e], mid[k]) > 0
        np.add.at(out, k[left], m[e[left]])
    return out


def windings(a: np.ndarray, b: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Winding numbers to the left and to the right of noded edges (as merge leaves them)."""
    level = a[:, 1] == b[:, 1]
    left, right = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    up = np.flatnonzero(~level)
    w = _above(a[up], b[up], m[up], (a + b)[up], np.arange(len(up)))
    left[up], right[up] = w + m[up], w
    # turned by a quarter (x, y) to (y, -x), an edge to the right points down and a ray upward goes to the right
    flat = np.flatnonzero(level)
    turn = lambda p: np.stack((p[:, 1], -p[:, 0]), axis=1)
    steep = np.flatnonzero(a[:, 0] != b[:, 0])
    ta, tb, tm = turn(a[steep]), turn(b[steep]), m[steep]
    down = ta[:, 1] > tb[:, 1]
    ta, tb, tm = np.where(down[:, None], tb, ta), np.where(down[:, None], ta, tb), np.where(down, -tm, tm)
    w = _above(ta, tb, tm, turn((a + b)[flat]), np.searchsorted(steep, flat))
    left[flat], right[flat] = w, w - m[flat]
    return left, right


def boundary(p: np.ndarray, q: np.ndarray, m: np.ndarray | None = None, odd: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Directed edges around the area of winding number above 0 (odd: of odd winding number, repeated loops counted once)."""
    a, b, m = node(p, q, np.ones(len(p), np.int64) if m is None else m)
    if not len(a):
        return a, b
    if odd:
        m = m // np.gcd.reduce(m)
    left, right = windings(a, b, m)
    inl, inr = (left % 2 == 1, right % 2 == 1) if odd else (left > 0, right > 0)
    edge = inl != inr
    a, b, inl = a[edge], b[edge], inl[edge]
    return np.where(inl[:, None], a, b), np.where(inl[:, None], b, a)


def following(a: np.ndarray, b: np.ndarray, plane: np.ndarray | None = None) -> np.ndarray:
    """For each boundary edge the next one of its ring: at their common point both bound the same wedge of the area. -1: none starts there.

    plane: edges of different numbers (from 0) do not meet; numbers times the extents stay below 2^63."""
    n = len(a)
    if not n:
        return np.zeros(0, np.int64)
    place = np.concatenate((a, b))
    out = np.concatenate((np.ones(n, bool), np.zeros(n, bool)))
    away = np.concatenate((b - a, a - b)).astype(float)
    angle = np.arctan2(away[:, 1], away[:, 0])
    at, extent = place - place.min(axis=0), np.ptp(place, axis=0) + 1
    vertex = at[:, 0] * extent[1] + at[:, 1]
    if plane is not None:
        vertex += np.concatenate((plane, plane)) * extent.prod()
    order = np.lexsort((angle, vertex))
    v, o, e = vertex[order], out[order], order % n
    # the last edge that starts before this one ends, turning left; round the point if there is none
    at = np.maximum.accumulate(np.where(o, np.arange(2 * n), -1))
    begin = np.searchsorted(v, v, side="left")
    final = at[np.searchsorted(v, v, side="right") - 1]
    use = np.where(at >= begin, at, np.where(final >= begin, final, -1))
    nxt = np.full(n, -1, np.int64)
    ends = ~o
    nxt[e[ends]] = np.where(use[ends] >= 0, e[use[ends]], -1)
    return nxt


def loops(points: list[tuple[int, int]]) -> list[np.ndarray]:
    """A closed walk (first point not repeated) cut at the points that it visits again; points in the middle of a straight line go."""
    out, stack, seen = [], [], {}
    for p in [*points, points[0]]:
        if p in seen:
            at = seen[p]
            ring = stack[at:]
            for x in ring[1:]:
                del seen[x]
            del stack[at + 1 :]
            ring = np.array(ring, np.int64)
            if len(ring) > 2:
                # a straight line in a loop of whole numbers is exact
                keep = side(np.roll(ring, 1, axis=0), ring, np.roll(ring, -1, axis=0)) != 0
                if keep.sum() > 2:
                    out.append(ring[keep])
        else:
            seen[p] = len(stack)
            stack.append(p)
    return out


def area(ring: np.ndarray) -> float:
    """Signed area of an open ring, exact up to the last division."""
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return sum((x * np.roll(y, -1) - np.roll(x, -1) * y).tolist()) / 2


def chains(a: np.ndarray, b: np.ndarray, stop: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Boundary edges as paths between the points marked in `stop` (of each edge: its end is such a point), and closed walks without any."""
    nxt = following(a, b)
    nxt[stop] = -1
    used = np.zeros(len(a), bool)
    paths, closed = [], []
    has = np.zeros(len(a), bool)
    has[nxt[nxt >= 0]] = True
    step, pa, pb = nxt.tolist(), list(map(tuple, a.tolist())), list(map(tuple, b.tolist()))
    for first in np.flatnonzero(~has).tolist() + list(range(len(a))):
        if used[first]:
            continue
        walk, e = [pa[first]], first
        while e >= 0 and not used[e]:
            used[e] = True
            walk.append(pb[e])
            e = step[e]
        (closed if e >= 0 else paths).append(np.array(walk[:-1] if e >= 0 else walk, np.int64))
    return paths, closed


def walks(nxt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges in the order of their closed walks, where each has a next one, and the length of each walk."""
    step, used, order, size = nxt.tolist(), bytearray(len(nxt)), [], []
    for first in range(len(step)):
        if not used[first]:
            begun, e = len(order), first
            while not used[e]:
                used[e] = 1
                order.append(e)
                e = step[e]
            size.append(len(order) - begun)
    return np.array(order, np.int64), np.array(size, np.int64)


def rings(a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
    """The rings of a boundary: shells turn left (positive area), holes right."""
    closed = chains(a, b, np.zeros(len(a), bool))[1]
    return [r for walk in closed for r in loops(list(map(tuple, walk.tolist())))]


def holds(ring: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Points (twice the coordinates, on no edge) inside an open ring."""
    a, b = ring, np.roll(ring, -1, axis=0)
    return _above(*merge(a, b, np.ones(len(a), np.int64)), points, np.full(len(points), -1)) != 0 if len(ring) else np.zeros(len(points), bool)


def with_holes(found: list[np.ndarray]) -> list[tuple[np.ndarray, list[np.ndarray]]]:
    """Shells with their holes: a hole belongs to the smallest shell around it."""
    sizes = [area(r) for r in found]
    shells = sorted(((s, k) for k, s in enumerate(sizes) if s > 0))
    held = {k: [] for _, k in shells}
    left = [k for k, s in enumerate(sizes) if s < 0]
    if left:
        mid = np.array([found[k][0] + found[k][1] for k in left])
        free = np.ones(len(left), bool)
        for _, k in shells:
            inside = np.flatnonzero(free)
            inside = inside[holds(found[k], mid[inside])]
            held[k] += [found[left[i]] for i in inside.tolist()]
            free[inside] = False
    return [(found[k], held[k]) for k in held]


def clip_half(ring: np.ndarray, axis: int, at: int, upper: bool) -> np.ndarray:
    """The part of an open ring on one side of a line. The ring crosses the line at its own points, or on edges square to the line."""
    v = ring[:, axis]
    inside = v >= at if upper else v <= at
    if inside.all() or not inside.any():
        return ring if inside.all() else ring[:0]
    after = np.roll(inside, -1)
    leave = np.flatnonzero(inside & ~after & (v != at))
    enter = np.flatnonzero(~inside & after & (np.roll(v, -1) != at))
    x, y = ring[leave].copy(), ring[(enter + 1) % len(ring)].copy()
    x[:, axis] = y[:, axis] = at
    own = np.flatnonzero(inside)
    order = np.argsort(np.concatenate((2 * own, 2 * leave + 1, 2 * enter + 1)), kind="stable")
    return np.concatenate((ring[own], x, y))[order]


def split_at_lines(ring: np.ndarray, cell: int) -> np.ndarray:
    """The open ring with points where it crosses lines at multiples of `cell`. The same edge gives the same points in either direction."""
    a, b = ring, np.roll(ring, -1, axis=0)
    swap = (a[:, 0] > b[:, 0]) | ((a[:, 0] == b[:, 0]) & (a[:, 1] > b[:, 1]))
    lo, hi = np.where(swap[:, None], b, a), np.where(swap[:, None], a, b)
    edges, points = [np.arange(len(a))], [a]
    for axis in (0, 1):
        first, last = np.minimum(lo, hi)[:, axis] // cell + 1, -(-np.maximum(lo, hi)[:, axis] // cell) - 1
        row, line = _spread(first, np.maximum(last, first - 1))
        run = (hi - lo)[row]
        t = (line * cell - lo[row, axis]).astype(np.longdouble) / run[:, axis].astype(np.longdouble)
        x = lo[row] + np.rint(t[:, None] * run).astype(np.int64)
        x[:, axis] = line * cell
        edges.append(row)
        points.append(x)
    edge, point = np.concatenate(edges), np.concatenate(points)
    along = ((point - a[edge]).astype(float) * (b - a)[edge]).sum(axis=1)
    order = np.lexsort((along, edge))
    out = point[order]
    return out[(out != np.roll(out, 1, axis=0)).any(axis=1)]


def cells(ring: np.ndarray, cell: int) -> list[tuple[int, int, np.ndarray]]:
    """(column, row, open ring) for each cell that a ring, split at the lines, reaches into; halves first, so a long ring is not walked for each cell."""
    out = []
    lo, hi = ring.min(axis=0) // cell, -(-ring.max(axis=0) // cell)
    stack = [(ring, lo, np.maximum(hi, lo + 1))]
    while stack:
        r, lo, hi = stack.pop()
        span = hi - lo
        if len(r) < 3:
            continue
        if (span == 1).all():
            out.append((int(lo[0]), int(lo[1]), r))
            continue
        axis = int(span.argmax())
        mid = int(lo[axis] + span[axis] // 2)
        for upper in (False, True):
            l, h = lo.copy(), hi.copy()
            (l if upper else h)[axis] = mid
            stack.append((clip_half(r, axis, mid * cell, upper), l, h))
    return out
