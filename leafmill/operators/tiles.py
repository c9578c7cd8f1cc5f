"""Counting and matching by tiles: rows that may meet come to one tile, and arrays count there without a row per pair."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ROWS, PAIRS = 200_000, 1_000_000  # rows of whole groups handled at once, pairs held at once


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of about ROWS rows from batches in which equal keys are next to each other; no group is cut."""
    held, n, least = [], 0, ROWS
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= least:
            rows = pa.Table.from_batches(held).combine_chunks()
            cut = int(np.flatnonzero(np.diff(group_codes(rows, keys), prepend=0))[-1:].sum())
            if cut:
                yield rows.slice(0, cut)
            held, n = rows.slice(cut).to_batches(), rows.num_rows - cut
            least = max(ROWS, 2 * n)
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def group_codes(rows: pa.Table, keys: list[str]) -> np.ndarray:
    """Numbers of the runs of equal keys, from 0; a null equals a null."""
    new = np.zeros(rows.num_rows, bool)
    for key in keys:
        kinds = pc.dictionary_encode(rows[key].combine_chunks(), null_encoding="encode")
        new[1:] |= np.diff(kinds.indices.to_numpy()) != 0
    return np.cumsum(new)


def array(rows: pa.Table, name: str) -> np.ndarray:
    return rows[name].to_numpy()


def spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the range, place) for each place of the ranges [lo, hi)."""
    n = np.maximum(hi - lo, 0)
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + lo[which]


def chunks(n: np.ndarray) -> Iterator[slice]:
    """Slices of rows that have about PAIRS pairs each, ``n`` a row."""
    at, ends = 0, np.cumsum(n)
    while at < len(n):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
        yield slice(at, end)
        at = end


class Ranks:
    """How many codes below a bound are in a range of places: a wavelet matrix, one pass a bit."""

    def __init__(self, codes: np.ndarray, top: int):
        self.levels = []
        for bit in reversed(range(int(top).bit_length())):
            one = (codes >> bit & 1).astype(bool)
            self.levels.append((bit, np.concatenate([[0], np.cumsum(~one)])))
            codes = np.concatenate([codes[~one], codes[one]])

    def below(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        found = np.zeros(len(lo), np.int64)
        for bit, zeros in self.levels:
            a, b, one = zeros[lo], zeros[hi], (bound >> bit & 1).astype(bool)
            found += np.where(one, b - a, 0)
            lo, hi = np.where(one, zeros[-1] + lo - a, a), np.where(one, zeros[-1] + hi - b, b)
        return found


def near_counts(tile: np.ndarray, ordinal: np.ndarray, x: np.ndarray, y: np.ndarray, area: np.ndarray, own: np.ndarray, radius: float) -> np.ndarray:
    """For each ``own`` row: the tile's rows of another ordinal within ``radius`` whose area is within twice and half.

    A tile is cut into strips by x. Within a strip the places by y that are surely in reach are a range, counted by ranks;
    only places that the strip's width leaves open are looked at one by one. Where x has few values nothing is left open.
    """
    slack = 1e-7 * radius
    areas, code = np.unique(area, return_inverse=True)
    low, high = np.searchsorted(areas, area / 2, "left"), np.searchsorted(areas, area * 2, "right")
    high = np.maximum(low, high)
    # strips: the distinct x of a tile, neighbours joined where there are many
    at = np.lexsort((x, tile))
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(tile[at]) != 0) | (np.diff(x[at]) != 0)
    first = np.searchsorted(tile[at], np.arange(tile.max() + 2))  # tiles' first rows, then the end
    rank = np.cumsum(new) - 1
    start = rank[first[:-1]]
    kinds = np.diff(np.append(start, rank[-1] + 1))
    most = np.maximum(64, 2 * np.sqrt(np.diff(first))).astype(np.int64)
    t = tile[at]
    local = (rank - start[t]) * np.minimum(kinds, most)[t] // kinds[t]
    begun = np.concatenate([[0], np.cumsum(np.minimum(kinds, most))])[:-1]
    strip = np.empty(len(at), np.int64)
    strip[at] = np.unique(begun[t] + local, return_inverse=True)[1]
    west, east = np.full(strip.max() + 1, np.inf), np.full(strip.max() + 1, -np.inf)
    np.minimum.at(west, strip, x)
    np.maximum.at(east, strip, x)
    strip_tile = np.zeros(len(west), np.int64)
    strip_tile[strip] = tile
    x0, y0 = np.full(tile.max() + 1, np.inf), np.full(tile.max() + 1, np.inf)
    np.minimum.at(x0, tile, x)
    np.minimum.at(y0, tile, y)
    rx, ry = x - x0[tile], y - y0[tile]
    wide, tall = rx.max() + 4 * radius, ry.max() + 4 * radius
    order = np.lexsort((y, strip))
    key = (strip * tall + ry)[order]
    ranks = Ranks(code[order], len(areas))
    mine = np.flatnonzero(own)
    place = tile[mine] * wide + rx[mine]
    lo = np.searchsorted(strip_tile * wide + east - x0[strip_tile], place - radius - slack, "left")
    hi = np.searchsorted(strip_tile * wide + west - x0[strip_tile], place + radius + slack, "right")
    near = np.zeros(len(mine), np.int64)

    def one_by_one(which: np.ndarray, begin: np.ndarray, end: np.ndarray, rows: np.ndarray, sign: int) -> None:
        for part in chunks(np.maximum(end - begin, 0)):
            w, p = spread(begin[part], end[part])
            w, other = which[part][w], rows[p]
            me = mine[w]
            hit = (np.hypot(x[me] - x[other], y[me] - y[other]) <= radius) & (low[me] <= code[other]) & (code[other] < high[me])
            np.add.at(near, w[hit], sign)

    for part in chunks(hi - lo):
        w, s = spread(lo[part], hi[part])
        w += part.start
        me = mine[w]
        nearest = np.maximum(0, np.maximum(west[s] - x[me], x[me] - east[s]))
        farthest = np.maximum(x[me] - west[s], east[s] - x[me])
        outer = np.sqrt(np.maximum(0, radius**2 - nearest**2)) + slack
        inner = np.sqrt(np.maximum(0, radius**2 - farthest**2)) - slack
        q = s * tall + ry[me]
        a, d = np.searchsorted(key, q - outer, "left"), np.searchsorted(key, q + outer, "right")
        b, c = np.searchsorted(key, q - inner, "left"), np.searchsorted(key, q + inner, "right")
        sure = (inner > 0) & (farthest < radius) & (b <= c)
        b, c = np.where(sure, b, d), np.where(sure, c, d)
        np.add.at(near, w, ranks.below(b, c, high[me]) - ranks.below(b, c, low[me]))
        for begin, end in ((a, b), (c, d)):
            left = begin < end
            one_by_one(w[left], begin[left], end[left], order, 1)
    # the rows of the same ordinal, itself among them
    same = np.unique(tile * (ordinal.max() + 1) + ordinal, return_inverse=True)[1]
    order = np.argsort(same, kind="stable")
    one_by_one(np.arange(len(mine)), np.searchsorted(same[order], same[mine], "left"), np.searchsorted(same[order], same[mine], "right"), order, -1)
    return near


class Near:
    """Points by cells of a grid, about two to a cell: which of them are within a distance of other points."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rows: np.ndarray):
        self.x0, self.y0 = x[rows].min(), y[rows].min()
        wide, tall = np.ptp(x[rows]), np.ptp(y[rows])
        self.size = max(np.sqrt(wide * tall * 2 / len(rows)), max(wide, tall) * 2 / len(rows)) or 1.0
        self.nx, self.ny = int(wide / self.size) + 1, int(tall / self.size) + 1
        cell = self._at(y[rows], self.y0) * self.nx + self._at(x[rows], self.x0)
        order = np.argsort(cell, kind="stable")
        self.rows, self.first = rows[order], np.searchsorted(cell[order], np.arange(self.nx * self.ny + 1))

    def _at(self, v: np.ndarray, origin: float) -> np.ndarray:
        return np.floor((v - origin) / self.size).astype(np.int64)

    def around(self, x: np.ndarray, y: np.ndarray, rings: int) -> tuple[np.ndarray, np.ndarray]:
        """(number of the point, row): all rows within ``rings`` cells' sizes of each point, and some more."""
        cx, cy = self._at(x, self.x0), self._at(y, self.y0)
        w, row = spread(np.maximum(cy - rings, 0), np.minimum(cy + rings + 1, self.ny))
        west, east = np.clip(cx - rings, 0, self.nx)[w], np.clip(cx + rings + 1, 0, self.nx)[w]
        v, place = spread(self.first[row * self.nx + west], self.first[row * self.nx + np.maximum(west, east)])
        return w[v], self.rows[place]


def greedy(left: dict[str, np.ndarray], right: dict[str, np.ndarray], reach: float, area_ratio: float, few: int = 4) -> list[tuple[int, int, float]]:
    """Matches (left, right, distance) of two sides in order of their ordinals: the largest first, each with its nearest free partner.

    Of a run of lefts the nearest of all free partners are found at once; then each takes the first one that is free
    still. A left whose list is used up before ``reach`` looks further by itself, so the result is that of one loop.
    """
    free = bytearray(b"\1") * len(right["x"])
    is_free = np.frombuffer(free, np.uint8)
    order = np.lexsort((np.arange(len(left["x"])), -left["area"]))
    left, out, at = {c: v[order] for c, v in left.items()}, [], 0

    def lists(grid: Near, who: np.ndarray, rings: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """(left, right, distance) by left, distance and ordinal, and the distance up to which they are complete."""
        sure, parts = rings * grid.size * (1 - 1e-9), []
        for c in chunks(np.full(len(who), 2 * (2 * rings + 1) ** 2)):
            w, r = grid.around(left["x"][who[c]], left["y"][who[c]], rings)
            me = who[c][w]
            a, b = left["area"][me], right["area"][r]
            dx, dy = left["x"][me] - right["x"][r], left["y"][me] - right["y"][r]
            keep = is_free[r].astype(bool) & (np.hypot(dx, dy) <= min(sure, reach * (1 + 1e-9))) & (np.minimum(a, b) >= area_ratio * np.maximum(a, b))
            d = np.array(list(map(math.hypot, dx[keep].tolist(), dy[keep].tolist())), float)
            near = (d <= reach) & (d <= sure * (1 - 1e-12))
            parts.append((w[keep][near] + c.start, r[keep][near], d[near]))
        w, r, d = (np.concatenate(v) for v in zip(*parts, strict=True))
        by = np.lexsort((r, d, w))
        return w[by], r[by], d[by], sure

    while at < len(order):
        end = min(len(order), at + min(8192, max(64, int(is_free.sum()) // 16)))
        low, high = left["area"][end - 1], left["area"][at]
        bound = max(abs(low), abs(high)) * 1e-9
        rows = np.flatnonzero((is_free > 0) & (right["area"] >= min(area_ratio * low, low) - bound) & (right["area"] <= max(high / area_ratio, high) + bound))
        if not len(rows):
            at = end
            continue
        grid = Near(right["x"], right["y"], rows)
        found, seen, open_, rings = {}, {}, np.arange(at, end), 1
        while len(open_):
            w, r, d, sure = lists(grid, open_, rings)
            n = np.bincount(w, minlength=len(open_))
            done = (n >= few) | (sure > reach)
            starts = (np.cumsum(n) - n).tolist()
            r, d, n = r.tolist(), d.tolist(), n.tolist()
            for k in np.flatnonzero(done).tolist():
                found[int(open_[k])] = (r, d, starts[k], starts[k] + n[k])
                seen[int(open_[k])] = rings if sure <= reach else 0
            open_, rings = open_[~done], rings * 2
        for i in range(at, end):
            r, d, a, b = found[i]
            rings = seen[i]
            while True:
                k = next((k for k in range(a, b) if free[r[k]]), None)
                if k is not None:
                    free[r[k]] = 0
                    out.append((int(order[i]), r[k], d[k]))
                if k is not None or not rings:
                    break
                rings *= 2
                _, far, gap, sure = lists(grid, np.array([i]), rings)
                r, d, a, b = far.tolist(), gap.tolist(), 0, len(far)
                rings = rings if sure <= reach else 0
        at = end
    return out


def lone_partners(tile: np.ndarray, side: np.ndarray, own: np.ndarray, box: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, how many, partner, IoU) of ``own`` rows with boxes of the other side at ``threshold`` at least: 1, or 2 for more.

    A row is left as soon as it has two. Neighbours by row and left edge are tried first, then all rows that may do.
    """
    left, top, right, bottom = box
    wide, tall, area = right - left, bottom - top, np.maximum(0.0, right - left) * np.maximum(0.0, bottom - top)
    before, after = (1 - threshold) / threshold * (1 + 1e-6) + 1e-9, (1 - threshold) * (1 + 1e-6) + 1e-9
    least = np.full(tile.max() + 1, np.inf), np.full(tile.max() + 1, np.inf)
    for v, low in zip((left, top), least, strict=True):
        np.minimum.at(low, tile, v)
    x, y = left - least[0][tile], top - least[1][tile]
    height = max(np.median(tall) / 4, y.max() / 1000)
    line = np.floor(y / height).astype(np.int64)
    lines, step = line.max() + 1, x.max() + (before + after + 1) * wide.max() + 1e-6
    found = []
    for s in (0, 1):
        me, other = np.flatnonzero(own & (side == s)), np.flatnonzero(side != s)
        if not len(me) or not len(other):
            continue
        band = tile * lines + line
        other = other[np.lexsort((x[other], band[other]))]
        bands = np.unique(band[other])
        key = np.searchsorted(bands, band[other]) * step + x[other]
        n, partner, score = np.zeros(len(me), np.int64), np.full(len(me), -1), np.zeros(len(me))

        def look(open_: np.ndarray, lo: np.ndarray, hi: np.ndarray, me=me, other=other, n=n, partner=partner, score=score) -> None:
            """Adds what the ranges [lo, hi) of ``other`` hold for the rows ``open_``."""
            for part in chunks(np.maximum(hi - lo, 0)):
                w, p = spread(lo[part], hi[part])
                w = open_[part][w]
                a, b = me[w], other[p]
                both = np.maximum(0.0, np.minimum(right[a], right[b]) - np.maximum(left[a], left[b])) * np.maximum(0.0, np.minimum(bottom[a], bottom[b]) - np.maximum(top[a], top[b]))
                with np.errstate(invalid="ignore", divide="ignore"):
                    iou = both / (area[a] + area[b] - both)
                hit = (iou >= threshold) & (tile[a] == tile[b])
                np.add.at(n, w[hit], 1)
                partner[w[hit]], score[w[hit]] = b[hit], iou[hit]

        def places(open_: np.ndarray, offset: int, shift: np.ndarray, edge: str, me=me, key=key, bands=bands) -> np.ndarray:
            """Places of the left edge plus ``shift`` in the line ``offset`` lines below; lines without rows have none."""
            want = tile[me[open_]] * lines + line[me[open_]] + offset
            at = np.searchsorted(bands, want)
            real = (at < len(bands)) & (bands[np.minimum(at, len(bands) - 1)] == want) & (line[me[open_]] + offset >= 0) & (line[me[open_]] + offset < lines)
            return np.where(real, np.searchsorted(key, at * step + np.clip(x[me[open_]] + shift, 0, step * (1 - 1e-9)), edge), 0)

        for reach in (4, 32):
            open_ = np.flatnonzero(n < 2)
            n[open_] = 0
            at = places(open_, 0, np.zeros(len(open_)), "left")
            look(open_, np.maximum(at - reach, 0), np.minimum(at + reach, len(key)))
        open_ = np.flatnonzero(n < 2)
        n[open_] = 0
        up, down = (np.ceil(k * tall[me] / height).astype(np.int64) + 1 for k in (before, after))
        for offset in sorted(range(-int(min(up.max(), lines)), int(min(down.max(), lines)) + 1), key=abs):
            open_ = open_[n[open_] < 2]
            some = open_[(-up[open_] <= offset) & (offset <= down[open_])]
            if len(some):
                w = wide[me[some]]
                look(some, places(some, offset, -before * w - 1e-9, "left"), places(some, offset, after * w + 1e-9, "right"))
        some = n > 0
        found.append((me[some], np.minimum(n[some], 2), partner[some], score[some]))
    return tuple(np.concatenate(v) for v in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3 + (np.zeros(0),)


def line_runs(page: np.ndarray, ordinal: np.ndarray, left: np.ndarray, right: np.ndarray, top: np.ndarray, matched: np.ndarray, cutoff: float, line: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, words, first, last) of each matched row's run: the rows at its two ends, and how many words it has."""
    at = np.lexsort((top, page))
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(page[at]) != 0) | ~(np.diff(top[at]) <= line)
    group = np.cumsum(new) - 1
    ends = np.append(np.flatnonzero(new)[1:], len(at)) - 1
    drifts = top[at][ends] - top[at][new] > line
    line_of = np.empty(len(at), np.int64)
    line_of[at] = group
    at = np.lexsort((ordinal, left, line_of))
    group = line_of[at]
    apart = np.ones(len(at), bool)
    apart[1:] = (np.diff(group) != 0) | (left[at[1:]] - right[at[:-1]] > cutoff)
    begin = np.flatnonzero(apart)
    end, run = np.append(begin[1:], len(at)), np.cumsum(apart) - 1
    place = np.flatnonzero(matched[at] & ~drifts[group])
    lo, hi = begin[run[place]], end[run[place]] - 1
    found = [(at[place], hi - lo + 1, at[lo], at[hi])]
    for g in np.flatnonzero(drifts):
        rows = at[slice(*np.searchsorted(group, [g, g + 1]))].tolist()
        x, r, t = (dict(zip(rows, v[rows].tolist(), strict=True)) for v in (left, right, top))
        walked = []
        for k in np.flatnonzero(matched[rows]).tolist():
            first = last = rows[k]
            n = 1
            for i in rows[k + 1 :]:
                if abs(t[i] - t[last]) <= line:
                    if x[i] - r[last] > cutoff:
                        break
                    last, n = i, n + 1
            for i in reversed(rows[:k]):
                if abs(t[i] - t[first]) <= line:
                    if x[first] - r[i] > cutoff:
                        break
                    first, n = i, n + 1
            walked.append((rows[k], n, first, last))
        if walked:
            found.append(tuple(np.array(walked).T))
    return tuple(np.concatenate(v) for v in zip(*found, strict=True))
