"""Blocks of sets compared all with all inside one task."""

from __future__ import annotations

import numpy as np


class SetBlock:
    """Sets of numbers as arrays: ``pid``, component ``root``, sizes and a 0/1 matrix over the numbers that several have."""

    def __init__(self, pid, comp, items):
        self.pid, self.root = pid, comp.copy()
        self.size = np.array([len(x) for x in items], np.float32)
        flat = np.concatenate(items) if len(items) else np.zeros(0, np.int64)
        _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
        held = np.flatnonzero(count > 1)                        # the others are in no intersection
        place = np.full(len(count), -1)
        place[held] = np.arange(len(held))
        self.row, self.col = np.repeat(np.arange(len(items)), self.size.astype(np.int64)), place[code]
        self.row, self.col = self.row[self.col >= 0], self.col[self.col >= 0]
        by = np.argsort(self.col, kind="stable")
        self.row, self.col = self.row[by].astype(np.int32), self.col[by].astype(np.int32)
        self.width = len(held)

    def common(self, i, j, a, b):
        """Sizes of the intersections of the sets ``i..j`` with the sets ``a..b``."""
        out = np.zeros((j - i, b - a), np.float32)
        for s in range(0, self.width, 1024):
            x, y = (np.zeros((n, min(1024, self.width - s)), np.float32) for n in (j - i, b - a))
            at = slice(*np.searchsorted(self.col, [s, s + 1024]))
            row, col = self.row[at], self.col[at] - s
            for m, lo, hi in ((x, i, j), (y, a, b)):
                use = (row >= lo) & (row < hi)
                m[row[use] - lo, col[use]] = 1
            out += x @ y.T
        return out

    def links(self, num: int, den: int, halves: int | None = None):
        """Links ``(pid, pid)`` of a Jaccard similarity of ``num / den`` or more that join components; with ``halves`` only those from the first ``halves`` sets to the others."""
        n = len(self.pid)
        out = []
        rows, cols = (n, (0, n)) if halves is None else (halves, (halves, n))
        for i in range(0, rows, 512):
            j = min(rows, i + 512)
            both = self.common(i, j, *cols)
            near = den * both >= num * (self.size[i:j, None] + self.size[None, cols[0]:cols[1]] - both)
            for r in range(j - i):
                other = cols[0] + np.flatnonzero(near[r] & (self.root[cols[0]:cols[1]] != self.root[i + r]))
                for root in np.unique(self.root[other]):
                    out.append((self.pid[i + r], self.pid[other[self.root[other] == root][0]]))
                if len(other):
                    merged = np.append(np.unique(self.root[other]), self.root[i + r])
                    self.root[np.isin(self.root, merged)] = merged.min()
        return out


SMALL = 32             # groups up to this size are compared many at a time
GATHER = 4000          # sets gathered for that
_CHUNK = 1 << 19       # numbers of the pairs compared at once


def small_links(group, comp, pid, items, num: int, den: int) -> list:
    """Links of many small groups at once: ``(pid, pid)`` of every pair of one group, of different components and a
    Jaccard similarity of ``num / den`` or more, each pair once.  Members of a group stand together."""
    size = np.array([len(x) for x in items], np.int64)
    pairs = []
    for o in range(1, SMALL):
        i = np.flatnonzero((group[o:] == group[:-o]) & (comp[o:] != comp[:-o]))
        if not len(i):
            if not (group[o:] == group[:-o]).any():
                break
            continue
        pairs.append(np.stack([i, i + o], axis=1))
    if not pairs:
        return []
    pairs = np.concatenate(pairs)
    a, b = size[pairs[:, 0]], size[pairs[:, 1]]
    pairs = pairs[den * np.minimum(a, b) >= num * np.maximum(a, b)]
    _, code = np.unique(pid, return_inverse=True)              # the same two lines meet in several groups
    low, high = np.minimum(*code[pairs].T), np.maximum(*code[pairs].T)
    pairs = pairs[np.unique(low * (len(pid) + 1) + high, return_index=True)[1]]
    out = []
    at = np.cumsum(size[pairs].sum(axis=1))
    for lo, hi in zip(*_cuts(at)):
        some = pairs[lo:hi]
        keys = np.concatenate([items[m] for m in some.ravel()]).view(np.uint64)
        of = np.repeat(np.repeat(np.arange(len(some)), 2), size[some.ravel()])
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + (of.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
        by = np.argsort(keys, kind="stable")
        same = (keys[by][1:] == keys[by][:-1]) & (of[by][1:] == of[by][:-1])
        common = np.bincount(of[by][1:][same], minlength=len(some))
        near = den * common >= num * (size[some].sum(axis=1) - common)
        out += [(pid[i], pid[j]) for i, j in some[near]]
    return out


def _cuts(at):
    """Ranges of pairs whose numbers stay near ``_CHUNK``."""
    if not len(at):
        return [], []
    edges = np.unique(np.append(np.searchsorted(at, np.arange(_CHUNK, at[-1], _CHUNK)), [0, len(at)]))
    return edges[:-1], edges[1:]


def group_links(parts, keys: list[str], name: str, num: int, den: int):
    """Links of the groups of sorted batches (``keys``, ``own``, ``comp``, ``items`` and the members' ``name``); ``x`` and ``y``
    are the two blocks that a group joins."""
    import pandas as pd

    def flush(pdf):
        pdf = pdf.reset_index(drop=True)
        cols = [pdf[k].to_numpy() for k in keys]
        new = np.zeros(len(pdf), bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        group = np.cumsum(new)
        count = np.bincount(group)
        pid, comp, items = pdf[name].to_numpy(np.int64), pdf["comp"].to_numpy(np.int64), [np.asarray(i, np.int64) for i in pdf["items"]]
        few = np.flatnonzero(count[group] <= SMALL)
        found = small_links(group[few], comp[few], pid[few], [items[i] for i in few], num, den) if len(few) else []
        for g in np.flatnonzero(count > SMALL):
            at = np.flatnonzero(group == g)
            own, x, y = pdf["own"].to_numpy()[at], pdf["x"].iat[at[0]], pdf["y"].iat[at[0]]
            at = at[np.argsort(own, kind="stable")]
            found += SetBlock(pid[at], comp[at], [items[i] for i in at]).links(num, den, None if x == y else int((own == x).sum()))
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    for pdf in whole_groups(parts, keys):
        yield flush(pdf)


def whole_groups(parts, keys: list[str]):
    """Batches sorted by ``keys``, put together until about ``GATHER`` rows of whole groups are there."""
    import pandas as pd
    kept = None
    for pdf in parts:
        kept = pdf if kept is None else pd.concat([kept, pdf], ignore_index=True)
        last = np.ones(len(kept), bool)
        for k in keys:
            last &= (kept[k] == kept[k].iat[-1]).to_numpy()
        if len(kept) >= GATHER and not last.all():
            yield kept[~last]                                   # the last group may go on in the next batch
            kept = kept[last]
    if kept is not None and len(kept):
        yield kept


def pairs_between(group, part):
    """Arrays ``(i, j)`` of all pairs of rows of one ``group`` and different ``part``, some at a time; rows are sorted by both."""
    n = len(group)
    if not n:
        return
    new = group[1:] != group[:-1]
    end = lambda starts: np.append(np.flatnonzero(starts) + 1, n)[np.concatenate([[0], np.cumsum(starts)])]
    after, stop = end(new | (part[1:] != part[:-1])), end(new)
    count = stop - after
    at = np.cumsum(count)
    for lo, hi in zip(*_cuts(at)):
        c = count[lo:hi]
        i = np.repeat(np.arange(lo, hi), c)
        if len(i):
            yield i, after[i] + np.arange(len(i)) - np.repeat(np.cumsum(c) - c, c)
