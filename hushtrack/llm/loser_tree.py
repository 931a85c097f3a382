"""Merging of front-coded sorted runs with loser trees, many ranges of keys at a time.

Keys are byte strings of one length, held as big-endian 64-bit words. Each run knows how long a prefix
each key shares with the one before it. A loser tree keeps, for every key that waits, the length of
the prefix that it shares with the last key put out; of two keys the one that shares more is smaller,
and only if both share equally much are they compared, from that place on. So no known prefix is
compared again. The key range is cut into lanes, and numpy takes one step of all lanes' trees at once.
"""

from __future__ import annotations

import numpy as np

_LANES = 4096
_FAN_IN = 256


def shared_bytes(x: np.ndarray) -> np.ndarray:
    """Number of leading zero bytes of non-zero 64-bit words."""
    out = np.zeros(len(x), np.int16)
    for bits in range(8, 64, 8):
        out += x < np.uint64(1 << (64 - bits))
    return out


def prefixes(words: np.ndarray, length: int) -> np.ndarray:
    """For sorted keys (one column each), bytes shared with the key before; 0 for the first."""
    out = np.zeros(words.shape[1], np.int16)
    if words.shape[1] < 2:
        return out
    rest = np.arange(1, words.shape[1])
    for k in range(words.shape[0]):
        x = words[k, rest] ^ words[k, rest - 1]
        differ = x != 0
        out[rest[differ]] = 8 * k + shared_bytes(x[differ])
        rest = rest[~differ]
    out[rest] = length
    return out


def quantiles(sample: np.ndarray, parts: int) -> np.ndarray:
    """Rows of two words that cut a sample of first 16 bytes in so many equal parts, or fewer."""
    sample = sample[np.lexsort((sample[:, 1], sample[:, 0]))]
    if not len(sample):
        return sample.reshape(0, 2)
    return np.unique(sample[np.linspace(0, len(sample), parts + 1).astype(int)[1:-1]], axis=0)


def cuts(words: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Where sorted keys pass the pivots, from 0 to their number."""
    n = words.shape[1]
    if not len(pivots):
        return np.array([0, n])
    lo, hi = np.searchsorted(words[0], pivots[:, 0], "left"), np.searchsorted(words[0], pivots[:, 0], "right")
    inner = lo.copy()
    for k in np.flatnonzero(lo < hi):
        inner[k] += np.searchsorted(words[1, lo[k] : hi[k]], pivots[k, 1])
    return np.concatenate(([0], inner, [n])).astype(np.int64)


def merge(words: np.ndarray, lcp: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge runs that lie one after the other (run r from starts[r] to starts[r + 1]).

    Gives the order of the keys and the bytes that each shares with the one before in that order.
    """
    order = np.arange(words.shape[1])
    while len(starts) > 2:
        new_starts = [0]
        parts, shared = [], []
        for k in range(0, len(starts) - 1, _FAN_IN):
            ends = starts[k : k + _FAN_IN + 1]
            lo, hi = int(ends[0]), int(ends[-1])
            if len(ends) == 2:
                at, common = np.arange(lo, hi), lcp[lo:hi]
            else:
                at, common = _merge_some(words[:, lo:hi], lcp[lo:hi], np.asarray(ends) - lo, length)
                at = at + lo
            parts.append(at)
            shared.append(common)
            new_starts.append(hi)
        step = np.concatenate(parts)
        words, lcp, order = words[:, step], np.concatenate(shared), order[step]
        starts = np.array(new_starts)
    return order, lcp


def _compare(words, length, la, pa, lb, pb):
    """Whether a comes first, and what the later one shares with it; lengths -1: run at its end."""
    first, common = la >= lb, np.minimum(la, lb)
    tie = np.flatnonzero((la == lb) & (la >= 0))
    if len(tie):
        i, j = pa[tie], pb[tie]
        k = la[tie].astype(np.int64) >> 3
        flat, n = words.reshape(-1), words.shape[1]
        left = np.arange(len(tie))
        result, where = np.ones(len(tie), bool), np.full(len(tie), length, np.int16)
        while len(left):
            row = k[left] * n
            x, y = flat.take(row + i[left]), flat.take(row + j[left])
            differ = x != y
            d = left[differ]
            result[d] = x[differ] < y[differ]
            where[d] = 8 * k[d] + shared_bytes(x[differ] ^ y[differ])
            left = left[~differ]
            k[left] += 1
            left = left[k[left] < words.shape[0]]
        first[tie], common[tie] = result, where
    return first, common


def _merge_some(words, lcp, starts, length):
    words = np.ascontiguousarray(words)
    total, runs = words.shape[1], len(starts) - 1
    size = 1 << max(1, (runs - 1).bit_length())
    lanes = max(1, min(_LANES, total // 64, (4 << 20) // size))
    pivots = quantiles(words[:2, :: max(1, total // (16 * lanes))].T, lanes)
    lanes = len(pivots) + 1
    at = np.zeros((lanes, size), np.int64)
    end = np.zeros((lanes, size), np.int64)
    for r in range(runs):
        lo, hi = int(starts[r]), int(starts[r + 1])
        cut = lo + cuts(words[:, lo:hi], pivots)
        at[:, r], end[:, r] = cut[:-1], cut[1:]
    counts = (end - at).sum(axis=1)
    out_at = np.concatenate(([0], np.cumsum(counts)))[:-1]
    order, common = np.empty(total, np.int64), np.empty(total, np.int16)
    # Build: all keys share nothing with the empty string before them.
    lane = np.arange(lanes)
    who = np.broadcast_to(np.arange(size), (lanes, size)).copy()
    share = np.where(at < end, 0, -1).astype(np.int16)
    loser, loser_share = np.zeros((lanes, size), np.int64), np.full((lanes, size), -1, np.int16)
    width = size
    while width > 1:
        a, b, la, lb = who[:, 0::2].ravel(), who[:, 1::2].ravel(), share[:, 0::2].ravel(), share[:, 1::2].ravel()
        rows = np.repeat(lane, width // 2)
        first, both = _compare(words, length, la, at[rows, a], lb, at[rows, b])
        width //= 2
        loser[:, width : 2 * width] = np.where(first, b, a).reshape(lanes, width)
        loser_share[:, width : 2 * width] = both.reshape(lanes, width)
        who, share = np.where(first, a, b).reshape(lanes, width), np.where(first, la, lb).reshape(lanes, width)
    win, win_share = who[:, 0], share[:, 0]
    live = np.flatnonzero(win_share >= 0)
    # Places in the trees are counted over all lanes from here on.
    at, end, loser, loser_share = (x.reshape(-1) for x in (at, end, loser, loser_share))
    while len(live):
        row, w = live * size, win[live]
        leaf = row + w
        place = at.take(leaf)
        order[out_at[live]], common[out_at[live]] = place, win_share[live]
        out_at[live] += 1
        place += 1
        at[leaf] = place
        more = place < end.take(leaf)
        share_now = np.full(len(live), -1, np.int16)
        share_now[more] = lcp[place[more]]
        node = (w + size) >> 1
        while True:
            spot = row + node
            other, other_share = loser.take(spot), loser_share.take(spot)
            other_place = at.take(row + other)
            first, both = _compare(words, length, share_now, place, other_share, other_place)
            loser[spot] = np.where(first, other, w)
            loser_share[spot] = both
            w = np.where(first, w, other)
            share_now = np.where(first, share_now, other_share)
            place = np.where(first, place, other_place)
            node = node >> 1
            if node[0] == 0:
                break
        win[live], win_share[live] = w, share_now
        live = live[share_now >= 0]
    # The first key of a lane shares what it shares with the last of the lane before.
    heads = np.concatenate(([0], np.cumsum(counts)))[:-1]
    heads = heads[(counts > 0) & (heads > 0)]
    for k in range(words.shape[0]):
        x = words[k, order[heads]] ^ words[k, order[heads - 1]]
        differ = x != 0
        common[heads[differ]] = 8 * k + shared_bytes(x[differ])
        heads = heads[~differ]
    common[heads] = length
    return order, common
