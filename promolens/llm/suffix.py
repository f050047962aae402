"""Suffix arrays in numpy: Larsson-Sadakane refinement, Kasai common prefixes, merging by binary search."""

from __future__ import annotations

import numpy as np

from promolens.llm.common import eight_bytes

#: Bytes of one suffix array: ranks and positions then fit in 21 bits, three of them in a sort key.
SHARD = 1 << 20
_BITS = np.uint64(21)
_LOW = np.uint64((1 << 21) - 1)


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in order; at most 2**21 - 2 bytes.

    The first ranks come from five bytes. Each round then sorts only the groups that are still
    tied, by the rank of what stands ``h`` bytes further on, and doubles ``h``. Keys hold group,
    next rank and position, so a plain sort of integers does it.
    """
    n = data.size
    if n > int(_LOW) - 1:
        raise ValueError("a shard holds at most 2**21 - 2 bytes")
    at = np.arange(n, dtype=np.uint64)
    first = eight_bytes(data).byteswap() >> np.uint64(24)  # five bytes, the first one highest
    short = np.minimum(np.arange(n, 0, -1), 5).astype(np.uint64)  # ends of the data sort before zeros
    order = np.sort((first << np.uint64(21)) | at) & _LOW
    sa = order.astype(np.int64)
    if n > 1:  # among equal five bytes, fewer real ones come first
        tail = np.arange(max(0, n - 5), n)
        head = first[sa]
        for p in tail[::-1]:
            lo, hi = np.searchsorted(head, first[p]), np.searchsorted(head, first[p], "right")
            block = sa[lo:hi]
            sa[lo:hi] = block[np.argsort(short[block], kind="stable")]
    key = (first[sa] << np.uint64(3)) | short[sa]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    heads = np.flatnonzero(new)
    rank = np.empty(n + 1, np.uint64)
    rank[n] = 0
    rank[sa] = heads[np.cumsum(new) - 1] + 1  # rank: place of the group's first member, from 1
    h = 5
    # places in sa that belong to groups of two or more
    size = np.diff(np.append(heads, n))
    tied = np.flatnonzero(np.repeat(size > 1, size))
    while tied.size:
        pos = sa[tied]
        ahead = rank[np.minimum(pos + h, n)]
        group = rank[pos]
        key = np.sort((group << (_BITS + _BITS)) | (ahead << _BITS) | pos.astype(np.uint64))
        pos = (key & _LOW).astype(np.int64)
        sa[tied] = pos
        both = key >> _BITS
        new = np.ones(tied.size, bool)
        new[1:] = both[1:] != both[:-1]
        heads = np.flatnonzero(new)
        rank[pos] = tied[heads[np.cumsum(new) - 1]] + 1
        size = np.diff(np.append(heads, tied.size))
        tied = tied[np.repeat(size > 1, size)]
        h *= 2
    return sa


def common_prefixes(data: np.ndarray, sa: np.ndarray, most: int, lanes: int = 0) -> np.ndarray:
    """Kasai: bytes (at most ``most``) that each suffix shares with the one before it in order.

    Walking the text, the next suffix shares at least one byte less with its own neighbour than
    this one does, so comparing goes on where it stopped. Many stretches of the text are walked
    side by side, each as one lane of numpy arrays, eight bytes a comparison.
    """
    n = sa.size
    out = np.zeros(n, np.int16)
    if n < 2:
        return out
    words = eight_bytes(data)
    before = np.empty(n, np.int64)
    before[sa[0]] = -1
    before[sa[1:]] = sa[:-1]
    lanes = lanes or max(1, n // 128)
    stretch = -(-n // lanes)
    begin = np.arange(0, n, stretch)
    common = np.zeros(begin.size, np.int64)
    shared = np.zeros(n, np.int16)
    for step in range(stretch):
        if begin[-1] + step >= n:
            begin, common = begin[:-1], common[:-1]
        i = begin + step
        j = before[i]
        common = np.where(j < 0, 0, np.maximum(common - 1, 0))
        live = np.flatnonzero((j >= 0) & (common < most))
        while live.size:
            a, b = i[live] + common[live], j[live] + common[live]
            room = n - np.maximum(a, b)
            inside = room > 0
            a, b, live, room = a[inside], b[inside], live[inside], room[inside]
            differ = words[a] ^ words[b]
            low = differ & (~differ + np.uint64(1))  # the lowest bit that differs
            equal = np.where(differ == 0, 8, np.frexp(low.astype(np.float64))[1] - 1 >> 3)
            more = np.minimum(equal, room)
            common[live] += more
            live = live[(more == 8) & (common[live] < most)]
        shared[i] = np.minimum(common, most)
    out[:] = shared[sa]
    return out


def window_groups(data: np.ndarray, start_owner: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups of equal ``width``-byte strings among marked starts.

    starts marks the positions that start a string; start_owner holds their owners, and the
    largest number elsewhere, which an owner may be as well.
    Returns, for each marked start in suffix order, its position, its group, and the smallest
    owner of each group.
    """
    sa = suffix_array(data)
    lcp = common_prefixes(data, sa, width)
    marked = starts[sa]
    group = np.cumsum(lcp < width) - 1
    least = np.minimum.reduceat(start_owner[sa], np.flatnonzero(np.r_[True, np.diff(group) > 0])) if sa.size else np.zeros(0, np.int64)
    group = group[marked]
    used, group = np.unique(group, return_inverse=True)
    return sa[marked], group, least[used]


def _strings(data: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Strings as fixed-width bytes with a mark behind, so that zeros at the end count."""
    out = np.ones((starts.size, width + 1), np.uint8)
    for k in range(width):
        out[:, k] = data[starts + k]
    return out.view(f"S{width + 1}").ravel()


def smallest_owners(shards: list[tuple[np.ndarray, np.ndarray, np.ndarray]], width: int) -> list[np.ndarray]:
    """For each shard (bytes, owner of each string start, where strings start) the smallest owner of each start's string in any shard.

    Each shard has its own suffix array. Its distinct strings, in suffix order, are then looked
    up in the other shards' by binary search, and the smaller owner is taken over.
    """
    none = np.iinfo(np.int64).max
    parts = [window_groups(data, owner, starts, width) for data, owner, starts in shards]
    if len(shards) > 1:
        runs = []
        for (data, _, _), (pos, group, _) in zip(shards, parts, strict=True):
            first = np.unique(group, return_index=True)[1]
            runs.append(_strings(data, pos[first], width))
        best = [least.copy() for _, _, least in parts]
        for a in range(len(runs)):
            for b in range(a + 1, len(runs)):
                if not runs[a].size or not runs[b].size:
                    continue
                at = np.minimum(np.searchsorted(runs[b], runs[a]), runs[b].size - 1)
                hit = np.flatnonzero(runs[b][at] == runs[a])
                low = np.minimum(parts[a][2][hit], parts[b][2][at[hit]])
                best[a][hit] = np.minimum(best[a][hit], low)
                best[b][at[hit]] = np.minimum(best[b][at[hit]], low)
        parts = [(pos, group, least) for (pos, group, _), least in zip(parts, best, strict=True)]
    out = []
    for (_, owner, _), (pos, group, least) in zip(shards, parts, strict=True):
        found = np.full(owner.size, none)
        found[pos] = least[group]
        out.append(found)
    return out
