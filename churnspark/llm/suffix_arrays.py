"""Suffix arrays of byte blocks and the anchors that bring equal passages to one block."""

from __future__ import annotations

import numpy as np

from churnspark.llm.shingles import BYTE_HASH, MULTIPLIER, blocks, inverse, mix, powers

#: Bytes of the hashed gram at an anchor.
GRAM = 100
SECOND = np.uint64(0xD6E8FEB86659FD93)


def _sums(values: np.ndarray, base: np.uint64) -> np.ndarray:
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(len(values), base), out=out[1:])
    return out


def anchors(texts: list[bytes], width: int):
    """Splits the starts of the ``width``-byte strings of each text into runs with one anchor.

    The anchor of a string is the place of its gram of lowest hash (the last of equal ones), so
    equal strings have equal grams at equal distances. Yields arrays of one block of texts: text
    number, first start, last start, anchor (bytes in the text), hash of the gram, and hash of all
    bytes of the run's strings with the anchor's place among them.
    """
    shift = width - GRAM
    for first, last in blocks(texts):
        some = texts[first:last]
        lengths = np.array([len(t) for t in some], dtype=np.int64)
        if lengths.max(initial=0) < width:
            continue
        data = np.frombuffer(b"\0".join(some), dtype=np.uint8)
        begins = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
        values = BYTE_HASH[data]
        sums = _sums(values, MULTIPLIER)
        back = powers(len(data) + 1, inverse(int(MULTIPLIER)))
        n = len(data) - GRAM + 1
        grams = mix((sums[GRAM:] - sums[:n]) * back[:n])
        bits = np.uint64(max(1, int(n).bit_length()))
        places = np.uint64(n - 1) - np.arange(n, dtype=np.uint64)
        low = (grams >> bits << bits) | places
        step = 1
        while 2 * step <= shift + 1:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        rest = shift + 1 - step
        if rest:
            low = np.minimum(low[:-rest], low[rest:])
        owner = n - 1 - (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        text_of = np.repeat(np.arange(len(some)), np.maximum(lengths - width + 1, 0))
        counts = np.maximum(lengths - width + 1, 0)
        offsets = np.arange(len(text_of)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = begins[text_of] + offsets
        owner = owner[starts]
        new = np.flatnonzero(np.concatenate((
            [True], (owner[1:] != owner[:-1]) | (text_of[1:] != text_of[:-1]))))
        ends = np.concatenate((new[1:], [len(starts)])) - 1
        a, b, p = starts[new], starts[ends], owner[new]
        second = _sums(values, SECOND)
        whole = mix((second[b + width] - second[a]) * powers(len(data) + 1, inverse(int(SECOND)))[a]
                    + mix(((p - a) * 65536 + (b - a)).astype(np.uint64)))
        base = begins[text_of[new]]
        yield text_of[new] + first, a - base, b - base, p - base, grams[p], whole


def suffix_array(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts in the order of their first ``depth`` bytes or more, by Larsson-Sadakane refinement.

    Ranks of single bytes are doubled in reach round by round; each round sorts only the starts
    whose rank is still shared, by the rank of the bytes that follow. Also returns the ranks: one
    more than the number of lower starts. Past the end of the data comes a lowest rank.
    """
    n = len(data)
    rank = data.astype(np.int64) + 1
    order = np.argsort(rank, kind="stable")
    rank = np.searchsorted(rank[order], rank).astype(np.int64) + 1
    shared, reach = order, 1
    while reach < depth and len(shared):
        after = np.zeros(len(shared), dtype=np.int64)
        inside = shared + reach < n
        after[inside] = rank[shared[inside] + reach]
        key = rank[shared] * (n + 2) + after
        by = np.argsort(key, kind="stable")
        shared, key = shared[by], key[by]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        # A group's new ranks count up from the group's old rank.
        at = np.flatnonzero(new)
        group = rank[shared]
        first_of_group = np.concatenate(([True], group[1:] != group[:-1]))
        group_start = np.maximum.accumulate(np.where(first_of_group, np.arange(len(shared)), 0))
        new_start = np.maximum.accumulate(np.where(new, np.arange(len(shared)), 0))
        rank[shared] = group + (new_start - group_start)
        sizes = np.diff(np.concatenate((at, [len(shared)])))
        shared = shared[np.repeat(sizes > 1, sizes)]
        reach *= 2
    return np.argsort(rank, kind="stable"), rank


def common_prefixes(data: np.ndarray, order: np.ndarray, rank: np.ndarray, begins: np.ndarray,
                    lengths: np.ndarray, most: int) -> np.ndarray:
    """Bytes, ``most`` at most, each start shares with the next lower start of another rank.

    Kasai's bound carries over: a start's common prefix is at most one byte shorter than that of
    the start before it. The stretches (``begins``, ``lengths``) go side by side, each one start
    further per step, so that every step works on arrays. ``rank`` counts the lower starts, + 1.
    """
    n = len(data)
    padded = np.concatenate((data.astype(np.int16), np.full(most + 1, -1, np.int16)))
    out = np.zeros(n, dtype=np.int64)
    active, known = np.arange(len(begins)), np.zeros(len(begins), dtype=np.int64)
    for step in range(int(lengths.max(initial=0))):
        keep = lengths[active] > step
        active, known = active[keep], np.maximum(known[keep] - 1, 0)
        at = begins[active] + step
        lower = rank[at] - 2
        has = lower >= 0
        other = order[np.maximum(lower, 0)]
        known[~has] = 0
        growing = np.flatnonzero(has & (known < most))
        while len(growing):
            k = known[growing]
            a, b = at[growing] + k, other[growing] + k
            # Two ends of the data never meet at the same place, so padding is no match.
            same = (padded[np.minimum(a, n)] == padded[np.minimum(b, n)]) & (a < n) & (b < n)
            growing = growing[same]
            known[growing] += 1
            growing = growing[known[growing] < most]
        out[at] = known
    return out


def classes(data: np.ndarray, begins: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """For every start a number that it shares with the starts of the same ``width`` bytes."""
    order, rank = suffix_array(data, width)
    shared = common_prefixes(data, order, rank, begins, lengths, width)
    first = np.flatnonzero(np.concatenate(([True], np.diff(rank[order]) > 0)))
    new = np.zeros(len(order), dtype=np.int64)
    new[first] = shared[order[first]] < width
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(new)
    return out
