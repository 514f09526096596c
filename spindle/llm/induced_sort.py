"""Suffix arrays by induced sorting, for many short texts ("lanes") in step.

A lane's suffixes are classed as smaller (S) or larger (L) than the next one.
The leftmost S suffixes are brought in order, by induction from any order of
theirs, by names of the pieces between them and, if names repeat, by the
suffix array of the names; one more induction gives all suffixes.  Each lane
takes linear time; every step of the scan is one numpy operation over all
lanes.  Arrays are (place, lane), so that a step reads one row.

Shorter lanes end in zeros, which are smaller than any letter; a suffix that
ends is smaller than any that goes on.
"""

from __future__ import annotations

import numpy as np

from spindle.llm.near_dup import mix


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the one after them.  The last one is
    larger than the empty suffix."""
    n, lanes = text.shape
    rise = np.zeros((n, lanes), np.int8)
    rise[:-1] = (text[1:] > text[:-1]).astype(np.int8) - (text[1:] < text[:-1])
    rise[-1] = -1
    # equal neighbours take the sign of the next place where letters differ
    place = np.where(rise != 0, np.arange(n, dtype=np.int32)[:, None], np.int32(n))
    place = np.minimum.accumulate(place[::-1], 0)[::-1]
    return np.take_along_axis(rise, place, 0) > 0


def leftmost(smaller: np.ndarray) -> np.ndarray:
    out = np.zeros_like(smaller)
    out[1:] = smaller[1:] & ~smaller[:-1]
    return out


def buckets(text: np.ndarray, letters: int) -> np.ndarray:
    """Where each letter's suffixes begin, (letter, lane) with one more row
    for the end."""
    n, lanes = text.shape
    key = text.astype(np.int64) * lanes + np.arange(lanes)
    counts = np.bincount(key.ravel(), minlength=letters * lanes).reshape(letters, lanes)
    out = np.zeros((letters + 1, lanes), np.int64)
    np.cumsum(counts, 0, out=out[1:])
    return out


def induce(text: np.ndarray, smaller: np.ndarray, borders: np.ndarray, seeds: np.ndarray, lane: np.ndarray) -> np.ndarray:
    """All suffixes in order, given the leftmost S ones (``seeds`` of ``lane``,
    in order within each lane) at the ends of their buckets.

    Places are kept as ``place * lanes + lane``; the suffix one further left
    is that minus ``lanes``.  Place 0 has none, so it also marks what is not
    known yet."""
    n, lanes = text.shape
    kind = np.int32 if (n + 1) * lanes < 1 << 31 else np.int64
    every = np.arange(lanes, dtype=kind)
    order = np.tile(every, n)
    bucket = text.astype(kind) * kind(lanes) + every
    if len(seeds):
        spot = bucket.ravel()[seeds * lanes + lane]
        by = np.argsort(spot, kind="stable")
        spot = spot[by]
        last = np.concatenate((np.flatnonzero(np.diff(spot)), [len(by) - 1]))
        left = np.repeat(last, np.diff(np.concatenate(([-1], last)))) - np.arange(len(by))
        end = borders[1:].ravel()[spot]
        order[(end - 1 - left) * lanes + lane[by]] = seeds[by] * lanes + lane[by]

    before = np.zeros((n, lanes), kind)
    before[1:] = bucket[:-1]
    before = before.ravel()
    wanted = np.zeros((n, lanes), bool)
    wanted[1:] = ~smaller[:-1]
    wanted = wanted.ravel()
    heads = (borders[:-1] * lanes + every).astype(kind).ravel()
    spot = bucket[n - 1]  # the last suffix comes before the empty one, which is first of all
    order[heads[spot]] = (n - 1) * lanes + every
    heads[spot] += lanes
    for i in range(0, n * lanes, lanes):
        row = order[i:i + lanes]
        at = row[wanted.take(row)]
        if len(at):
            spot = before.take(at)
            place = heads.take(spot)
            order[place] = at - lanes
            heads[spot] = place + lanes

    wanted = np.zeros((n, lanes), bool)
    wanted[1:] = smaller[:-1]
    wanted = wanted.ravel()
    tails = (borders[1:] * lanes + every).astype(kind).ravel()
    for i in range((n - 1) * lanes, -1, -lanes):
        row = order[i:i + lanes]
        at = row[wanted.take(row)]
        if len(at):
            spot = before.take(at)
            place = tails.take(spot) - lanes
            order[place] = at - lanes
            tails[spot] = place
    return order.reshape(n, lanes) // kind(lanes)


def name_pieces(text: np.ndarray, marks: np.ndarray, seeds: np.ndarray, lane: np.ndarray) -> np.ndarray:
    """Numbers of the pieces from each leftmost S place to the next, in the
    order of ``seeds``, from 1 in each lane; equal pieces get one number."""
    n, lanes = text.shape
    following = np.where(marks, np.arange(n)[:, None], n)
    after = np.full((n, lanes), n)
    after[:-1] = np.minimum.accumulate(following[::-1], 0)[::-1][1:]
    end = after.ravel()[seeds * lanes + lane]
    size = np.minimum(end, n - 1) - seeds + 1 + (end == n) * (2 * n)
    power = np.multiply.accumulate(np.full((n, 1), np.uint64(0x9E3779B97F4A7C15)), 0)
    sums = np.zeros((n + 1, lanes), np.uint64)
    np.cumsum(mix(text.astype(np.uint64) + np.uint64(1)) * power, 0, out=sums[1:])
    inverse = np.multiply.accumulate(np.full(n, np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))))
    stop = np.minimum(end, n - 1) + 1
    code = (sums.ravel()[stop * lanes + lane] - sums.ravel()[seeds * lanes + lane]) * inverse[seeds]
    new = np.ones(len(seeds), np.int64)
    new[1:] = (code[1:] != code[:-1]) | (size[1:] != size[:-1]) | (lane[1:] != lane[:-1])
    number = np.cumsum(new)
    first = np.concatenate(([True], lane[1:] != lane[:-1])) if len(lane) else np.zeros(0, bool)
    base = np.maximum.accumulate(np.where(first, number, 0)) if len(lane) else number
    return number - base + 1


def suffix_arrays(text: np.ndarray) -> np.ndarray:
    """The suffix array of every column of ``text`` (non-negative integers)."""
    n, lanes = text.shape
    if n == 0:
        return np.zeros((0, lanes), np.int64)
    text = text.astype(np.int32)
    smaller = smaller_than_next(text)
    marks = leftmost(smaller)
    borders = buckets(text, int(text.max()) + 1)
    lane, seeds = np.nonzero(marks.T)
    if not len(seeds):
        return induce(text, smaller, borders, seeds, lane)
    rough = induce(text, smaller, borders, seeds, lane).T
    found, where = np.nonzero(np.take_along_axis(marks.T, rough, 1))
    sorted_seeds = rough[found, where]
    names = name_pieces(text, marks, sorted_seeds, found)
    counts = np.bincount(lane, minlength=lanes)
    if len(names) == len(np.unique(names * lanes + found)):
        return induce(text, smaller, borders, sorted_seeds, found)
    nth = np.arange(len(seeds)) - np.repeat(np.cumsum(counts) - counts, counts)
    number = np.zeros((n, lanes), np.int64)
    number[seeds, lane] = nth
    reduced = np.zeros((int(counts.max()), lanes), np.int64)
    reduced[number[sorted_seeds, found], found] = names
    inner = suffix_arrays(reduced).T
    real_lane, real = np.nonzero(inner < counts[:, None])
    places = inner[real_lane, real]
    starts = np.cumsum(counts) - counts
    return induce(text, smaller, borders, seeds[starts[real_lane] + places], real_lane)
