"""Suffix-array deduplication by the difference-cover algorithm.

Pieces of text around recurring anchors are dealt to shards. A shard sorts all suffixes of its different pieces: sampled
triples are sorted and named, the string of names is solved the same way, the remaining suffixes are merged in; then the
prefixes of neighbours are compared. Neighbours that agree in a whole window are one class, and a window is removed from
every document that does not have the smallest id of its class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import unused_name
from tidemark.llm.recurring import (
    MIX, PLACE, STEP, _mixed, apply_ranges, merged_starts, recurring_ranges, removed_mask, run_hashes,
)

ANCHOR_BYTES = 16
LETTERS = (np.arange(1, 257, dtype=np.uint64) * MIX) ^ (np.arange(1, 257, dtype=np.uint64) * MIX >> np.uint64(29))


def byte_units(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8)


def byte_hashes(units: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """64-bit hashes of all runs of ``length`` bytes; those of the length of anchors come from the two halves of a run."""
    if length != ANCHOR_BYTES or seed:
        return run_hashes(LETTERS[units], length, seed)
    halves = np.ndarray((max(0, len(units) - 7),), "<u8", np.ascontiguousarray(units), 0, (1,))
    x = halves[:-8] * STEP
    x ^= x >> np.uint64(32)
    x += halves[8:]
    x *= MIX
    x ^= x >> np.uint64(32)
    return x


def _byte_slicer(data: bytes):
    return lambda low, high: [data[a:b] for a, b in zip(low.tolist(), high.tolist())]


def _order(keys: np.ndarray, top: int) -> np.ndarray:
    """Places of numbers below ``top`` in order; equal ones as they stand. Places are sorted behind the numbers if both fit."""
    bits = len(keys).bit_length()
    if top > 1 << (63 - bits):
        return np.argsort(keys, kind="stable")
    both = (keys << bits) | np.arange(len(keys))
    both.sort()
    return both & ((1 << bits) - 1)


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order. ``symbols`` are positive integers; a suffix precedes its extensions."""
    n = len(symbols)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: symbols[i:].tolist()), dtype=np.int64)
    top = int(symbols.max()) + 1
    if top >= 1 << 20:
        symbols = np.unique(symbols, return_inverse=True)[1] + 1
        top = int(symbols.max()) + 1
    s = np.concatenate([symbols.astype(np.int64), np.zeros(3, np.int64)])
    # sampled positions: those that are 1 or 2 mod 3, with one more behind a string of length 1 mod 3
    ones = np.arange(1, n + (n % 3 == 1), 3)
    twos = np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    triples = (s[sample] * top + s[sample + 1]) * top + s[sample + 2]
    order = _order(triples, top**3)
    new = np.ones(len(order), np.int64)
    new[1:] = triples[order[1:]] != triples[order[:-1]]
    named = np.cumsum(new)
    if named[-1] < len(sample):
        names = np.empty(len(sample), np.int64)
        names[order] = named
        order = suffix_array(names)
    rank = np.zeros(n + 3, np.int64)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    sampled = sample[order]
    sampled = sampled[sampled < n]
    # suffixes at 0 mod 3 by first symbol and the rank of the rest
    zeros = np.arange(0, n, 3)
    width = len(sample) + 2
    first_rank = s[zeros] * width + rank[zeros + 1]
    order = _order(first_rank, top * width)
    zeros, first_rank = zeros[order], first_rank[order]
    # where they go: behind the sampled suffixes that are smaller, which one or two symbols and a rank decide
    one, two = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    smaller = np.searchsorted(s[one] * width + rank[one + 1], first_rank)
    smaller += np.searchsorted(
        (s[two] * top + s[two + 1]) * width + rank[two + 2], (s[zeros] * top + s[zeros + 1]) * width + rank[zeros + 2]
    )
    out = np.empty(n, np.int64)
    place = smaller + np.arange(len(zeros))
    out[place] = zeros
    free = np.ones(n, bool)
    free[place] = False
    out[free] = sampled
    return out


def _agree(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether ``length`` bytes at ``a`` and at ``b`` are equal."""
    same = np.ones(len(a), bool)
    for size, kind in ((8, "<u8"), (4, "<u4"), (2, "<u2"), (1, "u1")):
        values = np.ndarray((max(0, len(data) - size + 1),), kind, data, 0, (1,))  # one value at every byte
        while length >= size:
            length -= size
            at = np.flatnonzero(same)
            same[at] = values[a[at] + length] == values[b[at] + length]
    return same


def _comparable(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray, window: int) -> np.ndarray:
    """Which pieces may share a window with another one.

    All windows of a piece have its anchor, the first of the runs with the smallest hash in the piece, and at least half of
    their other bytes stand together on one side of it. Equal windows agree there, so a piece has none to share if no other
    one has its anchor with as many bytes on either side. ``data`` has a byte more behind the pieces.
    """
    hashes = byte_hashes(data, ANCHOR_BYTES)
    runs = sizes - ANCHOR_BYTES + 1
    edges = np.stack([begins, begins + runs], axis=1).ravel()
    place = np.arange(len(hashes)) - np.repeat(begins, np.diff(begins, append=len(hashes)))
    smallest = np.minimum.reduceat(hashes & ~PLACE | place.astype(np.uint64), edges)[::2] & PLACE
    anchor = begins + smallest.astype(np.int64)
    half = (window - ANCHOR_BYTES + 1) // 2
    out = np.zeros(len(sizes), bool)
    for far in (-half, half):
        held = np.flatnonzero((anchor + far >= begins) & (anchor + far < begins + runs))
        at = anchor[held]
        near = max(-ANCHOR_BYTES, min(far, ANCHOR_BYTES))
        _, side, times = np.unique(
            _mixed(_mixed(hashes[at], hashes[at + far]), hashes[at + near]), return_inverse=True, return_counts=True
        )
        out[held] |= times[side] > 1
    return out


def first_holders(pieces: list[bytes], smallest: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of the pieces, one after the other, the smallest id that holds it; and where each piece begins.

    ``smallest`` is the smallest id that holds each piece. The pieces differ.
    """
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    data = np.frombuffer(b"\0".join(pieces) + b"\0" * (window + 8), np.uint8)
    size = int((sizes + 1).sum())
    symbols = data[:size].astype(np.int64) + 2
    symbols[begins + sizes] = 1
    order = suffix_array(symbols)
    # of each place, the piece and whether a whole window of it begins there
    piece = np.repeat(np.arange(len(pieces)), sizes + 1)
    whole = np.arange(size) + window <= (begins + sizes)[piece]
    order = order[whole[order]]
    new = np.ones(len(order), bool)
    new[1:] = ~_agree(data, order[:-1], order[1:], window)
    first = np.minimum.reduceat(smallest[piece[order]], np.flatnonzero(new))
    holder = np.empty(size, np.int64)
    holder[order] = first[np.cumsum(new) - 1]
    windows = sizes - window + 1
    return holder[whole], np.cumsum(windows) - windows


def suffix_solver(window: int):
    """Solve a shard: ranges of bytes covered by windows that also start in a document with a smaller id."""

    def solve(table: pa.Table) -> pa.Table:
        ids, keys, starts = (table.column(c).to_numpy() for c in ("doc_id", "text_key", "start"))
        # equal pieces are sorted once
        content = table.column("content").combine_chunks()
        content = pa.concat_arrays(content.chunks) if isinstance(content, pa.ChunkedArray) else content
        encoded = content.dictionary_encode()
        which = encoded.indices.to_numpy().astype(np.int64)
        different = encoded.dictionary
        _, edges, held = different.buffers()
        edges = np.frombuffer(edges, np.int32)[different.offset :][: len(different) + 1].astype(np.int64)
        sizes, begins, text = np.diff(edges), edges[:-1] - edges[0], held[int(edges[0]) : int(edges[-1])].to_pybytes()
        smallest = np.full(len(different), np.iinfo(np.int64).max)
        np.minimum.at(smallest, which, ids)
        compared = np.flatnonzero(_comparable(np.frombuffer(text + b"\0", np.uint8), begins, sizes, window))
        # of each piece, the smallest and the largest of the ids that hold its windows first
        low, high, at = smallest.copy(), smallest.copy(), np.zeros(len(different), np.int64)
        first = smallest[:0]
        if len(compared):
            pieces = [text[a:b] for a, b in zip(begins[compared].tolist(), (begins + sizes)[compared].tolist())]
            first, at[compared] = first_holders(pieces, smallest[compared], window)
            low[compared] = np.minimum.reduceat(first, at[compared])
            high[compared] = np.maximum.reduceat(first, at[compared])
        # pieces that go whole are one range, of others each window is looked at
        gone = np.flatnonzero(ids > high[which])
        some = np.flatnonzero((ids <= high[which]) & (ids > low[which]))
        windows = sizes[which[some]] - window + 1
        row = np.repeat(some, windows)
        step = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
        later = first[at[which[row]] + step] < ids[row]
        row, begin, end = merged_starts(row[later], starts[row[later]] + step[later], window)
        row = np.concatenate([gone, row])
        begin = np.concatenate([starts[gone], begin])
        end = np.concatenate([starts[gone] + sizes[which[gone]], end])
        # ranges of a text that overlap become one
        order = np.lexsort((begin, keys[row], ids[row]))
        own, own_keys, begin, end = ids[row[order]], keys[row[order]], begin[order], end[order]
        new = np.ones(len(order), bool)
        new[1:] = (own[1:] != own[:-1]) | (own_keys[1:] != own_keys[:-1]) | (begin[1:] > end[:-1])
        first_of = np.flatnonzero(new)
        end = np.maximum.reduceat(end, first_of) if len(end) else end
        return pa.table(
            {
                "doc_id": pa.array(own[first_of], pa.int64()), "text_key": pa.array(own_keys[first_of], pa.int64()),
                "low": pa.array(begin[first_of].astype(np.int32)), "high": pa.array(end.astype(np.int32)),
            }
        )

    return solve


def remove_repeated(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = 50,
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns of ``keep`` (``doc_id``), ``n_bytes, n_removed, n_spans`` and ``kept``, the bytes left.

    A byte is removed if it is covered by a string of ``window`` bytes that also starts in a document with a smaller id;
    strings are judged on the input and never cross documents. ``n_spans`` counts the runs of removed bytes. Null texts
    count as empty; null ids come after all others and count as equal; repeated rows of one id do not remove each other.
    Long texts are read whole, an empty table gives no rows. New columns whose names are taken get underscores in front.
    """
    kept = [doc_id] if keep is None else keep
    ranges = recurring_ranges(
        docs, doc_id, text, ANCHOR_BYTES, window, byte_units, _byte_slicer, suffix_solver(window), False, "suffixes",
        hashes_of=byte_hashes,
    )

    def rest(data: bytes, own: list | None) -> tuple:
        if not own:
            return len(data), 0, 0, data
        gone = removed_mask(own, len(data))
        runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
        return len(data), int(gone.sum()), runs, np.frombuffer(data, np.uint8)[~gone].tobytes()

    base = docs.select(*[f"`{c}`" for c in kept])
    names = (("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept", "binary"))
    return apply_ranges(
        docs, ranges, doc_id, text, kept, rest, ", ".join(f"{unused_name(base, c)} {t}" for c, t in names)
    )
