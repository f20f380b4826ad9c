"""Substring deduplication by repeated-phrase automata.

Windows of words around recurring anchors are dealt to shards. A shard confirms which windows recur, compiles them into
an Aho-Corasick automaton over words, and streams its pieces of documents through it to locate every occurrence; all but
the first are removed. Text away from recurring anchors cannot hold a recurring window and is not streamed.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import unused_name
from tidemark.llm.recurring import (
    MIX, STEP, _mixed, apply_ranges, merged_starts, power_sums, recurring_ranges, removed_mask, run_hashes,
)

ANCHOR_WORDS = 4
PART = 1 << 18
# which bytes are ASCII white space
SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))


def _words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last (exclusive) byte of each word."""
    edges = np.flatnonzero(np.diff(~SPACE[raw], prepend=False, append=False))
    return edges[::2], edges[1::2]


def _blocks(data: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """Parts of some hundred thousand bytes with their place; no word is cut."""
    raw, start = np.frombuffer(data, np.uint8), 0
    while start < len(data):
        end = start + PART
        if end < len(data):
            space = re.compile(rb"[ \t\n\v\f\r]").search(data, end)
            end = space.start() if space else len(data)
        yield start, raw[start:end]
        start = end


def word_units(data: bytes) -> np.ndarray:
    """64-bit hashes of the words (runs without ASCII white space): sums of bytes times powers, made free of the place."""
    units = [np.zeros(0, np.uint64)]
    for _, raw in _blocks(data):
        first, last = _words(raw)
        total, inverse = power_sums(raw + np.uint64(1))
        units.append(_mixed((total[last] - total[first]) * inverse[first], (last - first).astype(np.uint64)))
    return np.concatenate(units)


def _word_slicer(data: bytes):
    parts = [(first + start, last + start) for start, raw in _blocks(data) for first, last in [_words(raw)]]
    first, last = map(np.concatenate, zip(*parts)) if parts else (np.zeros(0, int),) * 2
    return lambda low, high: [data[a:b] for a, b in zip(first[low].tolist(), last[high - 1].tolist())]


#: A byte that UTF-8 does not have.
GAP = b"\xff"
#: Code points of letters: the filler, first or only letters, and those that may stand behind another one.
FILLER, FIRST, SECOND, SURROGATES, LAST = 1, 2, 0x10000, 0xD800, 0x10FFFF


def letters_of(n: int) -> tuple[np.ndarray, int]:
    """For each of ``n`` numbers its letters, and how many these are: one, or two if there are not enough."""
    numbers = np.arange(n, dtype=np.int64)
    if n <= LAST - 0x800:
        single = numbers + FIRST
        return (single + 0x800 * (single >= SURROGATES))[:, None], 1
    size = SURROGATES - FIRST
    # the two kinds of letters do not mix, so that no hit begins in the middle of a word
    return np.stack([numbers % size + FIRST, numbers // size + SECOND], axis=1), 2


def _as_text(letters: np.ndarray) -> str:
    return letters.astype("<u4").tobytes().decode("utf-32-le")


def automaton_solver(window: int):
    """Solve a shard: ranges of words covered by windows that do not start first."""

    def solve(table: pa.Table) -> pa.Table:
        ids, keys, starts = (table.column(c).to_numpy() for c in ("doc_id", "text_key", "start"))
        # equal pieces are streamed once, for all the places where they stand
        piece_of: dict[bytes, int] = {}
        which = np.array([piece_of.setdefault(c, len(piece_of)) for c in table.column("content").to_pylist()], np.int64)
        several = np.bincount(which, minlength=len(piece_of)) > 1
        # the pieces as numbers of words, each with a gap behind it, which no text can hold
        number_of: defaultdict[bytes, int] = defaultdict()
        number_of.default_factory = number_of.__len__
        gap = number_of[GAP]
        every = (b" %s " % GAP).join([*piece_of, b""]).split()
        words = np.fromiter(map(number_of.__getitem__, every), np.int64, len(every))
        del every
        ends = np.flatnonzero(words == gap)
        begins = np.append(0, ends[:-1] + 1)
        owner = np.repeat(np.arange(len(ends)), ends + 1 - begins)
        place = np.flatnonzero(owner[:-window] == owner[window:]) if len(words) > window else owner[:0]
        one, two = (run_hashes(words.astype(np.uint64) * MIX + STEP, window, seed)[place] for seed in (1, 2))
        _, first, same, times = np.unique(one, return_index=True, return_inverse=True, return_counts=True)
        likely = (times[same] > 1) | several[owner[place]]
        if not likely.any():
            return _ranges(ids, keys, which[:0], which[:0], window)
        # one place for each different window; those that only share a hash are taken as well
        chosen = np.zeros(len(place), bool)
        chosen[first] = True
        chosen = likely & (chosen | (two != two[first[same]]))
        # a word that stands once, in a piece that stands once, is in no recurring window
        single = np.bincount(words, minlength=len(number_of)) == 1
        single[words[several[owner]]] = False
        single[gap] = True
        known = np.flatnonzero(~single)
        letters, width = letters_of(len(known))
        letter_of = np.full((len(number_of), width), FILLER, np.int64)
        letter_of[known] = letters
        # what has no such window is left out of the text that is streamed
        streamed = np.flatnonzero(np.bincount(owner[place[likely]], minlength=len(ends))[owner])
        text = _as_text(letter_of[words[streamed]].ravel())

        confirmed = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for number, at in enumerate((np.searchsorted(streamed, place[chosen]) * width).tolist()):
            confirmed.add_word(text[at : at + window * width], number)
        confirmed.make_automaton()
        ending, number = np.fromiter(chain.from_iterable(confirmed.iter(text)), np.int64).reshape(-1, 2).T
        at = streamed[(ending + 1) // width - window]
        piece = owner[at]
        offset, found = at - begins[piece], np.bincount(piece, minlength=len(ends))
        # every hit at every place of its piece
        often = found[which]
        row = np.repeat(np.arange(len(which)), often)
        before = np.cumsum(found) - found
        hit = np.arange(len(row)) - np.repeat(np.cumsum(often) - often, often) + before[which[row]]
        start, number = starts[row] + offset[hit], number[hit]
        order = np.lexsort((start, ids[row], number))
        row, start, number = row[order], start[order], number[order]
        new = np.ones(len(row), bool)
        new[1:] = number[1:] != number[:-1]
        earliest = np.flatnonzero(new)[np.cumsum(new) - 1]
        later = (ids[row] != ids[row[earliest]]) | (start != start[earliest])
        return _ranges(ids, keys, row[later], start[later], window)

    return solve


def _ranges(ids: np.ndarray, keys: np.ndarray, row: np.ndarray, start: np.ndarray, window: int) -> pa.Table:
    """Covered units of each text in a shard as a table."""
    texts, text_of = np.unique(np.stack([ids, keys], axis=1), axis=0, return_inverse=True)
    text, low, high = merged_starts(text_of.reshape(-1)[row], start, window)
    return pa.table(
        {
            "doc_id": pa.array(texts[text, 0], pa.int64()), "text_key": pa.array(texts[text, 1], pa.int64()),
            "low": pa.array(low.astype(np.int32)), "high": pa.array(high.astype(np.int32)),
        }
    )


def remove_repeated(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = 20,
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns of ``keep`` (``doc_id``), ``n_words``, ``n_removed`` and ``kept``: the words left, joined by spaces.

    A word is removed if it is covered by ``window`` consecutive words that also start earlier: in a document with a
    smaller id, or before in the same one. Documents of fewer words than that lose none. Null texts have no words; null
    ids come after all others and are one document to this order; of repeated rows with the same id none is earlier.
    Long texts are read whole, an empty table gives no rows. New columns whose names are taken get underscores in front.
    """
    kept = [doc_id] if keep is None else keep
    ranges = recurring_ranges(
        docs, doc_id, text, ANCHOR_WORDS, window, word_units, _word_slicer, automaton_solver(window), True, "passages"
    )

    def rest(data: bytes, own: list | None) -> tuple:
        words = data.split()
        if not own:
            return len(words), 0, b" ".join(words).decode()
        gone = removed_mask(own, len(words))
        left = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
        return len(words), int(gone.sum()), left.decode()

    base = docs.select(*[f"`{c}`" for c in kept])
    schema = ", ".join(f"{unused_name(base, c)} {t}" for c, t in (("n_words", "long"), ("n_removed", "long"), ("kept", "string")))
    return apply_ranges(docs, ranges, doc_id, text, kept, rest, schema)


