"""Runs of units (words or bytes) that recur across documents: the part that two deduplication operators share.

Every window of ``window`` units has an anchor, its run of ``k`` units with the smallest hash. Equal windows have equal
anchors at the same place, so a window can only recur if its anchor does. Anchors are counted first; windows around
recurring anchors are dealt to shards by the anchor and solved there by the operator. An anchor that occurs very often
is not dealt to one shard: its windows are hashed, and the first place of each is found by an aggregation.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import bound_batches, map_columns, map_rows, release, stored, unused_name
from tidemark.operators.joins import frequent, hot_key_lookup

MIX, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: Units worked on at once; positions within them have 24 bits.
BLOCK = 1 << 22
PLACE = np.uint64((1 << 24) - 1)
LAST_ID = (1 << 63) - 1
#: Anchors of a block that asks, and about as many of a range that answers.
BLOCK_ANCHORS, RANGE_ANCHORS = 1 << 19, 1 << 21
#: Bytes of a hash within its range, and of a place within a block.
LOCAL_BYTES, PLACE_BYTES = 5, 3


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * STEP + b
    x ^= x >> np.uint64(31)
    x *= MIX
    x ^= x >> np.uint64(29)
    return x


@lru_cache(maxsize=64)
def powers(size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd number and of its inverse, modulo 2**64."""
    base = (int(MIX) * (2 * seed + 1)) % (1 << 64)
    return tuple(np.cumprod(np.full(size, x, np.uint64)) for x in (base, pow(base, -1, 1 << 64)))


def power_sums(values: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the values before each place, times powers; and the inverse powers that make differences free of it."""
    power, inverse = powers(1 << max(12, len(values).bit_length()), seed)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=total[1:])
    return total, inverse


def run_hashes(units: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """64-bit hashes of all runs of ``length`` units."""
    total, inverse = power_sums(units, seed)
    x = total[length:] - total[:-length]
    x *= inverse[: len(x)]
    x ^= x >> np.uint64(31)
    x *= MIX
    x ^= x >> np.uint64(29)
    return x


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


@lru_cache(maxsize=16)
def _numbers(size: int) -> np.ndarray:
    return np.arange(size, dtype=np.uint64)


def anchors(
    units: np.ndarray, k: int, window: int, hashes_of: Callable[..., np.ndarray] = run_hashes
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Hash of each anchor with the first and last start of the windows it stands for, in order, block by block."""
    for begin in range(0, len(units) - window + 1, BLOCK):
        part = units[begin : begin + BLOCK + window - 1]
        hashes = hashes_of(part, k)
        # the smallest hash, and of equal ones the first
        packed = hashes & ~PLACE
        packed |= _numbers(1 << max(12, len(hashes).bit_length()))[: len(hashes)]
        place = _sliding_min(packed, window - k + 1)
        place &= PLACE
        place = place.view(np.int64)
        new = np.ones(len(place), bool)
        np.not_equal(place[1:], place[:-1], out=new[1:])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(place)) - 1
        yield hashes[place[first]].view(np.int64), first + begin, last + begin


def text_key(text: bytes) -> int:
    """As Spark's ``xxhash64`` of the text."""
    value = xxhash.xxh64_intdigest(text, 42)
    return value - (1 << 64) if value >> 63 else value


def nameless(own_id: Column, text: Column) -> Column:
    """What tells documents without an id apart: a hash of their text; 0 for the others."""
    return F.when(own_id.isNull(), F.xxhash64(F.coalesce(text, F.lit("")))).otherwise(F.lit(0).cast("long"))


def narrow(values: np.ndarray, width: int) -> np.ndarray:
    """The lower ``width`` bytes of each number."""
    return np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)[:, :width].ravel()


def widen(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.reshape(-1).view("<u8")


def _binaries(data: np.ndarray, edges: np.ndarray) -> pa.Array:
    """The bytes between neighbouring edges."""
    return pa.Array.from_buffers(
        pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    )


def _sorted_places(values: np.ndarray, used: int) -> np.ndarray:
    """Places of the values in order of their leading bits, of ``used`` in all; equal ones as they stand."""
    bits = max(1, len(values).bit_length())
    both = values << np.uint64(64 - used)
    both >>= np.uint64(bits)
    both <<= np.uint64(bits)
    both |= np.arange(len(values), dtype=np.uint64)
    both.sort()
    both &= np.uint64((1 << bits) - 1)
    return both.view(np.int64)


MESSAGE = pa.schema([("r", pa.int32()), ("block", pa.int64()), ("data", pa.binary()), ("more", pa.binary())])
NUMBERS = pa.schema([("id", pa.int64()), ("of_text", pa.int64()), ("numbers", pa.list_(pa.int32()))])


def questions(
    task: int, block: int, rows: np.ndarray, hashes: np.ndarray, ranges: int, within_documents: bool
) -> Iterator[pa.RecordBatch]:
    """What a block of anchors asks each range of hashes, and its record, as ``r, block, data, more``.

    ``rows`` are ``id, of_text, number, n``: of each document the number of its first anchor in the block, and how many of
    ``hashes`` are its own. A range gets the different hashes in order, without the bits it stands for, and where one is
    held more than once, its place and how often. The record, for ``r`` below 0, is kept for the answers: ``rows``, and the
    place of each anchor among the different hashes.
    """
    x = hashes.view(np.uint64)
    # anchors have small hashes: spread them
    x = (x ^ (x >> np.uint64(32))) * MIX
    order = _sorted_places(x, 64)
    x = x[order]
    # hashes that only differ in their last bits may stand more than once, which counts the same
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    place = np.empty(len(x), np.int64)
    place[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    counted = np.ones(len(x), np.int64)
    if not within_documents:
        owner = np.repeat(np.arange(len(rows), dtype=np.int32), rows[:, 3])[order]
        counted[1:] = new[1:] | (owner[1:] != owner[:-1])
    times = np.add.reduceat(counted, first)
    x = x[first]
    r = (((x >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int32)
    begins = np.flatnonzero(np.diff(r, prepend=np.int32(-1)))
    edges = np.append(begins, len(x))
    several = np.flatnonzero(times > 1)
    several_edges = np.searchsorted(several, edges)
    at = several - np.repeat(begins, np.diff(several_edges))
    more = np.stack([at, times[several] - 1], axis=1).astype("<u4").reshape(-1).view(np.uint8)
    record = np.ascontiguousarray(rows, "<i8").tobytes()
    name = text_key(b"%d %d " % (task, block) + record + x.tobytes())
    yield pa.RecordBatch.from_arrays(
        [r[begins], np.full(len(begins), name), _binaries(narrow(x, LOCAL_BYTES), edges * LOCAL_BYTES), _binaries(more, several_edges * 8)],
        schema=MESSAGE,
    )
    columns = ([-1 - task], [name], [narrow(place, PLACE_BYTES).tobytes()], [record])
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, MESSAGE)], schema=MESSAGE)


def answers(table: pa.Table, often: int) -> pa.Table:
    """Of each hash a range was asked for: 0, 1 if it is held more than once, 2 if more than ``often`` times."""
    asked, more = table.column("data").to_pylist(), table.column("more").to_pylist()
    edges = np.cumsum([0, *map(len, asked)]) // LOCAL_BYTES
    local = widen(b"".join(asked), LOCAL_BYTES)
    times = np.ones(len(local), np.int64)
    at, extra = np.frombuffer(b"".join(more), "<u4").astype(np.int64).reshape(-1, 2).T
    times[np.repeat(edges[:-1], [len(m) // 8 for m in more]) + at] += extra
    order = _sorted_places(local, 8 * LOCAL_BYTES) if len(local) < 1 << 24 else np.argsort(local, kind="stable")
    ordered = local[order]
    new = np.ones(len(order), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    first = np.flatnonzero(new)
    total = np.add.reduceat(times[order], first)
    state = (total > 1).astype(np.uint8)
    state[total > often] = 2
    out = np.empty(len(order), np.uint8)
    out[order] = np.repeat(state, np.diff(first, append=len(order)))
    nothing = pa.nulls(len(table), pa.binary())
    return pa.table([table.column("r"), table.column("block"), _binaries(out, edges), nothing], schema=MESSAGE)


def answered_numbers(table: pa.Table) -> pa.Table:
    """``id, of_text, numbers`` of the recurring anchors of a block, from its record and its answers.

    If a task is lost and done again over rows in another order, blocks have other names, and some are answered in part.
    All their anchors are then taken, in both ways: what does not recur is left out by the solver. The records of a task are
    read together, so each document has one.
    """
    r = table.column("r").to_numpy()
    data = table.column("data").to_pylist()
    record = np.flatnonzero(r < 0)
    if not len(record):
        return NUMBERS.empty_table()
    place = widen(data[record[0]], PLACE_BYTES).astype(np.int64)
    rows = np.frombuffer(table.column("more")[int(record[0])].as_py(), "<i8").reshape(-1, 4)
    states = np.frombuffer(b"".join(data[i] for i in np.argsort(r, kind="stable").tolist() if r[i] >= 0), np.uint8)
    if len(states) != place.max() + 1:
        states = np.full(place.max() + 1, 3, np.uint8)
    state = states[place]
    row = np.repeat(np.arange(len(rows)), rows[:, 3])
    number = np.arange(len(row)) + (rows[:, 2] - np.cumsum(rows[:, 3]) + rows[:, 3])[row]
    usual, often = np.flatnonzero(state & 1), np.flatnonzero(state & 2)
    # numbers of all rows with the same id and text once
    keys, of_row = np.unique(rows[:, :2], axis=0, return_inverse=True)
    of_row = of_row.reshape(-1)
    both = np.concatenate([number[usual], -1 - number[often]]) + (1 << 32)
    both += of_row[row[np.concatenate([usual, often])]] << 33
    both = np.unique(both)
    edges = np.searchsorted(both, np.arange(len(keys) + 1) << 33)
    numbers = ((both & ((1 << 33) - 1)) - (1 << 32)).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(numbers))
    found = pa.table([pa.array(keys[:, 0]), pa.array(keys[:, 1]), lists], schema=NUMBERS)
    return found.filter(pa.array(np.diff(edges) > 0))


def recurring_numbers(
    source: DataFrame, k: int, window: int, units_of: Callable[[bytes], np.ndarray], within_documents: bool, often: int,
    hashes_of: Callable[..., np.ndarray] = run_hashes,
) -> DataFrame:
    """``id, of_text, numbers`` of the documents ``id, of_text, text``: which of their anchors, in order, recur.

    An anchor recurs if it is held by several rows, or with ``within_documents`` at several places. The number of one that
    is held more than ``often`` times is given as -1 - number. Anchors do not travel as rows: blocks of them send their
    different hashes to ranges of hashes, in one message each, and are answered in the order they asked; so a hash that
    stands everywhere arrives once a block, and there are never more messages than hashes.
    """
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # two anchors for as many units as a window has places for one; a unit has one byte at least
    ranges = min(1 << 20, size * 2 // (window - k + 2) // RANGE_ANCHORS + 1)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, block, rows, hashes, held = TaskContext.get().partitionId(), 0, [], [], 0
        for batch in batches:
            for i, of_text, t in zip(*[column.to_pylist() for column in batch.columns]):
                number = 0
                for h, _, _ in anchors(units_of((t or "").encode()), k, window, hashes_of):
                    rows.append((i, of_text, number, len(h)))
                    hashes.append(h)
                    number += len(h)
                    held += len(h)
                    if held >= BLOCK_ANCHORS:
                        yield from questions(task, block, np.array(rows), np.concatenate(hashes), ranges, within_documents)
                        block, rows, hashes, held = block + 1, [], [], 0
        if held:
            yield from questions(task, block, np.array(rows), np.concatenate(hashes), ranges, within_documents)

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        return table if key[0].as_py() < 0 else answers(table, often)

    def settle(key: tuple, table: pa.Table) -> pa.Table:
        return answered_numbers(table)

    message = "r int, block long, data binary, more binary"
    asked = source.select("id", "of_text", "text").mapInArrow(ask, message)
    answered = asked.groupBy("r").applyInArrow(answer, message)
    found = answered.groupBy("block").applyInArrow(settle, "id long, of_text long, numbers array<int>")
    return found.groupBy("id", "of_text").agg(F.flatten(F.collect_set("numbers")).alias("numbers"))


def recurring_ranges(
    docs: DataFrame,
    doc_id: str,
    text: str,
    k: int,
    window: int,
    units_of: Callable[[bytes], np.ndarray],
    slicer_of: Callable[[bytes], Callable[[np.ndarray, np.ndarray], list[bytes]]],
    solve: Callable[[pa.Table], pa.Table],
    within_documents: bool,
    name: str,
    often: int = 32768,
    shard_rows: int = 4096,
    hashes_of: Callable[..., np.ndarray] = run_hashes,
) -> DataFrame:
    """``doc_id, text_key, ranges``: the units of each document to remove, ``array<struct<low, high>>``.

    ``units_of`` gives the units of a text, by default as 64-bit hashes, of whose runs ``hashes_of`` gives the hashes (units,
    length of the runs, seed); ``slicer_of`` gives the bytes of ranges of units. ``solve`` gets a
    shard, ``doc_id, text_key, start, content``, and returns ``doc_id, text_key, low, high``. With ``within_documents``
    a window also recurs inside a document, and is removed wherever it does not start first; otherwise it is removed in
    every document that does not have the smallest id. Null ids count as the largest. Rows that share an id are one
    document to this order, but each text gets its own ranges.

    A shard holds about ``shard_rows`` pieces, so few that a solver works within the caches of a core, and of one anchor
    at most ``often``: some megabytes of text. Pieces go from the texts to their shards in one shuffle and are not stored
    but around anchors that occur often.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    own_id, content = F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`")
    source = docs.select(
        F.coalesce(own_id, F.lit(LAST_ID)).alias("id"), nameless(own_id, content).alias("of_text"), content.alias("text")
    )

    lists = stored(
        recurring_numbers(source, k, window, units_of, within_documents, often, hashes_of), f"{name}-candidates",
        compression="zstd",
    )
    release(spark)
    usual, seen_often = (F.sum(F.size(F.filter("numbers", c))) for c in (lambda x: x >= 0, lambda x: x < 0))
    shards, often_shards = (max(1, int(n or 0) // shard_rows) for n in lists.agg(usual, seen_often).first())

    def cut(ids: list, texts: list, chosen: list) -> Iterator[tuple]:
        """Pieces for the shards; those around anchors that occur often are spread over shards below 0."""
        found, content = [], []
        for i, t, numbers in zip(ids, texts, chosen):
            data = (t or "").encode()
            key, units, slice_of = text_key(data), units_of(data), slicer_of(data)
            wanted = np.unique(np.array(numbers, dtype=np.int64))
            # rows that share an id share their numbers, which may then hold an anchor in both ways
            usual, frequent = wanted[wanted >= 0], -1 - wanted[wanted < 0][::-1]
            at = 0
            for h, first, last in anchors(units, k, window, hashes_of):
                own, often_seen = (x[slice(*np.searchsorted(x, [at, at + len(h)]))] - at for x in (usual, frequent))
                at += len(h)
                spread = -1 - (first[often_seen] + i + key) % often_shards
                for places, shard in ((own, h[own] % shards), (often_seen, spread)):
                    if len(places):
                        low, n = first[places], len(places)
                        found.append((shard.astype(np.int32), np.full(n, i), np.full(n, key), low.astype(np.int32)))
                        content += slice_of(low, last[places] + window)
        if found:
            yield *map(np.concatenate, zip(*found)), content

    def deal(key: tuple, table: pa.Table) -> pa.Table:
        """Ranges of a shard; pieces around anchors that occur often are passed on as ``doc_id, text_key, low, content``."""
        if key[0].as_py() >= 0:
            got = solve(table)
            return got.append_column("content", pa.nulls(len(got), pa.binary()))
        columns = [*(table.column(c) for c in ("doc_id", "text_key", "start")), pa.nulls(len(table), pa.int32()), table.column("content")]
        return pa.table(columns, ["doc_id", "text_key", "low", "high", "content"])

    joined = source.join(lists, ["id", "of_text"])
    pieces = map_columns(
        joined, ["id", "text", "numbers"], cut, "shard int, doc_id long, text_key long, start int, content binary",
    )
    solved = stored(
        pieces.groupBy("shard").applyInArrow(deal, "doc_id long, text_key long, low int, high int, content binary"),
        f"{name}-solved", compression="zstd",
    )
    release(spark)
    ranges = (
        solved.where("content IS NULL").groupBy("doc_id", "text_key")
        .agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    )
    often_pieces = solved.where("content IS NOT NULL").select("doc_id", "text_key", F.col("low").alias("start"), "content")
    frequent = stored(frequent_ranges(often_pieces, window, units_of, within_documents, name, hashes_of), f"{name}-frequent")
    release(spark)
    return (
        ranges.unionByName(frequent).groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    )


def frequent_ranges(
    pieces: DataFrame, window: int, units_of: Callable[[bytes], np.ndarray], within_documents: bool, name: str,
    hashes_of: Callable[..., np.ndarray] = run_hashes,
) -> DataFrame:
    """``doc_id, text_key, ranges`` of pieces ``doc_id, text_key, start, content`` around anchors that occur often.

    Most of them are copies: each different piece is cut into windows once, whose first places are found by an aggregation
    over two hashes, and all pieces get the answer of their content. Windows and pieces that make up a thousandth of the
    rows or more are answered from a broadcast of a thousand rows at most, and their rows are spread.
    """
    spark = pieces.sparkSession
    key = [F.xxhash64("content").alias("p"), F.xxhash64(F.lit(1), "content").alias("q")]
    different = pieces.groupBy("content").agg(F.min(F.struct("doc_id", "start")).alias("at"), F.count("*").alias("times"))
    different = different.select(*key, "content", "at.doc_id", "at.start", "times")

    def cut(ps: list, qs: list, contents: list, ids: list, starts: list, times: list) -> Iterator[tuple]:
        rows = []
        for p, q, content, i, start, t in zip(ps, qs, contents, ids, starts, times):
            units = units_of(content)
            one, two = (hashes_of(units, window, seed).view(np.int64) for seed in (1, 2))
            n = len(one)
            at = np.arange(n, dtype=np.int32)
            rows.append((np.full(n, p), np.full(n, q), at, np.full(n, i), start + at, one, two, np.full(n, t)))
        if rows:
            yield tuple(map(np.concatenate, zip(*rows)))

    windows = stored(
        map_columns(
            different, ["p", "q", "content", "doc_id", "start", "times"], cut,
            "p long, q long, at int, doc_id long, start int, a long, b long, times long", batch=2000,
        ),
        f"{name}-windows",
    )
    release(spark)
    place = F.struct("doc_id", "start") if within_documents else F.struct("doc_id")
    firsts = stored(
        windows.groupBy("a", "b").agg(F.min(place).alias("first"), F.count("*").alias("held")), f"{name}-firsts"
    )
    first_of = firsts.select("a", "b", "first")
    hot = frequent(firsts, "held").select("a", "b", "first")
    answered = hot_key_lookup(windows.select("p", "q", "at", "a", "b", "times"), first_of, hot, ["a", "b"], ["p", "q"])
    answers = stored(
        answered.groupBy("p", "q").agg(F.collect_list(F.struct("at", "first")).alias("firsts"), F.max("times").alias("times")),
        f"{name}-answers",
    )
    release(spark)
    met = hot_key_lookup(
        pieces.select(*key, "doc_id", "text_key", "start"), answers.select("p", "q", "firsts"),
        frequent(answers, "times").select("p", "q", "firsts"), ["p", "q"], ["doc_id", "start"],
    )

    def later(w):
        if within_documents:
            return F.struct(F.col("doc_id"), F.col("start") + w["at"]) > w["first"]
        return F.col("doc_id") > w["first"]["doc_id"]

    gone = F.filter("firsts", later)
    # a piece that goes whole is one range
    ranges = F.when(
        F.size(gone) == F.size("firsts"),
        F.array(F.struct(F.col("start").alias("low"), (F.col("start") + F.size("firsts") - 1 + window).alias("high"))),
    ).otherwise(
        F.transform(
            gone,
            lambda w: F.struct((F.col("start") + w["at"]).alias("low"), (F.col("start") + w["at"] + window).alias("high")),
        )
    )
    met = met.select("doc_id", "text_key", ranges.alias("ranges")).where(F.size("ranges") > 0)
    return met.groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))


def merged_starts(rows: np.ndarray, starts: np.ndarray, window: int) -> Iterable[np.ndarray]:
    """Row, low and high of the units covered by windows: neighbouring and overlapping windows of a row become one."""
    order = np.lexsort((starts, rows))
    rows, starts = rows[order], starts[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (starts[1:] > starts[:-1] + window)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(rows)) - 1
    return (rows[first], starts[first], starts[last] + window) if len(rows) else (rows, starts, starts)


def removed_mask(ranges: list, size: int) -> np.ndarray:
    """Which of ``size`` units are within a range, ``low << 32 | high``."""
    packed = np.array(ranges, np.int64)
    edge = np.bincount(packed >> 32, minlength=size + 1) - np.bincount(packed & ((1 << 32) - 1), minlength=size + 1)
    return np.cumsum(edge[:-1]) > 0


def apply_ranges(
    docs: DataFrame, ranges: DataFrame, doc_id: str, text: str, keep: list[str],
    function: Callable[[bytes, list | None], tuple], schema: str,
) -> DataFrame:
    """The columns of ``keep`` and what ``function`` makes of each text and its ranges, ``low << 32 | high``."""
    packed = F.transform("ranges", lambda r: F.shiftleft(r["low"].cast("long"), 32) + r["high"]).alias("ranges")
    found = stored(ranges.select("doc_id", "text_key", packed), "recurring-ranges")
    release(docs.sparkSession)
    # all texts of an id stand in one row, so that documents meet their ranges by id; without an id, by text
    names = ("of_id", "of_text", "own_ranges", "id_key", "text_key")
    of_id, of_text, own, key, own_text = (unused_name(docs, c) for c in names)
    told_apart = F.when(F.col("doc_id") == LAST_ID, F.col("text_key")).otherwise(F.lit(0).cast("long"))
    by_id = found.groupBy(F.col("doc_id").alias(of_id), told_apart.alias(of_text)).agg(
        F.collect_list(F.struct("text_key", "ranges")).alias(own)
    )
    own_id = F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(LAST_ID))
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    by_text = F.when(own_id == LAST_ID, F.xxhash64(content)).otherwise(F.lit(0).cast("long"))
    keyed = docs.withColumns({key: own_id, own_text: by_text})
    joined = keyed.join(by_id, (F.col(key) == F.col(of_id)) & (F.col(own_text) == F.col(of_text)), "left")

    def run(texts: list, all_ranges: list) -> Iterator[tuple]:
        for t, options in zip(texts, all_ranges):
            data = (t or "").encode()
            key = text_key(data) if options else None
            yield function(data, [r for o in options or [] if o["text_key"] == key for r in o["ranges"]])

    return map_rows(joined, [text, own], run, schema, keep=keep, batch=500)
