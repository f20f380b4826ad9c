"""Best-fit packing of tokenised documents by a configuration linear program.

The histogram of piece lengths (at most one entry per length up to the capacity) is all the driver sees. A configuration
is a multiset of lengths that fits a sequence; the covering program over configurations is solved by multiplicative
weights, a knapsack dynamic program prices configurations, whole parts are taken, and what rounding leaves is packed
best-fit. Pieces then find their place by their number among the pieces of their length.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import map_rows, stored

# fixed values of byte-level vocabularies: how they cut texts, and the characters that stand for bytes
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SHOWN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]
# a space between white space belongs to a run that must not be cut
BETWEEN_SPACES = re.compile(r"\s (?:\s|$)")
#: Parts whose ids a task keeps, twice at most: some hundred bytes each.
CACHED = 500_000


class Parts(dict):
    """Ids of parts of texts by part, as bytes. When it is full, those not used again until the next time go."""

    def __init__(self, encoding: tiktoken.Encoding, before: str) -> None:
        self.encoding, self.before, self.older = encoding, before, {}

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            ids = array("I", self.encoding.encode_ordinary(self.before + part)).tobytes()
        if len(part) <= 64:
            if len(self) >= CACHED:
                self.older = dict(self)
                self.clear()
            self[part] = ids
        return ids


class Tokenizer:
    """Ids of a byte-level BPE vocabulary file.

    ``encode`` finds the added tokens of the file in a text, as ``tokenizers`` does with the file as it is; in ``ids`` they are
    ordinary text. Texts are cut before single spaces, where tokens never reach across, and the ids of each part are kept.
    """

    def __init__(self, vocabulary: str) -> None:
        file = json.loads(vocabulary)
        tokens = file["model"]["vocab"]
        self.added = {token["content"]: token["id"] for token in file.get("added_tokens") or []}
        flags = ("single_word", "lstrip", "rstrip", "normalized")
        if any(token.get(flag) for token in file.get("added_tokens") or [] for flag in flags) or file.get("normalizer"):
            raise ValueError("added tokens with conditions and normalizers are not supported")
        longest_first = sorted(self.added, key=len, reverse=True)
        self.added_token = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None
        hidden = [b for b in range(256) if b not in set(SHOWN_BYTES)]
        byte_of = {chr(b): b for b in SHOWN_BYTES} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in tokens.items() if all(c in byte_of for c in token)}
        special = {token for token in tokens if token.startswith("<|") and token.endswith("|>")}
        ranks = {k: i for k, i in ranks.items() if k.decode("utf-8", "replace") not in special}
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.first, self.later = Parts(self.encoding, ""), Parts(self.encoding, " ")

    def encode(self, text: str) -> np.ndarray:
        """Unsigned 32-bit ids; the parts between added tokens are texts of their own."""
        if not any(token in text for token in self.added):
            return self.ids(text)
        parts = self.added_token.split(text)
        found = [np.array([self.added[p]], "<u4") if i % 2 else self.ids(p) for i, p in enumerate(parts) if i % 2 or p]
        return np.concatenate(found)

    def ids(self, text: str) -> np.ndarray:
        """Unsigned 32-bit ids of ordinary text."""
        if BETWEEN_SPACES.search(text):
            return np.array(self.encoding.encode_ordinary(text), dtype="<u4")
        first, *rest = text.split(" ")
        return np.frombuffer(b"".join([self.first[first], *map(self.later.__getitem__, rest)]), dtype="<u4")


def cut_documents(
    docs: DataFrame, doc_id: str, text: str, tokenizer_path: str, capacity: int, end_id: int, with_ids: bool
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``), each document's ids with ``end_id`` behind them."""
    with open(tokenizer_path, encoding="utf-8") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())

    of_task: list[Tokenizer] = []

    def run(doc_ids: list, texts: list) -> Iterator[tuple]:
        # goes with the task: in a reused worker it would keep its parts beside the work of later stages
        if not of_task:
            of_task.append(Tokenizer(vocabulary.value))
        tokenizer = of_task[0]
        for i, t in zip(doc_ids, texts):
            ids = np.append(tokenizer.encode(t or ""), np.uint32(end_id)).astype("<u4")
            first = len(ids) % capacity or capacity
            cuts = [0, *range(first, len(ids) + 1, capacity)]
            for piece, (start, end) in enumerate(zip(cuts, cuts[1:])):
                own = ids[start:end]
                row = (i, piece, start, end - start, zlib.crc32(own.tobytes()))
                yield (*row, own.astype(np.int32)) if with_ids else row

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return map_rows(docs, [doc_id, text], run, schema, batch=500)


def _knapsack(value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best total value for each capacity, and the length taken last (0: none)."""
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for space in range(1, capacity + 1):
        # one piece of each length, and the best of what is left
        total = best[space - 1 :: -1][:space] + value[1 : space + 1]
        at = int(total.argmax())
        if total[at] > best[space - 1] + 1e-12:
            best[space], last[space] = total[at], at + 1
        else:
            best[space], last[space] = best[space - 1], 0
    return best, last


def _filled(last: np.ndarray, space: int) -> list[int]:
    lengths = []
    while space > 0:
        if last[space]:
            lengths.append(int(last[space]))
            space -= int(last[space])
        else:
            space -= 1
    return lengths


def fractional_cover(counts: np.ndarray, capacity: int, step: float = 0.5, at_once: int = 24) -> list[tuple[tuple, float]]:
    """Configurations and how often to use each so that every length is covered.

    Weights of lengths fall exponentially with the share covered so far; each knapsack prices ``at_once`` configurations,
    the best ones that hold the uncovered lengths of most value.
    """
    lengths = np.flatnonzero(counts)
    need = counts[lengths].astype(float)
    cover = np.zeros(len(lengths))
    place = np.zeros(capacity + 1, np.int64)
    place[lengths] = np.arange(len(lengths))
    base = lengths * (1 + lengths / capacity)
    chosen: dict[tuple, float] = {}
    while True:
        share = cover / need
        open_ = share < 1 - 1e-9
        if not open_.any():
            return list(chosen.items())
        value = np.zeros(capacity + 1)
        value[lengths[open_]] = base[open_] * np.exp(-0.05 * share[open_])
        best, last = _knapsack(value, capacity)
        own = lengths[open_]
        order = own[np.argsort(-(value[own] + best[capacity - own]), kind="stable")]
        for length in order[:at_once].tolist():
            config = [length, *_filled(last, capacity - length)]
            kinds, times = np.unique(config, return_counts=True)
            at = place[kinds]
            left = need[at] - cover[at]
            if (left <= 1e-9).any():
                continue
            amount = float((left / times).min()) * (step if (left / times).min() > 1 else 1)
            cover[at] += times * amount
            key = tuple(sorted(config, reverse=True))
            chosen[key] = chosen.get(key, 0.0) + amount


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple, int]]:
    """Longest pieces first, each into the fullest sequence it fits; equal sequences are listed once.

    Pieces of a length go into equal sequences together. A length adds at most three kinds of sequences, so the work
    depends on the number of lengths and not on the number of pieces.
    """
    by_space: dict[int, dict[tuple, int]] = {}
    spaces = np.zeros(capacity + 1, bool)

    def put(space: int, content: tuple, n: int) -> None:
        if n:
            same = by_space.setdefault(space, {})
            same[content] = same.get(content, 0) + n
            spaces[space] = True

    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            at = int(spaces[length:].argmax()) + length
            if spaces[at]:
                space = at
                content, n = by_space[space].popitem()
                if not by_space[space]:
                    spaces[space] = False
            else:
                space, content, n = capacity, (), left
            # the fullest sequence stays the fullest one until no piece of this length fits any more
            each = space // length
            full = min(n, left // each)
            put(space - each * length, content + (length,) * each, full)
            left -= full * each
            if full < n:
                put(space - left * length, content + (length,) * left, 1 if left else 0)
                if content:
                    put(space, content, n - full - (left > 0))
                left = 0
    found: dict[tuple, int] = {}
    for contents in by_space.values():
        for content, n in contents.items():
            found[content] = found.get(content, 0) + n
    return list(found.items())


def plan_sequences(counts: np.ndarray, capacity: int, rounds: int = 4) -> list[tuple[tuple, int]]:
    """Configurations and whole numbers of sequences that hold exactly ``counts`` pieces of each length.

    Whole parts of the fractional solution are taken, the rest is solved again, and the last rest is packed best-fit. If
    best fit alone takes fewer sequences, as it may at any number of pieces, that is the plan.
    """
    rest = counts.astype(np.int64).copy()
    plan: list[tuple[tuple, int]] = []
    if rest[capacity]:
        plan.append(((capacity,), int(rest[capacity])))
        rest[capacity] = 0
    plain = best_fit(rest, capacity)
    whole: list[tuple[tuple, int]] = []
    for _ in range(rounds):
        taken = 0
        if not rest.any():
            break
        for config, amount in sorted(fractional_cover(rest, capacity), key=lambda x: (-sum(x[0]), x[0])):
            kinds, times = np.unique(config, return_counts=True)
            n = min(int(amount + 1e-6), int((rest[kinds] // times).min()))
            # a configuration that leaves much space waits for the best fit, which places equal pieces together
            if n and sum(config) >= 0.995 * capacity:
                rest[kinds] -= times * n
                whole.append((config, n))
                taken += n
        if not taken:
            break
    whole += best_fit(rest, capacity)
    if sum(n for _, n in plain) < sum(n for _, n in whole):
        whole = plain
    return plan + whole


def _slots(plan: list[tuple[tuple, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys (length, first number), first sequence and offset of each place for pieces, sorted by key."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for config, n in plan:
        offset = 0
        for length in config:
            number = used.get(length, 0)
            rows.append((length << 44 | number, sequence - number, offset))
            used[length] = number + n
            offset += length
        sequence += n
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = 2048,
    end_id: int = 0,
    with_ids: bool = False,
    bucket_rows: int = 20_000,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``).

    Null texts count as empty and become a piece of ``end_id`` alone; null ids and repeated rows are packed like any
    other row, an empty table gives no rows, other columns are left out. ``ids_crc32`` is over little-endian unsigned
    32-bit ids. Documents longer than ``capacity`` are cut so that the first piece may be shorter.

    The driver holds the histogram and the plan, whose size depends on ``capacity`` and not on the documents.
    """
    spark = docs.sparkSession
    cut = cut_documents(docs, doc_id, text, tokenizer_path, capacity, end_id, with_ids)
    pieces = stored(cut.withColumn("row", F.monotonically_increasing_id()), "packing-pieces")
    histogram = pieces.groupBy("length").count().collect()
    counts = np.zeros(capacity + 1, np.int64)
    for row in histogram:
        counts[row["length"]] = row["count"]
    slots = spark.sparkContext.broadcast(_slots(plan_sequences(counts, capacity)))
    # pieces of a length are numbered in buckets of bounded size, behind the buckets before them
    buckets = max(1, int(counts.sum()) // bucket_rows)
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int"))
    before = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n")).select(
        F.col("length").alias("of_length"), F.col("bucket").alias("of_bucket"),
        (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"),
    )
    number = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("row")) - 1
    numbered = dealt.withColumn("number", number.cast("long")).join(
        before, (F.col("length") == F.col("of_length")) & (F.col("bucket") == F.col("of_bucket"))
    )
    names = [f.name for f in cut.schema]
    ranked = numbered.select(*names, (F.col("number") + F.col("before")).alias("number"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sequences, offsets = slots.value
        for batch in batches:
            length, number = (batch.column(names.index("length")), batch.column(len(names)))
            length, number = length.to_numpy(), number.to_numpy()
            at = np.searchsorted(keys, length << 44 | number, "right") - 1
            added = [pa.array(sequences[at] + number), pa.array(offsets[at])]
            yield pa.RecordBatch.from_arrays(
                batch.columns[: len(names)] + added, names=[*names, "sequence_id", "offset"]
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    return ranked.mapInArrow(place, schema + ", sequence_id long, offset long")
