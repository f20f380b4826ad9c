"""SimHash near-duplicates.

Equal and close fingerprints are linked through sharded BK-trees. Two fingerprints with at most r differing bits agree
in one of r+1 blocks of bits and, outside it, in one of r+1 smaller blocks; each such pair of blocks and its value names
a shard. A shard with many fingerprints is cut into chunks, and the tree of each chunk is sent to every other chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import map_rows, release, stored, unused_name
from tidemark.llm.graph import components, local_roots

SEED = 42
BLOCK = 1 << 22


def _word_blocks(data: bytes, overlap: int) -> Iterator[list[bytes]]:
    """Lists of words of about 4 MB of text; every list begins with the last ``overlap`` words of the one before."""
    if len(data) <= BLOCK:
        yield data.split()
        return
    tail: list[bytes] = []
    start = 0
    while start < len(data):
        end = min(len(data), start + BLOCK)
        while end < len(data) and data[end] not in b" \t\n\v\f\r":
            end += 1
        words = tail + data[start:end].split()
        yield words
        tail = words[-overlap:] if overlap else []
        start = end


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64 bits, each set if over half of the shingles' hashes have it set; 0 without words."""
    data = (text or "").encode().lower()
    hashes: list[np.ndarray] = []
    few: list[bytes] = []
    for words in _word_blocks(data, shingle - 1):
        few = words
        if len(words) < shingle:
            continue
        joined = b" ".join(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths).tolist()
        digest = xxhash.xxh64_intdigest
        values = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :].tolist())]
        hashes.append(np.array(values, dtype=">u8"))
    if not hashes:
        return xxhash.xxh64_intdigest(b" ".join(few), SEED) if few else 0
    total, count = 0, np.zeros(64, np.int64)
    for block in hashes:
        total += len(block)
        for first in range(0, len(block), 1 << 16):
            part = block[first : first + (1 << 16)]
            count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > total).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """``doc_id, fp``: the fingerprint as a signed long."""

    def run(ids: list, texts: list) -> Iterator[tuple]:
        for i, t in zip(ids, texts):
            value = fingerprint(t, shingle)
            yield i, value - (1 << 64) if value >> 63 else value

    return map_rows(docs, [doc_id, text], run, "doc_id long, fp long")


def block_masks(max_bits: int) -> list[int]:
    """Masks of the shards' bits as signed longs: one block of r+1, and one of r+1 smaller ones outside it."""
    masks = []
    for block in np.array_split(np.arange(64), max_bits + 1):
        rest = np.setdiff1d(np.arange(64), block)
        for inner in np.array_split(rest, max_bits + 1):
            mask = sum(1 << int(b) for b in [*block, *inner])
            masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def linked_pairs(fps: np.ndarray, group: np.ndarray, in_tree: np.ndarray, asks: np.ndarray, radius: int):
    """Yield arrays (a, b) of positions with at most ``radius`` differing bits, found in one BK-tree per group.

    Rows must be sorted by group. Rows with ``in_tree`` make up the trees, rows with ``asks`` are looked up; a tree's
    children are keyed by their distance to the parent, and only edges within the radius are followed.
    """
    members = np.flatnonzero(in_tree)
    if not len(members):
        return
    _, first = np.unique(group[members], return_index=True)
    root_of = np.full(int(group.max()) + 1, -1, np.int64)
    root_of[group[members[first]]] = members[first]
    pending = np.delete(members, first)
    node = root_of[group[pending]]
    edges, children = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(pending):
        # all rows that meet at a node with the same distance: the first becomes the child, the others go on to it
        edge = node * 65 + np.bitwise_count(fps[pending] ^ fps[node])
        keys, first, inverse = np.unique(edge, return_index=True, return_inverse=True)
        edges.append(keys)
        children.append(pending[first])
        node = np.delete(children[-1][inverse], first)
        pending = np.delete(pending, first)
    edge_keys, child = np.concatenate(edges), np.concatenate(children)
    order = np.argsort(edge_keys)
    edge_keys, child = edge_keys[order], child[order]

    sizes = np.bincount(group[members], minlength=len(root_of))
    askers = np.flatnonzero(asks & (root_of[group] >= 0))
    work = np.cumsum(sizes[group[askers]])
    for start in range(0, int(work[-1]) if len(work) else 0, 1 << 21):
        # so many lookups at a time that all nodes they could visit fit in memory
        ask = askers[np.searchsorted(work, start, "right") : np.searchsorted(work, start + (1 << 21), "right")]
        at = root_of[group[ask]]
        while len(ask):
            distance = np.bitwise_count(fps[ask] ^ fps[at]).astype(np.int64)
            hit = (distance <= radius) & (ask != at)
            yield ask[hit], at[hit]
            next_ask, next_at = [], []
            if len(edge_keys):
                for step in range(-radius, radius + 1):
                    label = distance + step
                    key = at * 65 + label
                    place = np.minimum(np.searchsorted(edge_keys, key), len(edge_keys) - 1)
                    there = (edge_keys[place] == key) & (label >= 0) & (label <= 64)
                    next_ask.append(ask[there])
                    next_at.append(child[place[there]])
            ask = np.concatenate(next_ask) if next_ask else ask[:0]
            at = np.concatenate(next_at) if next_at else at[:0]


def _forest_links(radius: int, batch_rows: int = 1 << 15):
    """Rows ``shard, a, b, fp, rep, role`` sorted by shard and tile to links between the smallest documents."""

    def solve(tile: np.ndarray, fps: np.ndarray, reps: np.ndarray, role: np.ndarray) -> pa.RecordBatch:
        ids, local = np.unique(reps, return_inverse=True)
        parent = np.arange(len(ids))
        for a, b in linked_pairs(fps, tile, role != 2, role != 1, radius):
            parent = local_roots(parent, local[a], local[b])
        moved = parent != np.arange(len(ids))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[moved]), pa.array(ids[parent[moved]])], names=["u", "v"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush(last: bool):
            nonlocal held
            columns = [np.concatenate(c) for c in zip(*held)]
            change = np.any([np.diff(c) != 0 for c in columns[:4]], axis=0)
            tile = np.concatenate([[0], np.cumsum(change)])
            cut = len(tile) if last else int(np.searchsorted(tile, tile[-1]))
            held = [] if last else [[c[cut:] for c in columns]]
            lonely = np.bincount(tile[:cut])[tile[:cut]] < 2 if cut else np.zeros(0, bool)
            pick = np.flatnonzero(~lonely)
            if len(pick):
                dense = np.unique(tile[pick], return_inverse=True)[1]
                return solve(dense, columns[4][pick].view(np.uint64), columns[5][pick], columns[6][pick])
            return None

        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            if sum(len(h[0]) for h in held) >= batch_rows:
                links = flush(False)
                if links is not None:
                    yield links
        if held:
            links = flush(True)
            if links is not None:
                yield links

    return run


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    max_bits: int = 3,
    chunk: int = 4096,
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    Words are lower-cased (A-Z) runs without ASCII white space. Documents without words have fingerprint zero and are
    linked like any other, null texts count as empty. Equal fingerprints are always linked. Repeated rows stay. Rows
    with a null id take no part in linking and get a null component. Long texts are read whole, an empty table gives no
    rows. Other columns are left out.

    ``chunk`` bounds the fingerprints of a tree: a shard with more is cut in chunks that meet pairwise in tiles of their
    own, so no link is lost and no task holds a whole shard.
    """
    spark = docs.sparkSession
    of_docs = stored(fingerprints(docs, doc_id, text, shingle), "simhash-fingerprints")
    reps = stored(
        of_docs.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-distinct"
    )
    masks = block_masks(max_bits)
    shards = F.explode(
        F.array(*[F.struct(F.lit(i).alias("kind"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(masks)])
    )
    keyed = reps.select("fp", "rep", shards.alias("s")).select("s.kind", "s.bits", "fp", "rep")
    large = (
        keyed.groupBy("kind", "bits").count().where(F.col("count") > chunk)
        .select("kind", "bits", F.ceil(F.col("count") / chunk).cast("int").alias("chunks"))
    )
    tiles = keyed.join(large, ["kind", "bits"], "left").select(
        "kind", "bits", "fp", "rep",
        F.when(F.col("chunks").isNull(), 0).otherwise(F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")).alias("c"),
        F.coalesce("chunks", F.lit(1)).alias("chunks"),
    )
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    tiles = tiles.withColumn("other", other).select(
        "kind", "bits",
        F.least("c", "other").alias("a"), F.greatest("c", "other").alias("b"), "fp", "rep",
        # 0: tree and lookup, 1: tree only, 2: lookup only
        F.when(F.col("c") == F.col("other"), 0).when(F.col("c") < F.col("other"), 1).otherwise(2).alias("role"),
    )
    dealt = tiles.repartition("kind", "bits", "a", "b").sortWithinPartitions("kind", "bits", "a", "b", "fp")
    links = stored(dealt.mapInArrow(_forest_links(max_bits), "u long, v long"), "simhash-links")
    release(spark)
    labels = components(links)
    classes = reps.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        F.col("fp").alias("of_fp"), F.coalesce("component", "rep").alias("component_id")
    )
    return of_docs.join(classes, of_docs["fp"] == classes["of_fp"], "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 3
) -> DataFrame:
    """The rows of ``docs`` that stay: of each group of near-duplicates the one with the smallest id, once.

    Rows with a null id cannot be compared and stay. All columns are kept as they are.
    """
    name = unused_name(docs, "first_id")
    first = (
        near_duplicates(docs, doc_id, text, shingle, max_bits)
        .where("doc_id = component_id").select(F.col("doc_id").alias(name)).distinct()
    )
    known = docs.where(F.col(f"`{doc_id}`").isNotNull()).join(first, F.col(f"`{doc_id}`") == F.col(name), "left_semi")
    return known.dropDuplicates([doc_id]).unionByName(docs.where(F.col(f"`{doc_id}`").isNull()))
