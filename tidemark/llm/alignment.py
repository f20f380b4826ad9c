"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes of a text.

Documents are shuffled by their full text, and each distinct text is tokenised and aligned once. Texts are worked on in
blocks: a text becomes a list of chunk numbers, a block keeps the alignment of its different chunks, and sends its
different pairs of ids, weighted by how many documents hold them, to be counted over the corpus. The counts come back to
the blocks, and the measures of a text to all documents that have it.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress, islice, pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.common import release, stored, unused_name
from tidemark.llm.packing import Tokenizer

#: No token of either kind reaches across a place where a blank or a line feed follows what is no white space.
CHUNK = re.compile(r"\s*+\S++(?:[^\S \n]\s*+\S++)*+(?:[^\S \n]\s*+\Z)?+|\s++\Z")
#: A block ends with this many chunks, different chunks, characters of these, or texts.
CHUNKS, DIFFERENT, CHARACTERS, TEXTS = 1 << 22, 1 << 18, 1 << 24, 1 << 15

MEASURES = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
TALLIES = "n_best long, count_sum long"


def _names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(", ")]


class Aligned(NamedTuple):
    """``documents``: the measures of each; ``pairs``: ``a_id, b_id, n_linked, is_best`` over the corpus."""

    documents: DataFrame
    pairs: DataFrame


class ByteLevel(Tokenizer):
    """A byte-level BPE file whose special tokens are plain text in texts."""

    def bytes_of_ids(self) -> list[bytes]:
        found = [b""] * (max([self.encoding.max_token_value, *self.added.values()]) + 1)
        for token in self.encoding.token_byte_values():
            found[self.encoding.encode_single_token(token)] = token
        return found


class Tokenizers:
    """Both vocabularies: A is byte-level BPE, B has pieces with U+2581 for a blank."""

    def __init__(self, a_file: str, b_file: bytes) -> None:
        self.a = ByteLevel(a_file)
        self.a_bytes = self.a.bytes_of_ids()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.lengths = [np.array([len(t) for t in tokens], np.int64) for tokens in (self.a_bytes, self.b_bytes)]
        # ids with what may stand behind them: the end of a chunk, a token of the same side, of the other, a group
        ids = range(max(len(self.a_bytes), len(pieces)))
        self.shown = np.array([[f"{i}{mark}" for i in ids] for mark in ("", ",", "|", ";")], object)
        self.blank = self.b.piece_to_id("▁")
        # texts may be cut only if no piece reaches across
        self.in_chunks = not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)

    def chunks(self, text: str) -> list[str]:
        return CHUNK.findall(" " + text) if self.in_chunks else [" " + text]

    def encode(self, chunks: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B for each chunk, which begins with a blank or a line feed."""
        a = [self.a.encoding.encode_ordinary(c) for c in chunks]
        # B puts a blank before a text: it stands for that of the chunk, or is taken off again
        b = self.b.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        return a, [[self.blank] if c == " " else own if c[0] == " " else own[1:] for c, own in zip(chunks, b)]

    def sound(self, chunk: str, a: list[int], b: list[int]) -> bool:
        """Whether both kinds of tokens are the bytes of the chunk."""
        data = chunk.encode()
        sides = (a, self.a_bytes), (b, self.b_bytes)
        return all(b"".join(map(tokens.__getitem__, ids)) == data for ids, tokens in sides)

    def align(self, a: list[list[int]], b: list[list[int]]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """For sound chunks, one after the other: number of groups, groups as text, number of links; and all links."""
        flat = [np.fromiter(chain.from_iterable(ids), np.int64) for ids in (a, b)]
        ends = [np.cumsum(length[ids]) for length, ids in zip(self.lengths, flat)]
        n_tokens = [np.fromiter(map(len, ids), np.int64) for ids in (a, b)]
        chunk_ends = ends[0][np.cumsum(n_tokens[0]) - 1]
        # a stretch between neighbouring ends lies in one token of each side: a link; common ends cut groups
        stretches, cuts = np.union1d(*ends), np.intersect1d(*ends)
        links = flat[0][np.searchsorted(ends[0], stretches)] << 32 | flat[1][np.searchsorted(ends[1], stretches)]
        group = np.concatenate([np.searchsorted(cuts, own) for own in ends])
        side = np.repeat([0, 1], [len(own) for own in flat])
        order = np.lexsort((side, group))  # stable: tokens of a side stay in order
        group, side, ids = group[order], side[order], np.concatenate(flat)[order]
        behind = np.zeros(len(ids), np.int64)
        behind[:-1] = np.where(group[1:] != group[:-1], 3, np.where(side[1:] != side[:-1], 2, 1))
        last = np.cumsum(n_tokens[0] + n_tokens[1])
        behind[last - 1] = 0
        shown = self.shown[behind, ids].tolist()
        texts = ["".join(shown[i:j]) for i, j in pairwise([0, *last.tolist()])]
        per_chunk = (np.diff(np.searchsorted(points, chunk_ends, side="right"), prepend=0) for points in (cuts, stretches))
        n_groups, n_links = per_chunk
        return n_groups, texts, n_links, links


@lru_cache(maxsize=2)
def _tokenizers(a_file: str, b_file: bytes) -> Tokenizers:
    return Tokenizers(a_file, b_file)


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32, their bytes by significance, compressed."""
    return zstandard.ZstdCompressor(level=3).compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class Block:
    """The different chunks of some texts, by number, with their alignment."""

    def __init__(self, tools: Tokenizers) -> None:
        self.tools, self.number_of = tools, defaultdict()
        self.number_of.default_factory = self.number_of.__len__
        self.sizes = [array("q") for _ in range(4)]  # tokens of A and B, groups, links of each chunk
        self.shown, self.links, self.sound = [], array("q"), array("b")
        self.n_chunks = self.n_characters = self.n_texts = 0
        self.weight = np.zeros(0, np.int64)

    def full(self) -> bool:
        over = (self.n_chunks, CHUNKS), (len(self.shown), DIFFERENT), (self.n_characters, CHARACTERS), (self.n_texts, TEXTS)
        return any(now >= most for now, most in over)

    def add(self, texts: list[str], times: list[int]) -> Iterator[tuple]:
        """The measures of each text, and its chunks."""
        numbers = [np.fromiter(map(self.number_of.__getitem__, self.tools.chunks(t)), np.int64) for t in texts]
        self._align_new()
        sizes, sound = [np.array(s, np.int64) for s in self.sizes], np.array(self.sound, bool)
        self.weight = np.append(self.weight, np.zeros(len(self.shown) - len(self.weight), np.int64))
        for own, n in zip(numbers, times):
            self.n_chunks += len(own)
            self.n_texts += 1
            if not sound[own].all():
                yield 0, 0, 0, 0, "", packed(own[:0])
                continue
            np.add.at(self.weight, own, n)
            shown = ";".join(map(self.shown.__getitem__, own.tolist()))
            yield *(int(s[own].sum()) for s in sizes), hashlib.sha256(shown.encode()).hexdigest(), packed(own)

    def _align_new(self) -> None:
        new = list(islice(self.number_of, len(self.shown), None))
        if not new:
            return
        a, b = self.tools.encode(new)
        sound = np.fromiter(map(self.tools.sound, new, a, b), bool)
        n_groups, n_links = np.zeros((2, len(new)), np.int64)
        shown = np.full(len(new), "", object)
        if sound.any():
            n_groups[sound], shown[sound], n_links[sound], links = self.tools.align(*(list(compress(x, sound)) for x in (a, b)))
            self.links.frombytes(links.tobytes())
        self.sound.extend(sound.tolist())
        self.shown += shown.tolist()
        for column, values in zip(self.sizes, (map(len, a), map(len, b), n_groups.tolist(), n_links.tolist())):
            column.extend(values)
        self.n_characters += sum(map(len, new))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, bytes, bytes]:
        """Different pairs and how often they are linked; the links of a chunk, and each as the number of its pair."""
        n_links = np.array(self.sizes[3], np.int64)
        pairs, links = np.unique(np.array(self.links, np.int64), return_inverse=True)
        times = np.zeros(len(pairs), np.int64)
        np.add.at(times, links, np.repeat(self.weight, n_links))
        return pairs, times, packed(n_links), packed(links)


def _aligned_blocks(distinct: DataFrame, a_file, b_file) -> DataFrame:
    """A row for each text, and one without ``key`` for each block, with its pairs."""
    schema = f"block long, key binary, {MEASURES}, chunks binary, pairs array<long>, times array<long>, n_links_of binary, links binary"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = _tokenizers(a_file.value, b_file.value)
        number, block = TaskContext.get().partitionId() << 32, Block(tools)

        def rows(columns: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)

        def ended() -> pa.RecordBatch:
            pairs, times, n_links, links = block.pairs()
            return rows([[number], *[[None]] * 7, [pairs], [times], [n_links], [links]])

        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                keys, texts, times = (c.to_pylist() for c in batch.slice(start, 200).columns)
                found = list(zip(*block.add(texts, times)))
                yield rows([[number] * len(keys), keys, *found, *[[None] * len(keys)] * 4])
                if block.full():
                    yield ended()
                    number, block = number + 1, Block(tools)
        if block.n_texts:
            yield ended()

    return distinct.mapInArrow(run, schema)


def _tallied(own: pa.Table, answers: pa.Table) -> pa.Table:
    """The texts of a block with ``n_best`` and ``count_sum``."""
    texts = own.filter(pa.compute.is_valid(own["key"]))
    block = own.filter(pa.compute.is_null(own["key"]))
    at = answers["at"].to_numpy()
    values = []
    for name in ("is_best", "n"):
        of_pair = np.zeros(len(at), np.int64)
        of_pair[at] = answers[name].to_numpy().astype(np.int64)
        total = np.concatenate([[0], np.cumsum(of_pair[unpacked(block["links"][0].as_py())])])
        ends = np.cumsum(unpacked(block["n_links_of"][0].as_py()), dtype=np.int64)
        values.append(total[ends] - total[np.append(0, ends[:-1])])
    numbers = [unpacked(c) for c in texts["chunks"].to_pylist()]
    out = texts.select(["key", *_names(MEASURES)])
    for name, of_chunk in zip(_names(TALLIES), values):
        out = out.append_column(name, pa.array([int(of_chunk[x].sum()) for x in numbers], pa.int64()))
    return out


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", keep: list[str] | None = None) -> Aligned:
    """Tokens of ``text`` under two vocabularies, grouped where tokens of both end, with the corpus counts of linked ids.

    ``a_path`` is a file of ``tokenizers`` with byte-level BPE, ``b_path`` one of ``sentencepiece``; special tokens in a
    text are plain text, and both see it with a blank in front. ``documents`` has the columns of ``keep`` (all, if not
    given) and ``n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum``. Tokens are linked if their bytes
    overlap. ``n_best`` counts the links whose pair is the most frequent of its B id over the corpus, ties included,
    ``count_sum`` adds the corpus counts of all links. A text that occurs in several rows counts once for each.

    Null and empty texts, and those whose tokens are not the text byte by byte, have no tokens: zeros, and an empty
    ``groups_sha256``. Repeated rows each get a row, an empty table gives empty tables, and columns of ``docs`` with
    names that are added here give way to them. Texts of any length are read whole. A task holds one block: at most
    4 million chunks, and what 200 texts add to them.
    """
    spark = docs.sparkSession
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        a_file, b_file = spark.sparkContext.broadcast(a.read()), spark.sparkContext.broadcast(b.read())
    own = f"`{text}`"
    key = F.unhex(F.sha2(F.col(own), 256))
    distinct = docs.where(F.length(own) > 0).groupBy(F.col(own).alias("text")).agg(F.count("*").alias("n"))
    distinct = distinct.select(F.unhex(F.sha2("text", 256)).alias("key"), "text", "n")
    blocks = stored(_aligned_blocks(distinct, a_file, b_file), "alignment-blocks")
    release(spark)

    asked = blocks.where("key IS NULL").select("block", F.posexplode(F.arrays_zip("pairs", "times")).alias("at", "held"))
    asked = asked.select(F.col("block").alias("of_block"), "at", F.col("held.pairs").alias("pair"), F.col("held.times").alias("times"))
    counted = asked.groupBy("pair").agg(F.sum("times").alias("n")).withColumn("b_id", F.expr("pair & 4294967295"))
    # a B id has at most one row for each id of A
    best = F.max("n").over(Window.partitionBy("b_id"))
    counted = stored(counted.withColumn("is_best", F.col("n") == best), "alignment-pairs")
    answers = asked.join(counted, "pair").select("of_block", "at", "n", "is_best")
    out = f"key binary, {MEASURES}, {TALLIES}"
    tallied = blocks.drop("pairs", "times").groupBy("block").cogroup(answers.groupBy("of_block")).applyInArrow(_tallied, out)

    names = _names(f"{MEASURES}, {TALLIES}")
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]
    of_text, own_key = unused_name(docs, "of_text"), unused_name(docs, "text_key")
    rows = docs.select(*[f"`{c}`" for c in kept], key.alias(of_text))
    measured = rows.join(tallied.withColumnRenamed("key", own_key), F.col(of_text) == F.col(own_key), "left")
    empty = {c: F.coalesce(c, F.lit("" if c == "groups_sha256" else 0)).alias(c) for c in names}
    pairs = counted.where("n > 0").select(
        F.shiftright("pair", 32).cast("int").alias("a_id"), F.col("b_id").cast("int").alias("b_id"),
        F.col("n").alias("n_linked"), "is_best",
    )
    return Aligned(measured.select(*[rows[f"`{c}`"] for c in kept], *empty.values()), pairs)
