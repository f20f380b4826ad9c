"""A word model that grows with the documents: n-grams of up to three words, counted and looked up by shuffles.

Every distinct text votes once for each n-gram it holds. Texts are cut into blocks; a block sends its different n-grams,
as hashes of 48 bits in sorted arrays, to ranges of hashes. A range adds up the votes and answers each block in the order
it asked. Neither the driver nor a broadcast ever holds n-grams, and an n-gram that stands everywhere arrives once a block.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.passages import word_units

ORDER, GRAM_BITS = 3, 48
# texts told apart beside an n-gram in 64 bits
TEXT_BITS = 64 - GRAM_BITS
BACK_OFF = 0.4
BLOCK_BYTES = 6 << 20
RANGE_GRAMS = 4_000_000
PASSED = 500_000
DIGITS = re.compile(r"[0-9]+")
# scripts that put no spaces between words: South-East Asian, kana and Han; each character counts as a word
UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _hashed(value: np.ndarray, salt: int) -> np.ndarray:
    """The upper 48 bits of a finalizer over 64 bits."""
    x = value + np.uint64(salt * int(MIX[0]) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return (x ^ (x >> np.uint64(31))) >> np.uint64(64 - GRAM_BITS)


def word_ngrams(text: str, lang: str) -> list[np.ndarray]:
    """Hashes of the n-grams of 0, 1, 2 and 3 words that end at each word; two marks stand before the first word.

    The last lists have one entry more in front for each mark, so that contexts stand one place before. Case is left out,
    and numbers are alike.
    """
    salt = zlib.crc32(lang.encode()) + 1
    shown = DIGITS.sub("0", text.lower())
    if not shown.isascii():
        shown = UNSPACED.sub(r" \1 ", shown)
    words = word_units(shown.encode())
    units = np.concatenate([np.array([1, 2], np.uint64), words])
    out = [_hashed(np.zeros(1, np.uint64), salt * 8)]
    run = np.zeros(len(units), np.uint64)
    for size in range(1, ORDER + 1):
        run = run[: len(units) - size + 1] * MIX[1] + _hashed(units[size - 1 :], size)
        out.append(_hashed(run, salt * 8 + size))
    return out


def _held(texts: list[list[np.ndarray]]) -> np.ndarray:
    """The n-grams of each text once, in order, with the numbers of their texts in the lower ``TEXT_BITS``."""
    both = np.empty(sum(len(x) for grams in texts for x in grams), np.uint64)
    at = 0
    for number, grams in enumerate(texts):
        begin = at
        for x in grams:
            np.left_shift(x, np.uint64(TEXT_BITS), out=both[at : at + len(x)])
            at += len(x)
        both[begin:at] |= np.uint64(number)
    both.sort()
    new = np.ones(len(both), bool)
    np.not_equal(both[1:], both[:-1], out=new[1:])
    return both[new]


def own_words(texts: list[list[np.ndarray]]) -> np.ndarray:
    """How many different words each text has: its votes for the empty n-gram, the context of single words."""
    parts = [texts[i : i + (1 << TEXT_BITS)] for i in range(0, len(texts), 1 << TEXT_BITS)]
    holders = ([[grams[1][ORDER - 1 :]] for grams in part] for part in parts)
    mask = np.uint64((1 << TEXT_BITS) - 1)
    return np.concatenate(
        [np.bincount((_held(part) & mask).astype(np.int64), minlength=len(part)) for part in holders]
    )


def pack_numbers(values: np.ndarray) -> bytes:
    """Non-negative numbers by planes of bytes, compressed."""
    planes = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([width]) + zlib.compress(planes[:, :width].T.tobytes(), 1)


def unpack_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data[1:]), np.uint8).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : data[0]] = planes.T
    return out.reshape(-1).view("<u8").astype(np.int64)


def texts_by_block(docs: DataFrame, text: str, lang: str) -> tuple[DataFrame, int]:
    """``block, a, b, lang, text``, and the number of hash ranges; rows without words are left out.

    Equal texts of a language have one block, about 6 MB large. A task passes on one copy of a text, so copies may make up
    any share of the rows; ``different`` drops the copies from other tasks.
    """
    picked = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit("")).alias("lang"), F.col(f"`{text}`").alias("text"))
    picked = picked.where(F.col("text").rlike(r"[^ \t\n\x0B\f\r]"))
    size = picked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    a, b = text_key(F.col("lang"), F.col("text"))
    block = F.pmod(a, F.lit(size // BLOCK_BYTES + 1)).alias("block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed: set[tuple] = set()
        for batch in batches:
            keep = []
            for key in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                keep.append(key not in passed)
                if len(passed) >= PASSED:
                    passed.clear()
                passed.add(key)
            yield batch.filter(pa.array(keep))

    schema = "block long, a long, b long, lang string, text string"
    # about 2.5 different n-grams for a word of six bytes
    return picked.select(block, a.alias("a"), b.alias("b"), "lang", "text").mapInArrow(run, schema), size * 5 // 12 // RANGE_GRAMS + 1


def different(table: pa.Table) -> list[tuple[int, int, str, str]]:
    """The different ``a, b, lang, text`` of a block in the order of their keys."""
    columns = (table.column(c).to_pylist() for c in ("a", "b", "lang", "text"))
    return sorted(set(zip(*columns)))


def text_key(lang: Column, text: Column) -> tuple[Column, Column]:
    """128 bits that stand for a text of a language."""
    return F.xxhash64(lang, text), F.xxhash64(F.lit(1), text, lang)


def block_votes(texts: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The different n-grams of a block and the votes of its texts: one each, and for the empty one as many as a text has
    different words.
    """
    parts = []
    for start in range(0, len(texts), 1 << TEXT_BITS):
        some = texts[start : start + (1 << TEXT_BITS)]
        grams = _held(some)
        grams >>= np.uint64(TEXT_BITS)
        first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        known, n = grams[first], np.diff(first, append=len(grams))
        empty = np.searchsorted(known, np.concatenate([g[0] for g in some]))
        np.add.at(n, empty, own_words(some) - 1)
        parts.append((known, n))
    if len(parts) == 1:
        return parts[0]
    grams, n = (np.concatenate(x) for x in zip(*parts))
    known, inverse = np.unique(grams, return_inverse=True)
    return known, np.bincount(inverse, weights=n).astype(np.int64)


def _places(values: np.ndarray) -> np.ndarray:
    """The place of each value among the different ones in order."""
    order = np.argsort(values)
    ordered = values[order]
    new = np.zeros(len(values), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    del ordered
    out = np.empty(len(values), np.int32)
    out[order] = np.cumsum(new, dtype=np.int32)
    return out


def _cuts(grams: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range begins in the sorted ``grams``; one place more for the end."""
    edges = [-(-(i << GRAM_BITS) // ranges) for i in range(ranges)]
    return np.append(np.searchsorted(grams, np.array(edges, np.uint64)), len(grams))


def bits_of(others: list[np.ndarray]) -> np.ndarray:
    """-log2 of the score of each word, backing off from three words to two, one and none.

    ``others`` are the votes of the other texts for each n-gram of a text, in the order of ``word_ngrams``: the text's own
    are set aside, so that what no other text holds counts as unseen.
    """
    n = len(others[ORDER])
    out, todo, weight = np.zeros(n), np.ones(n, bool), 1.0
    for size in range(ORDER, 0, -1):
        seen = others[size][len(others[size]) - n :]
        context = others[size - 1][-n - 1 : -1] if size > 1 else np.repeat(others[0], n)
        hit = todo & (seen > 0)
        out[hit] = -np.log2(weight * seen[hit] / np.maximum(context, seen)[hit])
        todo &= ~hit
        weight *= BACK_OFF
    out[todo] = -np.log2(weight / (others[0][0] + 1))
    return out


def score_words(texts: DataFrame, ranges: int) -> DataFrame:
    """``a, b, lang, n, word_bits, word_spread``: words, and mean and variance of the bits a word, of every different text."""

    def own_ngrams(table: pa.Table) -> tuple[list, list[list[np.ndarray]]]:
        rows = different(table)
        return rows, [word_ngrams(t, name) for _, _, name, t in rows]

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        grams, n = block_votes(own_ngrams(table)[1])
        cuts = _cuts(grams, ranges)
        rows = [
            (key[0].as_py(), r, pack_numbers(np.diff(grams[a:b], prepend=np.uint64(0))), pack_numbers(n[a:b]))
            for r, (a, b) in enumerate(zip(cuts, cuts[1:]))
            if a < b
        ]
        return pa.table([pa.array(c, t.type) for c, t in zip(zip(*rows), asked)], schema=asked)

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        parts = [np.cumsum(unpack_numbers(g)) for g in table.column("grams").to_pylist()]
        n = np.concatenate([unpack_numbers(x) for x in table.column("n").to_pylist()])
        inverse = np.unique(np.concatenate(parts), return_inverse=True)[1]
        total = np.bincount(inverse, weights=n).astype(np.int64)[inverse]
        ends = np.cumsum([len(p) for p in parts])
        packed = pa.array([pack_numbers(t) for t in np.split(total, ends[:-1])], pa.binary())
        return pa.table([table.column("block"), table.column("r"), packed], schema=answered)

    def score(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        rows, own = own_ngrams(table)
        words, sizes = own_words(own), [[len(g) for g in grams] for grams in own]
        flat = np.concatenate([g for grams in own for g in grams])
        del own
        # the n-grams of the block in order are those it asked for
        place = _places(flat)
        del flat
        found = sorted(zip(answers.column("r").to_pylist(), answers.column("n").to_pylist()))
        others = np.concatenate([unpack_numbers(n) for _, n in found])[place] - 1
        bits, at = [], 0
        for size, n_words in zip(sizes, words.tolist()):
            parts = np.split(others[at : at + sum(size)], np.cumsum(size)[:-1])
            parts[0] = parts[0] + 1 - n_words
            bits.append(bits_of(parts))
            at += sum(size)
        out = [(a, b, name, len(x), float(x.mean()), float(x.var())) for (a, b, name, _), x in zip(rows, bits)]
        return pa.table([pa.array(c, t.type) for c, t in zip(zip(*out), scored)], schema=scored)

    asked = pa.schema([("block", pa.int64()), ("r", pa.int32()), ("grams", pa.binary()), ("n", pa.binary())])
    answered = pa.schema([("block", pa.int64()), ("r", pa.int32()), ("n", pa.binary())])
    scored = pa.schema(
        [("a", pa.int64()), ("b", pa.int64()), ("lang", pa.string()), ("n", pa.int64())]
        + [("word_bits", pa.float64()), ("word_spread", pa.float64())]
    )
    questions = texts.groupBy("block").applyInArrow(ask, "block long, r int, grams binary, n binary")
    answers = questions.groupBy("r").applyInArrow(answer, "block long, r int, n binary")
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        score, "a long, b long, lang string, n long, word_bits double, word_spread double"
    )
