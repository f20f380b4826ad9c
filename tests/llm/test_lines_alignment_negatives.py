"""Line deduplication, cross-tokenizer alignment and hard negatives against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm_texts import sentence
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import alignment, linededup, negatives
from tidemark.llm.packing import SHOWN_BYTES

A, B = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- lines


def line_key(line):
    key = line.strip(" \t\x0b\x0c\r\n")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in key)


def brute_lines(rows, min_chars, min_docs):
    """Rows without an id are documents of their own, told apart by text and smaller than the others."""
    order = {k: n for n, k in enumerate(sorted({(i is not None, i or 0, "" if i is not None else t or "") for i, t in rows}))}
    holders = {}
    documents = [order[i is not None, i or 0, "" if i is not None else t or ""] for i, t in rows]
    for doc, (_, t) in zip(documents, rows):
        for line in (t or "").split("\n"):
            holders.setdefault(line_key(line), set()).add(doc)
    out = []
    for doc, (i, t) in zip(documents, rows):
        lines = (t or "").split("\n")
        kept = [
            line for line in lines
            if len(line_key(line)) < min_chars or len(holders[line_key(line)]) < min_docs or doc == max(holders[line_key(line)])
        ]
        out.append((str(i), len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return sorted(out)


def found_lines(df):
    return sorted((str(r["doc_id"]), r["n_lines"], r["n_dropped"], sha(r["kept"])) for r in df.collect())


@pytest.mark.parametrize(("batches", "fan_in"), [(1, 2), (5, 2), (7, 3)])
def test_lines_against_brute_force(docs, nasty, batches, fan_in):
    rng = random.Random(batches)
    common = [sentence(i, 8) for i in range(6)] + ["É" * 40, "e" * 39, " " + "ü" * 39, "A" * 40, "a" * 40, ""]
    blanks = ["", " ", "\t", "\r", "\x0b \x0c", "\xa0"]

    def made():
        lines = [rng.choice(blanks) + rng.choice([str, str.upper])(rng.choice(common)) + rng.choice(blanks) for _ in range(rng.randint(0, 9))]
        return "\n".join(lines)

    rows = [(rng.randint(0, 60), made()) for _ in range(80)] + [(None, sentence(n % 3, 8)) for n in range(9)]
    rows += [(n + 100, f"own {n}\n{common[0]}\n{common[0].upper()} ") for n in range(6)] + [(105, "\n" + common[0])]
    rows += [r[:2] for r in nasty]
    got = linededup.remove_repeated(docs(rows, clashing=True), min_docs=4, batches=batches, fan_in=fan_in)
    assert found_lines(got) == brute_lines(rows, 40, 4)
    assert "extra bits" in {r["bits"] for r in got.select("bits").distinct().collect()}


def test_a_line_needs_five_documents_and_stays_in_the_last(docs):
    line = sentence(1, 9)
    rows = [(n, f"head {n}\n  {line.upper()}\r\n{line}\ntail") for n in range(5)] + [(3, "again")]
    got = {(r["doc_id"], r["n_lines"]): r for r in linededup.remove_repeated(docs(rows)).collect()}
    assert got[4, 4]["kept"] == rows[4][1] and got[3, 1]["kept"] == "again"
    assert all(got[n, 4]["kept"] == f"head {n}\ntail" for n in range(4))
    assert {r["n_dropped"] for r in linededup.remove_repeated(docs(rows[1:])).collect()} == {0}


def test_lines_of_empty_table(docs):
    assert linededup.remove_repeated(docs([]), keep=["doc_id"]).columns == ["doc_id", "n_lines", "n_dropped", "kept"]
    assert linededup.remove_repeated(docs([])).count() == 0


def test_runs_compact_and_take_batches_in_any_order(spark):
    schema = "high long, low long, doc_id long, text_hash long"
    runs = linededup.LineRuns(spark, min_docs=3, fan_in=2)
    seen = {}
    for batch in ([1, 2, 3, 4], [20], [5, 6], [7], [11, 12, 13], [8], [9]):
        rows = [(k, -k, d, 0) for d in batch for k in range(1, 4) if d % k == 0]
        for k, _, d, _ in rows:
            seen.setdefault(k, []).append(d)
        runs.add(spark.createDataFrame(rows, schema))
    assert [len(level) for level in runs.levels] == [1, 1, 1]
    plan = spark.table(runs.runs()[0].table).join(spark.table(runs.runs()[1].table), ["high", "low"]).hint("merge")
    assert "hashpartitioning" not in plan._jdf.queryExecution().sparkPlan().toString()
    got = {r["high"]: r["holder"]["doc_id"] for r in runs.frequent().collect()}
    assert got == {k: max(d) for k, d in seen.items() if len(d) >= 3} and not runs.runs()


# ---- alignment


@pytest.fixture(scope="module")
def tools():
    return alignment.Tokenizers(open(A, encoding="utf-8").read(), open(B, "rb").read())


def brute_alignment(texts):
    """Measures of every row by whole texts, byte by byte, and the counts of all pairs."""
    a_tool, b_tool = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_tool.encode_special_tokens = True
    hidden = [b for b in range(256) if b not in set(SHOWN_BYTES)]
    byte_of = {chr(b): b for b in SHOWN_BYTES} | {chr(256 + i): b for i, b in enumerate(hidden)}

    def owners(pieces):
        return [n for n, piece in enumerate(pieces) for _ in piece]

    measured, counts = [], Counter()
    for text in texts:
        found = None
        if text:
            a, b = a_tool.encode(" " + text, add_special_tokens=False).ids, b_tool.encode(text)
            a_pieces = [bytes(byte_of[c] for c in a_tool.id_to_token(i)) for i in a]
            b_pieces = [
                bytes([int(b_tool.id_to_piece(i)[3:5], 16)]) if b_tool.is_byte(i) else b_tool.id_to_piece(i).replace("▁", " ").encode()
                for i in b
            ]
            if b"".join(a_pieces) == b"".join(b_pieces) == (" " + text).encode():
                ends = [set(np.cumsum([len(p) for p in pieces]).tolist()) for pieces in (a_pieces, b_pieces)]
                common = sorted(ends[0] & ends[1])
                groups = []
                for ids, pieces in ((a, a_pieces), (b, b_pieces)):
                    group_of = np.searchsorted(common, np.cumsum([len(p) for p in pieces]))
                    groups.append([",".join(str(i) for i, g in own) for _, own in itertools.groupby(zip(ids, group_of), lambda x: x[1])])
                groups = ["|".join(pair) for pair in zip(*groups)]
                links = [(a[i], b[j]) for i, j in sorted(set(zip(owners(a_pieces), owners(b_pieces))))]
                counts.update(links)
                found = (len(a), len(b), len(groups), links, sha(";".join(groups)))
        measured.append(found)
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(highest.get(b, 0), n)
    rows = [
        (*m[:3], len(m[3]), sum(counts[x] == highest[x[1]] for x in m[3]), sum(counts[x] for x in m[3]), m[4]) if m else (0,) * 6 + ("",)
        for m in measured
    ]
    return rows, counts


def test_cutting_into_chunks_changes_no_token(tools):
    rng = random.Random(4)
    whole, plain = sentencepiece.SentencePieceProcessor(model_file=B), Tokenizer.from_file(A)
    plain.encode_special_tokens = True
    parts = [" ", "  ", "\n", "\t", "\r\n", "a", "B", "é", "the", "ing", " of", "1", "23", "'s", "!", "<|endoftext|>", "<s>", "<0x41>",
             "　", "\xa0", "\x1c", "日本", "🙂", "\x00", "x" * 30, "​", "\x85", "{\r", "http://a.b", "﻿"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 14)))
        chunks = tools.chunks(text)
        a, b = (sum(ids, []) for ids in tools.encode(chunks))
        assert "".join(chunks) == " " + text and b == whole.encode(text)
        assert a == plain.encode(" " + text, add_special_tokens=False).ids


def test_alignment_against_brute_force(docs, nasty, monkeypatch):
    rng = random.Random(8)
    words = "the house of cards, naïve Übermut l'été 2024 <|endoftext|> <s> x=1; ▁ 日本 🙂 \t (end) tokenization\n\n".split(" ")
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 30))) for _ in range(60)]
    rows = [(n, t) for n, t in enumerate(texts)] + [(n + 100, texts[n % 3]) for n in range(40)] + [r[:2] for r in nasty]
    expected, counts = brute_alignment([t for _, t in rows])
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    for most in (1 << 15, 7):  # one block, many blocks
        monkeypatch.setattr(alignment, "TEXTS", most)
        got = alignment.align(docs(rows, clashing=True), A, B)
        assert sorted(str((r["doc_id"], *(r[c] for c in columns))) for r in got.documents.collect()) == sorted(
            str((i, *e)) for (i, _), e in zip(rows, expected)
        )
        assert {(r["a_id"], r["b_id"]): r["n_linked"] for r in got.pairs.collect()} == dict(counts)
    best = {r["b_id"]: r["n_linked"] for r in got.pairs.where("is_best").collect()}
    assert all(n <= best[b] for (_, b), n in counts.items())


def test_alignment_of_empty_table(docs):
    got = alignment.align(docs([]), A, B, keep=["doc_id"])
    assert got.documents.count() == 0 and got.pairs.count() == 0


# ---- hard negatives


def brute_negatives(rows, label, positives=5, negatives=5, share=80):
    best = {}
    for i, v, own in rows:
        own = label(i, own)
        if i is None or own is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (own, [math.floor(256 * x) for x in v])
        best[i] = min(best.get(i, row), row)
    out = []
    for a, (own, q) in best.items():
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, l) for i, (l, v) in best.items() if i != a and len(v) == len(q))
        for s, p, _ in [x for x in scored if x[2] == own][:positives]:
            inside = [(-n, i) for n, i, l in scored if l != own and share * -s <= 100 * -n <= 100 * -s]
            out += [(a, p, rank, i, -s, n) for rank, (n, i) in enumerate(inside[:negatives], 1)]
    return sorted(out)


def label_of(i, label):
    return (label + 1) % 10 if i is not None and label is not None and i % 7 == 0 else label


def mined(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    df = df.select("*", *[F.lit(0).alias(c) for c in ("score", "v", "rank", "dim", "shard", "is_anchor")])
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(tuple(r) for r in negatives.mine(df, label, F.col("vec_id") % 100 == 0, **more).collect())


def test_negatives_against_brute_force(spark):
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = [(i, [x + rng.gauss(0, 0.4) for x in centres[i % 4]], rng.choice([0, 1, 9])) for i in range(700)]
    rows += [(1000 + i, rows[5][1], i % 3) for i in range(60)]  # copies: ties
    rows += [(100, [0.0] * 6, 0), (100, [1.0] * 6, 9), rows[8], rows[8]]  # ids that come again
    rows += [(None, [1.0] * 6, 1), (2000, None, 1), (2001, [1.0] * 6, None), (2002, [None] * 6, 1), (2003, [math.nan] * 6, 1),
             (2100, [math.inf] * 6, 1), (2200, [0.5, -0.25, 1.0], 1), (2201, [0.5, -0.25, 1.0], 2), (2202, [0.5, 0.0, 1.0], 1),
             (2300, [], 1), (2301, [], 1), (2302, [], 2), (2400, [-1.0, -2.0], 3)]
    expected = brute_negatives(rows, label_of)
    assert expected
    for more in ({}, {"shard_rows": 50, "block_rows": 2, "words": 5, "sample_rows": 64}, {"sample_rows": 1}):
        assert mined(spark, rows, **more) == expected


def test_negatives_of_empty_table_and_large_components(spark):
    assert mined(spark, []) == []
    rows = [(0, [2.0**30, 3.0], 1), (1, [2.0**30, 5.0], 1), (2, [2.0**30, 4.0], 2), (3, [2.0**29, 4.0], 2)]
    assert mined(spark, rows) == brute_negatives(rows, label_of)


def test_walk_is_ordered_and_ends_early():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 300, (8, 8))
    matrix = np.floor(centres[rng.integers(0, 8, 2000)] + rng.normal(0, 20, (2000, 8))).astype(np.int64)
    books = negatives.fit_codebooks(matrix.astype(float), 8)
    halves = [(matrix[:, :4].astype(float), books[0]), (matrix[:, 4:].astype(float), books[1])]
    words = [negatives._nearest(half, book) for half, book in halves]
    radii = [np.array([np.sqrt(((h[w == k] - b[k]) ** 2).sum(axis=1)).max(initial=0) for k in range(8)]) for (h, b), w in zip(halves, words)]
    cells = words[0] * 8 + words[1]
    order = np.argsort(cells, kind="stable")
    shard = negatives.Shard(np.arange(2000)[order], np.zeros(2000, np.int64), matrix[order], cells[order], radii, books)
    anchor = matrix[7]
    scored, visits = matrix @ anchor, list(shard.visits(anchor))
    assert sum(rows.stop - rows.start for *_, rows in visits) == 2000
    bounds = [most for most, *_ in visits]
    assert bounds == sorted(bounds, reverse=True)
    for most, least, _, rows in visits:
        own = scored[shard.ids[rows]]
        assert least <= own.min() and own.max() <= most
    shard.scores = lambda a, rows, f=shard.scores, seen=(seen := []): (seen.append(rows), f(a, rows))[1]
    ids, scores = shard.positives(7, 0, anchor, 5)
    others = np.delete(np.arange(2000), 7)
    assert ids.tolist() == others[np.lexsort((others, -scored[others]))[:5]].tolist() and (scores == scored[ids]).all()
    assert sum(rows.stop - rows.start for rows in seen) < 1000
