"""The registered queries over the smallest test tables against brute force, and the pipeline over small documents."""

from __future__ import annotations

import hashlib
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_texts import sentence
from pyspark.sql import functions as F
from test_documents import KINDS, brute_passages, brute_spans, brute_strings
from test_near_duplicates_and_quality import brute_classes, brute_counts, brute_fingerprint, brute_model
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import mixing
from tidemark.llm.queries import LANGUAGES, ORACLE_SQL, QUERIES, SOURCES, TOPICS, topic_of

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def answer(spark, key):
    return {r["doc_id"]: r for r in QUERIES[key](spark, SF_DIR).collect()}


def test_all_thirteen_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)


@tables
def test_mixing_query_probabilities(spark, texts):
    got = answer(spark, "op1_mixing")
    assert set(got) == set(texts)
    assert all(r["n_tokens"] == len(texts[i].encode().split()) and 0 <= r["probability"] <= 1 for i, r in got.items())


@tables
def test_personal_data_query(spark, texts):
    got = answer(spark, "op4_pii")
    names = list(KINDS)
    for i, text in texts.items():
        spans = brute_spans(text)
        assert got[i]["base_sha256"] == sha(",".join(f"{names[k]}:{s}:{e}" for k, s, e in spans))
        assert [got[i][f"n_{k}"] for k in names] == [sum(s[0] == n for s in spans) for n in range(4)]


@tables
def test_substring_queries(spark, texts):
    rows = list(texts.items())
    got = answer(spark, "op5_suffixes")
    for i, n_bytes, n_removed, n_spans, kept in brute_strings(rows, 50):
        r = got[int(i)]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (n_bytes, n_removed, n_spans, sha(kept))
    got = answer(spark, "op10_passages")
    for i, n_words, n_removed, kept in brute_passages(rows, 20):
        r = got[int(i)]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (n_words, n_removed, sha(kept))


@tables
def test_packing_query(spark, texts):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, sequences = {}, {}
    for r in QUERIES["op6_packing"](spark, SF_DIR).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    for i, text in texts.items():
        ids, start = [*plain.encode(text, add_special_tokens=False).ids, 0], 0
        for n, r in enumerate(sorted(pieces[i], key=lambda r: r["piece"])):
            own = np.array(ids[start : start + r["length"]], dtype="<u4")
            assert (r["piece"], r["start"], r["ids_crc32"]) == (n, start, zlib.crc32(own.tobytes()))
            assert r["length"] == 2048 or n == 0
            start += r["length"]
        assert start == len(ids)
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == list(np.cumsum([0, *[n for _, n in places[:-1]]]))
        assert sum(n for _, n in places) <= 2048
    total = sum(r["length"] for rows in pieces.values() for r in rows)
    assert len(sequences) <= -(-total // 2048) + 1


@tables
def test_quality_and_simhash_queries(spark, texts):
    got = answer(spark, "op8_quality")
    for i, text in texts.items():
        n, chars, symbols, dup, repeat = brute_counts(text)
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            n, chars, symbols, dup, repeat,
        )
        assert r["base_failed"] == (n < 10 or 100 * repeat > 20 * n) and not (r["base_failed"] and r["kept"])
    got = answer(spark, "op9_simhash")
    values = {i: brute_fingerprint(t) for i, t in texts.items()}
    classes = brute_classes(values)
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {
        i: (f"{v:016x}", classes[i]) for i, v in values.items()
    }


def quartile_band(bits):
    binned = sorted(int(np.floor(b * 1000)) for b in bits)
    q1, q3 = (next(v for n, v in enumerate(binned, 1) if n / len(binned) >= share) for share in (0.25, 0.75))
    room = max((q3 - q1) / 1000 * 6, 1.0)
    return q1 / 1000 - room, q3 / 1000 + room


def test_pipeline_stages_against_brute_force(spark, docs, nasty):
    rows = [(100 + i, sentence(i, 40 + i), ["en", "de"][i % 2], f"src{i % 3}") for i in range(20)]
    rows += [(150 + i, f"{sentence(i, 60)} mail {i}x@site.example.org now", "en", "src1") for i in range(6)]
    rows += [(200 + i, sentence(i, 40 + i), "en", "src0") for i in range(3)]  # copies
    rows += [r for r in nasty if r[0] is None or r[0] not in (7, 10)]
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5
    start = docs(rows)

    good = stages["quality rules"](spark, start, "").cache()
    kept = []
    for lang in {r[2] for r in rows}:
        own = [r for r in rows if r[2] == lang]
        bits = brute_model([r[1] or "" for r in own])
        scored = [(r, bits(r[1])) for r in own if (r[1] or "").strip()]
        low, high = quartile_band([b for _, b in scored])
        for r, b in scored:
            n, _, _, _, repeat = brute_counts(r[1])
            if n >= 10 and 100 * repeat <= 20 * n and low <= b <= high:
                kept.append(r)
    assert sorted(str((r["doc_id"], r["text"])) for r in good.collect()) == sorted(str((r[0], r[1])) for r in kept)

    unique = stages["near-duplicates"](spark, good, "").cache()
    classes = brute_classes({r[0]: brute_fingerprint(r[1]) for r in kept if r[0] is not None})
    assert sorted(str(r["doc_id"]) for r in unique.collect()) == sorted(
        [str(i) for i in set(classes.values())] + ["None" for r in kept if r[0] is None]
    )

    redacted = stages["personal data"](spark, unique, "").cache()
    before = {r["doc_id"]: r["text"] for r in unique.where("doc_id IS NOT NULL").collect()}
    names = list(KINDS)
    for r in redacted.where("doc_id IS NOT NULL").collect():
        text = before[r["doc_id"]]
        for k, s, e in sorted(brute_spans(text), key=lambda x: -x[1]):
            text = text[:s] + f"<{names[k]}>" + text[e:]
        assert r["text"] == text and r["n_chars"] == len(text)

    drawn = stages["source mixing"](spark, redacted, "").cache()
    cells, tokens = {}, {}
    for r in redacted.withColumn("topic", topic_of(F.col("text"))).collect():
        cell = tuple(v if v in target else None for v, target in zip((r["source"], r["lang"], r["topic"]), (SOURCES, LANGUAGES, TOPICS)))
        cells.setdefault(cell, []).append(r)
        tokens[cell] = tokens.get(cell, 0) + len(r["text"].encode().split())
    order = sorted(cells, key=str)
    values = [sorted({c[d] for c in order}, key=str) for d in range(3)]
    members = [np.array([values[d].index(c[d]) for c in order]) for d in range(3)]
    targets = [np.array([t.get(v, 0.0) for v in vs]) for vs, t in zip(values, (SOURCES, LANGUAGES, TOPICS))]
    have = np.array([tokens[c] for c in order])
    wanted = mixing.rake(have, members, targets, 0.5 * have.sum()) / have
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(7), F.col("doc_id"), F.col("text")), 11) / float(1 << 53)
    chances = {str((r["doc_id"], r["text"])): r["u"] for r in redacted.withColumn("u", draw).collect()}
    expected = [
        k for c, p in zip(order, wanted) for k in (str((r["doc_id"], r["text"])) for r in cells[c]) if chances[k] < p - 1e-9
    ]
    assert sorted(str((r["doc_id"], r["text"])) for r in drawn.collect()) == sorted(expected)
    assert drawn.columns == start.columns

    packed = stages["packing"](spark, drawn, "").collect()
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = {}
    for r in sorted(packed, key=lambda r: r["piece"]):
        found.setdefault(r["doc_id"], []).extend(r["ids"])
    for r in drawn.where("doc_id IS NOT NULL").collect():
        assert found[r["doc_id"]] == [*plain.encode(r["text"], add_special_tokens=False).ids, 0]
