from __future__ import annotations

import math
import random
import re
import time
import tracemalloc
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_texts import sentence
from pyspark.sql import functions as F

from tidemark.llm import common, graph, quality, simhash, wordmodel

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fingerprint(text, size=3):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(values, radius=3):
    parent = {i: i for i in values}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in values:
        for b in values:
            if a < b and (values[a] ^ values[b]).bit_count() <= radius:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in values}


def test_fingerprint_across_blocks(monkeypatch):
    text = " ".join(sentence(i, 30) for i in range(20)) + "  \t\nEnd É"
    whole = brute_fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK", 100)
    assert simhash.fingerprint(text) == whole
    assert simhash.fingerprint("A b") == brute_fingerprint("a B") and simhash.fingerprint(None) == 0


def test_documents_against_brute_force(docs, nasty):
    rows = [(i, sentence(i // 4, 80) + f" tail{i}", "en", "a") for i in range(100, 220)] + nasty
    got = simhash.near_duplicates(docs(rows, clashing=True)).collect()
    assert len(got) == len(rows)
    values = {i: brute_fingerprint(t) for i, t, *_ in rows if i is not None}
    classes = brute_classes(values)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            assert r["fingerprint"] == f"{values[r['doc_id']]:016x}" and r["component_id"] == classes[r["doc_id"]]


def test_trees_of_chunks_lose_no_link(spark, monkeypatch):
    rng = random.Random(4)
    centres = [rng.getrandbits(64) for _ in range(3)]
    near = {c ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 4))) & (1 << 64) - 1 for c in centres for _ in range(150)}
    values = {i: v for i, v in enumerate(sorted(near))}
    rows = [(i, str(i)) for i in values]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    signed = {str(i): v - (1 << 64) if v >> 63 else v for i, v in values.items()}
    monkeypatch.setattr(
        simhash, "fingerprints",
        lambda d, *_: d.select("doc_id", F.create_map(*[F.lit(x) for p in signed.items() for x in p])[F.col("text")].alias("fp")),
    )
    expected = brute_classes(values)
    for chunk in (7, 4096):
        got = simhash.near_duplicates(df, chunk=chunk).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == expected


def test_bk_forest_finds_all_pairs():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 1 << 8, 300).astype(np.uint64)
    group = np.sort(rng.integers(0, 9, 300))
    fps = np.array([int(f) + 256 * i % 1024 for i, f in enumerate(fps)], dtype=np.uint64)
    every = np.ones(300, bool)
    got = {(int(x), int(y)) for a, b in simhash.linked_pairs(fps, group, every, every, 2) for x, y in zip(a, b)}
    expected = {
        (i, j) for i in range(300) for j in range(300)
        if i != j and group[i] == group[j] and (int(fps[i]) ^ int(fps[j])).bit_count() <= 2
    }
    assert {tuple(sorted(p)) for p in got} == {tuple(sorted(p)) for p in expected}


def test_keep_one(docs, nasty):
    rows = [*nasty, (50, sentence(5, 60), "en", "z")]
    kept = simhash.keep_one(docs(rows, clashing=True))
    assert kept.columns == docs(rows, clashing=True).columns
    ids = sorted(r["doc_id"] for r in kept.where("doc_id IS NOT NULL").collect())
    classes = brute_classes({i: brute_fingerprint(t) for i, t, *_ in rows if i is not None})
    assert ids == sorted(set(classes.values()))
    assert kept.where("doc_id IS NULL").count() == 2
    assert simhash.keep_one(docs([])).count() == 0


def test_components_of_long_chain_and_hub(spark):
    chain = [(i + 1, i) for i in range(200)]
    hub = [(1000, 2000 + i) for i in range(300)] + [(None, 5), (7, 7)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(chain + hub, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(201)} | {1000: 1000} | {2000 + i: 1000 for i in range(300)}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_surface_counts_against_brute_force():
    rng = random.Random(3)
    pieces = ["a", "b", "c", "\n", " ", "\t", "é", "#", "a b c a b", "\x0b", "\x1c", " ", "||", "a b a b a b\n"]
    for _ in range(800):
        text = "".join(rng.choices(pieces, k=rng.randint(0, 60)))
        assert quality.surface_counts(text) == brute_counts(text)


def test_model_is_a_distribution_and_backs_off():
    rng = np.random.default_rng(2)
    text = "".join(rng.choice(list("abcd "), 3000))
    grams = np.concatenate(list(quality.packed_ngrams(text)))
    model = quality.kneser_ney(*np.unique(grams, return_counts=True))
    for context in ("ab", "zz", " a"):
        packed = np.array([(ord(context[0]) << 7 | ord(context[1])) << 7 | c for c in range(128)])
        total = (2.0 ** quality.log_probability(model, packed)).sum()
        assert total == pytest.approx(1.0, abs=0.02)


def triples(text):
    return [(int(g) >> 14, int(g) >> 7 & 127, int(g) & 127) for part in quality.packed_ngrams(text) for g in part]


def brute_model(texts):
    """Modified Kneser-Ney by its formulas, with dictionaries; what only the scored text has counts as unseen."""
    top = Counter(g for t in texts for g in triples(t))
    levels = [None, None, None, top]
    for n in (2, 1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])

    def times(counted):
        return [None, *(sum((Counter({g[3 - n :]: c}) for g, c in counted.items()), Counter()) for n in (1, 2, 3))]

    everywhere = times(top)

    def discounts(counts):
        c = Counter(counts.values())
        n = [c[i] for i in (1, 2, 3, 4)]
        if min(n) == 0:
            return 0.5, 0.75, 0.9
        y = n[0] / (n[0] + 2 * n[1])
        return tuple(min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.05), i - 0.05) for i in (1, 2, 3))

    cut = [None, *(discounts(levels[n]) for n in (1, 2, 3))]

    def left(context):
        followers = {g: c for g, c in levels[len(context) + 1].items() if g[:-1] == context}
        total = sum(followers.values())
        return sum(cut[len(context) + 1][min(c, 3) - 1] for c in followers.values()) / total, total

    def p(gram):
        n = len(gram)
        lower = 1 / 128 if n == 1 else p(gram[1:])
        free, total = left(gram[:-1])
        kept = levels[n][gram]
        return (kept - cut[n][min(kept, 3) - 1]) / total + free * lower

    def bits(text):
        own = times(Counter(triples(text)))

        def score(gram):
            n = len(gram)
            if n == 0:
                return left(())[0] / 128
            if everywhere[n][gram] > own[n][gram]:
                return p(gram)
            context = gram[:-1]
            weight = left(context)[0] if n > 1 and everywhere[n - 1][context] > own[n - 1][context] else 1.0
            return weight * score(gram[1:])

        found = triples(text)
        return -sum(math.log2(score(g)) for g in found) / len(found)

    return bits


def test_bits_against_brute_force(docs):
    rows = [(i, sentence(i, 15), "en", "a") for i in range(6)] + [(9, "zu ab zu", None, "a"), (10, " ", "en", "a")]
    df = docs(rows)
    models = quality.train(df)
    got = {r["doc_id"]: r["bits"] for r in quality.score(df, models, "text", "lang", ["doc_id"]).collect()}
    for lang in ("en", None):
        own = [(i, t) for i, t, x, _ in rows if x == lang]
        bits = brute_model([t for _, t in own])
        for i, t in own:
            assert got[i] is None if not t.strip() else got[i] == pytest.approx(bits(t))


def test_verdicts_hold_out(docs, nasty):
    rng = random.Random(8)
    good = [(i, sentence(i, rng.randint(20, 200)), "en", "a") for i in range(1000, 1150)]
    noise = [(i, " ".join("".join(chr(rng.randint(33, 126)) for _ in range(7)) for _ in range(60)), "en", "a") for i in range(2000, 2006)]
    flat = [(3000, " ".join("a" * n for n in range(1, 80)), "en", "a")]
    short = [(3001, "too few words", "en", "a"), (3002, "say it once more now " * 30, "en", "a")]
    rows = good + noise + flat + short
    got = {r["doc_id"]: r for r in quality.judge(docs(rows)).collect()}
    assert all(got[i]["kept"] for i, *_ in good)
    assert not any(got[i]["kept"] or got[i]["base_failed"] for i, *_ in noise + flat)
    assert all(got[i]["base_failed"] and not got[i]["kept"] for i, *_ in short)
    df = docs(nasty, clashing=True)
    kept = quality.keep_good(df)
    assert kept.columns == df.columns
    counts = [(i, *brute_counts(t)) for i, t, *_ in nasty]
    expected = [i for i, n, *_, repeated in counts if n >= 10 and 100 * repeated <= 20 * n]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, expected))
    assert quality.judge(docs([])).count() == 0


def brute_word_bits(texts):
    """Bits a word of each text by what the other different texts hold, with dictionaries."""
    texts = list(dict.fromkeys(texts))
    words = [["<", "<<", *re.sub("[0-9]+", "0", t.lower()).split()] for t in texts]
    held = [{tuple(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)} for w in words]
    size = [len(set(w[2:])) for w in words]
    out = {}
    for d, w in enumerate(words):
        others = Counter(g for e, own in enumerate(held) if e != d for g in own)
        others[()] = sum(size) - size[d]
        total = 0.0
        for i in range(2, len(w)):
            for n in (3, 2, 1):
                gram = tuple(w[i - n + 1 : i + 1])
                if others[gram]:
                    total -= math.log2(0.4 ** (3 - n) * others[gram] / others[gram[:-1]])
                    break
            else:
                total -= math.log2(0.4**3 / (others[()] + 1))
        out[texts[d]] = total / (len(w) - 2)
    return out


def test_word_model_against_brute_force(docs, monkeypatch):
    monkeypatch.setattr(wordmodel, "BLOCK_BYTES", 300)
    monkeypatch.setattr(wordmodel, "RANGE_GRAMS", 50)
    rows = [(i, sentence(i % 9, 5 + 3 * (i % 9)), ["en", "de"][i % 2], "a") for i in range(40)] + [(90, " ", "en", "a")]
    texts, ranges = wordmodel.texts_by_block(docs(rows), "text", "lang")
    assert ranges > 3
    a, b = wordmodel.text_key(F.col("lang"), F.col("text"))
    keys = {(r["a"], r["b"]): (r["lang"], r["text"]) for r in docs(rows).select("lang", "text", a.alias("a"), b.alias("b")).collect()}
    got = {keys[r["a"], r["b"]]: r["word_bits"] for r in wordmodel.score_words(texts, ranges).collect()}
    wanted = {(x, t): v for x in ("en", "de") for t, v in brute_word_bits([r[1] for r in rows if r[2] == x and r[1].strip()]).items()}
    assert got == pytest.approx(wanted)


@pytest.mark.parametrize("letters", ["abcdefghij", "абвгдежзик", "".join(map(chr, range(0x4E00, 0x5200)))], ids=["latin", "cyrillic", "han"])
def test_words_in_no_order_are_noise(docs, letters):
    """Texts from a few phrases stay; the same words without their order go, in any script."""
    rng = random.Random(4)
    words = ["".join(rng.choices(letters, k=5)) for _ in range(300)]
    phrases = [rng.sample(words, 6) for _ in range(60)]
    good = [(i, " ".join(w for p in rng.choices(phrases, k=20) for w in p), "xx", "a") for i in range(150)]
    mixed = []
    for i in range(6):
        own = good[i][1].split()
        rng.shuffle(own)
        mixed.append((1000 + i, " ".join(own), "xx", "a"))
    got = {r["doc_id"]: r["kept"] for r in quality.judge(docs(good + mixed), max_repeat_percent=100).collect()}
    assert all(got[i] for i, *_ in good) and not any(got[i] for i, *_ in mixed)


def test_copies_of_noise_do_not_vouch_for_it(docs):
    rng = random.Random(8)
    rows = [(i, sentence(i, rng.randint(20, 200)), "en", "a") for i in range(150)]
    copies = []
    for times in (2, 5, 20):
        noise = " ".join("".join(chr(rng.randint(33, 126)) for _ in range(7)) for _ in range(60))
        copies += [(1000 * times + i, noise, "en", "a") for i in range(times)]
    got = {r["doc_id"]: r["kept"] for r in quality.judge(docs(rows + copies)).collect()}
    assert all(got[i] for i, *_ in rows) and not any(got[i] for i, *_ in copies)


def test_votes_of_more_texts_than_fit_beside_an_ngram():
    texts = [wordmodel.word_ngrams(f"w{i % 9} w{i % 7} w{i % 9}", "en") for i in range((1 << wordmodel.TEXT_BITS) + 50)]
    expected = Counter()
    for grams in texts:
        expected.update(set(np.concatenate(grams).tolist()))
        expected[int(grams[0][0])] += len(set(grams[1][2:].tolist())) - 1
    known, n = wordmodel.block_votes(texts)
    assert known.tolist() == sorted(expected) and dict(zip(known.tolist(), n.tolist())) == expected
    assert wordmodel.own_words(texts).tolist() == [len(set(g[1][2:].tolist())) for g in texts]


def test_batches_are_bounded(docs, spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for given, left in (("10000", "2000"), ("0", "2000"), ("50", "50")):
            spark.conf.set(name, given)
            quality.judge(docs([(1, sentence(1, 40))]))
            assert spark.conf.get(name) == left
    finally:
        spark.conf.set(name, before)


def test_release_drops_shuffles_of_stored_tables(spark):
    def shuffles():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in files.mkString("\n").split("\n") if "shuffle_" in f}

    before = shuffles()
    common.stored(spark.range(10_000).groupBy(F.col("id") % 100).count(), "released")
    made = shuffles() - before
    common.release(spark)
    end = time.time() + 5
    while made & shuffles() and time.time() < end:
        time.sleep(0.1)
    assert made and not made & shuffles()


def test_different_texts_are_counted_in_one_pass(docs):
    rows = [(i, sentence(i % 12, 20 + i % 12), ["en", "de"][i % 2], "a") for i in range(40)] + [(50, " ", "en", "a"), (51, None, "en", "a")]
    counted = quality.count_distinct_ngrams(wordmodel.texts_by_block(docs(rows), "text", "lang")[0])
    expected = Counter()
    for _, text, lang in {(0, r[1], r[2]) for r in rows if r[1] and r[1].strip()}:
        for part in quality.packed_ngrams(text):
            expected.update((lang, int(g)) for g in part)
    assert {(r["lang"], r["gram"]): r["n"] for r in counted.collect()} == expected
    plan = counted._jdf.queryExecution().sparkPlan().toString()
    # copies are left out before the shuffle of texts; behind it, each task needs one worker
    assert plan.count("FlatMapGroupsInArrow") == 1 and plan.count("MapInArrow") == 1


def test_votes_of_a_block_take_a_few_times_its_ngrams():
    texts = [wordmodel.word_ngrams(sentence(i, 1000), "en") for i in range(300)]
    size = sum(g.nbytes for grams in texts for g in grams)
    tracemalloc.start()
    try:
        wordmodel.block_votes(texts)
        assert tracemalloc.get_traced_memory()[1] < 2 * size
    finally:
        tracemalloc.stop()
