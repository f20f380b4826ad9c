"""Mixing, personal data, packing, pages and the two substring operators on small documents."""

from __future__ import annotations

import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_texts import sentence
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import html, mixing, packing, passages, pii, recurring, suffixes

PATH = public_tokenizers.path("byte_bpe_50k.json")


# mixing


def test_rake_meets_marginals_and_never_takes_more_than_there_is():
    rng = np.random.default_rng(1)
    members = [rng.integers(0, n, 60) for n in (4, 3, 2)]
    tokens = rng.integers(500, 2000, 60)
    targets = [np.array([0.4, 0.3, 0.2, 0.1]), np.array([0.5, 0.3, 0.2]), np.array([0.6, 0.4])]
    drawn = mixing.rake(tokens, members, targets, 0.2 * tokens.sum())
    assert (drawn <= tokens).all()
    for member, target in zip(members, targets):
        assert np.bincount(member, weights=drawn) / drawn.sum() == pytest.approx(target, abs=1e-4)
    scarce = mixing.rake(tokens, members, targets, 0.9 * tokens.sum())
    assert (scarce <= tokens + 1e-9).all() and scarce.sum() > 0


def test_mix_draws_the_calibrated_share(docs, nasty):
    rows = [(i, sentence(i, 40), ["en", "de"][i % 3 == 0], f"s{i % 5}") for i in range(3000)]
    topic = F.when(F.col("doc_id") % 7 < 3, "even").otherwise("odd")
    shares = ({f"s{i}": w for i, w in enumerate((0.4, 0.2, 0.2, 0.1, 0.1))}, {"en": 0.5, "de": 0.5}, {"even": 0.5, None: 0.5})
    got = mixing.mix(docs(rows), topic, *shares, share=0.3).toPandas()
    expected = (got.probability * got.n_tokens).groupby(got.source).sum()
    assert (expected / expected.sum()).tolist() == pytest.approx([0.4, 0.2, 0.2, 0.1, 0.1], abs=1e-3)
    assert expected.sum() == pytest.approx(0.3 * got.n_tokens.sum(), rel=1e-3)
    drawn = got[got.sampled].groupby("source").n_tokens.sum()
    assert (drawn / drawn.sum()).tolist() == pytest.approx([0.4, 0.2, 0.2, 0.1, 0.1], abs=0.05)
    df = docs(nasty, clashing=True)
    all_of = mixing.mix(df, topic, {"a": 1.0, None: 0.2}, {"en": 1.0, None: 0.2}, {None: 1.0}, share=0.5, keep=df.columns)
    assert all_of.count() == len(nasty) and all_of.where("_probability IS NULL OR _sampled IS NULL").count() == 0
    assert mixing.sample(df, topic, {"a": 1.0}, {"en": 1.0}, {None: 1.0}).columns == df.columns
    assert mixing.sample(docs([]), topic, *shares).count() == 0
    unnamed = mixing.mix(docs(nasty), topic, {"b": 1.0}, {None: 1.0}, {None: 1.0}).where("sampled")
    assert {r["source"] for r in unnamed.collect()} <= {"b"}


# personal data

KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def brute_spans(text):
    out = []
    for number, (kind, pattern) in enumerate(KINDS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(len(p.lstrip("0")) > 3 or int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((number, m.start(), m.end()))
    return out


def test_base_spans_against_plain_patterns():
    rng = random.Random(6)
    pieces = ["a", "@", ".", "b.c", "x@y.zz", "1", "255.", "10.0.0.1", "4111 1111 1111 1111", "+1 (234) 555-0199", "-", " ",
              "é", "%", "+", "(", "9" * 15, "٣", "@@", "a@b", "_", "\n"]
    for _ in range(4000):
        text = "".join(rng.choices(pieces, k=rng.randint(0, 12)))
        assert sorted(pii.base_spans(text)) == sorted(brute_spans(text)), repr(text)
    assert pii.base_spans("9" * 6000 + ".1.1.1") == []


def test_contexts_find_unseen_identifiers(docs, nasty):
    rows = [(i, f"{sentence(i, 20)} mail me at user{i}@site{i}.example.org soon", "en", "a") for i in range(8)]
    rows += [(20, "you can mail me at user9_at_home_dot_org today", "en", "a")]
    # a context that mostly stands before other things proves nothing
    rows += [(30 + i, f"look here at version{i}.beta now", "en", "a") for i in range(8)]
    rows += [(50, "look here at u7@a.example.com", "en", "a")]
    got = {r["doc_id"]: r["spans"] for r in pii.find(docs(rows)).collect()}
    text = rows[8][1]
    assert [(s["kind"], text[s["start"] : s["end"]]) for s in got[20]] == [("id", "user9_at_home_dot_org")]
    assert all(not got[30 + i] for i in range(8)) and [s["kind"] for s in got[50]] == ["email"]
    redacted = {r["doc_id"]: r["text"] for r in pii.redact(docs(rows)).collect()}
    assert redacted[20] == "you can mail me at <id> today"
    assert redacted[3].endswith("mail me at <email> soon")
    df = docs([*nasty, *rows], clashing=True)
    assert pii.redact(df).columns == df.columns and pii.redact(df).count() == len(rows) + len(nasty)
    assert pii.find(docs([])).count() == 0


@pytest.mark.parametrize(
    "shape",
    ["Email: {}", "{} is my address", "Contact address\n\n  {}\nthanks", "Contact:\n{}", "word{n} email: {} word{n}", "say{n} {} replied"],
)
def test_contexts_of_labels_and_words_behind(docs, shape):
    def text(n, value):
        return f"{sentence(n, 12)}\n" + shape.replace("{n}", "abcdefghijkl"[n]).replace("{}", value)

    rows = [(i, text(i, f"user{i}@site{i}.example.org"), "en", "a") for i in range(8)]
    rows += [(9, text(9, "user9_at_home_dot_org"), "en", "a"), (10, f"{sentence(3, 9)}\nsee version9.beta there", "en", "a")]
    got = {r["doc_id"]: r["text"] for r in pii.redact(docs(rows)).collect()}
    assert got[9] == text(9, "<id>") and got[10] == rows[-1][1]


def test_contexts_settle_after_many_hops(spark):
    """Two patterns on each level stand beside six instances of it and three of the next one."""
    rows = []
    for level in range(8):
        for p in range(2):
            rows += [(f"{level}{p}", f"{level}-{i}", level == 0) for i in range(6)]
            rows += [(f"{level}{p}", f"{level + 1}-{3 * p + i}", False) for i in range(3)]
    uses = spark.createDataFrame(rows, "pattern string, instance string, known boolean")
    assert {r["pattern"] for r in pii.score_patterns(uses).collect()} == {f"{n}{p}" for n in range(8) for p in range(2)}


def test_labelled_keys_are_found_and_common_words_prove_nothing(docs):
    rng = random.Random(3)

    def key(n=40):
        return "".join(rng.choices("0123456789abcdef", k=n))

    rows = [(i, f'{sentence(i, 20)} token = "{key()}" and more', "en", "a") for i in range(6)]
    rows += [(10, f'{sentence(10, 20)} token = "ab12cd" and more', "en", "a")]
    # keys behind words that mostly stand elsewhere, and one behind a word of its own
    rows += [(20 + i, f"the river{c} of the hill{c} the {key()} of rain{c} in the house of stone", "en", "a") for i, c in enumerate("abcdef")]
    rows += [(30, f"seen once beside {key()} only", "en", "a"), (31, "bought for the 1234567890123456 people", "en", "a")]
    got = {r["doc_id"]: r["spans"] for r in pii.find(docs(rows)).collect()}
    for i, text, *_ in rows:
        shown = [text[s["start"] : s["end"]] for s in got[i] if s["kind"] == "id"]
        assert shown == ([text.split('"')[1]] if "token" in text else []), text


def test_places_of_words_are_counted_in_whole_texts(docs):
    texts = [None, "", "Mail me:\nmail ME at 12", "x (mail) me\r\n12", "mail\u00a0me " * 3000]
    keys = {pii.sequence_key(w): w for w in ("mail me", "me", "^ mail", "me $", "0 $", "never there")}
    spark_keys = docs([]).sparkSession.createDataFrame([(k,) for k in keys], "key long")
    got = {keys[r["key"]]: r["places"] for r in pii.count_places(docs([(i, t) for i, t in enumerate(texts)]), "text", spark_keys).collect()}
    assert got == {"mail me": 3003, "me": 3003, "^ mail": 3, "me $": 3, "0 $": 2}


def test_long_runs_take_linear_time():
    start = time.process_time()
    for text in ("9" * 1_000_000, "a=" * 300_000, "1." * 200_000, "a@" * 300_000, "+1 " * 200_000):
        pii.occurrences(text)
    assert time.process_time() - start < 10


def test_spans_of_a_whole_long_text(docs):
    text = "word " * 200_000 + "mail a@b.co"
    (row,) = pii.find(docs([(1, text)]), keep=["doc_id"]).collect()
    assert [(s["kind"], s["start"], s["end"]) for s in row["spans"]] == [("email", 1_000_005, 1_000_011)]


# packing


def test_tokenizer_gives_the_ids_of_the_vocabulary():
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    with open(PATH, encoding="utf-8") as file:
        own = packing.Tokenizer(file.read())
    rng = random.Random(3)
    pieces = ["a", " ", "  ", "\n", " \n", "\t", "Hello", " 's", "é", " ", "123", "!!", "<|endoftext|>", "\x1c", "日本", "🙂"]
    for _ in range(3000):
        text = "".join(rng.choices(pieces, k=rng.randint(0, 12)))
        assert own.ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_added_tokens_of_the_file(docs):
    """Against the file loaded as it is."""
    plain = Tokenizer.from_file(PATH)
    rng = random.Random(7)
    pieces = ["a", " ", "  ", "\n", "Hello", "<|endoftext|>", "<|endof", "text|>", "é", "1", "<|endoftext|>"]
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> ", *("".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(300))]
    got = packing.pack(docs([(i, t, "en", "a") for i, t in enumerate(texts)]), PATH, with_ids=True).collect()
    assert {r["doc_id"]: r["ids"] for r in got} == {
        i: [*plain.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)
    }


def brute_fewest(lengths, capacity):
    """Fewest sequences of a handful of pieces, by trying every place."""
    best = len(lengths)

    def place(i, spaces):
        nonlocal best
        if len(spaces) >= best:
            return
        if i == len(lengths):
            best = len(spaces)
            return
        for n in range(len(spaces)):
            if spaces[n] >= lengths[i]:
                place(i + 1, [*spaces[:n], spaces[n] - lengths[i], *spaces[n + 1 :]])
        place(i + 1, [*spaces, capacity - lengths[i]])

    place(0, [])
    return best


def planned(lengths, capacity):
    counts = np.bincount(lengths, minlength=capacity + 1)
    plan = packing.plan_sequences(counts, capacity)
    held = Counter()
    for config, n in plan:
        assert sum(config) <= capacity and n > 0
        held.update({length: config.count(length) * n for length in set(config)})
    assert held == Counter(lengths)
    return sum(n for _, n in plan)


def test_plan_against_brute_force_and_bound():
    rng = random.Random(1)
    for _ in range(60):
        lengths = [rng.randint(1, 20) for _ in range(9)]
        assert planned(lengths, 20) <= brute_fewest(sorted(lengths, reverse=True), 20) + 1
    lengths = [rng.randint(1, 128) for _ in range(30_000)]
    assert planned(lengths, 128) <= -(-sum(lengths) // 128) * 1.002 + 1
    assert planned([20] * 5, 20) == 5


def one_by_one(lengths, capacity):
    """Best-fit decreasing, piece by piece."""
    spaces = []
    for length in sorted(lengths, reverse=True):
        fits = [s for s in spaces if s >= length]
        if fits:
            spaces.remove(min(fits))
        spaces.append((min(fits) if fits else capacity) - length)
    return sorted(spaces)


def test_bulk_best_fit_against_one_by_one():
    rng = random.Random(5)
    for _ in range(300):
        capacity = rng.choice([5, 20, 50])
        lengths = rng.choices(rng.sample(range(1, capacity + 1), rng.randint(1, min(capacity, 8))), k=rng.randint(0, 60))
        plan = packing.best_fit(np.bincount(lengths, minlength=capacity + 1).astype(np.int64), capacity)
        assert sorted(capacity - sum(config) for config, n in plan for _ in range(n)) == one_by_one(lengths, capacity)
        assert sorted(x for config, n in plan for x in config * n) == sorted(lengths)


def test_plan_of_hot_lengths_is_in_bulk():
    rng = np.random.default_rng(3)
    hot = np.zeros(2049, np.int64)
    hot[1:2049] = rng.integers(0, 2000, 2048)
    hot[1400] = 50_000_000
    middle = np.zeros(2049, np.int64)
    middle[1030:1900] = rng.integers(50_000, 100_000, 870)
    for counts in (hot, middle):
        plan = packing.plan_sequences(counts, 2048)
        held = np.zeros(2049, np.int64)
        for config, n in plan:
            assert sum(config) <= 2048 and n > 0
            np.add.at(held, list(config), n)
        assert (held == counts).all() and len(plan) < 20_000
        # no two of the long pieces fit one sequence
        assert sum(n for _, n in plan) >= counts[1025:].sum()
    assert sum(n for _, n in plan) == middle.sum()


def test_pack_places_every_piece(docs, nasty):
    df = docs(nasty, clashing=True)
    plain = Tokenizer.from_file(PATH)
    got = packing.pack(df, PATH, capacity=64, with_ids=True, bucket_rows=50).collect()
    rows = sorted(nasty, key=str)
    by_doc = {}
    for r in got:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) and len(r["ids"]) == r["length"]
        by_doc.setdefault(r["doc_id"], []).append(r)
    for i in {r[0] for r in rows}:
        wanted = sorted([*plain.encode(t or "", add_special_tokens=False).ids, 0] for j, t, *_ in rows if j == i)
        if len(wanted) == 1:
            pieces = sorted(by_doc[i], key=lambda r: r["piece"])
            assert [x for r in pieces for x in r["ids"]] == wanted[0]
            assert all(r["length"] == 64 for r in pieces[1:])
            assert [r["start"] for r in pieces] == list(np.cumsum([0, *[r["length"] for r in pieces[:-1]]]))
        assert sum(r["length"] for r in by_doc[i]) == sum(map(len, wanted))
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == list(np.cumsum([0, *[n for _, n in places[:-1]]])) and sum(n for _, n in places) <= 64
    total = sum(r["length"] for r in got)
    assert len(sequences) <= -(-total // 64) + 2
    assert packing.pack(docs([]), PATH).count() == 0


# pages


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


ARTICLE = "<p>" + "</p><p>".join(f"{sentence(i, 30)}, and more, {i}." for i in range(4)) + "</p>"
TEXT = "\n".join(f"{sentence(i, 30)}, and more, {i}." for i in range(4))


@pytest.mark.parametrize(
    "body",
    [
        f"<nav><ul><li><a href=/>Home</a></ul></nav><article>{ARTICLE}</article><footer>&copy; x</footer>",
        f"<div id=menu><a href=a>one</a></div><div class='post-body'>{ARTICLE}</div><div class='sidebar'><p>{sentence(9, 60)}</p></div>",
        f"<main><section>{ARTICLE}</section><form><p>name, and, so on<input></form></main><div id=comments><p>{sentence(8, 80)}</p></div>",
        f"<header><h2>Site</h2></header><script>var t='</p>';</script><div>{ARTICLE}<!-- <p>no</p> --></div><aside>{sentence(2, 40)}</aside>",
        f"<div class=cookie-notice>We, use, cookies.</div><div><div><div>{ARTICLE}</div></div></div><ul><li><a href=x>{sentence(3, 30)}</a></ul>",
        f"<div class='page has-sidebar'><div class='text'>{ARTICLE}</div></div><ol class=commentlist><li>{sentence(7, 90)}</ol>",
        f"<table><tr><td>{ARTICLE}</td><td class=ad>{sentence(4, 20)}</td></tr></table>",
        f"<article>{ARTICLE.replace('</p>', '')}<div class='share-buttons'>Share</div></article><dialog>hi</dialog>",
    ],
)
def test_main_text_of_pages(body):
    assert html.main_text(page(body)) == TEXT


@pytest.mark.parametrize(
    "body",
    [
        f"<nav>Home</nav><div class='elementor-widget-container'>{ARTICLE}</div><div class=sidebar>{sentence(2, 30)}</div>",
        f"<div class=page>" + "".join(f"<div class='widget-container'>{p}</p></div>" for p in ARTICLE.split("</p>")[:-1]) + "</div>",
        f"<div class=commentary>{ARTICLE}</div><div class=comments><p>{sentence(8, 80)}</p></div>",
        f"<article>{ARTICLE}<div class='share'><a href=x>Share</a></div><div class=related><a href=y>{sentence(3, 9)}</a></div></article>",
        f"<div id=overlay><div class='toc'><a href=a>One</a></div><section class=comments-on>{ARTICLE}</section></div>",
    ],
)
def test_names_alone_do_not_drop_text(body):
    assert html.main_text(page(body)) == TEXT


@pytest.mark.parametrize(
    "body",
    [
        f"<form id=aspnetForm action=x><input type=hidden><div id=content>{ARTICLE}</div><button>Send</button></form>",
        f"<form><div><nav>Home</nav><div>{ARTICLE}</div><form><label>Name</label><input></form></div></form>",
        f"<form><article>{ARTICLE}</article><fieldset><legend>Log in</legend><p>Your name, and word<select><option>one</select></p></fieldset></form>",
    ],
)
def test_a_page_within_a_form_keeps_its_article(body):
    assert html.main_text(page(body)) == TEXT


def test_forms_beside_the_text_go():
    login = "<form><p>Name, and password, please, to log in here.</p><input><textarea>old</textarea></form>"
    assert html.main_text(page(f"<div>{ARTICLE}</div>{login}")) == TEXT
    assert html.main_text(page(f"<article>{ARTICLE}{login}</article>")) == TEXT
    assert html.main_text(page(login)) == ""


def test_headline_formulas_and_short_pages_stay():
    headed = page(f"<article><div class='post-header'><h1>The headline</h1></div>{ARTICLE}</article>")
    assert html.main_text(headed) == "The headline\n" + TEXT
    assert html.main_text("<article><p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p></article>") == "so x=1 holds"
    assert html.main_text(page("<div class=comments><p>The only text of this page.</p></div>")) == "The only text of this page."


def test_blocks_references_and_white_space():
    text = "<article><h1>A &amp; B</h1><p>one<br>two \n\t <b>three</b>four &lt;p&gt; &eacute;&#33;<p>x < y, z > 1<ul><li>i<li>j</ul></article>"
    assert html.main_text(text) == "A & B\none two threefour <p> é!\nx < y, z > 1\ni\nj"


def test_odd_pages(spark):
    pages = [None, "", "plain text only", "<p", "<<<>>>", "</p></div>text", "<nav>only a menu</nav>", "<p class='a>b\">x</p>",
             "<div>" * 3000 + "deep" + "</div>" * 3000, "<p>" + "long, " * 200_000, "<!-- open", "<script>open"]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").select("*", F.lit(0).alias("text"))
    got = {r["page_id"]: r for r in html.extract(df).collect()}
    texts = [got[i]["_text"] for i in range(len(pages))]
    assert texts[:3] == ["", "", "plain text only"] and texts[5:7] == ["text", ""] and texts[8] == "deep"
    assert len(texts[9]) == 200_000 * 6 - 1 and texts[10:] == ["", ""]
    assert all(got[i]["n_chars"] == len(t) for i, t in enumerate(texts))
    assert html.extract(df.limit(0)).count() == 0


# repeated passages and strings


def substring_rows(nasty):
    rng = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(100 + i, f"{sentence(i, rng.randint(0, 25))} {passage} {sentence(i + 3, rng.randint(0, 25))}") for i in range(25)]
    rows += [(200 + i, passage[rng.randint(0, 60) : rng.randint(120, 230)] * rng.randint(1, 3)) for i in range(25)]
    rows += [(300 + i, "".join(rng.choices("ab \n", k=rng.randint(0, 300)))) for i in range(25)]
    rows += [(400, passage), (400, passage), (400, passage + " " + passage), (401, "é" * 60), (402, "xé" + "é" * 60)]
    return [(i, t) for i, t, *_ in nasty] + rows


def key(i):
    return 2**63 - 1 if i is None else i


def brute_passages(rows, window):
    first = {}
    words = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in words:
        for k in range(len(w) - window + 1):
            p = tuple(w[k : k + window])
            first[p] = min(first.get(p, (2**63, 0)), (key(i), k))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < (key(i), k):
                gone.update(range(k, k + window))
        out.append((str(i), len(w), len(gone), b" ".join(x for n, x in enumerate(w) if n not in gone).decode()))
    return sorted(out)


def brute_strings(rows, window):
    first = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for k in range(len(b) - window + 1):
            p = b[k : k + window]
            first[p] = min(first.get(p, 2**63), key(i))
    out = []
    for i, b in data:
        edge = np.zeros(len(b) + 1, np.int64)
        for k in range(len(b) - window + 1):
            if first[b[k : k + window]] < key(i):
                edge[k] += 1
                edge[k + window] -= 1
        gone = np.cumsum(edge[:-1]) > 0
        runs = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        out.append((str(i), len(b), int(gone.sum()), runs, np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return sorted(out)


@pytest.fixture(params=[(4096, 16384), (2, 40)], ids=["shards", "frequent"])
def bounds(request, monkeypatch):
    """Bounds of a shard: as in production, and so small that most anchors count as frequent."""
    often, shard_rows = request.param
    whole = recurring.recurring_ranges

    def bounded(*args, **kwargs):
        return whole(*args, often=often, shard_rows=shard_rows, **kwargs)

    monkeypatch.setattr(passages, "recurring_ranges", bounded)
    monkeypatch.setattr(suffixes, "recurring_ranges", bounded)


def test_passages_against_brute_force(docs, nasty, bounds, monkeypatch):
    monkeypatch.setattr(recurring, "BLOCK", 64)
    rows = substring_rows(nasty)
    got = passages.remove_repeated(docs([(*r, "en", "a") for r in rows], clashing=True)).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept"]) for r in got) == brute_passages(rows, 20)


def test_strings_against_brute_force(docs, nasty, bounds):
    rows = [(i, t) for i, t in substring_rows(nasty) if t is None or len(t) < 100_000]
    got = suffixes.remove_repeated(docs([(*r, "en", "a") for r in rows], clashing=True)).collect()
    found = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got)
    assert found == brute_strings(rows, 50)


def shard(contents):
    n = len(contents)
    return pa.table({"doc_id": pa.array(range(n), pa.int64()), "text_key": pa.array(range(n), pa.int64()),
                     "start": pa.array([0] * n, pa.int32()), "content": pa.array([c.encode() for c in contents], pa.binary())})


@pytest.mark.parametrize("limit", [None, 60])
def test_shard_with_more_words_than_letters(limit, monkeypatch):
    if limit:
        monkeypatch.setattr(passages, "LAST", 0x800 + limit)
        monkeypatch.setattr(passages, "SURROGATES", 22)
    rng = random.Random(3)
    passage = [[f"p{n}w{i}" for i in range(25)] for n in range(6)]
    contents = [" ".join([f"a{n}"] * (n % 3) + rng.choice(passage)[rng.randint(0, 5) :] + [f"b{n} c{n % 7}"]) for n in range(150)]
    got = passages.automaton_solver(8)(shard(contents)).to_pylist()
    gone = {}
    for r in got:
        gone.setdefault(r["doc_id"], set()).update(range(r["low"], r["high"]))
    for (i, _, n_removed, _), text in zip(sorted(brute_passages(list(enumerate(contents)), 8), key=lambda r: int(r[0])), contents):
        assert len(gone.get(int(i), ())) == n_removed


def test_shard_with_a_million_different_words():
    contents = [" ".join(f"{n}x{i}" for i in range(36)) for n in range(33_000)] + ["same " * 3 + " ".join(map(str, range(30)))] * 2
    got = passages.automaton_solver(20)(shard(contents)).to_pylist()
    assert [(r["doc_id"], r["low"], r["high"]) for r in got] == [(33_001, 0, 33)]


def test_documents_without_id_are_told_apart(docs):
    """Many texts without an id: each has its own list of places and ranges."""
    rows = [(None, f"{sentence(n, 30)} {sentence(0, 40)}") for n in range(1000)] + [(5, sentence(0, 40))]
    got = passages.remove_repeated(docs([(*r, "en", "a") for r in rows])).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept"]) for r in got) == brute_passages(rows, 20)


def test_substring_operators_without_documents(docs):
    assert passages.remove_repeated(docs([])).count() == 0 and suffixes.remove_repeated(docs([])).count() == 0


def test_word_hashes_do_not_depend_on_the_place(monkeypatch):
    rng = random.Random(2)
    words = ["a", "b", "ab", "ba", "é", "a" * 40, "\x1c", "word", "wordy", "\0", "\0\0"]
    for part in (7, 1 << 18):
        monkeypatch.setattr(passages, "PART", part)
        hashes = {}
        for _ in range(400):
            text = "".join(rng.choice(words) + rng.choice([" ", "  ", "\t\n", "\x0b "]) for _ in range(rng.randint(0, 20)))
            data = text.encode()
            units, slice_of = passages.word_units(data), passages._word_slicer(data)
            assert len(units) == len(data.split())
            assert slice_of(np.arange(len(units)), np.arange(len(units)) + 1) == data.split()
            for word, unit in zip(data.split(), units.tolist()):
                assert hashes.setdefault(word, unit) == unit
        assert len(set(hashes.values())) == len(hashes) == len(words)


@pytest.mark.parametrize("operator", [passages, suffixes])
def test_pieces_of_usual_anchors_are_not_stored(docs, operator, monkeypatch):
    tables, stored = {}, recurring.stored

    def noted(df, name, **options):
        tables[name] = stored(df, name, **options)
        return tables[name]

    monkeypatch.setattr(recurring, "stored", noted)
    rows = [(i, f"{sentence(i, 30)} {sentence(0, 40)}", "en", "a") for i in range(20)]
    assert operator.remove_repeated(docs(rows)).count() == 20
    held = [t for t in tables.values() if "content" in t.columns]
    assert held and all(t.where("content IS NOT NULL").count() == 0 for t in held)


def test_order_of_numbers_of_any_size():
    rng = np.random.default_rng(5)
    for top in (1, 3, 1 << 20, 1 << 62):
        keys = rng.integers(0, top, 3000)
        assert suffixes._order(keys, top).tolist() == np.argsort(keys, kind="stable").tolist()


def test_suffix_array_against_sorting():
    rng = random.Random(1)
    for _ in range(1500):
        symbols = [rng.randint(1, rng.choice([1, 2, 5])) for _ in range(rng.randint(0, 40))]
        expected = sorted(range(len(symbols)), key=lambda i: symbols[i:])
        assert suffixes.suffix_array(np.array(symbols, dtype=np.int64)).tolist() == expected


def test_pieces_alone_around_their_anchor_are_not_sorted(monkeypatch):
    rng = random.Random(3)

    def noise(n):
        return bytes(rng.choices(range(97, 123), k=n))

    def solved(texts):
        pieces = [
            (i, recurring.text_key(d), int(a), d[a : b + 50])
            for i, d in enumerate(texts)
            for _, first, last in recurring.anchors(suffixes.byte_units(d), 16, 50, suffixes.byte_hashes)
            for a, b in zip(first.tolist(), last.tolist())
        ]
        names = ["doc_id", "text_key", "start", "content"]
        got = suffixes.suffix_solver(50)(pa.table([pa.array(c) for c in zip(*pieces)], names=names)).to_pylist()
        return sorted((r["doc_id"], b) for r in got for b in range(r["low"], r["high"]))

    sizes = []
    whole = suffixes.suffix_array
    monkeypatch.setattr(suffixes, "suffix_array", lambda s: sizes.append(len(s)) or whole(s))
    text, part = noise(2000), noise(70)
    assert solved([text] * 3) == [(i, b) for i in (1, 2) for b in range(2000)]
    assert not sizes  # copies have nothing to be compared with
    assert solved([noise(300), noise(300)]) == [] and not sizes
    assert set(solved([noise(100) + part + noise(100), noise(30) + part])) == {(1, b) for b in range(30, 100)}
    assert 0 < max(sizes) < 470 * 2


def grouped(batches, name):
    table = pa.Table.from_batches(list(batches), recurring.MESSAGE)
    return {key: table.filter(pa.array(table.column(name).to_numpy() == key)) for key in set(table.column(name).to_pylist())}


@pytest.mark.parametrize("within", [True, False])
def test_anchors_are_counted_by_messages_of_blocks(within):
    """Against counting one by one; documents that share an id share their numbers."""
    rng = np.random.default_rng(5)
    known = rng.integers(-(1 << 63), (1 << 63) - 1, 400)
    own = [known[(400 * rng.random(rng.integers(1, 30)) ** 3).astype(int)] for _ in range(120)]
    own[40], ranges, often = own[0], 7, 15
    blocks = [range(start, start + 20) for start in range(0, 120, 20)]
    asked = []
    for n, block in enumerate(blocks):
        rows = np.array([(i % 40, 0 if i % 40 else 9, 0, len(own[i])) for i in block])
        asked += recurring.questions(n % 2, n, rows, np.concatenate([own[i] for i in block]), ranges, within)
    assert sum(len(batch) for batch in asked) <= len(blocks) * (ranges + 1)
    answered = [t if r < 0 else recurring.answers(t, often) for r, t in grouped(asked, "r").items()]
    by_block = grouped([b for t in answered for b in t.to_batches()], "block")
    got = {}
    for table in by_block.values():
        for row in recurring.answered_numbers(table).to_pylist():
            assert row["numbers"] == sorted(set(row["numbers"]))
            got.setdefault((row["id"], row["of_text"]), set()).update(row["numbers"])
    times = Counter(h for hashes in own for h in (hashes.tolist() if within else set(hashes.tolist())))
    expected = {}
    for i, hashes in enumerate(own):
        held = {-1 - a if times[h] > often else a for a, h in enumerate(hashes.tolist()) if times[h] > 1}
        expected.setdefault((i % 40, 0 if i % 40 else 9), set()).update(held)
    assert got == {k: v for k, v in expected.items() if v} and any(a < 0 for v in got.values() for a in v)
    # a block that is answered in part takes all its anchors in both ways; one without its record is that of a lost task
    table = next(iter(by_block.values()))
    part = table.filter(pa.array(table.column("r").to_numpy() != 0))
    rows = np.frombuffer(part.filter(pa.array(part.column("r").to_numpy() < 0)).column("more")[0].as_py(), "<i8").reshape(-1, 4)
    whole = {r["id"]: r["numbers"] for r in recurring.answered_numbers(part).to_pylist()}
    assert whole == {i: [*range(-n, 0), *range(n)] for i, _, _, n in rows.tolist()}
    assert not len(recurring.answered_numbers(table.filter(pa.array(table.column("r").to_numpy() >= 0))))


def test_recurring_numbers_against_counting(docs):
    rng = random.Random(4)
    part = "".join(rng.choices("abcdefgh", k=300))
    texts = [(i, "".join(rng.choices("abcdefgh", k=rng.randint(0, 900))) + part * (i % 2)) for i in range(30)]
    source = docs([(*r, "en", "a") for r in texts]).selectExpr("doc_id AS id", "0L AS of_text", "text")
    found = recurring.recurring_numbers(source, 16, 50, suffixes.byte_units, False, 10, suffixes.byte_hashes).collect()
    own = {
        i: [h for part, _, _ in recurring.anchors(suffixes.byte_units(t.encode()), 16, 50, suffixes.byte_hashes) for h in part.tolist()]
        for i, t in texts
    }
    times = Counter(h for hashes in own.values() for h in set(hashes))
    expected = {i: sorted(-1 - a if times[h] > 10 else a for a, h in enumerate(x) if times[h] > 1) for i, x in own.items()}
    assert {r["id"]: sorted(r["numbers"]) for r in found} == {i: x for i, x in expected.items() if x}
    assert any(a < 0 for x in expected.values() for a in x)


def test_pieces_that_differ_on_both_sides_of_their_anchor_are_not_sorted(monkeypatch):
    rng = random.Random(6)

    def noise(n, letters=26):
        return bytes(rng.choices(range(97, 97 + letters), k=n))

    def solved(texts):
        pieces = [
            (i, recurring.text_key(d), int(a), d[a : b + 50])
            for i, d in enumerate(texts)
            for _, first, last in recurring.anchors(suffixes.byte_units(d), 16, 50, suffixes.byte_hashes)
            for a, b in zip(first.tolist(), last.tolist())
        ]
        names = ["doc_id", "text_key", "start", "content"]
        got = suffixes.suffix_solver(50)(pa.table([pa.array(c) for c in zip(*pieces)], names=names)).to_pylist()
        return {(r["doc_id"], b) for r in got for b in range(r["low"], r["high"])}

    sizes = []
    whole = suffixes.suffix_array
    monkeypatch.setattr(suffixes, "suffix_array", lambda s: sizes.append(len(s)) or whole(s))
    part = noise(30)
    assert solved([noise(60) + part + noise(60) for _ in range(40)]) == set() and not sizes
    for size in (50, 51, 60, 66, 67, 90):
        part = noise(size)
        assert solved([noise(60) + part + noise(60), noise(20) + part + noise(9)]) == {(1, b) for b in range(20, 20 + size)}
    assert sizes
    for _ in range(60):
        texts = [noise(rng.randint(50, 130), rng.choice([1, 2])) + noise(rng.randint(0, 40), 1) for _ in range(6)]
        rows = list(enumerate(t.decode() for t in texts))
        got = Counter(i for i, _ in solved(texts))
        assert [got[int(r[0])] for r in brute_strings(rows, 50)] == [r[2] for r in brute_strings(rows, 50)]


def test_mask_of_packed_ranges():
    ranges = [(0, 2), (5, 9), (7, 8), (9, 10), (12, 13)]
    mask = recurring.removed_mask([a << 32 | b for a, b in ranges], 13)
    assert mask.tolist() == [any(a <= x < b for a, b in ranges) for x in range(13)]
    assert not recurring.removed_mask([], 3).any()
