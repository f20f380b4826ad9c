"""Personal data: base patterns, and identifiers found by bootstrapped contexts.

Seeds are the base entities and strings that look like keys (long, letters and digits in turn). One and two words on
either side of a seed form lexical patterns. A pattern counts if identifiers stand at most of the places its words have in
all documents, so common words never do. Spark scores patterns by how many of the instances they stand beside are known,
takes the instances of good patterns in, and repeats until none is added. Instances of patterns that end up with high
confidence become spans of kind ``id``; a seed that no pattern confirms becomes none.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import map_rows, stored, unused_name
from tidemark.llm.passages import word_units
from tidemark.llm.recurring import _mixed

KINDS = ("email", "ip", "card", "phone")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9][0-9.]*")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
# what an identifier looks like: no white space, at least six characters of which one is a digit
CANDIDATE = re.compile(r"(?<![^\s\"'(\[<=])[^\s\"'<>()\[\],;=]{6,}")
DIGIT = re.compile(r"[0-9]")
# what a key looks like: 20 or more characters, letters and digits taking turns six times or more
KEY = re.compile(r"[A-Za-z0-9+/_-]{20,}")
TURN = re.compile(r"[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])")
# words of contexts: what stands between white space, quotes, brackets and signs
SIGNS = "\"'=:()[]{}<>,;|"
WORD = re.compile(r"[^\s\"'=:()\[\]{}<>,;|]+")
DIGITS = re.compile(r"[0-9]+")
# ends and beginnings of lines among the words of a text
LINE_END, LINE_START = "\ue000", "\ue001"
SEPARATORS = str.maketrans({c: " " for c in SIGNS + "\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))})
PLACE_BITS = 26
REACH = 80


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of local part, @ and domain, looked for around each @."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and LOCAL.match(text, start - 1):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        else:
            free = at + 1
        at = text.find("@", free)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Runs of digits with single dots, taken by fours from the left; those with a part above 255 are dropped."""
    for m in DOTTED.finditer(text):
        at, four = m.start(), []
        for part in m[0].split("."):
            four = [*four, (at, part)] if part else []
            at += len(part) + 1
            if len(four) == 4:
                numbers = [p.lstrip("0") for _, p in four]
                if all(len(p) <= 3 and int(p or "0") <= 255 for p in numbers):
                    yield four[0][0], at - 1
                four = []


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind and start; matches that fail their check are dropped without a retry."""
    found = [(0, s, e) for s, e in _emails(text)]
    found += [(1, s, e) for s, e in _addresses(text)]
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
            found.append((3, m.start(), m.end()))
    return found


def _is_key(instance: str) -> bool:
    """Whether a string looks drawn at random, as keys and tokens do."""
    return KEY.fullmatch(instance) is not None and len(TURN.findall(instance)) >= 6


def _words_before(text: str, start: int) -> tuple[str, list[str]]:
    """``""`` and the words before ``start`` on its line, or ``"/"`` and those of the line above if there are none.

    Up to ``REACH`` characters are read; ``^`` stands for the beginning of the line.
    """
    for above in ("", "/"):
        low = max(0, start - REACH)
        line = text.rfind("\n", low, start) + 1
        words = WORD.findall(text[line or low : start])
        if line or not low:
            words = ["^", *words]
        elif words and WORD.match(text[low - 1]) and WORD.match(text[low]):
            words = words[1:]  # cut in the middle
        if len(words) > 1 or words != ["^"] or not line:
            return above, words
        # the label may stand on the line above, behind empty lines
        start = len(text[max(0, line - 1 - REACH) : line - 1].rstrip()) + max(0, line - 1 - REACH)
    return "/", words


def _words_after(text: str, end: int) -> list[str]:
    """The words behind ``end`` on its line, up to ``REACH`` characters on; ``$`` stands for the end of the line."""
    high = min(len(text), end + REACH)
    line = text.find("\n", end, high)
    words = WORD.findall(text[end : line if line >= 0 else high])
    if line >= 0 or high == len(text):
        return [*words, "$"]
    return words[:-1] if words and WORD.match(text[high - 1]) and WORD.match(text[high]) else words


def _plain(text: str) -> str:
    """Lower case, numbers alike."""
    return DIGITS.sub("0", text.lower().replace("\u03c2", "\u03c3"))


def _patterns(text: str, start: int, end: int) -> list[tuple[str, int]]:
    """Patterns of one and two words on either side with the keys of their words; at least one is a word of the text."""
    above, before = _words_before(text, start)
    after = _words_after(text, end)
    sides = [(above + "<", before[-n:], n) for n in (1, 2)] + [(">", after[:n], n) for n in (1, 2)]
    out = []
    for side, words, n in sides:
        if len(words) == n and any(word not in ("^", "$") for word in words):
            shown = _plain(" ".join(words))
            out.append((f"{side} {shown}", sequence_key(shown + " $" if above and side != ">" else shown)))
    return out


@lru_cache(maxsize=100_000)
def sequence_key(words: str) -> int:
    """What ``place_keys`` has for these words where they follow each other."""
    marks = {"^": LINE_START, "$": LINE_END}
    units = word_units(" ".join(marks.get(w, w) for w in words.split(" ")).encode(errors="replace"))
    return int(_sequences(units, len(units)).view(np.int64)[0])


def _sequences(units: np.ndarray, size: int) -> np.ndarray:
    run = units
    for i in range(1, size):
        run = _mixed(run[:-1] + np.uint64(i), units[i:])
    return run


def place_keys(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Keys of the runs of one, two and three words of the texts, ends and beginnings of lines among them."""
    line = f" {LINE_END} {LINE_START} "
    for text in texts:
        shown = f"{LINE_START} {_plain((text or '').translate(SEPARATORS)).replace(chr(10), line)} {LINE_END}"
        units = word_units(shown.encode(errors="replace"))
        for size in (1, 2, 3):
            yield _sequences(units, size).view(np.int64)


def occurrences(text: str | None) -> tuple[list[dict], list[dict]]:
    """Base spans, and every instance with each of its patterns; ``known`` marks the seeds, ``base`` those with a span."""
    text = text or ""
    base = base_spans(text)
    spans = [{"kind": k, "start": s, "end": e} for k, s, e in base]
    context = []

    def add(s: int, e: int, known: bool, is_base: bool) -> None:
        for pattern, key in _patterns(text, s, e):
            context.append(
                {"pattern": pattern, "key": key, "instance": text[s:e], "start": s, "end": e, "known": known, "base": is_base}
            )

    for _, s, e in base:
        add(s, e, True, True)
    # longest end so far of the spans that begin at or before a place
    taken = sorted((s, e) for _, s, e in base)
    starts, ends = [s for s, _ in taken], []
    for _, e in taken:
        ends.append(max(e, ends[-1]) if ends else e)
    for m in CANDIDATE.finditer(text):
        instance = m[0].rstrip(".,;:!?")
        end = m.start() + len(instance)
        if len(instance) < 6 or not DIGIT.search(instance):
            continue
        i = bisect_right(starts, end - 1)
        if i and ends[i - 1] > m.start():
            continue
        add(m.start(), end, _is_key(instance), False)
    return spans, context


def count_places(docs: DataFrame, text: str, keys: DataFrame) -> DataFrame:
    """``key, places``: how often the words of each key in ``keys`` follow each other in all documents.

    Tasks ask a table of 2**26 bits, 8 MB whatever the number of keys, which words can matter; the rest meets ``keys`` in
    a join, so a bit that several keys share changes nothing.
    """
    spark = docs.sparkSession
    place = F.col("key").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    rows = (
        keys.groupBy(F.shiftright(place, 15).alias("part"))
        .agg(F.bitmap_construct_agg(place.bitwiseAND(F.lit((1 << 15) - 1))).alias("bits")).collect()
    )
    table = np.zeros((1 << PLACE_BITS - 15, 1 << 12), np.uint8)
    for r in rows:
        table[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    shared = spark.sparkContext.broadcast(table.reshape(-1))

    def run(texts: list) -> Iterator[tuple]:
        table, hits, size = shared.value, [], 0

        def counted() -> Iterator[tuple]:
            found, n = np.unique(np.concatenate(hits), return_counts=True)
            yield from zip(found.tolist(), n.tolist())

        for keys in place_keys(texts):
            at = keys & ((1 << PLACE_BITS) - 1)
            hits.append(keys[(table[at >> 3] >> (at & 7).astype(np.uint8) & 1) > 0])
            size += len(hits[-1])
            if size > 1 << 20:
                yield from counted()
                hits, size = [], 0
        if size:
            yield from counted()

    found = map_rows(docs, [text], run, "key long, n long").groupBy("key").agg(F.sum("n").alias("places"))
    return found.join(keys, "key", "left_semi")


def telling_uses(docs: DataFrame, text: str, uses: DataFrame, min_known: int, fill: float) -> DataFrame:
    """``pattern, instance, known`` of the patterns with an identifier at ``fill`` or more of all places of their words.

    Patterns with fewer than ``min_known`` different instances can never be good and are left out.
    """
    graph = stored(
        uses.groupBy("pattern", "key", "instance").agg(F.max("known").alias("known"), F.count("*").alias("n")), "pii-uses"
    )
    patterns = graph.groupBy("pattern", "key").agg(F.count("*").alias("instances"), F.sum("n").alias("n"))
    patterns = stored(patterns.where(F.col("instances") >= min_known), "pii-candidates")
    places = count_places(docs, text, patterns.select("key").distinct())
    telling = patterns.join(places, "key").where(F.col("n") >= F.col("places") * fill).select("pattern")
    return graph.join(telling, "pattern", "left_semi").select("pattern", "instance", "known")


def score_patterns(
    uses: DataFrame, rounds: int | None = None, min_known: int = 3, confidence: float = 0.6
) -> DataFrame:
    """``pattern`` of high confidence, from the graph ``pattern, instance, known``.

    A round counts for each pattern the different instances and how many are known; a pattern is good if at least
    ``min_known`` are known and they make up ``confidence`` of all, and its instances are known in the next round. It ends
    when a round adds no instance (or after ``rounds``); what is known only grows, so that comes. Counts are aggregated in every task before they meet, so a pattern or instance may stand in any share of the documents.
    """
    graph = stored(uses.groupBy("pattern", "instance").agg(F.max("known").alias("known")), "pii-graph")
    n_known, done = graph.where("known").count(), 0
    while rounds is None or done < rounds:
        good = (
            graph.groupBy("pattern")
            .agg(F.count("*").alias("n"), F.sum(F.col("known").cast("long")).alias("n_known"))
            .where((F.col("n_known") >= min_known) & (F.col("n_known") >= confidence * F.col("n")))
            .select("pattern")
        )
        # what is known stays as it is, so frequent seeds are not shuffled
        unknown = graph.where(~F.col("known"))
        reached = unknown.join(good, "pattern", "left_semi").select("instance").distinct().withColumn("reached", F.lit(True))
        now = unknown.join(reached, "instance", "left").select(
            "pattern", "instance", F.coalesce("reached", F.lit(False)).alias("known")
        )
        graph = stored(graph.where("known").unionByName(now), "pii-graph")
        before, n_known, done = n_known, graph.where("known").count(), done + 1
        if n_known == before:
            break
    return (
        graph.groupBy("pattern")
        .agg(F.count("*").alias("n"), F.sum(F.col("known").cast("long")).alias("n_known"))
        .where((F.col("n_known") >= min_known) & (F.col("n_known") >= confidence * F.col("n")))
        .select("pattern")
    )


SPANS = "array<struct<kind:string,start:int,end:int>>"


def find(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, min_known: int = 3, fill: float = 0.5, **options
) -> DataFrame:
    """The columns of ``keep`` (all by default) and ``spans``: kind, start and end (exclusive) in code points.

    Spans stand by kind as in ``KINDS``, then ``id``, then start. A pattern needs ``min_known`` different known instances,
    and identifiers at a share of ``fill`` of all places of its words. Null and empty texts have no spans, very long ones
    are read whole in linear time, an empty table gives no rows. Repeated rows get equal spans, and each counts as a
    place; other columns, null ids included, pass through unread. If ``spans`` is taken the new column gets underscores
    in front.
    """
    kept = docs.columns if keep is None else keep
    parts = "struct<kind:int,start:int,end:int>"
    use = "struct<pattern:string,key:long,instance:string,start:int,end:int,known:boolean,base:boolean>"
    name = unused_name(docs.select(*[f"`{c}`" for c in kept]), "spans")
    held = unused_name(docs, "held")

    def run(texts: list) -> Iterator[tuple]:
        return (occurrences(t) for t in texts)

    # texts are read again only where they are kept; everything found is small beside them
    found = stored(
        map_rows(docs, [text], run, f"{name} array<{parts}>, {held} array<{use}>", keep=kept), "pii-found"
    )
    uses = found.select(F.explode(F.col(held)).alias("u")).select("u.pattern", "u.key", "u.instance", "u.known")
    telling = telling_uses(docs, text, uses, min_known, fill)
    good = stored(score_patterns(telling, min_known=min_known, **options), "pii-patterns")
    # the rows that have candidates of good patterns, by the candidates themselves: equal lists get equal answers
    new = found.where(F.exists(held, lambda u: ~u["base"])).select(F.col(held).alias("of")).distinct()
    accepted = (
        new.select("of", F.explode(F.filter("of", lambda u: ~u["base"])).alias("u"))
        .join(good, F.col("u.pattern") == F.col("pattern"), "left_semi")
        .select("of", F.struct(F.lit("id").alias("kind"), F.col("u.start").alias("start"), F.col("u.end").alias("end")).alias("s"))
        .groupBy(F.xxhash64("of").alias("of_key"), F.sha2(F.to_json("of"), 256).alias("of_sha"))
        .agg(F.array_sort(F.collect_set("s")).alias("added"))
    )
    kinds = F.array(*[F.lit(k) for k in KINDS])
    base = F.transform(
        F.col(name),
        lambda s: F.struct(F.element_at(kinds, s["kind"] + 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    has_new = F.exists(held, lambda u: ~u["base"])
    key, sha = unused_name(found, "of_key"), unused_name(found, "of_sha")
    accepted = accepted.toDF(f"{key}_", f"{sha}_", f"{key}_added")
    keyed = found.withColumn(key, F.when(has_new, F.xxhash64(held))).withColumn(
        sha, F.when(has_new, F.sha2(F.to_json(held), 256))
    )
    columns = [f"`{c}`" for c in kept]
    plain = keyed.where(F.col(key).isNull()).select(*columns, base.cast(SPANS).alias(name))
    joined = keyed.where(F.col(key).isNotNull()).join(
        accepted, (F.col(key) == F.col(f"{key}_")) & (F.col(sha) == F.col(f"{sha}_")), "left"
    )
    added = F.coalesce(F.col(f"{key}_added").cast(SPANS), F.array().cast(SPANS))
    return plain.unionByName(joined.select(*columns, F.concat(base.cast(SPANS), added).alias(name)))


def redact(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets; overlapping spans by one."""
    found = find(docs, text, **options)
    spans = found.columns[-1]

    def run(texts: list, all_spans: list) -> Iterator[tuple]:
        for t, own in zip(texts, all_spans):
            if not own:
                yield (t,)
                continue
            out, done = [], 0
            for s in sorted(own, key=lambda s: (s["start"], -s["end"])):
                if s["start"] >= done:
                    out += [t[done : s["start"]], f"<{s['kind']}>"]
                done = max(done, s["end"])
            yield ("".join([*out, t[done:]]),)

    new = unused_name(found, "redacted")
    return map_rows(found, [text, spans], run, f"{new} string", keep=docs.columns).select(
        *[(F.col(new).alias(c) if c == text else F.col(f"`{c}`")) for c in docs.columns]
    )
