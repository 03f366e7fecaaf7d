"""Secret scans: fixed patterns plus sliding-window entropy, in SQL functions only."""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, read, text_or_empty, worked_out

# Fixed values. The runs of `hex` and `access` are maximal, so asking for the length in
# the pattern gives the matches that pass it; `assign` is cut first and judged then.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
BASE = (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX))
VALUE_CHARS = 8

WINDOW = 24
# Windows are judged in stretches of so many, matches are placed in blocks of so many, and
# texts are masked in blocks of so many characters: what is rebuilt step by step stays small.
STRETCH, BLOCK, MASK_BLOCK = 256, 256, 1 << 16
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# Character class: candidate run, alphabet, what the run must hold, bits per character.
CLASSES = (
    ("hexadecimal", r"[0-9A-Fa-f]{24,}", "0123456789abcdef", ("[0-9]", "[A-Fa-f]"), 3.0),
    ("base64", r"[A-Za-z0-9+/_=-]{24,}", UPPER + LOWER + DIGITS + "+/_=-", ("[0-9]", "[A-Z]", "[a-z]"), 4.0),
    ("lower36", r"[a-z0-9]{24,}", LOWER + DIGITS, ("[0-9][a-z]+[0-9]", "[a-z][0-9]+[a-z]"), 4.0),
    ("upper36", r"[A-Z0-9]{24,}", UPPER + DIGITS, ("[0-9][A-Z]+[0-9]", "[A-Z][0-9]+[A-Z]"), 4.0),
)
# Known harmless shapes: ids with dashes, and words or short numbers between separators.
UUID = r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$"
SEPARATORS, PLAIN_PART = "[-_/=]+", "^([A-Za-z]{2,}|[0-9]{1,4})$"
# Placeholders and sequences: no window that touches one is judged. Length, pattern.
PLACEHOLDERS = (
    (7, "(?i)example"),
    (11, "(?i)placeholder"),
    (12, "(?i)abcdefghijkl"),
    (13, "(?i)0123456789abc"),
    (6, "(?i)xxxxxx"),
    (8, r"(.)\1{7}"),
)
NEITHER = "."  # in no alphabet
SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def _found(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as (gap, match): the text between two and the match."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
    pairs = F.zip_with(gaps, matches, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("hit")))
    return F.when(text.rlike(pattern), pairs).otherwise(
        F.lit(None).cast("array<struct<gap:int,hit:string>>")
    )


def _before(values: Column, zero: int, join) -> Column:
    """For every value what `join` makes of those before it (`zero` for the first). A step
    copies the list it adds to, so steps are taken in blocks, and the blocks are then joined
    with what comes before them."""

    def steps(part: Column) -> Column:
        seed = F.struct(F.lit(zero).alias("at"), F.array().cast("array<int>").alias("out"))

        def step(state: Column, v: Column) -> Column:
            return F.struct(join(state["at"], v).alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out"))

        return F.aggregate(part, seed, step)

    def blocks(all_values: Column) -> Column:
        n = F.size(all_values)
        starts = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1)), F.lit(BLOCK)), lambda i: i <= n)
        return F.transform(starts, lambda i: steps(F.slice(all_values, i, F.lit(BLOCK))))

    def joined_blocks(done: Column) -> Column:
        ahead = steps(F.transform(done, lambda b: b["at"]))["out"]
        return F.flatten(F.zip_with(done, ahead, lambda b, at: F.transform(b["out"], lambda v: join(at, v))))

    return worked_out(worked_out(values, blocks), joined_blocks)


def _spans(pairs: Column, kind: str, rank: int, keep, inside) -> Column:
    """Pairs -> spans in code points; `inside(hit)` gives the parts of a hit as (start, end)."""

    def parts(place: Column) -> Column:
        return F.transform(
            inside(place["hit"]),
            lambda p: F.struct(
                (place["at"] + p["start"]).alias("start"),
                F.lit(rank).alias("rank"),
                (place["at"] + p["end"]).alias("end"),
                F.lit(kind).alias("kind"),
            ),
        )

    def placed(found: Column) -> Column:
        before = _before(F.transform(found, lambda p: p["gap"] + F.length(p["hit"])), 0, lambda a, b: a + b)
        places = F.zip_with(found, before, lambda p, at: F.struct((at + p["gap"]).alias("at"), p["hit"].alias("hit")))
        return F.flatten(F.transform(F.filter(places, lambda p: keep(p["hit"])), parts))

    # No match is a null list, which goes through as null.
    return F.coalesce(worked_out(pairs, placed), F.array()).cast(SPAN)


def _whole(hit: Column) -> Column:
    return F.array(F.struct(F.lit(0).alias("start"), F.length(hit).alias("end")))


def _harmless(hit: Column) -> Column:
    """An id with dashes, or nothing but words and short numbers between separators."""
    parts = F.filter(F.split(hit, SEPARATORS), lambda p: p != "")
    return hit.rlike(UUID) | F.forall(parts, lambda p: p.rlike(PLAIN_PART))


def _codes(hit: Column, alphabet: str) -> Column:
    """Places in the alphabet, from 1; 0 within placeholders."""
    for length, pattern in PLACEHOLDERS:
        hit = F.regexp_replace(hit, pattern, NEITHER * length)
    text = F.lower(hit) if alphabet.lower() == alphabet else hit
    return F.transform(F.split(text, ""), lambda c: F.instr(F.lit(alphabet), c))


def _hot_ends(codes: Column, bits: float) -> Column:
    """Ends of the windows in these codes that have at least `bits` bits per character and
    touch no placeholder. The state holds the window's characters, the last placeholder, and
    the sum of c*log2(c) over the window's counts; a step moves the window by one character,
    which changes two counts and so two terms of that sum."""
    terms = F.array(*(F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)))
    ints = F.array().cast("array<int>")

    def step(state: Column, into: Column) -> Column:
        recent, i = state["recent"], state["i"] + 1
        full = F.size(recent) == WINDOW
        out = F.when(full, F.get(recent, F.lit(0))).otherwise(F.lit(-1))
        count = lambda c: F.size(F.filter(recent, lambda r: r == c))

        def moved(counts: Column) -> Column:
            more, less = counts["into"], counts["out"]
            added = F.get(terms, more + 1) - F.get(terms, more)
            taken = F.when(less > 0, F.get(terms, less) - F.get(terms, less - 1)).otherwise(0.0)
            return F.when(into == out, state["total"]).otherwise(state["total"] + added - taken)

        total = worked_out(F.struct(count(into).alias("into"), count(out).alias("out")), moved)
        blank = F.when(into == 0, i).otherwise(state["blank"])
        return F.struct(
            i.alias("i"),
            F.concat(F.when(full, F.slice(recent, F.lit(2), F.lit(WINDOW - 1))).otherwise(recent), F.array(into)).alias("recent"),
            total.alias("total"),
            blank.alias("blank"),
            F.when(
                (i >= WINDOW) & (i - blank >= WINDOW) & (math.log2(WINDOW) - total / WINDOW >= bits),
                F.concat(state["ends"], F.array(i)),
            )
            .otherwise(state["ends"])
            .alias("ends"),
        )

    seed = F.struct(
        F.lit(0).alias("i"),
        ints.alias("recent"),
        F.lit(0.0).alias("total"),
        F.lit(-WINDOW).alias("blank"),
        ints.alias("ends"),
    )
    return F.aggregate(codes, seed, step, lambda s: s["ends"])


def _hot_windows(hit: Column, alphabet: str, bits: float) -> Column:
    """Parts of `hit` covered by hot windows. Windows are judged in stretches that overlap by
    a window less one, so that time grows with the length of the hit."""

    def ends(codes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(codes) - WINDOW, F.lit(STRETCH))
        stretch = lambda s: _hot_ends(F.slice(codes, s + 1, F.lit(STRETCH + WINDOW - 1)), bits)
        return F.flatten(F.transform(starts, lambda s: F.transform(stretch(s), lambda e: s + e)))

    def parts(hot: Column) -> Column:
        apart = lambda k: F.coalesce(F.get(hot, k) - F.get(hot, k - 1) > WINDOW, F.lit(True))
        firsts = F.filter(hot, lambda _, k: (k == 0) | apart(k))
        lasts = F.filter(hot, lambda _, k: apart(k + 1))
        return F.zip_with(firsts, lasts, lambda f, t: F.struct((f - WINDOW).alias("start"), t.alias("end")))

    return worked_out(worked_out(_codes(hit, alphabet), ends), parts)


def _outermost(in_order: Column) -> Column:
    """The entropy spans that lie in no span before them in this order."""
    ends = _before(F.transform(in_order, lambda s: s["end"]), -1, F.greatest)
    pairs = F.zip_with(in_order, ends, lambda s, most: F.struct(s.alias("s"), (s["end"] > most).alias("outer")))
    outer = F.filter(pairs, lambda p: p["outer"] & (p["s"]["rank"] == len(BASE)))
    return F.transform(outer, lambda p: p["s"]).cast(SPAN)


def scan(docs: DataFrame, text: str = "text", base: str = "base", added: str = "added") -> DataFrame:
    """Adds the columns `base` and `added`, both arrays of (start, rank, end, kind) in code points.

    `base` holds the matches of the three fixed patterns. `added` (kind `entropy`) holds
    the parts of candidate strings whose windows carry many bits per character. Windows that
    touch a placeholder are not judged, strings of a harmless shape not at all, and parts
    that lie in a base span or in another part are left out. Null and empty texts have
    no spans; repeated rows are judged each on its own. One pass, no shuffle; all other
    columns are kept, columns of the caller with these two names are replaced.
    """
    body = fresh("text")
    df = docs.withColumn(body, text_or_empty(text))
    raw = {}
    for rank, (kind, pattern) in enumerate(BASE):
        raw[kind] = fresh(kind)
        value = lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 2)) >= VALUE_CHARS
        keep = value if kind == "assign" else (lambda hit: F.lit(True))
        df = df.withColumn(raw[kind], _spans(_found(F.col(body), pattern), kind, rank, keep, _whole))
    df = df.withColumn(base, F.array_sort(F.concat(*(F.col(c) for c in raw.values()))))
    extra = []
    for _, pattern, alphabet, holds, bits in CLASSES:
        name = fresh("entropy")
        extra.append(name)
        keep = lambda hit, holds=holds: reduce(and_, map(hit.rlike, holds)) & ~_harmless(hit)
        inside = lambda hit, a=alphabet, b=bits: _hot_windows(hit, a, b)
        df = df.withColumn(name, _spans(_found(F.col(body), pattern), "entropy", len(BASE), keep, inside))
    # Sorted by start, the longer first: a span lies in another if one before it ends no sooner.
    own = F.concat(*(F.col(c) for c in extra))
    in_order = F.array_sort(
        F.concat(base, own),
        lambda x, y: F.when(x["start"] != y["start"], x["start"] - y["start"])
        .when(x["end"] != y["end"], y["end"] - x["end"])
        .otherwise(x["rank"] - y["rank"]),
    )
    df = df.withColumn(added, F.when(F.size(own) > 0, worked_out(in_order, _outermost)).otherwise(F.array().cast(SPAN)))
    return df.drop(body, *raw.values(), *extra)


def joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The same rows with every span of `scan` replaced by `mark`; null texts stay null.
    Overlapping spans get one mark. Texts are masked block by block, so that time grows with
    their length."""
    at = fresh("spans")
    base, added = fresh("base"), fresh("added")
    scanned = scan(docs, text, base, added)
    spans = F.array_sort(F.concat(base, added))
    blocks = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{MASK_BLOCK}}}"), F.lit(0))

    def masked(block: Column, number: Column) -> Column:
        first = number * MASK_BLOCK
        inside = F.filter(F.col(at), lambda s: (s["start"] < first + MASK_BLOCK) & (s["end"] > first))

        def step(state: Column, s: Column) -> Column:
            gap = F.substring(block, state["at"] - first + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
            new = F.when((s["start"] >= state["at"]) & (s["start"] >= first), F.lit(mark)).otherwise(F.lit(""))
            return F.struct(
                F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["out"], gap, new).alias("out")
            )

        seed = F.struct(first.alias("at"), F.lit("").alias("out"))
        rest = lambda s: F.concat(s["out"], F.substring(block, s["at"] - first + 1, F.lit(MASK_BLOCK)))
        return F.when(F.size(inside) > 0, F.aggregate(inside, seed, step, rest)).otherwise(block)

    df = scanned.withColumn(at, spans)
    clean = F.when(F.size(at) > 0, F.array_join(F.transform(blocks, masked), "")).otherwise(F.col(text))
    return df.withColumn(text, clean).select(*docs.columns)


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every secret span of every document; see `scan`."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return scan(docs).select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind, _ in BASE),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )
