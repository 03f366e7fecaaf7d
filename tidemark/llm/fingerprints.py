"""Homomorphic multiset hashes of documents, in SQL functions only.

A fingerprint is a vector of lanes modulo 2^32: the sum over the text's paragraphs
(lines) of a vector hashed from each. Its parts:

* lane 0: number of items, an item being a word with its successor in the paragraph;
* 16 lanes from 8 hashes of the paragraph, for equality;
* 128 lanes that count, per bit of two hashes of each item, how often it is set. Twice
  the count less the number of items is a random projection of the item counts, so the
  angle between two such vectors estimates how alike two texts are.

Sums commute, so the order of paragraphs does not matter and a paragraph is inserted or
deleted by adding or subtracting its own fingerprint (`added`, `removed`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, read, text_or_empty

WHOLE_HASHES = 8
ITEM_HASHES = 2
HALF = 32
LOW = (1 << HALF) - 1
PAIR = (1 << HALF) | 1
ITEM_LANES = ITEM_HASHES * 64
FIRST_ID = -(1 << 63)
GROUP = 32


def lanes(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """`keys` and `lanes` (array<bigint>), one row per distinct `keys`.

    Rows that repeat a key must repeat its text: their sums are divided by their number.
    Null texts are empty texts, which have one empty paragraph. Where the input is
    partitioned by some of the keys already, no row moves.
    """
    paragraphs = texts.select(*keys, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("_at", "_line"))
    words = F.split("_line", " ")
    hashed = paragraphs.select(
        *keys,
        "_at",
        *(F.xxhash64(F.lit(i), "_line").alias(f"_w{i}") for i in range(WHOLE_HASHES)),
        F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.xxhash64(a, b)).alias("_items"),
    )
    items = hashed.select(
        *keys, "_at", *(f"_w{i}" for i in range(WHOLE_HASHES)), F.posexplode("_items").alias("_nr", "_h0")
    ).select("*", *(F.xxhash64("_h0", F.lit(i)).alias(f"_h{i}") for i in range(1, ITEM_HASHES)))
    first = F.col("_nr") == 0
    sums = [F.count("*").alias("_n"), F.count_if(first & (F.col("_at") == 0)).alias("_rows")]
    for i in range(WHOLE_HASHES):
        word = F.col(f"_w{i}")
        sums.append(F.sum(F.when(first, word.bitwiseAND(LOW)).otherwise(0)).alias(f"_a{i}"))
        sums.append(F.sum(F.when(first, F.shiftrightunsigned(word, HALF)).otherwise(0)).alias(f"_b{i}"))
    # Two lanes share a sum: the bits at g and g + 32 of the hash are 32 apart in it.
    packed = [(i, g) for i in range(ITEM_HASHES) for g in range(HALF)]
    for i, g in packed:
        bits = F.shiftrightunsigned(f"_h{i}", g).bitwiseAND(F.lit(PAIR))
        sums.append(F.sum(bits).alias(f"_s{i}_{g}"))
    out = items.groupBy(*keys).agg(*sums)
    each = lambda c: F.expr(f"{c} div _rows")
    whole = [each(f"_{x}{i}") for i in range(WHOLE_HASHES) for x in "ab"]
    low = [each(f"_s{i}_{g}").bitwiseAND(LOW) for i, g in packed]
    high = [F.shiftrightunsigned(each(f"_s{i}_{g}"), HALF) for i, g in packed]
    all_lanes = F.array(each("_n"), *whole, *low, *high)
    return out.select(*keys, F.transform(all_lanes, lambda x: x.bitwiseAND(LOW)).alias("lanes"))


def added(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(LOW))


def removed(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(LOW))


def as_text(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def sketch(fingerprint: Column) -> Column:
    """The lanes that likeness needs, centred: twice the count of a bit less the items."""
    counts = F.slice(fingerprint, 2 + 2 * WHOLE_HASHES, ITEM_LANES)
    return F.transform(counts, lambda c: 2 * c - F.get(fingerprint, F.lit(0))).cast("array<int>")


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 from two sketches: the cosine, negative ones as 0; equal ones give 1."""
    dot = lambda x, y: F.aggregate(
        F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, v: s + v
    )
    size = F.sqrt(dot(a, a) * dot(b, b))
    cosine = F.when(size > 0, dot(a, b) / size).otherwise((dot(a, a) == dot(b, b)).cast("double"))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine))


def successors(ids: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows with distinct k -> the same with next_k; the last k is followed by the first.

    Range partitions keep the order, so only the first id of each partition has to be
    known elsewhere: one row per partition meets in one task.
    """
    placed = scratch.stage(ids.repartitionByRange("k").withColumn("part", F.spark_partition_id()), "ids")
    heads = placed.groupBy("part").agg(F.min("k").alias("head"))
    order = Window.partitionBy(F.lit(1)).orderBy("head")
    after = heads.select(
        "part", F.coalesce(F.lead("head").over(order), F.first("head").over(order)).alias("next_head")
    )
    inside = Window.partitionBy("part").orderBy("k")
    return (
        placed.withColumn("inside", F.lead("k").over(inside))
        .join(after, "part")
        .select(*ids.columns, F.coalesce("inside", "next_head").alias("next_k"))
    )


def edited_fingerprints(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and two likenesses.

    The edited text replaces the last half of the code points by the first as many of the
    next document by doc_id (the last is followed by the first; a single one by itself).
    Null texts are empty texts. A null doc_id sorts before all ids. Rows that repeat an id
    have the same next document; of several rows with the next id the one with the smallest
    text hash counts. Texts are moved once by id and only the needed prefixes once more.
    An id of many rows is dealt to groups of about GROUP rows by text hash (`salt`), which
    rows meet in; only rows of equal id and text share a group whatever their number.
    """
    k = F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST_ID))
    rows = docs.select(k.alias("k"), text_or_empty().alias("text")).select("k", "text", F.xxhash64("text").alias("th"))
    ids = rows.groupBy("k").agg(F.min("th").alias("first"), F.ceil(F.count("*") / GROUP).alias("groups"))
    ids = scratch.stage(ids, "groups")
    many = scratch.stage(ids.filter("groups > 1").select("k", "groups"), "many")
    salted = rows.join(many, "k", "left").withColumn("salt", F.coalesce(F.pmod("th", "groups"), F.lit(0).cast("long")))
    hashed = salted.select("k", "salt", "text", "th").repartition("k", "salt")
    # What each group asks for: so many characters of the next id's first text.
    needs = salted.groupBy("k", "salt").agg(F.max(F.expr("length(text) div 2")).alias("need"))
    firsts = ids.select(
        F.col("k").alias("next_k"), F.col("first").alias("next_th"), F.pmod("first", "groups").alias("next_salt")
    )
    after = successors(ids.select("k"), scratch).join(firsts, "next_k")
    asked = scratch.stage(
        needs.join(after, "k").select(
            F.col("k").alias("asks"), F.col("salt").alias("asks_salt"), "need", "next_k", "next_salt", "next_th"
        ),
        "successors",
    )
    at_next = lambda df: (df["k"] == F.col("next_k")) & (df["salt"] == F.col("next_salt"))

    # One row per first text, before several groups ask for it.
    heads = asked.groupBy("next_k", "next_salt").agg(F.first("next_th").alias("next_th"), F.max("need").alias("most"))
    one = F.row_number().over(Window.partitionBy("k", "salt").orderBy("th"))
    heads = (
        hashed.join(heads, at_next(hashed))
        .filter(F.col("th").bitwiseXOR(F.col("next_th")) == 0)
        .select("k", "salt", "th", F.expr("left(text, most)").alias("head"))
        .withColumn("place", one)
        .filter("place = 1")
        .select("k", "salt", "head")
    )
    prefixes = heads.join(asked, at_next(heads)).select(
        F.col("asks").alias("k"), F.col("asks_salt").alias("salt"), F.expr("left(head, need)").alias("prefix")
    )
    half = F.expr("length(text) div 2")
    pairs = hashed.join(prefixes, ["k", "salt"]).select(
        "k",
        "salt",
        "th",
        F.length("text").cast("long").alias("n_chars"),
        F.concat(F.expr("left(text, length(text) - length(text) div 2)"), F.left("prefix", half)).alias("edited"),
    )
    own = lanes(hashed, ["k", "salt", "th"], "text")
    following = (
        own.join(asked, at_next(own))
        .filter(F.col("th").bitwiseXOR(F.col("next_th")) == 0)
        .select(F.col("asks").alias("k"), F.col("asks_salt").alias("salt"), sketch(F.col("lanes")).alias("next_sketch"))
    )
    changed = lanes(pairs, ["k", "salt", "th"], "edited").select(
        "k", "salt", F.col("th").alias("th2"), F.col("lanes").alias("edited_lanes")
    )
    rows = pairs.select("k", "salt", F.col("th").alias("th3"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
    # Equal on k and text hash; the hash is compared after the join on the group, so that all
    # stay partitioned by it. A group has few different texts.
    both = own.join(changed, ["k", "salt"]).filter(F.col("th").bitwiseXOR(F.col("th2")) == 0)
    found = rows.join(both, ["k", "salt"]).filter(F.col("th3").bitwiseXOR(F.col("th")) == 0)
    mine = sketch(F.col("lanes"))
    return found.join(following, ["k", "salt"]).select(
        F.when(F.col("k") != FIRST_ID, F.col("k")).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        as_text(F.col("lanes")).alias("fingerprint"),
        as_text(F.col("edited_lanes")).alias("edited_fingerprint"),
        likeness(mine, sketch(F.col("edited_lanes"))).alias("near_edited"),
        likeness(mine, F.col("next_sketch")).alias("near_next"),
    )


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return edited_fingerprints(read(spark, sf_dir, "documents"), Scratch(spark))
