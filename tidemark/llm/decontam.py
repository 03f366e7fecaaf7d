"""Benchmark decontamination with SimHash windows, in SQL functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, fresh, read, text_or_empty, worked_out
from tidemark.llm.simhash import row_key

SHINGLE = 5
BITS = 64
BROADCAST_ROWS = 1_000_000
CHUNK = 64
NEVER = 2**31 - 1


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def runs(hashed: Column, size: Column) -> Column:
    """Hash of every run of `size` words, at most SHINGLE, from the words' hashes; of all
    words where there are fewer, none where there are none."""
    return F.when(
        F.size(hashed) > 0,
        F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(hashed) - size, F.lit(0))),
            lambda i: F.xxhash64(*(F.when(size > k, F.get(hashed, i + k)) for k in range(SHINGLE))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def weighted(words: Column, hashes: Column, size: Column) -> Column:
    """The shingles with their weights. The weight is the letters in it: long words say more
    than short ones."""
    letters = lambda i: F.length(F.concat_ws("", *(F.when(size > k, F.get(words, i + k)) for k in range(SHINGLE))))
    return F.transform(hashes, lambda h, i: F.struct(h.alias("h"), letters(i).alias("w")))


def once(shingle_list: Column) -> Column:
    """The different shingles, by sorting: a set of structs would be compared pair by pair."""
    differs = lambda o, k: (k == 0) | (F.get(o, k)["h"] != F.get(o, k - 1)["h"])
    return worked_out(F.array_sort(shingle_list), lambda o: F.filter(o, lambda _, k: differs(o, k)))


def shingle_size() -> Column:
    """Items of fewer than five words are one shingle of that many words."""
    return F.least(F.lit(SHINGLE), F.col("size"))


def weight_of(shingle_list: Column) -> Column:
    return F.aggregate(shingle_list, F.lit(0).cast("long"), lambda s, e: s + e["w"])


def margin(shingle_list: Column, bit: Column) -> Column:
    """Weight of the shingles whose hash has the bit less that of the others. Its sign is the
    bit of the SimHash."""
    signed = lambda e: F.when(F.getbit(e["h"], bit) == 1, e["w"]).otherwise(-e["w"])
    return F.aggregate(shingle_list, F.lit(0).cast("long"), lambda s, e: s + signed(e))


def firm_bits(shingle_list: Column, weight: Column, threshold: float) -> Column:
    """(bit, margin) of the SimHash bits that every set as similar as the threshold shares.

    Of such a set and this one, the shingles that only one of them has weigh at most
    (1 - threshold) / threshold of this one's weight, and no margin differs by more. Half a
    letter is added against rounding.
    """
    margins = F.transform(
        F.sequence(F.lit(0), F.lit(BITS - 1)),
        lambda b: F.struct(b.alias("bit"), margin(shingle_list, b).alias("margin")),
    )
    return F.filter(margins, lambda m: F.abs(m["margin"]) > weight * ((1 - threshold) / threshold) + 0.5)


def marked(shingles: Column, item_shingles: Column) -> Column:
    """The shingles in their order with weight, whether the item has the same one, and the
    places of the same one before and after it. Equal shingles are found by sorting, so the
    time is that of a sort."""
    plain = "array<struct<h:bigint,i:int,w:int>>"
    own = F.transform(shingles, lambda e, i: F.struct(e["h"].alias("h"), i.alias("i"), e["w"].alias("w")))
    item = F.transform(item_shingles, lambda e: F.struct(e["h"].alias("h"), F.lit(-1).alias("i"), e["w"].alias("w")))
    both = F.array_sort(F.concat(item.cast(plain), own.cast(plain)))

    def groups(ordered: Column) -> Column:
        begins = lambda i: (i == 0) | (F.get(ordered, i)["h"] != F.get(ordered, i - 1)["h"])
        starts = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), begins)

        def members(found: Column) -> Column:
            def linked(start: Column, number: Column) -> Column:
                end = F.coalesce(F.get(found, number + 1), F.size(ordered))
                common = F.get(ordered, start)["i"] == -1
                place = lambda k, inside: F.when(inside, F.get(ordered, k)["i"])
                return F.transform(
                    F.sequence(start, end - 1),
                    lambda k: F.struct(
                        F.get(ordered, k)["i"].alias("i"),
                        F.get(ordered, k)["h"].alias("h"),
                        F.get(ordered, k)["w"].alias("w"),
                        common.alias("common"),
                        F.coalesce(place(k - 1, k > start), F.lit(-1)).alias("before"),
                        F.coalesce(place(k + 1, k + 1 < end), F.lit(NEVER)).alias("after"),
                    ),
                )

            return F.filter(F.flatten(F.transform(found, linked)), lambda e: e["i"] >= 0)

        return worked_out(starts, members)

    return F.array_sort(worked_out(both, groups))


def best_window() -> Column:
    """(similarity, back) of the best window of a stretch whose SimHash agrees with the item's
    firm bits; back is its start times -1, so that of equals the first is the greatest.

    The window moves by one shingle at a time: the one that leaves takes its weight along
    unless the window holds the same one again, the one that comes brings its own unless the
    window has it. The margins of the firm bits move with them. So a step costs the same for
    an item of any length.
    """
    marks, firm = F.col("marked"), F.col("firm")
    length = (F.col("size") - shingle_size() + 1).cast("int")
    long = lambda c: c.cast("long")
    sign = lambda e, f: F.when(F.getbit(e["h"], f["bit"]) == 1, long(e["w"])).otherwise(-long(e["w"]))
    first = F.filter(F.slice(marks, F.lit(1), length), lambda e: e["before"] < 0)

    def starting(held: Column) -> Column:
        total = lambda of: F.aggregate(held, F.lit(0).cast("long"), lambda s, e: s + of(e))
        return F.struct(
            total(lambda e: long(e["w"])).alias("weight"),
            total(lambda e: F.when(e["common"], long(e["w"])).otherwise(F.lit(0).cast("long"))).alias("common"),
            F.transform(firm, lambda f: total(lambda e: sign(e, f))).alias("margins"),
            F.lit(None).cast("struct<similarity:double,back:int>").alias("best"),
        )

    def judged(weight: Column, common: Column, margins: Column, best: Column, d: Column) -> Column:
        agrees = F.forall(F.zip_with(margins, firm, lambda m, f: m * f["margin"] > 0), lambda b: b)
        similarity = F.try_divide(common, weight + F.col("item_weight") - common)
        here = F.struct(similarity.alias("similarity"), (-(F.col("from").cast("int") + d)).alias("back"))
        better = best.isNull() | (similarity > best["similarity"])
        return F.struct(
            weight.alias("weight"),
            common.alias("common"),
            margins.alias("margins"),
            F.when(agrees & better, here).otherwise(best).alias("best"),
        )

    def step(state: Column, d: Column) -> Column:
        out, into = F.get(marks, d - 1), F.get(marks, d + length - 1)
        leaves = F.when(out["after"] >= d + length - 1, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
        comes = F.when(into["before"] < d, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))

        def moved(change: Column) -> Column:
            less, more = change["leaves"], change["comes"]
            shared = lambda e: F.when(e["common"], long(e["w"])).otherwise(F.lit(0).cast("long"))
            margins = F.zip_with(state["margins"], firm, lambda m, f: m - less * sign(out, f) + more * sign(into, f))
            return worked_out(
                F.struct(
                    (state["weight"] - less * long(out["w"]) + more * long(into["w"])).alias("weight"),
                    (state["common"] - less * shared(out) + more * shared(into)).alias("common"),
                    margins.alias("margins"),
                ),
                lambda now: judged(now["weight"], now["common"], now["margins"], state["best"], d),
            )

        return worked_out(F.struct(leaves.alias("leaves"), comes.alias("comes")), moved)

    steps = F.filter(F.sequence(F.lit(0), (F.col("to") - F.col("from")).cast("int")), lambda d: d > 0)
    seed = worked_out(worked_out(first, starting), lambda s: judged(s["weight"], s["common"], s["margins"], s["best"], F.lit(0)))
    return F.aggregate(steps, seed, step, lambda s: s["best"])


def _items(benchmark: DataFrame, threshold: float) -> DataFrame:
    """Items with their size, shingles and firm bits. `item` names an item by item_id and
    text, of which several rows are one item."""
    benchmark = benchmark.select("item_id", F.struct(*row_key("item_id", "text")).alias("item"), text_or_empty().alias("text"))
    benchmark = benchmark.dropDuplicates(["item"])
    items = benchmark.select("item_id", "item", words_of(F.col("text")).alias("words")).filter(F.size("words") > 0)
    items = items.select("item_id", "item", "words", F.size("words").alias("size"), word_hashes(F.col("words")).alias("hashed"))
    items = items.select("item_id", "item", "words", "size", runs(F.col("hashed"), shingle_size()).alias("hashes"))
    items = items.select(
        "item_id", "item", "size", once(weighted(F.col("words"), F.col("hashes"), shingle_size())).alias("item_shingles")
    )
    items = items.select("*", weight_of(F.col("item_shingles")).alias("item_weight"))
    return items.select("*", firm_bits(F.col("item_shingles"), F.col("item_weight"), threshold).alias("firm"))


def _probes(items: DataFrame, threshold: float) -> DataFrame:
    """The shingles that windows start from, out of stored items.

    A window as similar as the threshold shares at least that part of the item's weight.
    So of any shingles that weigh more than the rest of it, it has one: the item's rarest
    are taken until what is left weighs less than the threshold. Half a letter is added
    against rounding: a shingle too many is no loss.
    """
    parts = items.select("item", "size", F.explode("item_shingles").alias("s")).select("item", "size", "s.h", "s.w")
    rarity = parts.groupBy("h").agg(F.countDistinct("item").alias("items"))
    rarest = Window.partitionBy("item").orderBy("items", F.desc("w"), "h")
    before = rarest.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("item")
    return (
        parts.join(rarity, "h")
        .withColumn("taken", F.coalesce(F.sum("w").over(before), F.lit(0)))
        .withColumn("total", F.sum("w").over(whole))
        .filter(F.col("taken") <= F.col("total") * (1 - threshold) + 0.5)
        .select("h", "item", "size")
        .distinct()
    )


def leaks(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, threshold: float = 0.8) -> DataFrame:
    """(doc_id, k1, k2, item_id, similarity, start, size): the best window per document row
    and item, where it is as similar as `threshold` on weighted five-word shingles.

    Windows have the item's number of words, or all words of a shorter document. They are
    taken at every start from which they hold one of the item's probe shingles: one without
    any is below the threshold. Window and item meet by that shingle. They are compared
    exactly where their SimHashes agree on the item's firm bits, which all pairs of the
    threshold do: no pair is lost.
    Null and empty texts, and items without words, match nothing. Different texts under one
    item_id, also a null one, are items of their own and give a row each. Repeated rows share
    one (k1, k2). Extra columns are not read.
    """
    items = scratch.stage(_items(benchmark, threshold), "items")
    probes = scratch.stage(_probes(items, threshold), "probes")
    if probes.count() <= BROADCAST_ROWS:
        probes = F.broadcast(probes)
    texts = docs.select("doc_id", *row_key(), words_of(text_or_empty()).alias("words"))
    short = [r[0] for r in items.filter(F.col("size") < SHINGLE).select("size").distinct().collect()]
    hashed = texts.select("k1", "k2", word_hashes(F.col("words")).alias("hashed"))
    parts = [hashed.select("k1", "k2", F.posexplode(runs(F.col("hashed"), F.lit(n))).alias("pos", "h")) for n in [SHINGLE, *short]]
    seen = reduce(DataFrame.union, parts)
    # The starts from which a window holds the hit, cut into chunks: hits of one chunk become
    # one run of starts, and a long run is many rows. A chunk has as many starts as the item
    # has words, so that no word is in more than a few of an item's rows.
    from_ = F.greatest(F.col("pos") - F.greatest(F.col("size") - SHINGLE, F.lit(0)), F.lit(0))
    chunk = F.greatest(F.col("size"), F.lit(CHUNK))
    low = F.col("chunk") * chunk
    chunks = (
        seen.join(probes, "h")
        .select("k1", "k2", "item", "size", from_.alias("from"), F.col("pos").alias("to"))
        .select("*", F.explode(F.sequence(F.floor(F.col("from") / chunk), F.floor(F.col("to") / chunk))).alias("chunk"))
        .groupBy("k1", "k2", "item", "size", "chunk")
        .agg(F.min(F.greatest("from", low)).alias("from"), F.max(F.least("to", low + chunk - 1)).alias("to"))
    )
    wanted = chunks.groupBy("k1", "k2").agg(F.collect_list(F.struct("item", "size", "from", "to")).alias("wins"))
    wanted = scratch.stage(wanted, "windows")
    # The last window ends with the document.
    end = lambda w: F.greatest(F.size("words") - w["size"], F.lit(0))
    cut = F.transform(
        F.filter("wins", lambda w: w["from"] <= end(w)),
        lambda w: F.struct(
            w["from"].alias("from"),
            F.least(w["to"], end(w)).alias("to"),
            w["item"].alias("item"),
            w["size"].alias("size"),
            F.slice("words", w["from"] + 1, F.least(w["to"], end(w)) - w["from"] + w["size"]).alias("part"),
        ),
    )
    stretches = (
        texts.join(wanted, ["k1", "k2"])
        .select("doc_id", "k1", "k2", F.explode(cut).alias("w"))
        .select("doc_id", "k1", "k2", "w.*")
        .distinct()
        .select("*", word_hashes(F.col("part")).alias("hashed"))
        .select("*", runs(F.col("hashed"), shingle_size()).alias("hashes"))
    )
    shingles = weighted(F.col("part"), F.col("hashes"), shingle_size())
    # Staged with what the comparison reads many times, so that it is worked out once.
    stretches = scratch.stage(
        stretches.select("doc_id", "k1", "k2", "item", "size", "from", "to", shingles.alias("shingles"))
        .join(items.drop("size"), "item")
        .withColumn("marked", marked(F.col("shingles"), F.col("item_shingles"))),
        "cut",
    )
    scored = stretches.select("doc_id", "k1", "k2", "item", "item_id", "size", best_window().alias("best"))
    # The threshold is asked of the best window: asked of each, it would sink below the
    # comparison and do it twice.
    best = scored.groupBy("doc_id", "k1", "k2", "item", "item_id").agg(
        F.max(F.struct("best.similarity", "best.back", "size")).alias("best")
    )
    return best.filter(F.col("best.similarity") >= threshold).select(
        "doc_id", "k1", "k2", "item_id", "best.similarity", (-F.col("best.back")).alias("start"), "best.size"
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of `docs` that hold no item; same columns."""
    k1, k2 = fresh("k1"), fresh("k2")
    found = leaks(docs, benchmark, scratch).select(F.col("k1").alias(k1), F.col("k2").alias(k2)).distinct()
    found = scratch.stage(found, "leaks")
    keyed = docs.select("*", *(c.alias(n) for c, n in zip(row_key(), (k1, k2))))
    return keyed.join(found, [k1, k2], "left_anti").select(*docs.columns)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(document, benchmark item) pairs of leaked passages over all documents."""
    docs, benchmark = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return leaks(docs, benchmark, Scratch(spark)).select("doc_id", "item_id", "similarity", "start", "size")
