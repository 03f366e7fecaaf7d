"""The keys a table holds, arranged so that a batch reads few of them.

Keys lie in buckets of their hash, one part per run (a batch, or several folded ones), and
every part has a Bloom filter. A batch tests its own keys against the filters and reads the
parts that may hold one of them: for new keys almost none, for known ones those they are in.
Runs are folded by eights, each eight into one of the next level, so that few runs exist and
a key is written once per level.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import folders_in, has_file, read_text, remove, write_text
from tidemark.streaming import batches
from tidemark.streaming.batches import BATCH, FEED, Folder

BUCKETS = 32
RUNS_PER_FOLD = 8
# Bits of a filter per key, tests per key, and the largest filter of a part in 64-bit words.
BITS_PER_KEY, TESTS, MOST_WORDS = 12, 4, 1 << 17
FOLD_NAME = f"{batches.FOLDED}_level"
HASH, BUCKET = "_hash", "_bucket"
FILTERS = f"{FEED} string, {BATCH} long, {BUCKET} int, rows long, words array<long>"


def _place(test: int, bits: Column) -> Column:
    """Which bit of a filter this test of a key looks at."""
    return F.pmod(F.xxhash64(F.col(HASH), F.lit(test)), bits)


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


class KeyIndex:
    """Index of the keys of the table at `target`, in a folder of it that readers pass over."""

    def __init__(
        self, spark: SparkSession, target: str, schema: T.StructType, buckets: int = BUCKETS, runs: int = RUNS_PER_FOLD
    ) -> None:
        self._spark, self._schema, self._runs = spark, schema, runs
        self._keys = schema.names
        self._root = f"{target.rstrip('/')}/_keys"
        self._filters = f"{target.rstrip('/')}/_filters"
        # Buckets are what an index was made with, whatever is asked for later.
        made = f"{self._filters}/buckets.json"
        if not has_file(spark, self._filters, "buckets.json"):
            write_text(spark, made, json.dumps(buckets))
        self._buckets = json.loads(read_text(spark, made))

    @classmethod
    def of(cls, spark: SparkSession, target: str, keys: Sequence[str]) -> KeyIndex | None:
        """The index of a table that has one."""
        if not folders_in(spark, f"{target.rstrip('/')}/_keys"):
            return None
        return cls(spark, target, batches.read_live(spark, target).select(*keys).schema)

    def runs(self, but: Folder | None = None) -> list[Folder]:
        """Runs whose keys and filters are written."""
        found = batches.live_folders(self._spark, self._root)
        return [r for r in found if r != but and has_file(self._spark, self._filter_path(r), batches.DONE)]

    def add(self, rows: DataFrame, run: Folder) -> None:
        """Store the keys of these rows as a run, replacing it where it is there."""
        remove(self._spark, self._filter_path(run))
        keys = self._hashed(rows).select(*self._keys, HASH, BUCKET).distinct().hint("rebalance", BUCKET)
        batches.write_batch(keys, self._root, run, [BUCKET])
        self._write_filters(run, self._spark.read.schema(self._stored()).parquet(batches.folder_path(self._root, run)))

    def know(self, run: Folder) -> None:
        """Take note that all keys of this folder of the table are in the index already."""
        self.add(self._spark.createDataFrame([], self._schema), run)

    def cover(self, target: str, but: Folder | None = None) -> None:
        """Add the keys of folders that came into the table by another way than the feed's."""
        known = set(batches.all_folders(self._spark, self._root))
        known |= {f for folded in batches.covers(self._spark, self._root).values() for f in folded}
        for folder in batches.live_folders(self._spark, target):
            if folder != but and folder not in known:
                rows = self._spark.read.schema(self._schema).parquet(batches.folder_path(target, folder))
                self.add(rows, folder)

    def candidates(self, rows: DataFrame, but: Folder | None = None) -> list[tuple[Folder, int, int]]:
        """Parts (run, bucket) that may hold a key of these rows, and how many keys they hold.

        The rows' hashes meet the filters of their bucket; what comes back is at most one
        entry per run and bucket."""
        runs = self.runs(but)
        if not runs:
            return []
        filters = self._spark.read.schema(FILTERS).parquet(*[self._filter_path(r) for r in runs])
        probes = self._hashed(rows).select(HASH, BUCKET).distinct()
        bits = F.size("words").cast("long") * 64
        holds = _all(
            [
                F.getbit(F.element_at("words", (F.floor(_place(i, bits) / 64) + 1).cast("int")), F.pmod(_place(i, bits), F.lit(64)).cast("int")) == 1
                for i in range(TESTS)
            ]
        )
        hit = filters.alias("f").join(probes.alias("p"), (F.col(f"f.{BUCKET}") == F.col(f"p.{BUCKET}")) & holds, "left_semi")
        return [((r[FEED], r[BATCH]), r[BUCKET], r["rows"]) for r in hit.select(FEED, BATCH, BUCKET, "rows").collect()]

    def unseen(self, rows: DataFrame, but: Folder | None = None) -> DataFrame:
        """The rows whose key no run holds."""
        parts = self.candidates(rows, but)
        if not parts:
            return rows
        paths = [f"{batches.folder_path(self._root, run)}/{BUCKET}={bucket}" for run, bucket, _ in parts]
        stored = self._spark.read.schema(T.StructType(self._stored().fields[:-1])).parquet(*paths)
        a, b = self._hashed(rows).alias("a"), stored.distinct().alias("b")
        same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in self._keys]
        return a.join(b, _all([F.col(f"a.{HASH}") == F.col(f"b.{HASH}"), *same]), "left_anti").select(*rows.columns)

    def tidy(self, but: Folder | None = None) -> None:
        """Fold every eight runs of a level into one of the next."""

        def level(run: Folder) -> int:
            return int(run[0][len(FOLD_NAME) :].split("-")[0]) if run[0].startswith(FOLD_NAME) else 0

        for at, found in groupby(sorted(self.runs(but), key=level), key=level):
            found = list(found)
            if len(found) >= self._runs:
                batches.fold(
                    self._spark,
                    self._root,
                    lambda rows: rows.select(*self._keys, HASH, BUCKET).distinct().hint("rebalance", BUCKET),
                    found,
                    [BUCKET],
                    f"{FOLD_NAME}{at + 1}",
                    lambda made, rows: self._write_filters(made, rows),
                )
                for run in found:
                    remove(self._spark, self._filter_path(run))
                return

    def _filter_path(self, run: Folder) -> str:
        return f"{self._filters}/{run[0]}.{run[1]}"

    def _stored(self) -> T.StructType:
        hashes = [T.StructField(HASH, T.LongType()), T.StructField(BUCKET, T.IntegerType())]
        return T.StructType([*self._schema.fields, *hashes])

    def _hashed(self, rows: DataFrame) -> DataFrame:
        hashed = rows.withColumn(HASH, F.xxhash64(*self._keys))
        return hashed.withColumn(BUCKET, F.pmod(F.col(HASH), F.lit(self._buckets)).cast("int"))

    def _write_filters(self, run: Folder, keys: DataFrame) -> None:
        """One filter per bucket that has keys: bits are set word by word, then the words of
        a bucket are put in order. All filters of a run have the same length."""
        words, per_bucket = 1, keys.count() / self._buckets
        while words * 64 < per_bucket * BITS_PER_KEY and words < MOST_WORDS:
            words *= 2
        bits = F.lit(words * 64)
        places = F.array(*[F.struct(F.lit(i).alias("test"), _place(i, bits).alias("place")) for i in range(TESTS)])
        placed = keys.select(BUCKET, F.inline(places))
        place = F.col("place")
        set_bits = placed.select(
            BUCKET,
            F.floor(place / 64).alias("word"),
            F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int")).alias("bits"),
            (F.col("test") == 0).cast("long").alias("rows"),
        )
        blank = self._spark.range(self._buckets * words).select(
            F.floor(F.col("id") / words).cast("int").alias(BUCKET),
            F.pmod("id", F.lit(words)).alias("word"),
            F.lit(0).cast("long").alias("bits"),
            F.lit(0).cast("long").alias("rows"),
        )
        of_word = set_bits.unionByName(blank).groupBy(BUCKET, "word").agg(F.bit_or("bits").alias("bits"), F.sum("rows").alias("rows"))
        in_order = F.array_sort(F.collect_list(F.struct("word", "bits")))
        of_bucket = of_word.groupBy(BUCKET).agg(F.sum("rows").alias("rows"), F.transform(in_order, lambda w: w["bits"]).alias("words"))
        out = of_bucket.where("rows > 0").select(F.lit(run[0]).alias(FEED), F.lit(run[1]).cast("long").alias(BATCH), BUCKET, "rows", "words")
        out.write.mode("overwrite").parquet(self._filter_path(run))
