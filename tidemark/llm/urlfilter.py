"""URL rules by a sorted array of digests: vectorised binary search, then the full string."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import read

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OTHERWISE = "allow"
# Travels with every task: some 60 bytes a rule. Longer lists go through `judge_by_join`.
MOST_RULES = 200_000

# Verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and for urls without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


@dataclass(frozen=True)
class Rules:
    """(verdict, host, path) triples; of two with one host and path the first counts."""

    triples: tuple[tuple[str, str, str], ...]


class DigestArray:
    """xxhash64 digests of `host + path` in ascending order, mapped from a file of the
    worker's own that has no name, and the strings and verdicts in the same order."""

    def __init__(self, rules: Rules) -> None:
        verdicts = {}
        for verdict, host, path in rules.triples:
            verdicts.setdefault((host, path), verdict)
        keyed = sorted((xxhash.xxh64_intdigest(h + p), h, p, v) for (h, p), v in verdicts.items())
        self.entries = [(h, p, v) for _, h, p, v in keyed]
        self.sizes = sorted({len(p) for _, p, _ in self.entries})
        self.file = tempfile.TemporaryFile()
        np.array([k[0] for k in keyed] or [0], dtype="<u8").tofile(self.file)
        self.file.flush()
        self.digests = np.memmap(self.file, dtype="<u8", mode="r")[: len(keyed)]

    def judge(self, hosts: list[str], paths: list[str]) -> list[tuple[str, str] | None]:
        """(rule, verdict) of the longest rule that fits, per url."""
        owners, probes = [], []
        for i, (host, path) in enumerate(zip(hosts, paths)):
            labels = host.split(".")
            for at in range(len(labels)):
                suffix = ".".join(labels[at:])
                for size in self.sizes:
                    if size > len(path):
                        break
                    owners.append(i)
                    probes.append((suffix, path[:size]))
        wanted = np.fromiter((xxhash.xxh64_intdigest(h + p) for h, p in probes), dtype="<u8", count=len(probes))
        first = np.searchsorted(self.digests, wanted)
        found: list = [None] * len(hosts)
        inside = first < len(self.digests)
        inside[inside] = self.digests[first[inside]] == wanted[inside]
        for k in np.flatnonzero(inside):
            at = first[k]
            while at < len(self.digests) and self.digests[at] == wanted[k]:
                host, path, verdict = self.entries[at]
                if (host, path) == probes[k]:
                    rank = (len(host) + len(path), len(host))
                    if found[owners[k]] is None or found[owners[k]][0] < rank:
                        found[owners[k]] = (rank, host + path, verdict)
                at += 1
        return [f and f[1:] for f in found]


@lru_cache(maxsize=4)
def digest_array(rules: Rules) -> DigestArray:
    return DigestArray(rules)


def judge(urls: DataFrame, rules: Rules, url: str = "url", keep: list[str] | None = None) -> DataFrame:
    """`keep` (default: all columns but these four) with host, path, rule and verdict.

    A rule fits its host and all subdomains where the path starts with the rule's; the
    longest wins, of equally long ones that with the longer host. Where none fits, rule is
    null and the verdict is `allow`. Null and malformed urls have an empty host and path.
    """
    if len(rules.triples) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules: use judge_by_join")
    names = ["host", "path", "rule", "verdict"]
    keep = [c for c in urls.columns if c not in names] if keep is None else keep
    host, path = host_and_path(F.col(url))
    split = urls.select(*keep, host.alias("host"), path.alias("path"))
    out = StructType(list(split.schema.fields)).add("rule", "string").add("verdict", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = digest_array(rules)
        for batch in batches:
            found = array.judge(batch["host"].to_pylist(), batch["path"].to_pylist())
            rule = pa.array([f and f[0] for f in found], pa.string())
            verdict = pa.array([f[1] if f else OTHERWISE for f in found], pa.string())
            columns = [batch[name] for name in [*keep, "host", "path"]]
            yield pa.RecordBatch.from_arrays([*columns, rule, verdict], [*keep, *names])

    return split.mapInArrow(run, out)


def judge_by_join(urls: DataFrame, rules: DataFrame, url: str = "url", keep: list[str] | None = None) -> DataFrame:
    """What `judge` gives, for a rule table (verdict, host, path) of any size.

    Different (host, path) pairs and rules meet over the digest, then over the string; every
    row, repeated or without an id, then gets the verdict of its own pair. Of several rules
    with one host and path the last verdict in the alphabet counts. The lengths of rule
    paths, of which there are few, reach the driver."""
    names = ["host", "path", "rule", "verdict"]
    keep = [c for c in urls.columns if c not in names] if keep is None else keep
    host, path = host_and_path(F.col(url))
    rows = urls.select(*keep, host.alias("host"), path.alias("path"))
    sizes = [r[0] for r in rules.select(F.length("path")).distinct().collect() if r[0] is not None]
    labels = F.split("host", r"\.")
    suffixes = F.transform(labels, lambda x, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    probes = (
        rows.select("host", "path")
        .distinct()
        .select("host", "path", F.explode(suffixes).alias("suffix"))
        .select("host", "path", "suffix", F.explode(F.array(*(F.lit(s) for s in sizes)).cast("array<int>")).alias("size"))
        .filter("size <= length(path)")
        .select(F.struct("host", "path").alias("pair"), F.col("suffix").alias("host"), F.expr("left(path, size)").alias("path"))
        .withColumn("digest", F.xxhash64(F.concat("host", "path")))
    )
    own = rules.select("verdict", "host", "path", F.xxhash64(F.concat("host", "path")).alias("digest"))
    rank = F.struct(F.length("host") + F.length("path"), F.length("host"), F.concat("host", "path").alias("rule"), "verdict")
    best = probes.join(own, ["digest", "host", "path"]).groupBy("pair").agg(F.max(rank).alias("best"))
    found = best.select("pair.host", "pair.path", "best.rule", "best.verdict")
    judged = rows.join(found, ["host", "path"], "left")
    return judged.select(*keep, "host", "path", "rule", F.coalesce("verdict", F.lit(OTHERWISE)).alias("verdict"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page."""
    return judge(read(spark, sf_dir, "pages"), Rules(RULES), keep=["page_id"])


def _sql() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    return f"""
WITH rules(verdict, rhost, rpath) AS (VALUES {rules}),
rest AS (
  SELECT page_id, row_number() OVER () AS nr,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS tail
  FROM pages),
parts AS (
  SELECT page_id, nr, translate(regexp_extract(tail, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(substr(tail, length(regexp_extract(tail, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM rest),
best AS (
  SELECT nr, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
         arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY nr)
SELECT page_id, host, path, rule, coalesce(verdict, '{OTHERWISE}') AS verdict
FROM parts LEFT JOIN best USING (nr)"""


ORACLE = _sql()
