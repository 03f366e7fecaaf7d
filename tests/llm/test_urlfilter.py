import random

import duckdb
from tidemark.llm import urlfilter as uf
from tidemark.llm.urlfilter import Rules

RULES = [("block", "org", "/"), ("allow", "a.org", "/x"), ("block", "a.org", "/xy"), ("block", "com", ""), ("allow", "b.com", "/long/path/")]


def brute(host, path, rules):
    fits = [(len(h) + len(p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, "allow")


def urls():
    rng = random.Random(1)
    hosts = ["org", "a.org", "x.a.org", "aa.org", "b.com", "c.b.com", "net", "", ".org", "A.ORG", "a.org:80"]
    paths = ["", "/", "/x", "/xy/z", "/long/path/é", "/long/path?q", "#top", "?a=/x"]
    out = [f"http://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(200)]
    return out + [None, "", "no scheme/", "://", "x://org/", "http://org/http://net/", "http://a.org/" + "y" * 9000, "HTTP://É.org/x"]


def test_longest_rule_wins(spark):
    rows = [(i if i % 9 else None, u, "keep") for i, u in enumerate(urls())]
    df = spark.createDataFrame(rows, "page_id long, url string, rule string").repartition(3)
    got = uf.judge(df, Rules(tuple(RULES)), keep=["page_id", "url"]).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.rule, r.verdict) == brute(r.host, r.path, RULES)
    assert uf.judge(df.limit(0), Rules(())).count() == 0
    assert {r.verdict for r in uf.judge(df, Rules(())).collect()} == {"allow"}


def test_a_rule_table_of_any_size_judges_every_row(spark):
    """Repeated ids, null ids and repeated urls: each row has its own verdict."""
    rows = [(i % 5 if i % 9 else None, u, "keep") for i, u in enumerate(urls() * 2)]
    df = spark.createDataFrame(rows, "page_id long, url string, rule string").repartition(3)
    table = spark.createDataFrame(RULES, "verdict string, host string, path string")
    columns = ["page_id", "url", "host", "path", "rule", "verdict"]
    key = lambda r: tuple(map(repr, r))
    want = sorted(map(tuple, uf.judge(df, Rules(tuple(RULES)), keep=["page_id", "url"]).select(columns).collect()), key=key)
    got = uf.judge_by_join(df, table, keep=["page_id", "url"])
    assert got.columns == columns
    assert sorted(map(tuple, got.collect()), key=key) == want
    none = uf.judge_by_join(df, table.limit(0), keep=["page_id"]).collect()
    assert len(none) == len(rows) and {r.verdict for r in none} == {"allow"}
    assert uf.judge_by_join(df.limit(0), table).count() == 0


def test_equal_digests_are_told_apart(monkeypatch):
    monkeypatch.setattr(uf.xxhash, "xxh64_intdigest", lambda key: 7)
    array = uf.DigestArray(Rules(tuple(RULES)))
    assert array.judge(["a.org", "net"], ["/xyz", "/"]) == [("a.org/xy", "block"), None]


def test_query_matches_its_sql(spark, tmp_path):
    pages = spark.createDataFrame([(i, u, "<p>") for i, u in enumerate(urls() * 2)], "page_id long, url string, html string")
    pages.coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = con.execute(uf.ORACLE).fetchall()
    got = [tuple(r) for r in uf.op4_url_filter(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
