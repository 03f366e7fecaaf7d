import random

from tidemark.llm import warc
from tidemark.llm.common import Scratch


def rows():
    rng = random.Random(1)
    out = []
    for i in range(700):
        url = f"https://h{rng.randrange(5)}.example.org/{rng.randrange(40)}?q=é {i}"
        html = "<p>hot</p>" if i % 3 == 0 else f"<html>é😀\r\n\r\n{rng.random()}</html>"
        out.append((i * 7 % 1000 - 20, url, html, "x"))
    out += [(5000, None, None, "x"), (5001, "no scheme\r\nX: y", "", "x"), (5002, "", "z" * 200_000, "x")]
    out += [(None, "http://a/", "only", "x"), (None, "http://a/b", "<p>hot</p>", "x")]
    return out + [out[5], out[3]]


def want(data):
    first = {}
    for page, _, html, _ in data:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    out = []
    for page, _, html, _ in data:
        payload = (html or "").encode()
        known = first.get(html or "", page)
        repeat = known != page and known is not None
        out.append((page, len(payload), warc.digest_of(payload), "revisit" if repeat else "response", known if repeat else None))
    return out


def test_round_trip(spark, tmp_path, monkeypatch):
    data = rows()
    pages = spark.createDataFrame(data, "page_id long, url string, html string, file string").repartition(4)
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    got = [tuple(r) for r in warc.op5_warc(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(want(data), key=repr)


def test_index_blocks_and_unknown_pages(spark, tmp_path, monkeypatch):
    data = [(i // 3, "http://same.org/", f"<p>{i // 3}", "x") for i in range(900)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, file string")
    archive = warc.write(pages, Scratch(spark))
    asked = spark.createDataFrame([(7, "http://same.org/"), (7, "http://same.org/"), (900, "http://same.org/"), (7, "http://other.org/"), (None, None)], "page_id long, url string")
    assert [r.page_id for r in warc.look_up(asked, archive).collect()] == [7, 7, 7]
    assert warc.look_up(asked.limit(0), archive).count() == 0
    nothing = warc.write(pages.limit(0), Scratch(spark))
    assert nothing.shards == () and warc.look_up(asked, nothing).count() == 0


def test_small_payloads_are_all_responses(spark):
    data = [(1, "http://a/", "short"), (2, "http://b/", "short"), (3, "http://c/", "longer payload"), (4, "http://d/", "longer payload")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    got = {r.page_id: r.refers_to for r in warc.with_references(pages, 10).collect()}
    assert got == {1: None, 2: None, 3: None, 4: 3}


def test_url_keys_sort_by_domain():
    keys = [warc.url_key(u) for u in ("http://b.org/x", "https://a.B.org:80/y?z", None, "plain", "http://org")]
    assert keys == ["org,b)/x", "org,b,a:80)/y?z", ")", ")plain", "org)"]
