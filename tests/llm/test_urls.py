from datetime import date
from urllib.parse import urlsplit

from cohortflow.llm import urls
from cohortflow.llm.common import pick, read

EVENTS = [
    ("bad.example.org", "block", date(2024, 1, 10)),
    ("bad.example.org", "off", date(2024, 3, 1)),
    ("bad.example.org", "off", date(2024, 3, 1)),
    ("bad.example.org", "block", date(2024, 6, 1)),
    ("bad.example.org/press", "allow", date(2024, 2, 1)),
    ("example.net", "block", date(2024, 1, 1)),
    ("good.example.net", "allow", date(2024, 1, 1)),
    ("same.day", "allow", date(2024, 5, 5)),
    ("same.day", "block", date(2024, 5, 5)),
    (None, "block", date(2024, 1, 1)),
    ("void.org", "ban", date(2024, 1, 1)),
    ("void.org", "block", None),
]
CASES = [
    ("http://bad.example.org/x", date(2024, 1, 9), "pass"),
    ("http://bad.example.org/x", date(2024, 1, 10), "block"),
    ("HTTP://user:pw@BAD.example.org:8080/press/1?q=1#f", date(2024, 2, 2), "allow"),
    ("http://bad.example.org/pressed", date(2024, 2, 2), "block"),
    ("http://bad.example.org", date(2024, 3, 1), "pass"),
    ("http://bad.example.org./x", date(2024, 7, 1), "block"),
    ("https://a.b.example.net/", date(2024, 1, 1), "block"),
    ("https://good.example.net/", date(2024, 1, 1), "allow"),
    ("https://notexample.net/", date(2024, 1, 1), "pass"),
    ("ftp://same.day/", date(2024, 5, 5), "block"),
    ("http://void.org/", date(2024, 5, 5), "pass"),
    ("no url at all", date(2024, 5, 5), "pass"),
    ("", date(2024, 5, 5), "pass"),
    (None, date(2024, 5, 5), "pass"),
    ("http://bad.example.org/x", None, "pass"),
    ("http://bad.example.org" + "/p" * 20_000, date(2024, 1, 10), "block"),
    ("http://" + "a." * 5_000 + "example.net/", date(2024, 1, 10), "block"),
]
LIST = "key string, action string, listed_on date"
CAPTURES = "page_id long, url string, fetched_on date, HOST string, parts string"


def test_cases_and_repeated_rows(spark):
    captures = [(i, url, day, "x", "y") for i, (url, day, _) in enumerate(CASES)]
    out = urls.judge(spark.createDataFrame(captures * 2, CAPTURES), spark.createDataFrame(EVENTS, LIST)).collect()
    assert len(out) == 2 * len(CASES)
    for r in out:
        assert r["verdict"] == CASES[r["page_id"]][2], (r["page_id"], r["verdict"])


def test_empty_sides(spark):
    none, events = spark.createDataFrame([], CAPTURES), spark.createDataFrame(EVENTS, LIST)
    some = spark.createDataFrame([(1, "http://bad.example.org/", date(2024, 1, 10), "", "")], CAPTURES)
    assert urls.judge(none, events).count() == 0
    assert [r["verdict"] for r in urls.judge(some, spark.createDataFrame([], LIST)).collect()] == ["pass"]


def test_against_brute_force(spark, tables):
    pages = pick(read(spark, tables, "pages"), "page_id", "url")
    events = [(r["key"], r["action"], r["listed_on"]) for r in urls.listed(pages).collect()]
    captures = urls.fetched(pages).collect()
    rank = {a: i for i, a in enumerate(urls.STRICTNESS)}

    def verdict(url, day):
        parts = urlsplit(url)
        labels, path = parts.hostname.split("."), [p for p in parts.path.split("/") if p]
        for depth in range(len(path), -1, -1):
            for n in range(len(labels), 0, -1):
                key = "/".join([".".join(labels[-n:]), *path[:depth]])
                past = [(d, rank[a]) for k, a, d in events if k == key and d <= day]
                if past and max(past)[1]:
                    return urls.STRICTNESS[max(past)[1]]
        return "pass"

    want = {r["page_id"]: verdict(r["url"], r["fetched_on"]) for r in captures}
    got = {r["page_id"]: r["verdict"] for r in urls.judge(urls.fetched(pages), urls.listed(pages)).collect()}
    assert got == want and len(set(want.values())) == 3
