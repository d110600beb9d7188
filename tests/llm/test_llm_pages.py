from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest
from llm_brute import judge_url

from wardflow.llm.common import only, table
from wardflow.llm.queries import LLM_ORACLES, LLM_QUERIES
from wardflow.llm.url_rules import judge_urls, rules_table
from wardflow.llm.warc_index import (WarcParams, parse_record, read_back, record_bytes, search,
                                     write_archive)

PAGES = [(1, "http://a.com/x", "hi"), (2, "http://a.com/x y", "hi"), (2, "http://a.com/x y", "hi"),
         (None, None, "hi"), (-3, "zz", None), (4, "http://b.org/\r\nq", ""),
         (5, "http://é.com/?a", "ü" * 10), (1, "http://a.com/x", "hi"), (6, "http://a.com/x", "ho")]


def pages(spark, rows):
    return spark.createDataFrame(
        [(*r, "?", "?", "?") for r in rows],
        "page_id long, url string, html string, digest string, n string, entry string")


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_equals_its_sql(spark, small, name):
    got = LLM_QUERIES[name](spark, small)
    with duckdb.connect() as con:
        for name_of in ("documents", "benchmark", "pages"):
            con.execute(f"CREATE VIEW {name_of} AS SELECT * FROM '{small}/{name_of}.parquet'")
        con.execute(LLM_ORACLES[name])
        assert [d[0] for d in con.description] == got.columns
        want = con.fetchall()
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))


def brute_records(rows, least=0):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    count = {}
    for _, _, html in rows:
        count[html or ""] = count.get(html or "", 0) + 1
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        other = first.get(html or "")
        again = count[html or ""] > 1 and len(body) >= least and other is not None and other != i
        out.append((i, len(body), "revisit" if again else "response", other if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 1, 3])
def test_archives_read_back_by_their_index(spark, least):
    got = read_back(pages(spark, PAGES), WarcParams(min_revisit_bytes=least, block=2)).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got),
                  key=str) == brute_records(PAGES, least)
    bodies = {r.page_id: r.html for r in got if r.record_type == "response"}
    assert bodies[5] == "ü" * 10 and bodies[-3] == ""
    assert read_back(pages(spark, [])).count() == 0


def test_search_finds_exactly_the_wanted_captures(spark, small):
    all_pages = table(spark, small, "pages")
    archive = write_archive(all_pages, WarcParams(block=7, file_bytes=20_000))
    wanted = all_pages.where("page_id % 10 = 3").select("page_id", "url")
    got = search(archive, wanted.union(wanted)).collect()
    assert sorted(r.page_id for r in got) == sorted(r.page_id for r in wanted.collect())
    none = spark.createDataFrame([(1, "http://nowhere.example/")], "page_id long, url string")
    assert search(archive, none).count() == 0


def test_records_round_trip():
    for refers_to in (None, 7):
        raw = record_bytes(12, "http://a/\n", b"body\r\n\r\nmore", "D" * 32, refers_to,
                           "1970-01-01T00:00:00Z")
        got = parse_record(raw)
        assert (got["page_id"], got["payload_bytes"], got["refers_to"]) == (12, 12, refers_to)
        assert got["payload"] == (b"" if refers_to else b"body\r\n\r\nmore")


def test_url_rules_against_brute_force(spark):
    pick = random.Random(2)
    labels = ["a", "b", "com", "net", "x-y", "é", "a-", "a,b"]
    for default in ("allow", "block"):
        rules = list({(pick.choice(["allow", "block"]),
                       ".".join(pick.choice(labels) for _ in range(pick.randint(1, 4))),
                       pick.choice(["", "/", "/e", "/en/", "/f"])) for _ in range(40)})
        urls = [(i, pick.choice(["http://", "HTTPS://", "x"])
                 + ".".join(pick.choice(labels) for _ in range(pick.randint(1, 5)))
                 + pick.choice(["", "/", "/en/x", "/e?x", "#/en", "/f://x"])) for i in range(800)]
        urls += [(7, None), (8, ""), (9, "://"), (None, "http://A.COM/"), (10, "http://a..com/e"),
                 (11, "http://.com/e"), (12, "http://com./e"), (13, "x" * 100_000), (8, "")]
        noise = rules + rules[:3] + [(None, "a", "/"), ("block", None, "/"), ("block", "", "/")]
        got = judge_urls(pages(spark, [(*u, "") for u in urls]),
                         rules_table(spark, noise), default).collect()
        assert sorted(map(str, (tuple(r) for r in got))) == sorted(
            str((i, *judge_url(u, rules, default))) for i, u in urls)


def test_url_rules_on_empty_tables(spark):
    assert judge_urls(pages(spark, []), rules_table(spark, [("block", "a", "/")])).count() == 0
    got = judge_urls(pages(spark, PAGES), rules_table(spark, [])).collect()
    assert {r.verdict for r in got} == {"allow"} and len(got) == len(PAGES)


def test_url_plan_has_no_python(spark, small):
    from helpers import executed_plan
    plan = executed_plan(LLM_QUERIES["op7_url_rules"](spark, small))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert np.size(only(table(spark, small, "pages"), url="string").columns) == 1
