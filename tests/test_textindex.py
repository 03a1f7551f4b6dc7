"""Search by an index of parts, against scans and against the patterns themselves."""

from __future__ import annotations

import random
import re

import pytest

from hostpulse.operators.textindex import TextIndex, found_in, needed_grams, plain_runs, search

HOSTS = ["host1", "HOST12-3", "proxy.a-b.com", "ab", "", None, "É-proxy-K\u212a", "poller", "poller", "a.b.c", "xhostx"]


@pytest.mark.parametrize(
    "pattern, runs",
    [
        ("host1", ["host1"]),
        (r"Proxy\.a", ["proxy.a"]),
        ("abc?def", ["ab", "def"]),
        ("abc+def", ["abc", "def"]),
        ("ab(cde|f)ghi", ["ab", "ghi"]),
        ("(abc)?def", ["def"]),
        ("abc|def", []),
        ("^ab[xyz]{2}cd$", ["ab", "cd"]),
        ("abc{0}def", ["ab", "def"]),
        ("abé|", []),
        ("abcédef", ["abc", "def"]),
        (r"\Qabc\E", []),
        (r"\x41bcd", []),
        (r"abc\d+def", ["abc", "def"]),
        ("(?x)a b c", []),
        ("[a[bc]]def", []),
        ("", []),
    ],
)
def test_runs(pattern, runs):
    assert plain_runs(pattern) == runs


def test_runs_are_held_by_every_match():
    random.seed(5)
    pieces = ["a", "b", "c", "ab", r"\.", ".", "a?", "b*", "c+", "[ab]", "(a|bc)", "(ab)*", "a{2}", "c{0,1}", r"\w"]
    for _ in range(4000):
        pattern = "".join(random.choices(pieces, k=random.randint(1, 6)))
        runs = plain_runs(pattern)
        for _ in range(10):
            text = "".join(random.choices("aAbBc.", k=9))
            match = re.search(pattern, text, re.IGNORECASE)
            assert not match or all(run in match[0].lower() for run in runs), (pattern, text)


@pytest.fixture(scope="module")
def hosts(spark, tmp_path_factory):
    table = spark.createDataFrame([(host, n) for n, host in enumerate(HOSTS)], "host string, value int")
    return table, TextIndex(spark, str(tmp_path_factory.mktemp("index") / "t")).build(table, "host")


@pytest.mark.parametrize(
    "wanted, literal, indexed",
    [
        ("HOST1", True, True), ("o", True, False), ("proxy", False, True), ("É-Proxy", True, True),
        ("a.b", True, True), ("a.b", False, False), ("^host[0-9]+(-3)?$", False, True),
        ("poll|host", False, False), ("absent", False, True), ("k\u212a", True, False), ("", True, False),
    ],
)
def test_search_equals_scan(hosts, wanted, literal, indexed):
    table, index = hosts
    assert bool(needed_grams(wanted, literal)) is indexed
    assert (index.find(wanted, literal) is not None) is indexed
    found = search(table, "host", index, wanted, literal)
    scan = table.where(found_in("host", wanted, literal))
    assert sorted(r.value for r in found.collect()) == sorted(r.value for r in scan.collect())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert bool(re.search(r"PushedFilters: \[[^\]]*(In|EqualTo)\(gram", plan)) is indexed


def test_empty_table(spark, hosts, tmp_path):
    table, _ = hosts
    index = TextIndex(spark, str(tmp_path / "t")).build(table.limit(0), "host")
    assert search(table.limit(0), "host", index, "host1").count() == 0
