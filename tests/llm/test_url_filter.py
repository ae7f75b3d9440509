import random
import re

import numpy as np
import pyarrow as pa

from lakeq.llm import queries, textvec, url_filter
from lakeq.llm.url_filter import Glob, host_rule, host_word


def test_automaton_equals_regular_expressions():
    rng = random.Random(0)
    for _ in range(40):
        globs = ["".join(rng.choice("ab/*~?.") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 12))]
        subjects = ["".join(rng.choice("ab/.") for _ in range(rng.randint(0, 25))) for _ in range(60)]
        kinds = {"*": "(?s:.*)", "~": "[^/]*", "?": "(?s:.)"}
        regexes = [re.compile("".join(kinds.get(c, re.escape(c)) for c in g)) for g in globs]
        _, _, data, offs = next(textvec.slices(pa.array(subjects)))
        got = url_filter.Automaton([Glob(g, "block") for g in globs]).fits(data, offs)
        want = np.array([[bool(r.fullmatch(s)) for r in regexes] for s in subjects])
        assert (got == want).all()


def test_rules(spark):
    rows = [(1, "https://WWW.Example.com/en/x?q=/no#f"), (2, "http://a.example.com/en/"), (3, "http://example.com/de/"),
            (4, "http://b.net/es/1"), (5, "http://b.net/ES/1"), (6, "http://b.org/x.com/en/"), (7, "http://b.com"),
            (8, None), (9, ""), (10, "no scheme"), (11, "http://x.casino-y.org"), (12, "http://a.org/casino"),
            (13, "x://notexample.com/en/"), (14, "http://é.net/fr/"), (14, "http://é.net/fr/"), (15, "a://b://c.com/"),
            (16, "://com/z?"), (17, "http://" + "a" * 5000 + ".com/" + "b" * 5000)]
    df = spark.createDataFrame([(*r, "rule") for r in rows], "page_id long, url string, host string").repartition(3)
    globs = [*queries.URL_RULES, *(host_word(w, "block") for w in queries.BLOCKED_HOST_WORDS)]
    got = {}
    for r in url_filter.judge_urls(df, globs).collect():
        got.setdefault(r.page_id, []).append((r.host, r.path, r.rule, r.verdict))
    assert got.pop(17) == [("a" * 5000 + ".com", "/" + "b" * 5000, "com/", "allow")]
    assert len(got.pop(14)) == 2
    assert {k: v[0] for k, v in got.items()} == {
        1: ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        2: ("a.example.com", "/en/", "example.com/en/", "block"),
        3: ("example.com", "/de/", "com/", "allow"),
        4: ("b.net", "/es/1", "net/es/", "block"), 5: ("b.net", "/ES/1", None, "allow"),
        6: ("b.org", "/x.com/en/", None, "allow"), 7: ("b.com", "", None, "allow"),
        8: ("", "", None, "allow"), 9: ("", "", None, "allow"), 10: ("", "", None, "allow"),
        11: ("x.casino-y.org", "", None, "block"), 12: ("a.org", "/casino", None, "allow"),
        13: ("notexample.com", "/en/", "com/", "allow"),
        15: ("b:", "//c.com/", None, "allow"), 16: ("com", "/z", "com/", "allow")}


def test_empty_table_and_no_rules(spark):
    df = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge_urls(df, [host_rule("com", "/", "block")]).collect() == []
    one = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert url_filter.judge_urls(one, [], "block").first().verdict == "block"
