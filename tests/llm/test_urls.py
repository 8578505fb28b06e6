import random
import re

import pytest

from metframe.llm import queries, urls


def as_pattern(glob):
    out = "".join({"**": ".*", "*": "[^/]*", "?": "[^/]"}.get(p, re.escape(p)) for p in re.findall(r"\*\*|\*|\?|[^*?]", glob))
    return re.compile(out, re.S)


@pytest.mark.parametrize("seed", range(4))
def test_automaton_is_the_pattern(seed):
    rng = random.Random(seed)
    globs = list({re.sub(r"\*{3,}", "**", "".join(rng.choice("ab/*?*") for _ in range(rng.randrange(12)))) for _ in range(40)})
    texts = ["".join(rng.choice("ab/") for _ in range(rng.randrange(10))) for _ in range(300)] + [""]
    hits = urls.run(urls.build(globs), [t.encode() for t in texts])
    for j, glob in enumerate(globs):
        pattern = as_pattern(glob)
        assert [bool(h) for h in hits[:, j]] == [bool(pattern.fullmatch(t)) for t in texts], glob


def test_rules(spark):
    pages = [
        (1, "http://EXAMPLE.net/en/x?y#z"), (2, "https://a.example.net/fr/"), (3, "ftp://b.org/fr"), (4, "x://org/fr/"), (5, None),
        (6, "no scheme"), (7, "http://net"), (8, "http://xnet/"), (9, "http://evil.com/a.net/en/"), (10, "a://b://c.net/"), (None, "http://q.net/#/"),
        (11, "http://É.net/"), (12, ""), (13, "http://x.spam-farm.example.org/en/"), (13, "http://x.spam-farm.example.org/en/"),
    ]
    df = spark.createDataFrame([(i, u, "h") for i, u in pages], "page_id long, url string, host string")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judged(df, queries.RULES, queries.BLOCK).collect()}
    assert got == {
        (1, "example.net", "/en/x", "example.net/en/", "allow"), (2, "a.example.net", "/fr/", "net/", "block"), (3, "b.org", "/fr", None, "allow"),
        (4, "org", "/fr/", "org/fr/", "allow"), (5, "", "", None, "allow"), (6, "", "", None, "allow"), (7, "net", "", None, "allow"),
        (8, "xnet", "/", None, "allow"), (9, "evil.com", "/a.net/en/", None, "allow"), (10, "b:", "//c.net/", None, "allow"),
        (None, "q.net", "/", "net/", "block"), (11, "É.net", "/", "net/", "block"), (12, "", "", None, "allow"),
        (13, "x.spam-farm.example.org", "/en/", None, "block"),
    }
    assert urls.judged(df.where("false"), queries.RULES, queries.BLOCK).count() == 0
