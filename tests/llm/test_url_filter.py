import re

import numpy as np

from rostermart.llm import url_filter as f
from rostermart.llm.queries import URL_RULES

URLS = ["http://www.x.example.net/en/1?q=/de/", "https://EXAMPLE.NET/en/", "http://example.net/fr/", "ftp://a.org/fr/x#y", "http://org/fr/z", "http://example.com/de/a",
        "http://sub.example.com/en/", "http://notexample.com/de/", "no scheme", None, "", "http://", "://net/", "http://net", "http://a.net/x\ny?z", "x://a.com//b://net/"]


def brute(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = ("".join(c.lower() if c.isascii() else c for c in m[1]), m[2]) if m else ("", "")
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.name), default=None)


def test_rules(spark):
    rows = [(i, u, "p", "h") for i, u in enumerate(URLS)] + [(None, URLS[0], "p", "h")] * 2
    got = f.judge(spark.createDataFrame(rows, "page_id long, url string, path string, host string").repartition(3), URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, rule = brute(URLS[r.page_id or 0])
        assert (r.host, r.path, r.rule) == (host, path, rule.name if rule else None)
        assert r.verdict in ("allow", "block") and (rule is None or r.verdict == rule.verdict)


def test_model_learns_from_labels():
    rng = np.random.default_rng(0)
    def url(bad):
        return f"{'casino' if bad else 'school'}{rng.integers(1000)}.com", f"/{rng.integers(1000)}/{'win' if bad else 'book'}"
    y = rng.integers(0, 2, 400).astype(bool)
    made = [url(b) for b in y]
    model = f.train([h for h, _ in made[:200]], [p for _, p in made[:200]], y[:200])
    import pyarrow as pa
    score = model.scores(pa.array([h for h, _ in made[200:]]), pa.array([p for _, p in made[200:]]))
    assert ((score >= 0.5) == y[200:]).mean() > 0.97


def test_without_labels(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x"), (2, "http://b.net/")], "page_id long, url string")
    assert {r.verdict for r in f.judge(pages.where("page_id = 1"), URL_RULES).collect()} == {"allow"}
    assert {r.verdict for r in f.judge(pages, URL_RULES[:1]).collect()} == {"block"}
    assert f.judge(pages.limit(0), URL_RULES).count() == 0
