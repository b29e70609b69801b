import random

from tillscope.llm import url_rules as U

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/es/a", "allow"), ("com", "/de/", "block"),
         ("a.com", "", "allow"), ("com", "/de/", "allow"), ("Example.ORG", "/x", "block"), (None, "/", "block")]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, tail = rest[:end], rest[end:]
        host = "".join(c.lower() if c.isascii() else c for c in host)
        path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    best = {}
    for h, p, v in RULES:
        h = h and h.lower()
        if h is not None and (host == h or host.endswith("." + h)) and path.startswith(p):
            best[h + p] = max(v, best.get(h + p, ""))
    rule = max(best, key=len, default=None)
    return host, path, rule, best[rule] if rule else "allow"


def test_rules_equal_brute_force(spark):
    rnd = random.Random(5)
    urls = [None, "", "no scheme", "http://", "x://ORG", "http://ORG/", "http://a.b.Example.org/es/a/b?q#f", "http://com/de/#x",
            "ftp://aéÀ.a.com?x/y", "http://org\n/", "http://...org/"]
    urls += ["http://" + "".join(rnd.choice(["a.", "b.", "example.", ""]) for _ in range(3)) + rnd.choice(["org", "com", "net"])
             + rnd.choice(["/es/", "/es/a", "/de/", "/", "", "/x", "?/es/"]) + rnd.choice(["", "a", "?k=://", "#t"]) for _ in range(150)]
    table = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)] + [(0, None, "twice")], "page_id long, url string, rule string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    out = U.judge_urls(table, rules, salts=8).collect()
    assert len(out) == len(urls) + 1
    for r in out:
        assert (r.host, r.path, r.rule, r.verdict) == brute(urls[r.page_id]), urls[r.page_id]
    assert U.judge_urls(table.limit(0), rules, salts=4).count() == 0
    assert {r.verdict for r in U.judge_urls(table, rules.limit(0), salts=4).collect()} == {"allow"}
