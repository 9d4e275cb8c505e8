import random
import re

from tallyworks.llm import urlrules

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(url, rules):
    rest = url.partition("://")[2] if url else ""
    host, path, _ = re.match(r"(?s)([^/?#]*)([^?#]*)(.*)", rest).groups()
    host = host.translate(LOWER)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0]) + len(r[1]), len(r[0])), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


def judged(spark, urls, rules):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "1 AS host", "'x' AS key", "2 AS part")
    return urlrules.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))


def test_against_brute_force(spark, plan_of):
    rng = random.Random(1)
    labels, segments = ["a", "b", "com", "b-c", "é", ""], ["", "/", "/x", "/x/", "/xy", "/é", "/x/y", "/\U0010ffff"]

    def host():
        return ".".join(rng.choice(labels) for _ in range(rng.randint(1, 5)))

    rules = [(host().strip("."), rng.choice(segments) + rng.choice(segments), rng.choice(["allow", "block"])) for _ in range(60)]
    rules = list({(h, p): (h, p, v) for h, p, v in rules if h}.values())
    urls = [None, "", "no scheme", "://", "http://", "HTTP://A.B.COM", "http://u://v.com/x?y#z", "http://a.com?x/", "http://a.com#/x"]
    urls += [f"http://{host().upper() if rng.random() < 0.2 else host()}{rng.choice(segments)}{rng.choice(segments)}{rng.choice(['', '?q=/x', '#x'])}" for _ in range(400)]
    urls += ["http://b.com/x/y"] * 300
    result = judged(spark, urls, rules)
    rows = result.collect()
    assert len(rows) == len(urls)
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == brute(urls[r.page_id], rules), urls[r.page_id]
    assert not re.search("EvalPython|MapIn|FlatMapGroups|CartesianProduct|NestedLoop", plan_of(result))


def test_sweep_over_many_ranges(spark, with_settings):
    with_settings(spark__sql__shuffle__partitions="13")
    rng = random.Random(2)
    keys = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(0, 9))) for _ in range(300)})
    prefixes = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(0, 6))) for _ in range(40)})
    found = urlrules.sweep(spark.createDataFrame([(k,) for k in keys], "key string"), spark.createDataFrame([(p,) for p in prefixes], "key string"))
    got = {r.key: r.stack for r in found.collect()}
    assert got == {k: sorted((p for p in prefixes if k.startswith(p)), key=len) for k in keys}


def test_odd_rules_and_empty_tables(spark):
    assert [r.verdict for r in judged(spark, ["http://a.b/c"], []).collect()] == ["allow"]
    rules = [("A.B", "/c", "block"), ("a.b", "/c", "allow"), (None, "/", "block"), ("b", None, "block")]
    assert [(r.rule, r.verdict) for r in judged(spark, ["http://a.b/c", "http://b/"], rules).orderBy("page_id").collect()] == [("a.b/c", "allow"), (None, "allow")]
    assert judged(spark, [], rules).collect() == []
