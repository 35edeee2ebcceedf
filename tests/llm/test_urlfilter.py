import random
from collections import Counter

from pyspark.sql import functions as F

from lucrum.llm import urlfilter


def brute(captures, events):
    active = {}
    for e in sorted(e for e in events if None not in e):
        active.setdefault((e[0], e[1]), {}).setdefault(e[2], []).append(e[3])

    def is_on(entry, t):
        at = [s for s in active[entry] if s <= t]
        return bool(at) and min(active[entry][max(at)])
    out = []
    for key, url, t in captures:
        names = {}
        if url and "://" in url and t is not None:
            rest = url.split("://", 1)[1]
            host = rest.split("/")[0].split("?")[0].split("#")[0].rsplit("@", 1)[-1].split(":")[0].lower().rstrip(".")
            labels = host.split(".")
            if host:
                for i in range(max(1, len(labels) - 1)):
                    names[".".join(labels[i:])] = len(labels) - i
                path = rest.split("/", 1)[1] if "/" in rest else ""
                seg = path.split("/")[0].split("?")[0].split("#")[0]
                if seg:
                    names[host + "/" + seg] = len(labels) + 1
        hits = sorted((-names[e], lst != "allow", lst, e) for lst, e in active if e in names and is_on((lst, e), t))
        out.append((key, url, t, bool(hits) and hits[0][1], hits[0][2] if hits else None, hits[0][3] if hits else None, len(hits)))
    return Counter(out)


def test_equals_replaying_the_lists(spark):
    r = random.Random(5)
    hosts = ["a.example.org", "b.example.org", "example.org", "x.y.example.com", "localhost"]
    urls = [f"{s}://{h.upper() if r.random() < .2 else h}{p}" for h in hosts for s in ("http", "https")
            for p in ("", "/", "/blog", "/blog/x?y=1", ":80/blog#t", "?q", "/shop/")] + ["", "no address", "http://", None, "http:///x"]
    urls += ["http://b.example.org@a.example.org/blog", "http://u:p@a.example.org/", "http://u@v@x.y.example.com:80/", "http://a.example.org./blog",
             "http://example.org/@a.example.org", "http://example.org?@a.example.org", "http://./", "http://u@/x"]
    entries = hosts + ["example.com", "a.example.org/blog", "example.org/shop"]
    events = [(r.choice(["spam", "adult", "allow"]), r.choice(entries), r.randint(0, 30), r.random() < .6) for _ in range(120)]
    events += [events[0], (None, "example.org", 1, True), ("spam", None, 1, True), ("spam", "example.org", None, True)]
    captures = [(i, r.choice(urls), r.randint(0, 35)) for i in range(400)] + [(1, urls[0], None), (None, urls[2], 20), (None, urls[2], 20)]
    df = spark.createDataFrame(captures, "page_id long, url string, fetched long").withColumn("list", F.lit("x")).withColumn("key", F.lit(1))
    ev = spark.createDataFrame(events, "list string, entry string, at long, added boolean")
    out = urlfilter.judge(df, ev)
    got = Counter(map(tuple, out.select("page_id", "url", "fetched", "blocked", "list", "entry", "n_active").collect()))
    assert got == brute(captures, events)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
    assert urlfilter.judge(df, ev.limit(0)).where("blocked").count() == 0
    assert urlfilter.judge(df.limit(0), ev).count() == 0


def test_intervals_are_disjoint(spark):
    events = [("l", "e", 1, True), ("l", "e", 2, True), ("l", "e", 5, False), ("l", "e", 5, True), ("l", "e", 7, False), ("l", "e", 9, True)]
    got = sorted(map(tuple, urlfilter.intervals(spark.createDataFrame(events, "list string, entry string, at long, added boolean")).collect()))
    assert got == [("l", "e", 1, 5), ("l", "e", 9, None)]
