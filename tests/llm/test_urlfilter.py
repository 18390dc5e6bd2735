import datetime as dt

from pyspark.sql import functions as F

from tidemart.llm import urlfilter

CHANGES = "list string, entry string, day date, action string, seq long"
D = [dt.date(2024, 1, d) for d in range(1, 32)]


def judge(spark, urls, changes):
    captures = spark.createDataFrame([(i, u, d) for i, (u, d) in enumerate(urls)], "id long, url string, fetch_date date")
    captures = captures.withColumn("decision", F.lit(1)).drop("decision").withColumn("rank", F.lit(5)).withColumn("best", F.lit("x")).withColumn("day", F.lit(0))
    rows = urlfilter.evaluate(captures, spark.createDataFrame(changes, CHANGES)).collect()
    return [(r.decision, r.entry, r.kept) for r in sorted(rows, key=lambda r: r.id)]


def test_entries_count_while_they_are_valid(spark):
    changes = [("block", "bad.com", D[4], "add", 1), ("block", "bad.com", D[9], "remove", 2),
               ("block", "bad.com", D[19], "add", 3)]
    urls = [("http://www.bad.com/x", D[i]) for i in (3, 4, 8, 9, 18, 19, 30)]
    kept = [k for _, _, k in judge(spark, urls, changes)]
    assert kept == [True, False, False, True, True, False, False]
    spans = urlfilter.intervals(spark.createDataFrame(changes, CHANGES)).collect()
    assert sorted((r.valid_from, r.valid_to) for r in spans if r.valid_to) == [(D[4], D[9])]
    assert [r.valid_from for r in spans if r.valid_to is None] == [D[19]]


def test_the_most_specific_entry_decides(spark):
    changes = [("block", "com", D[0], "add", 1), ("allow", "a.com", D[0], "add", 1), ("block", "x.a.com", D[0], "add", 1),
               ("allow", "x.a.com/ok", D[0], "add", 1), ("block", "x.a.com/ok", D[0], "add", 2)]
    urls = [("http://b.com", D[1]), ("http://a.com/", D[1]), ("https://u:p@X.A.com.:8080/no", D[1]),
            ("http://x.a.com/ok?q#f", D[1]), ("http://ya.com", D[1])]
    assert judge(spark, urls, changes) == [
        ("blocked", "com", False), ("allowed", "a.com", True), ("blocked", "x.a.com", False),
        ("allowed", "x.a.com/ok", True), ("blocked", "com", False)]


def test_the_last_change_of_a_day_counts(spark):
    changes = [("block", "a.com", D[3], "add", 9), ("block", "a.com", D[3], "remove", 10),
               ("block", "b.com", D[3], "remove", 1), ("block", "b.com", D[3], "add", 2), ("block", "b.com", D[3], "add", 2)]
    assert [d for d, _, _ in judge(spark, [("http://a.com", D[5]), ("http://b.com", D[5])], changes)] == ["unlisted", "blocked"]


def test_entries_of_any_depth(spark):
    changes = [("block", "a.com/x", D[0], "add", 1), ("allow", "a.com/x/y/z", D[0], "add", 1),
               ("block", "a.com/x/y/z/1/2/3", D[4], "add", 1), ("block", "a.com/x/y/z/1/2/3", D[9], "remove", 2)]
    urls = [("http://a.com/", D[5]), ("http://a.com/x/y?z", D[5]), ("http://a.com/x/y/z/", D[5]), ("http://a.com/x/y/zz", D[5]),
            ("http://a.com/x/y/z/1/2/3/4#f", D[5]), ("http://a.com/x/y/z/1/2/3", D[10]), ("http://a.com//x/y/z", D[5]),
            ("http://a.com/x//y/z", D[5]), ("http://b.com/x/y/z", D[5]), ("http://a.com/" + "s/" * 20000, D[5])]
    assert judge(spark, urls, changes) == [
        ("unlisted", None, True), ("blocked", "a.com/x", False), ("allowed", "a.com/x/y/z", True), ("blocked", "a.com/x", False),
        ("blocked", "a.com/x/y/z/1/2/3", False), ("allowed", "a.com/x/y/z", True), ("unlisted", None, True),
        ("blocked", "a.com/x", False), ("unlisted", None, True), ("unlisted", None, True)]


def test_random_logs_against_brute_force(spark):
    """Every capture against the state of each of its entries, replayed change by change."""
    import random
    rng = random.Random(11)
    names = ["com", "a.com", "x.a.com", "a.com/p", "a.com/p/q", "x.a.com/p/q/r", "b.com"]
    changes = [(rng.choice(["block", "allow"]), rng.choice(names), rng.choice(D), rng.choice(["add", "remove"]), i)
               for i in range(160)]
    urls = [(rng.choice(["http://a.com/p/q/r", "http://x.a.com/p/q/r/s", "http://b.com/p", "http://c.org", "http://a.com"]), d)
            for d in D for _ in range(5)]

    def brute(url, day):
        place = url[7:].split("/")
        labels = place[0].split(".")
        mine = [".".join(labels[-i:]) for i in range(1, len(labels) + 1)]
        mine += ["/".join(place[:i]) for i in range(2, len(place) + 1)]
        best = ("unlisted", None, True)
        for entry in mine:
            on = {}
            for name, e, d, action, _ in sorted(changes, key=lambda c: (c[2], c[4])):
                if e == entry and d <= day:
                    on[name] = action == "add"
            if on.get("allow"):
                best = ("allowed", entry, True)
            elif on.get("block"):
                best = ("blocked", entry, False)
        return best

    assert judge(spark, urls, changes) == [brute(u, d) for u, d in urls]


def test_awkward_rows(spark):
    changes = [("block", None, D[0], "add", 1), ("block", "a.com", None, "add", 1), ("grey", "a.com", D[0], "add", 1),
               ("block", "a.com", D[0], None, 1), (None, "a.com", D[0], "add", 1), ("block", "c.com", D[0], "add", None)]
    urls = [(None, D[1]), ("", D[1]), ("no url", D[1]), ("http:///path", D[1]), ("http://a.com", None),
            ("http://a.com", D[1]), ("http://a.com", D[1]), ("http://c.com", D[1]), ("http://" + "a." * 3000 + "com/" + "x" * 9000, D[1])]
    got = [d for d, _, _ in judge(spark, urls, changes)]
    assert got == ["invalid"] * 4 + ["unlisted"] * 3 + ["blocked", "unlisted"]
    assert judge(spark, [], changes) == []
    assert [d for d, _, _ in judge(spark, urls, [])] == ["invalid"] * 4 + ["unlisted"] * 5


def test_native_plan(spark):
    captures = spark.createDataFrame([(1, "http://a.com", D[1])], "id long, url string, fetch_date date")
    plan = urlfilter.evaluate(captures, spark.createDataFrame([], CHANGES))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Cartesian", "NestedLoop"))
