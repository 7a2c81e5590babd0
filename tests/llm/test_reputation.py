import math

from pyspark.sql import functions as F

from pagemill.llm.reputation import CORRELATION, OP12_SQL, Rule, fit_hosts, judge_urls, op12_url_reputation

from ..oracle import connection, differences

PAGES = "page_id long, url string"


def brute(counts, z=1.645):
    """counts: host -> (n, k); every host is a.b.suffix."""
    name = {"suffix": lambda h: h.split(".")[-1], "domain": lambda h: ".".join(h.split(".")[-2:]), "host": lambda h: h}
    n, k = (sum(c[i] for c in counts.values()) for i in (0, 1))
    mean, weight = {"": (1 + k) / (2 + n)}, {}
    for level, up in (("suffix", None), ("domain", "suffix"), ("host", "domain")):
        groups = {}
        for h, (n, k) in counts.items():
            g = groups.setdefault(name[level](h), [0, 0, mean[name[up](h) if up else ""]])
            g[0] += n
            g[1] += k
        s = sum((k - n * m) ** 2 for n, k, m in groups.values())
        a, b = (sum(n * f(n) * m * (1 - m) for n, k, m in groups.values()) for f in (lambda n: 1, lambda n: n - 1))
        r = min(CORRELATION[1], max(CORRELATION[0], (s - a) / b)) if b else CORRELATION[1]
        c = 1 / r - 1
        mean |= {g: (c * m + k) / (c + n) for g, (n, k, m) in groups.items()}
        weight = {g: c + n for g, (n, k, m) in groups.items()}
    return {h: (mean[h], min(1, mean[h] + z * math.sqrt(mean[h] * (1 - mean[h]) / (weight[h] + 1)))) for h in counts}


def test_posteriors(spark):
    counts = {f"h{i}.d{i % 7}.{'com' if i % 3 else 'net'}": (i * 7 % 23, min(i * 7 % 23, i % 5)) for i in range(60)}
    counts |= {"x.d1.com": (0, 0), "y.new.org": (0, 0)}
    rows = fit_hosts(spark.createDataFrame([(h, *c) for h, c in counts.items()], "host string, n long, k long")).collect()
    want = brute(counts)
    assert len(rows) == len(want)
    for r in rows:
        assert math.isclose(r["share"], want[r["host"]][0], rel_tol=1e-9) and math.isclose(r["upper"], want[r["host"]][1], rel_tol=1e-9)


def verdicts(spark, urls, good=(), rules=(), **more):
    """good: (page_id, good) by place in ``urls``."""
    pages = spark.createDataFrame(list(enumerate(urls)), PAGES)
    outcomes = spark.createDataFrame(list(good), "page_id long, good int")
    return [tuple(r)[1:] for r in judge_urls(pages, outcomes, rules, **more).drop("url").orderBy("page_id").collect()]


def test_bad_hosts_go_and_few_outcomes_do_not_suffice(spark):
    urls = [f"http://{h}.{d}.com/{i}" for h, d, n in (("spam", "farm", 40), ("once", "farm", 1), ("none", "farm", 1), ("a", "fine", 40), ("b", "fine", 40), ("unlucky", "fine", 2)) for i in range(n)]
    good = [(i, int("fine" in u and "unlucky" not in u)) for i, u in enumerate(urls) if "none" not in u]
    got = {u.split("/")[2]: v[-1] for u, v in zip(urls, verdicts(spark, urls, good), strict=True)}
    assert got == {"spam.farm.com": "block", "once.farm.com": "block", "none.farm.com": "block", "a.fine.com": "allow", "b.fine.com": "allow", "unlucky.fine.com": "allow"}


def test_hosts_paths_and_rules(spark):
    rules = (Rule("block", "net", "/"), Rule("allow", "a.net", "/x"), Rule("block", "a.net", "/x/y"), Rule("block", "c", ""))
    cases = {
        "HTTP://WWW.A.net/x?q=/x/y": ("www.a.net", "/x", "a.net/x", "allow"), "http://a.net/x/yz#f": ("a.net", "/x/yz", "a.net/x/y", "block"), "http://ba.net/x": ("ba.net", "/x", "net/", "block"),
        "http://a.net": ("a.net", "", None, "allow"), "http://a.net?x://b.net/": ("a.net", "", None, "allow"), "http://Ä.NET/": ("Ä.net", "/", "net/", "block"), "c": ("", "", None, "allow"), None: ("", "", None, "allow"), "": ("", "", None, "allow"), "://": ("", "", None, "allow"),
        "ftp://u:p@A.net:21/x": ("u:p@a.net:21", "/x", None, "allow"), "http://c#/": ("c", "", "c", "block"), "http://1.2.3.4/\n/": ("1.2.3.4", "/\n/", None, "allow"), "x" * 200_000 + "://net/" + "y" * 200_000: ("net", "/" + "y" * 200_000, "net/", "block"),
    }
    assert verdicts(spark, list(cases), rules=rules) == list(cases.values())


def test_odd_tables(spark):
    columns = "page_id long, url string, host string, verdict int, _n int, `a.b` string"
    pages = spark.createDataFrame([(1, "http://a.com/", "h", 1, 2, "x"), (1, "http://a.com/", "h", 1, 2, "x"), (None, None, None, None, None, None)], columns)
    outcomes = spark.createDataFrame([(1, 1), (1, None), (None, 0), (7, 0)], "page_id long, good int")
    out = judge_urls(pages, outcomes)
    assert out.columns == ["page_id", "url", "_n", "a.b", "host", "path", "rule", "verdict"]
    assert sorted(map(str, (r["host"] for r in out.collect()))) == ["", "a.com", "a.com"]
    assert judge_urls(pages.limit(0), outcomes).count() == 0 and judge_urls(pages, outcomes.limit(0)).count() == 3


def test_one_host_holds_most_pages(spark):
    pages = spark.range(20_000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://"), F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).otherwise("big"), F.lit(".x.com/")).alias("url"))
    out = judge_urls(pages, pages.select("page_id", F.lit(0).alias("good")))
    assert out.where("verdict = 'block'").count() == 20_000


def test_query(spark, sf_dir):
    assert differences(op12_url_reputation(spark, sf_dir), connection(sf_dir), OP12_SQL) is None
