from pyspark.sql import functions as F

from lodestrata.llm import reputation as R


def judge(spark, *urls, **options):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in R.judge(df, **options).collect()}


def test_parts_and_rules(spark):
    got = judge(
        spark,
        "http://A.Example.ORG/es/1?x", "https://example.org/en/12", "https://notexample.org/en/12", "HTTP://x.com/fr/", "http://x.com/de/#t", "http://com/de/a://b", "x.com/de/", None, "",
        "ftp://h.net:80?q=/a", "://k.net/p", "http://u.example.org", "http://İ.example.org/es/", "a://b\nc.org/x\ny",
    )
    assert [g[:3] for _, g in sorted(got.items())] == [
        ("a.example.org", "/es/1", "example.org/es/"), ("example.org", "/en/12", "example.org/en/1"), ("notexample.org", "/en/12", "org/"), ("x.com", "/fr/", "com/fr/"), ("x.com", "/de/", "com/de/"),
        ("com", "/de/a://b", "com/de/"), ("", "", None), ("", "", None), ("", "", None), ("h.net:80", "", None), ("k.net", "/p", None), ("u.example.org", "", None), ("İ.example.org", "/es/", "example.org/es/"), ("b\nc.org", "/x\ny", "org/"),
    ]
    assert got[0][3] == "block" and got[2][3] == "allow" and got[4][3] == "block"


def test_reputation_shrinks_by_level(spark):
    bad = [f"http://bad{i}.spam.net/x/{k}" for i in range(3) for k in range(20)]
    good = [f"http://g{i}.fine.net/y/{k}" for i in range(3) for k in range(20)]
    rules = (R.Rule("net", "/x/", "block"), R.Rule("net", "/y/", "allow"))
    got = judge(spark, *bad, *good, "http://bad0.spam.net/other", "http://new.spam.net/other", "http://g1.fine.net/other", "http://new.fine.net/", "http://new.else.net/", rules=rules)
    n = len(bad) + len(good)
    assert [got[n + k][3] for k in range(5)] == ["block", "block", "allow", "allow", "allow"]


def test_bounds_against_plain_python(spark):
    hosts = [("a.x.net", 10, 9), ("b.x.net", 2, 2), ("c.x.net", 0, 0), ("d.y.net", 30, 1), ("e.z.com:8", 5, 5), ("", 0, 0), ("f", 1, 0)]

    def strength(groups):
        groups = [g for g in groups if g[0]]
        a = sum(n * (k / n - m) ** 2 for n, k, m in groups)
        b = sum(m * (1 - m) for *_, m in groups)
        c = sum((n - 1) * m * (1 - m) for n, _, m in groups)
        return 1 / min(0.99, max(0.01, (a - b) / c if c else 0.5)) - 1

    level = {}
    for h, n, k in hosts:
        bare = h.split(":")[0].split(".")
        for key in (("s", bare[-1]), ("d", bare[-1], ".".join(bare[-2:]))):
            a, b = level.get(key, (0, 0))
            level[key] = (a + n, b + k)
    root = (sum(k for *_, k in hosts) + 0.5) / (sum(n for _, n, _ in hosts) + 1)
    suffixes = {k[1]: v for k, v in level.items() if k[0] == "s"}
    s = strength([(n, k, root) for n, k in suffixes.values()])
    m_s = {x: (k + s * root) / (n + s) for x, (n, k) in suffixes.items()}
    domains = {k[1:]: v for k, v in level.items() if k[0] == "d"}
    s = strength([(n, k, m_s[x[0]]) for x, (n, k) in domains.items()])
    m_d = {x: (k + s * m_s[x[0]]) / (n + s) for x, (n, k) in domains.items()}
    of = lambda h: m_d[(h.split(":")[0].split(".")[-1], ".".join(h.split(":")[0].split(".")[-2:]))]
    s = strength([(n, k, of(h)) for h, n, k in hosts])
    want = {}
    for h, n, k in hosts:
        a, b = k + s * of(h), n - k + s * (1 - of(h))
        want[h] = a / (a + b) - R.Z * (a * b / ((a + b) ** 2 * (a + b + 1))) ** 0.5
    got = {r.host: r.bound for r in R.reputations(spark.createDataFrame(hosts, "host string, n long, k long")).collect()}
    assert {h: round(x, 9) for h, x in got.items()} == {h: round(x, 9) for h, x in want.items()}


def test_empty_and_repeated(spark):
    assert judge(spark) == {}
    df = spark.createDataFrame([(1, "http://x.org/"), (1, "http://x.org/"), (None, None)], "page_id long, url string")
    assert R.judge(df).count() == 3
    assert R.judge(df.where(F.col("page_id").isNull())).first().verdict == "allow"
