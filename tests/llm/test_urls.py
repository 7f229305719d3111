import random

from pyspark.sql import functions as F

from moodlens.llm import url_filter as U


def plain(url, rules=U.RULES):
    """(host, path, rule, verdict of the rule), by the contract."""
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path] + [len(path)])]
    fits = [(h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda r: len(r[0])) if fits else (None, None)
    return host, path, rule, verdict


ODD = ["http://Example.COM/en/1", "https://www.example.com/en/x?y=/fr/", "http://a.www.example.com/en/", "http://notexample.com/en/1", "http://example.com", "http://example.com?x=/", "http://example.com#/en/",
       "ftp://x.net/es/", "x.net/es/", "http://net/fr/1", "http://evilnet/fr/1", "a://b://c.com/", "http://x.org/?u=http://y.com/", "", None, "://", "http:///en/", "http://ÄÉ.com/", "http://a.com:80/x", "HTTP://X.NET/ES/", "http://x.net/es",
       "http://x.com/a\nb", "http://x.org/" + "a%20" * 100_000 + "?" + "&".join("p=1" for _ in range(1000))]


def table(spark, urls):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for c in ("host", "path", "rule", "label", "score", "features", "n", "last"):
        df = df.withColumn(c, F.lit("x"))
    return df


def test_rules_and_odd_urls(spark):
    rows = {r.page_id: r for r in U.url_verdicts(table(spark, ODD), trees=2).collect()}
    for i, url in enumerate(ODD):
        host, path, rule, verdict = plain(url)
        r = rows[i]
        assert (r.host, r.path, r.rule) == (host, path, rule), url
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
        assert 0 <= r.score <= 1
    assert U.url_verdicts(table(spark, ODD).limit(0)).count() == 0
    twice = table(spark, ODD[:3] * 2).withColumn("page_id", F.lit(None).cast("long"))
    assert U.url_verdicts(twice, trees=2).count() == 6


def test_one_kind_of_label_or_none(spark):
    urls = ["http://a.org/x", "http://b.org/y", None]
    assert {r.verdict for r in U.url_verdicts(table(spark, urls)).collect()} == {"allow"}
    assert {r.verdict for r in U.url_verdicts(table(spark, urls + ["http://x.net/es/1"])).collect()} == {"block"}
    assert {r.rule for r in U.url_verdicts(table(spark, urls), rules=()).collect()} == {None}


def test_trees_learn_lexical_features(spark):
    """Held-out rows of a task whose labels follow digits, parameters and the suffix."""
    rng = random.Random(3)
    urls, labels = [], []
    for i in range(1500):
        bad = rng.random() < 0.4
        host = "".join(rng.choices("abcdefgh0123456789-" if bad else "abcdefgh", k=rng.randint(5, 14))) + (".bad.example" if bad and rng.random() < 0.8 else ".fine.example")
        query = "?" + "&".join(f"p{j}={rng.random()}" for j in range(rng.randint(2, 6) if bad else rng.randint(0, 2)))
        urls.append(f"http://{host}/{'/'.join(rng.choices(['a', 'news', 'x1'], k=3))}{query}")
        labels.append(int(bad))
    rows = spark.createDataFrame([(i, u, y) for i, (u, y) in enumerate(zip(urls, labels))], "page_id long, url string, label int")
    rows = U.with_rules(rows, ())
    model = U.UrlModel(rows.where("page_id % 3 <> 0"), 10_000, 10, 3)
    scored = model.score(rows.where("page_id % 3 = 0")).collect()
    assert sum((r.score > 0.5) == (r.label == 1) for r in scored) / len(scored) >= 0.95


def test_verdicts_of_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    urls = {r.page_id: r.url for r in pages.collect()}
    rows = U.url_verdicts(pages).collect()
    assert sorted(r.page_id for r in rows) == sorted(urls)
    for r in rows:
        host, path, rule, verdict = plain(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and (verdict is None or r.verdict == verdict)


def test_every_labelled_url_counts(spark):
    """More labelled URLs than a task holds: suffixes and trees know them all."""
    rows = spark.createDataFrame([(i, f"http://h{i}.example/{'a' if i % 2 else 'b1'}", i % 2) for i in range(300)], "page_id long, url string, label int")
    model = U.UrlModel(U.with_rules(rows, ()), 100, 2, 2)
    assert model.rows == 300 and model.stats["last"].first()["n"] == 300 and model.stats["last_two"].count() == 300
