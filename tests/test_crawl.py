import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tidings.operators import domains, fetch, report
from tidings.plans.crawl import crawl
from tidings.sources.captures import latest, save_bucketed
from tidings.sources.seeds import as_seeds, read_seeds

SUFFIXES = ["com", "net", "org", "ru", "test", "uk", "co.uk"]
SITE = {
    "http://a.test/": '<a href="/one">1</a><a href="two?q=1">2</a><a href="#top">t</a><a href="mailto:x@a.test">m</a>'
    '<a href="//m.a.test/mob">m</a><a href="http://b.co.uk/">b</a><a href="/one">again</a> Start page.',
    "http://a.test/one": '<a href="/">home</a><a href="/link/deep">d</a><a href="gone">x</a> Page one.',
    "http://a.test/two?q=1": '<a href="javascript:void(0)">j</a><p></p>',
    "http://a.test/link/deep": '<a href="../one">up</a>',
    "http://m.a.test/mob": "<p>Mobile. 1a 2b</p>",
    "http://b.co.uk/": '<a href="http://c.co.uk/">other</a> British page.',
    "http://c.co.uk/": "Another registered domain.",
}


@pytest.fixture(scope="module")
def captures(spark):
    return spark.createDataFrame(list(SITE.items()), "url string, html string").repartition(4)


@pytest.fixture(scope="module")
def rules(spark):
    return domains.suffix_rules(spark, SUFFIXES)


def seeds_of(spark, *names):
    return as_seeds(spark.createDataFrame([(n,) for n in names], "url string"))


def visited(result):
    return sorted((r.depth, r.url, r.seed_url) for r in result.frontier.collect())


def test_seed_file(spark, tmp_path):
    path = tmp_path / "seeds.txt"
    path.write_text("http://a.test/\n\nhttp://b.co.uk/\n")
    rows = read_seeds(spark, str(path), 3).collect()
    assert sorted(map(tuple, rows)) == [("", "", 0), ("http://a.test/", "http://a.test/", 0), ("http://b.co.uk/", "http://b.co.uk/", 0)]


def test_depth_one_fetches_only_seeds(spark, captures, rules):
    result = crawl(seeds_of(spark, "http://a.test/"), captures, rules, depth=1)
    assert visited(result) == [(0, "http://a.test/", "http://a.test/")]


def test_depth_two_stays_in_the_registered_domain(spark, captures, rules):
    seed = "http://a.test/"
    urls = {u for d, u, _ in visited(crawl(seeds_of(spark, seed), captures, rules, depth=2)) if d == 1}
    assert urls == {"http://a.test/one", "http://a.test/two?q=1", "http://a.test/#top", "http://m.a.test/mob"}
    free = crawl(seeds_of(spark, seed), captures, rules, depth=2, inside_domain=False)
    assert "http://b.co.uk/" in {u for _, u, _ in visited(free)}
    assert all(u.startswith("http") for _, u, _ in visited(free))


def test_memory_of_visited_pages(spark, captures, rules):
    seed = "http://a.test/"
    everything = visited(crawl(seeds_of(spark, seed), captures, rules, depth=4))
    assert len({u for _, u, _ in everything}) == len(everything)
    level = visited(crawl(seeds_of(spark, seed), captures, rules, depth=3, remember="level"))
    assert (2, seed, seed) in level and (0, seed, seed) in level
    with pytest.raises(ValueError):
        crawl(seeds_of(spark, seed), captures, rules, remember="none")


def test_same_page_under_two_seeds_stays_twice(spark, captures, rules):
    result = crawl(seeds_of(spark, "http://a.test/", "http://m.a.test/mob", "http://a.test/one"), captures, rules, depth=2)
    deep = [(d, u, s) for d, u, s in visited(result) if u == "http://a.test/link/deep"]
    assert deep == [(1, "http://a.test/link/deep", "http://a.test/one")]


def test_status_and_content(spark, captures, rules):
    result = crawl(seeds_of(spark, "http://a.test/", "http://a.test/missing"), captures, rules, depth=2)
    counts = fetch.status_counts(fetch.fetch_status(result.frontier, captures), "depth")
    assert sorted(map(tuple, counts.collect())) == [(0, 1, 1), (1, 3, 1)]
    usable = fetch.usable_content(result.content)
    assert "http://a.test/two?q=1" in {r.url for r in usable.collect()}
    texts = {r.url: r.text for r in result.content.collect()}
    assert texts["http://m.a.test/mob"] == "Mobile. 1a 2b"


def test_url_with_link_in_it_is_content_not_a_link(spark, captures, rules):
    found = fetch.captured(seeds_of(spark, "http://a.test/link/deep"), captures)
    assert [tuple(r) for r in fetch.page_links(found).collect()] == [
        ("http://a.test/link/deep", "http://a.test/one", "http://a.test/link/deep")
    ]


def test_report(spark, captures, rules):
    seeds = seeds_of(spark, "http://m.a.test/mob", "http://b.co.uk/", "http://a.test/missing")
    vocab = spark.createDataFrame([("Mobile.",), ("British",)], "token string")
    out = report.crawl_report(
        fetch.page_links(fetch.captured(seeds, captures)), fetch.fetch_status(seeds, captures),
        fetch.page_content(seeds, captures), vocab,
    )
    rows = {r.seed_url: (r.links, r.failed_pct, r.unknown_pct) for r in out.collect()}
    assert rows["http://a.test/missing"] == (0, 100.0, None)
    assert rows["http://b.co.uk/"][:2] == (1, 0.0)
    assert abs(rows["http://m.a.test/mob"][2] - 200 / 3) < 1e-9


def test_registered_domain_rules(spark):
    rules = domains.suffix_rules(spark, ["com", "uk", "co.uk", "*.ck", "!www.ck"])
    cases = {
        "http://a.b.co.uk/x": ("b", "co.uk"), "https://X.Example.COM:8080/": ("example", "com"),
        "http://co.uk/": ("", "co.uk"), "http://shop.any.ck": ("shop", "any.ck"), "http://any.ck": ("", "any.ck"),
        "http://www.ck": ("www", "ck"), "http://a.www.ck": ("www", "ck"), "http://localhost/": ("localhost", ""),
        "http://x.unknown": ("x", "unknown"), "http://10.0.0.1/a": ("10.0.0.1", ""), "http://user@a.com/": ("a", "com"),
        "http://[::1]/": ("[::1]", ""), "http://a.com./": ("a", "com"),
    }
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    rows = domains.with_registered_domain(df, rules).collect()
    assert {r.url: (r.domain, r.suffix) for r in rows} == cases


def test_suffix_file(spark, tmp_path):
    path = tmp_path / "suffixes.dat"
    path.write_text("// comment\ncom\n\nco.uk // note\n*.ck\n!www.ck\n")
    rules = domains.read_suffix_rules(spark, str(path))
    assert rules.depth == 2 and rules.small
    assert {r.base for r in rules.table.collect()} == {"com", "co.uk", "ck", "www.ck"}


def test_plans_prune_and_do_not_move_links(spark, tmp_path, rules):
    path = str(tmp_path / "captures")
    spark.createDataFrame(list(SITE.items()), "url string, html string").write.parquet(path)
    stored = spark.read.parquet(path)
    seeds = as_seeds(stored.select("url"))
    lost = plan_of(fetch.failed(seeds, stored))
    assert "html" not in lost
    content = plan_of(fetch.usable_content(fetch.page_content(seeds, stored)))
    assert "StringStartsWith(url,http)" in content
    links = plan_of(domains.within_domain(stored.select(F.col("url").alias("href"), F.col("url").alias("seed_url")), rules))
    assert "SortMergeJoin" not in links and "CartesianProduct" not in links and "NestedLoop" not in links


def test_bucketed_captures_join_without_moving(spark, captures):
    save_bucketed(captures, "captures_bucketed", 4)
    try:
        stored = spark.table("captures_bucketed")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = fetch.captured(seeds_of(spark, *SITE), stored)
        exchanges = [line for line in plan_of(found).splitlines() if "Exchange" in line]
        assert len(exchanges) == 1  # the frontier moves, the captures stay
        assert found.count() == len(SITE)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE captures_bucketed")


def test_base_element_and_normalised_links(spark):
    page = "<base href='HTTP://CDN.test/dir/'><a href='x y'>1</a><a href='//A.test'>2</a>"
    found = spark.createDataFrame([("http://a.test/p", "http://a.test/p", page)], "url string, seed_url string, html string")
    assert sorted(r.href for r in fetch.page_links(found).collect()) == ["http://a.test/", "http://cdn.test/dir/x%20y"]


def test_latest_capture(spark):
    rows = [("u", "old", 1), ("u", "new", 2), ("v", "a", None), ("v", "b", None), ("v", "b", None), ("w", None, 3)]
    df = spark.createDataFrame(rows, "url string, html string, at int")
    assert sorted(map(tuple, latest(df, "at").collect())) == [("u", "new", 2), ("v", "b", None), ("w", None, 3)]


def domain_of(spark, rules, *urls):
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    rows = {r.url: (r.domain, r.suffix) for r in domains.with_registered_domain(df, rules).collect()}
    return [rows[u] for u in urls]


@pytest.mark.parametrize("small", [True, False])
def test_unknown_suffixes_follow_the_default_rule(spark, small):
    rules = domains.suffix_rules(spark, ["com", "рф", "*.ck", "!www.ck", "co.uk", "uk"])._replace(small=small)
    found = domain_of(spark, rules, "http://a.io/", "http://x.b.io/", "http://localhost/", "http://10.0.0.1/", "http://m.xn--d1acpjx3f.xn--p1ai/",
                      "http://m.пример.рф/", "http://a.b.ck/", "http://www.ck/", "http://x.co.uk/", "http://co.uk/")
    assert found == [("a", "io"), ("b", "io"), ("localhost", ""), ("10.0.0.1", ""), ("xn--d1acpjx3f", "xn--p1ai"), ("пример", "рф"),
                     ("a", "b.ck"), ("www", "ck"), ("x", "co.uk"), ("", "co.uk")]
    links = spark.createDataFrame([("http://a.io/", "http://b.io/"), ("http://m.a.io/", "http://a.io/"), ("http://x.com.br/", "http://y.com.br/")], "href string, seed_url string")
    kept = {r.href for r in domains.within_domain(links, rules).collect()}
    assert "http://a.io/" not in kept and "http://m.a.io/" in kept


@pytest.mark.parametrize("small", [True, False])
def test_rules_of_many_labels_and_both_forms_of_a_name(spark, small):
    rules = domains.suffix_rules(spark, ["com", "br", "com.br", "d.e.f.g.h", "h", "*.kawasaki.jp", "!city.kawasaki.jp", "jp", "москва"])._replace(small=small)
    pairs = [
        ("http://x.com.br/", "x", "com.br"), ("http://y.com.br/", "y", "com.br"), ("http://a.b.c.d.e.f.g.h/", "c", "d.e.f.g.h"), ("http://e.f.g.h/", "g", "h"),
        ("http://a.b.kawasaki.jp/", "a", "b.kawasaki.jp"), ("http://b.kawasaki.jp/", "", "b.kawasaki.jp"), ("http://w.city.kawasaki.jp/", "city", "kawasaki.jp"),
        ("http://kawasaki.jp/", "kawasaki", "jp"), ("http://сайт.москва/", "сайт", "москва"), ("http://a.xn--80adxhks/", "a", "xn--80adxhks"), ("http://10.0.0.1/", "10.0.0.1", ""),
        ("http://single/", "single", ""), ("http://a.unknown/", "a", "unknown"),
    ]
    rows = domains.with_registered_domain(spark.createDataFrame([(u,) for u, _, _ in pairs], "url string"), rules)
    assert {r.url: (r.domain, r.suffix) for r in rows.collect()} == {u: (d, s) for u, d, s in pairs}
    links = spark.createDataFrame([("http://x.com.br/a", "http://y.com.br/"), ("http://w.x.com.br/a", "http://x.com.br/")], "href string, seed_url string")
    assert [r.href for r in domains.within_domain(links, rules).collect()] == ["http://w.x.com.br/a"]
    if small:
        assert "Join" not in plan_of(domains.within_domain(links, rules))


def test_counters_while_writing_equal_the_join(spark, captures, rules):
    seeds = seeds_of(spark, "http://a.test/", "http://b.co.uk/", "http://gone.test/")
    counted = crawl(seeds, captures, rules, depth=3, counted=True)
    plain = crawl(seeds, captures, rules, depth=3)
    joined = fetch.status_counts(fetch.fetch_status(plain.frontier, captures), "depth").collect()
    assert counted.counts == sorted((r.depth, r.pages_ok, r.pages_failed) for r in joined)
    rows = lambda c: sorted((r.depth, r.url, r.text) for r in c.content.collect())
    assert rows(counted) == rows(plain)
    none = crawl(seeds.limit(0), captures, rules, depth=2, counted=True)
    assert none.counts == [(0, 0, 0), (1, 0, 0)]
    assert "Join" not in plan_of(counted.content)  # stored: the counters cost no further plan
