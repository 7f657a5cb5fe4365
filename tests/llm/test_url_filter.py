import pytest
from pyspark.sql import functions as F

from idweave.llm import url_filter as u
from idweave.llm.queries import URL_RULES

URLS = ["http://a.example.org/es/1", "http://EXAMPLE.org/en/12?x", "http://example.org", "https://x.org#f", None, "",
        "no scheme/x.org/", "http://notexample.com/de/", "http://b.com/fr/x", "http://com/de/1", "http://x.org:80/a",
        "://q.net/a//b", "http://É.org/a", "http://u@h.org/", "http://h.net/" + "a/" * 5000, "http://h.net/a\nb",
        "http://h.net/?://x.com/de/"]


def test_parts_and_rules(spark):
    pages = spark.createDataFrame([(k, x, "n", 1) for k, x in enumerate(URLS)],
                                  "page_id long, url string, rule string, n int")
    rows = {r.page_id: r for r in u.url_filter(pages, URL_RULES).collect()}
    assert len(rows) == len(URLS)
    got = [(rows[k].host, rows[k].rule, rows[k].verdict) for k in range(14)]
    assert got == [("a.example.org", "example.org/es/", "block"), ("example.org", "example.org/en/1", "block"),
                   ("example.org", None, "allow"), ("x.org", None, "allow"), ("", None, "allow"), ("", None, "allow"),
                   ("", None, "allow"), ("notexample.com", "com/de/", "block"), ("b.com", "com/fr/", "allow"),
                   ("com", "com/de/", "block"), ("x.org:80", None, "allow"), ("q.net", None, "allow"),
                   ("É.org", "org/", "allow"), ("u@h.org", "org/", "allow")]
    assert rows[1].path == "/en/12" and rows[2].path == "" and rows[11].path == "/a//b"
    assert rows[14].path == "/" + "a/" * 5000 and rows[15].path == "/a\nb" and rows[16].path == "/"


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(k, f"http://h{k % 2}.net/shop/{k}.html", True) for k in range(300)]
    rows += [(300 + k, f"http://h{k % 2}.net/news/{k}/{k * 7}", False) for k in range(300)]
    rows += [(600 + k, f"http://h0.net/shop/new-{k}.html", None) for k in range(40)]
    rows += [(700 + k, f"http://h0.net/news/new-{k}/{k * 11}", None) for k in range(40)]
    return spark.createDataFrame(rows, "page_id long, url string, bad boolean")


def test_templates_are_rejected_by_purity(labelled):
    out = u.url_filter(labelled, [], bad_col="bad").where("page_id >= 600")
    got = {(r.template, r.verdict) for r in out.select("template", "verdict").distinct().collect()}
    assert got == {("/shop/*.html", "block"), ("/news/*/*", "allow")}


def test_similar_branches_merge(spark):
    rows = [(k, f"http://h.net/{'abcd'[k % 4]}/{k}", k % 3 == 0) for k in range(400)]
    rows += [(400 + k, f"http://h.net/z/{k}", True) for k in range(100)]
    out = u.url_filter(spark.createDataFrame(rows, "page_id long, url string, bad boolean"), [], bad_col="bad")
    found = {r.template: r.verdict for r in out.select("template", "verdict").distinct().collect()}
    assert found == {"/a|b|c|d/*": "allow", "/z/*": "block"}


def test_nothing_labelled_and_empty(labelled, spark):
    assert u.url_filter(labelled.drop("bad"), []).where("verdict = 'block'").count() == 0
    assert u.url_filter(labelled.where("false"), URL_RULES).count() == 0


def test_no_python_in_the_plan(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").withColumn("x", F.lit(1))
    plan = u.url_filter(pages, URL_RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_segments_of_any_depth_tell_branches_apart(spark):
    rows = [(k, f"http://h.net/a/b/c/d/e/f/g/{('bad', 'good')[k % 2]}/{k}", k % 2 == 0) for k in range(400)]
    out = u.url_filter(spark.createDataFrame(rows, "page_id long, url string, bad boolean"), [], bad_col="bad")
    found = {r.template: r.verdict for r in out.select("template", "verdict").distinct().collect()}
    assert found == {"/a/b/c/d/e/f/g/bad/*": "block", "/a/b/c/d/e/f/g/good/*": "allow"}


def verdicts(spark, rows):
    out = u.url_filter(spark.createDataFrame(rows, "page_id long, url string, bad boolean"), [], bad_col="bad")
    return {(r.host, r.path): r.verdict for r in out.collect()}


def test_merged_branches_are_not_mistaken_for_a_literal_name(spark):
    rows = [(k, f"http://h.net/{'ab'[k % 2]}/{k}", True) for k in range(400)]
    rows += [(400 + k, f"http://h.net/a|b/{k}", False) for k in range(400)]
    got = verdicts(spark, rows)
    assert {got["h.net", f"/{'ab'[k % 2]}/{k}"] for k in range(400)} == {"block"}
    assert {got["h.net", f"/a|b/{k}"] for k in range(400)} == {"allow"}


def test_a_literal_star_is_no_wildcard(spark):
    rows = [(k, f"http://h.net/x/*/{k}", False) for k in range(300)]
    rows += [(300 + k, f"http://h.net/x/v{k}/{k}", True) for k in range(300)]
    got = verdicts(spark, rows)
    assert {got["h.net", f"/x/*/{k}"] for k in range(300)} == {"allow"}
    assert {got["h.net", f"/x/v{k}/{k}"] for k in range(300)} == {"block"}


def test_null_and_repeated_ids_are_kept(spark):
    rows = [(None, "http://h.net/a/1", True), (None, "http://h.net/a/1", True), (7, "http://h.net/a/2", None), (7, None, None)]
    out = u.url_filter(spark.createDataFrame(rows, "page_id long, url string, bad boolean"), [], bad_col="bad")
    assert sorted(((r.page_id, r.host) for r in out.collect()), key=repr) == [(7, ""), (7, "h.net"), (None, "h.net"), (None, "h.net")]


def test_the_sql_reads_deep_paths_too(spark):
    import duckdb

    paths = [f"/a/b/c/d/e/f/g/{('de', 'fr')[k % 2]}/{k}" for k in range(60)] + [f"/{'de' if k % 2 else '*'}/{k}" for k in range(60)]
    rows = [(k, f"http://x.com{p}") for k, p in enumerate(paths)] + [(900 + k, f"http://y.net/a|b/{k}") for k in range(9)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = sorted(tuple(r) for r in u.url_filter(pages, URL_RULES).select(
        "page_id", "host", "path", F.coalesce("rule", F.lit("")), "verdict", "template").collect())
    con = duckdb.connect()
    frame = pages.toPandas()
    con.register("pages", frame)
    want = con.sql(u.oracle(URL_RULES)).fetchall()
    assert got == sorted((*r[:3], r[3] or "", *r[4:]) for r in want)


def test_branches_below_the_first_segment_merge(spark):
    rows = [(k, f"http://h.net/shop/s{k % 5}/{k}.html", True) for k in range(200)]
    rows += [(200 + k, f"http://h.net/news/{k % 4}/x/{k}", False) for k in range(400)]
    out = u.url_filter(spark.createDataFrame(rows, "page_id long, url string, bad boolean"), [], bad_col="bad")
    found = {(r.template, r.verdict) for r in out.select("template", "verdict").distinct().collect()}
    assert found == {("/shop/s0|s1|s2|s3|s4/*.html", "block"), ("/news/0|1|2|3/x/*", "allow")}


def test_segments_are_counted_below_their_parent(spark):
    # "new" is frequent below /shop, a single article below /news
    rows = [(k, f"http://h.net/shop/{('new', 'old')[k % 2]}/{k}", k % 2 == 0) for k in range(200)]
    rows += [(200 + k, f"http://h.net/news/{'new' if k == 0 else k}/{k}", False) for k in range(300)]
    rows += [(600 + k, f"http://h.net/news/{k}/comments", True) for k in range(300)]
    out = u.url_filter(spark.createDataFrame(rows, "page_id long, url string, bad boolean"), [], bad_col="bad")
    found = {(r.template, r.verdict) for r in out.select("template", "verdict").distinct().collect()}
    assert found == {("/shop/new/*", "block"), ("/shop/old/*", "allow"), ("/news/*/*", "allow"),
                     ("/news/*/comments", "block")}


def test_random_trees_against_the_sql(spark):
    import random

    import duckdb

    draw = random.Random(4)
    pages = []
    for k in range(1500):
        parts = [draw.choice(["de", "fr", "a", "b", "x|y", "*", "", f"v{draw.randrange(60)}"])
                 for _ in range(draw.randrange(6))]
        pages.append((k, f"http://{draw.choice('pqr')}.com/" + "/".join([*parts, f"{k}{draw.choice(['', '.html'])}"])))
    frame = spark.createDataFrame(pages, "page_id long, url string")
    rules = [("com", "/de/", "block"), ("com", "/fr/", "allow"), ("p.com", "/a/b", "block"), ("q.com", "/b/", "block"), ("com", "/a/v", "allow")]
    got = sorted(tuple(r) for r in u.url_filter(frame, rules).select("page_id", "verdict", "template").collect())
    con = duckdb.connect()
    con.register("pages", frame.toPandas())
    assert got == sorted(con.sql(f"SELECT page_id, verdict, template FROM ({u.oracle(rules)})").fetchall())
    assert len({t for _, _, t in got}) > 50 and any("|" in t.split("/")[-2] for _, _, t in got if t.count("/") > 2)
