"""The URL filter against rules and sums written out one by one."""

import numpy as np
import pytest

from marinelake.llm.urls import ALLOW, BLOCK, BUCKETS, GRAMS, RULES, UNIT, UrlModel, filter_urls, labelled_urls, learn_urls, op13_url_filter

SF = "/root/testdata/sf0.01"
MASK = (1 << 64) - 1


def mixed(x):
    for _ in range(2):
        x = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & MASK
    return x ^ (x >> 32)


def buckets(text, salt):
    marked = [0, *(b + 1 for b in text.encode()), 0]
    out = []
    for size in GRAMS:
        for i in range(len(marked) - size + 1):
            code = salt * 64 + size
            for b in marked[i : i + size]:
                code = mixed((code + b) & MASK)
            out.append(code % BUCKETS)
    return out


def brute(url, model):
    host = path = ""
    if url is not None and "://" in url:
        rest = url[url.index("://") + 3 :]
        cut = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
        host, tail = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = tail[: min([tail.index(c) for c in "?#" if c in tail] + [len(tail)])]
    fit = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fit)[1:] if fit else (None, None)
    score = model.constant / UNIT
    for salt, text in enumerate((host, path)):
        own = buckets(text, salt)
        score += sum(int(model.weights[b]) for b in own) / np.sqrt(len(own)) / UNIT
    return host, path, rule, verdict or (BLOCK if score > 0 else ALLOW), score


@pytest.fixture(scope="module")
def model(spark):
    return learn_urls(labelled_urls(spark))


def check(spark, model, urls):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id bigint, url string, rule string")
    got = {r["page_id"]: r for r in filter_urls(df.repartition(3), model).collect()}
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        host, path, rule, verdict, score = brute(url, model)
        r = got[i]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict), url
        assert r["score"] == pytest.approx(score, abs=1e-9)
    return got


def test_against_plain_sums(spark, model):
    check(spark, model, [
        None, "", "no scheme/en/", "://", "http://", "http:///path", "a://b://c/d", "HTTP://ÉX.Example.NET/En/x", "http://net", "http://net/",
        "http://a.net?x=/", "http://a.net#/", "http://example.net/en/1", "http://xexample.net/en/1", "http://b.example.net/en", "https://a.b.example.com/de/",
        "http://org/fr/?q", "http://x.org/fr/a#b", "http://x.org/FR/a", "http://a.com/x\ny?z\nw", "ftp://u:p@Host.ORG:21/fr/é", "http://日本.example/道",
        "http://" + "sub." * 4000 + "com/" + "p/" * 9000, "http://a.com/" + "%20" * 3,
    ])


def test_whole_table(spark):
    model = learn_urls(labelled_urls(spark))
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r["page_id"]: r for r in op13_url_filter(spark, SF).collect()}
    assert len(got) == len(pages)
    for page in pages:
        assert tuple(got[page["page_id"]])[1:5] == brute(page["url"], model)[:4]


def test_verdicts(spark, model):
    wanted = {"https://casino-bonus.example.com/en/1": BLOCK, "http://www.free-spins.com/": BLOCK, "http://poker-online.com/en/77.html": BLOCK,
              "http://www.city-library.com/en/77.html": ALLOW, "http://museum.example.com/fr/1": ALLOW, "http://blog.weather.com/2024/3": ALLOW,
              "http://files.example.com/viagra/": BLOCK, None: ALLOW, "mailto:someone": ALLOW}
    got = check(spark, model, list(wanted))
    assert [got[i]["verdict"] for i in range(len(wanted))] == list(wanted.values())


def test_fit(spark, model):
    rows = labelled_urls(spark).collect()
    df = spark.createDataFrame([(i, r["url"]) for i, r in enumerate(rows)], "page_id bigint, url string")
    got = {r["page_id"]: r["score"] > 0 for r in filter_urls(df, model, rules=()).collect()}
    assert np.mean([got[i] == r["blocked"] for i, r in enumerate(rows)]) > 0.97
    again = learn_urls(labelled_urls(spark).repartition(7))
    assert (again.weights == model.weights).all() and again.constant == model.constant


def test_few_labels_and_odd_rows(spark):
    schema = "page_id bigint, url string, blocked boolean, text string, score int"
    df = spark.createDataFrame([(1, "http://a.com/x", True, None, 1), (1, "http://a.com/x", True, None, 1), (None, None, None, None, None), (2, "", None, "b", 2)], schema)
    for labels, says in ((df, BLOCK), (df.limit(0), ALLOW), (df.where("blocked is null"), ALLOW)):
        model = learn_urls(labels)
        assert isinstance(model, UrlModel)
        rows = filter_urls(df, model).collect()
        assert len(rows) == 4 and {r["verdict"] for r in rows} == {says}
    assert filter_urls(df.limit(0), learn_urls(df)).collect() == []
