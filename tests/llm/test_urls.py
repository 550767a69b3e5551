import itertools

from tablecraft.llm import urls
from tablecraft.llm.queries import URL_RULES


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i, c in enumerate(rest) if c in "/?#"], default=len(rest))
    path = rest[cut:]
    end = min([i for i, c in enumerate(path) if c in "?#"], default=len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), path[:end]


def plain_rule(host, path):
    fits = [(len(h + p), v == "block", h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


def pages(spark):
    made = [f"{s}://{h}{p}" for s, h, p in itertools.product(
        ("http", "HTTPS"), ("example.org", "a.Example.ORG", "org", "xorg", "b.com", "net", "example.org:80", "ÉX.com"),
        ("", "/", "/es/1", "/en/12", "/en/2", "/fr/", "/de/x", "?a=/fr/", "#/de/", "/fr"))]
    made += [None, "", "no scheme", "a://b://c/d", "://", "http://", "x\n://org/a\nb?c"]
    rows = [(i, u) for i, u in enumerate(made)] + [(0, made[0]), (None, "http://z.net/en/")]
    return spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 AS host", "2 AS path", "3 AS rule", "4 AS text")


def test_rules(spark):
    table = pages(spark)
    got = urls.judge(table, URL_RULES).collect()
    assert len(got) == table.count()
    want = {(r.page_id, *plain(r.url), *plain_rule(*plain(r.url))) for r in table.collect()}
    for r in got:
        assert any(w[:4] == (r.page_id, r.host, r.path, r.rule) and w[4] in (None, r.verdict) for w in want), r
    assert {r.verdict for r in got} == {"allow", "block"}


def test_models_tell_unseen_urls_apart(spark):
    rows = [(i, f"http://h{i}.com/{'fr' if i % 2 else 'de'}/{'bon' if i % 2 else 'gut'}{i % 50}") for i in range(400)]
    rows += [(1000 + i, f"http://w{i}.net/x/{'bon' if i % 2 else 'gut'}{i}") for i in range(100)]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), URL_RULES).filter("page_id >= 1000").collect()
    assert sum((r.verdict == "allow") == bool(r.page_id % 2) for r in got) >= 95


def test_one_class_and_empty(spark):
    schema = "page_id long, url string"
    assert urls.judge(spark.createDataFrame([], schema), URL_RULES).count() == 0
    assert [r.verdict for r in urls.judge(spark.createDataFrame([(1, "http://a.net/")], schema), URL_RULES).collect()] == ["allow"]


def test_model_is_a_distribution():
    model = urls.Markov(["abc", "abd", "xyz"])
    alphabet = set("abcdxyz\x03")
    rest = (0x110000 - len(alphabet)) * model.chance("ab", "\u1234")
    assert abs(sum(model.chance("ab", c) for c in alphabet) + rest - 1) < 1e-9


def test_a_url_inside_a_url_is_judged_with_its_host(spark):
    """The words that tell apart stand before the inner URL, which is the same for all."""
    rows = [(i, f"http://h{i}.com/{'fr' if i % 2 else 'de'}/{'bonjour' if i % 2 else 'gutentag'}?u=http://same.io/") for i in range(300)]
    rows += [(1000 + i, f"https://w.net/{'bonjour' if i % 2 else 'gutentag'}?u=http://same.io/\n{i}") for i in range(60)]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), URL_RULES).filter("page_id >= 1000").collect()
    assert sum((r.verdict == "allow") == bool(r.page_id % 2) for r in got) >= 57
