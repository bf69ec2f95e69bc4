import re
import time

from fileledger.llm import url_rules as U
from fileledger.llm.queries import _re2

URLS = [
    "http://a.net/x", "http://a.net", "https://example.net/en/1", "https://example.net/en", "https://m.example.net/en/?q", "http://EXAMPLE.com/de/2", "http://example.com/DE/2", "http://x.org/fr/", "http://notexample.com/de/",
    "http://spam-farm.example.org/x", "http://www.cheap-pills.example.com/en/", "http://cheap-pills.example.net/en/x", "ftp://h?x=://y/z", "no scheme/net/", "", None, "://", "http:///net/", "http://net/#f", "http://a.b/wp-login.php", "http://a.b/free-download-now/crack",
    "http://pornography.example.edu/", "http://ads.example.edu/", "http://loads.example.edu/", "http://a.net:80/x", "http://xn--e.net/é?ü", "http://a.b/WP-LOGIN.PHP?x", "http://a.casino", "http://a.casinos",
]


def split(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def verdict(url):
    host, path = split(url)
    fits = []
    for rule, action in U.SITE_RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), rule, action))
    if fits:
        return max(fits)[1:]
    return None, "block" if any(re.search(_re2(p), host + path) for p, _ in U.GENERIC_RULES) else "allow"


def rules(spark):
    return U.rule_table(spark, U.GENERIC_RULES, False).unionByName(U.rule_table(spark, U.SITE_RULES, True, 1))


def test_against_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    got = {r.page_id: r for r in U.judge_urls(df, rules(spark)).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        rule = got[i].rule if got[i]["class"] == 1 else None
        assert (got[i].host, got[i].path) == split(url), url
        assert (rule, got[i].verdict) == verdict(url), url


def test_tokens_are_whole_in_every_match(spark):
    df = rules(spark).select("pattern", U.literal_tokens(U.F.col("pattern")).alias("t"))
    got = {r.pattern: r.t for r in df.collect()}
    assert got["||net/"] == ["net"] and got["||example.net/en/"] == ["example", "net", "en"]
    assert got["||porn"] == [] and got["-pills."] == ["pills"] and got["free-download*crack"] == [] and got["spam-farm."] == ["farm"]


def test_null_urls_meet_rules_of_the_empty_text(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "http://a.b/")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in U.judge_urls(df, U.rule_table(spark, [("*", "block")], False)).collect()}
    assert got == {1: "block", 2: "block", 3: "block"}


def test_thousands_of_rules(spark):
    names = [f"{a}{b}" for a in ("ads", "shop", "news", "blog", "x") for b in range(400)]
    made = [(f"||{n}.com^", "block") if i % 3 else (f"/{n}/*/{i % 7}^", "allow") for i, n in enumerate(names)] + [(f"{n}-{i % 11}.", "block") for i, n in enumerate(names[:500])]
    urls = [f"https://{'www.' if i % 2 else ''}{n}.com/{names[i * 31 % len(names)]}/q/{i % 9}" for i, n in enumerate(names[::5])] + [f"http://pre{n}-{i % 11}.org/" for i, n in enumerate(names[::9])]
    got = {r.page_id: (r.rule, r.verdict) for r in U.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), U.rule_table(spark, made, False)).collect()}
    tests = [(re.compile(_re2(p)), p, a) for p, a in made]
    hits = 0
    for i, u in enumerate(urls):
        fits = [(len(p), p, a) for x, p, a in tests if x.search("".join(split(u)))]
        hits += bool(fits)
        assert got[i] == (max(fits)[1:] if fits else (None, "allow")), u
    assert hits > 100


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, "http://a.net/", 5), (1, "http://a.net/", 5), (None, "http://a.net/", 5), (2, None, 5), (3, "http://h/" + "a-" * 100_000, 5)], "page_id long, url string, token int")
    out = U.judge_urls(df, rules(spark))
    assert sorted((r.page_id or 0, r.verdict) for r in out.collect()) == [(0, "block"), (1, "block"), (1, "block"), (2, "allow"), (3, "allow")]
    assert U.judge_urls(df.limit(0), rules(spark)).count() == 0
    assert {r.verdict for r in U.judge_urls(df, rules(spark).limit(0), default="none").collect()} == {"none"}
    twice = rules(spark).unionByName(rules(spark)).selectExpr("*", "1 as urls").unionByName(rules(spark).selectExpr("cast(null as string) pattern", "rule", "action", "class", "rank", "1 as urls"))
    assert U.judge_urls(df, twice).count() == 5


def test_long_urls_take_no_long_time(spark):
    began = time.time()
    df = spark.createDataFrame([(1, "http://" + "a." * 20_000 + "com/" + "b/" * 20_000)], "page_id long, url string")
    U.judge_urls(df, rules(spark)).collect()
    assert time.time() - began < 60
