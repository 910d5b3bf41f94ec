import random

import duckdb
import pytest
from lakeloom.llm import url_filter as u

URLS = [None, "", "nourl", "http://", "http://ORG/x", "http://a.org", "http://example.org/es/", "https://www.Example.org/es/a?b",
        "http://example.org/en/12", "http://example.org/ES/1", "http://notexample.org/es/1", "http://x.com/fr/", "http://x.com/de/1#q",
        "http://com/de/", "http://com.net/de/", "http://e.com?x=/de/", "a b://h.com/de/://org/x", "http://spam-farm.net/a",
        "http://m.spam-farm.net/a", "http://notspam-farm.net/a", "http://h.net/spam-farm.net", "http://x.net/cgi-bin/q",
        "http://x.net/WP-login.php", "http://x.net/wp-login.phpx", "http://casino777.net/", "https://m.casino-x.gov.uk/", "https://a.gov/login?x", "http://x.de/feed/", "http://x.de/feed/a", r"http://x.de/a\zb", "http://a.net/?phpsessid=1", "http://é.org/"]


def test_equals_sql(spark, sf_dir):
    got = u.op1_url_filters(spark, sf_dir).collect()
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{sf_dir}/pages.parquet'")
    want = con.execute(u.oracle_sql()).fetchall()
    assert sorted(map(tuple, got)) == sorted(want)


def test_odd_urls_both_ways_and_brute_force(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(URLS + URLS[-3:])], "page_id long, url string")
    df = df.selectExpr("*", "'z' as host", "'z' as rule", "1 as token")
    rules = u.make_rules(patterns=[*u.read_patterns(), r"a\z*b|", "*track*", "@@|http://h.", "http://x.net/cgi-bin/q|"])
    got = sorted(map(tuple, u.filter_urls(df, rules).collect()))
    assert got == sorted(map(tuple, u.filter_urls(df, rules, index_bytes=0).collect()))
    for i, host, path, rule, verdict in got:
        url = (URLS + URLS[-3:])[i]
        hits = [r for r in rules if url is not None and u._compiled(r).search(host + path if r.host else url.translate(u._FOLD))]
        assert (rule, verdict) == u._decide(hits), url
    by = {(URLS + URLS[-3:])[i]: r for i, *r in got}
    assert by["http://example.org/en/12"] == ["example.org", "/en/12", "example.org/en/1", "block"]
    assert by["http://a.org"] == ["a.org", "", None, "allow"]
    assert by["a b://h.com/de/://org/x"][0] == "h.com"
    assert u.filter_urls(df.limit(0), rules).count() == 0


def test_rules_sit_under_their_rarest_token():
    rules = u.make_rules()
    index = u.index_rules(rules, {"example": 9, "org": 20, "es": 3, "en": 30})
    assert [r.text for r in index["es"]] == ["example.org/es/"]
    assert [r.text for r in index["example"]] == ["example.org/en/1"]
    assert u.Rule("||casino*.", "block", False).tokens == []
    # Nearly all listed rules can be found by a token of their own.
    assert sum(not r.tokens for r in u.make_rules()) <= 1
    assert u.Rule(r"a\z^", "block", False).regex("END").count("END") == 1


def test_filter_lists(tmp_path):
    path = tmp_path / "list.txt"
    path.write_text("! comment\n[Adblock Plus]\n\n||a.com^\nb.com##.banner\n@@/x/\n")
    assert u.read_patterns(path) == ["||a.com^", "@@/x/"]
    path.write_text("||a.com^$third-party\n")
    with pytest.raises(ValueError):
        u.read_patterns(path)


def test_thousands_of_rules_fetch_few_candidates(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    words = [word() for _ in range(3000)]
    patterns = [p.format(a=rng.choice(words), b=rng.choice(words)) for p in ("||{a}.{b}^", "/{a}/*/{b}/", "?{a}=", "@@||{a}.org^", "-{a}-{b}|") for _ in range(1000)]
    urls = ["http://" + p.lstrip("@|/?-").replace("*", "x").rstrip("^|") + rng.choice(["", "/", "/q", "?z=1"]) for p in rng.sample(patterns, 600)]
    urls += [f"https://{rng.choice(words)}.{rng.choice(['org', 'com'])}/{rng.choice(words)}/y/{rng.choice(words)}/?{rng.choice(words)}=1" for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = u.make_rules(patterns=patterns)
    got = sorted(map(tuple, u.filter_urls(df, rules).collect()))
    assert got == sorted(map(tuple, u.filter_urls(df, rules, index_bytes=0).collect()))
    for i, host, path, rule, verdict in got[::7]:
        assert (rule, verdict) == u._decide([r for r in rules if u._compiled(r).search(host + path if r.host else urls[i])])
    assert len({r[-1] for r in got}) == 2
    index = u.index_rules(rules, u.token_counts(df.selectExpr("page_id id", "url"), rules))
    fetched = [sum(len(index.get(t, ())) for t in {"", *u._TOKEN.findall(x)}) for x in urls]
    assert len(rules) > 5000 and sum(fetched) / len(fetched) < 0.002 * len(rules)


def test_published_lists_load_rule_by_rule(tmp_path):
    path = tmp_path / "list.txt"
    path.write_text("\n".join(["! title", "[Adblock Plus 2.0]", "||ads.example^$third-party", "||bad.example^$document", "||worse.example^$all,~doc", "/banner/*/img^",
                               "||x.example^$script,domain=a.com|b.com", "@@||good.example^$document", "a.com##.ad", "/ad[0-9]+/", "/re/$script", "&price=$"]))
    kept, left = u.read_list(path)
    assert kept == ["||bad.example^", "||worse.example^", "/banner/*/img^", "@@||good.example^"]
    assert left == {"third-party": 1, "script": 1, "domain": 1, "regular expression": 2, "": 1}


def test_only_rule_tokens_are_counted(spark):
    rules = u.make_rules(patterns=["/spam/", "casino*", "||a.b^"])
    urls = spark.createDataFrame([(1, "http://x1.net/spam/q"), (2, "http://x2.net/spam/spam"), (3, None)], "id long, url string")
    for size in (u.INDEX_BYTES, 0):
        assert u.token_counts(urls, rules, index_bytes=size)["spam"] == 2
    seen = urls.select(u.F.explode(u._tokens(u.F.col("url"))).alias("token")).join(u.F.broadcast(spark.createDataFrame([("spam",)], "token string")), "token", "left_semi")
    text = seen.groupBy("token").count()._jdf.queryExecution().executedPlan().toString()
    assert text.index("Exchange hashpartitioning(token") < text.index("BroadcastHashJoin")  # what is shuffled has met the rules
    every = [(i, x) for i, x in enumerate(URLS)]
    df, loose = spark.createDataFrame(every, "page_id long, url string"), u.make_rules(patterns=["*track*", "|http:", "ort|"])
    assert len(u.index_rules(loose, {})[""]) >= 2
    assert sorted(map(tuple, u.filter_urls(df, loose).collect())) == sorted(map(tuple, u.filter_urls(df, loose, index_bytes=0).collect()))
