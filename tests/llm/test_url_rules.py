import random
from collections import Counter
from itertools import combinations

from tidemark.llm import url_rules

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    tail = rest[end:]
    stop = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), tail[:stop]


def fixed(url):
    host, path = split(url)
    fits = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fits, key=lambda r: len(r[0] + r[1]), default=None)


URLS = [None, "", "no scheme", "http://", "http://A.Example.COM/en/1?x=1#y", "https://www.example.com/en/", "https://www.example.com/EN/", "http://b.net/es/3", "http://net/fr/", "http://anet/fr/",
        "http://x.net?u=http://com/", "http://x.net#/es/", "a://b://c/es/", "http://x.org/" + "p/" * 20_000, "http://é.com/ü", "http://x.com\n/en/", "http://com"]


def test_hosts_paths_and_fixed_rules(spark):
    pages = spark.createDataFrame([(i, u, "?", "?", "?") for i, u in enumerate(URLS)], "page_id bigint, url string, host string, verdict string, token string")
    none = spark.createDataFrame([], "token string, rule_id bigint, antecedent array<string>")
    for r in url_rules.judge(pages, none).collect():
        rule = fixed(URLS[r["page_id"]])
        assert (r["host"], r["path"]) == split(URLS[r["page_id"]])
        assert r["rule"] == (rule and rule[0] + rule[1]) and r["verdict"] == (rule[2] if rule else "allow")


def labelled_urls():
    rng, rows = random.Random(6), []
    for i in range(3000):
        host = rng.choice(["win", "news", "shop", "blog"])
        folder, top = rng.choice(["a", "b", "c"]), rng.choice(["org", "info"])
        bad = (host == "win" and folder == "a") or rng.random() < 0.05
        rows.append((f"http://{host}{i % 5}.{host}.{top}/{folder}/{i}.html", bad))
    return rows


def test_mined_rules_equal_counting(spark):
    rows = labelled_urls()
    frame = spark.createDataFrame([*rows, (None, True), ("http://x.org/", None)], "url string, bad boolean")
    rules = url_rules.mine(frame, support=30, confidence=0.7, lift=1.5).collect()
    baskets = [(set(r["t"]), r["bad"]) for r in frame.where("url is not null and bad is not null").select(url_rules.tokens(frame["url"]).alias("t"), "bad").collect()]
    total, bad_rows = Counter(), Counter()
    for tokens, bad in baskets:
        for n in range(1, len(tokens) + 1):
            for c in combinations(sorted(tokens), n):
                total[c] += 1
                bad_rows[c] += bad
    share = sum(b for _, b in baskets) / len(baskets)
    strong = {c: bad_rows[c] / total[c] for c in total if bad_rows[c] >= 30 and bad_rows[c] >= 0.7 * total[c] and bad_rows[c] / total[c] / share >= 1.5}
    least = {c for c in strong if not any(set(d) < set(c) and strong[d] >= strong[c] for d in strong)}
    assert {tuple(r["antecedent"]) for r in rules} == least and ("folder=a", "host=win") in least


def test_matches_equal_testing_every_rule(spark):
    rows = labelled_urls()
    frame = spark.createDataFrame(rows, "url string, bad boolean")
    mined = url_rules.mine(frame, support=30, confidence=0.7)
    rules = {r["rule_id"]: set(r["antecedent"]) for r in mined.collect()}
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)] + [(9999, rows[0][0]), (None, None)], "page_id bigint, url string")
    tokens = {r["url"]: set(r["t"]) for r in frame.select("url", url_rules.tokens(frame["url"]).alias("t")).collect()}
    got = url_rules.judge(pages, url_rules.inverted_index(mined, frame)).collect()
    assert len(got) == len(rows) + 2
    url = {i: u for i, (u, _) in enumerate(rows)} | {9999: rows[0][0]}
    for r in got:
        n = sum(a <= tokens[url[r["page_id"]]] for a in rules.values()) if r["page_id"] is not None else 0
        assert (r["n_mined"], r["verdict"]) == (n, "block" if n else "allow")
    assert sum(r["verdict"] == "block" for r in got) > 100


def test_a_bad_host_is_found_in_a_table_of_any_size(spark):
    """4,000 URLs of one host, all bad, among a million; and 40 of them among a thousand."""
    for n, bad in ((1_000_000, 4_000), (1_000, 40)):
        spoilt = f"id < {bad}"
        url = f"if({spoilt}, concat('http://bad.org/', id, '.html'), concat('http://h', id % 50, '.info/', id % 7, '/', id))"
        labelled = spark.range(n).selectExpr(f"{url} AS url", f"{spoilt} OR id % 25 = 0 AS bad")
        index = url_rules.inverted_index(url_rules.mine(labelled), labelled)
        pages = spark.createDataFrame([(1, "http://bad.org/new.html"), (2, "http://h3.info/2/5")], "page_id bigint, url string")
        assert {r["page_id"]: r["verdict"] for r in url_rules.judge(pages, index).collect()} == {1: "block", 2: "allow"}
