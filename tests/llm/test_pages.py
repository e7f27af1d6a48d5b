"""The URL filter on hand-made pages."""

from collections import defaultdict

from dialtide.llm import url_filter


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def verdicts(df):
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in df.collect()}


def test_rules_hosts_and_paths(spark):
    urls = [
        "http://A.Example.NET/en/x?y#z", "https://example.net/de/", "http://net/", "http://other.net", "http://other.net?q", "http://xnet/a",
        "http://www.example.com/de/1", "http://example.com/deutsch", "http://b.org/fr/", "http://b.org/fr", "http://b.org#/fr/", None, "", "no scheme",
        "://", "x://h://p/q", "http://example.net/en", "http://notexample.net/en/",
    ]
    df = pages(spark, [(i, u, None) for i, u in enumerate(urls)])
    want = [
        ("a.example.net", "/en/x", "example.net/en/", "allow"), ("example.net", "/de/", "net/", "block"), ("net", "/", "net/", "block"),
        ("other.net", "", None, "block"), ("other.net", "", None, "block"), ("xnet", "/a", None, "allow"),
        ("www.example.com", "/de/1", "example.com/de/", "block"), ("example.com", "/deutsch", None, "allow"), ("b.org", "/fr/", "org/fr/", "allow"),
        ("b.org", "/fr", None, "allow"), ("b.org", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("", "", None, "allow"), ("h:", "//p/q", None, "allow"), ("example.net", "/en", "net/", "block"), ("notexample.net", "/en/", "net/", "block"),
    ]
    got = verdicts(url_filter.url_filter(df))
    for i, w in enumerate(want):
        assert got[i][:3] == w[:3], urls[i]
        assert got[i][3] == w[3] or got[i][2] is None, urls[i]
    assert url_filter.url_filter(df.limit(0)).count() == 0
    clash = df.selectExpr("*", "'x' AS host", "'y' AS rule", "1 AS kind", "2 AS seed")
    assert verdicts(url_filter.url_filter(clash.union(clash))) == got


def spread(links, trusted, blocked, rounds):
    """Trust and distrust with plain dictionaries."""
    unit, out, back = url_filter.UNIT, defaultdict(set), defaultdict(set)
    for u, v in links:
        if u != v:
            out[u].add(v)
            back[v].add(u)
    hosts = {h for e in links for h in e} | set(trusted) | set(blocked)
    score = {h: trusted.get(h, 0) * 15 // 100 for h in hosts}
    for _ in range(rounds):
        score = {h: trusted.get(h, 0) * 15 // 100 + sum(score[u] // len(out[u]) for u in back[h]) // 100 * 85 for h in hosts}
    trust = {h: min(unit, s * 100 // 15) for h, s in score.items()}
    bad = {h: blocked.get(h, 0) for h in hosts}
    for _ in range(rounds):
        share = {h: sum(max(bad[v] - trust[v], 0) for v in out[h]) // len(out[h]) if out[h] else 0 for h in hosts}
        bad = {h: blocked.get(h, 0) + (unit - blocked.get(h, 0)) * share[h] // unit * 85 // 100 for h in hosts}
    return trust, bad


def linked_pages(spark, links):
    hosts = sorted({h for e in links for h in e})
    html = {h: " ".join(f'<a class="x" href="https://{v.upper()}/p?q">l</a>' for u, v in links if u == h) for h in hosts}
    return pages(spark, [(i, f"http://{h}/{'fr/' if h.endswith('org') else 'x'}", html[h]) for i, h in enumerate(hosts)])


def check_scores(spark, links):
    """Scores are the plain ones after all rounds; returns the verdicts by host."""
    df, unit = linked_pages(spark, links), url_filter.UNIT
    hosts = {h for e in links for h in e}
    ruled = url_filter.ruled_pages(df, url_filter.RULES)
    got = {r["host"]: (r["trust"], r["distrust"]) for r in url_filter.host_scores(df, ruled).collect()}
    seeds = [{h: unit for h in hosts if h.endswith(end)} for end in (".org", ".net")]
    trust, distrust = spread(links, *seeds, url_filter.ROUNDS)
    assert got == {h: (trust[h], distrust[h]) for h in hosts}
    more = spread(links, *seeds, 4 * url_filter.ROUNDS)
    assert all(abs(x[h] - y[h]) < unit // 5000 for x, y in zip((trust, distrust), more) for h in hosts)  # converged
    return {r["host"]: r["verdict"] for r in url_filter.url_filter(df).collect()}


def test_distrust_spreads_against_links_and_trust_along_them(spark):
    links = [("farm.com", "spam.net"), ("farm.com", "bad.net"), ("fine.com", "spam.net"), ("fine.com", "ok.org"), ("ok.org", "fine.com"),
             ("ok.org", "news.com"), ("deep.com", "farm.com"), ("self.com", "self.com")]
    decided = check_scores(spark, links)
    assert decided["farm.com"] == "block" and decided["fine.com"] == "allow" and decided["deep.com"] == "block"
    assert decided["news.com"] == "allow" and decided["self.com"] == "allow" and decided["ok.org"] == "allow"


def test_well_linked_spam_does_not_protect_its_linkers(spark):
    links = [(f"farm{i}.com", "spam.net") for i in range(6)] + [("half.com", "spam.net"), ("half.com", "news.com")]
    links += [("few.com", "spam.net"), *[("few.com", f"n{i}.com") for i in range(5)], ("alone.com", "lone.net")]
    decided = check_scores(spark, links)
    assert all(decided[f"farm{i}.com"] == "block" for i in range(6)) and decided["alone.com"] == "block"
    assert decided["half.com"] == "block" and decided["few.com"] == "allow" and decided["news.com"] == "allow"


def test_mutual_links_and_rings_converge(spark):
    ring = [(f"r{i}.com", f"r{(i + 1) % 5}.com") for i in range(5)]
    decided = check_scores(spark, [*ring, ("r0.com", "spam.net"), ("a.com", "b.com"), ("b.com", "a.com"), ("b.com", "spam.net"), ("x.org", "a.com")])
    assert decided["spam.net"] == "block" and decided["x.org"] == "allow"


def test_sql_says_the_same_of_linked_pages(spark):
    import duckdb

    from dialtide.llm.sql import URL_FILTER

    links = [("farm.com", "spam.net"), ("fine.com", "spam.net"), ("fine.com", "ok.org"), ("ok.org", "fine.com"), ("deep.com", "farm.com"), ("far.com", "deep.com")]
    df = linked_pages(spark, links)
    con = duckdb.connect()
    rows = df.toPandas()
    con.register("pages", rows)
    want = sorted(con.sql(URL_FILTER).fetchall())
    assert sorted(tuple(r) for r in url_filter.url_filter(df).select("page_id", "host", "path", "rule", "verdict").collect()) == want
