import re

from cartonwise.llm import queries, tables, urls


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def listed(host, path):
    fitting = [r for r in urls.LIST_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fitting, key=lambda r: len(r.text), default=None)


CASES = ["http://a.org/x", "http://EXAMPLE.org/es/1", "https://x.example.org/en/12", "https://x.example.org/en/2", "http://notorg/x", "http://org/",
         "http://org", "http://a.com/fr/", "http://a.com/de/5?x://y", "ftp://a.com/fr", "a://b://c/d", None, "", "no url", "://", "http://ÄB.org/é",
         "http://a.org?q=1", "http://a.com#/de/", "http://a.com/de/\nx", "http://badexample.org/es/1", "http://a.com:80/fr/x"]


def test_hosts_paths_and_list_rules(frame):
    rows = urls.judge_urls(frame(list(enumerate(CASES)), "page_id long, url string")).collect()
    assert len(rows) == len(CASES)
    for row in rows:
        host, path = parsed(CASES[row.page_id])
        rule = listed(host, path)
        assert (row.host, row.path, row.rule) == (host, path, rule and rule.text), CASES[row.page_id]
        assert row.verdict == (rule.verdict if rule else row.verdict) and row.verdict in ("allow", "block")


def test_mined_rules_judge_the_rest(frame):
    pages = [(i, f"http://w{i}.com/de/{i}") for i in range(60)] + [(100 + i, f"http://w{i}.org/fr/{i}") for i in range(60)]
    pages += [(300, "http://x.net/de/7"), (301, "http://x.net/fr/7"), (302, "http://x.net/it/7")]
    found = {r.page_id: r for r in urls.judge_urls(frame(pages, "page_id long, url string")).collect()}
    assert (found[300].verdict, found[300].mined_rule, found[300].confidence) == ("block", ["path:de"], 1.0)
    assert (found[301].verdict, found[302].verdict, found[302].mined_rule) == ("allow", "allow", None)


def test_rules_against_brute_force(spark, frame):
    """Support and confidence of every mined rule, and that no shorter rule says the same."""
    pages = tables.read(spark, "/root/testdata/sf0.01", "pages").select("page_id", "url")
    host, path, query = urls.url_host(pages.url), urls.url_path(pages.url), urls.url_query(pages.url)
    rows = pages.select(urls.url_tokens(host, path, query).alias("tokens"), urls.list_rule(host, path).verdict.alias("label"))
    known = [(set(r.tokens), r.label) for r in rows.collect() if r.label]
    labelled = rows.where("label is not null")
    same = urls.same_tokens(labelled)
    rules = urls.mine_rules(labelled, same, min_support=0.02).collect()
    assert rules
    holders = {}
    for place, (tokens, _) in enumerate(known):
        for token in tokens:
            holders.setdefault(token, set()).add(place)
    items = {r.token: r.item for r in same.collect()}
    assert items == {t: min(o for o in holders if holders[o] == holders[t]) for t in holders}
    # All of them: every set of up to two items that passes the limits is a rule, or a shorter one says the same.
    own = {t for t in items.values() if len(holders[t]) <= 0.95 * len(known)}
    told = {(frozenset(r.rule_tokens), r.verdict): r.confidence for r in rules}
    for a in own:
        for b in own:
            rows_of_both = holders[a] & holders[b]
            for verdict in ("allow", "block"):
                right = sum(known[i][1] == verdict for i in rows_of_both)
                if right / len(known) >= 0.02 and right >= 0.8 * len(rows_of_both):
                    subsets = [frozenset(s) for s in ({a}, {b}, {a, b})]
                    assert max(told.get((s, verdict), 0) for s in subsets) >= right / len(rows_of_both) - 1e-9
    for rule in rules:
        covered = [label for tokens, label in known if tokens >= set(rule.rule_tokens)]
        right = covered.count(rule.verdict)
        assert abs(right / len(covered) - rule.confidence) < 1e-9 and right / len(known) >= 0.02 and rule.confidence >= 0.8
        assert not [r for r in rules if set(r.rule_tokens) < set(rule.rule_tokens) and r.verdict == rule.verdict and r.confidence >= rule.confidence]


def test_long_urls(frame):
    """Paths of 40 segments, shared by many pages or by none: 2 to the power of 40 item sets, but few items."""
    shared, own = "/".join(f"s{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(40)), [f"k{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(40)]
    pages = [(i, f"http://w{i}.com/de/{shared}/{i}") for i in range(30)] + [(100 + i, f"http://w{i}.org/fr/{i}") for i in range(30)]
    pages += [(200, "http://long.org/" + "/".join(own)), (300, f"http://x.net/{shared}"), (301, "http://y.net/saa"), (302, "http://z.net/kaa/kba"),
              (303, "http://x.net/" + "segment/" * 50_000)]
    found = {r.page_id: r for r in urls.judge_urls(frame(pages, "page_id long, url string")).collect()}
    assert len(found) == len(pages) and found[300].verdict == found[301].verdict == "block" and found[302].verdict == "allow"
    assert found[301].mined_rule == ["path:saa"] and len(found[300].mined_rule) == 40 and found[303].verdict == "allow"


def test_empty_repeated_and_clashing(spark, frame):
    assert urls.judge_urls(frame([], "page_id long, url string")).count() == 0
    rows = urls.judge_urls(frame([(1, "http://q.net/"), (1, "http://q.net/"), (None, None)], "page_id long, url string").selectExpr(
        "*", "'h' as host", "1 as tokens", "2 as verdict")).collect()
    assert sorted((r.page_id or 0, r.host, r.verdict) for r in rows) == [(0, "", "allow"), (1, "q.net", "allow"), (1, "q.net", "allow")]


def test_query(spark):
    pages = {r.page_id: r.url for r in tables.read(spark, "/root/testdata/sf0.01", "pages").collect()}
    rows = queries.op10_url_filter(spark, "/root/testdata/sf0.01").collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for row in rows:
        host, path = parsed(pages[row.page_id])
        rule = listed(host, path)
        assert (row.host, row.path, row.rule) == (host, path, rule and rule.text)
        assert row.verdict == (rule.verdict if rule else row.verdict)
