from __future__ import annotations

from impactflow.llm.url_filter import STRICT, Rule, automaton, filter_urls, terms_in


def test_boundaries_and_distinct_soft_terms():
    a = automaton(["bad", "badly"], ["so", "soft"])
    assert terms_in(a, "http://x/bad") == ({"bad"}, set())
    assert terms_in(a, "http://x/badge/abad/bad1") == (set(), set())
    assert terms_in(a, "bad-badly.so/so?so") == ({"bad", "badly"}, {"so"})
    assert terms_in(automaton([], []), "x") == (set(), set())


def test_hosts_rules_and_verdicts(docs_of):
    rules = (Rule("block", "net", "/"), Rule("allow", "a.net", "/en/"))
    urls = {
        "HTTP://B.NET/En": ("b.net", "/En", "net/", "block"),
        "x://a.net/en/1?q#f": ("a.net", "/en/1", "a.net/en/", "allow"),
        "x://w.a.net/en": ("w.a.net", "/en", "net/", "block"),
        "x://ba.net/en/": ("ba.net", "/en/", "net/", "block"),
        "x://net?/a": ("net", "", None, "allow"),
        "x://h#/a": ("h", "", None, "allow"),
        "x://h/a://b.net/": ("h", "/a://b.net/", None, "allow"),
        "x://h/\nb": ("h", "/\nb", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "://": ("", "", None, "allow"),
        f"x://h/{STRICT[0].upper()}": ("h", f"/{STRICT[0].upper()}", None, "block"),
        "x://h/casino": ("h", "/casino", None, "allow"),
        "x://h/casino/casino": ("h", "/casino/casino", None, "allow"),
        "x://casino/poker": ("casino", "/poker", None, "block"),
        "x://a.net/en/porn": ("a.net", "/en/porn", "a.net/en/", "allow"),
        "x://h/" + "a/" * 50_000 + "xxx": ("h", "/" + "a/" * 50_000 + "xxx", None, "block"),
    }
    df = docs_of([(i, u, 5) for i, u in enumerate(urls)], "page_id long, url string, HOST int")
    got = {r.url: (r.host, r.path, r.rule, r.verdict) for r in filter_urls(df, rules=rules).collect()}
    assert got == urls
    assert filter_urls(docs_of([], "page_id long, url string")).collect() == []
