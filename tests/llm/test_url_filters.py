import random
import re

from messy import rows_of

from ascentframe.llm import url_filters as U

PAGES = "page_id long, url string, html string, host string, rule string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return lower, re.match(r"[^?#]*", rest[len(host) :])[0]


def pattern(glob):
    out, k = "", 0
    while k < len(glob):
        if glob[k : k + 2] == "**":
            out, k = out + "(?s:.*)", k + 2
        else:
            out, k = out + {"*": "[^/]*", "?": "(?s:.)"}.get(glob[k], re.escape(glob[k])), k + 1
    return re.compile(out)


def brute(url):
    host, path = parts(url)
    listed = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
    fit = [(len(h + p), h + p, v) for h, p, v in listed if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fit:
        return host, path, *max(fit)[1:]
    return host, path, None, "block" if any(pattern(r.glob).fullmatch(f".{host}{path}") for r in U.GENERAL) else "allow"


URLS = [
    None, "", "no scheme", "://", "http://", "http://org", "http://org/", "http://ORG/x", "http://xorg/", "http://a.Example.ORG/es/1?x", "http://example.org/es",
    "http://example.org/en/12", "http://b.com/fr/", "http://b.com/fr", "http://b.com/de/#x", "http://com/de/x", "x http://a.net/p://q", "http://casino.net",
    "http://a.net/casino", "http://my-casino-x.net/y", "http://É.net/ü/setup.exe", "http://a.net/a/wp-login.php", "http://ads.a.net", "http://x.ads.net/q",
    "http://a.net/x/porn/y", "http://a.net/\nporn/", "http://a.net/porn/\n", "http://user@h:80/p", "http://a.net/" + "y/" * 20_000 + "z.exe",
]


def test_rules_on_odd_urls(spark):
    rows = [(k % 25, u, None, "clash", "clash") for k, u in enumerate(URLS * 2)]
    got = rows_of(U.judge(spark.createDataFrame(rows, PAGES)), "page_id", "host", "path", "rule", "verdict")
    assert got == sorted([(k, *brute(u)) for k, u, *_ in rows], key=repr)
    assert U.judge(spark.createDataFrame([], PAGES)).count() == 0


def test_automaton_against_patterns():
    rng = random.Random(2)
    globs = ["".join(rng.choice(["a", "b", "/", "*", "**", "?", "é"]) for _ in range(rng.randrange(1, 14))) for _ in range(60)]
    texts = ["".join(rng.choice("ab/éx") for _ in range(rng.randrange(0, 16))) for _ in range(400)]
    found = U.Automaton(globs).run(texts)
    for k, glob in enumerate(globs):
        wanted = pattern(glob)
        assert [wanted.fullmatch(t) is not None for t in texts] == found[:, k].tolist(), glob
    assert U.Automaton(globs).run([]).shape == (0, 60)
