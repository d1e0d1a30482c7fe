from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from adoptrend.llm import url_filter

CASES = [
    # url, host, path, rule, verdict
    ("http://a.net/x", "a.net", "/x", "net/", "block"),
    ("http://a.net", "a.net", "", None, "allow"),
    ("http://net/", "net", "/", "net/", "block"),
    ("http://Sub.Example.NET/en/1?q=/de/", "sub.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://example.net/en", "example.net", "/en", "net/", "block"),
    ("http://notexample.net/en/1", "notexample.net", "/en/1", "net/", "block"),
    ("https://x.example.com/de/1#f", "x.example.com", "/de/1", "example.com/de/", "block"),
    ("https://x.example.com/DE/1", "x.example.com", "/DE/1", None, "allow"),
    ("https://a.org/fr/", "a.org", "/fr/", "org/fr/", "allow"),
    ("https://org/fr/a", "org", "/fr/a", "org/fr/", "allow"),
    ("https://aorg/fr/a", "aorg", "/fr/a", None, "allow"),
    ("https://É.net?x/y", "É.net", "", None, "allow"),
    ("x://a.net/b://c.org/fr/", "a.net", "/b://c.org/fr/", "net/", "block"),
    ("a.net/x", "", "", None, "allow"),
    ("://#", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("h://host\n.net/a\nb", "host\n.net", "/a\nb", "net/", "block"),
]


def pages(spark, urls, **extra):
    df = spark.createDataFrame([(i, u, "<html>") for i, u in enumerate(urls)], "page_id long, url string, html string")
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    return df


def test_parts_and_rules(spark):
    df = pages(spark, [c[0] for c in CASES], host="clash", path=1, by="b", label=2, n=3)
    got = {r.page_id: tuple(r)[1:] for r in url_filter.judged(df).collect()}
    for i, case in enumerate(CASES):
        # without a rule the templates beside decide; several under net are bad here
        assert got[i] == case[1:] or (case[3] is None and got[i][:3] == case[1:4] and case[1].endswith("net")), case[0]
    assert url_filter.judged(pages(spark, [])).collect() == []


def test_templates_are_rejected_by_their_purity(spark):
    urls, labels = [], []

    def add(url, label=None, n=1):
        urls.extend([url] * n)
        labels.extend([label] * n)

    for i in range(30):
        add(f"h://a.io/spam/{i}", 1)
        add(f"h://a.io/blog/{i}", 0)
        add(f"h://a.io/user{chr(97 + i % 26)}{chr(97 + i // 26)}/post", 1 if i % 2 else None)
    add("h://a.io/spam/999.html")
    add("h://a.io/spam/777")
    add("h://a.io/blog/777")
    add("h://b.io/spam/777")
    add("h://a.io/" + "deep/" * 200)
    df = pages(spark, urls).withColumn("l", F.element_at(F.array(*[F.lit(x) for x in labels]), (F.col("page_id") + 1).cast("int")))
    got = [r.verdict for r in url_filter.judged(df, rules=(), label=F.col("l")).orderBy("page_id").collect()]
    judged = dict(zip(urls, got, strict=True))
    assert judged["h://a.io/spam/777"] == "block" and judged["h://a.io/spam/1"] == "block"
    assert judged["h://a.io/blog/777"] == "allow" and judged["h://a.io/blog/1"] == "allow"
    # another host knows of one bad branch and a good one; a form of its own has one bad branch beside it
    assert judged["h://b.io/spam/777"] == "allow"


def brute(rows):
    """Purities of (host, segs, n, labelled, bad), with dictionaries for all nodes."""
    now = {(h, tuple(s)): list(s) for h, s, *_ in rows}

    def branches(only=False):
        at = {}
        for h, s, n, lab, bad in rows:
            path = now[h, tuple(s)]
            for i, seg in enumerate(path):
                b = at.setdefault((h, tuple(path[:i])), {}).setdefault(seg, [0, 0, 0])
                for j, x in enumerate((n, lab, bad)):
                    b[j] += x
        return at

    for _ in range(url_filter.PASSES):
        variable = {p for p, b in branches().items() if len(b) >= url_filter.BRANCHES and len(b) > url_filter.OWN_SHARE * sum(x[0] for x in b.values())}
        for (h, _), path in now.items():
            new = ["*" if (h, tuple(path[:i])) in variable else seg for i, seg in enumerate(path)]
            path[:] = new
    merged = set()
    for p, b in branches().items():
        told = {seg: x for seg, x in b.items() if x[1]}
        if len(told) > 1:
            share = sum(x[2] for x in told.values()) / sum(x[1] for x in told.values())
            merged |= {(p, seg) for seg, (_, lab, bad) in told.items() if abs(bad - lab * share) <= 2 * (lab * share * (1 - share)) ** 0.5}
    final = {
        (h, s): (h, tuple("+" if ((h, tuple(path[:i])), seg) in merged else seg for i, seg in enumerate(path))) for (h, s), path in now.items()
    }
    sums = {}
    for h, s, _, lab, bad in rows:
        t = sums.setdefault(final[h, tuple(s)], [0, 0])
        t[0], t[1] = t[0] + lab, t[1] + bad

    def chain(h, t):
        names = h.split(".")
        return [".".join(names[i:]) for i in reversed(range(len(names)))] + [(h, t[:i]) for i in range(1, len(t))]

    votes = {}
    for (h, t), (lab, bad) in sums.items():
        for node in chain(h, t) if lab else ():
            depth = len(node[1]) if isinstance(node, tuple) else 0
            seen = votes.setdefault(node, {}).setdefault(t[depth] if t else "", [0, 0])
            seen[0], seen[1] = seen[0] + bad, seen[1] + lab
    out = {}
    for key, (h, t) in final.items():
        p = url_filter.EXPECTED
        nodes = [n for n in chain(h, t) if n in votes]
        for node in [n for n, after in zip(nodes, [*nodes[1:], None]) if after is None or len(votes[n]) != len(votes[after])]:
            shares = [b / n for b, n in votes.get(node, {}).values()]
            p = (sum(shares) + 2 * p) / (len(shares) + 2)
        lab, bad = sums[h, t]
        out[key] = (bad + 2 * p) / (lab + 2)
    return out


def test_purities_are_those_of_plain_trees(spark):
    pick = random.Random(5)
    rows = {}
    for _ in range(400):
        host = pick.choice(["a.io", "b.a.io", "c.io", "", "x.c.io", "d.org", "e.f.g.org"])
        segs = tuple(pick.choice(["u", "v", "w", f"n{pick.randrange(40)}"]) for _ in range(pick.randrange(5)))
        n = pick.randrange(1, 4)
        lab = pick.choice([0, 0, n])
        rows[host, segs] = (host, list(segs), n, lab, pick.randrange(lab + 1) if pick.random() < 0.5 else (lab if "u" in segs else 0))
    schema = "host string, segs array<string>, n long, labelled long, bad long"
    want = brute(list(rows.values()))
    got = {(r.host, tuple(r.segs)): r.purity for r in url_filter.templates(spark.createDataFrame(list(rows.values()), schema)).collect()}
    assert got == pytest.approx(want)
    unlabelled = {want[k] for k, r in rows.items() if not r[3]}
    assert len({round(p, 6) for p in unlabelled}) > 10, "templates without labels inherit what is around them"


def test_unlabelled_branches_inherit(spark):
    rows = [("h.io", ["bad", "abcdef"[i], "p"], 9, 9, 9 - (i == 2)) for i in range(6)] + [("h.io", ["bad", "new", "p"], 9, 0, 0), ("h.io", ["good", "p"], 9, 9, 0)]
    rows += [("h.io", ["good", "q"], 9, 0, 0), ("k.io", ["p"], 9, 0, 0), ("k.com", ["p"], 9, 0, 0)]
    paths = spark.createDataFrame(rows, "host string, segs array<string>, n long, labelled long, bad long")
    purity = {(r.host, tuple(r.segs)): r.purity for r in url_filter.templates(paths).collect()}
    assert purity["h.io", ("bad", "new", "p")] > 0.5 > purity["h.io", ("good", "q")]
    assert purity["k.com", ("p",)] == url_filter.EXPECTED < purity["k.io", ("p",)]
