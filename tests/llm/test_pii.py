from __future__ import annotations

import hashlib
import math
import random
import re
import time

from adoptrend.llm import pii
from tests.llm.fixtures import CLASHING, ODD, documents

PLAIN = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def base(text):
    found = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            right = (
                True,
                kind == 1 and all(int(p) <= 255 for p in m.group().split(".")),
                12 <= len(digits) <= 19 and luhn(digits),
                9 <= len(digits) <= 15,
            )[kind]
            if right:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


STRANGE = [
    "a@b.c_d@e.f", "x..y@a.b.c.", "@a.b a@ a@b a@b.", "ä@b.c ñ.x@y.z", "1.2.3.4.5.6.7.8 1.2.3.4.5", "256.1.1.1 0255.001.0.9 999999999999.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112", "4111  1111 1111 1111", "+1 (555) 123-4567. +12 +123456789- +1....2 ++44 20 7946 0958",
    "+1 (555) 123-4567 4111111111111111", "😀 a@b.cc 😀 10.0.0.1", "a" * 3000 + "@" + "b" * 3000 + ".c", "1" * 5000, "1." * 4000, "a." * 4000 + "@b.c",
    "+" * 500 + "1234567890", "0-0 0-0 0-0 0-0 0-0 0-0", "\n7992739871300 \u00a04\u00a05",
]


def made():
    pick = random.Random(3)
    parts = ["a", "b.c", "@", ".", "1", "22", "255", " ", "-", "+", "(", ")", "é", "\n", "%", "_", "😀", "4111111111111111", "x@y.zz", "10.1.2.3"]
    return ["".join(pick.choice(parts) for _ in range(40)) for _ in range(300)]


def test_base_is_that_of_the_plain_expressions(spark):
    rows = [*ODD, *((100 + i, t) for i, t in enumerate(STRANGE + made()))]
    got = pii.personal_data(documents(spark, rows, **CLASHING)).select(
        "doc_id", pii.listed("base").alias("base"), *[pii.count_of(k, "base").alias(k) for k in pii.KINDS]
    )
    seen = {}
    for r in got.collect():
        seen.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, seen.values())) == len(rows)
    for doc_id, text, *_ in rows:
        spans = base(text)
        told = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        mine = next(r for r in seen[doc_id] if r.base == told)
        assert [mine[k] for k in pii.KINDS] == [sum(x[1] == k for x in spans) for k in range(4)], repr(text)[:80]
    assert pii.personal_data(documents(spark, [])).collect() == []


def corpus():
    """Cards stand after "card number", order numbers of the same form elsewhere."""
    pick = random.Random(8)
    words = [f"w{i}" .replace("0", "o").translate(str.maketrans("123456789", "abcdefghi")) for i in range(90)]

    def number(valid):
        while True:
            d = "4" + "".join(pick.choice("0123456789") for _ in range(15))
            if luhn(d) == valid:
                return d

    say = lambda n: " ".join(pick.choice(words) for _ in range(n))
    rows = []
    for i in range(120):
        rows.append((i, f"{say(6)} my card number {number(True)} thanks {say(4)}"))
        rows.append((1000 + i, f"{say(6)} your parcel reference {number(False)} arrived {say(4)}"))
    unseen = [number(False) for _ in range(5)]
    for i, d in enumerate(unseen):
        rows.append((5000 + i, f"{say(6)} my card number ({d}), thanks {say(4)}"))
    rows += [(9000 + i, f"{say(20)} in {i} days, see page {i}{i}") for i in range(50)]
    return rows, unseen


def test_believed_patterns_find_unseen_identifiers(spark):
    rows, unseen = corpus()
    texts = dict(rows)
    found = {r.doc_id: r for r in pii.personal_data(documents(spark, rows)).collect()}
    for i, digits in enumerate(unseen):
        start = texts[5000 + i].index(digits)
        assert [tuple(s) for s in found[5000 + i].spans] == [(start, 2, start + 16)] and found[5000 + i].base == []
    for doc_id, r in found.items():
        assert [tuple(s) for s in r.base] == base(texts[doc_id])
        if not 5000 <= doc_id < 5005:
            assert r.spans == r.base, "documents without such a context are left alone"


def test_copies_do_not_make_a_pattern(spark):
    seeds = [(i, "my card number 4111111111111111 thanks") for i in range(50)]
    rows = [*seeds, (900, "my card number 4111111111111112 thanks"), *((100 + i, f"a parcel {4000000000000000 + 10 * i + 1} came") for i in range(40))]
    found = {r.doc_id: r for r in pii.personal_data(documents(spark, rows)).collect()}
    assert found[900].spans == []


def test_digest_of_no_spans(spark):
    row = pii.personal_data(documents(spark, [(1, None)])).select(pii.listed("base").alias("b"), pii.listed("spans").alias("s")).first()
    assert (row.b, row.s) == ("", "") and hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_a_number_beside_a_candidate_does_not_end_its_context(spark):
    pick = random.Random(9)
    names = ["".join(pick.choice("abcdefgh") for _ in range(9)) for _ in range(60)]
    rows = [(i, f"Email {i % 7}: {n}@firma.de (since 20{i % 90 + 10})") for i, n in enumerate(names)]
    rows += [(100 + i, f"handle {i}: {n}@here since then") for i, n in enumerate(names)]
    rows += [(900, "Email 1: jörg@firma 2 times"), (901, "handle 1: jörg@office 2 times")]
    found = {r.doc_id: r for r in pii.personal_data(documents(spark, rows)).collect()}
    assert [tuple(s) for s in found[900].spans] == [(9, 0, 19)] and found[901].spans == []


def test_numbers_written_in_groups_are_found_as_a_whole(spark):
    rows, _ = corpus()
    pick = random.Random(4)
    for i in range(60):
        rows.append((2000 + i, f"please call me at +1 212 555 {pick.randrange(1000, 9999)} today"))
    unseen = {
        7000: ("my card number 4111 1111 1111 1112, thanks", "4111 1111 1111 1112", 2),
        7001: ("please call me at (743) 555-3824 today", "(743) 555-3824", 3),
        7002: ("please call me at 020 7946 0958 today", "020 7946 0958", 3),
        7003: ("please call me at (020.7946.0959) today", "020.7946.0959", 3),
    }
    found = {r.doc_id: r for r in pii.personal_data(documents(spark, rows + [(i, t) for i, (t, _, _) in unseen.items()])).collect()}
    for i, (text, value, kind) in unseen.items():
        start = text.index(value)
        assert [tuple(s) for s in found[i].spans] == [(start, kind, start + len(value))], text


OPENING, CLOSING = "\"'(<[{", "\"')>]},.;:!?"
TOKEN = r"(?<!\S)[^\s0-9@]*[0-9@]\S*"
GROUPS = r"(?<![0-9A-Za-z_@])\(?[0-9]+(?:(?:\)[ .-]?|[ .-]?\(|[ .-])[0-9]+)+"


def sides(text, matches, i, flags=re.ASCII):
    start, end = matches[i].span()
    low = matches[i - pii.REACH - 1].end() if i > pii.REACH else 0
    high = matches[i + pii.REACH].end() if i + pii.REACH < len(matches) else len(text)
    before, after = text[low:start][-pii.CONTEXT - 1 :], text[end:high][: pii.CONTEXT + 1]
    if len(before) > pii.CONTEXT:
        before = re.sub(r"^\S+", "", before, flags=flags)
    if len(after) > pii.CONTEXT:
        after = re.sub(r"\S+\Z", "", after, flags=flags)
    return before.rstrip(OPENING), after.lstrip(CLOSING)


def patterns(before, after):
    split = lambda t: [w for w in re.split(r"\s+", re.sub("[0-9]+", "0", t.lower()), flags=re.ASCII) if w]
    left, right = split(before), split(after)
    out = [f"{left[-2]} {left[-1]} _"] if len(left) > 1 else []
    return out + ([f"{left[-1]} _ {right[0]}"] if left and right else [])


def plain_spans(rows):
    """The whole method in plain Python, over all rows at once."""
    seeds, others, bases = [], [], []
    for row, (_, text, *_) in enumerate(rows):
        text = text or ""
        spans = base(text)
        bases.append(spans)
        for kind, pattern in enumerate(PLAIN):
            ms = list(re.finditer(pattern, text))
            for i, m in enumerate(ms):
                if (m.start(), kind, m.end()) in spans:
                    seeds += [(kind, p, m.group().lower()) for p in patterns(*sides(text, ms, i))]
        found = {}
        tokens, groups = list(re.finditer(TOKEN, text, re.ASCII)), list(re.finditer(GROUPS, text))
        for i, m in enumerate(tokens):
            opened = m.group().lstrip(OPENING)
            value, n = opened.rstrip(CLOSING), len(re.sub("[^0-9]", "", m.group()))
            kinds = [
                bool(re.fullmatch("[^@]+@[^@]+", value)), bool(re.fullmatch("[0-9a-fA-F]{1,4}(?:[.:][0-9a-fA-F]{0,4}){3,7}", value)),
                bool(re.fullmatch("[0-9-]+", value)) and 12 <= n <= 19, bool(re.fullmatch("[0-9().-]+", value)) and 7 <= n <= 15,
            ]
            start = m.start() + len(m.group()) - len(opened)
            if any(kinds):
                found[start, start + len(value)] = (value, [k for k in range(4) if kinds[k]], sides(text, tokens, i))
        for i, m in enumerate(groups):
            alone = m.group().startswith("(") and ")" not in m.group()
            value, n = m.group()[alone:], len(re.sub("[^0-9]", "", m.group()))
            kinds = [2] * (bool(re.fullmatch("[0-9 .-]+", value)) and 12 <= n <= 19) + [3] * (7 <= n <= 15)
            if kinds:
                found.setdefault((m.start() + alone, m.start() + alone + len(value)), (value, kinds, sides(text, groups, i)))
        for (a, b), (value, kinds, around) in found.items():
            if not any(s < b and a < e for s, _, e in spans):
                others += [(row, a, b, k, p, value.lower()) for k in kinds for p in patterns(*around)]
    edges, seeded = {}, {}
    for k, p, v in seeds + [(k, p, v) for _, _, _, k, p, v in others]:
        edges.setdefault((k, p), set()).add(v)
    for k, p, v in seeds:
        seeded[k, v] = 1
    values = {(k, v) for (k, p), vs in edges.items() for v in vs}
    usual = {k: (sum(seeded.get(x, 0) for x in values if x[0] == k) + 1) / (sum(x[0] == k for x in values) + 2) for k in range(4)}
    graph = {kp: vs for kp, vs in edges.items() if len(vs) >= pii.SUPPORT}
    trust = {x: float(seeded.get(x, 0)) for x in values}

    def rated():
        out = {}
        for (k, p), vs in graph.items():
            t = sum(trust[k, v] for v in vs)
            if t >= pii.SUPPORT:
                out[k, p] = (len(vs), t, t / (len(vs) + 1))
        return out

    for _ in range(pii.ROUNDS - 1):
        doubt = {}
        for (k, p), (_, _, score) in rated().items():
            for v in graph[k, p]:
                doubt[k, v] = doubt.get((k, v), 0) + math.log(1 - score)
        trust = {x: 1.0 if seeded.get(x) else 1 - math.exp(doubt.get(x, 0)) for x in trust}
    good = {}
    for (k, p), (n, t, score) in rated().items():
        share = min(max(t / n, 1e-9), 1 - 1e-9)
        ratio = 2 * n * (share * math.log(share / usual[k]) + (1 - share) * math.log((1 - share) / (1 - usual[k])))
        if score >= pii.CONFIDENT and share > usual[k] and ratio >= pii.EVIDENCE:
            good[k, p] = score
    best = {}
    for row, a, b, k, p, _ in others:
        if (k, p) in good:
            best.setdefault(row, {})[a, b] = max(best.get(row, {}).get((a, b), (0, 0)), (good[k, p], -k))
    out = []
    for row, spans in enumerate(bases):
        mine = best.get(row, {})
        kept = [
            (a, -k, b) for (a, b), (_, k) in mine.items()
            if not any(c < b and a < d and (d - c > b - a or d - c == b - a and c < a) for c, d in mine)
        ]
        out.append(sorted(spans + kept))
    return out


def test_spans_are_those_of_the_plain_method(spark):
    rows, _ = corpus()
    pick = random.Random(6)
    for i in range(60):
        rows.append((2000 + i, f"please call me at +1 212 555 {pick.randrange(1000, 9999)} today"))
        rows.append((3000 + i, f"{'w' * pick.randrange(200)} Email {i % 7}: n{i}.{'x' * i}@firma.de (since 20{i % 90 + 10})"))
    rows += [
        (7000, "my card number 4111 1111 1111 1112, thanks"), (7001, "please call me at (743) 555-3824 today"),
        (7002, "please call me at 020.7946.0959/12-34 today"), (7003, "Email 3: j\u00f6rg@firma 2 times"),
        (7004, "my card number 4111-1111-1111-1112 4111-1111-1111-1113 thanks"), *ODD, *((8000 + i, t) for i, t in enumerate(STRANGE)),
    ]
    want = plain_spans(rows)
    assert sum(len(w) for w in want) > sum(len(base(t)) for _, t, *_ in rows), "the method adds some"
    got = {}
    for r in pii.personal_data(documents(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append([tuple(s) for s in r.spans])
    for (doc_id, text, *_), spans in zip(rows, want, strict=True):
        assert spans in got[doc_id], repr(text)[:100]


def test_a_text_of_many_numbers(spark):
    pick = random.Random(2)
    text = " ".join(f"{pick.randrange(10**6)} {pick.randrange(1000)}-{pick.randrange(10**7)}," for _ in range(10_000))
    began = time.time()
    row = pii.personal_data(documents(spark, [(1, text), (2, "call +1 212 555 1234")])).where("doc_id = 1").first()
    assert [tuple(s) for s in row.base] == base(text)
    assert time.time() - began < 90
