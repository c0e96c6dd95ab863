"""Personal data against Python's regular expressions and a plain bootstrapping loop, written from the rules."""

import hashlib
import random
import re
from collections import defaultdict

from hirelake.llm import personal_data, queries

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SCHEMA = "doc_id long, text string"


def holds(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    found = [(m.start(), i, m.end(), k) for i, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if holds(k, m[0])]
    return [(a, b, k) for a, _, b, k in sorted(found)]


def found(df):
    return sorted(((r["doc_id"], tuple((s["start"], s["end"], s["kind"]) for s in r["spans"])) for r in df.collect()), key=repr)


def bootstrapped(rows):
    """Further spans of each row, by the rules of the operator's docstrings."""
    word, space = r"[^\x20\x09-\x0D]", r"[\x20\x09-\x0D]"
    plain = r"[^\x20\x09-\x0D0-9@]*[0-9@][^\x20\x09-\x0D]*"
    everywhere, slots = defaultdict(int), []
    for n, (_, text) in enumerate(rows):
        text = text or ""
        words = [w for w in re.split(f"{space}+", text.lower()) if w]
        for a, b, c in zip(words, words[1:], words[2:]):
            everywhere["b", a, b] += 1
            everywhere["a", a, c] += 1
        spans, last = {(a, b): k for a, b, k in base(text)}, 0
        matches = list(re.finditer(rf"(?<!{word}){plain}(?:\x20{plain})*", text))
        for m, following in zip(matches, [*matches[1:], None]):
            before, after = text[last : m.start()], text[m.end() : following.start() if following else None]
            last = m.end()
            lead = re.match(r"(?:(?![^\W_]|[0-9@+]).)*", m[0], re.S)[0]
            own = re.sub(r"(?<=[^\W_])(?:(?![^\W_]).)+\Z", "", m[0][len(lead) :], flags=re.S)
            if len(own) > 128 or (len(re.sub("[^0-9]", "", own)) < 4 and not re.search(r"[^\W_]@[^\W_]", own)):
                continue
            start = m.start() + len(lead)
            two = re.search(rf"(?<!{word})({word}+){space}+({word}+){space}+\Z", before.lower())
            one = re.search(rf"(?<!{word})({word}+){space}+\Z", before.lower())
            right = re.match(rf"{space}+({word}+)", after.lower())
            contexts = [("b", two[1], two[2])] if two else []
            contexts += [("a", one[1], right[1])] if one and right else []
            slots.append((n, start, start + len(own), own.lower(), spans.get((start, start + len(own))), contexts))
    edges = defaultdict(int)
    for _, _, _, own, kind, contexts in slots:
        for c in contexts:
            edges[own, kind, c] += 1
            everywhere[c] += 1 if " " in own and c[0] == "a" else 0
    different = defaultdict(set)
    for own, _, c in edges:
        different[c].add(own)
    edges = {e: n for e, n in edges.items() if len(different[e[2]]) >= 3}
    seeds = {(own, kind): 1.0 for own, kind, _ in edges if kind}
    trusted, contexts = dict(seeds), {}
    for _ in range(4):
        held, weight = defaultdict(set), defaultdict(float)
        for (own, _, c), n in edges.items():
            for (other, kind), score in trusted.items():
                if other == own:
                    held[c, kind].add(own)
                    weight[c, kind] += n * score
        contexts = {x: min(1.0, weight[x] / max(1, everywhere[x[0]])) for x in held if len(held[x]) >= 3}
        contexts = {x: s for x, s in contexts.items() if s >= 0.8}
        doubt = defaultdict(lambda: 1.0)
        for own, kind, c in edges:
            for (context, k), score in contexts.items():
                if kind is None and context == c:
                    doubt[own, k] *= max(1 - score, 1e-9)
        scored = {x: 1 - d for x, d in doubt.items() if 1 - d >= 0.8}
        best = {}
        for (own, k), s in scored.items():
            best[own] = max(best.get(own, (0, "")), (s, k))
        now = {**seeds, **{(own, k): s for own, (s, k) in best.items()}}
        if len(now) == len(trusted):
            break
        trusted = now
    trusted = now
    out = defaultdict(set)
    for n, start, end, own, kind, own_contexts in slots:
        for c in own_contexts:
            for (context, k), _ in contexts.items():
                if kind is None and context == c and (own, k) in trusted:
                    out[n].add((start, 5 + list(PATTERNS).index(k), end, f"context_{k}"))
    return out


def expected(rows):
    further = bootstrapped(rows)
    order = list(PATTERNS)
    out = []
    for n, (doc, text) in enumerate(rows):
        own = [(a, order.index(k) + 1, b, k) for a, b, k in base(text)]
        out.append((doc, tuple((a, b, k) for a, _, b, k in sorted([*own, *further[n]]))))
    return sorted(out, key=repr)


PIECES = [
    "a.b@c.d.e", "a@b", "x@y..z", "a@b@c.de", "u_v@w-x.yz_q@r.st", "1.2.3.4.5.6.7.8", "256.1.1.1", "0255.000.1.9", "1.2.3", "4111 1111 1111 1111",
    "4111-1111-1111-1112", "4111  1111", "+49 (30) 1234-567", "+1", "+1 (743) 555-3824.", "++123456789", "+1234567890123456", "5555555555554444", "é+12.345.678.9",
    "🙂", "日本1234567890128", "....", "%%@%%", "word", "Word,", "\n", "\t", "\x1c", "0" * 40, "12-34-56-78-90-12-8", "9 " * 30,
]


def test_base_kinds_equal_python(spark, odd):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice(PIECES) + rng.choice(["", " ", " ", "-", "."]) for _ in range(rng.randint(1, 25)))) for i in range(400)]
    rows += [(r["doc_id"], r["text"]) for r in odd.collect()] + [(None, "a@b.cd"), (None, "a@b.cd"), (1, None)]
    assert found(personal_data.find(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


def test_query_on_a_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    joined = lambda spans: ",".join(f"{k}:{a}:{b}" for a, b, k in spans)
    want = []
    for doc, spans in expected(rows):
        own = [s for s in spans if s[2] in PATTERNS]
        counts = [sum(s[2] == k for s in own) for k in PATTERNS]
        want.append((doc, *counts, hashlib.sha256(joined(own).encode()).hexdigest(), joined(spans)))
    got = [tuple(r) for r in queries.QUERIES["op12_personal_data"](spark, folder).collect()]
    assert sorted(got) == sorted(want)


def test_contexts_discover_unseen_identifiers(spark):
    rows = [(i, f"Please ring helpline +49 30 12345{i:02d} during office hours{i}") for i in range(20)]
    rows += [(50, "Please ring helpline 030 9876543 during the day"), (51, "my desk line: 030 9876543 answers"), (52, "my desk line: +1 (743) 555-3824 answers")]
    rows += [(53, "my desk line: 040 777 8888 answers"), (54, "my desk line: +44 20 7946 0958 answers"), (55, "code 4711 9999 is no number"), (56, "nothing at all")]
    rows += [(57, "the year 2020 was"), (58, "the year +49 30 1111111 was"), (59, "the year of nothing")]
    rows += [(80 + i, f"my desk line: +44 20 7946 095{i} answers") for i in (1, 2)] + [(60 + i, "the year that was") for i in range(9)]
    got = dict(found(personal_data.find(spark.createDataFrame(rows, SCHEMA))))
    assert found(personal_data.find(spark.createDataFrame(rows, SCHEMA))) == expected(rows)
    assert [k for _, _, k in got[50]] == ["context_phone"] and rows[20][1][21:32] == "030 9876543" and got[50][0][:2] == (21, 32)
    assert [k for _, _, k in got[51]] == ["context_phone"]
    assert [k for _, _, k in got[53]] == ["context_phone"]  # by a context that the identifier of another one has made certain
    assert got[55] == got[56] == got[57] == ()


def test_long_runs_end_soon_and_without_deep_recursion(spark):
    rows = [(1, "a" * 300_000), (2, "1." * 150_000), (3, "12 " * 100_000), (4, "+1" + " " * 200_000), (5, "a@b" + ".c" * 100_000), (6, "1" + "%" * 200_000 + "x"), (7, "x@" * 100_000)]
    got = dict(found(personal_data.find(spark.createDataFrame(rows, SCHEMA))))
    assert got[1] == got[3] == got[4] == got[6] == got[7] == () and len(got[2]) == 150_000 // 4 and got[5] == ((0, 200_003, "email"),)


def test_empty_table_and_clashing_columns(spark):
    assert personal_data.find(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, "mail a@b.cd now"), (1, "none"), (1, "mail a@b.cd now"), (None, None)]
    clashing = spark.createDataFrame([(*r, 1, "x", [1], "y") for r in rows], SCHEMA + ", key long, email string, slots array<int>, spans string")
    assert found(personal_data.find(clashing)) == expected(rows)


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "x")], SCHEMA).coalesce(1)
    plan = personal_data.occurrences(personal_data.scanned(docs))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
