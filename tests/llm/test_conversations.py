"""Repair of conversations against a plain search over all edits, written from the rules."""

import hashlib
import random
import re
import zlib

import pytest

from hirelake.llm import conversations, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub(r"[.!?]", "", text)
        if code == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out


def repaired(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, digest of one conversation's rows."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for _, t, r, x in rows]
    head = lambda r: (r[0] is not None, r[0] or 0, r[1][:64].encode(), r[2][:64].encode(), hashlib.sha256(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).hexdigest())
    rows = sorted(rows, key=head)
    faults, seen = [], set()
    for _, role, text in rows:
        end = re.search(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z", text)
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[1] not in ".!?" else "")
        seen.add((role, text))
    # all edits, row by row: the cheapest and ASCII-least letters for each sequence of roles so far that can still become a wanted one
    best = {"": (0, "", ())}

    def grown(roles):
        return bool(re.fullmatch(r"(s?(ua)*u?)?", roles))

    def short(roles):  # what may follow depends on this only
        return roles if roles in ("", "s") else roles[-1]

    def better(found, roles, way):
        k = short(roles)
        if grown(roles) and (k not in found or way[:2] < found[k][:2]):
            found[k] = way

    def inserts(found):
        for _ in range(3):
            for roles, (cost, letters, kept) in list(found.items()):
                for r in ("user", "assistant"):
                    better(found, follow(roles, r[0]), (cost + 5, letters + "I", (*kept, (r, ""))))
        return found

    def follow(roles, initial):
        last = {"": "", "s": "s", "u": "u", "a": "ua"}[roles]
        return last + initial

    for (_, role, text), fault in zip(rows, faults):
        new = {}
        for roles, (cost, letters, kept) in inserts(dict(best)).items():
            if short(roles) not in new or (cost + 2, letters + "D") < new[short(roles)][:2]:
                new[short(roles)] = (cost + 2, letters + "D", kept)
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault else 0
            if role[:1] in ("s", "u", "a"):
                better(new, follow(roles, role[0]), (cost + more, letters + "K", (*kept, (role, text))))
            for r in ("user", "assistant"):
                better(new, follow(roles, r[0]), (cost + 1 + more, letters + "R", (*kept, (r, text))))
        best = new
    cost, letters, kept = min((w for r, w in inserts(best).items() if r in ("", "a")), key=lambda w: w[:2])
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in kept).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, letters, digest)


def expected(rows, ids):
    return {c: repaired([r for r in rows if r[0] == c]) for c in ids}


def told(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[n] for n in names) for r in rows}


def made_up(seed, conversations_=60, longest=12):
    rng, rows = random.Random(seed), []
    for conv in [None, *range(conversations_)]:
        size = rng.randint(1, longest)
        for turn in range(size):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "usher", "", None, "User"])
            text = rng.choice(["Yes.", "No", "", None, " \t", "Yes.", "why?", "x" * 70 + ".", "x" * 70 + "!", "end. \n", "…", "a\x1c"])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None, -1]), role, text))
    return rows


@pytest.mark.parametrize("stretch", [3, 4096])
def test_equals_a_search_over_all_edits(spark, stretch):
    rows = made_up(stretch)
    got = told(conversations.repair(spark.createDataFrame(rows, SCHEMA), stretch=stretch))
    assert got == expected(rows, {r[0] for r in rows})


def test_query_equals_the_rules_on_a_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    ids = {r[0] for r in rows}
    assert told(queries.QUERIES["op11_conversation_repair"](spark, folder)) == expected(damaged(rows), ids)


def test_faults_put_in(spark):
    rows = [(c, t, r, x) for c in (1, None) for t in (*range(60), None) for r, x in (("assistant", "A. b!"), (None, None))]
    given = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(repr, map(tuple, conversations.damaged(given).collect()))) == sorted(map(repr, damaged(rows)))


def test_one_long_conversation_and_one_row_many_times(spark):
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["a.", "b.", f"c{t}.", f"d{t}"])) for t in range(900)]
    rows += [(2, 7, "user", "again.")] * 500 + [(2, 8, "assistant", "well.")] + [(3, 0, "user", "long " * 20000 + "."), (3, 1, "assistant", "x.")]
    got = told(conversations.repair(spark.createDataFrame(rows, SCHEMA), stretch=64))
    assert got == expected(rows, {1, 2, 3})


def test_empty_table_extra_columns_and_ids_without_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert conversations.repair(none).collect() == []
    ids = spark.createDataFrame([(5, 1), (None, 2), (5, 3)], "conv_id long, cost long")
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert told(conversations.repair(none, ids=ids)) == {5: nothing, None: nothing}
    rows = made_up(9, 10)
    clashing = spark.createDataFrame([(*r, 1, "x", "y", b"z", True) for r in rows], SCHEMA + ", place long, audit string, digest string, codes binary, first boolean")
    assert told(conversations.repair(clashing, ids=clashing)) == expected(rows, {r[0] for r in rows})


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "tool", "So."), (1, 3, "user", "End."), (None, None, "system", "s.")]
    given = spark.createDataFrame(rows, SCHEMA)
    _, audits = conversations.edits(conversations.classified(given))
    out = conversations.repaired(given, audits).orderBy("conv_id", "position").collect()
    assert [tuple(r) for r in out] == [(1, 0, "K", "user", "Hi."), (1, 1, "R", "assistant", "End.")]  # KDDR comes before KDRD
