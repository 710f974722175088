"""Conversation repair against trying all edits."""

import hashlib
import random
import re
import time
from zlib import crc32

from tessera.llm import dialog_repair as D

SCHEMA = "conv_id long, turn long, role string, text string"


def all_repairs(initials, faults, budget):
    """(cost, audit, roles) of every sequence of edits up to a cost."""
    def go(i, cost, audit, out):
        if cost > budget:
            return
        if i == len(initials) and re.fullmatch("(s?(ua)+)?", out):
            yield cost, audit, out
        for r in "ua":
            yield from go(i, cost + 2, audit + "I", out + r)
        if i < len(initials):
            yield from go(i + 1, cost + 3, audit + "D", out)
            if faults[i] not in ("blank", "duplicate"):
                cut = faults[i] == "truncated"
                yield from go(i + 1, cost + cut, audit + "K", out + initials[i] if initials[i] else out + "?")
                for r in "ua":
                    yield from go(i + 1, cost + 2 + cut, audit + "R", out + r)
    return go(0, 0, "", "")


def test_lightest_is_the_least_of_all():
    deal = random.Random(5)
    for _ in range(400):
        n = deal.randint(0, 5)
        initials = [deal.choice("ssuuuaaax") for _ in range(n)]
        faults = [deal.choice(["", "", "", "blank", "duplicate", "truncated"]) for _ in range(n)]
        cost, edits = D.lightest(initials, faults)
        want = min((c, a) for c, a, _ in all_repairs(initials, faults, cost))
        assert (cost, "".join(e for e, _ in edits)) == want
        rows = D.apply_edits([({"s": "system", "u": "user", "a": "assistant"}.get(i, i), "t") for i in initials], edits)
        assert re.fullmatch("(s?(ua)+)?", "".join(role[:1] for role, _ in rows))


def test_prefix_ties_take_the_least_initials():
    # "D..." beats "I..." and "K..." at equal cost
    assert D.lightest(["a"], [""]) == (2, [("I", "u"), ("K", None)])
    assert D.lightest(["u"], [""]) == (2, [("K", None), ("I", "a")])
    assert D.lightest(["s"], [""]) == (3, [("D", None)])
    assert D.lightest([""], [""])[0] == 3
    assert D.lightest([], []) == (0, [])


ODD = [
    (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (2, 5, "user", "Cut"), (2, 9, "assistant", " \t\n"),
    (3, 0, "user", "Same."), (3, 1, "user", "Same."), (3, 2, "assistant", "Ok!"), (4, None, "system", "S."),
    (4, None, "user", "U?"), (4, 3, "assistant", "A."), (5, 0, None, None), (5, 1, "", "x."), (6, 1, "user", ""),
    (None, 0, "user", "N."), (None, 0, "assistant", "M. "), (7, 0, "assistant", "B."), (7, 0, "user", "B."),
    (8, 0, "user", "long " * 300_000), (8, 1, "assistant", "End." * 100_000)]


def by_hand(rows):
    """Everything but cost, audit and repair, from the contract's words."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or " ",
                                                                           r[2] or " "))
        own = [(t, role if role is not None else " ", text if text is not None else " ") for t, role, text in own]
        turns = {t for t, _, _ in own if t is not None}
        count = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for k, (_, role, text) in enumerate(own):
            if not re.search(r"[^\x20\x09-\x0D]", text):
                count["blank"] += 1
            elif (role, text) in [r[1:] for r in own[:k]]:
                count["duplicate"] += 1
            elif not re.search(r"[.!?][\x20\x09-\x0D]*\Z", text):
                count["truncated"] += 1
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *count.values(), illegal)
    return out


def test_odd_rows(spark):
    given = spark.createDataFrame(ODD, SCHEMA).selectExpr("*", "'x' AS cost", "1 AS present", "2 AS _kind")
    got = {r["conv_id"]: r for r in D.repair(given).collect()}
    assert {c: tuple(r)[1:6] for c, r in got.items()} == by_hand(ODD)
    lines = {c: [tuple(x) for x in r["repaired"]] for c, r in got.items()}
    assert (got[1]["cost"], got[1]["audit"], lines[1]) == (0, "KK", [("user", "Hi."), ("assistant", "Yes.")])
    assert (got[2]["cost"], got[2]["audit"]) == (6, "DD") and got[2]["gaps"] == 3 and lines[2] == []
    assert (got[3]["cost"], got[3]["audit"]) == (3, "KDK")
    assert (got[4]["cost"], got[4]["audit"], got[4]["gaps"]) == (0, "KKK", 0)
    assert (got[6]["cost"], got[6]["audit"], lines[6]) == (3, "D", [])
    assert lines[8][0] == ("user", "long " * 300_000) and got[8]["audit"] == "KK" and got[8]["cost"] == 1
    assert D.repair(spark.createDataFrame([], SCHEMA)).count() == 0
    assert D.repair_digest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_damage_and_digest(spark):
    rows = ODD[:-2] + [(c, t, ("user", "assistant")[t % 2], f"Text {t}. And!") for c in range(20, 120) for t in range(6)]
    blank = lambda x: " " if x is None else str(x)
    damaged = []
    for conv, turn, role, text in rows:
        kind = crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = "user" if kind == 4 else blank(role), "" if kind == 1 else blank(text)
        text = re.sub("[.!?]", "", text) if kind == 2 else text
        damaged += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    want, sizes = by_hand(damaged), {r[0] for r in rows}
    got = {r["conv_id"]: r for r in D.repair_digest(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got) == sizes
    for conv, r in got.items():
        assert tuple(r)[1:6] == want.get(conv, (0, 0, 0, 0, 0))
        own = sorted((x[1:] for x in damaged if x[0] == conv), key=lambda x: (x[0] is not None, x[0] or 0, x[1:]))
        said = [x[1:] for x in own]
        fixed = D.apply_edits(said, D.lightest([s[0][:1] for s in said], D.faults_of(said))[1])
        digest = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in fixed).encode()).hexdigest()
        assert r["repaired_sha256"] == digest and len(r["audit"]) >= len(own)


def test_a_conversation_without_rows_left(spark):
    conv = next(c for c in range(10_000) if crc32(f"{c}:0".encode()) % 20 == 0)
    r = D.repair_digest(spark.createDataFrame([(conv, 0, "user", "x.")], SCHEMA)).collect()
    assert tuple(r[0]) == (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_long_conversation():
    n, deal = 20_000, random.Random(1)
    initials = [deal.choice("sua") for _ in range(n)]
    start = time.time()
    cost, edits = D.lightest(initials, [deal.choice(["", "blank", "truncated"]) for _ in range(n)])
    assert cost > 0 and sum(e != "I" for e, _ in edits) == n and time.time() - start < 20
