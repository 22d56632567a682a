"""Conversation repair against a search over all edits, on rows read one by one."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from trackline.llm import turn_repair
from trackline.llm.turn_repair import damaged, repair_report, repaired_turns

SCHEMA = "conv_id long, turn long, role string, text string, gaps string"
WORDS = ["Yes.", "No", "ok", "Why?", "", " \t", "ok.", "Well!\n", "a b"]


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role or (" " if role is None else ""), text or (" " if text is None else "")
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [(conv, turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, repaired) by trying every edit; rows are (role, text, fault)."""
    @cache
    def best(i, state, run):
        options = [(0, "", ())] if i == len(rows) and state in "0a" else []
        due = "a" if state == "u" else "u"
        full = {"u": "user", "a": "assistant"}[due]
        if run < 4:
            c, s, r = best(i, due, run + 1)
            options.append((c + 5, "I" + s, ((full, ""), *r)))
        if i < len(rows):
            role, text, fault = rows[i]
            c, s, r = best(i + 1, state, 0)
            options.append((c + 2, "D" + s, r))
            if fault in (None, "truncated"):
                extra = 5 if fault else 0
                for to in [due] + (["s"] if state == "0" else []):
                    if role[:1] == to:
                        c, s, r = best(i + 1, to, 0)
                        options.append((c + extra, "K" + s, ((role, text), *r)))
                c, s, r = best(i + 1, due, 0)
                options.append((c + extra + 1, "R" + s, ((full, text), *r)))
        return min(options, key=lambda o: o[:2], default=(10 ** 9, "", ()))
    return best(0, "0", 0)


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        out[conv] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    by = {}
    for conv, turn, role, text in damage(rows):
        by.setdefault(conv, []).append((turn is not None, turn, role, hashlib.md5(text.encode()).hexdigest(), text))
    for conv, got in by.items():
        got.sort(key=lambda r: (r[0], r[1] or 0, r[2], r[3]))
        seen, marked = set(), []
        for *_, role, _, text in got:
            shown = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = {t for _, t, *_ in got if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        n = lambda f: sum(m[2] == f for m in marked)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:], strict=False))
        cost, audit, kept = cheapest(tuple(marked))
        text = "\n".join(f"{r}:{t}" for r, t in kept)
        out[conv] = (gaps, n("blank"), n("duplicate"), n("truncated"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def conversations(rng, n):
    rows = []
    for c in range(n):
        for t in range(rng.choice([0, 1, 2, 4, 8, 12])):
            turn = None if rng.random() < 0.03 else t * rng.choice([1, 1, 1, 2])
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "System", None, ""])
            rows.append((c, turn, role, rng.choice(WORDS) if rng.random() < 0.6 else f"{rng.random()}."))
    rows += [(None, 0, "user", "Hi."), (None, None, None, None), (7_000, 0, "user", "Long " * 50_000), (7_000, 0, "user", "Long " * 50_000)]
    return rows


@pytest.mark.parametrize("block", [1024, 3])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(turn_repair, "BLOCK", block)
    rows = conversations(random.Random(block), 250)
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(5)
    got = {r[0]: tuple(r)[1:] for r in repair_report(damaged(df), df.select("conv_id")).collect()}
    assert got == brute(rows)


def test_repaired_turns_follow_the_grammar(spark):
    rows = conversations(random.Random(5), 60)
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    by = {}
    for r in repaired_turns(df).collect():
        by.setdefault(r["conv_id"], []).append((r["place"], r["role"], r["edit"]))
    for got in by.values():
        got.sort()
        assert [p for p, *_ in got] == list(range(len(got)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for _, r, _ in got))


def test_long_conversation_and_empty_table(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"t{t}.") for t in range(5000)]
    r = repair_report(spark.createDataFrame([(*x, "x") for x in rows], SCHEMA)).collect()
    whole = "\n".join(f"{a}:{b}" for _, _, a, b in rows)
    assert [tuple(x) for x in r] == [(1, 0, 0, 0, 0, 0, 0, "K" * 5000, hashlib.sha256(whole.encode()).hexdigest())]
    none = spark.createDataFrame([], SCHEMA)
    assert repair_report(damaged(none), none.select("conv_id")).count() == 0
