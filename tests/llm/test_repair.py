"""Conversation repair against an exhaustive search."""

import hashlib
import re
import zlib
from functools import cache

import numpy as np
import pytest

from skewlake.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, gone string, pack int, `a.b` string, cost string"
WORD = re.compile(r"[^\x20\x09-\x0D]")
TARGET = re.compile(r"(s?(ua)+)?")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(name.encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub(r"[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """rows: (initial, fault). The least of every way, with up to two insertions before each row and at the end."""

    def read(done, role):
        if role not in ("s", "u", "a") or not re.fullmatch(r"s?(ua)*u?", done + role):
            return None
        return {"s": "s", "u": "u", "a": "ua"}[role]

    @cache
    def best(i, done, run):
        found = [(0, "")] if i == len(rows) and TARGET.fullmatch(done) else []

        def go(cost, letter, i, done, run):
            rest = None if done is None else best(i, done, run)
            if rest:
                found.append((cost + rest[0], letter + rest[1]))

        if i < len(rows):
            initial, fault = rows[i]
            more = fault == "truncated"
            go(3, "D", i + 1, done, 0)
            if fault not in ("blank", "duplicate"):
                go(more, "K", i + 1, read(done, initial), 0)
                for r in "ua":
                    go(2 + more, "R", i + 1, read(done, r), 0)
        if run < 2:
            for r in "ua":
                go(2, "I", i, read(done, r), run + 1)
        return min(found, default=None)

    return best(0, "", 0)


def brute(original):
    out = []
    for conv in {r[0] for r in original}:
        rows = sorted((r[1:] for r in damage(original) if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in rows:
            kept = WORD.findall(text)
            faults.append("blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, _, _ in rows if t is not None]
        cost, audit = cheapest(tuple((r[1][:1], f) for r, f in zip(rows, faults, strict=True)))
        lines, at, roles = [], 0, ""
        for a in audit:
            role, text = ("", "") if a == "I" else rows[at][1:]
            at += a != "I"
            if a == "D":
                continue
            if a in "IR":
                role = "assistant" if roles.endswith("u") else "user"
            roles += role[0]
            lines.append(f"{role}:{text}")
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def made(seed, convs=60):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.integers(1, 9)):
            role = ["system", "user", "assistant", "tool", None, "", "usher"][rng.choice(7, p=[0.1, 0.4, 0.35, 0.05, 0.04, 0.03, 0.03])]
            text = ["Fine. Yes!", "cut off", "What?", "", " \t", None, f"t{rng.integers(99)}.", "é東京? "][rng.integers(8)]
            rows.append((c if c else None, None if rng.random() < 0.05 else int(t * rng.integers(1, 3)), role, text))
    return rows


@pytest.mark.parametrize(("seed", "options"), [(1, {}), (2, {"pack_bytes": 300}), (3, {"most": 4}), (4, {"most": 1})])
def test_equals_exhaustive_search(spark, monkeypatch, seed, options):
    if "most" in options:
        monkeypatch.setattr(repair, "PIECE", 3)
    rows = made(seed)
    df = spark.createDataFrame([(*r, "g", 1, "x", "c") for r in rows], SCHEMA).repartition(3)
    got = repair.repair(repair.damaged(df), **options)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_long_conversation_equals_whole(spark):
    """One conversation that holds most rows, in pieces over many tasks and as one."""
    rng = np.random.default_rng(9)
    rows = [(7, i, ["user", "assistant", "system"][rng.choice(3, p=[0.5, 0.45, 0.05])], f"text {rng.integers(2000)}" + "." * int(rng.integers(2))) for i in range(3000)]
    rows += [(8, 1, "user", "a.")]
    df = spark.createDataFrame([(*r, "g", 1, "x", "c") for r in rows], SCHEMA).repartition(5)
    whole, cut = (sorted(map(tuple, repair.repair(repair.damaged(df), most=m).collect())) for m in (10_000, 100))
    assert whole == cut and len(whole) == 2
    assert sum(whole[0][7].count(x) for x in "KRD") == len([r for r in damage(rows) if r[0] == 7])


def test_empty(spark):
    assert repair.op12_conversation_repair(spark.createDataFrame([], SCHEMA)).count() == 0
