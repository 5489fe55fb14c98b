import hashlib
import random
import zlib

import numpy as np
import pytest
from llm_texts import prose

from asterlap.llm import conversation_repair as C
from asterlap.llm.block_tables import ENDS, INSERT, after_given, moves, tables

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, seq long, chunk int, copies string, symbol int, letters string, said string"


def cheapest(symbols):
    """(cost, letters) by dynamic programming over whole strings; a symbol is None for rows that must go."""
    def inserted(best):
        for _ in range(4):
            for s in list(best):
                cost, letters = best[s]
                n = after_given(s)
                best[n] = min(best.get(n, (10**9, "")), (cost + INSERT, letters + "I"))
        return best

    best = inserted({0: (0, "")})
    for x in symbols:
        then = {}
        for s, (cost, letters) in best.items():
            for letter, c, n, _ in [("D", 2, s, "")] if x is None else moves(s, x):
                then[n] = min(then.get(n, (10**9, "")), (cost + c, letters + letter))
        best = inserted(then)
    return min(best[s] for s in ENDS if s in best)


def brute(rows):
    """The contract, row by row."""
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        said = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        role, text = said(role), said(text)
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        role = "user" if kind == 4 else role
        mine += [] if kind == 0 else [(turn, role, text)] * (1 + (kind == 3))
    return {conv: digest(sorted(mine, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))) for conv, mine in out.items()}


def digest(rows):
    seen, symbols, counts = set(), [], [0, 0, 0]
    for _, role, text in rows:
        body = text.rstrip(SPACE)
        fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        initial = "sua".find(role[:1]) if role else -1
        symbols.append(None if fault in (0, 1) else (initial if initial >= 0 else 3) + 4 * (fault == 2))
    cost, audit = cheapest(symbols)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = zip(rows, rows[1:])
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs)
    said, state, k = [], 0, 0
    for letter in audit:
        if letter == "I":
            said.append(("user:", "assistant:")[state == 2])
            state = after_given(state)
            continue
        _, role, text = rows[k]
        k += 1
        if letter == "K":
            said.append(role + ":" + text)
            state = next(n for x, _, n, _ in moves(state, symbols[k - 1]) if x == "K")
        elif letter == "R":
            said.append(("user:", "assistant:")[state == 2] + text)
            state = after_given(state)
    return gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest()


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 7, 7, "c", 7, "l", "s") for r in rows], SCHEMA)


def query(spark, tmp_path, rows):
    folder = str(tmp_path)
    conversations(spark, rows).write.parquet(f"{folder}/conversations.parquet")
    found = C.op11_conversation_repair(spark, folder).collect()
    got = {r.conv_id: tuple(r)[1:] for r in found}
    assert len(got) == len(found)
    return got


def some(seed, n):
    rng = random.Random(seed)
    texts = [None, "", " \t", "no end", "Ends.", "Asks? \n", *(prose(i, 5) + rng.choice([".", ""]) for i in range(n))]
    roles = ["user", "assistant", "system", "tool", "", None, "assistant", "user", "User"]
    return [rng.choice(texts) for _ in range(n)], [rng.choice(roles) for _ in range(n)]


@pytest.mark.parametrize("chunk_bits", [14, 2])
def test_against_brute_force(spark, tmp_path, monkeypatch, chunk_bits):
    monkeypatch.setattr(C, "CHUNK_BITS", chunk_bits)
    rng, rows = random.Random(3), []
    for conv in [None, *range(60)]:
        n = rng.randint(1, 14)
        texts, roles = some(conv or 99, n)
        turns = [None if rng.random() < 0.1 else rng.randint(0, 12) for _ in range(n)]
        rows += [(conv, *r) for r in zip(turns, roles, texts)]
    rows += [(70, 1, "user", "Same.")] * 40 + [(71, None, None, None)] * 3 + rows[:20] + [(72, 5, "user", prose(1, 30_000))]
    n = 400  # one long conversation: a hundred chunks of four rows
    texts, roles = some(5, n)
    rows += [(80, i, r, t) for i, (r, t) in enumerate(zip(roles, texts))]
    rng.shuffle(rows)
    got, want = query(spark, tmp_path, rows), brute(rows)
    assert got == want
    assert any("R" in r[6] for r in want.values()) and len(want[80][6]) > 390


def test_conversations_without_rows_left(spark, tmp_path):
    dropped = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    assert query(spark, tmp_path, [(1, dropped, "user", "Hello.")]) == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_empty_table(spark, tmp_path):
    assert query(spark, tmp_path, []) == {}


def test_repaired_rows_are_what_is_hashed(spark, rows):
    data = [(c, t, r, x, 1) for c in range(30) for t, (x, r) in enumerate(zip(*some(c, 9)))]
    df = spark.createDataFrame([(c, t, r or " ", x or " ", n) for c, t, r, x, n in data], "conv_id long, turn long, role string, text string, copies long")
    edited = C.edits(C.judged(df))
    said = {}
    for r in sorted(C.repaired(edited).collect(), key=lambda r: (r.conv_id, r.seq, r.place)):
        said.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in C.digests(edited).collect():
        assert hashlib.sha256("\n".join(said.get(r.conv_id, [])).encode()).hexdigest() == r.repaired_sha256


def test_tables_against_strings():
    rng = random.Random(1)
    for _ in range(500):
        symbols = [rng.randrange(8) for _ in range(rng.randrange(14))]
        traced, state = tables().trace(np.array(symbols, np.int64), 0, 0)
        vector, taken = tables().back(np.array(symbols, np.int64), 0)
        letters = "".join(x for x, _ in traced) + tables().last_inserts(state)[0]
        assert (tables().vectors[vector][0] + taken, letters) == cheapest(symbols)
