"""Slow, plain versions of operators to compare with."""

import hashlib
import heapq
import re
import zlib

BLANK = " \t\n\x0b\x0c\r"


def damage(rows):
    """Rows (conv, turn, role, text) with the query's faults put in."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h == 1:
            text = ""
        if h == 2:
            text = re.sub("[.!?]", "", text)
        if h == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return out


def repaired(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit and digest of one conversation's rows, by uniform-cost search."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    faults, seen = [], set()
    for _, _, role, text in rows:
        kept = text.rstrip(BLANK)
        faults.append("blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [r[1] for r in rows if r[1] is not None]
    initials = [r[2][:1] for r in rows]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    todo, done = [(0, "", 0, "", ())], {}
    while True:
        cost, audit, i, last, lines = heapq.heappop(todo)
        if i == len(rows) and last in ("", "a"):
            break
        if done.get((i, last), (1 << 60, "")) <= (cost, audit):
            continue
        done[i, last] = (cost, audit)
        for x in follows[last]:
            if x in names:
                heapq.heappush(todo, (cost + 3, audit + "I", i, x, (*lines, f"{names[x]}:")))
        if i < len(rows):
            _, _, role, text = rows[i]
            heapq.heappush(todo, (cost + 4, audit + "D", i + 1, last, lines))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 if faults[i] else 0
                for x in follows[last]:
                    if role[:1] == x:
                        heapq.heappush(todo, (cost + more, audit + "K", i + 1, x, (*lines, f"{role}:{text}")))
                    if x in names:
                        heapq.heappush(todo, (cost + 3 + more, audit + "R", i + 1, x, (*lines, f"{names[x]}:{text}")))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
