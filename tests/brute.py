"""Plain-Python statements of the keyed rules. Rows are ``(id, key, ts, ...)``."""

from __future__ import annotations

from collections import defaultdict


def histories(rows):
    by_key = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[2], r[0])):
        by_key[row[1]].append(row)
    return by_key


def repaired(rows, seed_from_old=False):
    """``(id, key, ts, flag)`` -> {id: flag}."""
    out = {}
    for history in histories(rows).values():
        seen = False
        for i, _, _, flag in history:
            out[i] = "0" if flag == "1" and seen else flag
            seen = seen or flag == "1" or seed_from_old
    return out


def bounces(rows, within):
    """``(id, key, ts, entry)`` -> ids, by walking a pattern matcher event by event."""
    out = set()
    for history in histories(rows).values():
        open_entry = None
        for i, _, ts, entry in history:
            if open_entry is not None and (ts - open_entry[1] >= within or entry):
                out.add(open_entry[0])
            open_entry = (i, ts) if entry else None
        if open_entry is not None:
            out.add(open_entry[0])
    return out


def deltas(rows, threshold, baseline):
    """``(id, key, ts, value)`` -> {(id, last)}."""
    out = set()
    for history in histories(rows).values():
        last = None
        for i, _, _, value in history:
            if last is not None and abs(value - last) >= threshold:
                out.add((i, last))
            if last is None or baseline == "previous":
                last = value
    return out


def interval_pairs(left, right, lower, upper):
    """``(id, key, ts)`` lists -> id pairs."""
    return {(a[0], b[0]) for a in left for b in right if a[1] == b[1] and a[2] + lower <= b[2] <= a[2] + upper}


def sessions(rows, gap):
    """``(id, key, ts, ...)`` -> {(key, first, last, n)}."""
    out = []
    for key, history in histories(rows).items():
        part = [history[0]]
        for row in history[1:]:
            if row[2] - part[-1][2] > gap:
                out.append((key, part[0][2], part[-1][2], len(part)))
                part = []
            part.append(row)
        out.append((key, part[0][2], part[-1][2], len(part)))
    return set(out)
