"""Plain Python versions of what the operators must return; no hashing, no Spark."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str | None) -> str:
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def groups(docs: list[tuple], size: int, num: int, den: int) -> dict[int, tuple[int, int]]:
    """doc_id -> (shingles, component) for (doc_id, text)."""
    sets = []
    for _, text in docs:
        w = BLANK.findall(lower(text))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (doc_id, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return {doc_id: (len(sets[i]), least[find(i)]) for i, (doc_id, _) in enumerate(docs)}


def contamination(docs: list[tuple], items: list[tuple], size: int = 13) -> list[tuple]:
    wins = []
    for item, text in items:
        w = ALNUM.findall(lower(text))
        wins += [(str(item), w[i : i + size]) for i in range(max(len(w) - size + 1, 1 if w else 0))]
    out = []
    for doc_id, text in docs:
        w = ALNUM.findall(lower(text))
        hit, found = set(), set()
        for item, win in wins:
            for i in range(len(w) - len(win) + 1):
                if w[i : i + len(win)] == win:
                    hit.update(range(i, i + len(win)))
                    found.add(item)
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def language_model(docs: list[tuple], mu: float) -> list[tuple]:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base, model) with exact counts."""
    held = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in docs]
    tokens = [BLANK.findall(lower(t)) + [None] for _, t in docs]
    one, two = Counter(), Counter()
    for out, t in zip(held, tokens):
        if not out:
            one.update(t)
            two.update(zip(["<s>", *t], t))
    n, types = sum(one.values()), len(one)
    share = lambda w: (one[w] + 0.1) / (n + 0.1 * (types + 1))
    rows = []
    for (i, _), out, t in zip(docs, held, tokens):
        model = sum(math.log10((two[v, w] + mu * share(w)) / ((one[None] if k == 0 else one[v]) + mu)) for k, (v, w) in enumerate(zip(["<s>", *t], t)))
        rows.append((i, out, len(t), sum(one[w] > 0 for w in t), n, sum(math.log10(share(w)) for w in t), model))
    return rows


KINDS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def personal(text: str | None) -> list[str]:
    def good(kind, s):
        digits = [int(c) for c in s if c.isdigit()]
        if kind == "ip":
            return all(int(p) <= 255 for p in s.split("."))
        if kind == "card":
            return 13 <= len(digits) <= 19 and sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    return [f"{k}:{m.start()}:{m.end()}" for k, p in KINDS.items() for m in p.finditer(text or "") if good(k, m[0])]


def targets(sizes: dict, share: float = 1.5, limit: float = 2.0) -> dict:
    """Targets of sources by sharing what is too much again and again."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    rest, free, out = share * sum(sizes.values()), set(order), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / total > limit * sizes[s]]
        if not over:
            return out | {s: rest * weight[s] / total for s in free}
        for s in over:
            out[s] = limit * sizes[s]
            free.discard(s)
        rest = share * sum(sizes.values()) - sum(out.values())
    return out


def shared_passages(a: str, b: str, words: int) -> bool:
    """Whether two texts share a run of ``words`` words."""
    x, y = BLANK.findall(lower(a)), BLANK.findall(lower(b))
    runs = {tuple(x[i : i + words]) for i in range(len(x) - words + 1)}
    return any(tuple(y[i : i + words]) in runs for i in range(len(y) - words + 1))


def damaged(rows: list[tuple]) -> dict:
    """conv_id -> its rows (turn, role, text) after damage, in order."""
    out: dict = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if how:
            row = (turn, "user" if how == 4 else role, "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text)
            own += [row] * (2 if how == 3 else 1)
    for own in out.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.md5(r[2].encode()).hexdigest()))
    return out


def faults(rows: list[tuple]) -> list[str]:
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\r\x0b\x0c")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def repair(rows: list[tuple]) -> dict:
    """The numbers, the audit and the digest of one conversation: all edit sequences, cheapest first, then least by ASCII (uniform-cost search)."""
    import heapq

    fault = faults(rows)
    grammar = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    names = {"u": "user", "a": "assistant"}
    queue, done = [(0, "", 0, "")], set()
    while True:
        cost, audit, i, state = heapq.heappop(queue)
        if i == len(rows) and state in ("", "a"):
            break
        if (i, state) in done:
            continue
        done.add((i, state))
        fits = "a" if state == "u" else "u"
        heapq.heappush(queue, (cost + 3, audit + "I", i, fits))
        if i < len(rows):
            heapq.heappush(queue, (cost + 4, audit + "D", i + 1, state))
            if fault[i] not in ("blank", "duplicate"):
                more = 3 * (fault[i] == "truncated")
                heapq.heappush(queue, (cost + 3 + more, audit + "R", i + 1, fits))
                if rows[i][1][:1] in grammar[state]:
                    heapq.heappush(queue, (cost + more, audit + "K", i + 1, rows[i][1][0]))
    lines, i, state = [], 0, ""
    for edit in audit:
        fits = "a" if state == "u" else "u"
        role, text = ("", "") if edit == "I" else rows[i][1:]
        i += edit != "I"
        if edit != "D":
            state = role[0] if edit == "K" else fits
            lines.append(f"{role if edit == 'K' else names[fits]}:{text}")
    turns = [r[0] for r in rows if r[0] is not None]
    pairs = [(a[1][:1], b[1][:1]) for a, b in zip(rows, rows[1:])]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, **{k: fault.count(k) for k in ("blank", "duplicate", "truncated")},
        "illegal": sum("".join(p) not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def collocations(docs: list[tuple], least: int, longest: int, share: int, top: int) -> list[tuple]:
    """(lang, rank, phrase, a, l, r, n, score) for (lang, text)."""
    counts: dict[str, Counter] = {}
    for lang, text in docs:
        own = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            own.update(tuple(w[i : i + m]) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    out = []
    for lang, own in counts.items():
        cands = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cands.items():
            if any(100 * b >= share * a for q, b in cands.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))):
                continue
            score, k = min((1000000 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        n = sum(a for p, a in own.items() if len(p) == 1)
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])]
    return out
