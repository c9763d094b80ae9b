"""Personal data: patterns with checks, and a linear-chain conditional random field over word shapes.

The patterns give the base spans. The field adds what they miss (a card number written twice in a row, a phone number in
an unusual spelling): words are tagged B/I for each kind or O, scores are sums of weights of a word's shape features and of
tag transitions, and a line's best tags are found by Viterbi in numpy, many runs of words at once. An added span never overlaps a
base span.

Training: maximum likelihood with forward-backward on a small labelled table, the lines of ``EXAMPLES`` and lines of a bounded
sample of the documents that are labelled by the patterns. Lines whose labels the patterns leave in doubt are not used.

Decoding reads whole texts. A word without digit, ``@`` or ``+`` has the shape ``plain``, which the field holds to O. So a line falls into
independent runs of other words, and decoding these, with the transitions from and to their plain neighbours, is decoding the line.
A decoded span must pass its kind's check (Luhn, number of digits, parts of an address) as a base span must.

Null and empty texts have no spans; repeated rows get the same answer; an empty table still has the examples to train
on; extra columns stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.llm.common import BLANK

KINDS = ("email", "ip", "card", "phone")

# The patterns whose leftmost matches are checked, one after the other.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# A labelled table. What stands between [kind| and ] is such a span.
EXAMPLES = (
    "write to [email|jo.doe@example.org] or call [phone|+1 (212) 555-0187] today.",
    "mail [email|info@mail.example.com], phone [phone|+44 20 7946 0958].",
    "server [ip|10.0.12.7] answered [ip|192.168.4.25] again",
    "client 3 at [ip|8.8.4.4] sent 17 packets in 2.5 s",
    "card [card|4111 1111 1111 1111] was charged 25.00 on 2024-03-01",
    "cards [card|4111111111111111] [card|4111111111111111] on file",
    "paid with [card|5500-0000-0000-0004], order 20931",
    "[card|378282246310005] [card|378282246310005] are test numbers",
    "ring [phone|+49 30 901820] or [phone|+33 1 70 18 99 00]",
    "phone [phone|+1 (743) 555-3824] [phone|+1 (743) 555-3824] twice",
    "from [email|a_b@x.example] to [email|c.d+e@mail9.example.net] at 10:45",
    "version 1.2.3 of 2023 has 1200 pages, 3.14 and 42% of 1,000,000",
    "room 12, floor 3, 5th of May 1999, section 4.2.1, pp. 10-12",
    "a + b = 12 and c @ d costs 5 @ 3.20 each",
    "isbn 978-3-16-148410-0 and part 0042-A7 for 12.50",
    "build 20240229.1 took 00:12:33 with 8 cores and 16 GB",
    "chapter 7 verse 21 (1987), vol. 3, no. 4",
    "the temperature was -12.5 to +30 degrees, up 10%",
)
TAGS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _is_octet(digits: str) -> bool:
    """Whether digits are at most 255; of any length, with any zeros before them."""
    bare = digits.lstrip("0")
    return len(bare) <= 3 and int(bare or "0") <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain: a match begins where the run of local characters before an @ does."""
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(end, at + 1))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end (code points) of the checked matches of each pattern, by kind, then start."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text) is None:
        return out
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(map(_is_octet, m[0].split(".")))]
    for m in CARD.finditer(text):
        found = _digits(m[0])
        if 13 <= len(found) <= 19 and luhn(found):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def holds(kind: str, found: str) -> bool:
    """Whether a decoded span passes the check of its kind."""
    n = len(_digits(found))
    if kind == "card":
        return 13 <= n <= 19 and luhn(_digits(found))
    if kind == "phone":
        return 9 <= n <= 15
    if kind == "ip":
        parts = found.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and _is_octet(p) for p in parts)
    return "@" in found[1:-1] and "." in found.rpartition("@")[2]


# --- words, shapes, features ------------------------------------------------------------------------------------

_DIGIT = re.compile("[0-9]")
_SIGN = re.compile("[0-9@+]")
_WORD = re.compile(f"[^{re.escape(BLANK)}]+")
_PIECE = re.compile(r"[0-9]+|[^\W\d_]+|(.)\1*", re.S)


def _size(n: int) -> str:
    return str(n) if n <= 4 else "8" if n <= 8 else "12" if n <= 12 else "19" if n <= 19 else "20"


def shape(word: str) -> str:
    """Letters as ``x``, digits as ``d`` and how many, other characters once: ``plain`` without digit, @ and +."""
    if _SIGN.search(word) is None:
        return "plain"
    out = []
    for m in _PIECE.finditer(word):
        p = m[0]
        out.append(f"d{_size(len(p))}" if "0" <= p[0] <= "9" else "x" if p[0].isalpha() else p[0])
    return "".join(out)


def features(form: str, digits: int) -> list[str]:
    """Features of a word by its shape and its number of digits."""
    if form == "plain":
        return ["plain"]
    core = form.strip(".,;:!?\"'")
    return ["bias", f"shape={core[:40]}", f"digits={_size(digits)}", f"dots={min(core.count('.'), 4)}", f"at={'@' in core}", f"first={core[:1]}", f"letters={'x' in core}", f"dash={min(core.count('-'), 3)}"]


def word_features(word: str) -> tuple[str, ...]:
    return tuple(features(shape(word), len(_digits(word))))


@dataclass
class Field:
    """Weights of a trained field: ``emit[feature][tag]``, ``step[tag][tag]``, ``first[tag]``."""

    names: dict[str, int]
    emit: np.ndarray
    step: np.ndarray
    first: np.ndarray

    def scores(self, word: str) -> np.ndarray:
        """Score of each tag for a word that is not plain."""
        ids = [self.names[f] for f in word_features(word) if f in self.names]
        return self.emit[ids].sum(0)


def allowed() -> np.ndarray:
    """Transitions that may be: I only after B or I of its kind."""
    ok = np.ones((len(TAGS), len(TAGS)), bool)
    for j, tag in enumerate(TAGS):
        if tag[0] == "I":
            ok[:, j] = [t[2:] == tag[2:] for t in TAGS]
    return ok


FORBIDDEN = -30.0  # the score of what may not be


def train(lines: list[tuple[list[str], list[int]]], rounds: int = 80, rate: float = 0.2, decay: float = 2e-3) -> Field:
    """Fit a field to lines of words and tags by gradient steps on the mean log-likelihood."""
    names: dict[str, int] = {}
    for words, _ in lines:
        for w in words:
            for f in word_features(w):
                names.setdefault(f, len(names))
    width = 8
    longest, count, k = max(len(w) for w, _ in lines), len(lines), len(TAGS)
    ids = np.full((count, longest, width), len(names))
    tags = np.zeros((count, longest), int)
    length = np.array([len(w) for w, _ in lines])
    for i, (words, own) in enumerate(lines):
        tags[i, : len(own)] = own
        for j, w in enumerate(words):
            fs = [names[f] for f in word_features(w)]
            ids[i, j, : len(fs)] = fs
    inside = np.arange(longest) < length[:, None]
    held = np.zeros((count, longest, k))
    for i, (words, _) in enumerate(lines):
        held[i, [j for j, w in enumerate(words) if shape(w) == "plain"], 1:] = FORBIDDEN
    ok = allowed()
    emit, step, first = np.zeros((len(names) + 1, k)), np.zeros((k, k)), np.zeros(k)
    first_ok = np.array([t[0] != "I" for t in TAGS])
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (emit, step, first)]
    gold_step = np.zeros((k, k))
    pairs = inside[:, 1:]
    np.add.at(gold_step, (tags[:, :-1][pairs], tags[:, 1:][pairs]), 1)
    for r in range(1, rounds + 1):
        score = emit[ids].sum(2) + held
        trans = np.where(ok, step, FORBIDDEN)
        begin = np.where(first_ok, first, FORBIDDEN)
        alpha = np.empty((longest, count, k))
        beta = np.zeros((longest, count, k))
        alpha[0] = begin + score[:, 0]
        for t in range(1, longest):
            new = _logsum(alpha[t - 1][:, :, None] + trans, 1) + score[:, t]
            alpha[t] = np.where(inside[:, t, None], new, alpha[t - 1])
        for t in range(longest - 2, -1, -1):
            new = _logsum(trans + (score[:, t + 1] + beta[t + 1])[:, None, :], 2)
            beta[t] = np.where(inside[:, t + 1, None], new, 0)
        whole = _logsum(alpha[-1], 1)
        miss = np.exp(alpha + beta - whole[:, None]).transpose(1, 0, 2) * inside[:, :, None]
        np.subtract.at(miss, (*np.nonzero(inside), tags[inside]), 1)
        g_emit = np.zeros_like(emit)
        np.add.at(g_emit, ids.reshape(-1, width), np.repeat(miss.reshape(-1, 1, k), width, 1))
        g_emit[-1] = 0
        g_step = -gold_step.copy()
        for t in range(1, longest):
            both = np.exp(alpha[t - 1][:, :, None] + trans + (score[:, t] + beta[t])[:, None, :] - whole[:, None, None])
            g_step += (both * inside[:, t, None, None]).sum(0)
        for p, g, (m, v) in zip((emit, step, first), (g_emit, g_step * ok, miss[:, 0].sum(0) * first_ok), state):
            g = g / count + decay * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.99**r)) + 1e-8)
    return Field(names, emit[:-1], np.where(ok, step, FORBIDDEN), np.where(first_ok, first, FORBIDDEN))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def viterbi(field: Field, emissions: np.ndarray, after: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Best tags of runs of one length: ``emissions (runs, words, tags)``; whether a run follows, or is followed by, a plain word."""
    runs, words, _ = emissions.shape
    best = emissions[:, 0] + np.where(after[:, None], field.step[0], field.first)
    back = np.empty((words, runs, len(TAGS)), np.int8)
    for t in range(1, words):
        both = best[:, :, None] + field.step
        back[t] = both.argmax(1)
        best = both.max(1) + emissions[:, t]
    best = best + np.where(before[:, None], field.step[:, 0], 0.0)
    out = np.empty((runs, words), int)
    out[:, -1] = best.argmax(1)
    for t in range(words - 1, 0, -1):
        out[:, t - 1] = back[t][np.arange(runs), out[:, t]]
    return out


def _runs(text: str) -> Iterator[tuple[list[tuple[int, int]], bool, bool]]:
    """Runs of words that are not plain, as spans, and whether a plain word stands before and after in the line."""
    run: list[tuple[int, int]] = []
    end = 0

    def close(run):
        before = text[text.rfind("\n", 0, run[0][0]) + 1 : run[0][0]].strip(BLANK) != ""
        stop = text.find("\n", run[-1][1])
        return run, before, text[run[-1][1] : stop if stop >= 0 else len(text)].strip(BLANK) != ""

    for m in _SIGN.finditer(text):
        if m.start() < end:
            continue
        start = m.start()
        while start > end and text[start - 1] not in BLANK:
            start -= 1
        word = _WORD.match(text, start)
        gap = text[end:start]
        if run and (gap.strip(BLANK) or "\n" in gap):
            yield close(run)
            run = []
        end = word.end()
        run.append((start, end))
    if run:
        yield close(run)


def tagged_spans(texts: list[str], field: Field) -> list[list[tuple[str, int, int]]]:
    """Spans that the field finds in each text."""
    by_length: dict[int, list] = {}
    cache: dict[str, np.ndarray] = {}

    def score(word: str) -> np.ndarray:
        if word not in cache:
            if len(cache) > 100_000:
                cache.clear()
            cache[word] = field.scores(word)
        return cache[word]

    for i, text in enumerate(texts):
        for run, after, before in _runs(text):
            by_length.setdefault(len(run), []).append((i, run, after, before))
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    for length, runs in by_length.items():
        group = max(1, 20_000 // length)
        for a in range(0, len(runs), group):
            some = runs[a : a + group]
            emissions = np.array([[score(texts[i][s:e]) for s, e in run] for i, run, _, _ in some])
            tags = viterbi(field, emissions, np.array([r[2] for r in some]), np.array([r[3] for r in some]))
            for (i, run, _, _), own in zip(some, tags):
                j = 0
                while j < length:
                    tag, k = TAGS[own[j]], j + 1
                    if tag != "O":
                        while k < length and TAGS[own[k]] == f"I-{tag[2:]}":
                            k += 1
                        s, e = run[j][0], run[k - 1][1]
                        while e > s and not texts[i][e - 1].isalnum():
                            e -= 1
                        while s < e and not (texts[i][s].isalnum() or texts[i][s] in "+("):
                            s += 1
                        if s < e and holds(tag[2:], texts[i][s:e]):
                            out[i].append((tag[2:], s, e))
                    j = k
    return out


def all_spans(texts: list[str], field: Field) -> list[tuple[list, list]]:
    """Base spans and all spans of each text, by kind, then start."""
    out = []
    for text, extra in zip(texts, tagged_spans(texts, field)):
        base = base_spans(text)
        # Spans of both lists are few; what overlaps a base span is not added.
        new = [x for x in extra if not any(x[1] < b[2] and b[1] < x[2] for b in base)] if base else extra
        out.append((base, sorted(base + new, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))))
    return out


# --- training table and Spark side ------------------------------------------------------------------------------


def examples() -> list[tuple[str, list[tuple[str, int, int]]]]:
    """The lines of ``EXAMPLES`` with their spans."""
    out = []
    for marked in EXAMPLES:
        text, spans, at = "", [], 0
        for m in re.finditer(r"\[(\w+)\|([^\]]*)\]", marked):
            text += marked[at : m.start()]
            spans.append((m[1], len(text), len(text) + len(m[2])))
            text, at = text + m[2], m.end()
        out.append((text + marked[at:], spans))
    return out


def tagged_line(text: str, spans: list[tuple[str, int, int]]) -> tuple[list[str], list[int]]:
    """Words and tags of a line; a word belongs to the span it overlaps."""
    words, tags = [], []
    last = None
    for m in _WORD.finditer(text):
        own = next((s for s in spans if s[1] < m.end() and m.start() < s[2]), None)
        words.append(m[0])
        tags.append(0 if own is None else TAGS.index(f"{'I' if own == last else 'B'}-{own[0]}"))
        last = own
    return words, tags


def doubtful(line: str, spans: list[tuple[str, int, int]]) -> bool:
    """Whether something outside the spans looks like personal data."""
    rest = list(line)
    for _, a, b in spans:
        rest[a:b] = " " * (b - a)
    rest = "".join(rest)
    return "@" in rest or "+" in rest or any(len(_digits(m[0])) >= 9 for m in CARD.finditer(rest)) or IP.search(rest) is not None


def sample_lines(docs: DataFrame, text: str, key: str, sample_docs: int, sample_lines: int) -> list[tuple[str, list]]:
    """Lines with a digit or @ of at most ``sample_docs`` documents (least hashes of their key), ``sample_lines`` at most, labelled by the patterns."""
    order = F.xxhash64(F.col(key), F.lit("pii"))
    edge = docs.select(order.alias("o")).orderBy("o").limit(sample_docs).agg(F.max("o")).first()[0]
    if edge is None:
        return []
    lines = docs.filter(order <= edge).select(order.alias("o"), F.posexplode(F.split(text, "\n")).alias("p", "line")).filter(F.col("line").rlike("[0-9@]"))
    # A line of thousands of words teaches nothing more than its part around the sign.
    cut = F.regexp_extract("line", r"(?:\S+\s+){0,6}\S*[0-9@](?:\S*\s*){0,12}", 0)
    rows = lines.orderBy(F.xxhash64("o", "p"), "o", "p").limit(sample_lines).select(cut.alias("line")).collect()  # bounded by sample_lines
    out = []
    for r in rows:
        spans = base_spans(r["line"])
        if not doubtful(r["line"], spans):
            out.append((r["line"], spans))
    return out


def fit(docs: DataFrame, text: str = "text", key: str = "doc_id", sample_docs: int = 4000, sample_size: int = 800) -> Field:
    """A field trained on the examples and on a bounded sample of ``docs``."""
    # The examples weigh as much as the sample, which shows few spellings.
    found = sample_lines(docs, text, key, sample_docs, sample_size)
    own = examples() * max(1, len(found) // (2 * len(EXAMPLES)))
    return train([tagged_line(t, s) for t, s in own + found if t.strip(BLANK)])


def personal_data(text: Column, field: Field) -> Column:
    """A struct for each text: counts of base spans by kind, ``base`` and ``spans`` (``kind:start:end``, comma-joined)."""
    names = [f"n_{k}" for k in KINDS]

    @F.pandas_udf(", ".join(f"{n} long" for n in names) + ", base string, spans string")
    def spans(texts: pd.Series) -> pd.DataFrame:
        said = lambda xs: ",".join(f"{k}:{a}:{b}" for k, a, b in xs)
        rows = []
        for base, every in all_spans([t or "" for t in texts], field):
            kinds = [k for k, _, _ in base]
            rows.append((*(kinds.count(k) for k in KINDS), said(base), said(every)))
        return pd.DataFrame(rows, columns=[*names, "base", "spans"])

    return spans(text)


def find_personal_data(docs: DataFrame, text: str = "text", key: str = "doc_id", field: Field | None = None, name: str = "pii") -> DataFrame:
    """``docs`` with a struct ``name`` of what is found in each text."""
    return docs.withColumn(name, personal_data(F.col(text), field or fit(docs, text, key)))
