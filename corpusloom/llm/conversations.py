"""Conversation structure repair: the cheapest edits that give each conversation a well-formed order of roles.

Rows are edited in their order: Keep, Rerole to the role that fits, Delete, Insert an empty message; what is left must read
``(s?(ua)+)?`` by the initials of the roles (system, user, assistant). Four states (nothing yet, after the system message, after a
user, after an assistant) and a cost for each edit make this a Viterbi search, done backward, so that tracing forward can
choose the least edit by ASCII among the cheapest.

The search is parallel by rank convergence. Rows are laid out by conversation and order over range partitions and cut into chunks of
``CHUNK`` rows, so a conversation of any length spreads over many tasks. Each chunk starts from four speculative cost vectors that
span every vector its right neighbour can have. Where the four results differ only by constants, the chunk has converged:
whatever follows, its costs are that vector plus a constant. Fix-up passes rerun the others from their neighbour's vectors until theirs
differ only by constants too; as costs are min-plus linear, a rerun is the product of two 4 x 4 tables, and each pass
doubles how far it reaches, so the passes grow with the logarithm of the longest stretch that doesn't converge. With the vector
at its right end each chunk traces its edits for the four states it may be entered in; the same passes, from the left, find
which state that is. Vectors that differ by a constant are one vector, so there are few, and a row costs a lookup.

Faults are found before: a blank row, a row that repeats role and text of an earlier one (128-bit digests stand for equal texts), and a
row that ends without a full stop, exclamation or question mark. Duplicates are found by the least position of each role and
digest, with partial aggregation; no conversation and no repeated text is held in one task.

Nulls: a null role, text or part of a key counts as one space (so a null text is blank), a null conversation is one conversation, null turns
come first. Rows of one turn are ordered by role, then by the first 64 characters of the text, then by its digest; equal rows are
interchangeable. A role with another initial than s, u or a cannot be kept. Empty tables give empty results; extra columns are ignored
and may have any name. A conversation's digest is that of its whole repaired text and is chained block by block, as SHA-256 must be;
its blocks of a megabyte pass through one task without being held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from corpusloom.llm.common import stored

#: Rows of a chunk, the unit that is searched and traced in one piece.
CHUNK = 512
#: Costs of the edits; keeping a truncated row costs ``TRUNCATED`` more, also under a new role.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

BLANK_CHARS = r"[^\x20\x09-\x0D]"
S, U, A, OTHER = range(4)  # the initials of roles
IS_BLANK, IS_DUPLICATE, IS_TRUNCATED = 4, 8, 16  # a row's code: initial plus its first fault

# States: nothing yet, system, user, assistant. What an initial leads to, and what an inserted or re-roled message leads to.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
KEEPS = ({S: SYSTEM, U: USER}, {U: USER}, {A: ASSISTANT}, {U: USER})
FITS = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
CLOSING = (0, 2 * INSERT, INSERT, 0)  # the cost of ending a conversation in each state
TAILS = ("", "II", "I", "")

# v[i] <= v[j] + BOUND[j][i] for every cost vector v: what a state can always do as well as another, and at what price.
# So any vector is the least of these four, each raised by v[j].
SPECULATIVE = (
    (0, DELETE + 2 * INSERT, DELETE + INSERT, DELETE),
    (0, 0, INSERT, 0),
    (INSERT, INSERT, 0, INSERT),
    (0, 2 * INSERT, INSERT, 0),
)


# --- the search over one row ------------------------------------------------------------------------------------


def _costs(after: tuple, code: int) -> list[int]:
    """The least cost from before a row, in each state, to the end, when ``after`` holds the costs behind it."""
    gone, more = code & (IS_BLANK | IS_DUPLICATE), TRUNCATED if code & IS_TRUNCATED else 0
    raw = []
    for q in range(4):
        best = DELETE + after[q]
        if not gone:
            best = min(best, REROLE + more + after[FITS[q]])
            if code & 3 in KEEPS[q]:
                best = min(best, more + after[KEEPS[q][code & 3]])
        raw.append(best)
    user, assistant = min(raw[USER], INSERT + raw[ASSISTANT]), min(raw[ASSISTANT], INSERT + raw[USER])
    return [min(raw[NOTHING], INSERT + user), min(raw[SYSTEM], INSERT + user), user, assistant]


@lru_cache(None)
def step(after: tuple, code: int) -> tuple[tuple, int]:
    """``_costs`` as a vector whose least number is 0, and the constant taken off. There are few such vectors."""
    costs = _costs(after, code)
    least = min(costs)
    return tuple(c - least for c in costs), least


@lru_cache(None)
def edits_of(after: tuple, code: int, state: int) -> tuple[str, int, int]:
    """The least edits (by ASCII) of the cheapest ones for a row, insertions before it first; the state behind it; their cost."""
    costs = _costs(after, code)
    more = TRUNCATED if code & IS_TRUNCATED else 0
    done, spent = "", 0
    while True:
        if DELETE + after[state] == costs[state]:
            return done + "D", state, spent + DELETE
        if INSERT + costs[FITS[state]] == costs[state]:
            done, state, spent = done + "I", FITS[state], spent + INSERT
            continue
        kept = KEEPS[state].get(code & 3)
        if kept is not None and more + after[kept] == costs[state]:
            return done + "K", kept, spent + more
        return done + "R", FITS[state], spent + REROLE + more


# --- the search over one chunk ----------------------------------------------------------------------------------


def chunk_vectors(codes: list[int], ends: tuple) -> list[int]:
    """For each vector of ``ends`` behind the chunk, the vector before it: 4 numbers each."""
    out: list[int] = []
    for vector in ends:
        total = 0
        for code in reversed(codes):
            vector, least = step(vector, code)
            total += least
        out += [total + v for v in vector]
    return out


def converged(table: list[int]) -> bool:
    """Whether the four vectors differ only by constants."""
    return all(table[4 * j + q] - table[4 * j] == table[q] - table[0] for j in range(1, 4) for q in range(1, 4))


def vector_of(table: list[int]) -> tuple:
    """The vector of a converged table, its least number 0."""
    return tuple(v - min(table[:4]) for v in table[:4])


def rerun(table: list[int], neighbour: list[int]) -> list[int]:
    """The table of a chunk that starts from its neighbour's four vectors instead of the speculative ones."""
    return [min(neighbour[4 * j + k] + table[4 * k + q] for k in range(4)) for j in range(4) for q in range(4)]


def trace(codes: list[int], end: tuple, state: int) -> tuple[list[str], int, int]:
    """The edits of each row of a chunk entered in ``state``, with the costs ``end`` behind it; the last state; their cost."""
    vectors = [end]
    for code in reversed(codes):
        vectors.append(step(vectors[-1], code)[0])
    edits, spent = [], 0
    for i, code in enumerate(codes):
        done, state, cost = edits_of(vectors[len(codes) - 1 - i], code, state)
        edits.append(done)
        spent += cost
    return edits, state, spent


# --- chunks of all conversations --------------------------------------------------------------------------------


def _rows(df: DataFrame, make, schema: str) -> DataFrame:
    """``make`` over each row (a dict), as a table; rows are read in Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pylist([make(r) for r in batch.to_pylist()], schema=arrow)

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return df.mapInArrow(run, schema)


def lay_out(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows in their order over range partitions: ``c`` (a key that is never null), ``turn, role, text, digest, pos, g``.

    ``pos`` rises with the order; ``g`` numbers the chunks without gaps, so that a conversation's next chunk is ``g + 1``.
    """
    blank = F.lit(" ")
    cells = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit("")).alias("c"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), blank).alias("role"), F.coalesce(F.col(text), blank).alias("text"))
    cells = cells.withColumn("digest", F.md5("text")).withColumn("start", F.substring("text", 1, 64))
    order = ["c", F.col("turn").asc_nulls_first(), "role", "start", "digest"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Equal rows are dealt by a random number: one row repeated without end is no hot key.
    dealt = cells.withColumn("r", F.rand(11)).repartitionByRange(parts, *order, "r").sortWithinPartitions(*order, "r")
    laid = stored(dealt.select("c", "turn", "role", "text", "digest", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("pos")), "layout")
    # One row for each partition of the layout.
    sizes = sorted((r["part"], r["n"]) for r in laid.groupBy("part").agg(F.count("*").alias("n")).collect())
    offsets, total = [], 0
    for part, n in sizes:
        offsets.append((part, total))
        total += -(-n // CHUNK)
    numbered = F.broadcast(rows.sparkSession.createDataFrame(offsets, "part int, before long"))
    nth = F.col("pos").bitwiseAND((1 << 33) - 1)
    return laid.join(numbered, "part").select("c", "turn", "role", "text", "digest", "pos", (F.col("before") + F.floor(nth / CHUNK)).alias("g"))


def first_fault(role: Column, text: Column) -> Column:
    """A row's code without duplicates: the initial of its role, and whether it is blank or truncated."""
    initial = F.substring(role, 1, 1)
    which = F.when(initial == "s", S).when(initial == "u", U).when(initial == "a", A).otherwise(OTHER)
    blank = ~text.rlike(BLANK_CHARS)
    ends = text.rlike(r"[.!?][\x20\x09-\x0D]*\z")
    return (which + F.when(blank, IS_BLANK).when(~ends, IS_TRUNCATED).otherwise(0)).cast("int")


def chunks_of(laid: DataFrame) -> DataFrame:
    """A row for each conversation and chunk: ``c, g, codes, turns`` (how many distinct), first and last turn, and what the next chunk begins with."""
    coded = laid.select("c", "g", "pos", "turn", "role", "digest", first_fault(F.col("role"), F.col("text")).alias("code"))
    first = coded.filter(F.col("code").bitwiseAND(IS_BLANK) == 0).groupBy("c", "role", "digest").agg(F.min(F.struct("pos", "g")).alias("m"))
    marks = first.select("c", "m.g", "m.pos", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("int").alias("code"))
    both = coded.select(*marks.columns).unionByName(marks)
    # A row with its mark is the first of its kind; the shuffle on (c, g) serves both groupings.
    rows = both.repartition("c", "g").groupBy("c", "g", "pos").agg(F.max("turn").alias("turn"), F.max("code").alias("code"), F.count("*").alias("n"))
    late = (F.col("n") == 1) & (F.col("code").bitwiseAND(IS_BLANK) == 0)
    code = F.when(late, F.col("code").bitwiseAND(3) + IS_DUPLICATE).otherwise(F.col("code"))
    grouped = rows.select("c", "g", F.struct("pos", code.cast("int").alias("code"), "turn").alias("r")).groupBy("c", "g").agg(F.array_sort(F.collect_list("r")).alias("r"))
    turns = F.array_distinct(F.filter(F.col("r")["turn"], lambda t: t.isNotNull()))
    cut = grouped.select("c", "g", F.col("r")["code"].alias("codes"), F.size(turns).cast("long").alias("turns"), F.array_min(turns).alias("low"), F.array_max(turns).alias("high"), F.get(F.col("r")["turn"], F.size("r") - 1).alias("last"), F.get(F.col("r")["turn"], F.lit(0)).alias("begin"))
    cut = stored(cut, "chunks")
    after = cut.select("c", (F.col("g") - 1).alias("g"), F.col("begin").alias("next_turn"), F.get("codes", F.lit(0)).alias("next_code"))
    before = cut.select("c", (F.col("g") + 1).alias("g"), F.lit(True).alias("has_before"))
    joined = cut.join(after, ["c", "g"], "left").join(before, ["c", "g"], "left")
    return stored(joined.withColumn("has_before", F.coalesce("has_before", F.lit(False))), "linked-chunks")


def _settle(tables: DataFrame, is_settled, product) -> DataFrame:
    """Fix-up passes: ``tables (c, g, t, to)`` until each ``t`` is settled; ``to`` is the chunk whose table comes next.

    Each pass rewrites the tables that aren't settled, from those of the chunk they reach, and doubles what they reach.
    """
    schema = "c string, g long, t array<long>, to long, settled boolean"

    def make(r: dict) -> dict:
        t = product(r["t"], r["other"]) if r.get("other") is not None else r["t"]
        return {"c": r["c"], "g": r["g"], "t": t, "to": r["next"], "settled": is_settled(t)}

    now = stored(_rows(tables.withColumnRenamed("to", "next"), make, schema), "tables")
    while not now.filter(~F.col("settled")).isEmpty():
        reached = now.select("c", F.col("g").alias("to"), F.col("t").alias("other"), F.col("to").alias("next"))
        again = now.filter(~F.col("settled")).join(reached, ["c", "to"]).select("c", "g", "t", "other", "next")
        now = stored(now.filter("settled").unionByName(_rows(again, make, schema)), "tables")
    return now


def search(chunks: DataFrame) -> DataFrame:
    """The chunks with ``end`` (the costs behind them) and ``state`` (what they are entered in)."""

    def speculate(r: dict) -> dict:
        last = r["next_code"] is None
        return {"c": r["c"], "g": r["g"], "t": chunk_vectors(r["codes"], (CLOSING,) * 4 if last else SPECULATIVE), "to": r["g"] + 1}

    vectors = _settle(_rows(chunks, speculate, "c string, g long, t array<long>, to long"), converged, rerun)
    behind = vectors.select("c", (F.col("g") - 1).alias("g"), F.col("t").alias("after"))

    def exits(r: dict) -> dict:
        end = vector_of(r["after"]) if r["after"] is not None else CLOSING
        out = [trace(r["codes"], end, q)[1] for q in range(4)]
        return {"c": r["c"], "g": r["g"], "t": out if r["has_before"] else [out[NOTHING]] * 4, "to": r["g"] - 1, "end": list(end)}

    traced = stored(_rows(chunks.select("c", "g", "codes", "has_before").join(behind, ["c", "g"], "left"), exits, "c string, g long, t array<long>, to long, end array<long>"), "exits")
    states = _settle(traced.drop("end"), lambda t: len(set(t)) == 1, lambda t, before: [t[q] for q in before])
    entered = states.select("c", (F.col("g") + 1).alias("g"), F.get("t", F.lit(0)).alias("state"))
    full = chunks.join(traced.select("c", "g", "end"), ["c", "g"]).join(entered, ["c", "g"], "left")
    return full.withColumn("state", F.coalesce("state", F.lit(NOTHING)))


def judge_chunks(found: DataFrame) -> DataFrame:
    """Each chunk's edits (``edits``: one text per row and one for what follows the last) and its share of the conversation's numbers."""
    legal = {(S, U), (U, A), (A, U)}
    counts = "rows long, blank long, duplicate long, truncated long, illegal long, cost long"

    def make(r: dict) -> dict:
        codes = r["codes"]
        edits, state, cost = trace(codes, tuple(r["end"]), r["state"])
        tail = TAILS[state] if r["next_code"] is None else ""
        initials = [c & 3 for c in codes] + ([] if r["next_code"] is None else [r["next_code"] & 3])
        out = {k: r[k] for k in ("c", "g", "state", "low", "high")}
        return out | {
            "edits": [*edits, tail], "turns": r["turns"] - (r["last"] is not None and r["last"] == r["next_turn"]), "rows": len(codes), "alone": r["next_code"] is None and not r["has_before"],
            "blank": sum(c & IS_BLANK > 0 for c in codes), "duplicate": sum(c & IS_DUPLICATE > 0 for c in codes), "truncated": sum(c & IS_TRUNCATED > 0 for c in codes),
            "illegal": sum(p not in legal for p in zip(initials, initials[1:])), "cost": cost + INSERT * len(tail),
        }

    return stored(_rows(found, make, f"c string, g long, state int, low long, high long, edits array<string>, turns long, alone boolean, {counts}"), "edits")


def apply_edits(laid: DataFrame, judged: DataFrame) -> DataFrame:
    """The repaired messages and the edits that made them, in order inside each partition: ``c, g, alone, edit, role, text``.

    A deleted row has null role and text. Rows and edits of a chunk meet in one shuffle and are streamed.
    """
    rows = laid.select("c", "g", "pos", "role", "text", F.lit(None).cast("array<string>").alias("edits"), F.lit(None).cast("int").alias("state"), F.lit(None).cast("boolean").alias("alone"))
    plans = judged.select("c", "g", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "edits", "state", "alone")
    schema = "c string, g long, alone boolean, edit string, role string, text string"
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.string(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, nth, state, alone = [""], 0, NOTHING, True
        for batch in batches:
            out: list[tuple] = []
            for c, g, pos, role, text, edits, entered, single in zip(*(batch.column(i).to_pylist() for i in range(8))):
                if pos < 0:
                    plan, nth, state, alone = edits, 0, entered, single
                    continue
                last = nth == len(plan) - 2
                for edit in plan[nth] + (plan[-1] if last else ""):
                    if edit == "D":
                        out.append((c, g, alone, edit, None, None))
                        continue
                    if edit == "K":
                        state = KEEPS[state]["sua".index(role[0])]
                        out.append((c, g, alone, edit, role, text))
                        continue
                    state = FITS[state]
                    out.append((c, g, alone, edit, ROLES[state], text if edit == "R" else ""))
                nth += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), kinds)], names=names)

    return rows.unionByName(plans).repartition("c", "g").sortWithinPartitions("c", "g", "pos").mapInArrow(run, schema)


def repair_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(numbers, messages)``: a row for each conversation, and every edit with the message it leaves.

    numbers: ``c, gaps, blank, duplicate, truncated, illegal, cost``. messages: see ``apply_edits``.
    """
    laid = lay_out(rows, conv, turn, role, text)
    judged = judge_chunks(search(chunks_of(laid)))
    sums = [F.sum(n).alias(n) for n in ("blank", "duplicate", "truncated", "illegal", "cost")]
    gaps = F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("turns"), F.lit(0)).cast("long")
    return judged.groupBy("c").agg(gaps.alias("gaps"), *sums), apply_edits(laid, judged)


def digests(messages: DataFrame) -> DataFrame:
    """``c, audit, repaired_sha256`` of each conversation: its edits' initials, and the digest of its ``role:text`` lines."""
    limit = 1 << 20
    schema = "c string, g long, nth long, alone boolean, audit string, data binary, sha string"
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.binary(), pa.string()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=names)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A conversation of one chunk gets its digest; others give blocks of lines, each line with a newline before it."""
        key = None
        out: list[tuple] = []
        audit, block, size, nth, alone, whole = [], [], 0, 0, True, hashlib.sha256()

        def close(end: bool) -> None:
            nonlocal audit, block, size, nth
            if key is not None and (end or block):
                data = b"".join(block)
                if alone:
                    whole.update(data[1:] if nth == 0 else data)
                    if end:
                        out.append((*key, nth, True, "".join(audit), None, whole.hexdigest()))
                        audit = []
                else:
                    out.append((*key, nth, False, "".join(audit), data, None))
                    audit = []
                block, size, nth = [], 0, nth + (len(data) > 0)

        for batch in batches:
            for c, g, single, edit, role, text in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if (c, g) != key:
                    close(True)
                    key, alone, nth, whole = (c, g), single, 0, hashlib.sha256()
                audit.append(edit)
                if role is not None:
                    line = f"\n{role}:{text}".encode()
                    block.append(line)
                    size += len(line)
                    if size >= limit:
                        close(False)
            if out:
                yield batch_of(out)
                out = []
        close(True)
        if out:
            yield batch_of(out)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, audit, whole, empty = None, [], hashlib.sha256(), True
        names = ["c", "audit", "repaired_sha256"]
        for batch in batches:
            out = []
            for c, _, _, single, part, data, sha in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if c != key:
                    if key is not None:
                        out.append((key, "".join(audit), whole.hexdigest()))
                    key, audit, whole, empty = c, [], hashlib.sha256(), True
                audit.append(part)
                if data:
                    whole.update(data[1:] if empty else data)
                    empty = False
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.string()) for v in zip(*out)], names=names)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.string()) for v in (key, "".join(audit), whole.hexdigest())], names=names)

    cut = stored(messages.mapInArrow(pieces, schema), "pieces")
    chained = cut.filter(~F.col("alone")).repartition("c").sortWithinPartitions("c", "g", "nth").mapInArrow(join, "c string, audit string, repaired_sha256 string")
    return cut.filter("alone").select("c", "audit", F.col("sha").alias("repaired_sha256")).unionByName(chained)


def damage(rows: DataFrame) -> DataFrame:
    """``conversations`` rows with a fifth of them damaged, by the CRC-32 of ``conv_id:turn``; nulls are one space."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(how == 1, "").when(how == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    copies = F.when(how == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    hurt = rows.select("conv_id", "turn", F.when(how == 4, "user").otherwise(spaced("role")).alias("role"), text.alias("text"), how.alias("how"), copies.alias("copies")).filter("how <> 0")
    return hurt.select("conv_id", "turn", "role", "text", F.explode("copies").alias("copy")).drop("copy")


def repaired_digests(rows: DataFrame) -> DataFrame:
    """A row for each conversation of ``rows``, also for those that the damage left empty."""
    numbers, messages = repair_conversations(damage(rows))
    keyed = rows.select("conv_id", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("c")).distinct()
    whole = keyed.join(numbers, "c", "left").join(digests(messages), "c", "left")
    counts = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return whole.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
