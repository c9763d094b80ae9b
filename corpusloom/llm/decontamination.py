"""Benchmark decontamination with a distributed positional inverted index.

A window is a run of ``size`` words of a benchmark item (an item of fewer words is one window). The index stores postings (document,
position) of the words that windows are looked up by: each window's rarest words, by their counts over all documents, two more
than a match may differ in. A posting minus the word's position in the item is the alignment of item and document; windows of an item
share it, so a word is met once for an item and not once for a window. An alignment on which as many of the offset-adjusted lists
agree as a match must have is a candidate, so no match is lost. What is left is verified word by word: all
of a window equal is an exact phrase match, ``near`` of them in place is a proximity match.

The documents are cut into words twice (word counts, postings) and the candidates once more. Each document has one
more posting, of the empty word, at the position behind its last word: its length. Postings meet in one shuffle of (document, item,
alignment), counted before it. No text is shuffled while the candidates fit ``BROADCAST_ROWS``; beyond it they meet their texts in a
shuffle join. Postings are spread by document, so a word or a passage that a third of all documents has makes no large group. Only
DataFrame functions are used.

Null and empty texts have no words and are never contaminated; items without words are dropped; repeated rows, repeated
items and windows that several items share are counted once for each document; an empty benchmark contaminates nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.llm.common import alnum_words, document_key, lower_ascii, stored

#: Tables of at most so many rows (of a few numbers and short strings) are sent to every task; larger ones are joined by shuffle.
BROADCAST_ROWS = 200_000


def _sent(df: DataFrame, size: Column | None = None) -> DataFrame:
    """A written table, marked for broadcast if its size allows it; ``size`` is what a row counts for, else 1."""
    n = df.count() if size is None else df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def windows_of(items: DataFrame, item: str, text: str, size: int) -> DataFrame:
    """``(item, phrase, len)``: the distinct windows of each item, as words joined by a blank."""
    words = F.transform(alnum_words(F.col(text)), lower_ascii)
    cut = items.select(F.col(item).cast("string").alias("item"), words.alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    return cut.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("p")).select("item", F.array_join("p", " ").alias("phrase"), F.size("p").alias("len")).distinct()


def _terms(docs: DataFrame, wanted: DataFrame, keep: list[str], more: Column | None = None) -> DataFrame:
    """Each place of a wanted ``term`` in ``docs (text, ...)``; ``more`` is an array of words behind the text's own."""
    words = alnum_words(F.col("text"))
    out = docs.select(*keep, F.posexplode(words if more is None else F.concat(words, more)).alias("pos", "raw"))
    return out.withColumn("term", lower_ascii(F.col("raw"))).drop("raw").join(wanted, "term")


def find_matches(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", size: int = 13, near: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """``(documents, windows)``: every row of ``docs`` with what was found in it, and which items a window belongs to.

    documents: ``doc`` (row key), ``doc_id``, ``n_words``, ``matches`` (array of start, len, phrase, same: how many words
    are in place; ``same = len`` is an exact match). windows: ``item``, ``phrase``, ``len``.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), document_key(F.col(doc_id), F.col(text)).alias("doc"), F.col(text).alias("text"))
    windows = stored(windows_of(items, item, item_text, size), "windows")
    # Equal items are one sequence of words.
    words = F.transform(alnum_words(F.col(item_text)), lower_ascii)
    sequences = stored(items.select(words.alias("w")).filter(F.size("w") > 0).distinct().select(F.monotonically_increasing_id().alias("seq"), "w"), "sequences")
    vocabulary = stored(sequences.select(F.explode("w").alias("term")).distinct(), "vocabulary")
    counts = stored(_terms(rows, _sent(vocabulary), []).groupBy("term").agg(F.count("*").alias("n")), "term-counts")
    # A match may differ in ``len - least`` words. Of that many places and two more, the rarest ones, two (or the only one) stand
    # in place in every match, exact or near; words that no document has are among them and differ.
    length = F.least(F.size("w"), F.lit(size))
    least = F.ceil(F.col("len") * F.lit(near)).cast("int")
    starts = F.sequence(F.lit(0), F.size("w") - F.col("len"))
    places = sequences.withColumn("len", length).select("seq", "len", F.explode(starts).alias("s"), "w").select("seq", "s", "len", F.posexplode(F.slice("w", F.col("s") + 1, F.col("len"))).alias("off", "term"))
    known = places.join(counts, "term", "left").select("seq", "s", "len", "term", (F.col("s") + F.col("off")).alias("at"), F.coalesce("n", F.lit(0)).alias("n"))
    known = known.groupBy("seq", "s", "len").agg(F.array_sort(F.collect_list(F.struct("n", "at", "term"))).alias("r"), F.count(F.when(F.col("n") > 0, 1)).alias("have"))
    looked = known.filter(F.col("have") >= least).select("seq", F.least("len", F.col("len") - least + 2).alias("take"), (F.col("len") - least).alias("differ"), "r")
    looked = looked.select("seq", (F.col("take") - F.col("differ")).alias("agree"), F.explode(F.slice(F.col("r"), F.lit(1), F.col("take"))).alias("r"))
    anchors = looked.filter("r.n > 0").groupBy("seq", "r.at", "r.term").agg(F.min("agree").alias("agree"))
    agree = anchors.groupBy("seq").agg(F.min("agree").alias("agree"))
    anchors = stored(anchors.drop("agree"), "anchors")
    sought = anchors.select("term").distinct().unionByName(docs.sparkSession.range(1).select(F.lit("").alias("term")))
    postings = stored(_terms(rows, _sent(stored(sought, "anchor-terms")), ["doc", "doc_id"], F.array(F.lit(""))).select("doc", "doc_id", "pos", "term"), "postings")
    # A row repeated in ``docs`` repeats its postings and may so become a candidate, which the words then decide.
    aligned = postings.join(_sent(anchors), "term").select("doc", "seq", (F.col("pos") - F.col("at")).alias("diag"))
    met = aligned.groupBy("doc", "seq", "diag").agg(F.count("*").alias("seen"))
    needed = _sent(stored(agree.join(sequences.select("seq", F.size("w").alias("n")), "seq"), "needed"))
    met = met.join(needed, "seq").filter("seen >= agree")
    candidates = stored(met.groupBy("doc").agg(F.collect_list(F.struct("seq", "diag", "n")).alias("found")), "candidates")
    texts = rows.select("doc", "text").join(_sent(candidates, F.size("found")), "doc")
    own = F.transform(alnum_words(F.col("text")), lower_ascii)

    def cut(words):
        return F.transform("found", lambda c: F.struct(c["seq"].alias("seq"), c["diag"].alias("diag"), F.slice(words, F.greatest(c["diag"], F.lit(0)) + 1, c["n"]).alias("own")))

    pieces = texts.select("doc", F.explode(F.transform(F.array(own), cut)[0]).alias("c")).select("doc", "c.*").join(_sent(sequences, F.size("w")), "seq")
    lead = F.greatest(-F.col("diag"), F.lit(0))
    span = F.least(F.size("w"), F.lit(size))
    equal = F.zip_with(F.slice("w", lead + 1, F.size("w")), F.slice("own", F.lit(1), F.size("w") - lead), lambda a, b: F.coalesce(a == b, F.lit(False)).cast("int"))
    pieces = pieces.filter(F.size("w") - span >= lead).select("doc", "diag", "w", lead.alias("lead"), span.alias("span"), equal.alias("equal"))

    def window(s):
        same = F.aggregate(F.slice("equal", s - F.col("lead") + 1, F.col("span")), F.lit(0), lambda a, x: a + x)
        return F.struct((F.col("diag") + s).alias("start"), F.col("span").alias("len"), same.alias("same"), s.alias("s"))

    hits = F.filter(F.transform(F.sequence(F.col("lead"), F.size("w") - F.col("span")), window), lambda m: m["same"] >= m["len"] * F.lit(near))
    hits = F.transform(hits, lambda m: F.struct(m["start"].alias("start"), m["len"].alias("len"), F.array_join(F.slice("w", m["s"] + 1, m["len"]), " ").alias("phrase"), m["same"].alias("same")))
    matches = pieces.select("doc", F.explode(hits).alias("m")).groupBy("doc").agg(F.array_sort(F.collect_set("m")).alias("matches"))
    every = postings.filter("term = ''").select("doc", "doc_id", F.col("pos").cast("long").alias("n_words"))
    return every.join(matches, "doc", "left"), windows


def contamination(docs: DataFrame, items: DataFrame, share: int = 20, **how) -> DataFrame:
    """A row for each row of ``docs``: ``doc, doc_id, n_words, n_hit, n_near, n_items, items_sha256, contaminated``.

    A word inside an exact match is hit; a document is contaminated when ``share * n_hit >= n_words`` and a word is hit.
    ``n_near`` counts proximity matches that are not exact; they do not contaminate.
    """
    found, windows = find_matches(docs, items, **how)
    exact = F.filter("matches", lambda m: m["same"] == m["len"])
    # Merged ranges: starts are sorted, so the words covered are a running sum.
    covered = F.aggregate(
        exact, F.struct(F.lit(0).alias("sum"), F.lit(0).alias("end")),
        lambda a, m: F.struct((a["sum"] + F.greatest(m["start"] + m["len"] - F.greatest(a["end"], m["start"]), F.lit(0))).alias("sum"), F.greatest(a["end"], m["start"] + m["len"]).alias("end")),
        lambda a: a["sum"])
    base = found.select("doc", "doc_id", "n_words", F.coalesce(covered, F.lit(0)).cast("long").alias("n_hit"), F.coalesce(F.size("matches") - F.size(exact), F.lit(0)).cast("long").alias("n_near"),
                        F.array_distinct(F.transform(exact, lambda m: m["phrase"])).alias("phrases"))
    base = stored(base, "matches")
    # Items for each document: a window may belong to many items, a document to many windows.
    pairs = base.select("doc", F.explode("phrases").alias("phrase")).distinct().join(windows.select("phrase", "item"), "phrase").select("doc", "item").distinct()
    items_of = pairs.groupBy("doc").agg(F.array_sort(F.collect_list("item")).alias("items"))
    out = base.join(items_of, "doc", "left")
    listed = F.coalesce(F.array_join("items", ","), F.lit(""))
    hit = (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    return out.select("doc", "doc_id", "n_words", "n_hit", "n_near", F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"), hit.alias("contaminated"))


def remove_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns."""
    flagged = stored(contamination(docs, items, doc_id=doc_id, text=text, **how).filter("contaminated").select("doc").distinct(), "contaminated")
    key = "__doc"
    while key in docs.columns:
        key += "_"
    keyed = docs.withColumn(key, document_key(F.col(doc_id), F.col(text)))
    return keyed.join(_sent(flagged.withColumnRenamed("doc", key)), key, "left_anti").select(*docs.columns)
