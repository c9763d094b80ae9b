"""Text, date and scalar functions. Each takes and returns Spark ``Column`` objects."""

from __future__ import annotations

import html
import re
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T

WHITESPACE = " \t\n\r\x0b\x0c"
ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"
PERSIAN_DIGITS = "۰۱۲۳۴۵۶۷۸۹"

# Words ignored when weighting query terms.
STOP_WORDS = (
    "请问", "您", "你", "我", "他", "是", "的", "就", "有", "于", "及", "即", "在", "为", "最", "从", "以",
    "了", "将", "与", "吗", "吧", "中", "#", "什么", "怎么", "哪个", "哪些", "啥", "相关",
)

# Question words and function words removed from a query, applied in this order.
QUESTION_WORDS_ZH = (
    r"是*(怎么办|什么样的|哪家|一下|那家|请问|啥样|咋样了|什么时候|何时|何地|何人|是否|是不是|多少|哪里|怎么|哪儿|怎么样|如何|哪些"
    r"|是啥|啥是|啊|吗|呢|吧|咋|什么|有没有|呀|谁|哪位|哪个)是*"
)
QUESTION_WORDS_EN = r"(^| )(what|who|how|which|where|why)('re|'s)? "
FUNCTION_WORDS_EN = (
    r"(^| )('s|'re|is|are|were|was|do|does|did|don't|doesn't|didn't|has|have|be|there|you|me|your|my|mine|just"
    r"|please|may|i|should|would|wouldn't|will|won't|done|go|for|with|so|the|a|an|by|i'm|it's|he's|she's|they"
    r"|they're|you're|as|by|on|in|at|up|out|down|of|to|or|and|if) "
)
# Fixed value: characters that a query loses.
QUERY_PUNCTUATION = r"""[ :|\r\n\t,，。？?/`!！&^%()\[\]{}<>*~'"\\]+"""

FULL_WIDTH = "".join(chr(0xFF01 + i) for i in range(94)) + "\u3000"
HALF_WIDTH = "".join(chr(0x21 + i) for i in range(94)) + " "


def strip(c: Column) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.btrim(c, F.lit(WHITESPACE))


# --- clean-up -------------------------------------------------------------------------------------


# Where a space is redundant, after opening and before closing punctuation.
SPACE_AFTER = r"(?i)([^a-z0-9.,\)>]) +([^ ])"
SPACE_BEFORE = r"(?i)([^ ]) +([^a-z0-9.,\(<])"


def remove_redundant_spaces(c: Column) -> Column:
    """Drop spaces after opening and before closing punctuation."""
    return F.regexp_replace(F.regexp_replace(c, SPACE_AFTER, "$1$2"), SPACE_BEFORE, "$1$2")


def clean_markdown_block(c: Column) -> Column:
    """Drop a leading markdown fence and a trailing fence."""
    opened = F.regexp_replace(c, r"^\s*```markdown\s*\n?", "")
    return strip(F.regexp_replace(opened, r"\n?\s*```\s*\z", ""))


def is_blank(c: Column) -> Column:
    return F.length(strip(F.coalesce(c, F.lit("")))) == 0


def normalize_arabic_digits(c: Column) -> Column:
    return F.translate(c, ARABIC_DIGITS + PERSIAN_DIGITS, "0123456789" * 2)


@F.pandas_udf(T.StringType())
def _nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: v if v is None else unicodedata.normalize("NFKC", v))


def normalize_presentation_forms(c: Column) -> Column:
    """NFKC, computed only for texts that hold Arabic presentation forms."""
    flagged = c.rlike(r"[\uFB50-\uFDFF\uFE70-\uFEFF]")
    return F.coalesce(_nfkc(F.when(flagged, c)), c)


# Character entities replaced without leaving the JVM; the ampersand must come last.
COMMON_ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\u00a0"),
    ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"),
)


@F.pandas_udf(T.StringType())
def _unescape(values: pd.Series) -> pd.Series:
    return values.map(lambda v: v if v is None else html.unescape(v))


def unescape_entities(c: Column) -> Column:
    """Decode character entities; only rows with an uncommon one take the Python path."""
    common = "|".join(name[1:] for name, _ in COMMON_ENTITIES)
    rest = F.regexp_replace(c, f"&(?:{common})", "")
    uncommon = rest.rlike("&#?[A-Za-z0-9]+")
    plain = c
    for name, char in COMMON_ENTITIES:
        plain = F.replace(plain, F.lit(name), F.lit(char))
    return F.coalesce(_unescape(F.when(uncommon, c)), plain)


def clean_string(c: Column) -> Column:
    """Unescape entities, then drop double quotes and control characters."""
    return F.regexp_replace(unescape_entities(strip(c)), "[\"\\x00-\\x1f\\x7f-\\x9f]", "")


def collapse_whitespace(c: Column) -> Column:
    """One space per run, no trailing spaces, one newline per run."""
    out = F.regexp_replace(c, " +", " ")
    out = F.regexp_replace(out, " +[\n\r]", "\n")
    return strip(F.regexp_replace(out, "[\n\r]+", "\n"))


def newlines_to_space(c: Column) -> Column:
    return F.regexp_replace(c, "[\n\r]+", " ")


# --- language and quality tests ---------------------------------------------------------------------


def is_english(c: Column) -> Column:
    """More than 80 % of the characters are Latin letters, digits or common punctuation (not space)."""
    # Fixed value: the characters that count as English.
    kept = F.regexp_replace(c, r"""[^`a-zA-Z0-9.,':;/"?<>!()\-]""", "")
    return F.coalesce(F.try_divide(F.length(kept), F.length(c)) > 0.8, F.lit(False))


def is_english_list(c: Column) -> Column:
    """More than 80 % of the non-blank strings consist of Latin text only."""
    texts = F.filter(c, lambda t: ~is_blank(t))
    latin = F.filter(texts, lambda t: strip(t).rlike(r"""^[`a-zA-Z0-9\s.,':;/"?<>!()\-]$"""))
    return F.coalesce(F.try_divide(F.size(latin), F.size(texts)) > 0.8, F.lit(False))


def is_chinese(c: Column) -> Column:
    """More than 20 % of the characters are CJK ideographs."""
    han = F.regexp_replace(c, "[^一-鿿]", "")
    return F.coalesce(F.try_divide(F.length(han), F.length(c)) > 0.2, F.lit(False))


def is_chinese_query(c: Column) -> Column:
    """Three words or fewer, or at least 70 % of the words are not purely alphabetic."""
    words = F.split(c, "[ \t]+")
    other = F.filter(words, lambda w: ~w.rlike("^[a-zA-Z]+$"))
    return (F.size(words) <= 3) | (F.size(other) / F.size(words) >= 0.7)


def is_garbled(c: Column, threshold: float = 0.5) -> Column:
    """Unmapped glyph markers, or too many private-use, control and replacement characters."""
    visible = F.regexp_replace(c, r"\s", "")
    unmapped = r"\uE000-\uF8FF\uFFFD\x00-\x1f\x80-\x9f\x{F0000}-\x{FFFFF}\x{100000}-\x{10FFFF}\p{Cn}\p{Cs}"
    bad = F.regexp_replace(visible, f"[^{unmapped}]", "")
    ratio = F.try_divide(F.length(bad), F.length(visible))
    return ~is_blank(c) & (c.rlike(r"\(cid\s*:\s*[0-9]+\s*\)") | F.coalesce(ratio >= threshold, F.lit(False)))


# --- tokens -----------------------------------------------------------------------------------------


def tokens(c: Column) -> Column:
    """Lower-case letter and digit runs; every CJK ideograph is a token of its own."""
    spaced = F.regexp_replace(F.lower(c), r"(\p{IsHan})", " $1 ")
    return F.regexp_extract_all(spaced, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def token_parts(c: Column, name: str) -> list[Column]:
    """Two columns from which ``token_lists`` makes the tokens of ``c`` in a task: a text of ASCII as it is, the tokens of any other."""
    plain = F.octet_length(c) == F.char_length(c)
    return [F.when(plain, c).alias(f"{name}_ascii"), F.when(~plain, tokens(c)).alias(f"{name}_other")]


_ASCII = np.array([ord(chr(b).lower()) if chr(b).isalnum() and b < 128 else 32 for b in range(256)], np.uint8)


def token_lists(batch: pa.RecordBatch, name: str) -> pa.ListArray:
    """``tokens`` of a batch with the two columns of ``token_parts``; a text without any may have one empty token, a null has a null."""
    plain, other = batch.column(f"{name}_ascii"), batch.column(f"{name}_other").cast(pa.list_(pa.string()))
    if plain.null_count == len(plain):
        return other
    valid, offsets, data = plain.buffers()
    marked = _ASCII[np.frombuffer(data, np.uint8)] if data is not None else np.empty(0, np.uint8)
    marked = pa.StringArray.from_buffers(len(plain), offsets, pa.py_buffer(marked), valid, plain.null_count, plain.offset)
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(marked)).cast(pa.list_(pa.string()))
    return lists if other.null_count == len(other) else pc.coalesce(lists, other)


def fine_tokens(c: Column) -> Column:
    """Tokens with letter and digit runs separated."""
    spaced = F.regexp_replace(F.lower(c), r"(\p{IsHan})", " $1 ")
    return F.regexp_extract_all(spaced, F.lit(r"\p{L}+|\p{N}+"), F.lit(0))


def token_count(c: Column) -> Column:
    """The unit of every token budget."""
    return F.size(tokens(c))


def truncate_tokens(c: Column, n) -> Column:
    return F.array_join(F.slice(tokens(c), 1, n), " ")


def filter_tokens(c: Column, keep_numbers: bool = False) -> Column:
    """Drop stop words, punctuation and, unless asked for, single digits."""
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])

    def keep(t):
        ok = ~F.array_contains(stop, t) & t.rlike(r"^[\p{L}\p{N}]")
        return ok if keep_numbers else ok & ~t.rlike("^[0-9]$")

    return F.filter(c, keep)


def merge_short_tokens(c: Column) -> Column:
    """Join runs of two to four short tokens; longer runs are joined two by two.

    The state of the fold is the finished list plus the run of short tokens still open.
    """
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])

    def short(t):
        return ((F.length(t) == 1) | t.rlike("^[0-9a-z]{1,2}$")) & ~F.array_contains(stop, t)

    def flush(done, run):
        n = F.size(run)
        pairs = F.when(n < 2, F.lit(0)).otherwise(F.greatest(F.lit(0), F.floor((n - 3) / 2).cast("int")))
        starts = F.when(pairs > 0, F.sequence(F.lit(0), pairs - 1)).otherwise(F.array().cast("array<int>"))
        paired = F.transform(starts, lambda i: F.array_join(F.slice(run, i * 2 + 1, 2), " "))
        rest = F.when(
            n > pairs * 2, F.array(F.array_join(F.slice(run, pairs * 2 + 1, F.greatest(n - pairs * 2, F.lit(1))), " "))
        ).otherwise(F.array().cast("array<string>"))
        return F.concat(done, paired, rest)

    empty = F.array().cast("array<string>")
    # A leading short token is glued to a following non-Latin word.
    first, second = F.try_element_at(c, F.lit(1)), F.try_element_at(c, F.lit(2))
    glue = F.coalesce(
        ((F.length(first) == 1) | first.rlike("^[0-9a-z]{1,2}$"))
        & (F.length(second) > 1) & ~second.rlike("^[0-9a-zA-Z]"),
        F.lit(False),
    )
    head = F.when(glue, F.array(F.array_join(F.slice(c, 1, 2), " "))).otherwise(empty)
    tail = F.when(glue, F.slice(c, 3, F.greatest(F.size(c), F.lit(1)))).otherwise(c)
    return F.aggregate(
        tail,
        F.struct(head.alias("done"), empty.alias("run")),
        lambda acc, t: F.when(
            short(t), F.struct(acc["done"].alias("done"), F.array_append(acc["run"], t).alias("run"))
        ).otherwise(
            F.struct(F.array_append(flush(acc["done"], acc["run"]), t).alias("done"), empty.alias("run"))
        ),
        lambda acc: flush(acc["done"], acc["run"]),
    )


def merge_adjacent_words(c: Column) -> Column:
    """Join neighbouring words that both end in a Latin letter into one phrase."""
    flat = strip(F.regexp_replace(c, r"[ \t\r\n]+", " "))
    # A space separates phrases unless it stands between two words that end in a Latin letter.
    return F.split(flat, r" (?:(?<![a-zA-Z] )|(?!\S*[a-zA-Z](?: |\z)))", -1)


def rm_question_words(c: Column) -> Column:
    """Remove question and function words; keep the input when nothing would be left."""
    out = F.regexp_replace(c, f"(?i){QUESTION_WORDS_ZH}", "")
    out = F.regexp_replace(out, f"(?i){QUESTION_WORDS_EN}", " ")
    out = F.regexp_replace(out, f"(?i){FUNCTION_WORDS_EN}", " ")
    return F.when(out == "", c).otherwise(out)


def space_latin_cjk(c: Column) -> Column:
    """Put a space between Latin and CJK runs."""
    han = "一-龥"
    # Where a space goes.
    for pattern in (
        f"([A-Za-z]+[0-9]+)([{han}]+)", f"([A-Za-z])([{han}]+)", f"([{han}]+)([A-Za-z]+[0-9]+)", f"([{han}]+)([A-Za-z])",
    ):
        c = F.regexp_replace(c, pattern, "$1 $2")
    return c


def to_half_width(c: Column) -> Column:
    return F.translate(c, FULL_WIDTH, HALF_WIDTH)


def normalize_query(c: Column) -> Column:
    """Lower case, half width, no operator characters, no question words."""
    out = to_half_width(F.lower(space_latin_cjk(c)))
    return rm_question_words(strip(F.regexp_replace(out, QUERY_PUNCTUATION, " ")))


# --- split, merge, replace ----------------------------------------------------------------------------


def alternation(delimiters) -> str:
    """Regular expression for any of the literal delimiters, longest first."""
    unique = sorted(set(delimiters), key=lambda d: (-len(d), d))
    return "|".join(re.escape(d) for d in unique)


def split_any(c: Column, delimiters) -> Column:
    return F.split(c, alternation(delimiters), -1)


def split_by_markers(c: Column, markers) -> Column:
    """Split by any marker, trim, drop blanks."""
    return F.filter(F.transform(split_any(c, markers), strip), lambda s: s != "")


def merge_template(template: str, **fields: Column) -> Column:
    """Fill ``{name}`` slots of a template."""
    out = F.lit(template)
    for name, value in fields.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def replace_variables(c: Column, variables: Column) -> Column:
    """Replace every ``{key}`` of a map column by its value."""
    return F.aggregate(
        F.map_entries(variables), c, lambda acc, e: F.replace(acc, F.concat(F.lit("{"), e["key"], F.lit("}")), e["value"])
    )


def split_combined_values(values: Column) -> Column:
    """Split list members on commas, semicolons and bars; trim; keep first occurrences."""

    def parts(v):
        pieces = F.filter(F.transform(F.split(strip(v), "[、,，;；|]+"), strip), lambda s: s != "")
        return F.when(F.size(pieces) > 0, pieces).otherwise(F.array(v))

    return F.array_distinct(F.flatten(F.transform(values, parts)))


# --- numbers and dates --------------------------------------------------------------------------------


def safe_float(c: Column) -> Column:
    return F.coalesce(F.expr("null").cast("double") if c is None else c.try_cast("double"), F.lit(float("-inf")))


def normalize_overlap_percent(c: Column) -> Column:
    value = c.try_cast("double")
    value = F.when((value > 0) & (value < 1), value * 100).otherwise(value)
    whole = F.when(value < 0, F.ceil(value)).otherwise(F.floor(value)).cast("int")
    return F.when(whole.isNull(), F.lit(0)).otherwise(F.greatest(F.lit(0), F.least(whole, F.lit(90))))


def parse_tag_features(c: Column) -> Column:
    """JSON (or single-quoted literal) map text to a map of finite numbers; anything else is an empty map."""
    text = strip(c)
    text = F.when(text.rlike(r"^\{\s*'"), F.replace(text, F.lit("'"), F.lit('"'))).otherwise(text)
    raw = F.try_variant_get(strict_json(text), "$", "map<string,variant>")
    numeric = F.map_filter(
        raw, lambda k, v: (strip(k) != "") & F.schema_of_variant(v).rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT)")
    )
    numbers = F.transform_values(
        F.transform_keys(numeric, lambda k, v: strip(k)), lambda k, v: F.try_variant_get(v, "$", "double")
    )
    return F.coalesce(numbers, F.create_map().cast("map<string,double>"))


def epoch_ms_to_text(c: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(F.timestamp_millis(c), pattern)


def text_to_epoch_ms(c: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.unix_millis(F.try_to_timestamp(c, F.lit(pattern)))


def iso_to_text(c: Column) -> Column:
    """ISO-8601 text to ``Y-m-d H:M:S`` in its own offset; other text unchanged."""
    local = F.regexp_replace(c, r"(Z|[+-][0-9]{2}:?[0-9]{2})$", "")
    stamp = F.when(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"), local.try_cast("timestamp_ntz"))
    return F.coalesce(F.date_format(stamp, "yyyy-MM-dd HH:mm:ss"), c)


def truncate_micros(c: Column) -> Column:
    return F.date_trunc("second", c)


def seconds_since(earlier: Column, now: Column | None = None) -> Column:
    later = F.current_timestamp() if now is None else now
    return (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / 1_000_000


# Spellings of a Boolean cell.
TRUE_CELLS = r"(?i)^(true|yes|是|\*|✓|✔|☑|✅|√)$"
FALSE_CELLS = r"(?i)^(false|no|否|⍻|×)$"
DATE_FORMATS = (
    "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd", "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd", "dd MMM yyyy", "MMM dd, yyyy", "yyyyMMdd",
)


def cell_to_bool(c: Column) -> Column:
    text = strip(c)
    return F.when(text.rlike(TRUE_CELLS), "yes").when(text.rlike(FALSE_CELLS), "no")


def cell_to_timestamp(c: Column) -> Column:
    return F.coalesce(*[F.try_to_timestamp(strip(c), F.lit(f)) for f in DATE_FORMATS])


def cell_to_date_text(c: Column) -> Column:
    return F.date_format(cell_to_timestamp(c), "yyyy-MM-dd HH:mm:ss")


# --- ids ----------------------------------------------------------------------------------------------


def content_id(*parts: Column) -> Column:
    return F.md5(F.concat(*[p.cast("string") for p in parts]))


def modulo_hash(c: Column, n: int) -> Column:
    """SHA-1 of the text as an integer, modulo ``n``, folded eight hex digits at a time."""
    digest = F.sha1(c)
    words = F.transform(
        F.sequence(F.lit(0), F.lit(4)), lambda i: F.conv(F.substr(digest, i * 8 + 1, F.lit(8)), 16, 10).cast("long")
    )
    return F.aggregate(words, F.lit(0).cast("long"), lambda acc, w: F.pmod(acc * F.lit(4294967296 % n) + w, F.lit(n)))


# --- similarity, highlight ------------------------------------------------------------------------------


def bigrams(c: Column) -> Column:
    n = F.length(c)
    return F.when(
        n > 1, F.array_distinct(F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substr(c, i, F.lit(2))))
    ).otherwise(F.array().cast("array<string>"))


def bigram_similarity(left: Column, right: Column) -> Column:
    """Shared bigrams over the larger set; the right text is read only as far as the left is long."""
    a = bigrams(left)
    b = bigrams(F.substr(right, F.lit(1), F.length(left) + 1))
    return F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.size(b), F.lit(1))


WORD_EDGE = r"""[ .?/'"()!,:;-]"""  # fixed value: characters a keyword may stand between


def highlight(c: Column, keywords, mode: str = "words") -> Column:
    """Wrap keyword matches in ``<em>`` and keep only the sentences that have one.

    ``mode``: ``words`` matches at word boundaries, ``literal`` anywhere (longest keyword first), ``auto``
    decides per sentence with :func:`is_english`.
    """
    flat = F.regexp_replace(c, "[\r\n]", " ")
    edge = WORD_EDGE

    def by_words(s):
        for word in keywords:
            s = F.regexp_replace(s, rf"(?i)(^|{edge})({re.escape(word)})({edge}|$)", "$1<em>$2</em>$3")
        return s

    def literal(s):
        for word in sorted(keywords, key=len, reverse=True):
            s = F.regexp_replace(s, rf"(?i){re.escape(word)}", f"<em>{word}</em>")
        return s

    def mark(s):
        if mode == "words":
            return by_words(s)
        if mode == "literal":
            return literal(s)
        return F.when(is_english(s), by_words(s)).otherwise(literal(s))

    sentences = F.filter(F.transform(F.split(flat, "[.?!;]"), strip), lambda s: s != "")
    hits = F.filter(F.transform(sentences, mark), lambda s: s.rlike("(?i)<em>[^<>]+</em>"))
    return F.when(F.size(hits) > 0, F.array_join(hits, "...")).otherwise(flat)


# --- answers --------------------------------------------------------------------------------------------

DIGITS = f"[0-9{ARABIC_DIGITS}{PERSIAN_DIGITS}]"


def _marker_number(digits: Column) -> Column:
    return normalize_arabic_digits(digits).try_cast("long")


def repair_citations(c: Column, n_chunks) -> Column:
    """Rewrite loose citation markers to ``[ID:n]`` when ``n`` is a valid chunk index."""
    limit = F.lit(n_chunks) if isinstance(n_chunks, int) else n_chunks
    # Loose marker forms, as (text before the number, text after it).
    forms = (
        (r"\(\s*ID\s*[: ]*\s*", r"\s*\)"),
        (r"\[\s*ID\s*[: ]*\s*", r"\s*\]"),
        (r"【\s*ID\s*[: ]*\s*", r"\s*】"),
        (r"(?i)ref\s*", rf"(?!{DIGITS})"),
    )
    for before, after in forms:
        found = F.array_distinct(F.regexp_extract_all(c, F.lit(f"{before}({DIGITS}+){after}"), F.lit(1)))
        valid = F.filter(found, lambda d: F.coalesce(_marker_number(d) < limit, F.lit(False)))
        c = F.aggregate(
            valid,
            c,
            lambda acc, d: F.regexp_replace(
                acc, F.concat(F.lit(before), d, F.lit(after)), F.concat(F.lit("[ID:"), d, F.lit("]"))
            ),
        )
    return c


def cited_ids(c: Column, n_chunks) -> Column:
    """Sorted distinct chunk indexes cited as ``[ID:n]`` or ``[n]``."""
    limit = F.lit(n_chunks) if isinstance(n_chunks, int) else n_chunks
    found = F.transform(F.regexp_extract_all(c, F.lit(rf"\[(?:ID:)?({DIGITS}+)\]"), F.lit(1)), _marker_number)
    return F.array_sort(F.array_distinct(F.filter(found, lambda d: F.coalesce(d < limit, F.lit(False)))))


def strip_reasoning(c: Column) -> Column:
    """Text after the last closing marker when an opening marker stands before it."""
    first = F.locate("<think>", c)
    last = F.length(c) - F.length(F.substring_index(c, "</think>", -1)) - len("</think>") + 1
    return F.when((first > 0) & F.contains(c, F.lit("</think>")) & (last >= first), F.substring_index(c, "</think>", -1)).otherwise(c)


def strict_json(c: Column) -> Column:
    """VARIANT of a text that is exactly one JSON value, else null (trailing content is not accepted)."""
    wrapped = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), c, F.lit("]"))), "$", "array<variant>")
    return F.when(F.size(wrapped) == 1, F.get(wrapped, F.lit(0)))


def parse_fenced_json(c: Column) -> Column:
    """Strip a JSON fence and parse; invalid text gives an empty object (as VARIANT)."""
    text = strip(c)
    text = F.when(F.startswith(text, F.lit("```json")), F.substr(text, F.lit(8))).otherwise(text)
    text = F.when(F.endswith(text, F.lit("```")), F.substr(text, F.lit(1), F.length(text) - 3)).otherwise(text)
    return F.coalesce(strict_json(strip(text)), F.parse_json(F.lit("{}")))


def front_matter(c: Column, default_name: Column) -> Column:
    """Struct of name, description and tags read from a ``---`` header."""
    header = F.regexp_extract(c, r"(?s)^[ \t]*---[ \t\r]*\n((?:.*?\n)??)[ \t]*---[ \t\r]*(?:\n|\z)", 1)

    def last(key):  # the last line of a key wins
        found = F.regexp_extract_all(header, F.lit(rf"(?m)^{key}:([^\n]*)$"), F.lit(1))
        return strip(F.element_at(F.when(F.size(found) > 0, found), -1))

    tags = last("tags")
    inner = F.btrim(tags, F.lit("[]"))
    listed = F.when(
        tags.rlike(r"^\[.*\]$"), F.transform(F.split(inner, ","), strip)
    ).when(F.coalesce(tags, F.lit("")) != "", F.array(tags)).otherwise(F.array().cast("array<string>"))
    return F.struct(
        F.coalesce(last("name"), default_name).alias("name"),
        F.coalesce(last("description"), F.lit("")).alias("description"),
        listed.alias("tags"),
    )


def increment_version(c: Column) -> Column:
    """Patch + 1 with carry at 999; anything but three parts restarts at 1.0.0."""
    parts = F.split(F.coalesce(c, F.lit("")), r"\.")
    major, minor, patch = [
        F.coalesce(F.regexp_extract(F.get(parts, F.lit(i)), r"^\s*([+-]?[0-9]+)", 1).try_cast("int"), F.lit(0)) for i in range(3)
    ]
    carry_minor = patch + 1 > 999
    carry_major = carry_minor & (minor + 1 > 999)
    new_patch = F.when(carry_minor, F.lit(0)).otherwise(patch + 1)
    new_minor = F.when(carry_major, F.lit(0)).when(carry_minor, minor + 1).otherwise(minor)
    new_major = F.when(carry_major, major + 1).otherwise(major)
    return F.when(F.size(parts) == 3, F.format_string("%d.%d.%d", new_major, new_minor, new_patch)).otherwise("1.0.0")
