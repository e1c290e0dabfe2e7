"""Quality rules: a threshold table compiled into one Spark projection.

Every rule is a ratio or a count with a closed range.  The table is data; the
compiler turns it into one ``select`` of built-in functions, so a document is
read once, nothing is shuffled and no user function runs.

Defined results: a null text counts as no words at all; an empty text, too.
Ratios over zero words or lines are 0.  Rows that repeat are judged one by
one; extra input columns are ignored (``apply_rules``) or kept as they are
(``keep_documents``).  An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "[\\x20\\x09-\\x0D]+"

# fixed values: frequent function words of the supported languages
STOP_WORDS = (
    "the of and to in a is that be it was for on are as with his they at this from have or by not "
    "de la le et les des en un une du que est pour qui dans au par sur pas plus ce il "
    "el los las y se del por con para al lo como más "
    "der die das und ist von den mit zu im nicht ein eine auf für dem sich auch es").split()


@dataclass(frozen=True)
class Rule:
    """Keep a document when ``low <= measure <= high`` (None: no bound)."""
    measure: str
    low: float | None = None
    high: float | None = None


# the threshold table; measures are the keys of MEASURES
RULES = (
    Rule("n_words", 50, None),
    Rule("mean_word_chars", 2.0, 15.0),
    Rule("symbol_ratio", None, 0.10),        # symbols per word
    Rule("stop_word_ratio", 0.02, None),     # stop words per word
    Rule("dup_line_ratio", None, 0.50),      # repeated lines per line with a word
    Rule("repeat_word_ratio", None, 0.50),   # words in repeated 3-word windows per word
    Rule("upper_word_ratio", None, 0.50),    # words wholly in capitals per word
    Rule("line_end_ratio", None, 0.30),      # lines ending in an ellipsis
    Rule("bullet_line_ratio", None, 0.90),   # lines starting with a bullet
)


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))


MEASURES = {
    "n_words": lambda: F.col("n_words").cast("double"),
    "mean_word_chars": lambda: _ratio("word_chars", "n_words"),
    "symbol_ratio": lambda: _ratio("n_symbols", "n_words"),
    "stop_word_ratio": lambda: _ratio("n_stop_words", "n_words"),
    "dup_line_ratio": lambda: _ratio("n_dup_lines", "n_lines"),
    "repeat_word_ratio": lambda: _ratio("n_repeat_words", "n_words"),
    "upper_word_ratio": lambda: _ratio("n_upper_words", "n_words"),
    "line_end_ratio": lambda: _ratio("n_ellipsis_lines", "n_lines"),
    "bullet_line_ratio": lambda: _ratio("n_bullet_lines", "n_lines"),
}


def _without(col: Column, chars: str) -> Column:
    for c in chars:
        col = F.replace(col, F.lit(c), F.lit(""))
    return col


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts behind the rules, as columns of one struct
    ``q`` (a struct, so that input columns of any name stay untouched).

    Repeated 3-word windows: a text's windows are sorted as (64-bit hash,
    place); equal ones are then neighbours, and the places of those that have
    an equal neighbour, back in order, cover min(3, distance to the place
    before) words each.  Linear memory in the text, n log n time."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    split = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).select(
        "row", "t",
        F.filter(F.split("t", SPACE), lambda w: w != "").alias("w"),
        F.filter(F.split("t", "\n"), lambda x: F.trim(x, F.lit(" \t\x0b\x0c\r")) != "").alias("ln"))
    windows = split.select("*", F.expr("""
        if(size(w) < 4, cast(array() as array<struct<h:bigint,i:int>>),
           sort_array(transform(sequence(0, greatest(size(w) - 3, 0)),
                                i -> struct(xxhash64(w[i], w[i + 1], w[i + 2]) as h, i as i))))""").alias("s"))
    places = windows.select("row", "t", "w", "ln", F.expr("""
        sort_array(transform(filter(s, (e, k) -> e.h <=> get(s, k - 1).h or e.h <=> get(s, k + 1).h),
                             e -> e.i))""").alias("d"))
    counts = F.struct(
        F.size("w").cast("long").alias("n_words"),
        F.length(_without(F.col("t"), " \n\t\r\x0b\x0c")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(_without(F.col("t"), "#*$%&|<>"))).cast("long").alias("n_symbols"),
        (F.size("ln") - F.size(F.array_distinct("ln"))).cast("long").alias("n_dup_lines"),
        F.expr("aggregate(transform(d, (v, k) -> least(3, v - coalesce(get(d, k - 1), v - 3))), 0L, (n, v) -> n + v)")
        .alias("n_repeat_words"),
        F.size("ln").cast("long").alias("n_lines"),
        F.size(F.filter("ln", lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…")))
        .cast("long").alias("n_ellipsis_lines"),
        F.size(F.filter("ln", lambda x: F.substring(F.ltrim(x), 1, 1).isin("-", "*", "•")))
        .cast("long").alias("n_bullet_lines"),
        F.expr(f"size(filter(w, x -> lower(x) in ({stop})))").cast("long").alias("n_stop_words"),
        F.expr("size(filter(w, x -> x = upper(x) and x != lower(x)))").cast("long").alias("n_upper_words"))
    # a generator of one row each: predicates on the counts stay above it, where
    # a plain projection would be copied into them and evaluated again
    return places.select("row", F.explode(F.array(counts)).alias("q"))


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """The compiled table: true when every rule holds.  Expects the fields of
    ``q`` as columns."""
    ok = F.lit(True)
    for r in rules:
        m = MEASURES[r.measure]()
        if r.low is not None:
            ok = ok & (m >= F.lit(float(r.low)))
        if r.high is not None:
            ok = ok & (m <= F.lit(float(r.high)))
    return ok


def _base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, the counts, ``base_failed`` and ``kept``."""
    flat = measured(docs, text_col).select(F.col("row")[id_col].alias("doc_id"), "q.*")
    return (flat.withColumn("base_failed", _base_failed())
            .withColumn("kept", ~F.col("base_failed") & verdict(rules)))


def keep_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, all their columns unchanged."""
    judged = measured(docs, text_col).select("row", "q.*")
    return judged.where(~_base_failed() & verdict(rules)).select("row.*")


def query(spark, sf_dir):
    from footfall.llm.common import table
    return apply_rules(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return f"""
with docs as (select doc_id, coalesce(text, '') as t from documents),
split as (
  select doc_id, t, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ln
  from docs),
win as (
  select doc_id, unnest(list_transform(generate_series(1, len(w) - 2),
                                       lambda i: {{'i': i, 'x': [w[i], w[i + 1], w[i + 2]]}})) as p
  from split where len(w) >= 3),
rep as (select doc_id, p.i as i, count(*) over (partition by doc_id, p.x) as n from win),
covered as (
  select doc_id, count(distinct i + k) as n_repeat_words
  from rep, (select unnest([0, 1, 2]) as k) where n > 1 group by doc_id),
counts as (
  select s.doc_id, cast(len(w) as bigint) as n_words,
         cast(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) as bigint) as word_chars,
         cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(len(ln) - len(list_distinct(ln)) as bigint) as n_dup_lines,
         coalesce(n_repeat_words, 0) as n_repeat_words,
         cast(len(ln) as bigint) as n_lines,
         cast(len(list_filter(ln, lambda x: ends_with(rtrim(x), '...') or ends_with(rtrim(x), '…'))) as bigint)
           as n_ellipsis_lines,
         cast(len(list_filter(ln, lambda x: substr(ltrim(x), 1, 1) in ('-', '*', '•'))) as bigint)
           as n_bullet_lines,
         cast(len(list_filter(w, lambda x: lower(x) in ({stop}))) as bigint) as n_stop_words,
         cast(len(list_filter(w, lambda x: x = upper(x) and x <> lower(x))) as bigint) as n_upper_words
  from split s left join covered c using (doc_id)),
judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counts)
select *, not base_failed and {_oracle_verdict()} as kept from judged"""


def _oracle_verdict() -> str:
    terms = {"n_words": "n_words", "mean_word_chars": "word_chars / nullif(n_words, 0)",
             "symbol_ratio": "n_symbols / nullif(n_words, 0)", "stop_word_ratio": "n_stop_words / nullif(n_words, 0)",
             "dup_line_ratio": "n_dup_lines / nullif(n_lines, 0)",
             "repeat_word_ratio": "n_repeat_words / nullif(n_words, 0)",
             "upper_word_ratio": "n_upper_words / nullif(n_words, 0)",
             "line_end_ratio": "n_ellipsis_lines / nullif(n_lines, 0)",
             "bullet_line_ratio": "n_bullet_lines / nullif(n_lines, 0)"}
    parts = []
    for r in RULES:
        m = f"coalesce({terms[r.measure]}, 0)"
        parts += [f"{m} >= {r.low}"] * (r.low is not None) + [f"{m} <= {r.high}"] * (r.high is not None)
    return "(" + " and ".join(parts) + ")"


ORACLE = _oracle()
