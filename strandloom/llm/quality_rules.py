"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.llm import _common as c
from strandloom.llm._common import ASCII_SPACE, let

WORD_GAP = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

# Common short words of the languages in use (English, French, German, Spanish).
STOP_WORDS = (
    "the of and to in a is that it for was on with are as at by this be from or an "
    "la de le les et des un une du que qui est en pour dans au par sur avec "
    "der die und das den von zu mit sich ist ein eine auf für dem im "
    "el los las y con para se del al lo no su es por una"
).split()


@dataclass(frozen=True)
class Rule:
    """A document passes if ``metric`` is within the bounds that are given."""

    metric: str
    at_least: float | None = None
    at_most: float | None = None


#: The production table. Ratios are to the number of words, or of lines that hold a word.
RULES = (
    Rule("mean_word_chars", at_least=3.0, at_most=12.0),
    Rule("symbol_ratio", at_most=0.1),
    Rule("exclamation_ratio", at_most=0.5),
    Rule("stop_word_ratio", at_least=0.06),
    Rule("dup_line_ratio", at_most=0.5),
)


def _words(text: Column) -> Column:
    inner = F.btrim(text, F.lit(ASCII_SPACE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, WORD_GAP))


def _windows(words: Column) -> Column:
    """A 64-bit hash of each 3-word window, in order."""
    n = F.size(words)
    made = F.transform(F.slice(words, 1, F.greatest(n - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(n >= 3, made).otherwise(F.array().cast("array<bigint>"))


def _covered(windows: Column) -> Column:
    """How many words stand in windows that occur again."""

    def again(order: Column) -> Column:
        alike = F.filter(order, lambda x, j: (F.get(order, j - 1)["h"] == x["h"]) | (F.get(order, j + 1)["h"] == x["h"]))
        return F.filter(F.array_sort(F.transform(alike, lambda x: x["i"])), lambda i: i.isNotNull())

    def length(at: Column) -> Column:
        own = F.transform(at, lambda i, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1), i + 3) - i))
        return F.aggregate(own, F.lit(0), lambda a, b: a + b)

    order = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(let(let(order, again), length))


def _line_counts(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_CHAR))
    return let(lines, lambda x: F.struct(F.size(x).alias("all"), F.size(F.array_distinct(x)).alias("distinct")))


def _stats(text: Column) -> Column:
    """A struct of all counts of a text; words and lines are made once."""

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
            let(_windows(w), _covered).cast("long").alias("n_repeat_words"),
        )

    return let(_words(text), of_words)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts and ratios that rules can name; null texts have no words and no lines.

    Columns of the same names are replaced. Whole texts count, however long. No shuffle.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    by_word, by_line = c.unused(df, "_word_stats"), c.unused(df, "_line_stats")
    made = df.withColumns(
        {
            by_word: _stats(t),
            by_line: _line_counts(t),
            "n_symbols": F.regexp_count(t, F.lit(SYMBOLS)).cast("long"),
            "n_exclamations": F.regexp_count(t, F.lit("!")).cast("long"),
        }
    )
    lines, words = F.col(by_line), F.col(by_word)
    made = made.withColumns(
        {name: words[name] for name in ("n_words", "word_chars", "n_stop_words", "n_repeat_words")}
        | {"n_lines": lines["all"].cast("long"), "n_dup_lines": (lines["all"] - lines["distinct"]).cast("long")}
    ).drop(by_word, by_line)
    n = F.col("n_words")
    return made.withColumns(
        {
            "mean_word_chars": _ratio(F.col("word_chars"), n),
            "symbol_ratio": _ratio(F.col("n_symbols"), n),
            "exclamation_ratio": _ratio(F.col("n_exclamations"), n),
            "stop_word_ratio": _ratio(F.col("n_stop_words"), n),
            "dup_line_ratio": _ratio(F.col("n_dup_lines"), F.col("n_lines")),
        }
    )


def compile_rules(rules: tuple[Rule, ...]) -> Column:
    """One boolean column: whether every rule of the table holds."""
    held = F.lit(True)
    for r in rules:
        if r.at_least is not None:
            held = held & (F.col(r.metric) >= F.lit(float(r.at_least)))
        if r.at_most is not None:
            held = held & (F.col(r.metric) <= F.lit(float(r.at_most)))
    return held


def apply(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``measure`` plus ``base_failed`` and ``kept``.

    ``base_failed``: fewer than 50 words, or over half of them in 3-word windows that occur again. ``kept``:
    not ``base_failed`` and all ``rules`` hold. Empty and null texts fail; each row is judged alone, so
    repeated rows get equal verdicts.
    """
    out = measure(df, text)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & compile_rules(rules))


def oracle_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The same rows in DuckDB SQL: doc_id, the counts of the contract, base_failed and kept."""
    held = [f"{r.metric} {op} {bound!r}" for r in rules for op, bound in ((">=", r.at_least), ("<=", r.at_most)) if bound is not None]
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return rf"""
with d as (
  select doc_id, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from documents
),
g as (
  select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as gram
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) as i from d)
),
again as (select doc_id, gram from g group by doc_id, gram having count(*) > 1),
covered as (
  select doc_id, count(*) as n from (
    select distinct doc_id, i + k as p from g join again using (doc_id, gram) cross join (values (0), (1), (2)) as s(k)
  ) group by doc_id
),
m as (
  select d.doc_id, cast(len(w) as bigint) as n_words,
    cast(length(array_to_string(w, '')) as bigint) as word_chars,
    cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(length(t) - length(replace(t, '!', '')) as bigint) as n_exclamations,
    cast(len(l) as bigint) as n_lines,
    cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
    cast(len(list_filter(w, lambda x: lower(x) in ({stop}))) as bigint) as n_stop_words,
    cast(coalesce(c.n, 0) as bigint) as n_repeat_words
  from d left join covered c on c.doc_id = d.doc_id
),
r as (
  select *,
    case when n_words > 0 then word_chars / n_words else 0 end as mean_word_chars,
    case when n_words > 0 then n_symbols / n_words else 0 end as symbol_ratio,
    case when n_words > 0 then n_exclamations / n_words else 0 end as exclamation_ratio,
    case when n_words > 0 then n_stop_words / n_words else 0 end as stop_word_ratio,
    case when n_lines > 0 then n_dup_lines / n_lines else 0 end as dup_line_ratio,
    (n_words < 50 or 100 * n_repeat_words > 50 * n_words) as base_failed
  from m
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (not base_failed and {" and ".join(held)}) as kept
from r
"""
