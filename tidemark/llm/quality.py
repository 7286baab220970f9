"""Quality rules: a threshold table compiled into one projection.

``measures`` gives the counts of a text as native columns, ``RULES`` says which ratios are too high or too low,
and ``compile_rules`` turns the table into boolean columns. Every ratio is a comparison of integers
(``100 * part > percent * whole``), so the verdict is exact and the same in any engine. There is no shuffle.

Defined cases: a null or empty text has no words, all counts are 0 and the document fails ``min_words``.
Equal rows give equal results, ties cannot occur, an empty table gives an empty table. All input columns but the
key and the text are ignored unless ``judge`` is asked to keep them; measures then win over columns of their name.
Repeated five-word windows are found by 64-bit hashes of the windows of one text.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_GAP

#: Words per window whose repetition counts.
WINDOW = 5

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is it that for with on as are was by this from be at or an not "
    "le la les de des du et un une en que qui est pour par sur dans avec au "
    "der die das und den von zu mit ist auf ein eine im nicht für als auch "
    "el los las del y a se con su una por no lo para"
).split()


class Rule(NamedTuple):
    """Fails when ``100 * part`` is above (``max``), or ``100 * (part + slack)`` below (``min``), ``percent * whole``."""

    name: str
    part: str
    whole: str
    kind: str
    percent: int
    slack: int = 0


#: A text that the base rules let through is kept unless one of these fails.
RULES = (
    Rule("short_words", "word_chars", "n_words", "min", 200),
    Rule("long_words", "word_chars", "n_words", "max", 2500),
    Rule("symbols", "n_symbols", "n_words", "max", 10),
    Rule("stop_words", "n_stop_words", "n_words", "min", 3, 1),
    Rule("repeated_lines", "n_dup_lines", "n_lines", "max", 40),
)
BASE_MIN_WORDS, BASE_REPEAT_PERCENT = 10, 20
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words")


def _let(value: Column, body) -> Column:
    """``body`` over ``value``, computed once for each row: a bound variable, not a repeated expression."""
    return F.transform(F.array(value), body)[0]


def _covered(windows: Column) -> Column:
    """Words covered by windows that occur twice or more, from the array of window hashes.

    Sorted (hash, place) pairs put equal windows side by side; the places of those, sorted again, are summed up
    by the step to the next place, five at most. Everything is n log n in the length of the text.
    """
    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(p: Column) -> Column:
        same = lambda a, b: F.coalesce(F.get(p, a)["h"] == F.get(p, b)["h"], F.lit(False))
        hit = F.filter(p, lambda x, k: same(k, k - 1) | same(k, k + 1))
        return F.array_sort(F.transform(hit, lambda x: x["i"]))

    def total(at: Column) -> Column:
        steps = F.transform(at, lambda x, k: F.coalesce(F.least(F.get(at, k + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x)

    return _let(pairs, lambda p: _let(places(p), total))


def measures(text: Column) -> Column:
    """One struct of the counts of a text (null: empty)."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, WORD_GAP), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(w: Column) -> Column:
        size = F.size(w)
        windows = F.when(size >= WINDOW, F.transform(
            F.sequence(F.lit(0), F.greatest(size - WINDOW, F.lit(0))),
            lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]),
        )).otherwise(F.array().cast("array<bigint>"))
        repeated = _let(windows, lambda h: F.when(
            F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(_covered(h)))
        stops = F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS)))
        return F.struct(size.cast("long").alias("n_words"), repeated.alias("n_repeat_words"),
                        stops.cast("long").alias("n_stop_words"))

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).cast("long").alias("n_lines"),
                        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))

    return F.struct(
        F.length(F.regexp_replace(text, WORD_GAP, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        _let(words, of_words).alias("w"), _let(lines, of_lines).alias("l"),
    )


def compile_rules(rules=RULES) -> dict[str, Column]:
    """A boolean column for each rule: true where the text breaks it."""
    out = {}
    for rule in rules:
        part = (F.col(rule.part) + (rule.slack if rule.kind == "min" else 0)) * 100
        whole = F.col(rule.whole) * rule.percent
        out[rule.name] = part > whole if rule.kind == "max" else part < whole
    return out


def judge(docs: DataFrame, text: str = "text", keep: list[str] | None = None, rules=RULES) -> DataFrame:
    """The kept columns with counts, one boolean for each rule (``breaks_<rule>``), ``base_failed`` and ``kept``."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in COUNTS]
    m = docs.select(*keep, measures(F.col(text)).alias("__m"))
    m = m.select(*keep, *[F.col(f"__m.{'w.' if c in ('n_words', 'n_repeat_words', 'n_stop_words') else 'l.' if c in ('n_lines', 'n_dup_lines') else ''}{c}").alias(c) for c in COUNTS])
    base = (F.col("n_words") < BASE_MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * BASE_REPEAT_PERCENT)
    broken = compile_rules(rules)
    kept = ~base
    for bad in broken.values():
        kept = kept & ~bad
    return m.select(*keep, *COUNTS, *[bad.alias(f"breaks_{n}") for n, bad in broken.items()],
                    base.alias("base_failed"), kept.alias("kept"))

def good_ones(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``docs``, columns unchanged, that the rules keep."""
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    return judge(rows, "text", ["row"], rules).where("kept").select("row.*")


_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
ORACLE = f"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS s,
         list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents
), g AS (
  SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM t WHERE len(w) >= 5
), h AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i+1], w[i+2], w[i+3], w[i+4]) AS n FROM g
), r AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i+1, i+2, i+3, i+4]) AS p FROM h WHERE n > 1)
  GROUP BY doc_id
), m AS (
  SELECT t.doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(s, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(s, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines,
         len(list_filter(w, lambda x: lower(x) IN ({_STOPS})))::BIGINT AS n_stop_words
  FROM t LEFT JOIN r ON r.doc_id = t.doc_id
), b AS (
  SELECT *, {", ".join(
      f"100 * ({r.part} + {r.slack if r.kind == 'min' else 0}) {'>' if r.kind == 'max' else '<'} {r.percent} * {r.whole} AS breaks_{r.name}"
      for r in RULES)},
      n_words < {BASE_MIN_WORDS} OR 100 * n_repeat_words > {BASE_REPEAT_PERCENT} * n_words AS base_failed
  FROM m
)
SELECT *, NOT (base_failed OR {" OR ".join(f"breaks_{r.name}" for r in RULES)}) AS kept FROM b
"""
