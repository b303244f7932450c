"""Quality rules with thresholds taken from the corpus itself.

Fixed cutoffs misjudge a language or a source with habits of its own.  Here
each (language, source) gets a KLL quantile sketch of every metric over its
documents that pass the base rules; sketches merge, so a source with few
documents takes the sketch of its language, and a language with few takes that
of all.  A document is kept if each metric lies inside the fences

    q25 - REACH * (q75 - q25) - slack  ..  q75 + REACH * (q75 - q25) + slack

of its group.  Everything is DataFrame work; only the metrics, never the text,
take part in the aggregation and the join.

Words are ``[^\\x20\\x09-\\x0D]+``.  A null text has none and fails the base
rules.  Null languages and sources form groups of their own.  Repeated rows are
judged one by one.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import clean_columns, stored

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
#: Documents that a group needs for thresholds of its own.
ENOUGH = 200
REACH = 3.0
#: Items a sketch keeps at its finest level: the rank error is about 0.1 %.
SKETCH_K = 4096
#: metric: (lower fence?, upper fence?, slack in the metric's unit)
METRICS = {
    "symbol_rate": (False, True, 0.1),
    "dup_line_rate": (False, True, 0.3),
    "repeat_rate": (False, True, 0.3),
    "word_length": (True, True, 0.5),
}


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words inside a three-word window that the text holds twice or more.

    Windows are compared by 64-bit hashes.  Sorted by (hash, place), equal
    windows are neighbours; their places, sorted again, cover three words
    each, less what the one before covers too.
    """
    n = F.size(words)
    windows = F.transform(
        F.sequence(F.lit(1), n - 2),
        lambda i: F.struct(F.xxhash64(F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)).alias("h"), i.alias("i")),
    )
    def twice(s):
        return F.filter(s, lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]))

    def covered(at):
        return F.aggregate(
            at,
            F.struct(F.lit(-2).alias("last"), F.lit(0).alias("n")),
            lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")),
            lambda acc: acc["n"],
        )

    found = let(F.sort_array(windows), lambda s: let(F.transform(F.coalesce(twice(s), F.array()), lambda x: x["i"]), lambda at: covered(F.sort_array(at))))
    return F.when(n < 3, 0).otherwise(found)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the five counts and base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    length = lambda drop: F.length(text) - F.length(F.translate(text, drop, ""))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
    counts = docs.select(
        "doc_id",
        "lang",
        "source",
        (F.length(text) - length(SPACE)).cast("long").alias("word_chars"),
        length(SYMBOLS).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))).alias("lines"),
        let(words, lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("repeat"))).alias("words"),
    )
    n, rep = F.col("words.n").cast("long"), F.col("words.repeat").cast("long")
    return counts.select(
        "doc_id",
        "lang",
        "source",
        n.alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("lines.dup").cast("long").alias("n_dup_lines"),
        rep.alias("n_repeat_words"),
        F.col("lines.n").cast("long").alias("n_lines"),
        ((n < 50) | (100 * rep > 50 * n)).alias("base_failed"),
    )


def with_metrics(counts: DataFrame) -> DataFrame:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return counts.withColumns(
        {
            "symbol_rate": F.col("n_symbols") / n,
            "dup_line_rate": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double"),
            "repeat_rate": F.col("n_repeat_words") / n,
            "word_length": F.col("word_chars") / n,
        }
    )


def thresholds(metrics: DataFrame) -> DataFrame:
    """Fences of each (lang, source), from its own or a merged sketch."""
    passed = metrics.filter(~F.col("base_failed"))
    sketch = [F.expr(f"kll_sketch_agg_double({m}, {SKETCH_K})").alias(m) for m in METRICS]
    merged = [F.expr(f"kll_merge_agg_double({m}, {SKETCH_K})").alias(m) for m in METRICS]
    by_source = stored(passed.groupBy("lang", "source").agg(F.count("*").alias("n"), *sketch), "quality-sketches")
    by_lang = by_source.groupBy("lang").agg(F.sum("n").alias("n"), *merged)
    overall = by_lang.groupBy().agg(F.sum("n").alias("n"), *merged)

    def fences(df: DataFrame, prefix: str) -> list[Column]:
        out = [F.col("n").alias(f"{prefix}_n")]
        for m, (low, high, slack) in METRICS.items():
            q25, q75 = (F.when(F.col("n") > 0, F.expr(f"kll_sketch_get_quantile_double({m}, {p}D)")) for p in ("0.25", "0.75"))
            reach = REACH * (q75 - q25) + slack
            out += [(q25 - reach).alias(f"{prefix}_{m}_low")] * low + [(q75 + reach).alias(f"{prefix}_{m}_high")] * high
        return out

    groups = by_source.select("lang", "source", *fences(by_source, "s"))
    langs = by_lang.select(F.col("lang").alias("l_lang"), *fences(by_lang, "l"))
    # One row with the fences of all documents together.
    alls = overall.select(*fences(overall, "a")).first()
    joined = groups.join(langs, F.col("lang").eqNullSafe(F.col("l_lang")))
    pick = lambda c: F.when(F.col("s_n") >= ENOUGH, F.col(f"s_{c}")).when(F.col("l_n") >= ENOUGH, F.col(f"l_{c}")).otherwise(F.lit(alls[f"a_{c}"]).cast("double"))
    names = [f"{m}_{side}" for m, (low, high, _) in METRICS.items() for side, on in (("low", low), ("high", high)) if on]
    return joined.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), *(pick(c).alias(c) for c in names))


def quality_rules(docs: DataFrame) -> DataFrame:
    """The counts, base_failed and kept of each document."""
    metrics = with_metrics(stored(measured(clean_columns(docs, "doc_id", "text", "lang", "source")), "quality-counts"))
    limits = thresholds(metrics)
    inside = F.lit(True)
    for m, (low, high, _) in METRICS.items():
        inside &= (F.col(m) >= F.col(f"{m}_low")) if low else F.lit(True)
        inside &= (F.col(m) <= F.col(f"{m}_high")) if high else F.lit(True)
    same = F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source"))
    judged = metrics.join(limits, same, "left")
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"))
