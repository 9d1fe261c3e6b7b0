"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule's cost and rejection rate are measured on a sample; rules then run in the order of rejection per cost, and a document
that one rule rejects is not looked at by the later ones. The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from statistics import median

from pyspark.sql import Column, DataFrame, functions as F

from spotshare.plans.staging import write_stage

SAMPLE = 1_000  # rows on which costs and rejections are measured, about
COPIES, RUNS = 8, 3  # of the sample in a timed job, and of each job
_SPACE = r"\x20\x09-\x0D"


@dataclass(frozen=True)
class Rule:
    """A name and an SQL condition under which a document is rejected, over ``text`` and the columns of ``measured``."""

    name: str
    rejects: str


BASE = (
    Rule("few words", "n_words < 10"),
    Rule("repeated words", "100 * n_repeat_words > 20 * n_words"),
)
RULES = (
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("word length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("repeated lines", "10 * n_dup_lines > 3 * size(split(text, '\\n'))"),
    Rule("capitals", "2 * length(regexp_replace(text, '[^A-Z]', '')) > word_chars"),
    Rule("exclamations", "10 * (length(text) - length(replace(text, '!!', ''))) > 4 * n_words"),
)


def _tail(values: Column, by: int) -> Column:
    return F.slice(values, F.lit(by + 1), F.greatest(F.size(values) - by, F.lit(0)))


def _head(values: Column, short: int) -> Column:
    return F.slice(values, F.lit(1), F.greatest(F.size(values) - short, F.lit(0)))


def _joined(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (longs) for every row.

    Words are runs of other than ASCII white space. NULL texts count as empty: all zero. Columns of these names are replaced.
    Windows of five words are compared by 64-bit hashes within a text.
    """
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    keep = [f"`{c}`" for c in docs.columns if c.lower() not in made]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    hashes = [f"__{n}" for n in ("words", "lines", "w1", "w2", "w4", "w5", "sorted", "same", "starts")]
    words, lines, w1, w2, w4, w5, order, same, starts = (F.col(n) for n in hashes)
    rows = docs.select(
        *keep, F.regexp_extract_all(text, F.lit(f"[^{_SPACE}]+"), F.lit(0)).alias("__words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{_SPACE}]")).alias("__lines"),
    )
    rows = rows.select(
        *keep, F.size(words).cast("long").alias("n_words"),
        F.length(F.regexp_replace(text, f"[{_SPACE}]+", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.transform(words, lambda w: F.xxhash64(w)).alias("__w1"),
    )
    base = [*keep, *made[:4]]
    rows = rows.select(*base, "__w1", _joined(_head(w1, 1), _tail(w1, 1)).alias("__w2"))
    rows = rows.select(*base, "__w1", _joined(_head(w2, 2), _tail(w2, 2)).alias("__w4"))
    rows = rows.select(*base, _joined(_head(w4, 1), _tail(w1, 4)).alias("__w5"))
    # only texts with a repeated window sort theirs
    rows = rows.select(*base, F.when(F.size(F.array_distinct(w5)) < F.size(w5), F.sort_array(
        F.transform(w5, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("__sorted"))
    rows = rows.select(*base, "__sorted", F.zip_with(_head(order, 1), _tail(order, 1), lambda a, b: a["h"] == b["h"]).alias("__same"))
    no = F.array(F.lit(False))
    flags = F.zip_with(F.concat(same, no), F.concat(no, same), lambda a, b: a | b)
    rows = rows.select(*base, F.sort_array(F.transform(
        F.filter(F.zip_with(order, flags, lambda s, f: F.struct(s["i"].alias("i"), f.alias("f"))), lambda x: x["f"]), lambda x: x["i"])).alias("__starts"))
    steps = F.zip_with(_head(starts, 1), _tail(starts, 1), lambda a, b: F.least(b - a, F.lit(5)))
    return rows.select(*base, F.coalesce(F.aggregate(steps, F.lit(5), lambda total, x: total + x), F.lit(0)).cast("long").alias("n_repeat_words"))


def _costs(part: DataFrame, rules: tuple[Rule, ...]) -> list[float]:
    """Seconds that each rule takes on ``COPIES`` copies of the rows, without those of a job that evaluates none: medians of several
    runs, the first of which, where code is compiled, don't count.
    """
    rows = part.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES))))
    jobs = [rows.agg(F.count_if(F.expr(c))) for c in ("n_words < 0", *(r.rejects for r in rules))]
    taken: list[list[float]] = [[] for _ in jobs]
    for _ in range(RUNS + 1):
        for job, seconds in zip(jobs, taken):
            start = time.perf_counter()
            job.first()
            seconds.append(time.perf_counter() - start)
    idle, *own = (median(seconds[1:]) for seconds in taken)
    return [max(s - idle, 1e-4) for s in own]


def order_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> list[Rule]:
    """``rules`` by falling rejection per cost, as measured on about ``sample`` rows of ``docs``.

    A rule that rejects nothing comes last, the cheapest first; an empty table keeps the order given.
    """
    total = docs.count()
    if not total:
        return list(rules)
    part = write_stage(measured(docs.sample(min(1.0, sample / total), seed=3)), "rules")
    rates = part.agg(*(F.avg(F.coalesce(F.expr(r.rejects), F.lit(False)).cast("int")).alias(f"r{i}") for i, r in enumerate(rules))).first()
    costs = _costs(part, rules)
    return [rules[i] for *_, i in sorted((-(rates[i] or 0.0) / costs[i], costs[i], i) for i in range(len(rules)))]


def cascade(docs: DataFrame, rules: list[Rule]) -> Column:
    """The name of the first of ``rules`` that rejects a document, else NULL; later rules are then not evaluated."""
    if not rules:
        return F.lit(None).cast("string")
    chain = F.when(F.expr(rules[0].rejects), F.lit(rules[0].name))
    for rule in rules[1:]:
        chain = chain.when(F.expr(rule.rejects), F.lit(rule.name))
    return chain


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with the columns of ``measured``, ``base_failed``, ``failed_rule`` (which depends on the order) and ``kept``.

    Every row gets a verdict. A NULL or empty text has no words and fails the base rules. Columns of these names are replaced.
    """
    base = F.expr(" OR ".join(f"({r.rejects})" for r in BASE))
    docs = docs.drop("base_failed", "failed_rule", "kept")
    order = order_rules(docs, rules, sample)
    rows = measured(docs).withColumn("base_failed", base)
    rows = rows.withColumn("failed_rule", F.when(F.col("base_failed"), F.lit("base")).otherwise(cascade(rows, order)))
    return rows.withColumn("kept", F.col("failed_rule").isNull())
