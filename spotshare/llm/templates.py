"""Benchmark decontamination by template windows, in DataFrame functions only.

Numbers, names and units of a text become typed placeholders. Windows of the canonical words are hash-joined with those of the
benchmark's items, so a question is found even if it was asked again with other parameters. The values that stood in the
placeholders must then map one to one: an item's value has the same value in the document wherever it occurs. Where enough
windows are equal in raw words, values edited elsewhere don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spotshare.plans.staging import join_side, write_stage

WINDOW = 8  # canonical words
LITERALS = 5  # of these, words of a window that are no placeholders
LEAST_WINDOWS = 3  # in one alignment, or all windows of a shorter item

# Units that count as such after a number.
UNITS = (
    "mm cm m km inch inches ft feet yd yards mile miles g mg kg lb lbs oz ton tons ml l litre litres liter liters gallon gallons "
    "s sec second seconds min minute minutes h hr hrs hour hours day days week weeks month months year years "
    "usd eur gbp dollar dollars euro euros cent cents percent mph kmh kph degree degrees watt watts kw kwh volt volts amp amps "
    "hz khz mhz ghz kb mb gb tb byte bytes"
).split()
_NUMBER, _QUANTITY, _NAME = "\u0001", "\u0002", "\u0003"
_NUMBERS = r"[0-9]+(?:[.,:/][0-9]+)*"
# a number with its unit; a number; a word with the sentence end before it; a word
_TOKEN = (
    rf"{_NUMBERS} ?(?i:{'|'.join(sorted(UNITS, key=len, reverse=True))})(?![\p{{L}}\p{{N}}])|{_NUMBERS}"
    r"|[.!?]\s+[\p{L}\p{M}]+|[\p{L}\p{M}]+"
)


def words_of(text: Column) -> Column:
    """Words, numbers and quantities of a text. A word that starts a sentence has the end of the last one before it."""
    return F.regexp_extract_all(F.concat(F.lit(". "), F.coalesce(text, F.lit(""))), F.lit(_TOKEN), F.lit(0))


def _canonical(word: Column) -> Column:
    """A placeholder, or the word in small letters. A name is a capitalised word that doesn't start a sentence."""
    digit = (word >= "0") & (word < ":")
    return (
        F.when(word < "A", F.when(digit, F.when(F.substring(word, -1, 1) < "A", F.lit(_NUMBER)).otherwise(F.lit(_QUANTITY)))
               .otherwise(F.lower(_raw(word))))
        .when(F.lower(word) == word, word).when(F.upper(word) == word, F.lower(word)).otherwise(F.lit(_NAME))
    )


def _raw(word: Column) -> Column:
    """The word as it stands, without the sentence end before it."""
    return F.ltrim(word, F.lit(".!? \t\n\r\u000b\f"))


def _shifted(values: Column, by: int) -> Column:
    return F.slice(values, F.lit(by + 1), F.greatest(F.size(values) - by, F.lit(0)))


def _headed(values: Column, short: int) -> Column:
    return F.slice(values, F.lit(1), F.greatest(F.size(values) - short, F.lit(0)))


def _windows(rows: DataFrame, keep: list[str], window: int, short: tuple[int, ...]) -> DataFrame:
    """``keep``, ``size``, ``pos`` and ``hash`` of each run of ``window`` values of the array ``w``, and of each run of a ``short`` length."""
    if window < 2 or window & (window - 1):
        raise ValueError("window: a power of two")
    if any(not 0 < n < window for n in short):
        raise ValueError("short: lengths below the window")
    made = [f"__{n}" for n in sorted(short)]
    rows = rows.select(*keep, "w", *(F.lit(None).cast("array<bigint>").alias(c) for c in made))
    width = 1
    while width < window:
        # a short length is the sum of its bits, the lowest first
        parts = []
        for c in made:
            n, done = int(c[2:]), int(c[2:]) & (width - 1)
            if n & width and done:
                part = F.zip_with(_headed(F.col(c), width), _shifted(F.col("w"), done), lambda a, b: F.xxhash64(a, b))
            else:
                part = F.col("w") if n & width else F.col(c)
            parts.append(part.alias(c))
        wider = F.zip_with(_headed(F.col("w"), width), _shifted(F.col("w"), width), lambda a, b: F.xxhash64(a, b))
        rows = rows.select(*keep, wider.alias("w"), *parts)
        width *= 2
    # there is always a row; the outer form keeps the planner from copying the whole expression into filters below
    if not made:
        return rows.select(*keep, F.lit(window).alias("size"), F.posexplode_outer("w").alias("pos", "hash"))

    def placed(size: int, name: str) -> Column:
        return F.transform(name, lambda h, i: F.struct(F.lit(size).alias("size"), i.alias("pos"), h.alias("hash")))

    every = F.concat(placed(window, "w"), *(placed(int(c[2:]), c) for c in made))
    return rows.select(*keep, F.explode_outer(every).alias("__at")).select(*keep, "__at.*")


def template_windows(texts: DataFrame, keep: list[str], window: int = WINDOW, short: tuple[int, ...] = ()) -> DataFrame:
    """For each window of ``text``: the columns ``keep``, ``size``, ``pos``, and ``hash`` of its canonical words.

    Windows have ``window`` words, and each of the ``short`` lengths. A text of fewer words has one row without a place.
    """
    words = texts.select(*keep, words_of(F.col("text")).alias("words"))
    return _windows(words.select(*keep, F.transform("words", lambda w: F.xxhash64(_canonical(w))).alias("w")), keep, window, short)


def _is_slot(canonical: Column) -> Column:
    return canonical.isin(_NUMBER, _QUANTITY, _NAME)


def _whole_windows(flags: Column, size: Column) -> Column:
    """How many runs of ``size`` flags are all true."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(flags) - size, F.lit(0)))
    return F.size(F.filter(starts, lambda p: (F.size(F.slice(flags, p + 1, size)) == size) & ~F.array_contains(F.slice(flags, p + 1, size), False)))


def alignments(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, literals: int = LITERALS, least: int = LEAST_WINDOWS) -> DataFrame:
    """Texts that hold an item or a long part of it: ``digest`` of the text, ``item_id``, ``shift`` (word of the text where the item
    would start), ``n_windows``, ``n_words`` matched, ``reparameterised`` (some value differs).

    Windows of at least ``literals`` literals find alignments, all windows of an item that has no such one. ``least`` windows of an
    alignment must match, with or without so many literals, or all of an item that has fewer. An item's first word counts as
    a sentence's first and as one within a sentence.
    """
    digest = F.unhex(F.md5(F.col("text").cast("string")))
    items = benchmark.select("item_id", F.col("text").cast("string")).withColumn("item", words_of(F.col("text")))
    items = items.withColumn("kinds", F.transform("item", _canonical)).withColumn("length", F.size("item")).where("length > 0")
    # the same, where the first word stands within a sentence
    items = items.withColumn("inner", F.transform("item", lambda w, i: F.when(i == 0, _canonical(_raw(w))).otherwise(_canonical(w))))
    items = items.withColumn("size", F.least("length", F.lit(window))).withColumn("enough", F.least(F.lit(least), F.col("length") - F.col("size") + 1))

    def n_literals(kinds: Column) -> Column:
        return F.size(F.filter(kinds, lambda k: ~_is_slot(k)))

    items = items.withColumn("eligible", F.transform(
        F.sequence(F.lit(0), F.col("length") - F.col("size")),
        lambda p: n_literals(F.slice("kinds", p + 1, F.col("size"))) >= F.least(F.lit(literals), F.col("length"))))
    items = items.withColumn("n_eligible", F.size(F.filter("eligible", lambda e: e)))
    # an item too short for a window is one of its own length
    short = tuple(r["length"] for r in items.where(F.col("length") < window).select("length").distinct().collect())
    kept = ["item_id", "length", "enough", "eligible", "n_eligible"]
    windows = items.select(*kept, F.explode(F.array_distinct(F.array("kinds", "inner"))).alias("form"))
    windows = _windows(windows.select(*kept, F.transform("form", lambda k: F.xxhash64(k)).alias("w")), kept, window, short)
    windows = windows.where(F.col("size") == F.least("length", F.lit(window)))
    windows = windows.where((F.col("n_eligible") == 0) | F.get("eligible", F.col("pos"))).select(
        "size", "hash", "item_id", F.col("pos").alias("at"), "length",
        F.when(F.col("n_eligible") == 0, F.col("enough")).otherwise(F.least("enough", "n_eligible")).alias("need")).distinct()
    # within a measured bound the items' windows are broadcast; otherwise both sides are shuffled by hash
    own = template_windows(docs.select(digest.alias("digest"), F.col("text").cast("string")), ["digest"], window, short)
    hits = own.join(join_side(windows), ["size", "hash"]).select("digest", "item_id", (F.col("pos") - F.col("at")).alias("shift"), "at", "length", "need")
    key = ["digest", "item_id", "shift"]
    # copies of a text repeat its windows
    runs = hits.groupBy(*key, "length", "need").agg(
        F.size(F.collect_set("at")).alias("n_windows"), F.min("at").alias("first"), (F.max("at") + window).alias("last"),
    ).where(F.col("n_windows") >= F.col("need")).drop("need")
    runs = write_stage(runs.withColumn("last", F.least("last", "length")), "alignments")
    # only texts with an alignment are read again, for the values in the placeholders
    found = docs.select(digest.alias("digest"), F.col("text").cast("string")).join(join_side(runs.select("digest").distinct()), "digest")
    found = found.groupBy("digest").agg(F.first("text").alias("text")).select("digest", words_of(F.col("text")).alias("doc"))
    sides = items.select("item_id", "item", "kinds", "inner", "size", "enough", "n_eligible")
    both = runs.join(found, "digest").join(join_side(sides), "item_id")
    # where too few windows have literals, the others are looked at too: all of the item that the text can hold
    sparse = F.col("n_eligible") < F.col("enough")
    both = both.withColumn("first", F.when(sparse, F.greatest(F.lit(0), -F.col("shift"))).otherwise(F.col("first")))
    both = both.withColumn("last", F.when(sparse, F.least(F.col("length"), F.size("doc") - F.col("shift"))).otherwise(F.col("last")))
    span = F.col("last") - F.col("first")
    # a first word may be another name in the text only where the rest says enough
    named = n_literals(F.col("inner")) >= F.least(F.lit(literals), F.col("length"))

    def part(words: str, start: Column) -> Column:
        return F.slice(words, start + 1, span)

    words = F.zip_with(
        F.arrays_zip(part("item", F.col("first")).alias("w"), part("kinds", F.col("first")).alias("k"), part("inner", F.col("first")).alias("m")),
        F.transform(part("doc", F.col("shift") + F.col("first")), lambda w: F.struct(w.alias("w"), _canonical(w).alias("k"))),
        lambda i, d: F.struct(
            _raw(i["w"]).alias("item"), _raw(d["w"]).alias("doc"), ((i["k"] == d["k"]) | ((i["m"] == d["k"]) & named)).alias("kind"), _is_slot(d["k"]).alias("slot")))
    both = both.select(*key, "n_windows", "size", "enough", "n_eligible", "length", n_literals(F.col("kinds")).alias("n_literals"), span.alias("n_words"), words.alias("words"))

    def same(p: Column) -> Column:
        return F.lower(p["item"]) == F.lower(p["doc"])

    # a part between two matched windows may differ; it has no values to compare
    pairs = F.array_distinct(F.transform(
        F.filter("words", lambda p: p["kind"] & p["slot"]), lambda p: F.struct(p["item"].alias("item"), p["doc"].alias("doc"))))
    both = both.select(
        *key, "n_windows", "n_words", "enough", "n_eligible", "length", "n_literals", pairs.alias("pairs"),
        _whole_windows(F.transform("words", lambda p: p["kind"] | same(p)), F.col("size")).alias("n_alike"),
        _whole_windows(F.transform("words", same), F.col("size")).alias("n_same"))
    both = both.withColumn("item_values", F.size(F.array_distinct(F.transform("pairs", lambda p: p["item"]))))
    # an item of mostly values says too little without them
    consistent = (F.size("pairs") == F.col("item_values")) & ((F.col("n_eligible") > 0) | (2 * F.col("n_literals") >= F.col("length")))
    # windows that are equal in raw words need no values, whatever was edited elsewhere
    equal = F.col("n_same") >= F.col("enough")
    return both.where((F.col("n_alike") >= F.col("enough")) & (consistent | equal)).select(
        *key, "n_windows", "n_words", F.exists("pairs", lambda p: p["item"] != p["doc"]).alias("reparameterised"))


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, literals: int = LITERALS, least: int = LEAST_WINDOWS) -> DataFrame:
    """Pairs of ``doc_id`` and ``item_id``, with the longest alignment of each: ``shift``, ``n_windows``, ``n_words``,
    ``reparameterised``. Documents without a benchmark passage don't appear.

    A pair needs ``least`` template windows in one alignment, or all of an item too short for that, with consistent values or
    equal in raw words. An item whose windows all lack literals and whose words are mostly values needs them equal in raw words.
    NULL and empty texts, on either side, match nothing; repeated rows give repeated pairs, a NULL id stays NULL; items with
    equal texts each match. Other columns are not read. Very long texts are read whole.
    """
    best = F.max_by(F.struct("shift", "n_windows", "n_words", "reparameterised"), F.struct("n_windows", -F.col("shift")))
    found = alignments(docs, benchmark, window, literals, least).groupBy("digest", "item_id").agg(best.alias("best"))
    own = docs.select(F.unhex(F.md5(F.col("text").cast("string"))).alias("digest"), "doc_id")
    return own.join(join_side(found), "digest").select("doc_id", "item_id", "best.*")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage, with all their columns."""
    found = join_side(alignments(docs, benchmark).select("digest").distinct())
    # the columns in one struct, so that none of theirs clashes
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.unhex(F.md5(F.col("text").cast("string"))).alias("digest"))
    return own.join(found, "digest", "left_anti").select("row.*")
