"""Benchmark decontamination by template canonicalisation.

Texts become sequences of template tokens: numbers, units after numbers and
names (capitalised words inside a sentence) are replaced by typed placeholders,
everything else is lower-cased.  Windows of ``WINDOW`` template tokens of the
benchmark are hash-joined with those of the documents, so a question leaks even
if its figures or names were exchanged.  Matches of a document and an item lie
on diagonals (document position minus item position).  On each diagonal names
inside sentences must be consistent: the same name is always replaced by the
same name and no two by one, or no window of the diagonal counts.  Redrawn
numbers may coincide; one that is replaced by several values takes out the
windows that hold it.  A capitalised word that starts a sentence is both a plain
word and, in a second template, a name; contradictions of the latter take out
its windows there alone.
A document leaks an item when the windows left cover ``COVERAGE`` of the item's.

Windows with fewer than ``LITERALS`` plain words say too little and are not
used.  Everything is DataFrame code: documents are read once (a second time
only those with matched slots), windows live inside the scan's stage, and the
benchmark's windows are broadcast only while they are few (``MAX_BROADCAST``),
beyond that the join shuffles.

Items without a usable window (fewer than ``WINDOW`` words, or slots throughout)
are matched by their exact values: one window of the item's whole length over
lower-cased tokens, single characters in scripts without spaces.  A window of
fewer than ``EXACT`` tokens is evidence only if it is the whole document: "Yes."
leaks in a document that says just that, not in every one with the word.

Cases: null and empty texts, and texts without a token, match nothing; of rows
that share an id the best match counts; null ids are matched like any other;
an empty table on either side gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.llm.common import kept, split_by_keys, stored

WINDOW = 5
LITERALS = 3
COVERAGE = 0.5
EXACT = 4
MAX_BROADCAST = 500_000
DOC = ["doc_id", "doc_hash"]

# fixed values: units of measure that may follow a number
UNITS = ("mm", "cm", "dm", "m", "km", "inch", "inches", "ft", "foot", "feet", "yd", "yards",
         "mile", "miles", "mg", "g", "kg", "t", "oz", "lb", "lbs", "ml", "cl", "l", "litre",
         "litres", "liter", "liters", "gallon", "gallons", "s", "sec", "second", "seconds", "min",
         "minute", "minutes", "h", "hour", "hours", "day", "days", "week", "weeks", "month",
         "months", "year", "years", "meter", "meters", "metre", "metres", "gram", "grams",
         "percent", "dollar", "dollars", "euro", "euros", "cent", "cents", "kmh", "mph", "v",
         "volt", "volts", "w", "watt", "watts", "kw", "hz", "khz", "mhz", "ghz", "kb", "mb", "gb",
         "%", "€", "$", "£", "°")

# a word that starts a sentence brings along what stands between it and the sentence before
_TOKEN = ("(?:[.!?:\\n][^\\p{L}0-9]*(?=\\p{Lu}))?\\p{L}[\\p{L}\\p{M}0-9]*"
          "|[0-9]+(?:[.,][0-9]+)*|[%€$£°]")


# scripts without spaces: every character is a token of its own
_DENSE = ("\\p{IsHan}\\p{IsHiragana}\\p{IsKatakana}\\p{IsThai}\\p{IsLao}\\p{IsKhmer}"
          "\\p{IsMyanmar}")
_EXACT = (f"[{_DENSE}]|[\\p{{L}}&&[^{_DENSE}]][[\\p{{L}}\\p{{M}}0-9]&&[^{_DENSE}]]*"
          "|[0-9]+(?:[.,][0-9]+)*|[%€$£°]")


def exact_tokens(text: Column) -> Column:
    """Lower-cased words, numbers and unit signs as they are."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_EXACT), F.lit(0))


def raw_tokens(text: Column) -> Column:
    """Words, numbers and unit signs."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_TOKEN), F.lit(0))


def templates(raw: Column) -> Column:
    """Template tokens of an array column of raw tokens, position by position."""
    def number(token: Column) -> Column:
        return token.between("0", "9\uffff")

    def one(token: Column, i: Column) -> Column:
        unit = F.coalesce(number(F.get(raw, i - 1)), F.lit(False)) & F.lower(token).isin(*UNITS)
        return (F.when((F.lower(token) == token),
                       F.when(number(token), "<num>").when(unit, "<unit>").otherwise(token))
                .when(unit, "<unit>")
                .when((i > 0) & token.rlike("^\\p{Lu}\\p{Ll}"), "<name>")
                .otherwise(F.lower(F.regexp_extract(token, "\\p{L}+.*", 0))))
    return F.transform(raw, one)


def _bare(token: Column) -> Column:
    """A raw token in lower case, without what stands between it and the sentence before."""
    return F.lower(F.regexp_replace(token, "^[.!?:\\n][^\\p{L}0-9]*", ""))


def opened(raw: Column, tokens: Column) -> Column:
    """Template tokens with the capitalised words that start sentences as names too."""
    def one(token: Column, i: Column) -> Column:
        starts = F.get(raw, i).rlike("^[^\\p{L}0-9]*\\p{Lu}\\p{Ll}")
        return F.when(starts & ~token.startswith("<"), "<name>").otherwise(token)
    return F.transform(tokens, one)


def _hashes(tokens: str, window: int) -> Column:
    """The hashes of all windows of an array column of template tokens.

    The last, shorter windows of a text have hashes too; no full window has those.
    """
    def one(token: Column, i: Column) -> Column:
        return F.xxhash64(token, *[F.get(tokens, i + k) for k in range(1, window)])
    return F.transform(tokens, one)


def _windows(rows: DataFrame, key: list[str], window: int) -> DataFrame:
    """Rows (*key, at, plain, open) of the hashes of windows under both templates."""
    return (rows.select(*key, _hashes("tokens", window).alias("plain"),
                        _hashes("opened", window).alias("open"))
            .select(*key, F.posexplode(F.arrays_zip("plain", "open")).alias("at", "hash"))
            .select(*key, "at", "hash.plain", "hash.open"))


def _usable(rows: DataFrame, window: int) -> DataFrame:
    """Windows of the benchmark that are full and have plain words enough.

    ``place`` is the window's hash under the first template, ``is_open`` tells the second.
    """
    def enough(tokens: str) -> Column:
        return F.size(F.filter(F.slice(tokens, F.col("at") + 1, F.lit(window)),
                               lambda t: ~t.startswith("<"))) >= LITERALS
    found = _windows(rows, ["item_id", "tokens", "opened"], window).where(
        F.col("at") + window <= F.size("tokens"))
    first = found.where(enough("tokens")).select(
        "item_id", "at", F.col("plain").alias("window"), F.col("plain").alias("place"),
        F.lit(False).alias("is_open"))
    return first.unionByName(found.where(enough("opened") & (F.col("open") != F.col("plain")))
                             .select("item_id", "at", F.col("open").alias("window"),
                                     F.col("plain").alias("place"), F.lit(True).alias("is_open")))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
          coverage: float = COVERAGE) -> DataFrame:
    """doc_id, item_id, matched_windows, item_windows, coverage of every leak."""
    best = F.max_by(F.struct("matched_windows", "item_windows", "coverage"), "coverage")
    return (_leaks(docs, benchmark, id_col, text_col, item_col, item_text_col, window, coverage)
            .groupBy("doc_id", "item_id").agg(best.alias("best"))
            .select("doc_id", "item_id", "best.*"))


def _leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
           coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``leaks`` for every text of an id, with its hash ``doc_hash``."""
    items = stored(benchmark.select(F.col(item_col).cast("long").alias("item_id"),
                                    raw_tokens(F.col(item_text_col)).alias("raw"))
                   .select("item_id", "raw", templates(F.col("raw")).alias("tokens"))
                   .withColumn("opened", opened(F.col("raw"), F.col("tokens"))), "items")
    bench = stored(_usable(items, window)
                   .withColumnRenamed("at", "item_at").distinct(), "item-windows")
    totals = bench.groupBy("item_id").agg(F.countDistinct("place").alias("item_windows"))
    side = F.broadcast(bench) if bench.count() <= MAX_BROADCAST else bench

    # rows that share an id are told apart by the hash of their texts
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        F.xxhash64(F.col(text_col)).alias("doc_hash"))
    # one projection a step: a lambda must refer to a finished array, not to its expression
    cut = (texts.select(*DOC, raw_tokens(F.col("text")).alias("raw"))
           .select(*DOC, "raw", templates(F.col("raw")).alias("tokens"))
           .select(*DOC, "tokens", opened(F.col("raw"), F.col("tokens")).alias("opened")))
    found = _windows(cut, DOC, window).select(
        *DOC, "at", F.explode(F.array_distinct(F.array("plain", "open"))).alias("window"))
    matched = stored(found.join(side, "window").select(
        *DOC, "at", "item_id", "item_at", "place", "is_open"), "matches")

    item_tokens = F.when(F.col("is_open"), F.col("item_opened")).otherwise(F.col("item_tokens"))
    slotted = stored(matched.join(
        items.select(F.col("item_id").alias("slot_item"), F.col("raw").alias("item_raw"),
                     F.col("tokens").alias("item_tokens"), F.col("opened").alias("item_opened"))
        .where(F.exists("item_opened", lambda t: t.startswith("<"))),
        F.col("item_id").eqNullSafe(F.col("slot_item")))
        .withColumn("slots", item_tokens)
        .select(*DOC, "at", "item_id", "item_at", "is_open", F.explode(F.transform(
            F.filter(F.sequence(F.lit(0), F.lit(window - 1)),
                     lambda k: F.get("slots", F.col("item_at") + k).startswith("<")),
            lambda k: F.struct(
                k.alias("k"), (F.get("slots", F.col("item_at") + k) == "<name>").alias("name"),
                (~F.get("item_tokens", F.col("item_at") + k).startswith("<")).alias("first"),
                _bare(F.get("item_raw", F.col("item_at") + k)).alias("value")))).alias("slot"))
        .select(*DOC, "item_id", "at", "item_at", "is_open",
                (F.col("at") + F.col("slot.k")).alias("slot_at"),
                (F.col("at") - F.col("item_at")).alias("diagonal"), "slot.name", "slot.first",
                "slot.value").distinct(), "slots")
    wrong = stored(_inconsistent(slotted, texts), "contradictions")
    good = matched.withColumn("diagonal", F.col("at") - F.col("item_at"))
    same = (F.col("doc_id").eqNullSafe(F.col("wrong_doc"))
            & (F.col("doc_hash") == F.col("wrong_hash"))
            & F.col("item_id").eqNullSafe(F.col("wrong_item"))
            & (F.col("diagonal") == F.col("wrong_diagonal")))
    good = good.join(wrong.where("whole"), same, "left_anti").join(
        wrong.where("NOT whole"), same & (F.col("at") == F.col("wrong_at"))
        & (F.col("is_open") == F.col("wrong_open")), "left_anti")
    templated = (good.groupBy(*DOC, "item_id").agg(F.countDistinct("place").alias("matched_windows"))
            .join(totals.withColumnRenamed("item_id", "of_item"),
                  F.col("item_id").eqNullSafe(F.col("of_item")))
            .select(*DOC, "item_id", "matched_windows", "item_windows",
                    (F.col("matched_windows") / F.col("item_windows")).alias("coverage"))
            .where(F.col("coverage") >= coverage))
    return templated.unionByName(_exact_leaks(texts, benchmark, totals, item_col, item_text_col))


def _exact_leaks(texts: DataFrame, benchmark: DataFrame, totals: DataFrame, item_col: str,
                 item_text_col: str) -> DataFrame:
    """Leaks of the items without a usable window: their whole length, value by value."""
    whole = stored(benchmark.select(F.col(item_col).cast("long").alias("item_id"),
                                    exact_tokens(F.col(item_text_col)).alias("words"))
                   .where(F.size("words") > 0)
                   .join(totals.select(F.col("item_id").alias("of_item")),
                         F.col("item_id").eqNullSafe(F.col("of_item")), "left_anti")
                   .select("item_id", F.size("words").alias("length"),
                           F.xxhash64("words").alias("window")).distinct(), "whole-items")
    lengths = [r[0] for r in whole.select("length").distinct().orderBy("length").collect()]
    none = F.array().cast("array<struct<length:int,window:bigint>>")
    if not lengths:
        return texts.where("false").select(
            *DOC, F.lit(None).cast("long").alias("item_id"),
            F.lit(1).cast("long").alias("matched_windows"),
            F.lit(1).cast("long").alias("item_windows"), F.lit(1.0).alias("coverage"))
    words = texts.select(*DOC, exact_tokens(F.col("text")).alias("words"))

    def windows(length: int) -> Column:
        last = F.size("words") - length
        # short items match whole documents only
        fits = last >= 0 if length >= EXACT else last == 0
        return F.when(fits, F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.struct(F.lit(length).alias("length"), F.xxhash64(
                F.slice("words", i + 1, F.lit(length))).alias("window"))))
    found = words.select(*DOC, F.explode(F.concat(
        none, *[F.coalesce(windows(n), none) for n in lengths])).alias("w")).select(
        *DOC, "w.length", "w.window")
    return (found.join(whole, ["length", "window"]).select(*DOC, "item_id").distinct()
            .select(*DOC, "item_id", F.lit(1).cast("long").alias("matched_windows"),
                    F.lit(1).cast("long").alias("item_windows"), F.lit(1.0).alias("coverage")))


def _inconsistent(slotted: DataFrame, texts: DataFrame) -> DataFrame:
    """Diagonals (``whole``) and windows on which slots contradict each other."""
    some, _ = split_by_keys(texts, F.xxhash64(*DOC), slotted.select(
        F.xxhash64(*DOC).alias("key")).distinct(), "slot-texts")
    # rows that repeat id and text have the same tokens
    raw = (some.dropDuplicates(DOC)
           .select(F.col("doc_id").alias("raw_doc"), F.col("doc_hash").alias("raw_hash"),
                   raw_tokens(F.col("text")).alias("raw")))
    diagonal = [*DOC, "item_id", "diagonal"]
    filled = (slotted.join(raw, F.col("doc_id").eqNullSafe(F.col("raw_doc"))
                           & (F.col("doc_hash") == F.col("raw_hash")))
              .withColumn("filled", _bare(F.get("raw", "slot_at"))))

    def values(of: Column, by: str) -> Column:
        return F.size(F.collect_set(of).over(Window.partitionBy(*diagonal, "name", by)))

    inner = ~F.col("first")
    ways = values(F.col("filled"), "value") > 1
    either = ways | (values(F.col("value"), "filled") > 1)
    inside = ((values(F.when(inner, F.col("filled")), "value") > 1)
              | (values(F.when(inner, F.col("value")), "filled") > 1))
    found = filled.select(
        *diagonal, "at", "is_open", (F.col("name") & inner & inside).alias("whole"),
        ((~F.col("name") & ways) | (F.col("first") & either)).alias("part"))
    return (found.where("whole OR part").distinct()
            .select(*diagonal, F.col("at").alias("wrong_at"), F.col("is_open").alias("wrong_open"),
                    "whole")
            .toDF("wrong_doc", "wrong_hash", "wrong_item", "wrong_diagonal", "wrong_at",
                  "wrong_open", "whole"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that leak no benchmark item, all columns unchanged.

    Rows are told apart by id and text: others with the id of a row that goes stay.
    """
    gone = kept(lambda: _leaks(docs, benchmark, id_col, text_col, **options)
                .select(F.col("doc_id").alias("__leaked_id"),
                        F.col("doc_hash").alias("__leaked_hash")).distinct(), "leaks")
    # only rows that pass the bit table of the leaks are joined with them
    some, rest = split_by_keys(
        docs, F.xxhash64(F.col(id_col).cast("long"), F.xxhash64(F.col(text_col))),
        gone.select(F.xxhash64("__leaked_id", "__leaked_hash").alias("key")), "leak-texts")
    return rest.unionByName(some.join(
        gone, F.col(id_col).eqNullSafe(F.col("__leaked_id"))
        & (F.xxhash64(F.col(text_col)) == F.col("__leaked_hash")), "left_anti"))
