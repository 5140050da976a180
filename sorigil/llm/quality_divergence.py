"""Quality rules by distribution divergence, with DataFrame functions only.

Every document has two histograms: its characters over the seven ``CLASSES`` and its words over
``COMMON`` (function words of the known languages, everything else in one bin). The references are the
same histograms summed over all documents of a language, by the first part of its tag in lower case (``en-US`` is ``en``).
Documents of a language without function words here are kept apart by script as well. Where such a language has
fewer than ``LEAST_DOCS`` documents of ``LEAST_CHARS`` characters in a script, and where no language is given, the reference is
that of the script over all these languages; several languages are mixed in it, so it has no words and only the
characters are compared. Where the script has too few documents too, the distances decide nothing. A document fails when the Jensen-Shannon
distance (base 2, 0 to 1) of either histogram from its language's reference is above the limit, provided
the text is long enough for the histogram to mean something (``LEAST_CHARS``, ``LEAST_WORDS``); shorter texts
pass that test. The base rules of the contract (few words, repeated word windows) come on top.

Two scans of the texts and no shuffle of them: the first sums the references (partial sums per task, a
few hundred rows a task and language exchanged), the second computes and compares. The references, a row for each language
and script, are stored and broadcast if they are at most ``BROADCAST_REFERENCES``.

Results: null and empty texts have no words, so they fail the base rule. The SQL twin pools all
languages but those of ``FUNCTION_WORDS``; it holds for tables that have only these. Repeated rows each get their row.
Other columns are not read; clashing names do no harm, since only the id, text and language are selected.
Windows are found by a 64-bit hash and confirmed on their words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sorigil.functions.bind import let
from sorigil.llm.common import stored
from sorigil.session import broadcast_if_bounded

SPACE = "[\\x20\\x09-\\x0D]+"
# Character classes, taken away from the text one after the other; the rest is the last class.
CLASSES = {"lower": "[a-z]+", "space": SPACE, "other_script": "[^\\x00-\\x7F]+", "upper": "[A-Z]+", "digit": "[0-9]+", "symbol": "[#*$%&|<>]+"}
# Frequent function words of the known languages.
FUNCTION_WORDS = {
    "en": "the of and to in a is that for it was on be with as by at are this from",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine auch",
    "es": "de la que el en y a los del se las por un para con no una su al lo",
    "fr": "de la le et les des en un du une que est pour qui dans par sur au pas avec",
}
COMMON = sorted({w for words in FUNCTION_WORDS.values() for w in words.split()}, key=lambda w: w.encode())
LEAST_WORDS_BASE, WINDOW, MOST_REPEATED = 10, 5, 20  # contract: words, window, percent of words in repeated windows
LEAST_CHARS, MOST_CLASS = 300, 0.31
LEAST_WORDS, MOST_WORD = 120, 0.29
LEAST_DOCS = 30  # of a reference of a language without function words, or of a script
BROADCAST_REFERENCES = 20_000
NO_LANGUAGE = ("und", "mul", "mis", "zxx", "unknown", "other", "none", "null")
# Scripts that are told apart, letters of any other are one more.
SCRIPTS = {"latin": "\\p{IsLatin}", "cyrillic": "\\p{IsCyrillic}", "greek": "\\p{IsGreek}", "arabic": "\\p{IsArabic}", "hebrew": "\\p{IsHebrew}", "devanagari": "\\p{IsDevanagari}", "thai": "\\p{IsThai}",
           "hangul": "\\p{IsHangul}", "east_asian": "\\p{IsHan}\\p{IsHiragana}\\p{IsKatakana}"}


def script(text: Column) -> Column:
    """The script most letters of a text are of, Latin if it has no letters."""
    patterns = {**{k: f"[^{p}]+" for k, p in SCRIPTS.items()}, "rest": f"[\\P{{L}}{''.join(SCRIPTS.values())}]+"}
    most = F.array_max(F.array(*(F.struct(F.length(F.regexp_replace(text, p, "")).alias("n"), F.lit(k).alias("script")) for k, p in patterns.items())))
    return let(lambda m: F.when(m["most"]["n"] > 0, m["most"]["script"]).otherwise("latin"), most=most)


def language(lang: Column, text: Column) -> Column:
    """The language's tag; behind other languages than those of ``FUNCTION_WORDS``, and behind none, a bar and the script."""
    tag = F.coalesce(F.lower(F.regexp_extract(lang, "^\\s*([A-Za-z]{2,8})(?:[-_][A-Za-z0-9_-]*)?\\s*$", 1)), F.lit(""))
    named = F.when(tag.isin(*NO_LANGUAGE), "").otherwise(tag)
    return F.when(tag.isin(*FUNCTION_WORDS), tag).otherwise(F.concat(named, F.lit("|"), script(F.coalesce(text, F.lit("")))))


def histograms(docs: DataFrame, text_col: str, *keep: Column) -> DataFrame:
    """``keep`` with t, words, n_words, n_chars, classes and commons (counts as arrays of long)."""
    rest, lengths = F.col("t"), []
    for pattern in CLASSES.values():
        lengths.append(F.length(rest))
        rest = F.regexp_replace(rest, pattern, "")
    lengths.append(F.length(rest))
    common = F.array(*map(F.lit, COMMON))
    cut = (
        docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("t"))
        .withColumns({"words": F.array_remove(F.split("t", SPACE), ""), "lengths": F.array(*lengths)})
        # the common words of the text and each word of the list once, in order: a run's length tells its count
        .withColumn("found", F.sort_array(F.concat(F.filter("words", lambda w: w.isin(*COMMON)), common)))
        .withColumn("at", F.transform(common, lambda w: F.array_position("found", w)))
    )
    ends = F.concat(F.slice("at", 2, len(COMMON)), F.array(F.size("found").cast("long") + 1))
    return cut.select(
        *[c for c in cut.columns if c not in ("found", "at", "lengths")],
        F.size("words").cast("long").alias("n_words"),
        F.element_at("lengths", 1).cast("long").alias("n_chars"),
        F.transform(F.sequence(F.lit(1), F.lit(len(CLASSES) + 1)), lambda i: (F.element_at("lengths", i) - F.coalesce(F.get("lengths", i), F.lit(0))).cast("long")).alias("classes"),
        F.concat(
            F.zip_with(ends, "at", lambda end, start: end - start - 1),
            F.array(F.size("words") - (F.size("found") - F.lit(len(COMMON))).cast("long")),
        ).alias("commons"),
    )


def shares(counts: str) -> Column:
    """Counts over their sum, zeros where the sum is zero."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b)
    return let(lambda s: F.transform(s["of"], lambda n: F.when(s["n"] > 0, n / s["n"]).otherwise(0.0)), of=F.col(counts), n=total)


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per language (and script, see ``language``): shares of characters and words, null where there are too few."""
    k, m = len(CLASSES) + 1, len(COMMON) + 1
    long_enough = F.array((F.col("n_chars") >= LEAST_CHARS).cast("long"))
    both = histograms(docs, text_col, language(F.col(lang_col), F.col(text_col)).alias("of")).select("of", F.posexplode(F.concat("classes", "commons", long_enough)).alias("at", "n"))
    sums = stored(both.groupBy("of", "at").agg(F.sum("n").alias("n")), "references")

    def bins(rows: DataFrame, name: str) -> DataFrame:
        sorted_bins = rows.groupBy(name).agg(F.array_sort(F.collect_list(F.struct("at", "n"))).alias("bins"))
        return sorted_bins.select(name, F.slice("bins.n", 1, k).alias("c"), F.slice("bins.n", k + 1, m).alias("w"), F.element_at("bins.n", k + m + 1).alias("docs"))

    behind = F.regexp_extract("of", "\\|(.*)$", 1).alias("script")
    own = bins(sums, "of").select("of", behind, shares("c").alias("c"), shares("w").alias("w"), "docs")
    pooled = bins(sums.where(F.col("of").contains("|")).select(behind, "at", "n").groupBy("script", "at").agg(F.sum("n").alias("n")), "script")
    pool = pooled.where(F.col("docs") >= LEAST_DOCS).select("script", shares("c").alias("pool"))
    alone = ~F.col("of").contains("|") | ((F.col("docs") >= LEAST_DOCS) & ~F.col("of").startswith("|"))
    return own.join(pool, "script", "left").select("of", F.when(alone, F.col("c")).otherwise(F.col("pool")).alias("ref_classes"), F.when(alone, F.col("w")).alias("ref_commons"))


def distance(p: str, q: str) -> Column:
    """Jensen-Shannon distance (base 2) of two arrays of shares."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    total = F.aggregate(F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a)), F.lit(0.0), lambda a, b: a + b)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def repeats(df: DataFrame) -> DataFrame:
    """``df`` (with ``words``) and n_repeat_words: words in windows that the text has twice or more."""
    nothing = "array<struct<h:bigint,w:array<string>,i:int>>"
    starts = F.sequence(F.lit(0), F.size("words") - WINDOW)
    hashes = F.transform(starts, lambda i: F.xxhash64(*(F.get("words", i + k) for k in range(WINDOW))))
    hashed = df.withColumn("hashes", F.when(F.size("words") > WINDOW, hashes).otherwise(F.array().cast("array<bigint>")))
    # sorted by hash, then words, then place; only texts in which some hash comes twice pay for this
    entries = F.transform("hashes", lambda h, i: F.struct(h.alias("h"), F.slice("words", i + 1, WINDOW).alias("w"), i.alias("i")))
    some = F.size(F.array_distinct("hashes")) < F.size("hashes")
    ordered = hashed.withColumn("ordered", F.when(some, F.sort_array(entries)).otherwise(F.array().cast(nothing)))

    def same(e: Column, other: Column) -> Column:
        return F.coalesce((other["h"] == e["h"]) & (other["w"] == e["w"]), F.lit(False))

    marked = F.transform("ordered", lambda e, j: F.when(same(e, F.get("ordered", j - 1)) | same(e, F.get("ordered", j + 1)), e["i"]))
    placed = ordered.withColumn("placed", F.sort_array(F.filter(marked, lambda i: i.isNotNull())))
    lengths = F.transform("placed", lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get("placed", j + 1) - i, F.lit(WINDOW))))
    return placed.withColumn("n_repeat_words", F.aggregate(lengths, F.lit(0), lambda a, b: a + b).cast("long")).drop("hashes", "ordered", "placed")


def judged(docs: DataFrame, *keep: str, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: the ``keep`` columns, the base counts, both distances and the verdict."""
    bins = histograms(docs, text_col, F.struct(*(F.col(c) for c in keep)).alias("kept_row"), language(F.col(lang_col), F.col(text_col)).alias("of"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    counted = (
        repeats(bins.withColumn("lines", lines))
        .withColumn("word_chars", F.col("n_chars") - F.element_at("classes", 2))
        .withColumn("n_symbols", F.element_at("classes", len(CLASSES)))
        .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
        .drop("t", "words", "lines")
        .withColumns({"classes": shares("classes"), "commons": shares("commons")})
    )
    refs = broadcast_if_bounded(stored(references(docs, text_col, lang_col), "references"), BROADCAST_REFERENCES)
    far = counted.join(refs, "of", "left").select(
        "kept_row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars",
        distance("classes", "ref_classes").alias("class_distance"), distance("commons", "ref_commons").alias("word_distance"),
    )
    failed = (F.col("n_words") < LEAST_WORDS_BASE) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    strange = ((F.col("n_chars") >= LEAST_CHARS) & (F.col("class_distance") > MOST_CLASS)) | ((F.col("n_words") >= LEAST_WORDS) & (F.col("word_distance") > MOST_WORD))
    return far.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~F.coalesce(strange, F.lit(False)))


def judge(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The verdict of every document with its counts."""
    return judged(docs, id_col).select(
        F.col("kept_row")[id_col].alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns."""
    # a filter on the verdict would be pushed down with all that the verdict is computed from written out in
    # it, again and again; nothing is pushed through a column that depends on the place of the row
    verdict = F.when(F.monotonically_increasing_id() >= 0, F.col("kept"))
    return judged(docs, *docs.columns).select("kept_row", verdict.alias("kept")).where("kept").select("kept_row.*")
