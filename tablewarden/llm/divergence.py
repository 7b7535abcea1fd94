"""Quality rules: base counts and the divergence of a document's histograms from those of its language."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tablewarden.llm.common import cut_lineage

# Frequent function words by language.
COMMON_WORDS = {
    "en": "the of and in to a is that it for on with as was be by".split(),
    "fr": "de la le et les des en un une que qui du est pour dans par".split(),
    "de": "der die und den in von zu mit das ist im ein dem auf für des".split(),
    "es": "de la que el en y los un las del se por con para una es".split(),
}
N_COMMON = 16
# For any other language: some of each list.
OTHER_WORDS = [w for i in range(4) for w in (COMMON_WORDS[k][i] for k in ("en", "fr", "de", "es"))]

WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
# Greatest Jensen-Shannon distances, and the least lengths from which they are held against a document.
CHAR_DISTANCE, CHAR_GUARD = 0.27, 200
WORD_DISTANCE, WORD_GUARD = 0.245, 100

_SPACE = r"[\x20\x09-\x0D]+"
_SYMBOLS = r"[#*$%&|<>]+"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row, also where a lambda inside refers to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _without(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window of ``window`` words found twice or more in the array, the first one included."""

    def covered(starts: Column) -> Column:
        n = F.size(starts)
        gap = lambda k: F.when(k == n, window).otherwise(F.least(F.lit(window), F.get(starts, k) - F.get(starts, k - 1)))
        return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, k: acc + gap(k))

    def twice(ordered: Column) -> Column:
        n = F.size(ordered)
        hash_at = lambda k: F.get(ordered, k)["h"]
        same = lambda k: ((k > 0) & (hash_at(k - 1) == hash_at(k))) | ((k < n - 1) & (hash_at(k + 1) == hash_at(k)))
        places = F.filter(F.sequence(F.lit(0), n - 1), lambda k: F.coalesce(same(k), F.lit(False)))
        return _let(F.sort_array(F.transform(places, lambda k: F.get(ordered, k)["i"])), covered)

    def of_windows(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(_let(ordered, twice))

    def of_hashes(hashes: Column) -> Column:
        window_at = lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(window)])
        return F.when(F.size(hashes) <= window, 0).otherwise(_let(F.transform(F.sequence(F.lit(0), F.size(hashes) - window), window_at), of_windows))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def measures(docs: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """_id, _lang, the base counts and the two histograms of every row."""
    given = docs.select(F.col(key).alias("_id"), F.col(lang).cast("string").alias("_given"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"))
    known = F.coalesce(F.col("_given").isin(list(COMMON_WORDS)), F.lit(False))
    lists = F.lit(None).cast("array<string>")
    for name, words in [*COMMON_WORDS.items(), ("", OTHER_WORDS)]:
        lists = F.when(F.col("_lang") == name, F.array(*[F.lit(w) for w in words])).otherwise(lists)
    every = sorted({w for words in [*COMMON_WORDS.values(), OTHER_WORDS] for w in words})
    words = F.filter(F.split("_t", _SPACE), lambda w: w != "")

    def by_word(common: Column) -> Column:
        return F.transform(F.col("_list"), lambda v: F.size(common) - F.size(F.array_remove(common, v)))

    def lines(kept: Column) -> Column:
        return F.size(kept) - F.size(F.array_distinct(kept))

    def of_words(w: Column) -> Column:
        lowered = F.filter(F.transform(w, lambda x: F.lower(x)), lambda x: x.isin(every))
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            repeated_words(w).cast("bigint").alias("n_repeat_words"),
            _let(lowered, by_word).alias("common"),
        )

    counted = given.withColumn("_lang", F.when(known, F.col("_given")).otherwise("")).withColumn("_list", lists).select(
        "_id",
        "_lang",
        _let(words, of_words).alias("_w"),
        F.length("_t").alias("_chars"),
        _without(F.col("_t"), _SYMBOLS).cast("bigint").alias("n_symbols"),
        _let(F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), lines).cast("bigint").alias("n_dup_lines"),
        _without(F.col("_t"), r"\p{Ll}+").alias("_lower"),
        _without(F.col("_t"), r"\p{Lu}+").alias("_upper"),
        _without(F.col("_t"), r"\p{Nd}+").alias("_digit"),
    )
    return counted.select("*", "_w.*").drop("_w").select(
        "_id", "_lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "_chars",
        F.transform(
            F.array("_lower", "_upper", "_digit", F.col("n_symbols"), F.col("_chars") - F.col("word_chars"), F.col("word_chars") - F.col("_lower") - F.col("_upper") - F.col("_digit") - F.col("n_symbols")),
            lambda n: F.greatest(n.cast("double"), F.lit(0.0)),
        ).alias("_kinds"),
        F.transform(F.concat("common", F.array(F.greatest(F.col("n_words") - F.aggregate("common", F.lit(0), lambda a, b: a + b), F.lit(0)).cast("int"))), lambda n: n.cast("double")).alias("_common"),
    )


def references(counted: DataFrame) -> DataFrame:
    """Histograms per language over all rows that pass the base rules, one added to every bin: a row per language."""
    sums = [(F.sum(F.get(F.col(c), F.lit(i))) + 1.0) for c, n in (("_kinds", 6), ("_common", N_COMMON + 1)) for i in range(n)]
    return (
        counted.filter("NOT base_failed")
        .groupBy("_lang")
        .agg(F.array(*sums[:6]).alias("_ref_kinds"), F.array(*sums[6:]).alias("_ref_common"))
    )


def distance(seen: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (root of the divergence in bits, 0 to 1) of two arrays of counts; null if one is empty."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    term = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)

    def of_shares(p: Column, q: Column) -> Column:
        return (term(p, (p + q) / 2) + term(q, (p + q) / 2)) / 2

    def with_totals(t: Column) -> Column:
        parts = F.zip_with(seen, reference, lambda a, b: of_shares(a / t["s"], b / t["r"]))
        return F.when((t["s"] > 0) & (t["r"] > 0), F.sqrt(F.greatest(total(parts), F.lit(0.0))))

    return _let(F.struct(total(seen).alias("s"), total(reference).alias("r")), with_totals)


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``key``, the base counts, base_failed, kept and the two distances for every row of ``docs``.

    A document that passes the base rules is rejected if its character classes or its common words are further from
    those of its language than the limits, and it is long enough for that to mean something. Null and empty texts
    have no words and fail the base rules. A null or unknown language has a word list and a reference of its own. Where
    no document passes, there is no reference and nothing more to reject. Null and repeated keys are judged row by row;
    other columns are ignored; an empty table gives an empty result.
    """
    repeats = F.lit(100) * F.col("n_repeat_words") > F.lit(MOST_REPEATED) * F.col("n_words")
    counted = cut_lineage(measures(docs, key, text, lang).withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | repeats))
    # One row for each of a fixed set of languages and the rest: at most five rows.
    judged = counted.join(F.broadcast(references(counted)), "_lang", "left").select(
        "*",
        # Rounded, so that the order of the bins does not show.
        F.round(distance(F.col("_kinds"), F.col("_ref_kinds")), 6).alias("char_distance"),
        F.round(distance(F.col("_common"), F.col("_ref_common")), 6).alias("word_distance"),
    )
    strange = ((F.col("_chars") >= CHAR_GUARD) & (F.col("char_distance") > CHAR_DISTANCE)) | ((F.col("n_words") >= WORD_GUARD) & (F.col("word_distance") > WORD_DISTANCE))
    return judged.select(
        F.col("_id").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.coalesce(strange, F.lit(False))).alias("kept"), "char_distance", "word_distance",
    )
