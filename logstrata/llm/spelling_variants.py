"""Spelling variants: words that differ by one code point, found by asymmetric chunks.

Of two words that differ by one edit, the shorter (either, if equal) is cut into two disjoint chunks, and one of them lies
unchanged in the other word, at the same place or one further. So a word sends its two chunks, and, for partners as long as
itself or one shorter, those of its own positional grams that lie within a shift of one of such a chunk. Words that meet are
compared in full.

A chunk that many words hold is a hot group. Its words are not paired: the part of them that differs is cut into two again,
and one half must agree as well. That ends at a single differing place, where a group is no larger than its letters allow.

Words are counted before anything is shuffled; all steps are DataFrame functions.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logstrata.session import materialize

LETTERS = r"[A-Za-zÀ-ÿ]"
SHORTEST = 6
LEAST = 5
# A form is at least so many times as frequent as its variant.
TIMES = 5
# One run in so many loses a code point.
TYPO_EVERY = 199
# Pairs that a group may form; a larger one is cut.
PAIRS = 4096

KEY = ["length", "start", "end", "outside"]


def _cut(word: Column, start: Column, end: Column) -> Column:
    """``word`` without the code points from ``start`` up to ``end``, counted from 0."""
    return F.concat(F.substring(word, F.lit(1), start), F.substring(word, end + 1, F.char_length(word)))


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, n)``: runs of letters of all whole texts, A-Z lowered, with the stated typos, from 6 code points and 5 uses on."""
    # A shorter run gives no word, so it is not taken out of the text.
    runs = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(F.col(text), F.lit(f"{LETTERS}{{{SHORTEST},}}"), F.lit(0))).alias("run"),
    )
    lowered = runs.select("doc", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    hashed = lowered.select("run", F.crc32(F.concat_ws(":", "doc", "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    words = hashed.select(F.when(F.col("h") % TYPO_EVERY == 0, _cut(F.col("run"), at, at + 1)).otherwise(F.col("run")).alias("word"))
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.col("n") >= LEAST) & (F.char_length("word") >= SHORTEST))


def _halved(state: DataFrame) -> DataFrame:
    """The part that may differ, from ``start`` up to ``end``, cut in two: either half may hold the edit, the other agrees."""
    middle = F.floor((F.col("start") + F.col("end")) / 2).cast("int")
    windows = F.array(
        F.struct(F.col("start").alias("start"), middle.alias("end")),
        F.struct(middle.alias("start"), F.col("end").alias("end")),
    )
    either = state.select("word", "longer", "length", F.explode(windows).alias("w"))
    either = either.select("word", "longer", "length", F.col("w.start").alias("start"), F.col("w.end").alias("end"))
    more = F.greatest(F.col("longer"), F.lit(0))
    return either.withColumn("outside", _cut(F.col("word"), F.col("start"), F.col("end") + more))


def near_words(words: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """``(a, b)`` for every two of the distinct ``word`` that differ by one edited code point, in both directions.

    Words of fewer than two code points and nulls are near nothing.
    """
    words = words.where(F.char_length("word") >= 2).select("word", F.char_length("word").alias("size"))
    # ``longer`` is what the word has beyond the partner that sends chunks of ``length``; -1 marks that partner.
    roles = F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))
    state = words.select("word", "size", roles.alias("longer"))
    state = state.select("word", "longer", (F.col("size") - F.greatest(F.col("longer"), F.lit(0))).alias("length")).where("length >= 2")
    state = state.withColumns({"start": F.lit(0), "end": F.col("length")})
    found = None
    while True:
        state = materialize(_halved(state), "chunks")
        sends = F.col("longer") < 0
        groups = state.groupBy(*KEY).agg(
            F.count_if(sends).alias("chunks"), F.count_if(~sends).alias("grams"), F.min("word").alias("first"), F.max("word").alias("last")
        )
        groups = groups.where((F.col("chunks") > 0) & (F.col("first") < F.col("last")))
        crowded = (F.col("chunks") * F.col("grams") > pairs) & (F.col("end") - F.col("start") > 1)
        met = materialize(state.join(groups.select(*KEY, crowded.alias("crowded")), KEY), "met")
        calm = met.where(~F.col("crowded"))
        a = calm.where(sends).select(*KEY, F.col("word").alias("a"))
        b = calm.where(~sends).select(*KEY, F.col("word").alias("b"), "longer")
        # Words of equal length meet in both roles; one order is enough.
        both = a.join(b, KEY).where((F.col("longer") == 1) | (F.col("a") < F.col("b")))
        near = materialize(both.where(F.levenshtein("a", "b", 1) == 1).select("a", "b"), "near")
        found = near if found is None else found.union(near)
        state = met.where("crowded").select("word", "longer", "length", "start", "end")
        if not state.limit(1).count():
            break
    once = found.distinct()
    return once.union(once.select(F.col("b").alias("a"), F.col("a").alias("b")))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for every ``(word, form)``: where following forms ends. Each round doubles the steps taken."""
    taken = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = taken.select(F.col("word").alias("root"), F.col("root").alias("next"))
        taken = materialize(taken.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        moved = taken.where("moved").limit(1).count()
        taken = taken.select("word", "root")
        if not moved:
            return taken


def group_variants(words: DataFrame, times: int = TIMES, pairs: int = PAIRS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of distinct words with their counts.

    A word's form is its most frequent near word (ties: least in code-point order) if that is ``times`` as frequent, else null.
    """
    links = near_words(words, pairs)
    counts = words.select(F.col("word").alias("b"), "n")
    best = links.join(counts, "b").groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), F.col("b").alias("form"))).alias("best")
    )
    judged = words.join(best, "word", "left")
    fits = -F.col("best.less") >= times * F.col("n")
    judged = judged.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(fits, F.col("best.form")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n"),
    )
    judged = materialize(judged, "forms")
    ends = roots(judged.where(F.col("form").isNotNull()))
    out = judged.join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of the table, as ``word_counts`` and ``group_variants`` say.

    Null and empty texts give no words; a null id counts as the empty string in the rule for typos. Repeated rows count
    each time. Of near words that are equally frequent the least in code-point order is the form. Texts of any length are
    read whole; other columns are ignored. Empty tables give no rows.
    """
    return group_variants(materialize(word_counts(docs, doc_id, text), "words"))
