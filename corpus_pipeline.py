"""A training corpus from raw documents: language, near copies, repeated passages, benchmark leaks, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstrata import configure
from logstrata.llm import bpe, language_codes, suffix_dedup
from logstrata.llm.decontamination import contaminated
from logstrata.llm.minhash_dedup import near_duplicates
from logstrata.session import materialize

# SQL has neither the models nor the tokenizer; tests/llm checks the stages against plain Python.
ORACLE_SQL = None


# A text has at least this share of letters in what is not blank.
LEAST_LETTERS = 0.2


def _apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The documents under names that no operator gives a column of its own, and the new name of each column."""
    names = [f"_doc{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), dict(zip(docs.columns, names))


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents and a column that tells their rows apart: ``doc_id``, unless it is null or repeats somewhere.

    Then rows are numbered by their place, in a written table, so that every later read sees the same numbers.
    """
    counts = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"))
    if not counts.where("doc_id is null or _n > 1").limit(1).count():
        return docs, "doc_id"
    key = "_row"
    while key in docs.columns:
        key += "_"
    return materialize(docs.withColumn(key, F.monotonically_increasing_id()), "rows"), key


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in one of the languages that the labelled rows hold.

    A text goes if it is null or has no letter, if less than ``LEAST_LETTERS`` of it is letters, or if its n-grams are less
    likely in the language it is nearest to than drawn at random: another language, or noise. A text whose nearest language
    is merely ambiguous (one word, say) stays. Where no row has a language, all texts with letters stay. Repeated rows are
    judged alike; extra columns stay as they are, whatever their names.
    """
    model = language_codes.fit(docs, F.lit(True))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    inner, name = _apart(docs)
    told = language_codes.identify(inner, model, text=name["text"], evidence=True)
    kept = (F.col("lang_pred") != language_codes.UNDETERMINED) & (F.col("evidence") >= 0) & (F.col("letters") >= LEAST_LETTERS)
    return told.where(kept).select(*name.values()).toDF(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 over five-word shingles: that of the smallest id.

    Null and empty texts are linked with nothing and stay. Rows that repeat, and rows without an id, are documents of their
    own; where there are such rows, the first row of a group stays.
    """
    rows, key = _keyed(docs)
    inner, name = _apart(rows)
    own = F.col(name[key])
    kept = near_duplicates(inner, size=5, percent=80, key=name[key], text=name["text"]).where("kept").select(own.alias("_kept"))
    return inner.join(kept, own == F.col("_kept"), "left_semi").select(*[F.col(name[c]).alias(c) for c in docs.columns])


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of earlier ones; a document that loses all its text goes.

    Earlier is a smaller id, or an earlier row where ids are null or repeat. ``n_chars`` follows the text where it changed.
    Null and empty texts lose nothing and stay. Extra columns stay as they are, whatever their names.
    """
    rows, key = _keyed(docs)
    inner, name = _apart(rows)
    cut = suffix_dedup.remove_repeats(inner, key=name[key], text=name["text"], content=False, readable=True)
    left = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_bytes")))
    changed = F.col("n_removed") > 0
    left = left.withColumns(
        {
            name["text"]: F.when(changed, F.col("kept_text")).otherwise(F.col(name["text"])),
            name["n_chars"]: F.when(changed, F.length("kept_text")).otherwise(F.col(name["n_chars"])),
        }
    )
    return left.select(*[F.col(name[c]).alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark.

    Every row is judged by its own text, whatever its id, and repeated rows go together. Null and empty texts and items hold
    nothing; with an empty benchmark all stay.
    """
    rows, key = _keyed(docs)
    inner, name = _apart(rows)
    own = F.col(name[key])
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").withColumnRenamed("text", name["text"])
    found = contaminated(inner, benchmark, key=name[key], text=name["text"]).select(own.alias("_found")).distinct()
    return inner.join(found, own == F.col("_found"), "left_anti").select(*[F.col(name[c]).alias(c) for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, with digests of the ids and of the bytes they decode to; a null text is empty. Each row is coded."""
    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("repeats", repeats),
    ("decontamination", decontamination),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table, each written to the shared folder before the next; an empty table gives no rows."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
