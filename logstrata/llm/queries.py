"""The registered queries of this subpackage: each operator over its whole table, and what SQL can check."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logstrata import configure
from logstrata.llm import bpe, forced_bpe, language_codes, license_scan, suffix_dedup, toxicity_cnn
from logstrata.llm.decontamination import contaminated
from logstrata.llm.histogram_shards import histogram_shards
from logstrata.llm.lexical_search import search
from logstrata.llm.minhash_dedup import near_duplicates
from logstrata.llm.perplexity_rules import STATISTICS, quality_rules
from logstrata.llm.spelling_variants import spelling_variants
from logstrata.llm.suffix_tree import score_texts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = lambda spark, sf_dir: function(configure(spark), sf_dir)
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op7_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return judged.select("doc_id", *STATISTICS, "base_failed", "kept", "log_perplexity")


@query
def op10_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = histogram_shards(table(spark, sf_dir, "documents"))
    return sharded.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def held_out(parts: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == 2


@query
def op9_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out(7).alias("held_out"))
    scored = score_texts(docs, ~F.col("held_out"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op3_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out(4).alias("held_out"))
    model = language_codes.fit(docs, ~F.col("held_out"))
    return language_codes.identify(docs, model, carry=["doc_id", "held_out"])


@query
def op8_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out(4).alias("held_out"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity_cnn.fit(docs, ~F.col("held_out"), labels=labels)
    return toxicity_cnn.detect(docs, model, carry=["doc_id", "held_out"])


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


ORACLES["op6_license_scan"] = license_scan.oracle()


@query
def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), content=False, carry=["doc_id"])


@query
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, carry=["doc_id"], content=False)


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_forced_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return forced_bpe.encode(table(spark, sf_dir, "documents"), path, carry=["doc_id"], content=False)


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


# Runs with their checksums, then words that agree but for one place or one left out.
ORACLES["op12_spelling_variants"] = r"""
with recursive bits as (
  select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) order by i) as tab
  from range(256) t(i)),
runs as (
  select doc_id, run, count(*) as n from (
    select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]{6,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
    from documents) group by doc_id, run),
coded as (select *, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) as h from runs),
hashed as (
  select run, n, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(range(1, len(h), 2), lambda i: ('0x' || substr(h, i, 2))::bigint)),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) as h
  from coded, bits),
words as (
  select word, sum(n)::bigint as n from (
    select n, case when h % 199 = 0 then substr(run, 1, h % length(run)) || substr(run, (h % length(run))::bigint + 2) else run end as word from hashed)
  where length(word) >= 6 group by word having sum(n) >= 5),
places as (select word, unnest(range(1, length(word) + 1)) as i from words),
holes as (select word, substr(word, 1, i - 1) || '?' || substr(word, i + 1) as hole, substr(word, 1, i - 1) || substr(word, i + 1) as less from places),
near as (
  select a.word as a, b.word as b from holes a join holes b using (hole) where a.word <> b.word
  union select h.word, w.word from holes h join words w on h.less = w.word
  union select w.word, h.word from holes h join words w on h.less = w.word),
best as (
  select a as word, count(*) as n_near, arg_min(b, (-n, b)) as form, max(n) as form_n
  from near join (select word as b, n from words) using (b) group by a),
judged as (
  select word, n, coalesce(n_near, 0) as n_near, case when b.form_n >= 5 * n then b.form end as form, case when b.form_n >= 5 * n then b.form_n end as form_n
  from words left join best b using (word)),
follow as (
  select word, word as at from judged
  union all select f.word, j.form from follow f join judged j on j.word = f.at where j.form is not null)
select j.word, j.form, f.at as root, j.n, j.n_near, j.form_n
from judged j join follow f using (word) join judged last on last.word = f.at where last.form is null
"""


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


# Every item's terms against every document's, all scored.
ORACLES["op13_lexical_search"] = r"""
with d as (
  select row_number() over () as doc, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t
  from documents where text is not null),
q as (
  select row_number() over () as item, item_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t
  from benchmark where text is not null),
size as (select count(*)::bigint as n, sum(len(t))::bigint as l from d where len(t) > 0),
postings as (select doc, doc_id, term, count(*)::bigint as tf, any_value(n) as n from (select doc, doc_id, len(t) as n, unnest(t) as term from d) group by doc, doc_id, term),
weights as (select term, floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1)))::bigint as w from (select term from postings), size group by term, n),
asked as (select item, item_id, term, count(*)::bigint as r from (select item, item_id, unnest(t) as term from q) group by all),
scored as (
  select item, item_id, doc, doc_id, sum(r * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * p.n * size.n) // size.l))))::bigint as score
  from asked join postings p using (term) join weights using (term), size group by all),
ranked as (select *, row_number() over (partition by item order by score desc, doc_id) as place from scored where score > 0)
select item_id, place::int as rank, doc_id, score from ranked where place <= 20
"""

# Full sets against full sets, then everything reachable over links.
ORACLES["op1_minhash_dedup"] = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
s as (
  select doc_id, case when len(w) >= 3 then list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)])
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s from w),
e as (select doc_id, len(s) as n, unnest(s) as x from s),
links as (
  select a.doc_id as a, b.doc_id as b from e a join e b on a.x = b.x and a.doc_id <> b.doc_id
    and 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
least_id as (select a, min(b) as b from reach group by a)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, least(s.doc_id, coalesce(l.b, s.doc_id)) as component_id,
  s.doc_id <= coalesce(l.b, s.doc_id) as kept
from s left join least_id l on l.a = s.doc_id
"""
