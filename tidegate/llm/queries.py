"""The registered queries of the numbered operators and, where SQL can say it, their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import (bpe, jaccard, mixing, quality, ranking, simhash, tokens, topk, toxicity,
                          url_trie, variants, warc, winnowing)
from tidegate.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edited_fingerprints(_table(spark, sf_dir, "documents"))


def rating(labels: DataFrame) -> DataFrame:
    """(id, grade): 0 for low quality, 1 for good texts that are toxic, 2 for the others."""
    good = F.when(F.col("toxic") == 1, 1).otherwise(2)
    return labels.select(F.col("doc_id").cast("long").alias("id"), F.when(
        F.col("quality") == 0, 0).when(F.col("quality") == 1, good).alias("grade"))


def with_quality(docs: DataFrame, every_doc: DataFrame, labels: DataFrame,
                 name: str = "_quality") -> DataFrame:
    """`docs` with the struct `name`, judged by a model of all rated documents."""
    model = quality.fit(every_doc.select(F.col("doc_id").alias("id"), "text"), rating(labels))
    return docs.withColumn(name, quality.assess(docs, F.col("text"), model))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = with_quality(docs.select("doc_id", "text"), docs, _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "_quality.expected_grade", "_quality.probability",
                         F.col("_quality.selected").alias("keep"))


def with_toxicity(docs: DataFrame, every_doc: DataFrame, labels: DataFrame,
                  name: str = "_toxicity") -> DataFrame:
    """`docs` with the struct `name`. Toxic words differ by language, so the chain goes from
    toxic in English and toxic in another language to toxic at all, which decides."""
    toxic, english = F.col("toxic") == 1, F.col("lang") == "en"
    categories = {"toxic_english": toxic & english, "toxic_other": toxic & ~english,
                  "toxic": toxic}
    chain = toxicity.fit(
        every_doc.select(F.col("doc_id").cast("long").alias("id"), "text", "lang"),
        labels.select(F.col("doc_id").cast("long").alias("id"), "toxic"), categories, "toxic")
    return docs.withColumn(name, toxicity.assess(docs, F.col("text"), chain))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


JACCARD_SQL = r"""
with recursive worded as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
sets as (
  select doc_id, list_distinct(case when len(w) = 0 then []
    when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
  from worded),
grams as (select doc_id, len(s) as n, unnest(s) as gram from sets),
shared as (
  select a.doc_id as a, b.doc_id as b, a.n as n, b.n as m, count(*) as common
  from grams a join grams b on a.gram = b.gram and a.doc_id <> b.doc_id
  group by all),
links as (select a, b from shared where 100 * common >= 75 * (n + m - common)),
reach as (
  select doc_id as a, doc_id as b from documents
  union
  select r.a, l.b from reach r join links l on r.b = l.a),
found as (select a, min(b) as component_id from reach group by a),
equal as (
  select doc_id, min(doc_id) over (partition by case when len(s) = 0 then [cast(doc_id as varchar),
    ''] else list_sort(s) end) as class_id from sets)
select s.doc_id, len(s.s) as n_shingles, f.component_id, e.class_id
from sets s join found f on f.a = s.doc_id join equal e on e.doc_id = s.doc_id
"""


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.top_k(vectors, F.col("id") % 20 == 0)


TOPK_SQL = """
with cells as (
  select vec_id, list_transform(embedding,
    lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id,
    cast(coalesce(list_sum(list_transform(list_zip(q.v, c.v),
      lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))), 0) as bigint) as score
  from cells q join cells c on q.vec_id <> c.vec_id
  where q.vec_id % 20 = 0),
ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer)
    as rank
  from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""


#: Target shares by language; sources and topics are evened out.
LANGUAGES = {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_table(spark, sf_dir, "documents"), {"lang": LANGUAGES})


PIECE_FILE = public_tokenizers.path("piece_bpe_32k.model")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    counter = tokens.Counter(spark, tokens.load_pieces(PIECE_FILE))
    return docs.select("doc_id", counter.count(F.col("text")).alias("n_tokens"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = with_toxicity(docs.select("doc_id", "text"), docs, _table(spark, sf_dir, "labels"))
    p = F.col("_toxicity.probabilities")
    return scored.select("doc_id", F.get(p, 0).alias("toxic_english"),
                         F.get(p, 1).alias("toxic_other"), F.get(p, 2).alias("probability"),
                         "_toxicity.toxic")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    typed = warc.with_record_types(_table(spark, sf_dir, "pages"))
    manifest = warc.write_archives(warc.chunk_rows(typed), folder)
    chunks = warc.read_archives(spark, manifest, folder, with_data=False)
    return warc.records(chunks).select(F.col("record_id").alias("page_id"), "payload_bytes",
                                       "payload_digest", "record_type", "refers_to", "intact")


WARC_SQL = """
with payloads as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
    sha256(coalesce(html, '')) as payload_digest
  from pages),
firsts as (
  select payload_digest, min(page_id) as first_id from payloads
  where payload_bytes >= 100 group by payload_digest having count(*) > 1)
select p.page_id, p.payload_bytes, p.payload_digest,
  case when f.first_id <> p.page_id then 'revisit' else 'response' end as record_type,
  case when f.first_id <> p.page_id then f.first_id end as refers_to,
  true as intact
from payloads p left join firsts f using (payload_digest)
"""

URL_RULES = [url_trie.Rule("net", "/", "block"), url_trie.Rule("example.net", "/en/", "allow"),
             url_trie.Rule("example.com", "/de/", "block"), url_trie.Rule("org", "/fr/", "allow")]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trie.filter_urls(_table(spark, sf_dir, "pages"), URL_RULES, keep=("page_id",))


URL_SQL = """
with parts as (
  select page_id,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path
  from pages),
judged as (
  select *, case
    when (host = 'example.net' or host like '%.example.net') and starts_with(path, '/en/')
      then 'example.net/en/'
    when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/de/')
      then 'example.com/de/'
    when (host = 'net' or host like '%.net') and starts_with(path, '/') then 'net/'
    when (host = 'org' or host like '%.org') and starts_with(path, '/fr/') then 'org/fr/'
    end as rule
  from parts)
select page_id, host, path, rule,
  case when rule in ('net/', 'example.com/de/') then 'block' else 'allow' end as verdict
from judged
"""

BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")


def bpe_digests(docs: DataFrame, path: str = BPE_FILE) -> DataFrame:
    """Ids and decoded text of each document, as counts and digests."""
    model = bpe.Bpe(docs.sparkSession, path)
    both = docs.select("doc_id", model.round_trip(F.col("text")).alias("bpe"))
    return both.select("doc_id", "bpe.ids", "bpe.decoded").select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(_table(spark, sf_dir, "documents"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_components(_table(spark, sf_dir, "documents"))


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(variants.thinned_words(_table(spark, sf_dir, "documents")))


def op13_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.ranked_search(_table(spark, sf_dir, "documents"),
                                 _table(spark, sf_dir, "benchmark"))


RANKING_SQL = r"""
with found as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents),
asked as (
  select item_id, term, count(*) as times from (
    select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark) group by all),
lengths as (select doc_id, count(*) as n from found group by doc_id),
whole as (select count(*) as documents, cast(sum(n) as bigint) as length from lengths),
near as (
  select doc_id, 25 + (75 * n * documents) // length as m from lengths, whole),
held as (
  select doc_id, term, count(*) as tf from found
  where term in (select term from asked) group by all),
weights as (
  select term, cast(floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1))) as bigint)
    as w
  from held, whole group by term),
scored as (
  select item_id, doc_id, cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint)
    as score
  from asked join held using (term) join weights using (term) join near using (doc_id)
  group by all),
ranked as (
  select *, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer)
    as rank
  from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""


QUERIES = {
    "op1_winnowing": op1_winnowing,
    "op2_quality": op2_quality,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_token_counts": op4_token_counts,
    "op5_topk": op5_topk,
    "op6_warc": op6_warc,
    "op7_url_filter": op7_url_filter,
    "op8_bpe": op8_bpe,
    "op9_mixing": op9_mixing,
    "op10_toxicity": op10_toxicity,
    "op11_simhash": op11_simhash,
    "op12_variants": op12_variants,
    "op13_ranking": op13_ranking,
}

ORACLE = {
    "op3_ngram_jaccard": JACCARD_SQL,
    "op5_topk": TOPK_SQL,
    "op6_warc": WARC_SQL,
    "op7_url_filter": URL_SQL,
    "op13_ranking": RANKING_SQL,
}
