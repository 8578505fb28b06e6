"""The operators over their whole tables, by name, and the SQL of those that have an equivalent."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from metframe.llm import align, bpe, chat, decontaminate, fingerprints, jaccard_join, lm, negatives, pii, quality, suffixes, toxicity, urls

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = "word_bpe_49k.json"
ALIGNED = "byte_bpe_50k.json", "piece_bpe_32k.model"

# Rules over hosts and paths, and the hosts that the globs block.
RULES = [
    urls.Rule("net", "/", "block"), urls.Rule("example.net", "/en/", "allow"),
    urls.Rule("example.com", "/de/", "block"), urls.Rule("org", "/fr/", "allow"),
]
BLOCK = ["spam-*.**", "*.spam-*.**", "cheap-*.**", "*.cheap-*.**", "*casino*.**", "*/ads/**", "**/popup?.html"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items it holds."""
    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_key")


def jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near duplicates."""
    return jaccard_join.near_classes(table(spark, sf_dir, "documents")).drop("row_key", "class")


def importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its importance weight and whether the resampling keeps it."""
    return quality.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("row_key")


def encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again, as digests."""
    return bpe.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), with_ids=False)


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the rules, else by the globs."""
    return urls.judged(table(spark, sf_dir, "pages"), RULES, BLOCK).drop("glob")


def personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the spans of its personal data."""
    return pii.personal_data(table(spark, sf_dir, "documents")).drop("row_key")


def language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its log probabilities under the unigram base and under the model."""
    return lm.scored(table(spark, sf_dir, "documents"))


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its toxicity score."""
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and an edited version's, and how near they and the next one's are."""
    return fingerprints.compared(table(spark, sf_dir, "documents"), pieces=fingerprints.CLAUSES).drop("edited_digests")


def repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 200-byte strings that start anywhere else too."""
    return suffixes.without_repeats(table(spark, sf_dir, "documents"), keep_first=False, with_bytes=False)


def alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the groups and links of two tokenizers' tokens."""
    return align.aligned(table(spark, sf_dir, "documents"), *map(public_tokenizers.path, ALIGNED), with_groups=False)


def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every anchor and positive; an anchor's id is divisible by 100."""
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return negatives.mined(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=changed)


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as canonical turns, formatted under a loss mask and read back."""
    own = spark.createDataFrame([(-7, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant"))], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(own)
    out = chat.formatted(chat.canonical(chat.records_of(rows))).select("conv_id", "layout", "formatted", "loss")
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return chat.read_back(out).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "layout")


LEAK_SQL = r"""
with split as (
  select 'd' as side, doc_id as id, list_filter(string_split_regex(lower(coalesce(text, '')), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') as w from documents
  union all
  select 'i', item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') from benchmark),
grams as (
  select distinct side, id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) as g from split),
items as (select id as item_id, g, count(*) over (partition by id) as n_shingles from grams where side = 'i')
select d.id as doc_id, item_id, n_shingles, count(*) as n_found, count(*) / n_shingles as containment
from grams d join items using (g) where d.side = 'd' group by d.id, item_id, n_shingles having count(*) / n_shingles >= 0.8"""

URL_SQL = r"""
with parts as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
split as (
  select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from parts),
ruled as (
  select *, case
    when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
    when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
    when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/' end as rule
  from split)
select page_id, host, path, rule, case
  when rule in ('example.net/en/', 'org/fr/') then 'allow' when rule is not null then 'block'
  when regexp_matches(host || path, '^([^/]*\.)?(spam|cheap)-[^/]*\.') or regexp_matches(host || path, '^[^/]*casino[^/]*\.')
    or regexp_matches(host || path, '^[^/]*/ads/') or regexp_matches(host || path, '/popup[^/]\.html$') then 'block'
  else 'allow' end as verdict
from ruled"""

NEGATIVE_SQL = """
with sound as (
  select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and coalesce(list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false))), true)),
scores as (
  select a.vec_id as anchor_id, a.label = b.label as same, b.vec_id as id, list_dot_product(a.v, b.v)::bigint as score
  from sound a join sound b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
positives as (
  select anchor_id, id, score from scores where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select anchor_id, p.id as positive_id, row_number() over (partition by anchor_id, p.id order by n.score desc, n.id)::int as rank,
  n.id as negative_id, p.score as positive_score, n.score as negative_score
from positives p join scores n using (anchor_id)
where not same and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
qualify row_number() over (partition by anchor_id, p.id order by n.score desc, n.id) <= 10"""

CHAT_SQL = r"""
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized as (
  select *, length(role || text) + list_sum(list_transform(['\', '<|', '<s>', '</s>', '[INST]', '[/INST]', '<<SYS>>', '<</SYS>>'],
    lambda c: (length(role) - length(replace(role, c, '')) + length(text) - length(replace(text, c, ''))) // length(c))) as chars
  from said)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(chars + length('<|im_start|><|im_sep|><|im_end|>'))::bigint as formatted_chars,
  case when list(role order by turn, role, text) = ['user', 'assistant'] then 'prompt'
    when list(role order by turn, role, text) = ['system', 'user', 'assistant'] then 'instruction'
    when bool_and(role in ('system', 'user', 'assistant')) then 'conversations' else 'messages' end as layout
from sized group by conv_id"""

QUERIES: dict[str, Query] = {
    "op1_benchmark_containment": leaks,
    "op2_ngram_jaccard_join": jaccard,
    "op3_importance_resampling": importance,
    "op4_bpe_tree_concatenation": encoding,
    "op5_url_wildcard_automaton": url_rules,
    "op6_log_bilinear_lm": language_model,
    "op7_weak_supervision_toxicity": toxic,
    "op8_invertible_bloom_fingerprints": versions,
    "op9_bootstrapped_pii": personal,
    "op10_suffix_repeats": repeats,
    "op11_threshold_join_negatives": hard_negatives,
    "op12_schema_fingerprint_chat": chats,
    "op13_shared_cut_alignment": alignment,
}

ORACLES: dict[str, str] = {"op1_benchmark_containment": LEAK_SQL, "op5_url_wildcard_automaton": URL_SQL, "op11_threshold_join_negatives": NEGATIVE_SQL, "op12_schema_fingerprint_chat": CHAT_SQL}
