"""Registered queries of this subpackage: thin digests of the operators'
outputs over the whole given tables, and their DuckDB SQL where it exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_codec, language_id, quality, toxicity
from .common import crc_mod, documents
from .decontaminate import decontaminate
from .exact_dedup import exact_dedup
from .labelled import held_out
from .lexical_search import search
from .pii import pseudonymize
from .quality_rules import quality_rules
from .repeated_spans import repeated_passages
from .simhash import near_duplicates
from .spelling import spelling_variants
from .token_fst import count_tokens

# Sequences of more tokens than this are flagged (the model's context).
CONTEXT_TOKENS = 2048

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer file (never copied here)."""
    import public_tokenizers
    return public_tokenizers.path(name)


@_query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = count_tokens(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"), keep=["doc_id"])
    return out.withColumn("over_limit", F.col("n_tokens") > CONTEXT_TOKENS)


# The key of the registered query. In production it is a secret.
SURROGATE_KEY = "registered-query"


@_query
def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return pseudonymize(docs, SURROGATE_KEY)


LANGUAGE_MOD = 5


def language_model(docs: DataFrame) -> list:
    """Learnt from the rows that are not held out."""
    return language_id.learn(docs.filter(crc_mod("doc_id", LANGUAGE_MOD) != 0))


@_query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = language_id.identify(docs, language_model(docs), keep=["doc_id"])
    return out.select("doc_id", (crc_mod("doc_id", LANGUAGE_MOD) == 0).alias("held_out"),
                      "lang_pred", "score", "margin", "rejected")


@_query
def op4_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.learn(docs, documents(spark, sf_dir, "labels"))
    out = toxicity.classify(docs, model, keep=["doc_id"])
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted", "threshold_lang")


@_query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "keep_id", "group_size", "kept",
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


ORACLE["op5_exact_dedup"] = """
with d as (select doc_id, coalesce(text, '') as t from documents)
select doc_id, max(doc_id) over (partition by t) as keep_id,
       count(*) over (partition by t) as group_size,
       doc_id = max(doc_id) over (partition by t) as kept,
       sha256(t) as text_sha256
from d
"""


@_query
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


@_query
def op7_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.learn(docs, documents(spark, sf_dir, "labels"))
    out = quality.classify(docs, model, keep=["doc_id"])
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted", "nearest")


@_query
def op8_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(documents(spark, sf_dir))


def bpe_digests(df: DataFrame, keep: list[str], extra: list[str] = ()) -> DataFrame:
    """Encode, decode, and digest both; ``extra`` may name ``ids`` (packed)
    and ``decoded``."""
    path = tokenizer_file("byte_bpe_multi_50k.tiktoken")
    out = bpe_codec.encode_and_decode(df, path, keep=keep)
    return out.select(*keep, *extra, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@_query
def op9_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(documents(spark, sf_dir), ["doc_id"])


@_query
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
                      "contaminated")


_WORDS = ("regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")
ORACLE["op10_benchmark_decontamination"] = f"""
with d as (select doc_id, {_WORDS.format(t="coalesce(text, '')")} w from documents),
b as (select item_id, {_WORDS.format(t="text")} w from benchmark where text is not null),
win as (
  select distinct item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') g from (
    select item_id, w, least(len(w), 10) k, unnest(range(1, greatest(len(w) - 9, 1) + 1)) i from b where len(w) > 0) z),
occ as (
  select doc_id, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') g from (
    select doc_id, w, k, unnest(range(1, len(w) - k + 2)) i from d, (select distinct k from win) ks where len(w) >= k) z),
hits as (select doc_id, i, occ.k k, item_id from occ join win on win.k = occ.k and win.g = occ.g),
cover as (select doc_id, count(distinct p) n from (select doc_id, unnest(range(i, i + k)) p from hits) z group by doc_id),
found as (
  select doc_id, count(*) n, string_agg(item, ',' order by item) ids
  from (select distinct doc_id, cast(item_id as varchar) item from hits) z group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) n_words, coalesce(cover.n, 0) n_hit, coalesce(found.n, 0) n_items,
       sha256(coalesce(found.ids, '')) items_sha256, coalesce(cover.n, 0) > 0 contaminated
from d left join cover on cover.doc_id = d.doc_id left join found on found.doc_id = d.doc_id
"""


@_query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"), k=20)


_TERMS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')")
ORACLE["op12_lexical_search"] = f"""
with d as (select doc_id, {_TERMS} w from documents),
s as (select count(*) big_n, sum(len(w)) big_l from d where len(w) > 0),
p as (select doc_id, n, t, count(*) tf from (select doc_id, len(w) n, unnest(w) t from d) z group by all),
f as (select t, count(*) df from p group by t),
q as (select item_id, t, count(*) c from (select item_id, unnest({_TERMS}) t from benchmark) z group by all),
x as (
  select item_id, doc_id, cast(sum(c * cast(floor(1000 * ln(cast(2 * big_n + 2 as double) / (2 * df + 1))) as bigint)
      * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l)))) as bigint) score
  from q join f using (t) join p using (t) cross join s group by item_id, doc_id),
r as (select *, row_number() over (partition by item_id order by score desc, doc_id) k from x where score > 0)
select item_id, cast(k as integer) "rank", doc_id, score from r where k <= 20
"""


@_query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))


# CRC-32 in SQL: the table follows from its polynomial, a run's bytes fold over it.
ORACLE["op13_spelling_variants"] = r"""
with recursive crc(i, c, k) as (
  select i, cast(i as bigint), 0 from range(256) z(i)
  union all
  select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from crc where k < 8),
tab as (select list(c order by i) t from crc where k = 8),
runs as (
  select doc_id, run, count(*) n from (
    select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) run from documents) z group by all),
coded as (
  select run, n, hex(concat(doc_id, ':', run)) x from runs where length(run) >= 6),
hashed as (
  select run, n, xor(list_reduce(list_concat([cast(4294967295 as bigint)],
      list_transform(range(0, length(x) // 2), lambda i: cast(concat('0x', substr(x, 2 * i + 1, 2)) as bigint))),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) h
  from coded, tab),
words as (
  select case when h % 199 = 0 then concat(left(run, h % length(run)), substr(run, h % length(run) + 2)) else run end word,
         n from hashed),
vocab as (select word, cast(sum(n) as bigint) n from words where length(word) >= 6 group by word having sum(n) >= 5),
cut as (
  select word, n, i, concat(left(word, i - 1), substr(word, i + 1)) rest
  from (select word, n, unnest(range(1, length(word) + 1)) i from vocab) z),
pairs as (
  select a.word, a.n, b.word near, b.n near_n from cut a join cut b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union
  select a.word, a.n, b.word, b.n from cut a join vocab b on a.rest = b.word
  union
  select b.word, b.n, a.word, a.n from cut a join vocab b on a.rest = b.word),
best as (
  select word, n, count(*) n_near, list({'m': -near_n, 'w': near} order by near_n desc, near)[1] b from pairs group by all),
near as (
  select word, n_near, case when -b.m >= 5 * n then b.w end form, case when -b.m >= 5 * n then -b.m end form_n from best),
walk(word, place, d) as (
  select word, form, 1 from near where form is not null
  union all
  select walk.word, near.form, d + 1 from walk join near on near.word = walk.place where near.form is not null),
root as (select word, arg_max(place, d) root from walk group by word)
select v.word, near.form, coalesce(root.root, v.word) root, v.n, coalesce(near.n_near, 0) n_near, near.form_n
from vocab v left join near on near.word = v.word left join root on root.word = v.word
"""


@_query
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = documents(spark, sf_dir, "labels")
    out = quality_rules(documents(spark, sf_dir), labels.filter("quality = 1").select("doc_id"), keep=["doc_id"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


ORACLE["op11_quality_rules"] = r"""
with d as (
  select row_number() over () k, doc_id, coalesce(text, '') t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
tok as (
  select k, doc_id, unnest(range(1, len(w) + 1)) i, unnest(w) word from d),
h as (
  select k, doc_id, i, cast(md5_number_lower(word) & 2147483647 as bigint) h,
         lead(cast(md5_number_lower(word) & 2147483647 as bigint)) over (partition by k order by i) h2 from tok),
g as (
  select k, doc_id, h & 65535 b from h
  union all
  select k, doc_id, 65536 + ((h * 40503 + h2) & 65535) from h where h2 is not null),
trust as (
  select doc_id, cast(concat('0x', left(md5(cast(doc_id as varchar)), 8)) as bigint) % 4 = 0 cal
  from (select distinct doc_id from labels where quality = 1) z),
bins as (select unnest(range(131072)) b),
cr as (select b, count(*) n from g group by b),
ct as (select b, count(*) n from g join trust using (doc_id) where not cal group by b),
c as (select b, coalesce(cr.n, 0) r, coalesce(ct.n, 0) t from bins left join cr using (b) left join ct using (b)),
s as (select sum(r) r, sum(t) t from c),
wt as (
  select b, cast(floor(1048576 * (ln((c.t + 1) / (s.t + 131072)) - ln((c.r + 1) / (s.r + 131072))) + 0.5) as bigint) v
  from c, s),
llr as (select k, sum(v) v, count(*) n from g join wt using (b) group by k),
win as (select k, i, count(*) over (partition by k, word, w2, w3) n from (
  select k, i, word, lead(word) over o w2, lead(word, 2) over o w3 from tok window o as (partition by k order by i)) z
  where w3 is not null),
rep as (select k, count(distinct p) n from (select k, unnest([i, i + 1, i + 2]) p from win where n > 1) z group by k),
ln as (select k, count(*) - count(distinct x) n from (
  select k, unnest(string_split(t, chr(10))) x from d) z where regexp_matches(x, '[^\x20\x09-\x0D]') group by k),
base as (
  select d.k, d.doc_id, cast(len(w) as bigint) n_words, cast(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as bigint) word_chars,
         cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) n_symbols,
         coalesce(ln.n, 0) n_dup_lines, coalesce(rep.n, 0) n_repeat_words,
         len(w) < 50 or 100 * coalesce(rep.n, 0) > 50 * len(w) base_failed
  from d left join rep on rep.k = d.k left join ln on ln.k = d.k),
cal as (
  select cast(floor(cast(llr.v as double) / llr.n / 1024) as bigint) bin, count(*) n
  from base join trust on trust.doc_id = base.doc_id and cal join llr on llr.k = base.k where not base_failed group by 1),
edge as (
  select min(bin) * 1024 - 262144 cut from (
    select bin, sum(n) over (order by bin) upto, sum(n) over () total from cal) z where upto > 0.01 * total)
select base.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and llr.v >= edge.cut * llr.n kept
from base left join llr on llr.k = base.k cross join edge
"""
