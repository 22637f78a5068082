"""Registered queries: one per operator, each reading the given tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name]`` (DuckDB
SQL over the same parquet files) share column names, so a result can be
compared with its oracle row for row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import stats
from . import oracle as O
from . import tables as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- sources
@register("read_lines", O.with_(O.LINES) + "select * from lines")
def q_read_lines(spark, sf):
    return T.lines(spark, sf)


# ---------------------------------------------------------------- F1, A3
@register("pretokenize", O.with_(O.LINES) + f"""
select doc_id, line_no, cast(u.i - 1 as bigint) pos, u.t pretoken
from lines, unnest({O.pretokens_expr('line')}) with ordinality u(t, i)""")
def q_pretokenize(spark, sf):
    return stats.pretokens(T.lines(spark, sf), ["doc_id", "line_no"])


@register("pretoken_histogram", O.with_(O.LINES) + f"""
select t pretoken, count(*) n from (select unnest({O.pretokens_expr('line')}) t from lines) z
group by t""")
def q_pretoken_histogram(spark, sf):
    return stats.pretoken_histogram(T.lines(spark, sf))


# ---------------------------------------------------------------- shared pieces
def _bitext(spark, sf):
    return T.bitext(spark, sf)


BITEXT_KEYS = ["pair", "doc_no", "line_no"]
QUALITY_SQL = ("src <> '' and tgt <> '' and length(src) <= 2 * length(tgt) "
               "and length(tgt) <= 2 * length(src)")


def _quality():
    return F.expr(QUALITY_SQL)


def _h(seed, *cols):
    return f"md5(concat_ws(':', '{seed}', {', '.join(cols)}))"


# ---------------------------------------------------------------- P1–P7
@register("normalize_newlines", O.with_(O.LINES, O.LINES_DIRTY) + """
select doc_id, line_no, replace(concat(line, chr(10)), chr(13) || chr(10), chr(10)) text
from lines_dirty""")
def q_normalize_newlines(spark, sf):
    from ..functions.text import normalize_newlines
    d = T.lines_dirty(spark, sf)
    return d.select("doc_id", "line_no",
                    normalize_newlines(F.concat("line", F.lit("\n"))).alias("text"))


@register("drop_lines", O.with_(O.LINES, O.LINES_DIRTY) + """
select doc_id, source, line_no, line from lines_dirty
where not (source in ('src3', 'src4') and (contains(line, '</hl') or ends_with(line, '<hl>')))""")
def q_drop_lines(spark, sf):
    from ..operators.clean import drop_lines
    d = T.lines_dirty(spark, sf).select("doc_id", "source", "line_no", "line")
    return drop_lines(d, "line", where=F.col("source").isin("src3", "src4"))


@register("protect_amp", O.with_(O.LINES, O.LINES_DIRTY) + """
select doc_id, line_no, replace(line, '&', '__amp__') protected,
       replace(replace(line, '&', '__amp__'), '__amp__', '&') restored
from lines_dirty""")
def q_protect_amp(spark, sf):
    from ..functions.text import protect_amp, restore_amp
    d = T.lines_dirty(spark, sf)
    return d.select("doc_id", "line_no", protect_amp("line").alias("protected"),
                    restore_amp(protect_amp("line")).alias("restored"))


@register("strip_text", O.with_(O.LINES, O.LINES_DIRTY) + """
select doc_id, line_no, regexp_replace(line, '^[\\s\\x1c-\\x1f]+|[\\s\\x1c-\\x1f]+$', '', 'g') stripped
from lines_dirty""")
def q_strip_text(spark, sf):
    from ..functions.text import strip_text
    d = T.lines_dirty(spark, sf)
    return d.select("doc_id", "line_no", strip_text("line").alias("stripped"))


@register("tag_language", O.with_(O.BITEXT) + """
select pair, doc_no, line_no, concat('<2', substr(pair, 4, 8), '> ', src) src_tagged, tgt
from bitext""")
def q_tag_language(spark, sf):
    from ..operators.clean import tag_language
    return tag_language(_bitext(spark, sf)).select("pair", "doc_no", "line_no", "src_tagged", "tgt")


CORPUS_NAME_SQL = ("concat('en-', lang, '.', source, '.', lang, "
                   "case when substr(md5(cast(doc_id as string)), 1, 1) < '8' then '.sp' else '' end)")


def _corpus_files(spark, sf):
    return T.documents(spark, sf).select("doc_id", F.expr(CORPUS_NAME_SQL).alias("name"))


@register("parse_corpus_name", f"""
with f as (select doc_id, {CORPUS_NAME_SQL} name from documents)
select doc_id, name,
  nullif(regexp_extract(name, '^(en-..)\\.([^.]+)\\.(..)(\\.sp)?$', 1), '') pair,
  nullif(regexp_extract(name, '^(en-..)\\.([^.]+)\\.(..)(\\.sp)?$', 2), '') split,
  nullif(regexp_extract(name, '^(en-..)\\.([^.]+)\\.(..)(\\.sp)?$', 3), '') lang,
  regexp_extract(name, '^(en-..)\\.([^.]+)\\.(..)(\\.sp)?$', 4) = '.sp' encoded
from f""")
def q_parse_corpus_name(spark, sf):
    from ..operators.clean import parse_corpus_name
    return parse_corpus_name(_corpus_files(spark, sf), "name")


FREQ_VOCAB_SQL = f"""hist as (
  select t pretoken, count(*) n from (select unnest({O.pretokens_expr('line')}) t from lines) z
  group by t),
fvocab as (
  select pretoken piece, n, cast(row_number() over (order by n desc, pretoken) + 4 as integer) id
  from hist qualify row_number() over (order by n desc, pretoken) <= 1000)"""


def _freq_vocab(spark, sf, size=1000):
    from ..operators.clean import frequency_vocab
    return frequency_vocab(stats.pretoken_histogram(T.lines(spark, sf)), size)


@register("vocab_pieces", O.with_(O.LINES, FREQ_VOCAB_SQL) + "select id, piece from fvocab")
def q_vocab_pieces(spark, sf):
    from ..operators.clean import vocab_pieces
    return vocab_pieces(_freq_vocab(spark, sf))


# ---------------------------------------------------------------- J1–J4
@register("zip_parallel", O.with_(O.BITEXT) + "select * from bitext")
def q_zip_parallel(spark, sf):
    return _bitext(spark, sf)


DEV_MEMBERS_SQL = O.DOC_RANKS + """,
members as (
  select 'dev.tgz' archive,
         concat('dev/newstest', doc_no, '-en', lang, '-ref.', lang, '.sgm') member,
         text from kdocs where lang <> 'en'
  union all
  select 'dev.tgz', concat('dev/newstest', doc_no, '-en', t.l, '-src.en.sgm'), text
  from kdocs, (select unnest(['de', 'es', 'fr']) l) t where lang = 'en')"""


@register("pair_ref_src", "with " + DEV_MEMBERS_SQL + """
select r.archive, regexp_extract(r.member, '([^/]*)-ref\\.', 1) "set", r.member ref_member,
       regexp_extract(r.member, 'ref\\.([a-z]{2})\\.sgm$', 1) ref_lang, s.member src_member,
       r.text ref_text, s.text src_text
from members r join members s
  on s.archive = r.archive
 and s.member = concat(regexp_extract(r.member, '^(.*)ref\\.[^/]*$', 1), 'src.en.sgm')
where regexp_matches(r.member, 'ref\\.[a-z]{2}\\.sgm$')""")
def q_pair_ref_src(spark, sf):
    from ..operators.joins import pair_ref_src
    docs = T.ranked_documents(spark, sf)
    ref = docs.filter(F.col("lang") != "en").select(
        F.lit("dev.tgz").alias("archive"),
        F.concat(F.lit("dev/newstest"), F.col("doc_no").cast("string"), F.lit("-en"), "lang",
                 F.lit("-ref."), "lang", F.lit(".sgm")).alias("member"),
        "text")
    src = docs.filter(F.col("lang") == "en").select(
        F.lit("dev.tgz").alias("archive"), "doc_no", "text",
        F.explode(F.array(*[F.lit(x) for x in ("de", "es", "fr")])).alias("l")).select(
        "archive", F.concat(F.lit("dev/newstest"), F.col("doc_no").cast("string"), F.lit("-en"),
                            "l", F.lit("-src.en.sgm")).alias("member"), "text")
    out = pair_ref_src(ref.unionByName(src))
    return out.select("archive", "set", "ref_member", "ref_lang", "src_member", "ref_text", "src_text")


@register("lookup_ids", O.with_(O.LINES, FREQ_VOCAB_SQL) + f"""
select doc_id, line_no, cast(u.i - 1 as bigint) pos, coalesce(v.id, 3) id
from lines, unnest({O.pretokens_expr('line')}) with ordinality u(t, i)
left join fvocab v on v.piece = u.t""")
def q_lookup_ids(spark, sf):
    from ..operators.joins import lookup_ids
    from ..functions.text import pretokenize
    ln = T.lines(spark, sf).select("doc_id", "line_no", pretokenize("line").alias("pieces"))
    out = lookup_ids(ln, "pieces", _freq_vocab(spark, sf))
    return out.select("doc_id", "line_no", F.col("_pos").cast("long").alias("pos"), "id")


OFFSETS_SQL = """f as (select doc_id, count(*) n from lines group by doc_id),
o as (select doc_id, cast(coalesce(sum(n) over (order by doc_id rows between unbounded
      preceding and 1 preceding), 0) as bigint) start from f)"""


@register("sample_at", O.with_(O.LINES, OFFSETS_SQL) + """,
fs as (select n first_size from f order by doc_id limit 1)
select start + line_no i, doc_id, line_no,
       cast(floor((start + line_no) / first_size) as bigint) ref_file,
       cast((start + line_no) % first_size as bigint) ref_sample
from lines join o using (doc_id), fs""")
def q_sample_at(spark, sf):
    from ..operators.joins import line_offsets, sample_at
    ln = T.lines(spark, sf)
    offs = line_offsets(ln)
    n, first = offs.agg(F.sum("n_lines"), F.min_by("n_lines", "doc_id")).first()
    idx = spark.range(0, int(n)).withColumnRenamed("id", "i")
    out = sample_at(idx, ln, offs, first_size=int(first))
    return out.select("i", "doc_id", "line_no", F.col("ref_file").cast("long").alias("ref_file"),
                      F.col("ref_sample").cast("long").alias("ref_sample"))


# ---------------------------------------------------------------- A1, A2, A7
@register("count_blank_lines", O.with_(O.LINES, O.LINES_DIRTY) + """
select lang, source, count(*) n_lines, cast(count_if(line = '') as bigint) n_blank from lines_dirty
group by lang, source""")
def q_count_blank_lines(spark, sf):
    return stats.count_blank_lines(T.lines_dirty(spark, sf), ["lang", "source"])


@register("corpus_summary", O.with_(O.LINES) + """, pf as (
  select lang, doc_id, count(*) n from lines group by lang, doc_id)
select lang, count(*) n_files, cast(sum(n) as bigint) n_examples, cast(ceil(sum(n) / 32) as bigint) n_batches,
       cast(arg_min(n, doc_id) * (count(*) - 1) + arg_max(n, doc_id) as bigint) ref_examples
from pf group by lang""")
def q_corpus_summary(spark, sf):
    return stats.corpus_summary(T.lines(spark, sf), 32, by=["lang"])


@register("plan_steps", O.with_(O.LINES) + """
select lang, count(*) n_examples, cast(ceil(count(*) / 32) as bigint) steps_per_epoch,
       cast(50 * ceil(count(*) / 32) + 500 as bigint) total_steps
from lines group by lang""")
def q_plan_steps(spark, sf):
    return stats.plan_steps(T.lines(spark, sf), 32, 50, 500, by=["lang"])


# ---------------------------------------------------------------- A8, W1
LCA_PRODUCT = "(theta_after - theta_before) * grad"


def _nine(col):
    """A double to nine significant digits: sums of doubles depend on their
    order beyond that. The SQL twin is ``nine_sql``."""
    return F.format_string("%.8e", F.col(col)).cast("double").alias(col.strip("`"))


def nine_sql(expr: str) -> str:
    return f"cast(printf('%.8e', {expr}) as double)"



@register("lca_step", O.with_(O.TRACE) + f"""
select step, param, {nine_sql(f'sum({LCA_PRODUCT})')} lca_sum,
       {nine_sql(f'sum({LCA_PRODUCT}) / count(*)')} lca_mean
from param_trace where step % 5 = 0 group by step, param""")
def q_lca_step(spark, sf):
    from ..operators.traces import lca_step
    return lca_step(T.param_trace(spark, sf), 5).select("step", "param", _nine("lca_sum"), _nine("lca_mean"))


@register("lca_interval", O.with_(O.TRACE) + f""",
s as (select step, param, sum({LCA_PRODUCT}) s, count(*) n from param_trace group by step, param),
c as (select *, sum(s) over (partition by param order by step
      rows between unbounded preceding and current row) cum from s)
select step, param, {nine_sql('cum / 5.0')} interval_sum, {nine_sql('cum / 5.0 / n')} interval_mean
from c where step % 5 = 0""")
def q_lca_interval(spark, sf):
    from ..operators.traces import lca_interval
    return lca_interval(T.param_trace(spark, sf), 5).select(
        "step", "param", _nine("interval_sum"), _nine("interval_mean"))


# ---------------------------------------------------------------- O1–O4, W2
@register("aligned_shuffle", O.with_(O.BITEXT) + f"""
select pair, doc_no, line_no, src, tgt,
  row_number() over (order by {_h(42, 'pair', 'doc_no', 'line_no')}, pair, doc_no, line_no) shuf_rank
from bitext""")
def q_aligned_shuffle(spark, sf):
    from ..operators.order import aligned_shuffle
    b = _bitext(spark, sf).select("pair", "doc_no", "line_no", "src", "tgt")
    return aligned_shuffle(b, BITEXT_KEYS, seed=42)


@register("epoch_order", O.with_(O.LINES) + f"""
select e.epoch, doc_id, line_no, row_number() over (partition by e.epoch
  order by {_h(42, 'e.epoch', 'doc_id', 'line_no')}, doc_id, line_no) epoch_rank
from lines, (select unnest([0, 1]) epoch) e""")
def q_epoch_order(spark, sf):
    from ..operators.order import epoch_order
    ln = T.lines(spark, sf).select("doc_id", "line_no")
    return epoch_order(ln, ["doc_id", "line_no"], seed=42, epoch=[0, 1]).select(
        "epoch", "doc_id", "line_no", "epoch_rank")


@register("batch_slots", O.with_(O.LINES) + f""", r as (
  select doc_id, line_no, row_number() over (
    order by {_h(42, '0', 'doc_id', 'line_no')}, doc_id, line_no) epoch_rank from lines)
select doc_id, line_no, epoch_rank, cast(floor((epoch_rank - 1) / 32) as bigint) batch_id,
       cast((epoch_rank - 1) % 32 as integer) slot from r""")
def q_batch_slots(spark, sf):
    from ..operators.order import batch_slots, epoch_order
    ln = T.lines(spark, sf).select("doc_id", "line_no")
    r = epoch_order(ln, ["doc_id", "line_no"], seed=42, epoch=0)
    return batch_slots(r, 32).select("doc_id", "line_no", "epoch_rank", "batch_id", "slot")


@register("sort_shards", O.with_(O.LINES, OFFSETS_SQL) + """
select doc_id, line_no, start + line_no sample_idx from lines join o using (doc_id)""")
def q_sort_shards(spark, sf):
    from ..operators.order import sort_shards
    return sort_shards(T.lines(spark, sf).select("doc_id", "line_no")).select(
        "doc_id", "line_no", "sample_idx")


FILE_PATH_SQL = "concat('corpus/', lang, '/', source, '/doc', doc_id, '.txt')"


@register("preview", f"""
with f as (select {FILE_PATH_SQL} path, n_chars from documents)
select path, n_chars from f order by path
limit case when (select count(*) from f) > 5 then 3 else (select count(*) from f) end""")
def q_preview(spark, sf):
    from ..operators.order import preview
    f = T.documents(spark, sf).select(F.expr(FILE_PATH_SQL).alias("path"), "n_chars")
    return preview(f, 3, 5)


# ---------------------------------------------------------------- U1–U3, Q1, Q2
@register("concat_corpora", O.with_(O.BITEXT) + """,
s as (select pair, doc_no, line_no, 'src' side, 'en' lang, src line from bitext
      union all
      select pair, doc_no, line_no, 'tgt', substr(pair, 4, 8), tgt from bitext)
select 'pair' grouping, pair corpus, * from s
union all select 'multilingual', 'multiling', * from s
union all select 'language', lang, * from s where side = 'tgt' or pair = 'en-de'""")
def q_concat_corpora(spark, sf):
    from ..operators.splits import concat_groupings
    return concat_groupings(_bitext(spark, sf)).select(
        "grouping", "corpus", "pair", "doc_no", "line_no", "side", "lang", "line")


@register("append_to_split", O.with_(O.BITEXT) + f""",
u as (select pair, doc_no, line_no, 'europarl' origin, 'train' split from bitext
      where source not in ('src0', 'src1')
      union all
      select pair, doc_no, line_no, 'news', 'train' from bitext where source = 'src1')
select *, row_number() over (partition by pair, split
  order by {_h(42, 'pair', 'doc_no', 'line_no')}, pair, doc_no, line_no) shuf_rank from u""")
def q_append_to_split(spark, sf):
    from ..operators.splits import append_and_shuffle
    b = _bitext(spark, sf).select(*BITEXT_KEYS, "source")
    base = b.filter(~F.col("source").isin("src0", "src1")).select(
        *BITEXT_KEYS, F.lit("europarl").alias("origin"), F.lit("train").alias("split"))
    extra = b.filter(F.col("source") == "src1").select(*BITEXT_KEYS, F.lit("news").alias("origin"))
    return append_and_shuffle(base, extra, BITEXT_KEYS, seed=42)


@register("concat_ordered", O.with_(O.BITEXT) + """,
p as (select *, case pair when 'en-de' then 1 when 'en-es' then 2 when 'en-fr' then 3 end part_no
      from bitext)
select pair, doc_no, line_no, part_no,
       row_number() over (order by part_no, doc_no, line_no) line_no_all
from p where part_no is not null""")
def q_concat_ordered(spark, sf):
    from ..operators.splits import concat_ordered
    b = _bitext(spark, sf).select(*BITEXT_KEYS)
    return concat_ordered(b, ["en-de", "en-es", "en-fr"]).select(
        "pair", "doc_no", "line_no", "part_no", "line_no_all")


def _split_quota_sql(dev, test):
    return O.with_(O.BITEXT) + f""",
q as (select *, coalesce({QUALITY_SQL}, false) ok, {_h(42, 'pair', 'doc_no', 'line_no')} h
      from bitext),
r as (select *, row_number() over (partition by pair, ok order by h, pair, doc_no, line_no) rn
      from q),
sq as (select pair, doc_no, line_no, source,
  case when not ok then 'train' when rn <= {dev} then 'dev' when rn <= {dev + test} then 'test'
       else 'train' end split from r)
"""


SPLIT_QUOTA_SQL = _split_quota_sql(200, 200)


def _split_quota(spark, sf, dev=200, test=200):
    from ..operators.splits import split_quota
    b = _bitext(spark, sf).select(*BITEXT_KEYS, "source", "src", "tgt")
    return split_quota(b, BITEXT_KEYS, dev=dev, test=test, quality=_quality(), seed=42).select(
        *BITEXT_KEYS, "source", "split")


@register("split_quota", SPLIT_QUOTA_SQL + "select * from sq")
def q_split_quota(spark, sf):
    return _split_quota(spark, sf)


@register("split_quota_full", _split_quota_sql(2500, 2500) + "select * from sq")
def q_split_quota_full(spark, sf):
    """Q1 with 2,500 lines of each held-out split."""
    return _split_quota(spark, sf, 2500, 2500)


@register("hold_out", SPLIT_QUOTA_SQL + """
select pair, doc_no, line_no, source,
       case when source = 'src0' then 'newstest2018' else split end split from sq""")
def q_hold_out(spark, sf):
    from ..operators.splits import hold_out
    return hold_out(_split_quota(spark, sf), F.col("source") == "src0", "newstest2018")


PREP_SQL = O.with_(O.BITEXT) + f""",
b as (select *, coalesce({QUALITY_SQL}, false) ok, {_h(42, 'pair', 'doc_no', 'line_no')} h from bitext),
r as (select *, row_number() over (partition by pair, ok order by h, pair, doc_no, line_no) rn
      from b where source not in ('src0', 'src1')),
g as (select pair, doc_no, line_no, src, tgt, h, case when ok and rn <= 200 then 'dev'
        when ok and rn <= 400 then 'test' else 'train' end split from r
      union all select pair, doc_no, line_no, src, tgt, h, 'train' from b where source = 'src1'
      union all select pair, doc_no, line_no, src, tgt, h, 'newstest2018' from b where source = 'src0'),
prep as (select pair, doc_no, line_no, src, tgt, split, row_number() over (
  partition by pair, split order by h, pair, doc_no, line_no) shuf_rank from g)
"""


def _prep(spark, sf):
    """Quota split of the corpus, news added: one source held out as its own
    split, another appended to train, everything reshuffled."""
    from .prep import add_news_dev, split_parallel
    b = _bitext(spark, sf)
    base = split_parallel(b.filter(~F.col("source").isin("src0", "src1")), 200, 200, _quality(), 42)
    news = b.filter(F.col("source").isin("src0", "src1"))
    return add_news_dev(base, news, F.col("source") == "src0", "newstest2018", 42).select(
        *BITEXT_KEYS, "src", "tgt", "split", "shuf_rank")


@register("prep_splits", PREP_SQL + "select * from prep")
def q_prep_splits(spark, sf):
    return _prep(spark, sf)


MULTI_DEV_SQL = PREP_SQL + """,
p as (select *, case pair when 'en-de' then 1 when 'en-es' then 2 else 3 end part_no from prep
      where split = 'dev')
select pair, doc_no, line_no, {tag} src_sp, tgt tgt_sp, part_no,
       row_number() over (order by part_no, doc_no, line_no) line_no_all from p"""


def _multi_dev(spark, sf, tag_first):
    from .prep import multilingual_dev
    dev = _prep(spark, sf).filter("split = 'dev'").select(
        *BITEXT_KEYS, F.col("src").alias("src_sp"), F.col("tgt").alias("tgt_sp"))
    return multilingual_dev(dev, ["en-de", "en-es", "en-fr"], tag_first).select(
        *BITEXT_KEYS, "src_sp", "tgt_sp", "part_no", "line_no_all")


@register("multilingual_dev", MULTI_DEV_SQL.replace("{tag}", "concat('<2', substr(pair, 4, 8), '> ', src)"))
def q_multilingual_dev(spark, sf):
    return _multi_dev(spark, sf, True)


@register("multilingual_dev_untagged", MULTI_DEV_SQL.replace("{tag}", "src"))
def q_multilingual_dev_untagged(spark, sf):
    """The reference's order of steps, which leaves the concatenation untagged."""
    return _multi_dev(spark, sf, False)


@register("leaked_rows", SPLIT_QUOTA_SQL + """
select t.pair, t.doc_no, t.line_no from sq t
where t.split = 'train' and exists (select 1 from sq h where h.split <> 'train'
  and h.doc_no = t.doc_no and h.line_no = t.line_no)""")
def q_leaked_rows(spark, sf):
    """Q2's check across pairs: train rows whose English line is held out for
    another pair (within a pair there are none, by construction)."""
    from ..operators.splits import leaked_rows
    s = _split_quota(spark, sf)
    out = leaked_rows(s.filter("split = 'train'"), s.filter("split <> 'train'"), ["doc_no", "line_no"])
    return out.select(*BITEXT_KEYS)


@register("zip_parallel_strict", O.with_(O.BITEXT) + "select pair, doc_no, line_no, src, tgt from bitext")
def q_zip_parallel_strict(spark, sf):
    """J1 with its length check, on two sides that are aligned."""
    from ..operators.joins import zip_parallel
    b = _bitext(spark, sf)
    return zip_parallel(b.select(*BITEXT_KEYS, "src"), b.select(*BITEXT_KEYS, "tgt"), BITEXT_KEYS, strict=True)


@register("zip_corpus_tree", O.with_(O.BITEXT) + """
select pair, doc_no, line_no, src, tgt from bitext where doc_no % 3 = 0""")
def q_zip_corpus_tree(spark, sf):
    """J1 on two sides stored as bucketed tables: the dev split is paired, with
    its length check, without an exchange."""
    import uuid

    from ..operators.joins import zip_parallel
    from ..session import scratch_path, stored
    from ..sources.tree import drop_sides, read_side, write_side
    b = _bitext(spark, sf).withColumn("split", F.when(F.col("doc_no") % 3 == 0, "dev").otherwise("train"))
    tables = {side: f"tree_{side}_{uuid.uuid4().hex[:12]}" for side in ("src", "tgt")}
    for side, table in tables.items():
        write_side(b.select("split", *BITEXT_KEYS, side), table, scratch_path(spark, "tree"), BITEXT_KEYS, buckets=8)
    out = stored(zip_parallel(*[read_side(spark, t, "dev") for t in tables.values()], BITEXT_KEYS), "zipped")
    drop_sides(spark, *tables.values())
    return out.select(*BITEXT_KEYS, "src", "tgt")


# ---------------------------------------------------------------- F4–F10 (toy ids)
@register("join_pieces", O.with_(O.LINES) + f"""
select doc_id, line_no, array_to_string({O.pretokens_expr('line')}, ' ') joined from lines""")
def q_join_pieces(spark, sf):
    from ..functions.text import join_pieces, pretokenize
    return T.lines(spark, sf).select("doc_id", "line_no",
                                     join_pieces(pretokenize("line")).alias("joined"))


TOY_LEN = 16
TOY_FRAMES = O.with_(O.LINES, O.TOY_IDS) + f""",
fr as (select doc_id, line_no, list_concat([0], list_slice(ids, 1, {TOY_LEN - 2}), [2]) f
       from toy_arrays),
pd as (select doc_id, line_no, f, list_resize(f, {TOY_LEN}, 1) labels,
              list_transform(range({TOY_LEN}), lambda k: case when k < len(f) then 1 else 0 end) am
       from fr),
mk as (select *, list_transform(labels, lambda x, i: case when x not in (0, 1, 2) and
         substr(md5(concat('42:0:', doc_id, ':', line_no, ':', i - 1)), 1, 8) < '26666666'
         then 4 else x end) input_ids from pd)
"""


def _toy_examples(spark, sf):
    from ..operators.mlm import mlm_examples
    return mlm_examples(T.toy_id_arrays(T.lines(spark, sf)), "ids", ["doc_id", "line_no"],
                        max_length=TOY_LEN, epoch=0, seed=42, p=0.15)


def _s(c):
    return F.array_join(F.col(c).cast("array<string>"), " ")


@register("frame_truncate", TOY_FRAMES + "select doc_id, line_no, array_to_string(f, ' ') framed from fr")
def q_frame_truncate(spark, sf):
    from ..functions.arrays import frame_truncate
    a = T.toy_id_arrays(T.lines(spark, sf))
    return a.select("doc_id", "line_no", frame_truncate("ids", TOY_LEN).alias("f")).select(
        "doc_id", "line_no", _s("f").alias("framed"))


@register("pad_to", TOY_FRAMES + "select doc_id, line_no, array_to_string(labels, ' ') padded from pd")
def q_pad_to(spark, sf):
    return _toy_examples(spark, sf).select("doc_id", "line_no", _s("labels").alias("padded"))


@register("attention_mask", TOY_FRAMES +
          "select doc_id, line_no, array_to_string(am, ' ') attention_mask from pd")
def q_attention_mask(spark, sf):
    return _toy_examples(spark, sf).select("doc_id", "line_no",
                                           _s("attention_mask").alias("attention_mask"))


@register("mlm_mask", O.with_(O.LINES, O.TOY_IDS) + """
select doc_id, line_no, pos, cast(case when id not in (0, 1, 2) and
  substr(md5(concat('42:0:', doc_id, ':', line_no, ':', pos)), 1, 8) < '26666666'
  then 4 else id end as integer) id
from toy_ids""")
def q_mlm_mask(spark, sf):
    from ..functions.arrays import mlm_mask
    a = T.toy_id_arrays(T.lines(spark, sf))
    m = a.select("doc_id", "line_no", mlm_mask(F.col("ids"), ["doc_id", "line_no"], 0, 42, 0.15)
                 .alias("m"))
    return m.select("doc_id", "line_no", F.posexplode("m").alias("pos", "id")).withColumn(
        "pos", F.col("pos").cast("long"))


@register("mlm_examples_toy", TOY_FRAMES + """
select doc_id, line_no, array_to_string(input_ids, ' ') input_ids,
       array_to_string(am, ' ') attention_mask, array_to_string(labels, ' ') labels from mk""")
def q_mlm_examples_toy(spark, sf):
    from ..operators.mlm import as_text
    return as_text(_toy_examples(spark, sf))


@register("lr_schedule", O.with_(O.LINES) + """,
t as (select cast(2 * ceil(count(*) / 32) + 500 as bigint) total from lines)
select s.range step,
  case when s.range < 50 then cast(0.002 as double) * cast(s.range as double) / greatest(1.0, 50.0)
       else cast(0.002 as double) * greatest(0.0, (cast(total as double) - cast(s.range as double))
            / greatest(1.0, cast(total as double) - 50.0)) end lr
from t, range(total) s""")
def q_lr_schedule(spark, sf):
    from ..operators.mlm import lr_schedule
    total = stats.plan_steps(T.lines(spark, sf), 32, 2, 500).first()["total_steps"]
    return lr_schedule(spark, total, base=0.002, warmup=50)


# ---------------------------------------------------------------- A4, A6, F2, F10 (BPE)
BPE_VOCAB = 300
# The sizes of a production run.
FULL_VOCAB, FULL_LEN = 32_000, 512


def bpe_model(spark, sf, vocab_size=BPE_VOCAB):
    """Byte-level BPE learnt on all lines of ``sf`` with their line breaks, as
    a trainer reading corpus files sees them."""
    from ..operators.bpe import bpe_train
    hist = stats.pretoken_histogram(T.lines(spark, sf), line_end="\n")
    return bpe_train(hist, vocab_size=vocab_size, min_frequency=2)


BYTE_IDS_SQL = """bmap as (
  select printf('%02X', b) hx, cast(row_number() over (order by case when (b between 33 and 126)
         or (b between 161 and 172) or (b between 174 and 255) then b else 256 + b end) + 4
         as integer) id
  from range(256) r(b))"""


@register("bpe_pair_counts", O.with_(O.LINES, BYTE_IDS_SQL) + f""",
hist as (select t w, count(*) n from (select unnest({O.pretokens_expr('line')}) t from lines) z
         group by t),
wb as (select n, hex(encode(w)) h from hist),
pr as (select n, substr(h, 2 * k + 1, 2) x, substr(h, 2 * k + 3, 2) y
       from wb, unnest(range(0, cast(length(h) / 2 as bigint) - 1)) u(k))
select a.id left_id, b.id right_id, cast(sum(n) as bigint) n
from pr join bmap a on a.hx = pr.x join bmap b on b.hx = pr.y group by a.id, b.id""")
def q_bpe_pair_counts(spark, sf):
    from ..operators.bpe import pair_counts, words_table
    return pair_counts(words_table(stats.pretoken_histogram(T.lines(spark, sf))))


# Merges that BPE_VOCAB leaves room for: specials and bytes take 261 ids.
BPE_MERGES = BPE_VOCAB - 261
BPE_SQL = O.with_recursive(O.LINES, O.BYTES, O.bpe(BPE_MERGES))


@register("bpe_train", BPE_SQL + """
select rank, voc[l + 1] "left", voc[r + 1] "right", l left_id, r right_id, cast(261 + rank as integer) new_id
from merged, voc""")
def q_bpe_train(spark, sf):
    return bpe_model(spark, sf).merges_df(spark)


@register("vocab_size", O.with_recursive(O.LINES, O.BYTES, O.bpe_whole(FULL_VOCAB)) + """
select count(*) vocab_size, count(*) filter (where n < 5) n_special,
       count(*) filter (where n between 5 and 260) n_alphabet, count(*) filter (where n > 260) n_merge
from learn where kind = 2""")
def q_vocab_size(spark, sf):
    """A6 of a vocabulary of 32,000 pieces (fewer where the corpus has no more pairs)."""
    return stats.vocab_size(bpe_model(spark, sf, FULL_VOCAB).vocab_df(spark))


@register("bpe_encode", O.with_recursive(O.LINES, O.BYTES, O.bpe(BPE_MERGES), O.bpe_ids(BPE_MERGES)) + """
select doc_id, line_no, array_to_string(ids, ' ') ids from enc""")
def q_bpe_encode(spark, sf):
    from ..operators.bpe import bpe_encode
    ln = T.lines(spark, sf).select("doc_id", "line_no", "line")
    out = bpe_encode(ln, "line", bpe_model(spark, sf))
    return out.select("doc_id", "line_no", F.array_join(F.col("ids").cast("array<string>"), " ")
                      .alias("ids"))


@register("bpe_by_language", O.with_recursive(O.LINES, O.BYTES, O.bpe_each(BPE_MERGES, "lang")) + """
select g lang, rank, l left_id, r right_id, cast(261 + rank as integer) new_id from merged""")
def q_bpe_by_language(spark, sf):
    """A4 over U1's grouping by language: all vocabularies in one job."""
    from ..operators.bpe import bpe_train_each
    hist = stats.pretoken_histogram(T.lines(spark, sf), line_end="\n", by=["lang"])
    rows = [(g, r, a, b, n) for g, m in bpe_train_each(hist, "lang", vocab_size=BPE_VOCAB).items()
            for r, (a, b, n) in enumerate(m.merges)]
    return spark.createDataFrame(rows, "lang string, rank int, left_id int, right_id int, new_id int")


@register("bpe_train_full")
def q_bpe_train_full(spark, sf):
    """A4 up to 32,000 pieces (fewer where the corpus has no more pairs)."""
    return bpe_model(spark, sf, FULL_VOCAB).merges_df(spark)


@register("mlm_examples_full")
def q_mlm_examples_full(spark, sf):
    """F10 with a vocabulary of 32,000 pieces and examples of 512 ids."""
    from ..operators.bpe import bpe_encode
    from ..operators.mlm import mlm_examples
    ln = T.lines(spark, sf).select("doc_id", "line_no", "line")
    enc = bpe_encode(ln, "line", bpe_model(spark, sf, FULL_VOCAB))
    return mlm_examples(enc, "ids", ["doc_id", "line_no"], max_length=FULL_LEN, epoch=0, seed=42, p=0.15)


MLM_LEN = 64


def _mlm_sql(length):
    """Examples of ``length`` ids from ``enc``, as text."""
    return f""",
fr as (select doc_id, line_no, list_concat([0], list_slice(ids, 1, {length - 2}), [2]) f from enc),
pd as (select doc_id, line_no, list_resize(f, {length}, 1) labels,
              list_transform(range({length}), lambda k: case when k < len(f) then 1 else 0 end) am from fr),
mk as (select *, list_transform(labels, lambda x, i: case when x not in (0, 1, 2) and
         substr(md5(concat('42:0:', doc_id, ':', line_no, ':', i - 1)), 1, 8) < '26666666'
         then 4 else x end) input_ids from pd)
select doc_id, line_no, array_to_string(input_ids, ' ') input_ids, array_to_string(am, ' ') attention_mask,
       array_to_string(labels, ' ') labels from mk"""


@register("mlm_examples", O.with_recursive(O.LINES, O.BYTES, O.bpe(BPE_MERGES), O.bpe_ids(BPE_MERGES)) +
          _mlm_sql(MLM_LEN))
def q_mlm_examples(spark, sf):
    from ..operators.bpe import bpe_encode
    from ..operators.mlm import as_text, mlm_examples
    ln = T.lines(spark, sf).select("doc_id", "line_no", "line")
    enc = bpe_encode(ln, "line", bpe_model(spark, sf))
    return as_text(mlm_examples(enc, "ids", ["doc_id", "line_no"], max_length=MLM_LEN,
                                epoch=0, seed=42, p=0.15))


@register("epoch_batches", O.with_recursive(O.LINES, O.BYTES, O.bpe(BPE_MERGES), O.bpe_ids(BPE_MERGES)) + f""",
fr as (select doc_id, line_no, list_resize(list_concat([0], list_slice(ids, 1, {MLM_LEN - 2}), [2]), {MLM_LEN}, 1) labels
       from enc),
ord as (select e.epoch, doc_id, line_no, row_number() over (partition by e.epoch
          order by {_h(42, 'e.epoch', 'doc_id', 'line_no')}, doc_id, line_no) - 1 r
        from lines, (select unnest([0, 1]) epoch) e)
select ord.epoch, cast(floor(r / 32) as bigint) batch_id, cast(r % 32 as integer) slot, doc_id, line_no,
       array_to_string(list_transform(labels, lambda x, i: case when x not in (0, 1, 2) and
         substr(md5(concat('42:', ord.epoch, ':', doc_id, ':', line_no, ':', i - 1)), 1, 8) < '26666666'
         then 4 else x end), ' ') input_ids
from ord join fr using (doc_id, line_no)""")
def q_epoch_batches(spark, sf):
    """Two epochs of batches: a new order and new masks in each."""
    from ..operators.mlm import as_text
    from .training import epoch_batches
    out = epoch_batches(T.lines(spark, sf), bpe_model(spark, sf), MLM_LEN, epochs=2, batch_size=32, seed=42, p=0.15)
    return as_text(out, ["input_ids"]).select("epoch", "batch_id", "slot", "doc_id", "line_no", "input_ids")


# ---------------------------------------------------------------- sources and sinks
@register("read_segments", O.with_(O.LINES) + """
select doc_id, cast(line_no + 1 as integer) seg_no,
       regexp_replace(replace(line, '<', ' '), '^[\\s\\x1c-\\x1f]+|[\\s\\x1c-\\x1f]+$', '', 'g') text
from lines""")
def q_read_segments(spark, sf):
    from ..functions.text import protect_amp, restore_amp
    from ..sources.archives import read_segments
    docs = T.segment_docs(spark, sf).select("doc_id", protect_amp("xml").alias("xml"))
    segs = read_segments(docs, "xml", "doc_id", on_empty="blank")
    return segs.select("doc_id", "seg_no", restore_amp("text").alias("text"))


@register("discover_corpus", f"""
with f as (select doc_id, {CORPUS_NAME_SQL} name, n_chars size from documents)
select doc_id, name,
  nullif(regexp_extract(name, '^(en-..)\\.([^.]+)\\.(..)(\\.sp)?$', 1), '') pair,
  nullif(regexp_extract(name, '^(en-..)\\.([^.]+)\\.(..)(\\.sp)?$', 2), '') split,
  nullif(regexp_extract(name, '^(en-..)\\.([^.]+)\\.(..)(\\.sp)?$', 3), '') lang,
  regexp_extract(name, '(\\.[^.]*)$', 1) suffix, size
from f where name glob 'en-??.*' and not name glob '*.ids'
  and regexp_extract(name, '(\\.[^.]*)$', 1) in ('.en', '.de', '.fr')""")
def q_discover_corpus(spark, sf):
    from ..functions.text import corpus_name_part
    from ..sources.lines import select_files
    files = T.documents(spark, sf).select("doc_id", F.expr(CORPUS_NAME_SQL).alias("name"),
                                          F.col("n_chars").alias("size"))
    sel = select_files(files, "en-??.*", ["*.ids"], [".en", ".de", ".fr"])
    return sel.select("doc_id", "name",
                      *[corpus_name_part("name", p).alias(p) for p in ("pair", "split", "lang")],
                      F.regexp_extract("name", r"(\.[^.]*)$", 1).alias("suffix"), "size")


@register("discover_corpus_files", f"""
with f as (select doc_id, {CORPUS_NAME_SQL} name, lang, octet_length(encode(coalesce(text, ''))) size from documents)
select doc_id, name,
  nullif(regexp_extract(name, '^(en-..)\\.([^.]+)\\.(..)(\\.sp)?$', 1), '') pair,
  nullif(regexp_extract(name, '^(en-..)\\.([^.]+)\\.(..)(\\.sp)?$', 2), '') split,
  nullif(regexp_extract(name, '^(en-..)\\.([^.]+)\\.(..)(\\.sp)?$', 3), '') lang,
  regexp_extract(name, '(\\.[^.]*)$', 1) suffix, size
from f where lang <> 'en' and regexp_extract(name, '(\\.[^.]*)$', 1) in ('.de', '.fr', '.sp')
  and not name glob '*.src1.*'""")
def q_discover_corpus_files(spark, sf):
    """S2 on files: every document is written as a file of a corpus tree, and
    the tree is listed with a glob over its folders."""
    from ..session import scratch_path
    from ..sources.lines import discover_corpus
    from ..sources.sinks import write_files
    root = scratch_path(spark, "tree")
    folder = F.when(F.col("lang") == "en", F.lit("mono")).otherwise(F.concat(F.lit("en-"), "lang"))
    docs = T.documents(spark, sf).select(
        F.concat_ws("/", F.concat(F.lit("doc"), "doc_id"), folder, F.expr(CORPUS_NAME_SQL)).alias("name"), "text")
    write_files(docs, root, "name", "text")
    found = discover_corpus(spark, root, "en-??/*", ["*.src1.*"], suffixes=[".de", ".fr", ".sp"])
    return found.select(F.regexp_extract("path", r"/doc(\d+)/", 1).cast("long").alias("doc_id"), "name", "pair",
                        "split", "lang", "suffix", "size")


FILES_SQL = """files as (
  select concat('lang=', lang, '/source=', source) file, lang, source, line,
         cast(row_number() over (partition by lang, source order by doc_id, line_no) - 1 as bigint) line_no
  from lines)"""


def _line_files(spark, sf):
    """The documents written as one line file per (language, source) and read
    back: ``(file, lang, source, line_no, line)``."""
    from ..session import scratch_path
    from ..sources.lines import read_lines
    from ..sources.sinks import write_lines
    path = scratch_path(spark, "lines")
    write_lines(T.lines(spark, sf), path, ["lang", "source"], ["doc_id", "line_no"])
    back = read_lines(spark, path, newline="lf", unit="dir", recursive=True)
    file = F.regexp_extract("unit", r"(lang=[^/]*/source=[^/]*)$", 1)
    return back.select(file.alias("file"), F.regexp_extract(file, "lang=([^/]*)", 1).alias("lang"),
                       F.regexp_extract(file, "source=([^/]*)", 1).alias("source"), "line_no", "line")


@register("write_lines", O.with_(O.LINES, FILES_SQL) + "select lang, source, line_no, line from files")
def q_write_lines(spark, sf):
    return _line_files(spark, sf).select("lang", "source", "line_no", "line")


SHARDS_SQL = """sizes as (select file, count(*) n from files group by file),
shards as (select file, cast(coalesce(sum(n) over (order by file rows between unbounded preceding
           and 1 preceding), 0) as bigint) start from sizes)"""


@register("sort_shard_files", O.with_(O.LINES, FILES_SQL, SHARDS_SQL) + """
select file, line_no, start + line_no sample_idx from files join shards using (file)""")
def q_sort_shard_files(spark, sf):
    """O3 over files: their paths, as text, give the sample order."""
    from ..operators.order import sort_shards
    return sort_shards(_line_files(spark, sf).select("file", "line_no"), "file").select(
        "file", "line_no", "sample_idx")


@register("sample_at_files", O.with_(O.LINES, FILES_SQL, SHARDS_SQL) + """
select start + line_no i, file, line_no, line from files join shards using (file)
where (start + line_no) % 7 = 0""")
def q_sample_at_files(spark, sf):
    """J4 over files: every seventh sample of the global order, with its text."""
    from ..operators.joins import line_offsets, sample_at
    files = _line_files(spark, sf)
    offs = line_offsets(files, "file")
    n = offs.agg(F.sum("n_lines")).first()[0] or 0
    idx = spark.range(0, int(n), 7).withColumnRenamed("id", "i")
    return sample_at(idx, files, offs, "file", columns=["line"]).select("i", "file", "line_no", "line")


@register("write_vocab", O.with_(O.LINES, FREQ_VOCAB_SQL) + """
select piece, cast(id - 5 as integer) id, cast(n as double) score from fvocab""")
def q_write_vocab(spark, sf):
    from ..session import scratch_path
    from ..sources.vocab import load_vocab, write_vocab
    v = _freq_vocab(spark, sf)
    path = scratch_path(spark, "unigram.vocab")
    write_vocab(v.select("piece", "id", F.col("n").cast("double").alias("score")), path, "unigram")
    return load_vocab(spark, path, "unigram")


@register("load_bpe_model", BPE_SQL + """
select rank, voc[l + 1] "left", voc[r + 1] "right", cast(l as integer) left_id, cast(r as integer) right_id,
       cast(261 + rank as integer) id
from merged, voc""")
def q_load_bpe_model(spark, sf):
    """K2 and S5 on a learnt model: vocabulary and merges files are written
    and read back, and every merge finds the ids of its parts and its result."""
    from ..session import scratch_path
    from ..sources.vocab import load_vocab, write_vocab
    model, path = bpe_model(spark, sf), scratch_path(spark, "bpe-model")
    write_vocab(model.vocab_df(spark), path, "bpe", model.merges_df(spark))
    vocab, merges = load_vocab(spark, path, "bpe")

    def ids(col, out):
        return vocab.select(F.col("piece").alias(col), F.col("id").alias(out))
    out = merges.join(ids("left", "left_id"), "left").join(ids("right", "right_id"), "right")
    out = out.withColumn("both", F.concat("left", "right")).join(ids("both", "id"), "both")
    return out.select("rank", "left", "right", "left_id", "right_id", "id")


@register("load_vocab", O.with_(O.LINES, FREQ_VOCAB_SQL) + "select piece, id from fvocab")
def q_load_vocab(spark, sf):
    from ..session import scratch_path
    from ..sources.vocab import load_bpe_vocab, write_bpe
    path = scratch_path(spark, "bpe")
    empty = spark.createDataFrame([], "rank int, left string, right string")
    write_bpe(_freq_vocab(spark, sf).select("piece", "id"), empty, path)
    return load_bpe_vocab(spark, f"{path}/vocab.json")


@register("build_or_reuse", O.with_(O.LINES, FREQ_VOCAB_SQL) + "select piece, id from fvocab")
def q_build_or_reuse(spark, sf):
    from ..session import scratch_path
    from ..sources.vocab import build_or_reuse
    path = scratch_path(spark, "vocab.parquet")
    build_or_reuse(spark, path, lambda: _freq_vocab(spark, sf).select("piece", "id"))
    return build_or_reuse(spark, path, lambda: (_ for _ in ()).throw(RuntimeError("rebuilt")))


@register("write_lca_log", O.with_(O.TRACE) + f""",
s as (select step, param, sum({LCA_PRODUCT}) s, count(*) n from param_trace group by step, param),
c as (select *, sum(s) over (partition by param order by step
      rows between unbounded preceding and current row) cum from s)
select step, param, {nine_sql('s')} lca_sum, {nine_sql('s / n')} lca_mean,
       {nine_sql('cum / 5.0')} interval_sum, {nine_sql('cum / 5.0 / n')} interval_mean
from c where step % 5 = 0""")
def q_write_lca_log(spark, sf):
    from ..operators.traces import lca_log
    from ..session import scratch_path
    from ..sources.sinks import write_lca_log
    path = scratch_path(spark, "lca_log")
    write_lca_log(lca_log(T.param_trace(spark, sf), 5), path)
    back = spark.read.schema("param string, step long, sum double, mean double, "
                             "`interval.sum` double, `interval.mean` double").json(path)
    back = back.toDF("param", "step", "lca_sum", "lca_mean", "interval_sum", "interval_mean")
    return back.select("step", "param", *[_nine(c) for c in back.columns[2:]])


@register("append_metrics", O.with_(O.LINES) + """,
t as (select cast(2 * ceil(count(*) / 32) + 500 as bigint) total from lines)
select s.range step, 'learning rate' tag,
  case when s.range < 50 then cast(0.002 as double) * cast(s.range as double) / greatest(1.0, 50.0)
       else cast(0.002 as double) * greatest(0.0, (cast(total as double) - cast(s.range as double))
            / greatest(1.0, cast(total as double) - 50.0)) end value
from t, range(total) s""")
def q_append_metrics(spark, sf):
    from ..session import scratch_path
    from ..sources.sinks import append_metrics
    path = scratch_path(spark, "metrics")
    lr = q_lr_schedule(spark, sf)
    half = lr.agg(F.max("step")).first()[0] // 2
    m = lr.select("step", F.lit("learning rate").alias("tag"), F.col("lr").alias("value"))
    append_metrics(m.filter(F.col("step") <= half), path)   # two appends, as steps go by
    append_metrics(m.filter(F.col("step") > half), path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- A5, F3 (unigram)
UNIGRAM_VOCAB = 500
MAX_PIECE = 16


def unigram_model(spark, sf, vocab_size=UNIGRAM_VOCAB):
    from ..operators.unigram import unigram_train
    return unigram_train(T.lines(spark, sf), vocab_size=vocab_size)


UNIGRAM_WORDS_SQL = """uwords as (
  select concat('▁', t) word, count(*) n
  from (select unnest(regexp_split_to_array(line, '[ \\t\\n\\r\\f]+')) t from lines) z where t <> '' group by t)"""


@register("unigram_word_counts", O.with_(O.LINES, UNIGRAM_WORDS_SQL) + "select word, n from uwords")
def q_unigram_word_counts(spark, sf):
    """The word table that A5 learns from (the given texts hold no character
    that normalisation changes, so SQL needs none)."""
    from ..operators.unigram import word_histogram
    return word_histogram(T.lines(spark, sf))


@register("unigram_seed_counts", O.with_(O.LINES, UNIGRAM_WORDS_SQL) + f"""
select piece, cast(sum(n) as bigint) freq from (
  select substr(word, i, k) piece, n from (
    select word, n, i, unnest(range(1, least({MAX_PIECE}, length(word) - i + 1) + 1)) k from (
      select word, n, unnest(range(1, length(word) + 1)) i from uwords) a) b) c
group by piece having sum(n) > 1 or length(piece) = 1""")
def q_unigram_seed_counts(spark, sf):
    """A5's candidates with their counts."""
    from ..operators.unigram import seed_pieces, word_histogram
    return seed_pieces(word_histogram(T.lines(spark, sf)), MAX_PIECE).select(
        "piece", F.col("freq").cast("long").alias("freq"))


@register("unigram_train")
def q_unigram_train(spark, sf):
    return unigram_model(spark, sf).vocab_df(spark)


@register("unigram_train_full")
def q_unigram_train_full(spark, sf):
    """A5 with 32,000 pieces (fewer where the corpus cannot give so many)."""
    from ..operators.unigram import unigram_train
    return unigram_train(T.lines(spark, sf), FULL_VOCAB, hard_vocab_limit=False).vocab_df(spark)


@register("vocabularies_by_language")
def q_vocabularies_by_language(spark, sf):
    """A5 over U1's grouping by language: all vocabularies in one job."""
    from ..operators.unigram import unigram_train_each
    models = unigram_train_each(T.lines(spark, sf), "lang", UNIGRAM_VOCAB, hard_vocab_limit=False)
    out = None
    for lang, m in sorted(models.items()):
        part = m.vocab_df(spark).select(F.lit(lang).alias("lang"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@register("unigram_encode_trained")
def q_unigram_encode_trained(spark, sf):
    """F3 with the vocabulary that A5 learns on the same lines."""
    from ..functions.text import join_pieces
    from ..operators.unigram import unigram_encode
    ln = T.lines(spark, sf).select("doc_id", "line_no", "line")
    out = unigram_encode(ln, "line", unigram_model(spark, sf).vocab_df(spark))
    return out.select("doc_id", "line_no", join_pieces("pieces").alias("pieces"))


@register("encode_monolingual")
def q_encode_monolingual(spark, sf):
    """Every language's lines with their own language's vocabulary, all of
    them learnt in one job."""
    from ..operators.unigram import unigram_train_each
    from .prep import encode_monolingual
    ln = T.lines(spark, sf)
    models = unigram_train_each(ln, "lang", UNIGRAM_VOCAB, hard_vocab_limit=False)
    return encode_monolingual(ln, models).select("lang", "doc_id", "line_no", "line_sp")


FREQUENCY_PIECES = 2000

FREQUENCY_PIECES_SQL = UNIGRAM_WORDS_SQL + f""",
useeds as (
  select piece, sum(n) freq from (
    select substr(word, i, k) piece, n from (
      select word, n, i, unnest(range(1, least({MAX_PIECE}, length(word) - i + 1) + 1)) k from (
        select word, n, unnest(range(1, length(word) + 1)) i from uwords) a) b) c group by piece),
uvoc as (
  select piece, freq from useeds where length(piece) = 1
  union all
  select piece, freq from (select piece, freq from useeds where length(piece) > 1 and freq > 1
                           order by freq * length(piece) desc, piece limit {FREQUENCY_PIECES}) z),
uscore as (select piece, round(ln(freq / (select sum(freq) from uvoc)), 6) s from uvoc),
best(word, i, best, back) as (
  select word, cast(0 as bigint), [cast(0 as double)], [cast(0 as bigint)] from uwords
  union all
  select word, i + 1, list_append(best, max(v)), list_append(back, list(j order by v desc, j)[1]) from (
    select w.word word, w.i i, w.best best, w.back back, w.j j, w.best[w.j + 1] + us.s v
    from (select word, i, best, back, unnest(range(greatest(0, i - {MAX_PIECE - 1}), i + 1)) j from best
          where i < length(word)) w
    join uscore us on us.piece = substr(w.word, w.j + 1, w.i + 1 - w.j)) z
  group by word, i, best, back),
cut(word, k, back, pieces) as (
  select word, i, back, cast([] as varchar[]) from best where i = length(word)
  union all
  select word, back[k + 1], back, list_prepend(substr(word, back[k + 1] + 1, k - back[k + 1]), pieces)
  from cut where k > 0),
upieces as (select word, pieces from cut where k = 0)"""


def _frequency_pieces(spark, sf):
    """A piece table that SQL can make: all characters, and the substrings
    that cover most of the corpus, scored by their log shares."""
    from ..operators.unigram import seed_pieces, word_histogram
    seeds = seed_pieces(word_histogram(T.lines(spark, sf)), MAX_PIECE)
    one = F.length("piece") == 1
    top = seeds.filter(~one).orderBy(F.desc(F.col("freq") * F.length("piece")), "piece").limit(FREQUENCY_PIECES)
    both = seeds.filter(one).unionByName(top)
    total = both.agg(F.sum("freq")).first()[0]
    return both.select("piece", F.round(F.log(F.col("freq") / F.lit(total)), 6).alias("score"))


@register("unigram_encode", O.with_recursive(O.LINES, FREQUENCY_PIECES_SQL) + """,
toks as (select doc_id, line_no, u.i i, u.t t
         from lines, unnest(regexp_split_to_array(line, '[ \\t\\n\\r\\f]+')) with ordinality u(t, i) where u.t <> ''),
coded as (select doc_id, line_no, array_to_string(flatten(list(p.pieces order by i)), ' ') pieces
          from toks join upieces p on p.word = concat('▁', t) group by doc_id, line_no)
select l.doc_id, l.line_no, coalesce(c.pieces, '') pieces
from lines l left join coded c on c.doc_id = l.doc_id and c.line_no = l.line_no""")
def q_unigram_encode(spark, sf):
    from ..functions.text import join_pieces
    from ..operators.unigram import unigram_encode
    ln = T.lines(spark, sf).select("doc_id", "line_no", "line")
    out = unigram_encode(ln, "line", _frequency_pieces(spark, sf))
    return out.select("doc_id", "line_no", join_pieces("pieces").alias("pieces"))


# ---------------------------------------------------------------- streaming (P5 on a stream)
@register("stream_tag_language", O.with_(O.BITEXT) + """
select pair, doc_no, line_no, concat('<2', substr(pair, 4, 8), '> ', src) src_tagged, tgt
from bitext""")
def q_stream_tag_language(spark, sf):
    """P5 as a Structured Streaming query: the bitext lands as Parquet files,
    a file stream tags it and a Parquet sink (with checkpoint) collects it."""
    from ..operators.clean import tag_language
    from ..session import scratch_path
    from ..streaming.live import read_table_stream, write_parquet_stream
    src_path, out_path = scratch_path(spark, "bitext-in"), scratch_path(spark, "bitext-tagged")
    b = _bitext(spark, sf).select("pair", "doc_no", "line_no", "src", "tgt")
    b.write.mode("overwrite").parquet(src_path)
    stream = read_table_stream(spark, src_path, "pair string, doc_no long, line_no long, "
                                                "src string, tgt string")
    tagged = tag_language(stream).select("pair", "doc_no", "line_no", "src_tagged", "tgt")
    q = write_parquet_stream(tagged, out_path)
    q.awaitTermination()
    return spark.read.parquet(out_path)


def _in_two_runs(spark, src, out, schema, stream):
    """Half of the rows arrive, a stream takes them and stops; the other half
    arrives, and a stream started anew from the same checkpoint goes on."""
    from ..session import scratch_path
    from ..streaming.live import read_table_stream, write_parquet_stream
    place, checkpoint = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-checkpoint")
    for half in (0, 1):
        src.filter(F.pmod(F.col("doc_id"), F.lit(2)) == half).write.mode("append").parquet(place)
        q = write_parquet_stream(stream(read_table_stream(spark, place, schema)), out, checkpoint)
        q.awaitTermination()
    return spark.read.parquet(out)


@register("stream_mlm_examples",
          O.with_recursive(O.LINES, O.BYTES, O.bpe_whole(FULL_VOCAB), O.bpe_whole_ids()) +
          _mlm_sql(FULL_LEN))
def q_stream_mlm_examples(spark, sf):
    """F1, F2, F5 to F8 and F10 on a stream of lines, restarted half-way, with
    a vocabulary of 32,000 pieces and examples of 512 ids."""
    from ..operators.bpe import bpe_encode
    from ..operators.mlm import as_text, mlm_examples
    from ..session import scratch_path
    model = bpe_model(spark, sf, FULL_VOCAB)
    ln = T.lines(spark, sf).select("doc_id", "line_no", "line")
    return _in_two_runs(spark, ln, scratch_path(spark, "stream-out"), "doc_id long, line_no long, line string",
                        lambda s: as_text(mlm_examples(bpe_encode(s, "line", model), "ids", ["doc_id", "line_no"],
                                                       max_length=FULL_LEN, epoch=0, seed=42, p=0.15)))


@register("stream_lookup_ids", ORACLE["lookup_ids"])
def q_stream_lookup_ids(spark, sf):
    """J3 as a stream-static join: pre-tokens of a stream of lines meet the
    vocabulary table; the stream is restarted half-way."""
    from ..functions.text import pretokenize
    from ..operators.joins import lookup_ids
    from ..session import scratch_path
    vocab = _freq_vocab(spark, sf)
    ln = T.lines(spark, sf).select("doc_id", "line_no", "line")
    out = _in_two_runs(
        spark, ln, scratch_path(spark, "stream-out"), "doc_id long, line_no long, line string",
        lambda s: lookup_ids(s.select("doc_id", "line_no", pretokenize("line").alias("p")), "p", vocab,
                             key_cols=["doc_id", "line_no"]))
    return out.select("doc_id", "line_no", F.col("_pos").cast("long").alias("pos"), "id")


@register("stream_numbered_lines", O.with_(O.LINES) + """,
ends as (select doc_id, max(line_no) last from lines group by doc_id)
select cast(doc_id as varchar) file, line_no, line from lines join ends using (doc_id)
where not (line_no = last and line = '')""")
def q_stream_numbered_lines(spark, sf):
    """S1 on a stream: the documents arrive as text files in two halves; every
    file's lines are numbered in the micro-batch that brings it."""
    from ..session import scratch_path
    from ..sources.sinks import write_files
    from ..streaming.live import numbered_lines_stream
    place, out = scratch_path(spark, "files-in"), scratch_path(spark, "numbered")
    checkpoint = scratch_path(spark, "stream-checkpoint")
    docs = T.documents(spark, sf).select(F.concat(F.lit("f"), "doc_id", F.lit(".txt")).alias("name"), "text", "doc_id")
    for half in (0, 1):
        write_files(docs.filter(F.pmod(F.col("doc_id"), F.lit(2)) == half), place, "name", "text")
        numbered_lines_stream(spark, place, out, checkpoint, newline="lf", max_files_per_trigger=10_000).awaitTermination()
    return spark.read.parquet(out).select(F.regexp_extract("path", r"/f([^/]*)\.txt$", 1).alias("file"), "line_no", "line")


# ---------------------------------------------------------------- S3 (archives)
DOCS_PER_ARCHIVE = 64


@register("read_archive_members", O.with_(O.LINES, O.SEGMENT_DOCS) + f"""
select concat('dev/newstest', doc_id, '.sgm') member, length("xml") n_chars, md5("xml") digest
from segment_docs""")
def q_read_archive_members(spark, sf):
    """S3: the documents are packed as SGM members into tar archives of at
    most {DOCS_PER_ARCHIVE} documents (by id range) in the shared folder, then
    the archives are read back and their ``.sgm`` members extracted."""
    from ..session import scratch_path
    from ..sources.archives import read_archive_members, write_archives
    path = scratch_path(spark, "dev-archives")
    docs = T.segment_docs(spark, sf).select(
        F.concat(F.lit("dev-"), F.floor(F.col("doc_id") / DOCS_PER_ARCHIVE).cast("string"))
        .alias("archive"),
        F.concat(F.lit("dev/newstest"), F.col("doc_id").cast("string"), F.lit(".sgm")).alias("member"),
        F.col("xml").alias("text"))
    write_archives(docs, path).agg(F.count("*")).collect()
    m = read_archive_members(spark, f"{path}/*.tgz", "*.sgm")
    return m.select("member", F.length("text").cast("long").alias("n_chars"),
                    F.md5("text").alias("digest"))
