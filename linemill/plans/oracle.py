"""DuckDB twins of the derived tables, as CTE text for the oracle queries.

The Spark side builds the same tables with the DataFrame API
(:mod:`linemill.plans.tables`); every query in the catalog is checked by
running its oracle SQL on the same parquet files.
"""

from __future__ import annotations

from ..functions.arrays import SPECIAL_TOKENS
from ..operators.bpe import PRINTABLE_BYTE_RANGES

LINES = """lines as (
  select doc_id, lang, source, cast(u.i - 1 as bigint) line_no, u.line line
  from documents, unnest(string_split(text, chr(10))) with ordinality u(line, i))"""

LINES_DIRTY = """lines_dirty as (
  select doc_id, lang, source, line_no,
    case substr(h, 1, 1) when '0' then '' when '1' then concat(line, chr(13))
      when '2' then concat('  ', line, chr(9)) when '3' then concat('a & b &amp; ', line)
      when '4' then concat(line, '<hl>') when '5' then concat('</hl ', line) else line end line
  from (select *, md5(concat('d:', doc_id, ':', line_no)) h from lines) z)"""

DOC_RANKS = """kdocs as (
  select doc_id, lang, source, text,
         row_number() over (partition by lang order by doc_id) doc_no from documents),
klines as (
  select doc_id, lang, source, doc_no, cast(u.i - 1 as bigint) line_no, u.line line
  from kdocs, unnest(string_split(text, chr(10))) with ordinality u(line, i))"""

BITEXT = DOC_RANKS + """,
bitext as (
  select concat('en-', b.lang) pair, b.doc_no doc_no, b.line_no line_no, a.source source,
         a.line src, b.line tgt
  from klines a join klines b on a.doc_no = b.doc_no and a.line_no = b.line_no
  where a.lang = 'en' and b.lang <> 'en')"""

TOY_IDS = """toy_arrays as (
  select doc_id, line_no, list_transform(string_split(line, ' '), lambda w: 5 + length(w)) ids
  from lines),
toy_ids as (
  select doc_id, line_no, cast(u.i - 1 as bigint) pos, u.id id
  from toy_arrays, unnest(ids) with ordinality u(id, i))"""

TRACE = """trace_src as (
  select label, step, cast(u.i - 1 as bigint) idx, cast(u.x as double) x
  from (select label, embedding,
               row_number() over (partition by label order by vec_id) - 1 step from embeddings),
       unnest(embedding) with ordinality u(x, i)),
param_trace as (
  select step, concat('p', label) param, idx, theta_before, theta_after, theta_before grad
  from (select label, step, idx, x theta_after,
               lag(x) over (partition by label, idx order by step) theta_before
        from trace_src) z
  where theta_before is not null)"""

SEGMENT_DOCS = """segment_docs as (
  select doc_id, concat('<doc docid="', doc_id, '">',
    string_agg(concat('<seg id="', line_no + 1, '">', replace(line, '<', ' '), '</seg>'), ''
               order by line_no), '</doc>') "xml"
  from lines group by doc_id)"""

# DuckDB's RE2 has no look-ahead: a marker is put before the last white
# space of a run that precedes a non-space, and excluded from all classes.
PRETOKENS_EXPR = (
    "regexp_extract_all(regexp_replace({col}, '(\\s+)(\\s\\S)', '\\1' || chr(1) || '\\2', 'g'), "
    "'''s|''t|''re|''ve|''m|''ll|''d| ?\\p{{L}}+| ?\\p{{N}}+| ?[^\\s\\x01\\p{{L}}\\p{{N}}]+|\\s+', 0)")


def pretokens_expr(col: str) -> str:
    return PRETOKENS_EXPR.format(col=col)


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------- learnt vocabularies
_SPECIALS = ", ".join(f"'{p}'" for p in SPECIAL_TOKENS)
_PRINTABLE = " or ".join(f"(b between {lo} and {hi})" for lo, hi in PRINTABLE_BYTE_RANGES)
# Byte values to symbol ids and to their characters, in id order.
BYTES = f"""bmap as (
  select b, printf('%02X', b) hx, p, case when p then chr(cast(b as integer)) else
           chr(cast(255 + row_number() over (partition by p order by b) as integer)) end ch,
         cast(row_number() over (order by case when p then b else 256 + b end) + 4 as integer) id
  from (select b, {_PRINTABLE} p
        from range(256) r(b)) z)"""


def symbols(name: str, source: str) -> str:
    """``name(t, w, n)``: the words ``t`` of ``source(t, n)`` with one character
    per symbol id (id + 32)."""
    return f"""{name}_bytes as (
  select t, n, k, substr(hex(encode(t)), 2 * k + 1, 2) hx from (
    select t, n, unnest(range(0, cast(length(hex(encode(t))) / 2 as bigint))) k from {source}) z),
{name} as (
  select t, any_value(n) n, string_agg(chr(cast(b.id + 32 as integer)), '' order by k) w
  from {name}_bytes y join bmap b on b.hx = y.hx group by t)"""


def bpe(merges: int) -> str:
    """``merged(rank, l, r)`` and ``voc(voc)``: byte-level BPE learnt on all
    lines with their breaks, one merge a step, as CTEs of a recursive query."""
    return f"""hist0 as (
  select t, count(*) n from (select unnest({pretokens_expr("concat(line, chr(10))")}) t from lines) z group by t),
{symbols("syms", "hist0")},
learn(step, w, n, p) as (
  select 0, w, n, cast(null as varchar) from syms
  union all
  select b.step + 1, replace(b.w, best.p, chr(cast(32 + 261 + b.step as integer))), b.n, best.p
  from learn b, (
    select p from (select substr(w, i, 2) p, n
                   from (select w, n, unnest(range(1, length(w))) i from learn) y) z
    group by p having sum(n) >= 2 order by sum(n) desc, p limit 1) best
  where b.step < {merges}),
merged as (
  select cast(step - 1 as integer) rank, any_value(p) p, cast(ascii(substr(any_value(p), 1, 1)) - 32 as integer) l,
         cast(ascii(substr(any_value(p), 2, 1)) - 32 as integer) r from learn where step > 0 group by step),
grow(step, voc) as (
  select 0, list_concat([{_SPECIALS}], (select list(ch order by id) from bmap))
  union all
  select step + 1, list_append(voc, concat(voc[l + 1], voc[r + 1])) from grow join merged on rank = step),
voc as (select voc from grow order by step desc limit 1)"""


def bpe_each(merges: int, by: str) -> str:
    """``merged(g, rank, l, r)``: as :func:`bpe`, for each value of the column
    ``by`` of ``lines``."""
    return f"""hist0 as (
  select g, t, count(*) n
  from (select {by} g, unnest({pretokens_expr("concat(line, chr(10))")}) t from lines where {by} is not null) z group by g, t),
kinds0 as (select t, 1 n from hist0 group by t),
{symbols("ksyms0", "kinds0")},
syms as (select h.g g, k.w w, h.n n from hist0 h join ksyms0 k on k.t = h.t),
learn(step, g, w, n, p) as (
  select 0, g, w, n, cast(null as varchar) from syms
  union all
  select b.step + 1, b.g, replace(b.w, best.p, chr(cast(32 + 261 + b.step as integer))), b.n, best.p
  from learn b join (
    select g, p from (
      select g, p, row_number() over (partition by g order by c desc, p) k from (
        select g, p, sum(n) c from (select g, substr(w, i, 2) p, n
                                    from (select g, w, n, unnest(range(1, length(w))) i from learn) y) z
        group by g, p having sum(n) >= 2) x) v where k = 1) best on best.g = b.g
  where b.step < {merges}),
merged as (
  select g, cast(step - 1 as integer) rank, cast(ascii(substr(any_value(p), 1, 1)) - 32 as integer) l,
         cast(ascii(substr(any_value(p), 2, 1)) - 32 as integer) r from learn where step > 0 group by g, step)"""


def bpe_ids(merges: int) -> str:
    """``enc(doc_id, line_no, ids)``: every line's ids under ``merged``."""
    return f"""toks as (
  select doc_id, line_no, u.i i, u.t t from lines, unnest({pretokens_expr("line")}) with ordinality u(t, i)),
kinds as (select t, 1 n from toks group by t),
{symbols("ksyms", "kinds")},
apply(step, t, w) as (
  select 0, t, w from ksyms
  union all
  select step + 1, t, replace(w, p, chr(cast(32 + 261 + rank as integer))) from apply join merged on rank = step),
coded as (
  select t, list_transform(string_split(w, ''), lambda c: ascii(c) - 32) ids
  from apply where step = (select count(*) from merged)),
enc as (
  select lines.doc_id, lines.line_no, coalesce(any_value(x.ids), []) ids from lines left join (
    select doc_id, line_no, flatten(list(ids order by i)) ids from toks join coded using (t)
    group by doc_id, line_no) x on x.doc_id = lines.doc_id and x.line_no = lines.line_no
  group by lines.doc_id, lines.line_no)"""


def bpe_whole(vocab_size: int, candidates: int = 512) -> str:
    """``learn(kind, k, w, n)``: as :func:`bpe`, up to ``vocab_size`` pieces,
    many merges a step. Kind 0 are the words (``w``, from ``k``) and their
    counts ``n``, 1 the pairs ``k`` and theirs, 2 the pieces ``k`` and their
    ids ``n``, 3 the merges: rank ``k``, pair ``w``, new id ``n``.

    A step merges the first of the pairs in order (count, then pair) that
    cannot change each other's turn. It ends before a pair that overlaps an
    earlier one somewhere, and before one that could be outdone by a pair which
    an earlier merge makes: that pair counts no more than the triple of symbols
    it comes from, and its new symbol is the highest. A pair whose piece is
    known merges alone. ``candidates`` bounds a step, not the result."""
    return f"""hist0 as (
  select t, count(*) n from (select unnest({pretokens_expr("concat(line, chr(10))")}) t from lines) z group by t),
{symbols("syms", "hist0")},
specials as (select unnest([{_SPECIALS}]) s, unnest(range({len(SPECIAL_TOKENS)})) id),
learn(kind, k, w, n) using key (kind, k) as (
  (select 0 kind, w k, w, cast(sum(n) as bigint) n from syms where length(w) > 1 group by w
   union all
   select 1, p, null, cast(sum(n) as bigint)
   from (select substr(w, i, 2) p, n from (select w, n, unnest(range(1, length(w))) i from syms) y) z group by p
   union all
   select 2, ch, null, id from bmap
   union all
   select 2, s, null, id from specials)
  union
  (with now as materialized (select kind, k, w, n from recurring.learn where kind <> 0 or length(w) > 1),
   voc as materialized (select k s, n id from now where kind = 2),
   size as (select (select count(*) from now where kind = 2) pieces, (select count(*) from now where kind = 3) merges),
   top as materialized (
     select k p, n c, row_number() over (order by n desc, k) j
     from (select k, n from now where kind = 1 and n >= 2 order by n desc, k limit {candidates}) z),
   named as materialized (
     select p, j, concat(a.s, b.s) s from top join voc a on a.id = ascii(substr(p, 1, 1)) - 32
     join voc b on b.id = ascii(substr(p, 2, 1)) - 32),
   places as materialized (
     select k, w, n, substr(w, i, 3) t
     from (select k, w, n, unnest(range(1, length(w))) i from now where kind = 0) y),
   triples as materialized (
     select substr(t, 1, 2) p, substr(t, 2, 2) q, sum(n) c from places
     where length(t) = 3 and (substr(t, 1, 2) in (select p from top) or substr(t, 2, 2) in (select p from top))
     group by t),
   ends as (
     select greatest(a.j, b.j) j from triples t join top a on a.p = t.p join top b on b.p = t.q where a.j <> b.j
     union all
     select min(b.j) from triples t join top a on a.p = t.q
     join top b on b.j > a.j and (b.c < t.c or (b.c = t.c and substr(b.p, 1, 1) > substr(t.p, 1, 1)))
     union all
     select min(b.j) from triples t join top a on a.p = t.p join top b on b.j > a.j and b.c < t.c
     union all
     select greatest(2, j) from (select j, s, min(j) over (partition by s) f from named) z
     where f < j or s in (select s from voc)
     union all
     select {vocab_size} - pieces + 1 from size),
   batch as materialized (
     select p, s, coalesce(v.id, pieces + j - 1) id, merges + j - 1 rank
     from size, named left join voc v using (s) where j < coalesce((select min(j) from ends), j + 1)),
   hit as materialized (
     select k, w, any_value(n) n, list_reduce(list_prepend(w, list(distinct concat(p, chr(cast(32 + id as integer))))),
       lambda x, m: replace(x, substr(m, 1, 2), substr(m, 3, 1))) x
     from places join batch on p = substr(t, 1, 2) group by k, w),
   change as (
     select p, sum(n) d from (
       select substr(w, i, 2) p, -n n from (select w, n, unnest(range(1, length(w))) i from hit) y
       union all
       select substr(x, i, 2) p, n from (select x, n, unnest(range(1, length(x))) i from hit) y) z
     group by p having sum(n) <> 0)
   select 0, k, x, n from hit
   union all
   select 1, p, null, cast(coalesce(r.n, 0) + d as bigint) from change left join now r on r.kind = 1 and r.k = p
   union all
   select 2, s, null, id from batch
   union all
   select 3, cast(rank as varchar), p, id from batch))"""


def bpe_whole_ids() -> str:
    """``enc(doc_id, line_no, ids)`` under the merges of :func:`bpe_whole`: in
    every distinct pre-token the leftmost pair of lowest rank is merged, one a
    step."""
    return f"""toks as (
  select doc_id, line_no, u.i i, u.t t from lines, unnest({pretokens_expr("line")}) with ordinality u(t, i)),
kinds as (select t, 1 n from toks group by t),
{symbols("ksyms", "kinds")},
ranks as materialized (
  select w p, max(cast(k as bigint)) rank, arg_max(n, cast(k as bigint)) id from learn where kind = 3 group by w),
apply(step, t, w) as (
  select 0, t, w from ksyms
  union all
  select step + 1, t, concat(substr(w, 1, m.i - 1), chr(cast(32 + m.id as integer)), substr(w, m.i + 2)) from (
    select step, t, w, min({{'rank': rank, 'i': i, 'id': id}}) m
    from (select step, t, w, unnest(range(1, length(w))) i from apply) y join ranks on p = substr(w, i, 2)
    group by step, t, w) z),
coded as (
  select t, list_transform(string_split(arg_max(w, step), ''), lambda c: ascii(c) - 32) ids from apply group by t),
enc as (
  select lines.doc_id, lines.line_no, coalesce(any_value(x.ids), []) ids from lines left join (
    select doc_id, line_no, flatten(list(ids order by i)) ids from toks join coded using (t)
    group by doc_id, line_no) x on x.doc_id = lines.doc_id and x.line_no = lines.line_no
  group by lines.doc_id, lines.line_no)"""


def with_recursive(*ctes: str) -> str:
    return "with recursive " + ",\n".join(ctes) + "\n"
