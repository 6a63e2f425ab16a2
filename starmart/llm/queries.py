"""The operators applied to the driver's tables with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (codes, exactdedup, fim, langid, licences, lines, mixing, packing, ppm, quality, simhash,
               toxicity, warc)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

WORDS_SQL = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"
FOLD_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return add


@query("op1_warc_round_trip", """
with p as (select page_id, encode(coalesce(html, '')) as body from pages),
d as (select page_id, octet_length(body) as n, sha1(body) as h from p),
k as (select h, max(page_id) as keep from d where n >= 1000 group by h having count(*) > 1)
select page_id, cast(n as bigint) as payload_bytes, h as payload_digest,
       case when page_id <> keep then 'revisit' else 'response' end as record_type,
       case when page_id <> keep then keep end as refers_to
from d left join k using (h)""")
def op1_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.round_trip(table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op2_pu_quality")
def op2_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _lines_sql() -> str:
    """The line rules in SQL, from the same patterns and limits."""
    r, q = lines.Rules(), lambda pattern: "'" + pattern.replace("'", "''") + "'"
    return f"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
l as (select rid, unnest(string_split(t, chr(10))) as line,
      generate_subscripts(string_split(t, chr(10)), 1) as ln from d),
s as (select *, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') as ws from l),
f as (select rid, ln, line, ws, len(ws) as n, length(array_to_string(ws, '')) as chars,
      len(regexp_extract_all(line, {q(lines.NAVIGATION.pattern)})) as nav,
      length(line) - length(regexp_replace(line, {q(lines.MARKS.pattern)}, '', 'g')) as marks,
      row_number() over (partition by rid, line order by ln) as seen from s where len(ws) > 0),
w as (select rid, ln, unnest(ws) as x, generate_subscripts(ws, 1) as i from f),
v as (select rid, ln, i, x, lag(x) over (partition by rid, ln order by i) as before,
      x || ' ' || lead(x, 1) over o || ' ' || lead(x, 2) over o || ' ' || lead(x, 3) over o
        || ' ' || lead(x, 4) over o as win
      from w window o as (partition by rid order by ln, i)),
stutter as (select rid, ln, count(*) filter (x = before) as same from v group by rid, ln),
c as (select rid, ln, i, case when win is null then 0
        when count(*) over (partition by rid, win) > 1 then 1 else 0 end as twice from v),
rep as (select rid, sum(hit) as n_repeat_words from (
      select rid, max(twice) over (partition by rid order by ln, i
                                   rows between {lines.WINDOW - 1} preceding and current row) as hit
      from c) group by rid),
j as (select f.*, not ((nav >= {r.nav_marks} and n <= {r.words_per_mark} * nav)
        or marks > {r.mark_share}::double * chars
        or (n <= {r.boilerplate_words} and regexp_matches(line, {q("(?i)" + lines.BOILERPLATE.pattern)}))
        or same > {r.stutter_share}::double * n
        or (n < {r.min_words} and not regexp_matches(line, {q(lines.CLOSED.pattern)}))
        or not regexp_matches(line, '[\\p{{L}}\\p{{N}}]')) as good
      from f join stutter using (rid, ln)),
g as (select rid, sum(n) as n_words, sum(chars) as word_chars, count(*) filter (seen > 1) as n_dup_lines,
      coalesce(sum(n) filter (good), 0) as kept_words, coalesce(sum(chars) filter (good), 0) as kept_chars
      from j group by rid),
b as (select d.doc_id, coalesce(n_words, 0) as n_words, coalesce(word_chars, 0) as word_chars,
      length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
      coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
      coalesce(kept_words, 0) as kept_words, coalesce(kept_chars, 0) as kept_chars
      from d left join g using (rid) left join rep using (rid))
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
       n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words,
       n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
       not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and kept_words >= {r.min_words}
         and kept_chars >= {r.min_kept}::double * word_chars as kept,
       kept_words::bigint as kept_words
from b"""


@query("op3_line_clean", _lines_sql())
def op3_line_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.clean_lines(table(spark, sf_dir, "documents"), with_text=False)


@query("op4_source_mix", f"""
with d as (select doc_id, source, cast({WORDS_SQL} as bigint) as size from documents),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
w as (select *, ((row_number() over (order by source is null, encode(source)) - 1) % 3) + 1 as weight,
      3 * source_size as lim from s),
r as (select *, sum(lim) over o as limits, sum(weight) over o as weights,
      sum(source_size) over () as total, sum(weight) over () as all_weights,
      row_number() over o as k
      from w window o as (order by cast(lim as double) / weight, source is null, encode(source)
                          rows unbounded preceding)),
l as (select *, cast(total - (limits - lim) as double) / (all_weights - (weights - weight)) as lvl from r),
lev as (select min_by(lvl, k) as lvl from l where lim >= lvl * weight),
t as (select l.source, l.source_size,
      case when l.source_size > 0 then least(cast(l.lim as double), lev.lvl * l.weight) else 0.0 end as target
      from l, lev),
r3 as (select d.doc_id, d.size, t.source, t.source_size, t.target,
       case when t.source_size > 0 then least(3.0::double, t.target / t.source_size) else 0.0::double end as rate
       from d join t on d.source is not distinct from t.source),
tries as (select r3.*, k, cast('0x' || substr(md5('mix' || k || ':' || coalesce(cast(doc_id as varchar), '')), 1, 13)
                               as bigint)::double / 4503599627370496.0::double as u
          from r3, unnest(range(16)) as ks(k)),
c as (select *, cast(floor(rate) + case when u < rate - floor(rate) then 1 else 0 end as integer) as copies from tries),
best as (select source, k from (select source, k, any_value(target) as target, sum(size * copies) as got
                                from c group by source, k)
         qualify row_number() over (partition by source order by abs(got::double - target), k) = 1)
select doc_id, size, source_size, target, size * copies as taken, copies
from c join best on c.source is not distinct from best.source and c.k = best.k""")
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(table(spark, sf_dir, "documents"))


def vocabulary() -> str:
    """The public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary())


@query("op6_counterfactual_toxicity")
def op6_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_exact_dedup", f"""
with d as (select doc_id, {FOLD_SQL} as norm from documents),
g as (select norm, max(doc_id) as keep_id, count(*) as group_size from d group by norm)
select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept, sha256(d.norm) as text_sha256
from d join g using (norm)""")
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.exact_groups(table(spark, sf_dir, "documents"))


@query("op8_centroid_language")
def op8_centroid_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


@query("op9_ppm_scores")
def op9_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.scores(table(spark, sf_dir, "documents"))


@query("op10_simhash_dedup")
def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


@query("op11_fill_in_middle", """
with d as (select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h
           from documents),
u as (select doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') as toks,
      cast('0x' || h[1:8] as bigint) as h1, cast('0x' || h[9:16] as bigint) as h2,
      cast('0x' || h[17:24] as bigint) as h3, cast('0x' || h[25:32] as bigint) as h4 from d),
c as (select *, len(toks) as n, least(h1 % (len(toks) + 1), h2 % (len(toks) + 1)) as a,
      greatest(h1 % (len(toks) + 1), h2 % (len(toks) + 1)) as b,
      case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90
           then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from u),
f as (select *, array_to_string(toks[1:a], '') as p, array_to_string(toks[a + 1:b], '') as m,
      array_to_string(toks[b + 1:n], '') as s from c)
select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then length(p) end as prefix_chars,
       case when form <> 'plain' then length(m) end as middle_chars,
       sha256(case form when 'plain' then t when 'spm' then '<S>' || s || '<P>' || p || '<M>' || m
                        else '<P>' || p || '<S>' || s || '<M>' || m end) as output_sha256,
       sha256(t) as restored_sha256 from f""")
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2(out.output.cast("binary"), 256).alias("output_sha256"),
                      F.sha2(fim.restored(out.output, out.form).cast("binary"), 256).alias("restored_sha256"))


@query("op12_licence_scan")
def op12_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents")).drop("notices")


def _codes_sql(rounds: int = 4) -> str:
    """Assignment by all distances and integer means, one pair of subqueries a round."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
a{i} as materialized (
  select rid, p, min(cast(list_inner_product(x.v, x.v) - 2 * list_inner_product(x.v, b.v)
                          + list_inner_product(b.v, b.v) as bigint) * 256 + e) as best
  from x join b{i} b using (p) group by rid, p)""")
        if i < rounds:
            steps.append(f"""
m{i} as (select p, e, pos, sum(val) as s, count(*) as n
  from (select p, best % 256 as e, unnest(v) as val, generate_subscripts(v, 1) as pos
        from a{i} join x using (rid, p)) group by p, e, pos),
b{i + 1} as materialized (
  select p, e, coalesce(fresh, v) as v from b{i} left join (
    select p, e, list(floor(s / n) order by pos) as fresh from m{i} group by p, e) using (p, e))""")
    return f"""
with k as materialized (
  select row_number() over () as rid, vec_id, label,
         [floor(1024 * cast(c as double)) for c in embedding] as q
  from embeddings where embedding is not null
    and len([c for c in embedding if c is null or not isfinite(c)]) = 0),
x as materialized (
  select rid, vec_id, q, p, q[p * (len(q) // 4) + 1:(p + 1) * (len(q) // 4)] as v from k, range(4) g(p)),
b0 as materialized (select p, e, v from (
  select p, v, row_number() over (partition by p order by vec_id nulls last, q) - 1 as e from x) where e < 256),
{",".join(steps)},
r as (select rid, string_agg(format('{{:02x}}', best % 256), '' order by p) as code, sum(best // 256) as error
      from a{rounds} group by rid),
h as (select sha256(string_agg(cast(cast(val as bigint) as varchar), ',' order by p, e, pos)) as sha from (
  select p, e, unnest(v) as val, generate_subscripts(v, 1) as pos from b{rounds}))
select vec_id, code, cast(error as bigint) as error,
       cast(sum(error) over (partition by label) as bigint) as label_error, sha as codebooks_sha256
from r join k using (rid), h"""


@query("op13_vector_codes", _codes_sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, books = codes.compress(table(spark, sf_dir, "embeddings"))
    return out.withColumn("codebooks_sha256", F.lit(codes.books_sha256(books)))
