"""The registered queries of the text operators, and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwright.llm import (
    bpe_digests,
    filter_audit,
    fuzzy_lines,
    id_files,
    mixing,
    page_text,
    pitman_yor,
    quality,
    rules,
    token_groups,
    topk,
    toxicity,
    vector_codes,
)
from claimwright.llm.bpe import Vocabulary
from claimwright.llm.storage import prepare

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def op2_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.rule_ledger(_table(spark, sf_dir, "documents"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_groups.similar_components(_table(spark, sf_dir, "documents"), 3, 90)


def op4_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.line_dedup(_table(spark, sf_dir, "documents"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, 5)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    vocabulary = Vocabulary.read(path, public_tokenizers.PATTERN)
    return bpe_digests.round_trips(_table(spark, sf_dir, "documents"), vocabulary)


def op7_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.language_scores(_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = {"en": 0.4, "fr": 0.2, "de": 0.2, "es": 0.2}
    return mixing.mixture(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), targets
    )


def op9_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return id_files.id_files(_table(spark, sf_dir, "documents"), path, 2)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(_table(spark, sf_dir, "embeddings"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def op13_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.page_texts(_table(spark, sf_dir, "pages"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_rule_ledger": op2_rule_ledger,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_fuzzy_lines": op4_fuzzy_lines,
    "op5_exact_topk": op5_exact_topk,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_pitman_yor": op7_pitman_yor,
    "op8_mixing": op8_mixing,
    "op9_id_files": op9_id_files,
    "op10_quality": op10_quality,
    "op11_vector_codes": op11_vector_codes,
    "op12_filter_audit": op12_filter_audit,
    "op13_page_text": op13_page_text,
}

RULE_LEDGER_SQL = r"""
with d as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as ls
  from documents
),
words as (select rid, unnest(ws) as w, unnest(range(1, len(ws) + 1)) as k from d),
win as (
  select d.rid, i.k, array_to_string(d.ws[i.k:i.k + 7], ' ') as win
  from d, lateral (select unnest(range(1, len(d.ws) - 6)) as k) i
),
twice as (select rid, win from win group by all having count(*) > 1),
covered as (
  select rid, count(distinct p) as n
  from (select win.rid, unnest(range(win.k, win.k + 8)) as p from win join twice using (rid, win))
  group by rid
),
stutter as (
  select rid, count(*) as n
  from (select rid, w, lag(w) over (partition by rid order by k) as before from words)
  where w = before group by rid
),
m as (
  select d.doc_id, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols, len(ls) as n_lines,
    len(ls) - len(list_distinct(ls)) as n_dup_lines,
    coalesce(covered.n, 0) as n_repeat_words, coalesce(stutter.n, 0) as n_adjacent_repeats,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) as n_capitals
  from d left join covered using (rid) left join stutter using (rid)
),
b as (
  select *,
    case when n_words < 20 then 1 else 0 end
    + case when 100 * n_repeat_words > 30 * n_words then 2 else 0 end
    + case when 10 * n_symbols > 3 * n_words then 4 else 0 end
    + case when 2 * n_dup_lines > n_lines then 8 else 0 end
    + case when word_chars < 2 * n_words or word_chars > 15 * n_words then 16 else 0 end
    + case when 10 * n_adjacent_repeats > 3 * n_words then 32 else 0 end
    + case when 2 * n_capitals > word_chars then 64 else 0 end as bits
  from m
)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars,
  n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines,
  n_repeat_words::bigint as n_repeat_words, (bits & 3) <> 0 as base_failed, bits = 0 as kept,
  n_lines::bigint as n_lines, n_adjacent_repeats::bigint as n_adjacent_repeats,
  n_capitals::bigint as n_capitals, bits::bigint as fail_bits
from b
"""

TOP_K_SQL = """
with v as (
  select vec_id,
    list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as e
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
),
q as (select * from v where vec_id % 50 = 0),
s as (
  select q.vec_id as query_id, c.vec_id,
    list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::bigint as score
  from q join v c on c.vec_id <> q.vec_id
)
select query_id, rank::int as rank, vec_id, score
from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s
)
where rank <= 5
"""

FILTER_AUDIT_SQL = r"""
with d as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws
  from documents
),
originals as (select t, min(doc_id) as original from d group by t),
marks as (
  select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic
  from labels where doc_id is not null group by doc_id
),
f as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
    [len(ws) < 200,
     100 * len(list_distinct(ws)) < 50 * len(ws),
     100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
     regexp_matches(t, '[#$%&*|]'),
     coalesce(doc_id > original, false)] as fails
  from d join originals using (t) left join marks using (doc_id)
),
cells as (select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from f group by all),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
met as (
  select part, filter_order, step, n, good, toxic, filter_order[step] as letter,
    fails[ord(filter_order[step]) - 64] as own,
    len(list_filter(range(1, step), lambda s: fails[ord(filter_order[s]) - 64])) > 0 as earlier,
    len(list_filter(fails, lambda x: x)) as failed
  from cells, orders, (select unnest([1, 2, 3, 4, 5]) as step) steps
),
counted as (
  select part, filter_order, step, letter,
    sum(case when not own and not earlier then n else 0 end)::bigint as kept,
    sum(case when own and not earlier then n else 0 end)::bigint as removed,
    sum(case when own and earlier then n else 0 end)::bigint as redundant,
    sum(case when own and failed = 1 then n else 0 end)::bigint as unique_fails,
    sum(case when own and not earlier then good else 0 end)::bigint as good_lost,
    sum(case when own and not earlier then toxic else 0 end)::bigint as toxic_lost
  from met group by all
)
select part, filter_order, step::int as step, kept, removed, redundant, unique_fails, good_lost,
  toxic_lost, sum(removed) over (partition by part, letter)::bigint as shapley
from counted
"""


def _vector_codes_sql(rounds: int = vector_codes.ROUNDS) -> str:
    """The codebooks' rounds written out one after the other."""
    steps = [
        """v as materialized (
  select row_number() over (order by vec_id, embedding) - 1 as rid, vec_id, label,
    list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as e
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
)""",
        """parts as materialized (
  select rid, p, e[p * (len(e) // 4) + 1:(p + 1) * (len(e) // 4)] as x
  from v, (select unnest([0, 1, 2, 3]) as p) positions
)""",
        "book0 as materialized (select p, rid as entry, x as c from parts where rid < 256)",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""near{i} as materialized (
  select rid, p, min(struct_pack(d := gap, entry := entry)) as best
  from (
    select rid, parts.p, entry,
      list_sum(list_transform(range(1, len(x) + 1), lambda k: (x[k] - c[k]) * (x[k] - c[k])))::bigint as gap
    from parts join book{i} on parts.p = book{i}.p
  )
  group by rid, p
)"""
        )
        if i < rounds:
            steps.append(
                f"""book{i + 1} as materialized (
  select b.p, b.entry, coalesce(m.c, b.c) as c
  from book{i} b left join (
    select p, entry, list((total - ((total % points) + points) % points) // points order by k) as c
    from (
      select p, entry, k, sum(x)::bigint as total, count(*) as points
      from (
        select p, best.entry as entry, unnest(range(1, len(x) + 1)) as k, unnest(x) as x
        from near{i} join parts using (rid, p)
      )
      group by all
    )
    group by p, entry
  ) m on m.p = b.p and m.entry = b.entry
)"""
            )
    return (
        "with "
        + ",\n".join(steps)
        + f""",
coded as (
  select rid, string_agg(printf('%02x', best.entry), '' order by p) as code,
    sum(best.d)::bigint as error
  from near{rounds} group by rid
),
digest as (
  select sha256(string_agg(array_to_string(c, ','), ',' order by p, entry)) as codebooks_sha256
  from book{rounds}
)
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256
from coded join v using (rid), digest
"""
    )


ORACLE_SQL: dict[str, str] = {
    "op2_rule_ledger": RULE_LEDGER_SQL,
    "op5_exact_topk": TOP_K_SQL,
    "op11_vector_codes": _vector_codes_sql(),
    "op12_filter_audit": FILTER_AUDIT_SQL,
}
