"""Queries of the corpus operators: each applies one operator, with production
parameters, to its whole table."""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histlake.llm import (ann, audit, jaccard, lattice, lexical, licenses, linededup, mixing, pieces, repetition,
                          simhash, surrogates, urlfilter)
from histlake.llm.common import Stage, read_table


def piece_model() -> str:
    """Place of the public piece vocabulary (a parameter of the operators)."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix(read_table(spark, sf_dir, "documents"), Stage(spark, "op1"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    coded = pieces.encode_decode(F.col("text"), piece_model())
    return docs.select("doc_id", coded.alias("c")).select("doc_id", "c.*")


def op4_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = linededup.line_classes(read_table(spark, sf_dir, "documents"), Stage(spark, "op4"))
    return lines.select("doc_id", "line_no", "class_doc_id", "class_line_no", "n_links", "kept")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(read_table(spark, sf_dir, "documents"), Stage(spark, "op6"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", repetition.repetition(F.col("text")).alias("m")).select("doc_id", "m.*")


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, Stage(spark, "op2"), F.col("vec_id") % 100 == 0)


def op5_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score_documents(read_table(spark, sf_dir, "documents"), piece_model(), Stage(spark, "op5"))


def op7_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(read_table(spark, sf_dir, "pages"), urlfilter.label_table(spark))


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key comes from the session; without one every run draws its own."""
    key = spark.conf.get("spark.histlake.surrogate.key", None) or secrets.token_hex(32)
    return surrogates.replace_entities(read_table(spark, sf_dir, "documents"), Stage(spark, "op9"), key)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = licenses.scan_licenses(F.col("text"), licenses.document_frequencies(docs))
    return docs.select("doc_id", found.alias("s")).select("doc_id", "s.*")


def op11_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"),
                       Stage(spark, "op11"))


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"),
                          Stage(spark, "op12"))


def op13_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(read_table(spark, sf_dir, "documents"), Stage(spark, "op13"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing, "op2_nearest": op2_nearest, "op3_pieces": op3_pieces, "op4_linededup": op4_linededup,
    "op5_lattice": op5_lattice, "op6_simhash": op6_simhash, "op7_urlfilter": op7_urlfilter,
    "op8_repetition": op8_repetition, "op9_surrogates": op9_surrogates, "op10_licenses": op10_licenses, "op11_audit": op11_audit,
    "op12_lexical": op12_lexical, "op13_jaccard": op13_jaccard,
}

# Exact search: the operator's error bounds leave nothing out on these vectors.
OP2_SQL = """
with v as (
  select vec_id, embedding::double[] as e from embeddings
  where vec_id is not null and embedding is not null
    and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
    and list_bool_or(list_transform(embedding, lambda x: x <> 0))),
d as (
  select q.vec_id as query_id, c.vec_id,
         sqrt(list_sum(list_transform(list_zip(q.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) as score
  from v q join v c on c.vec_id <> q.vec_id and len(c.e) = len(q.e)
  where q.vec_id % 100 = 0),
r as (select *, row_number() over (partition by query_id order by score, vec_id)::int as rank from d)
select query_id, rank, vec_id, score from r where rank <= 10
"""

# All orders of five letters, and every figure by its definition.
OP11_SQL = r"""
with d as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
lab as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
fails as (
  select d.doc_id, part, coalesce(lab.good, 0) as good, coalesce(lab.toxic, 0) as toxic,
         [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
          100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * len(t), regexp_matches(t, '[#$%&*|]'),
          coalesce(d.doc_id > min(d.doc_id) over (partition by t), false)] as f
  from d left join lab on lab.doc_id = d.doc_id),
letters as (select * from (values ('A', 1), ('B', 2), ('C', 3), ('D', 4), ('E', 5)) v(letter, no)),
orders as (
  select a.letter || b.letter || c.letter || x.letter || y.letter as filter_order, [a.no, b.no, c.no, x.no, y.no] as o
  from letters a, letters b, letters c, letters x, letters y
  where len(list_distinct([a.no, b.no, c.no, x.no, y.no])) = 5),
masks as (
  select part, f, count(*) as n, sum(good) as good, sum(toxic) as toxic from fails group by part, f),
steps as (
  select part, filter_order, step, o[step] as no, n, good, toxic, f,
         list_bool_or(list_transform(o[1:step - 1], lambda i: f[i])) as gone
  from masks, orders, (select unnest([1, 2, 3, 4, 5]) as step)),
firsts as (
  select part, no, sum(n) as shapley from steps where f[no] and not coalesce(gone, false) group by part, no)
select s.part, s.filter_order, s.step::int as step,
       sum(case when not f[s.no] and not coalesce(gone, false) then n else 0 end)::bigint as kept,
       sum(case when f[s.no] and not coalesce(gone, false) then n else 0 end)::bigint as removed,
       sum(case when f[s.no] and gone then n else 0 end)::bigint as redundant,
       sum(case when f[s.no] and len(list_filter(f, lambda x: x)) = 1 then n else 0 end)::bigint as unique_fails,
       sum(case when f[s.no] and not coalesce(gone, false) then good else 0 end)::bigint as good_lost,
       sum(case when f[s.no] and not coalesce(gone, false) then toxic else 0 end)::bigint as toxic_lost,
       coalesce(any_value(shapley), 0)::bigint as shapley
from steps s left join firsts on firsts.part = s.part and firsts.no = s.no
group by s.part, s.filter_order, s.step, s.no
"""

OP12_SQL = r"""
with terms as (
  select doc_id, row_no, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select *, row_number() over () as row_no from documents)),
tf as (select row_no, any_value(doc_id) as doc_id, term, count(*) as tf from terms group by row_no, term),
size as (select row_no, sum(tf)::bigint as n from tf group by row_no),
total as (select count(*)::bigint as n_docs, sum(n)::bigint as n_all from size),
weight as (
  select term, floor(1000 * ln((2 * any_value(n_docs) + 2)::double / (2 * count(*) + 1)))::bigint as w
  from tf, total group by term),
item_terms as (
  select distinct item_id, item_no, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select *, row_number() over () as item_no from benchmark)),
scores as (
  select item_no, any_value(item_id) as item_id, tf.row_no, any_value(tf.doc_id) as doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_all))))::bigint as score
  from item_terms join tf using (term) join weight using (term) join size on size.row_no = tf.row_no, total
  group by item_no, tf.row_no),
ranked as (
  select *, row_number() over (partition by item_no order by score desc, doc_id nulls last)::int as rank
  from scores where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""

OP13_SQL = r"""
with recursive words as (
  select row_number() over () as no, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
sets as (
  select no, doc_id, case when len(w) = 0 then []::varchar[] else list_distinct(list_transform(
    range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) end as s from words),
grams as (select no, unnest(s) as g from sets),
links as (
  select a, b from (select x.no as a, y.no as b, count(*) as n from grams x join grams y on x.g = y.g and x.no <> y.no
                    group by x.no, y.no) p
  join sets u on u.no = p.a join sets v on v.no = p.b where 100 * n >= 85 * (len(u.s) + len(v.s) - n)),
reach as (select no as a, no as b from sets union select r.a, l.b from reach r join links l on l.a = r.b),
parts as (select r.a as no, min(s.doc_id) as component_id from reach r join sets s on s.no = r.b group by r.a),
degree as (select a as no, count(*) as n_links from links group by a)
select s.doc_id, len(s.s)::bigint as n_shingles, component_id, coalesce(n_links, 0)::bigint as n_links
from sets s join parts using (no) left join degree using (no)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {"op2_nearest": OP2_SQL, "op11_audit": OP11_SQL, "op12_lexical": OP12_SQL,
            "op13_jaccard": OP13_SQL}
