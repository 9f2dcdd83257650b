"""The registered queries of the text operators, each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.llm import (centroids, decontamination, html_text, language, line_dedup, near_duplicates, neighbours, pieces, quality,
                          quality_rules, source_audit, toxicity, url_filter)
from loanloom.llm.frames import bucket_of, read_table

Query = Callable[[SparkSession, str], DataFrame]


def labels_outside(spark: SparkSession, sf_dir: str, folds: int, held_out: int) -> DataFrame:
    """Labels of the ids that do not fall into the held-out fold."""
    return read_table(spark, sf_dir, "labels").where(bucket_of(F.col("doc_id"), folds) != held_out)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.overlaps(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_text.extract(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = line_dedup.without_repeated_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


OP3_SQL = """
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place
  from documents),
keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines),
repeated as (
  select key, max(doc_id) as keeper from keyed where length(key) >= 40
  group by key having count(distinct doc_id) >= 5),
judged as (
  select k.*, r.key is not null and k.doc_id <> r.keeper as gone
  from keyed k left join repeated r on k.key = r.key)
select doc_id, count(*) as n_lines, cast(sum(gone::int) as bigint) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not gone), '')) as kept_sha256
from judged group by doc_id
"""


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.classes(read_table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score_rows(docs, quality.fit(docs, labels_outside(spark, sf_dir, 4, 2)))
    return scored.select("doc_id", (bucket_of(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read_table(spark, sf_dir, "embeddings"), k=20, query_step=20)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(bucket_of(F.col("doc_id"), 5) != 0))
    told, _ = language.identify(docs.select("doc_id", "text"), model)
    return told.select("doc_id", (bucket_of(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score", "accepted")


#: The rules of the query: host, path and verdict.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages"), URL_RULES)


def _normal_form_sql(url: str) -> tuple[str, str, str]:
    rest = f"(case when position('://' in {url}) > 0 then substr({url}, position('://' in {url}) + 3) else '' end)"
    host = f"translate(regexp_extract({rest}, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    path = f"regexp_extract({rest}, '(?s)^[^/?#]*([^?#]*)', 1)"
    query = f"regexp_extract({rest}, '(?s)^[^?#]*\\?([^#]*)', 1)"
    kept = f"regexp_replace(regexp_replace({query}, '{url_filter.TRACKING}', '', 'g'), '^&', '')"
    return host, path, f"{host} || regexp_replace({path}, '/+$', '') || case when {kept} <> '' then '?' || {kept} else '' end"


def _sql_text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _op8_sql() -> str:
    host, path, node = _normal_form_sql("coalesce(url, '')")
    _, _, target = _normal_form_sql("whole")
    longest = sorted(URL_RULES, key=lambda r: -len(r[0] + r[1]))
    fits = [f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')" for h, p, _ in longest]
    rule = "case " + " ".join(f"{f} then '{h + p}'" for f, (h, p, _) in zip(fits, longest)) + " end"
    own = "case " + " ".join(f"{f} then '{v}'" for f, (_, _, v) in zip(fits, longest)) + " end"
    return f"""
with recursive named as (select page_id, url, html, {host} as host, {path} as path, nullif({node}, '') as node from pages),
ruled as (select *, {rule} as rule, {own} as own from named),
tags as (
  select url, host, path, node as u, unnest(regexp_extract_all(regexp_replace(html, {_sql_text(url_filter.NOISE)}, ' ', 'g'), {_sql_text(url_filter.TAGS)})) as tag
  from named where node is not null),
targets as (
  select u, url, host, path, replace(case when regexp_matches(tag, {_sql_text(url_filter.CANONICAL)}) then regexp_extract(tag, {_sql_text(url_filter.HREF)}, 1)
         when regexp_matches(tag, {_sql_text(url_filter.REFRESH)}) then regexp_extract(tag, {_sql_text(url_filter.REFRESH_URL)}, 1) end, '&amp;', '&') as target,
         regexp_extract(url, '^([^:/?#]*)://', 1) as scheme
  from tags),
wholes as (
  select u, case when contains(target, '://') then target when starts_with(target, '//') then scheme || ':' || target
              when starts_with(target, '/') then scheme || '://' || host || target
              else scheme || '://' || host || coalesce(nullif(regexp_extract(path, '(?s)^(.*/)', 1), ''), '/') || target end as whole
  from targets where target <> ''),
links as (select u, {target} as v from wholes),
ties as (select u, v from links where u <> '' and v <> '' union select v, u from links where u <> '' and v <> ''),
condemned as (select node from ruled where own = 'block' union select t.v from condemned c join ties t on t.u = c.node)
select page_id, host, path, rule,
       coalesce(own, case when node in (select node from condemned where node is not null) then 'block' end, 'allow') as verdict,
       case when own is not null then 'rule' when node in (select node from condemned where node is not null) then 'alias' else 'none' end as decided_by
from ruled
"""


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_rows(docs, toxicity.fit(docs, labels_outside(spark, sf_dir, 5, 0)))
    return scored.select("doc_id", (bucket_of(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
                         F.size("passages").alias("n_passages"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each sampled segmentation, with a digest of its ids and whether decoding gives the text back.

    A document whose text is null has one row, with null in all columns but its id.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    each = pieces.encode(docs, read_back="restored").select("doc_id", "restored", F.posexplode_outer("segmentations").alias("place", "one"))
    drawn = F.col("one").isNotNull()    # size and hash of null are numbers
    return each.select("doc_id", (F.col("place") + 1).alias("draw"), F.when(drawn, F.size("one.ids")).alias("n_pieces"),
                       F.when(drawn, F.xxhash64("one.ids")).alias("ids_hash"),
                       F.col("one.log_prob").alias("log_prob"), F.col("one.log_inclusion").alias("log_inclusion"), "restored")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels, centres = centroids.clusters(read_table(spark, sf_dir, "embeddings"))
    return centroids.with_inertia(labels, centres).select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _op11_sql() -> str:
    k, rounds = centroids.CENTROIDS, centroids.ROUNDS
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} as materialized (
  select rid, c, distance from (
    select p.rid, c.c, cast(sum((p.x - c.x) * (p.x - c.x)) as bigint) as distance from points p join c{i} c using (d) group by p.rid, c.c)
  qualify row_number() over (partition by rid order by distance, c) = 1)""")
        if i < rounds:
            steps.append(f"""c{i + 1} as materialized (
  select c.c, c.d, coalesce(m.x, c.x) as x from c{i} c left join (
    select a.c, p.d, cast((sum(p.x) - ((sum(p.x) % count(*)) + count(*)) % count(*)) // count(*) as bigint) as x
    from a{i} a join points p using (rid) group by a.c, p.d) m using (c, d))""")
    return f"""
with kept as materialized (
  select row_number() over () as rid, vec_id, [cast(floor({centroids.SCALE} * cast(x as double)) as bigint) for x in embedding] as v
  from embeddings where len(embedding) = {centroids.WIDTH} and len([x for x in embedding if x is not null and isfinite(x)]) = {centroids.WIDTH}),
points as materialized (select rid, unnest(generate_series(1, {centroids.WIDTH})) as d, unnest(v) as x from kept),
start as (select row_number() over (order by sha256('2:' || vec_id), v) - 1 as c, v from kept where vec_id is not null
          qualify row_number() over (order by sha256('2:' || vec_id), v) <= {k}),
c0 as materialized (select c, unnest(generate_series(1, {centroids.WIDTH})) as d, unnest(v) as x from start),
{", ".join(steps)},
digests as (select c, sha256(string_agg(cast(x as varchar), ',' order by d)) as centroid_sha256 from c{rounds} group by c)
select vec_id, cast(a.c as int) as cluster, distance, cast(sum(distance) over (partition by a.c) as bigint) as cluster_inertia,
       cast(sum(distance) over () as bigint) as inertia, centroid_sha256
from a{rounds} a join kept using (rid) join digests g on g.c = a.c
"""


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document; the trees learn from the labels that op5 learns from."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_rules.fit(docs, labels_outside(spark, sf_dir, 4, 2))
    judged, _ = quality_rules.judge(docs, model)
    return judged.select("doc_id", *quality_rules.BASE, "base_failed", "kept", "rule_score")


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(read_table(spark, sf_dir, "documents"))


OP13_SQL = r"""
with docs as materialized (
  select row_number() over () as rid, coalesce(text, '') as text, coalesce(lang, '') as lang, coalesce(source, '') as source from documents),
words as (
  select rid, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as word from docs),
counts as materialized (
  select rid, lang, source, translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term, count(*) as n
  from words group by all),
kept as materialized (
  select lang, term, cast(sum(n) as bigint) as n from counts group by lang, term having count(*) >= 3),
groups as materialized (select distinct lang, source from docs),
sizes as materialized (
  select l.lang, count(k.term) as v, cast(coalesce(sum(k.n), 0) as bigint) as total
  from (select distinct lang from groups) l left join kept k using (lang) group by l.lang),
own as materialized (
  select c.lang, c.source, c.term, cast(sum(c.n) as bigint) as n from counts c join kept using (lang, term) group by c.lang, c.source, c.term),
totals as materialized (
  select g.lang, g.source, cast(coalesce(sum(o.n), 0) as bigint) as total from groups g left join own o using (lang, source) group by g.lang, g.source),
priced as materialized (
  select t.lang, t.source, k.term, coalesce(o.n, 0) as n, 1 + 1000000000 * (coalesce(o.n, 0) + 1) // (t.total + s.v) as p,
         1 + 1000000000 * (k.n + 1) // (s.total + s.v) as q
  from totals t join sizes s using (lang) join kept k using (lang)
  left join own o on o.lang = t.lang and o.source = t.source and o.term = k.term),
pairs as (
  select a.lang, a.source, b.source as item, cast(sum((a.p - b.p) * (a.p - b.p) // b.p) as bigint) as value
  from priced a join priced b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by a.lang, a.source, b.source),
ranked as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(p.value, 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
  union all
  select lang, source, 'term', term, (p - q) * (p - q) // q from priced where n > 0 and p > q)
select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank
from ranked qualify part = 'pair' or rank <= 200
"""


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_decontamination, op2_html_extraction, op3_line_dedup, op4_near_dedup, op5_quality_classifier,
    op6_nearest_neighbours, op7_language_id, op8_url_filter, op9_toxicity, op10_sentencepiece, op11_centroid_clustering,
    op12_quality_rules, op13_source_audit)}
ORACLE_SQL: dict[str, str] = {"op3_line_dedup": OP3_SQL, "op8_url_filter": _op8_sql(), "op11_centroid_clustering": _op11_sql(),
                              "op13_source_audit": OP13_SQL}
