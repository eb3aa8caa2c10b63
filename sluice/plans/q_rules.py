"""Rule documents and retrieval queries (S-11, S-12, ST-03 batch, T-02, T-03, A-14, IO-10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.operators import rules as RL
from sluice.operators.promotion import DEFAULT_ML_RULES
from sluice.plans.oracle import with_ctes
from sluice.plans.registry import register
from sluice.sources.tables import Tables


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


_LINES = r"""rl AS (
  SELECT doc_id, category, ln_no, ln, is_head,
         sum(CASE WHEN is_head THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY ln_no) AS rule_no
  FROM (SELECT doc_id, category, ln_no, ln, regexp_matches(ln, '^###\s+\[[A-Z]+-[0-9]+\]\s+\S') AS is_head
        FROM (SELECT doc_id, category, generate_subscripts(p, 1) AS ln_no, unnest(p) AS ln
              FROM (SELECT doc_id, category, string_split(block, chr(10)) AS p FROM rule_docs)))),
blocks AS (
  SELECT doc_id, category, CAST(rule_no AS INT) AS rule_no, max(CASE WHEN is_head THEN ln END) AS heading,
         coalesce(string_agg(CASE WHEN NOT is_head THEN ln END, chr(10) ORDER BY ln_no), '') AS body_text
  FROM rl WHERE rule_no > 0 GROUP BY doc_id, category, rule_no)"""

_HEAD = r"'^###\s+\[([A-Z]+-[0-9]+)\]\s+(.+?)\s*$'"


def _parse_sql() -> str:
    sev = strip_sql(r"regexp_extract(b.body_text, '-\s+\*\*Severity:\*\*\s+(.+)', 1)")
    cit = strip_sql(r"regexp_extract(b.body_text, '-\s+\*\*Citation:\*\*\s+(.+)', 1)")
    title = strip_sql(f"regexp_extract(b.heading, {_HEAD}, 2)")
    rid = f"regexp_extract(b.heading, {_HEAD}, 1)"
    body = strip_sql(f"""coalesce((SELECT string_agg(r.ln, chr(10) ORDER BY r.ln_no) FROM rl r
        WHERE r.doc_id = b.doc_id AND r.rule_no = b.rule_no AND NOT r.is_head
          AND NOT starts_with({strip_sql('r.ln')}, '- **Severity:**')
          AND NOT starts_with({strip_sql('r.ln')}, '- **Citation:**')), '')""")
    return f"""parsed AS (
  SELECT b.doc_id, b.rule_no, {rid} AS rule_id, {title} AS title, {title} || chr(10) || chr(10) || {body} AS content,
         CASE WHEN {cit} <> '' THEN {cit} ELSE 'Handbook › ' || b.category || ' › ' || {rid} END AS citation,
         b.category, upper(CASE WHEN {sev} <> '' THEN {sev} ELSE 'SUGGESTION' END) AS severity_hint
  FROM blocks b)"""


def _sql(body: str, *ctes: str) -> str:
    return with_ctes(["rule_docs"], "WITH " + ",\n".join(ctes) + "\n" + body)


@register("parse_rules", _sql("SELECT * FROM parsed", _LINES, _parse_sql()), ids=("S-11",))
def q_parse_rules(spark, sf_dir):
    return RL.parse_rules(Tables(spark, sf_dir).rule_docs)


_SEV_PAT = r"'\*\*Severity:\*\*\s*(BLOCKER|SUGGESTION|STYLE)'"
_CIT_PAT = r"'\*\*Citation:\*\*\s*(.+)'"


def _compact_sql() -> str:
    s = strip_sql("ln")
    return rf"""compact AS (
  SELECT b.doc_id, b.rule_no, regexp_extract(b.heading, '^###\s+\[([A-Z]+-[0-9]+)\]\s+(.+)$', 1) AS rule_id,
         {strip_sql(r"regexp_extract(b.heading, '^###\s+\[([A-Z]+-[0-9]+)\]\s+(.+)$', 2)")} AS title,
         x.sev, x.cit, x.body
  FROM blocks b LEFT JOIN (
    SELECT doc_id, rule_no,
           arg_max(regexp_extract(ln, {_SEV_PAT}, 1), ln_no) FILTER (WHERE regexp_matches(ln, {_SEV_PAT})) AS sev,
           arg_max({strip_sql(f"regexp_extract(ln, {_CIT_PAT}, 1)")}, ln_no)
             FILTER (WHERE NOT regexp_matches(ln, {_SEV_PAT}) AND regexp_matches(ln, {_CIT_PAT})) AS cit,
           {strip_sql(f'''coalesce(string_agg({s}, ' ' ORDER BY ln_no) FILTER (
               WHERE NOT regexp_matches(ln, {_SEV_PAT}) AND NOT regexp_matches(ln, {_CIT_PAT})
                 AND {s} <> '' AND NOT starts_with({s}, '❌') AND NOT starts_with({s}, '✅')
                 AND NOT starts_with({s}, '-') AND NOT contains(ln, '**Severity:**')
                 AND NOT contains(ln, '**Citation:**')), '')''')} AS body
    FROM rl WHERE rule_no > 0 AND NOT is_head GROUP BY doc_id, rule_no) x
  ON b.doc_id = x.doc_id AND b.rule_no = x.rule_no),
lines_c AS (
  SELECT doc_id, rule_no, rule_id,
         '- ' || rule_id || ' [' || coalesce(nullif(sev, ''), 'SUGGESTION') || '] (Citation: '
         || CASE WHEN coalesce(cit, '') <> '' THEN cit ELSE 'Handbook › ML Model Lifecycle › ' || rule_id END
         || '): ' || CASE WHEN coalesce(body, '') = '' THEN title ELSE body END AS rule_line
  FROM compact)"""


@register("compact_rules", _sql("SELECT doc_id, rule_no, rule_id, rule_line FROM lines_c", _LINES, _compact_sql()),
          ids=("S-12",))
def q_compact_rules(spark, sf_dir):
    return RL.compact_rules(Tables(spark, sf_dir).rule_docs)


@register("rules_text", _sql(f"""
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_rules, coalesce(t, {q(DEFAULT_ML_RULES)}) AS rules_text
FROM rule_docs d LEFT JOIN (SELECT doc_id, count(*) AS n, string_agg(rule_line, chr(10) ORDER BY rule_no) AS t
                            FROM lines_c GROUP BY doc_id) x ON d.doc_id = x.doc_id""", _LINES, _compact_sql()),
          ids=("S-12",))
def q_rules_text(spark, sf_dir):
    docs = Tables(spark, sf_dir).rule_docs
    return RL.rules_text(docs, DEFAULT_ML_RULES)


def _snapshots(t: Tables):
    rules = RL.parse_rules(t.rule_docs)
    old = (rules.where(F.col("doc_id") % 40 != 10)
           .withColumn("content", F.when(F.col("doc_id") % 30 == 0, F.concat("content", F.lit(" (v1)")))
                       .otherwise(F.col("content"))))
    new = rules.where(F.col("doc_id") % 40 != 20)
    return old, new


def _hash_sql(alias: str) -> str:
    cols = ", ".join(f"coalesce({alias}.{c}, '')" for c in ("title", "content", "citation", "category", "severity_hint"))
    return f"sha256(concat_ws(chr(1), {cols}))"


@register("index_change_set", _sql(f"""
SELECT coalesce(o.rule_id, n.rule_id) AS rule_id,
       CASE WHEN o.h IS NULL THEN 'insert' WHEN n.h IS NULL THEN 'delete' WHEN o.h <> n.h THEN 'update' END AS op,
       o.h AS old_hash, n.h AS new_hash
FROM (SELECT rule_id, {_hash_sql('p')} AS h FROM (
        SELECT doc_id, rule_id, title, CASE WHEN doc_id % 30 = 0 THEN content || ' (v1)' ELSE content END AS content,
               citation, category, severity_hint FROM parsed WHERE doc_id % 40 <> 10) p) o
FULL OUTER JOIN (SELECT rule_id, {_hash_sql('p')} AS h FROM parsed p WHERE doc_id % 40 <> 20) n
  ON o.rule_id = n.rule_id
WHERE o.h IS NULL OR n.h IS NULL OR o.h <> n.h""", _LINES, _parse_sql()), ids=("ST-03",))
def q_index_change_set(spark, sf_dir):
    old, new = _snapshots(Tables(spark, sf_dir))
    return RL.index_change_set(old, new)


_TOKENS = r"regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')"
_TEXT_TOPK = rf"""post AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_TOKENS}) AS term FROM documents)
  WHERE term <> '' GROUP BY doc_id, term),
idf AS (SELECT term, CAST(floor(ln(CAST((SELECT count(*) FROM documents) AS DOUBLE) / count(*)) * 1e9 + 0.5) AS BIGINT) AS idf
        FROM post GROUP BY term),
qt AS (SELECT DISTINCT item_id AS query_id, term FROM (SELECT item_id, unnest({_TOKENS}) AS term FROM benchmark)
       WHERE term <> ''),
sc AS (SELECT qt.query_id, post.doc_id, sum(post.tf * idf.idf) AS score
       FROM qt JOIN idf ON qt.term = idf.term JOIN post ON post.term = qt.term WHERE idf.idf > 0
       GROUP BY qt.query_id, post.doc_id),
top AS (SELECT query_id, CAST(rank AS INT) AS rank, doc_id, CAST(score AS DOUBLE) / 1e9 AS score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM sc)
        WHERE rank <= 3)"""


def _text_top(t: Tables):
    queries = t.benchmark.select(F.col("item_id").alias("query_id"), "text")
    return RL.text_top_k(t.documents.select("doc_id", "text"), queries, k=3)


@register("text_top_k", "WITH " + _TEXT_TOPK + "\nSELECT * FROM top", ids=("T-03",))
def q_text_top_k(spark, sf_dir):
    return _text_top(Tables(spark, sf_dir))


_VEC = """vq AS (
  SELECT label AS query_id, CAST(list(s ORDER BY i) AS DOUBLE[]) AS qv
  FROM (SELECT label, i, sum(CAST(floor(CAST(x AS DOUBLE) * 1000000.0 + 0.5) AS BIGINT)) AS s
        FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
        GROUP BY label, i)
  GROUP BY label),
vs AS (SELECT vq.query_id, e.vec_id AS match_id,
              list_dot_product(vq.qv, CAST(e.embedding AS DOUBLE[]))
              / (sqrt(list_dot_product(vq.qv, vq.qv))
                 * sqrt(list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])))) AS cosine
       FROM vq CROSS JOIN embeddings e WHERE list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) > 0),
vtop AS (SELECT query_id, CAST(rank AS INT) AS rank, match_id, CAST(CAST(cosine AS DECIMAL(20,6)) AS DOUBLE) AS score
         FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, match_id) AS rank FROM vs)
         WHERE rank <= 3)"""


def _vec_top(t: Tables):
    """Nearest vectors to each label's centroid (queries derived from the whole table)."""
    emb = t.embeddings
    cent = RL.label_centroids(emb).select(F.col("query_id").alias("vec_id"), "embedding")
    return RL.vector_top_k(emb.select("vec_id", "embedding"), cent, exclude_self=False)


@register("vector_top_k", "WITH " + _VEC + "\nSELECT * FROM vtop", ids=("T-02",))
def q_vector_top_k(spark, sf_dir):
    return _vec_top(Tables(spark, sf_dir))


@register("vector_neighbours", """
SELECT query_id, CAST(rank AS INT) AS rank, match_id, CAST(CAST(cosine AS DECIMAL(20,6)) AS DOUBLE) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, match_id) AS rank
      FROM (SELECT a.vec_id AS query_id, b.vec_id AS match_id,
                   list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))
                   / (sqrt(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[])))
                      * sqrt(list_dot_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])))) AS cosine
            FROM embeddings a JOIN embeddings b ON b.vec_id <> a.vec_id WHERE a.vec_id % 20 = 0))
WHERE rank <= 3""", ids=("T-02",))
def q_vector_neighbours(spark, sf_dir):
    emb = Tables(spark, sf_dir).embeddings.select("vec_id", "embedding")
    return RL.vector_top_k(emb, emb.where(F.col("vec_id") % 20 == 0))


@register("retrieval_checks", "WITH " + _VEC + ",\n" + _TEXT_TOPK + """
SELECT 'vector_label_in_top3' AS check_name, CAST(v.query_id AS BIGINT) AS query_id,
       bool_or(CAST(m.label AS VARCHAR) = CAST(v.query_id AS VARCHAR)) AS passed
FROM vtop v JOIN embeddings m ON m.vec_id = v.match_id
GROUP BY v.query_id
UNION ALL
SELECT 'text_top1_contains_passage', b.item_id, coalesce(contains(d.text, b.text), false)
FROM benchmark b LEFT JOIN top t ON t.query_id = b.item_id AND t.rank = 1 LEFT JOIN documents d ON d.doc_id = t.doc_id
""", ids=("A-14",))
def q_retrieval_checks(spark, sf_dir):
    t = Tables(spark, sf_dir)
    emb = t.embeddings.select("vec_id", F.col("label").cast("string").alias("label"))
    vtop = _vec_top(t).join(emb.withColumnRenamed("vec_id", "match_id").withColumnRenamed("label", "match"),
                            "match_id")
    expected = emb.select(F.col("label").alias("query_id")).distinct().select(
        "query_id", F.lit(None).cast("string").alias("expect_exact"),
        F.col("query_id").cast("string").alias("expect_prefix"))
    vec = RL.retrieval_checks(vtop, expected).select(F.lit("vector_label_in_top3").alias("check_name"),
                                                     F.col("query_id").cast("bigint").alias("query_id"), "passed")
    queries = t.benchmark.select(F.col("item_id").alias("query_id"), "text")
    txt = RL.text_retrieval_checks(_text_top(t), t.documents.select("doc_id", "text"), queries).select(
        F.lit("text_top1_contains_passage").alias("check_name"), "query_id", "passed")
    return vec.unionByName(txt)


@register("retrieval_exact", """
SELECT query_id, CAST(top1 AS VARCHAR) AS top1, CASE WHEN query_id % 40 = 0 THEN CAST(expected AS VARCHAR) END AS expect_exact,
       CASE WHEN query_id % 40 <> 0 THEN substr(CAST(expected AS VARCHAR), 1, 1) END AS expect_prefix,
       CASE WHEN query_id % 40 = 0 THEN top1 = expected ELSE prefixed END AS passed
FROM (SELECT query_id, query_id + CASE WHEN query_id % 120 = 0 THEN 1 ELSE 0 END AS expected, arg_min(match_id, rank) AS top1,
             bool_or(starts_with(CAST(match_id AS VARCHAR), substr(CAST(query_id AS VARCHAR), 1, 1))) AS prefixed
      FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, match_id) AS rank
            FROM (SELECT a.vec_id AS query_id, b.vec_id AS match_id,
                         list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))
                         / (sqrt(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[])))
                            * sqrt(list_dot_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])))) AS cosine
                  FROM embeddings a JOIN embeddings b ON true WHERE a.vec_id % 20 = 0))
      WHERE rank <= 3 GROUP BY query_id)""", ids=("A-14",))
def q_retrieval_exact(spark, sf_dir):
    # every twentieth vector looks itself up: half by exact id (a third of these expect the wrong one), half by the id's first digit
    emb = Tables(spark, sf_dir).embeddings.select("vec_id", "embedding")
    queries = emb.where(F.col("vec_id") % 20 == 0)
    top = RL.vector_top_k(emb, queries, exclude_self=False).withColumn("match", F.col("match_id").cast("string"))
    v = F.col("vec_id")
    expected = (v + (v % 120 == 0).cast("int")).cast("string")
    exact = v % 40 == 0
    wanted = queries.select(v.alias("query_id"), F.when(exact, expected).alias("expect_exact"), F.when(~exact, F.substring(expected, 1, 1)).alias("expect_prefix"))
    return RL.retrieval_checks(top, wanted)
