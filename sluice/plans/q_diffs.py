"""Diff and review queries (S-21, W-05, A-15, P-03..P-06, J-03, J-04, A-06, T-05, T-07, S-14, S-15, S-24)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.operators import diffs as D
from sluice.operators import review as V
from sluice.operators import rules as RL
from sluice.plans.oracle import with_ctes
from sluice.plans.registry import register
from sluice.sources.tables import Tables


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _lang_sql(path: str) -> str:
    whens = " ".join(f"WHEN ends_with({path}, {q(sfx)}) THEN {q(lang)}" for sfx, lang in D.LANGUAGE_BY_SUFFIX)
    return f"CASE {whens} ELSE {q(D.DEFAULT_LANGUAGE)} END"


# Numbered from how the diffs are made: a file added whole counts from 1; the two-hunk change keeps a line at 20,
# drops one, and has a second hunk at 900; binary files have no lines.
_FILES = f"""files AS (
  SELECT change_id, doc_id, CAST(row_number() OVER (PARTITION BY change_id ORDER BY doc_id) AS INT) AS file_no,
         CAST(count(*) OVER (PARTITION BY change_id) AS INT) AS n_files, path, {_lang_sql('path')} AS language,
         text, kind, kind = 'binary' AS is_binary, kind = 'rename' AS is_rename,
         CASE kind WHEN 'binary' THEN ''
                   WHEN 'two' THEN '@@ -20,2 +20,' || CAST(n_lines + 1 AS VARCHAR) || ' @@' || chr(10) || '@@ -500 +900,3 @@'
                   ELSE '@@ -0,0 +1,' || CAST(n_lines AS VARCHAR) || ' @@' END AS hunks
  FROM change_files)"""
_LINES = """lines AS (
  SELECT change_id, file_no, path, language, CAST(1 AS INT) AS hunk_no,
         CAST(line + CASE WHEN kind = 'two' THEN 20 ELSE 0 END AS INT) AS line, text
  FROM (SELECT f.change_id, f.file_no, f.path, f.language, f.kind, unnest(p) AS text, generate_subscripts(p, 1) AS line
        FROM (SELECT *, string_split(text, chr(10)) AS p FROM files WHERE NOT is_binary) f)
  UNION ALL
  SELECT change_id, file_no, path, language, CAST(2 AS INT), CAST(n AS INT), t
  FROM files, (VALUES (900, 'tail one'), (902, 'tail two')) v(n, t) WHERE kind = 'two')"""

# The handbook's line rules as a reviewer would type them, for changes in the dev environment.
_RULES_BY_HAND = [
    ("ENV-01", "BLOCKER", "Catalog-per-Env", "", "text", "mlops_staging|mlops_prod", "References another environment's catalog or schema"),
    ("TP-02", "SUGGESTION", "Transform Pattern", "python", "text", r"[.](collect|toPandas|first|count)[(][)]", "Driver action inside transformation logic"),
    ("TP-04", "SUGGESTION", "Transform Pattern", "python", "text", r"sys[.]argv|os[.]environ|os[.]getenv[(]|widgets[.]get[(]",
     "Reads argv, environment or widgets instead of taking a curried parameter"),
    ("SQL-02", "STYLE", "SQL Conventions", "sql python", "lower(text)", r"(order|group)[ \t]+by[ \t]+[0-9]", "Orders or groups by ordinal position"),
    ("SQL-03", "SUGGESTION", "SQL Conventions", "sql python", "lower(text)", r"select[ \t]+[*]", "SELECT * in a production query"),
    ("NM-01", "STYLE", "Naming Conventions", "sql", "text", r"(TABLE|VIEW|table|view)[ \t]+[a-z0-9_.]*[A-Z]", "Table or view name is not snake_case"),
    ("ML-04", "BLOCKER", "ML Model Lifecycle", "yaml", "text", r"""(catalog|schema):[ \t]*["']?[A-Za-z0-9_]*(staging|prod)""",
     "Training config points at another environment"),
    ("SEC-01", "BLOCKER", "PII & Secret Policy", "", "lower(text)", r"""(api[_-]?key|secret|password|passwd|token)[ \t]*[:=][ \t]*["'][^"']{8,}""",
     "Hardcoded secret or credential"),
]


def rule_hits_sql(source: str, columns: str) -> str:
    parts = []
    for i, (rule, severity, topic, langs, subject, pattern, message) in enumerate(_RULES_BY_HAND):
        only = f"language IN ({', '.join(q(x) for x in langs.split())}) AND " if langs else ""
        parts.append(f"SELECT {columns}, {i} AS rule_rank, {q(rule)} AS rule_id, {q(severity)} AS severity, {q(f'Handbook › {topic} › {rule}')} AS citation, "
                     f"{q(message)} AS message FROM {source} WHERE {only}regexp_matches({subject}, {q(pattern)})")
    return "\nUNION ALL\n".join(parts)


def _scan_sql() -> str:
    return "findings AS (\n" + rule_hits_sql("lines", "change_id, file_no, path AS file, line") + ")"


# Rules retrieved for a change: TF-IDF of the handbook's rules over the distinct words of its added lines.
_TOKENS = r"regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+')"
_GROUNDED = f"""rules AS (
  SELECT doc_id, rule_id, title, title || chr(10) || chr(10) || regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS content, citation, severity_hint
  FROM handbook WHERE titled),
rp AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_TOKENS.format('content')}) AS term FROM rules) WHERE term <> '' GROUP BY ALL),
ri AS (SELECT term, CAST(floor(ln(CAST((SELECT count(*) FROM rules) AS DOUBLE) / count(*)) * 1e9 + 0.5) AS BIGINT) AS idf FROM rp GROUP BY term),
ct AS (SELECT DISTINCT change_id, term FROM (
         SELECT change_id, unnest({_TOKENS.format('query_text')}) AS term FROM (
           SELECT c.change_id, coalesce(nullif(x.q, ''), 'coding standards') AS query_text
           FROM (SELECT DISTINCT change_id FROM files) c
           LEFT JOIN (SELECT change_id, string_agg(text, chr(10) ORDER BY file_no, hunk_no, line) AS q FROM lines GROUP BY change_id) x USING (change_id))) WHERE term <> ''),
rs AS (SELECT change_id, rp.doc_id, sum(rp.tf * ri.idf) AS score FROM ct JOIN ri USING (term) JOIN rp USING (term) WHERE ri.idf > 0 GROUP BY ALL),
blocks AS (
  SELECT change_id, string_agg('- ' || rule_id || ' [' || severity_hint || '] (citation: ' || citation || '): ' || content, chr(10) ORDER BY rank) AS rules_block
  FROM (SELECT *, row_number() OVER (PARTITION BY change_id ORDER BY score DESC, doc_id) AS rank FROM rs) JOIN rules USING (doc_id)
  WHERE rank <= 3 GROUP BY change_id)"""


def _sql(body: str, *ctes: str) -> str:
    return with_ctes(["change_files"], "WITH " + ",\n".join(ctes) + "\n" + body)


def _files(t: Tables):
    return D.diff_files(t.changes)


def _lines(t: Tables):
    return D.diff_added_lines(_files(t))


def _findings(t: Tables):
    return V.policy_scan(_lines(t))


def _parsed(t: Tables):
    return D.parsed_diffs(t.changes)


def _reviewed(t: Tables):
    return _parsed(t).select("change_id", V.findings_of(F.col("files")).alias("findings"))


def _rules_blocks(t: Tables, parsed):
    """The three handbook rules nearest to each change's added lines (S-24, T-03, S-11)."""
    rules = RL.parse_rules(t.handbook)
    queries = parsed.select("change_id", V.query_text_of(F.col("files")).alias("query_text"))
    top = RL.text_top_k(rules.select("doc_id", F.col("content").alias("text")), queries.select(F.col("change_id").alias("query_id"), F.col("query_text").alias("text")))
    ids = rules.select("doc_id", "rule_id")
    return V.rules_blocks(top.join(ids, "doc_id").select(F.col("query_id").alias("change_id"), "rank", "rule_id"), rules)


@register("as_added_diff", with_ctes(["change_files"], """
SELECT doc_id, 'diff --git a/' || path || ' b/' || path || chr(10) || '+++ b/' || path || chr(10) || '@@ -0,0 +1,'
       || CAST(CASE WHEN text = '' THEN 0 ELSE len(string_split(body, chr(10))) END AS VARCHAR) || ' @@' || chr(10)
       || CASE WHEN text = '' THEN '' ELSE '+' || replace(body, chr(10), chr(10) || '+') || chr(10) END AS diff
FROM (SELECT doc_id, path, text,
             CASE WHEN ends_with(text, chr(10)) THEN substr(text, 1, length(text) - 1) ELSE text END AS body
      FROM change_files)"""), ids=("S-21",))
def q_as_added_diff(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.change_files.select("doc_id", D.as_added_diff(F.col("path"), F.col("text")).alias("diff"))


@register("diff_files", _sql("""
SELECT change_id, file_no, n_files, path, language, is_binary, is_rename, hunks FROM files""",
                             _FILES), ids=("A-15", "S-02"))
def q_diff_files(spark, sf_dir):
    return _files(Tables(spark, sf_dir)).select("change_id", "file_no", "n_files", "path", "language", "is_binary",
                                                "is_rename", "hunks")


@register("diff_added_lines", _sql("SELECT change_id, file_no, path, hunk_no, line, text FROM lines",
                                   _FILES, _LINES), ids=("W-05",))
def q_diff_added_lines(spark, sf_dir):
    return _lines(Tables(spark, sf_dir)).select("change_id", "file_no", "path", "hunk_no", "line", "text")


@register("file_checks", with_ctes(["change_files"], f"""
SELECT doc_id, path, {_lang_sql('path')} AS language,
       CASE WHEN ends_with(path, '.py') THEN 'ruff' WHEN ends_with(path, '.sql') THEN 'sqlfluff' END AS linter,
       (text IS NOT NULL AND regexp_matches(text, '\\S')) AS content_ok,
       CASE WHEN text IS NOT NULL AND regexp_matches(text, '\\S') THEN '' ELSE 'empty content' END AS content_reason
FROM change_files"""), ids=("P-04", "P-05", "P-06"))
def q_file_checks(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return D.file_checks(t.change_files).select("doc_id", "path", "language", "linter", "content_ok", "content_reason")


@register("policy_scan", _sql("""
SELECT change_id, file_no, file, line, rule_id, severity, citation, message FROM findings""",
                              _FILES, _LINES, _scan_sql()), ids=("J-04",))
def q_policy_scan(spark, sf_dir):
    found = _reviewed(Tables(spark, sf_dir)).select("change_id", F.explode("findings").alias("f"))
    return found.select("change_id", "f.file_no", "f.file", "f.line", "f.rule_id", "f.severity", "f.citation", "f.message")


_GATE = """gate AS (
  SELECT c.change_id,
         CASE WHEN coalesce(n, 0) = 0 THEN 'success' WHEN coalesce(b, 0) > 0 THEN 'failure' ELSE 'neutral' END
           AS conclusion,
         CAST(coalesce(b, 0) AS BIGINT) AS blocker_count, CAST(coalesce(n, 0) AS BIGINT) AS n_findings,
         CASE WHEN coalesce(n, 0) = 0 THEN '""" + V.NO_FINDINGS + """'
              WHEN coalesce(b, 0) > 0 THEN CAST(b AS VARCHAR) || ' blocking of ' || CAST(n AS VARCHAR)
                   || ' finding(s); the change waits until they are fixed.'
              ELSE CAST(n AS VARCHAR) || ' advisory finding(s); the change may be merged.' END AS summary
  FROM (SELECT DISTINCT change_id FROM change_files) c
  LEFT JOIN (SELECT change_id, count(*) AS n, count(*) FILTER (WHERE severity = 'BLOCKER') AS b
             FROM findings GROUP BY change_id) x ON c.change_id = x.change_id)"""


@register("decide_gate", _sql("SELECT * FROM gate", _FILES, _LINES, _scan_sql(), _GATE), ids=("A-06",))
def q_decide_gate(spark, sf_dir):
    return V.gate_of(_reviewed(Tables(spark, sf_dir)))


@register("check_annotations", _sql("""
SELECT change_id, CAST(annotation_no AS INT) AS annotation_no, CAST((annotation_no - 1) // 50 AS INT) AS batch_no, file AS path,
       line AS start_line, line AS end_line,
       CASE severity WHEN 'BLOCKER' THEN 'failure' WHEN 'SUGGESTION' THEN 'warning' ELSE 'notice' END AS annotation_level,
       severity || ' ' || rule_id AS title, message || chr(10) || chr(10) || 'Source: ' || citation AS message
FROM (SELECT *, row_number() OVER (PARTITION BY change_id ORDER BY file_no, line, rule_rank) AS annotation_no
      FROM findings)""", _FILES, _LINES, _scan_sql()), ids=("T-05", "W-06"))
def q_check_annotations(spark, sf_dir):
    return V.check_annotations(_findings(Tables(spark, sf_dir)))


@register("check_runs", _sql(f"""
SELECT g.change_id, g.conclusion,
       CASE g.conclusion WHEN 'failure' THEN '{V.CHECK_TITLES['failure']}' WHEN 'neutral'
            THEN '{V.CHECK_TITLES['neutral']}' ELSE '{V.CHECK_TITLES['success']}' END AS title,
       g.summary || CASE WHEN coalesce(a.n, 0) > 50
            THEN chr(10) || chr(10) || CAST(a.n - 50 AS VARCHAR) || ' finding(s) follow after the first 50.' ELSE '' END AS summary,
       CAST(coalesce(a.n, 0) AS BIGINT) AS n_annotations, CAST(greatest(coalesce(a.n, 0) - 50, 0) AS BIGINT) AS n_overflow
FROM gate g LEFT JOIN (SELECT change_id, count(*) AS n FROM findings GROUP BY change_id) a
  ON g.change_id = a.change_id""", _FILES, _LINES, _scan_sql(), _GATE), ids=("T-05",))
def q_check_runs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    findings = _findings(t)
    return V.check_runs(V.decide_gate(t.changes, findings), findings)


@register("render_comment", _sql("""
SELECT c.change_id, '""" + V.COMMENT_TITLE + """' || chr(10) || chr(10)
       || CASE c.change_id % 3 WHEN 0 THEN 'Change ' || CAST(c.change_id AS VARCHAR) || ' was read.' || chr(10) || chr(10) ELSE '' END
       || CASE WHEN x.n IS NULL THEN '""" + V.NO_FINDINGS + """'
            ELSE x.body || chr(10) || '---' || chr(10) || 'Findings: ' || CAST(x.n AS VARCHAR) || ', blocking: ' || CAST(x.nb AS VARCHAR)
                 || '. Only blocking ones stop a merge.' END AS comment
FROM (SELECT DISTINCT change_id FROM change_files) c
LEFT JOIN (
  SELECT change_id, count(*) AS n, count(*) FILTER (WHERE severity = 'BLOCKER') AS nb,
         string_agg(concat_ws(chr(10),
             '### ' || CASE severity WHEN 'BLOCKER' THEN '🔴' WHEN 'SUGGESTION' THEN '🟡' ELSE '⚪' END || ' '
               || severity || ' `' || file || ':' || CAST(line AS VARCHAR) || '` ' || rule_id,
             message, 'Source: ' || citation, ''), chr(10)
           ORDER BY CASE severity WHEN 'BLOCKER' THEN 0 WHEN 'SUGGESTION' THEN 1 ELSE 2 END, file_no, line, rule_rank)
           AS body
  FROM findings GROUP BY change_id) x ON c.change_id = x.change_id""", _FILES, _LINES, _scan_sql()), ids=("T-07",))
def q_render_comment(spark, sf_dir):
    t = Tables(spark, sf_dir)
    # a review's summary: none, blank, or a sentence
    c = F.col("change_id")
    said = F.when(c % 3 == 0, F.concat(F.lit(" Change "), c.cast("string"), F.lit(" was read.\n"))).when(c % 3 == 1, F.lit(" \n"))
    return V.comment_of(_reviewed(t).withColumn("review_summary", said))


@register("select_fixable", _sql("""
SELECT change_id, file, CAST(count(*) AS BIGINT) AS n_findings FROM findings f
WHERE file IS NOT NULL AND file <> '' AND NOT starts_with(file, '/') AND NOT contains(file, '..')
  AND EXISTS (SELECT 1 FROM files c WHERE c.change_id = f.change_id AND c.path = f.file)
GROUP BY change_id, file""", _FILES, _LINES, _scan_sql()), ids=("J-03", "S-02"))
def q_select_fixable(spark, sf_dir):
    t = Tables(spark, sf_dir)
    fixable = V.select_fixable(_findings(t), _files(t))
    return fixable.groupBy("change_id", "file").agg(F.count(F.lit(1)).cast("bigint").alias("n_findings"))


@register("fix_prompts", with_ctes(["change_files", "handbook"], "WITH " + ",\n".join([_FILES, _LINES, _scan_sql(), _GROUNDED]) + f"""
SELECT x.change_id, x.file AS path, CAST(x.n AS BIGINT) AS n_findings, {q(V.FIX_SYSTEM)} AS system,
       'PATH' || chr(10) || x.file || chr(10) || chr(10) || 'RULES' || chr(10) || coalesce(k.rules_block, '(those that the findings cite)')
       || chr(10) || chr(10) || 'FINDINGS' || chr(10) || x.issues || chr(10) || chr(10) || 'FILE' || chr(10) || '```' || chr(10)
       || coalesce(c.text, '') || chr(10) || '```' || chr(10) || chr(10) || 'Answer with the whole repaired file in one code block.' AS prompt
FROM (SELECT change_id, file, count(*) AS n,
             string_agg('- L' || CAST(line AS VARCHAR) || ' [' || severity || '] ' || rule_id
                        || ': ' || message, chr(10) ORDER BY line, rule_rank) AS issues
      FROM findings f WHERE NOT starts_with(file, '/') AND NOT contains(file, '..')
        AND EXISTS (SELECT 1 FROM files c WHERE c.change_id = f.change_id AND c.path = f.file)
      GROUP BY change_id, file) x
LEFT JOIN files c ON c.change_id = x.change_id AND c.path = x.file LEFT JOIN blocks k ON k.change_id = x.change_id"""), ids=("S-15",))
def q_fix_prompts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    lines = _lines(t)
    return V.fix_prompts(V.select_fixable(V.policy_scan(lines), _files(t)), t.change_files, blocks=_rules_blocks(t, _parsed(t)))


@register("review_prompts", with_ctes(["change_files", "handbook"], "WITH " + ",\n".join([_FILES, _LINES, _GROUNDED]) + f""",
numbered AS (SELECT *, (row_number() OVER (PARTITION BY change_id, file_no ORDER BY hunk_no, line) - 1) // 200 + 1 AS part_no FROM lines),
shown AS (SELECT change_id, file_no, part_no, string_agg('  L' || CAST(line AS VARCHAR) || ': ' || text, chr(10) ORDER BY hunk_no, line) AS added
          FROM numbered GROUP BY ALL),
held AS (SELECT f.change_id, f.file_no, 1 AS part_no FROM files f UNION SELECT change_id, file_no, part_no FROM shown),
parts AS (
  SELECT h.change_id, h.part_no, string_agg('### ' || f.path || CASE WHEN f.is_binary THEN ' (binary)'
           ELSE ' (' || f.language || ')' || chr(10) || coalesce(s.added, '') END, chr(10) || chr(10) ORDER BY h.file_no) AS body
  FROM held h JOIN files f USING (change_id, file_no) LEFT JOIN shown s USING (change_id, file_no, part_no) GROUP BY h.change_id, h.part_no)
SELECT p.change_id, CAST(p.part_no AS INT) AS part_no, CAST(n AS INT) AS n_parts, {q(V.REVIEW_SYSTEM)} AS system,
       'RULES' || chr(10) || coalesce(k.rules_block, '(no rule was retrieved)') || chr(10) || chr(10) || 'ADDED LINES, PART '
       || CAST(p.part_no AS VARCHAR) || ' OF ' || CAST(n AS VARCHAR) || chr(10) || p.body || chr(10) || chr(10)
       || 'Answer with the findings as JSON.' AS prompt
FROM (SELECT *, max(part_no) OVER (PARTITION BY change_id) AS n FROM parts) p LEFT JOIN blocks k USING (change_id)"""), ids=("S-14", "W-08"))
def q_review_prompts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    parsed = _parsed(t)
    return V.prompts_of(parsed.join(_rules_blocks(t, parsed), "change_id", "left"))


@register("change_query_text", _sql("""
SELECT c.change_id, coalesce(nullif(q.q, ''), 'coding standards') AS query_text
FROM (SELECT DISTINCT change_id FROM files) c
LEFT JOIN (SELECT change_id, string_agg(text, chr(10) ORDER BY file_no, hunk_no, line) AS q FROM lines GROUP BY change_id) q
  ON c.change_id = q.change_id""", _FILES, _LINES), ids=("S-24",))
def q_change_query_text(spark, sf_dir):
    return _parsed(Tables(spark, sf_dir)).select("change_id", V.query_text_of(F.col("files")).alias("query_text"))


_PERMS = ["read", "triage", "write", "maintain", "admin"]


@register("fix_authorization", f"""
SELECT conv_id, turn, permission, branch_is_protected,
       CASE WHEN branch_is_protected THEN false ELSE permission IN ('write', 'maintain', 'admin') END AS authorized,
       CASE WHEN branch_is_protected THEN 'Protected branch: fixes are not pushed to it.'
            WHEN permission IN ('write', 'maintain', 'admin') THEN ''
            ELSE 'Role ''' || permission || ''' may not push; one of write, maintain, admin is needed.' END AS reason
FROM (SELECT conv_id, turn, {str(_PERMS).replace('"', "'")}[CAST(conv_id % 5 + 1 AS INT)] AS permission,
             turn % 4 = 0 AS branch_is_protected FROM conversations)""", ids=("P-03",))
def q_fix_authorization(spark, sf_dir):
    conv = Tables(spark, sf_dir).conversations
    perms = F.array(*[F.lit(p) for p in _PERMS])
    req = conv.select("conv_id", "turn", F.element_at(perms, (F.col("conv_id") % 5 + 1).cast("int")).alias("permission"),
                      (F.col("turn") % 4 == 0).alias("branch_is_protected"))
    return V.fix_authorization(req)
