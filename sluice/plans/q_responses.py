"""Stored model responses (S-16..S-20)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.operators import responses as RS
from sluice.plans.oracle import with_ctes
from sluice.plans.registry import register
from sluice.sources.tables import Tables

# What each stored shape must decode to, stated from how it was made: a key that stands twice keeps its last
# value, a cut text is closed, a bad enum or a line end stays in the string.
_DECODE = r"""dec AS (
  SELECT response_id, truth, raw,
         CASE shape WHEN 3 THEN raw || '"}' WHEN 4 THEN NULL WHEN 5 THEN raw WHEN 7 THEN raw ELSE j END AS j,
         CASE WHEN shape IN (0, 1, 5, 7) THEN 'direct' WHEN shape <> 4 THEN 'recovered' END AS decoded_by
  FROM responses),
dd AS (
  SELECT *, upper(regexp_replace(json_extract_string(j, '$.decision'), '^\s+|\s+$', '', 'g')) AS said FROM dec)"""


@register("tolerant_json", with_ctes(["responses"], "WITH " + _DECODE + """
SELECT response_id, decoded_by, json_extract_string(j, '$.decision') AS decision_raw FROM dec"""), ids=("S-16",))
def q_tolerant_json(spark, sf_dir):
    df = RS.tolerant_json(Tables(spark, sf_dir).responses)
    return df.select("response_id", "decoded_by", F.try_variant_get("json", "$.decision", "string").alias("decision_raw"))


@register("parse_decisions", with_ctes(["responses"], "WITH " + _DECODE + f"""
SELECT response_id, truth, j IS NOT NULL AS parsed, CASE WHEN said IN ('APPROVE', 'BLOCK') THEN said ELSE 'BLOCK' END AS decision,
       CAST(coalesce(json_array_length(j, '$.findings'), 0) AS BIGINT) AS n_findings,
       CASE WHEN j IS NULL THEN '{RS.UNREADABLE}' || coalesce(raw, '') ELSE json_extract_string(j, '$.justification') END AS justification
FROM dd"""), ids=("S-17",))
def q_parse_decisions(spark, sf_dir):
    df = RS.parse_decisions(Tables(spark, sf_dir).responses)
    return df.select("response_id", "truth", "parsed", "decision",
                     F.size("findings").cast("bigint").alias("n_findings"), "justification")


@register("decision_findings", with_ctes(["responses"], "WITH " + _DECODE + """
SELECT response_id, CAST(n - 1 AS INT) AS finding_no,
       coalesce(json_extract_string(f, '$.rule_id'), 'UNKNOWN') AS rule_id,
       upper(coalesce(json_extract_string(f, '$.severity'), 'SUGGESTION')) AS severity,
       coalesce(json_extract_string(f, '$.message'), '') AS message
FROM (SELECT response_id, unnest(json_extract(j, '$.findings[*]')) AS f,
             generate_subscripts(json_extract(j, '$.findings[*]'), 1) AS n
      FROM dec WHERE j IS NOT NULL AND json_type(j) = 'OBJECT')
WHERE json_type(f) = 'OBJECT'"""), ids=("S-17", "Q12", "Q13"))
def q_decision_findings(spark, sf_dir):
    df = RS.parse_decisions(Tables(spark, sf_dir).responses)
    return df.select("response_id", F.posexplode("findings").alias("finding_no", "f")).select(
        "response_id", "finding_no", "f.rule_id", "f.severity", "f.message")


def review_responses(labels):
    """Stored reviewer responses in four wrappers with valid and invalid findings."""
    d = F.col("doc_id")
    line = (F.when(d % 3 == 0, (d % 50).cast("string")).when(d % 3 == 1, F.concat(F.lit('"'), (d % 50).cast("string"),
                                                                                   F.lit('"')))
            .otherwise(F.lit('"n/a"')))
    sev = F.when(d % 5 == 0, "bad").when(d % 2 == 0, "blocker").otherwise("SUGGESTION")
    finding = F.concat(F.lit('{"file": "src/d'), d.cast("string"), F.lit('.py", "line": '), line,
                       F.lit(', "severity": "'), sev, F.lit('", "rule_id": "TP-0'), (d % 4 + 1).cast("string"),
                       F.lit('", "citation": "Handbook", "message": '),
                       F.when(d % 7 == 0, F.lit('""')).otherwise(F.lit('"found"')),
                       F.when(F.col("toxic") == 1, F.lit(', "suggestion": "fix it"')).otherwise(F.lit("")), F.lit("}"))
    arr = F.concat(F.lit("["), finding, F.lit(", 42]"))
    k = d % 4
    raw = (F.when(k == 0, F.concat(F.lit('{"summary": "doc '), d.cast("string"), F.lit('", "findings": '), arr,
                                   F.lit("}")))
           .when(k == 1, arr)
           .when(k == 2, F.concat(F.lit("Here you go:\n```json\n{\"summary\": \"s\", \"findings\": "), arr,
                                  F.lit("}\n```\ntrailing } junk")))
           .otherwise(F.lit("not json at all")))
    return labels.select(d.alias("response_id"), raw.alias("raw"))


_REVIEW_SQL = r"""rr AS (
  SELECT doc_id AS response_id, CASE doc_id % 4
      WHEN 0 THEN '{"summary": "doc ' || CAST(doc_id AS VARCHAR) || '", "findings": ' || arr || '}'
      WHEN 1 THEN arr
      WHEN 2 THEN 'Here you go:' || chr(10) || '```json' || chr(10) || '{"summary": "s", "findings": ' || arr || '}'
                  || chr(10) || '```' || chr(10) || 'trailing } junk'
      ELSE 'not json at all' END AS raw
  FROM (SELECT doc_id, '[' || '{"file": "src/d' || CAST(doc_id AS VARCHAR) || '.py", "line": '
               || CASE WHEN doc_id % 3 = 0 THEN CAST(doc_id % 50 AS VARCHAR)
                       WHEN doc_id % 3 = 1 THEN '"' || CAST(doc_id % 50 AS VARCHAR) || '"' ELSE '"n/a"' END
               || ', "severity": "' || CASE WHEN doc_id % 5 = 0 THEN 'bad' WHEN doc_id % 2 = 0 THEN 'blocker'
                                            ELSE 'SUGGESTION' END
               || '", "rule_id": "TP-0' || CAST(doc_id % 4 + 1 AS VARCHAR)
               || '", "citation": "Handbook", "message": ' || CASE WHEN doc_id % 7 = 0 THEN '""' ELSE '"found"' END
               || CASE WHEN toxic = 1 THEN ', "suggestion": "fix it"' ELSE '' END || '}' || ', 42]' AS arr
        FROM labels)),
rj AS (
  SELECT response_id, CASE WHEN json_valid(raw) THEN raw
                           WHEN json_valid(regexp_extract(raw, '\{[^{}]*\[\{[^{}]*\}, 42\]\}', 0))
                             THEN regexp_extract(raw, '\{[^{}]*\[\{[^{}]*\}, 42\]\}', 0) END AS j
  FROM rr)"""


@register("parse_findings", "WITH " + _REVIEW_SQL + """
SELECT response_id, CAST(n - 1 AS INT) AS finding_no, json_extract_string(f, '$.file') AS file,
       CASE WHEN json_type(f, '$.line') IN ('BIGINT', 'UBIGINT') THEN CAST(json_extract(f, '$.line') AS BIGINT)
            WHEN json_type(f, '$.line') = 'VARCHAR' AND regexp_matches(json_extract_string(f, '$.line'), '^[0-9]+$')
              THEN CAST(json_extract_string(f, '$.line') AS BIGINT) END AS line,
       upper(json_extract_string(f, '$.severity')) AS severity, json_extract_string(f, '$.rule_id') AS rule_id,
       json_extract_string(f, '$.citation') AS citation, json_extract_string(f, '$.message') AS message,
       nullif(json_extract_string(f, '$.suggestion'), '') AS suggestion, nullif(json_extract_string(f, '$.patch'), '')
         AS patch
FROM (SELECT response_id, unnest(items) AS f, generate_subscripts(items, 1) AS n
      FROM (SELECT response_id, CASE WHEN json_type(j) = 'OBJECT' THEN json_extract(j, '$.findings[*]')
                                     WHEN json_type(j) = 'ARRAY' THEN json_extract(j, '$[*]') END AS items
            FROM rj WHERE j IS NOT NULL))
WHERE json_type(f) = 'OBJECT'
  AND coalesce(json_extract_string(f, '$.file'), '') <> '' AND coalesce(json_extract_string(f, '$.severity'), '') <> ''
  AND coalesce(json_extract_string(f, '$.rule_id'), '') <> '' AND coalesce(json_extract_string(f, '$.citation'), '') <> ''
  AND coalesce(json_extract_string(f, '$.message'), '') <> ''
  AND upper(json_extract_string(f, '$.severity')) IN ('BLOCKER', 'SUGGESTION', 'STYLE')""", ids=("S-18",))
def q_parse_findings(spark, sf_dir):
    return RS.parse_findings(review_responses(Tables(spark, sf_dir).labels))


@register("review_summary", "WITH " + _REVIEW_SQL + """
SELECT response_id, CASE WHEN json_type(j) = 'OBJECT' THEN coalesce(json_extract_string(j, '$.summary'), '') ELSE '' END
         AS summary
FROM rj""", ids=("S-18",))
def q_review_summary(spark, sf_dir):
    return RS.review_summary(review_responses(Tables(spark, sf_dir).labels))


def payloads(conversations):
    """Serving payloads per conversation turn, by ``turn % 5``: typed and plain content elements, a plain string
    content, several chat choices, and neither."""
    text = F.col("text")
    typed = F.struct(F.lit("output_text").alias("type"), text.alias("text"))
    choice = F.struct(F.struct(text.alias("content")).alias("message"))
    second = F.struct(F.struct(F.lit("second").alias("content")).alias("message"))
    shapes = [
        F.to_json(F.struct(F.array(F.struct(F.array(typed).alias("content"))).alias("output"))),
        F.to_json(F.struct(F.array(F.struct(F.array(F.lit("plain"), text).alias("content"))).alias("output"))),
        F.to_json(F.struct(F.array(F.struct(text.alias("content"))).alias("output"))),
        F.to_json(F.struct(F.array(choice, second).alias("choices"))),
    ]
    out = F.lit("{}")
    for k, shape in enumerate(shapes):
        out = F.when(F.col("turn") % 5 == k, shape).otherwise(out)
    return conversations.select("conv_id", "turn", out.alias("payload"))


@register("response_text", r"""
SELECT conv_id, turn, regexp_replace(CASE turn % 5 WHEN 0 THEN t WHEN 1 THEN 'plain' || chr(10) || t WHEN 2 THEN t
                                     WHEN 3 THEN t || chr(10) || 'second' ELSE '' END, '^\s+|\s+$', '', 'g') AS text
FROM (SELECT conv_id, turn, coalesce(text, '') AS t FROM conversations)""", ids=("S-19",))
def q_response_text(spark, sf_dir):
    return RS.response_text(payloads(Tables(spark, sf_dir).conversations)).select("conv_id", "turn", "text")


def model_outputs(documents):
    d = F.col("doc_id")
    out = (F.when(d % 3 == 0, F.concat(F.lit("Here is the fix:\n```python\n"), F.col("text"), F.lit("\n\n```\nDone.")))
           .when(d % 3 == 1, F.concat(F.lit("```\n   \n```\n"), F.col("text"))).otherwise(F.col("text")))
    return documents.select("doc_id", out.alias("output"))


@register("extract_code", r"""
SELECT doc_id, CASE WHEN regexp_matches(o, '(?s)```[a-zA-Z0-9_+.-]*\n(.*?)```')
                     AND regexp_matches(regexp_replace(regexp_extract(o, '(?s)```[a-zA-Z0-9_+.-]*\n(.*?)```', 1),
                                                       '\n+\z', ''), '\S')
                    THEN regexp_replace(regexp_extract(o, '(?s)```[a-zA-Z0-9_+.-]*\n(.*?)```', 1), '\n+\z', '')
                         || chr(10) END AS code
FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'Here is the fix:' || chr(10) || '```python' || chr(10) || text
                                                    || chr(10) || chr(10) || '```' || chr(10) || 'Done.'
                          WHEN doc_id % 3 = 1 THEN '```' || chr(10) || '   ' || chr(10) || '```' || chr(10) || text ELSE text END AS o
      FROM documents)""", ids=("S-20",))
def q_extract_code(spark, sf_dir):
    return RS.extract_code(model_outputs(Tables(spark, sf_dir).documents)).select("doc_id", "code")
