"""Tolerant reading of stored model responses: decisions, findings, payload text, code blocks.

Decoding runs natively first: fences are stripped with ``regexp_replace`` and the text
goes through ``try_parse_json`` (VARIANT). Rows that fail go, in the same pass, through
one Arrow-batched ``pandas_udf`` that finds an object in prose, closes a truncated one
and keeps the last of repeated keys; it gets NULL for all other rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from sluice.functions.json_repair import FENCE_CLOSE, FENCE_OPEN, recover

NL = "\n"
# Decision enum, defaults and finding contract.
DECISIONS = ("APPROVE", "BLOCK")
SEVERITIES = ("BLOCKER", "SUGGESTION", "STYLE")
REQUIRED_FINDING_FIELDS = ("file", "severity", "rule_id", "citation", "message")
FENCE_CODE = r"(?s)```[a-zA-Z0-9_+.-]*\n(.*?)```"
UNREADABLE = "No decision could be read from the stored response, so the gate blocks. Response: "
NO_REASON = " was decided without a stated reason."


@pandas_udf(StringType())
def _recover_decision(raw: pd.Series) -> pd.Series:
    return raw.map(lambda s: recover(s, repair=True, require_key="decision"))


@pandas_udf(StringType())
def _recover_object(raw: pd.Series) -> pd.Series:
    return raw.map(lambda s: recover(s, repair=False))


def strip(c: Column) -> Column:
    """White space off both ends (``trim`` takes spaces only)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def strip_fences(raw: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(strip(raw), FENCE_OPEN, ""), FENCE_CLOSE, ""))


def tolerant_json(df: DataFrame, raw_col: str = "raw", fences: bool = True, repair: bool = True) -> DataFrame:
    """S-16: add ``json`` (VARIANT) and ``decoded_by`` (direct / recovered / NULL)."""
    direct = F.try_parse_json(strip_fences(F.col(raw_col)) if fences else F.col(raw_col))
    udf = _recover_decision if repair else _recover_object
    return (df.withColumn("_direct", direct)
            .withColumn("_rec", udf(F.when(F.col("_direct").isNull(), F.col(raw_col))))
            .withColumn("json", F.coalesce("_direct", F.try_parse_json("_rec")))
            .withColumn("decoded_by", F.when(F.col("_direct").isNotNull(), "direct").when(F.col("json").isNotNull(), "recovered"))
            .drop("_direct", "_rec"))


def _is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def _get(v: Column, path: str, t: str = "string") -> Column:
    return F.try_variant_get(v, path, t)


def parse_decisions(df: DataFrame, raw_col: str = "raw") -> DataFrame:
    """S-17: decision (APPROVE/BLOCK, never anything else), cleaned findings, justification."""
    j = tolerant_json(df, raw_col, fences=True, repair=True)
    v = F.col("json")
    is_obj = _is_object(v)
    dec_raw = F.upper(strip(F.coalesce(_get(v, "$.decision"), F.lit(""))))
    decision = F.when(is_obj & dec_raw.isin(*DECISIONS), dec_raw).otherwise(F.lit("BLOCK"))
    items = F.when(is_obj, F.coalesce(_get(v, "$.findings", "array<variant>"), F.array().cast("array<variant>")))
    items = F.coalesce(items, F.array().cast("array<variant>"))
    findings = F.transform(F.filter(items, _is_object), lambda e: F.struct(
        F.coalesce(_get(e, "$.rule_id"), F.lit("UNKNOWN")).alias("rule_id"),
        F.upper(F.coalesce(_get(e, "$.severity"), F.lit("SUGGESTION"))).alias("severity"),
        F.coalesce(_get(e, "$.message"), F.lit("")).alias("message")))
    just = strip(F.coalesce(_get(v, "$.justification"), F.lit("")))
    justification = (F.when(~is_obj, F.concat(F.lit(UNREADABLE), F.coalesce(F.col(raw_col), F.lit(""))))
                     .when(just == "", F.concat(decision, F.lit(NO_REASON))).otherwise(just))
    return j.select("*", is_obj.alias("parsed"), decision.alias("decision"), findings.alias("findings"),
                    justification.alias("justification")).drop("json")


def parse_findings(df: DataFrame, raw_col: str = "raw", key_cols=("response_id",)) -> DataFrame:
    """S-18: valid findings (required fields non-empty, known severity, integer line) per response."""
    j = tolerant_json(df, raw_col, fences=False, repair=False)
    v = F.col("json")
    kind = F.schema_of_variant(v)
    items = (F.when(kind.startswith("OBJECT"), _get(v, "$.findings", "array<variant>"))
             .when(kind.startswith("ARRAY"), _get(v, "$", "array<variant>")))
    exploded = j.select(*key_cols, F.posexplode(F.coalesce(items, F.array().cast("array<variant>")))
                        .alias("finding_no", "f"))
    f = F.col("f")
    present = [(_get(f, f"$.{k}").isNotNull() & (_get(f, f"$.{k}") != "")) for k in REQUIRED_FINDING_FIELDS]
    ok = _is_object(f)
    for p in present:
        ok = ok & F.coalesce(p, F.lit(False))
    sev = F.upper(_get(f, "$.severity"))
    line_kind = F.schema_of_variant(F.try_variant_get(f, "$.line", "variant"))
    line_s = _get(f, "$.line")
    line = (F.when(line_kind.startswith("BIGINT") | line_kind.startswith("INT") | line_kind.startswith("SMALLINT")
                   | line_kind.startswith("TINYINT"), _get(f, "$.line", "bigint"))
            .when(line_kind.startswith("STRING") & line_s.rlike("^[0-9]+$"), line_s.try_cast("bigint")))
    opt = lambda k: F.when(F.coalesce(_get(f, f"$.{k}"), F.lit("")) != "", _get(f, f"$.{k}"))
    return exploded.where(ok & sev.isin(*SEVERITIES)).select(
        *key_cols, "finding_no", _get(f, "$.file").alias("file"), line.alias("line"), sev.alias("severity"),
        _get(f, "$.rule_id").alias("rule_id"), _get(f, "$.citation").alias("citation"),
        _get(f, "$.message").alias("message"), opt("suggestion").alias("suggestion"), opt("patch").alias("patch"))


def review_summary(df: DataFrame, raw_col: str = "raw", key_cols=("response_id",)) -> DataFrame:
    """S-18: the ``summary`` string of a review response ('' when absent or not an object)."""
    j = tolerant_json(df, raw_col, fences=False, repair=False)
    v = F.col("json")
    return j.select(*key_cols, F.when(_is_object(v), F.coalesce(_get(v, "$.summary"), F.lit(""))).otherwise(F.lit(""))
                    .alias("summary"))


def _content_parts(content: Column) -> Column:
    """Texts of a message's content: the string itself, or its string elements and ``text`` fields."""
    whole = F.when(F.schema_of_variant(content) == "STRING", F.array(content.try_cast("string")))
    elements = F.transform(F.try_variant_get(content, "$", "array<variant>"), lambda e: F.coalesce(
        F.when(F.schema_of_variant(e) == "STRING", e.try_cast("string")), F.try_variant_get(e, "$.text", "string")))
    return F.coalesce(whole, elements, F.array().cast("array<string>"))


def _texts(v: Column, items: str, content: str) -> Column:
    found = F.coalesce(F.try_variant_get(v, items, "array<variant>"), F.array().cast("array<variant>"))
    parts = F.flatten(F.transform(found, lambda o: _content_parts(F.try_variant_get(o, content, "variant"))))
    return strip(F.array_join(F.filter(parts, lambda t: t != ""), NL))


def response_text(df: DataFrame, payload_col: str = "payload") -> DataFrame:
    """S-19: text of a Responses-API payload (``output[].content[]``), else of all chat choices, joined by lines."""
    staged = df.withColumn("_v", F.try_parse_json(payload_col))
    staged = staged.withColumn("_t", _texts(F.col("_v"), "$.output", "$.content"))
    text = F.when(F.col("_t") != "", F.col("_t")).otherwise(_texts(F.col("_v"), "$.choices", "$.message.content"))
    return staged.withColumn("text", F.coalesce(text, F.lit(""))).drop("_v", "_t")


def extract_code(df: DataFrame, col: str = "output") -> DataFrame:
    """S-20: first fenced block, trailing newlines trimmed to one; NULL when absent or blank."""
    code = F.regexp_extract(F.col(col), FENCE_CODE, 1)
    found = F.col(col).rlike(FENCE_CODE)
    trimmed = F.regexp_replace(code, r"\n+\z", "")
    return df.select("*", F.when(found & trimmed.rlike(r"\S"), F.concat(trimmed, F.lit(NL))).alias("code"))
