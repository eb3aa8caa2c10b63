"""Unified-diff parsing as column expressions: files, hunks and numbered added lines.

A diff row is cut into files at ``diff --git`` headers and each file into hunks at
``@@`` headers with ``split``; inside a hunk the new-file line number of an added line
is the hunk start plus its index among the lines that advance the new file (added and
context lines). That index comes from filtering the hunk's line array, so numbering is a
per-row array expression: no window, no shuffle, and every diff is parsed whole.

Header rule: ``+++ b/``, ``Binary files`` and ``rename from/to`` lines are recognised
before the first ``@@`` of a file only; inside a hunk ``-`` never advances the counter
and ``+`` always records a line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NL = "\n"

# Language by path suffix (first match wins), linters per language.
LANGUAGE_BY_SUFFIX = [
    (".py", "python"),
    (".sql", "sql"),
    (".yml", "yaml"),
    (".yaml", "yaml"),
    (".sh", "shell"),
]
DEFAULT_LANGUAGE = "text"
LINTER_BY_SUFFIX = [(".py", "ruff"), (".sql", "sqlfluff")]

_HEADER_RE = r"^a/(.+?) b/(.+)$"
_HUNK_RE = r"^@@ -[0-9]+(,[0-9]+)? \+([0-9]+)(,[0-9]+)? @@"


def detect_language(path: Column) -> Column:
    """P-05: language from the path suffix, default ``text``."""
    expr = None
    for suffix, lang in LANGUAGE_BY_SUFFIX:
        cond = path.endswith(suffix)
        expr = F.when(cond, F.lit(lang)) if expr is None else expr.when(cond, F.lit(lang))
    return expr.otherwise(F.lit(DEFAULT_LANGUAGE))


def linter_for(path: Column) -> Column:
    """P-04: deterministic linter guarding a file type; NULL when none."""
    expr = None
    for suffix, tool in LINTER_BY_SUFFIX:
        cond = path.endswith(suffix)
        expr = F.when(cond, F.lit(tool)) if expr is None else expr.when(cond, F.lit(tool))
    return expr


def content_check(content: Column) -> tuple[Column, Column]:
    """P-06: (ok, reason) - content must be non-blank."""
    ok = content.isNotNull() & content.rlike(r"\S")
    return ok, F.when(ok, F.lit("")).otherwise(F.lit("empty content"))


def lines_of(text: Column) -> Column:
    """Text -> array of lines (a final newline does not open an empty last line)."""
    body = F.when(text.endswith(NL), F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    return F.when((text.isNull()) | (text == ""), F.array().cast("array<string>")).otherwise(F.split(body, NL))


def as_added_diff(path: Column, content: Column) -> Column:
    """S-21: a file's text presented as a new-file diff."""
    lines = lines_of(content)
    body = F.array_join(F.transform(lines, lambda x: F.concat(F.lit("+"), x, F.lit(NL))), "")
    return F.concat(
        F.lit("diff --git a/"), path, F.lit(" b/"), path, F.lit(NL + "+++ b/"), path,
        F.lit(NL + "@@ -0,0 +1,"), F.size(lines).cast("string"), F.lit(" @@" + NL), body,
    )


def diff_files(changes: DataFrame, diff_col: str = "diff", key_cols=("change_id",)) -> DataFrame:
    """A-15: one row per file of each diff with path, language, flags and hunk headers.

    Also carries ``n_files`` of the diff and the raw ``hunk_texts`` for line numbering.
    Intermediate arrays are projected in stages, so each is computed once per row (the
    optimizer does not inline an expensive expression that is used more than once).
    """
    files = F.split(F.concat(F.lit(NL), F.coalesce(F.col(diff_col), F.lit(""))), NL + "diff --git ")
    staged = changes.select(*key_cols, F.slice(files, 2, 1 << 30).alias("_files")).select(
        *key_cols, F.size("_files").alias("n_files"),
        F.posexplode("_files").alias("_pos", "_ftext"))
    parts = staged.select(*key_cols, "n_files", "_pos", F.split(F.col("_ftext"), NL + "@@ ").alias("_parts"))
    pre = parts.select(*key_cols, "n_files", "_pos", "_parts",
                       F.split(F.try_element_at("_parts", F.lit(1)), NL).alias("_pre"))
    first = F.try_element_at("_pre", F.lit(1))
    plus = F.try_element_at(F.filter("_pre", lambda x: x.startswith("+++ b/")), F.lit(-1))
    path = F.coalesce(F.regexp_replace(F.substring(plus, 7, 1 << 30), r"\s+$", ""),
                      F.regexp_extract(first, _HEADER_RE, 2))
    hunk_texts = F.transform(F.slice("_parts", 2, 1 << 30), lambda h: F.concat(F.lit("@@ "), h))
    return pre.select(
        *key_cols, "n_files", (F.col("_pos") + 1).alias("file_no"),
        path.alias("path"),
        F.exists("_pre", lambda x: x.startswith("Binary files")).alias("is_binary"),
        F.exists("_pre", lambda x: x.startswith("rename from") | x.startswith("rename to")).alias("is_rename"),
        hunk_texts.alias("hunk_texts"),
    ).select(
        "*", detect_language(F.col("path")).alias("language"),
        F.array_join(F.transform("hunk_texts", lambda h: F.substring_index(h, NL, 1)), NL).alias("hunks"),
    )


def diff_added_lines(files: DataFrame, key_cols=("change_id",)) -> DataFrame:
    """W-05: one row per added line with its new-file line number.

    Within a hunk, the lines that advance the new file (context and added) are kept in
    order; an added line's number is the hunk start plus its index in that array. Each
    intermediate array is its own projection, so it is computed once per hunk.
    """
    keep = [*key_cols, "file_no", "path", "language", "is_binary"]
    h = files.select(*keep, F.posexplode("hunk_texts").alias("hunk_no", "_h")) \
        .select(*keep, (F.col("hunk_no") + 1).alias("hunk_no"), F.split("_h", NL).alias("_lines"))
    h = h.select(*keep, "hunk_no",
                 F.regexp_extract(F.try_element_at("_lines", F.lit(1)), _HUNK_RE, 2).try_cast("int").alias("_start"),
                 F.filter(F.slice("_lines", 2, 1 << 30), lambda x: ~x.startswith("-") & ~x.startswith("\\"))
                 .alias("_adv"))
    # a hunk that starts at line 0 only advances once its first added line is seen
    h = h.select(*keep, "hunk_no", "_start", "_adv",
                 F.array_position(F.transform("_adv", lambda x: x.startswith("+")), True).cast("int").alias("_fa"))
    adv = F.when((F.col("_start") == 0) & (F.col("_fa") > 0), F.slice("_adv", F.col("_fa"), F.lit(1 << 30))) \
        .otherwise(F.col("_adv"))
    h = h.where(F.col("_start").isNotNull()).select(*keep, "hunk_no", "_start", adv.alias("_adv"))
    numbered = F.transform("_adv", lambda x, i: F.struct((F.col("_start") + i).alias("line"), x.alias("raw")))
    added = F.filter(numbered, lambda s: s["raw"].startswith("+"))
    return h.select(*keep, "hunk_no", F.explode(added).alias("_a")).select(
        *keep, "hunk_no", F.col("_a.line").alias("line"), F.substring(F.col("_a.raw"), 2, 1 << 30).alias("text"))


def parsed_diffs(changes: DataFrame, diff_col: str = "diff", keep=("change_id",)) -> DataFrame:
    """``keep`` and ``files``: A-15 and W-05 within the row, nothing exploded.

    ``files`` is an array of (file_no, path, language, is_binary, is_rename, lines), ``lines`` the added ones as
    (hunk_no, line, text). Each stage is a projection of its own, so that arrays are computed once.
    """
    rest = lambda c, at: F.slice(c, at, 1 << 30)
    df = changes.select(*keep, rest(F.split(F.concat(F.lit(NL), F.coalesce(F.col(diff_col), F.lit(""))), NL + "diff --git "), 2).alias("_f"))
    df = df.select(*keep, F.transform("_f", lambda f: F.split(f, NL + "@@ ")).alias("_f"))
    df = df.select(*keep, F.transform("_f", lambda p: F.struct(F.split(p[0], NL).alias("pre"), rest(p, 2).alias("hunks"))).alias("_f"))

    def named(f: Column, i: Column) -> Column:
        plus = F.try_element_at(F.filter(f["pre"], lambda x: x.startswith("+++ b/")), F.lit(-1))
        path = F.coalesce(F.regexp_replace(F.substring(plus, 7, 1 << 30), r"\s+$", ""), F.regexp_extract(f["pre"][0], _HEADER_RE, 2))
        return F.struct((i + 1).alias("file_no"), path.alias("path"),
                        F.exists(f["pre"], lambda x: x.startswith("Binary files")).alias("is_binary"),
                        F.exists(f["pre"], lambda x: x.startswith("rename from") | x.startswith("rename to")).alias("is_rename"),
                        F.transform(f["hunks"], lambda h: F.split(h, NL)).alias("hunks"))

    def advancing(lines: Column, i: Column) -> Column:
        start = F.regexp_extract(F.concat(F.lit("@@ "), lines[0]), _HUNK_RE, 2).try_cast("int")
        return F.struct((i + 1).alias("hunk_no"), start.alias("start"),
                        F.filter(rest(lines, 2), lambda x: ~x.startswith("-") & ~x.startswith("\\")).alias("adv"))

    def from_first(h: Column) -> Column:
        # a hunk that starts at line 0 only advances once its first added line is seen
        first = F.array_position(F.transform(h["adv"], lambda x: x.startswith("+")), True).cast("int")
        return F.when((h["start"] == 0) & (first > 0), rest(h["adv"], first)).otherwise(h["adv"])

    def added(h: Column) -> Column:
        numbered = F.transform(h["adv"], lambda x, i: F.struct(h["hunk_no"].alias("hunk_no"), (h["start"] + i).alias("line"), x.alias("text")))
        return F.transform(F.filter(numbered, lambda n: n["text"].startswith("+")), lambda n: F.struct(
            n["hunk_no"].alias("hunk_no"), n["line"].alias("line"), F.substring(n["text"], 2, 1 << 30).alias("text")))

    df = df.select(*keep, F.transform("_f", named).alias("_f"))
    df = df.select(*keep, F.transform("_f", lambda f: f.withField("hunks", F.filter(F.transform(f["hunks"], advancing), lambda h: h["start"].isNotNull()))).alias("_f"))
    df = df.select(*keep, F.transform("_f", lambda f: f.withField("hunks", F.transform(f["hunks"], lambda h: h.withField("adv", from_first(h))))).alias("_f"))
    return df.select(*keep, F.transform("_f", lambda f: F.struct(
        f["file_no"].alias("file_no"), f["path"].alias("path"), detect_language(f["path"]).alias("language"), f["is_binary"].alias("is_binary"),
        f["is_rename"].alias("is_rename"), F.flatten(F.transform(f["hunks"], added)).alias("lines"))).alias("files"))


def file_checks(files: DataFrame, path_col: str = "path", content_col: str = "text") -> DataFrame:
    """P-04 / P-05 / P-06 over a table of files."""
    ok, reason = content_check(F.col(content_col))
    return files.select(
        "*", detect_language(F.col(path_col)).alias("language"), linter_for(F.col(path_col)).alias("linter"),
        ok.alias("content_ok"), reason.alias("content_reason"))
