"""Diffs and reviews. Diffs are written by ``unified`` from lists of lines, so what must be parsed is known."""

import random

from support import rows
from pyspark.sql import functions as F

from sluice.operators import diffs as D
from sluice.operators import review as V

KEYS = "change_id long, "


def unified(path, hunks, renamed_from=None, binary=False):
    """(diff text, [(line, text)]): hunks are (start, [(mark, text)])."""
    out, want = [f"diff --git a/{renamed_from or path} b/{path}"], []
    if renamed_from:
        out += [f"rename from {renamed_from}", f"rename to {path}"]
    if binary:
        out.append(f"Binary files a/{path} and b/{path} differ")
    elif hunks:
        out += [f"--- a/{path}", f"+++ b/{path}"]
    for start, body in hunks:
        kept = sum(m != "-" for m, _ in body)
        out.append(f"@@ -{start},{sum(m != '+' for m, _ in body)} +{start},{kept} @@ def scope")
        at = start
        for mark, text in body:
            out.append(mark + text)
            if mark == "+":
                want.append((at, text))
            at += mark != "-"
    return "\n".join(out) + "\n", want


def _parse(spark, diff):
    files = D.diff_files(spark.createDataFrame([(1, diff)], KEYS + "diff string"))
    lines = D.diff_added_lines(files).orderBy("file_no", "hunk_no", "line").collect()
    return files.orderBy("file_no").collect(), [(r.path, r.line, r.text) for r in lines]


def test_generated_diffs_are_parsed_back(spark):
    rng = random.Random(8)
    for _ in range(6):
        text, want, paths = "", [], []
        for f in range(rng.randrange(1, 5)):
            path = f"pkg{f}/mod{f}.{rng.choice(['py', 'sql', 'yaml', 'md'])}"
            hunks, start = [], 1
            for _ in range(rng.randrange(1, 4)):
                start += rng.randrange(0, 40)
                body = [(rng.choice("+- "), rng.choice(["", "++ x", "-- y", "a = 1", "@ b", "\ttab"])) for _ in range(rng.randrange(1, 9))]
                hunks.append((start, body))
                start += len(body)
            part, lines = unified(path, hunks, renamed_from=rng.choice([None, f"old/{f}.py"]))
            text += part
            paths.append(path)
            want += [(path, *x) for x in lines]
        files, got = _parse(spark, text)
        assert [f.path for f in files] == paths and got == want


def test_files_without_lines(spark):
    binary, _ = unified("img/a.bin", [], binary=True)
    moved, _ = unified("lib/to.sh", [], renamed_from="lib/from.sh")
    files, lines = _parse(spark, binary + moved)
    assert [(f.path, f.language, f.is_binary, f.is_rename, f.n_files, f.hunks) for f in files] == [
        ("img/a.bin", "text", True, False, 2, ""), ("lib/to.sh", "shell", False, True, 2, "")]
    assert lines == [] and _parse(spark, "") == ([], []) and _parse(spark, None) == ([], [])


def test_a_text_as_a_diff_comes_back(spark):
    for text in ("one\ntwo", "one\n\ntwo\n", "single", "\n", ""):
        diff = spark.range(1).select(D.as_added_diff(F.lit("p/q.sql"), F.lit(text)).alias("d")).first().d
        body = text[:-1] if text.endswith("\n") else text
        assert [x[1:] for x in _parse(spark, diff)[1]] == ([] if text == "" else list(enumerate(body.split("\n"), 1)))


def test_file_checks(spark):
    df = spark.createDataFrame([("x/y.py", "a"), ("x/y.sql", " \t\n\n"), ("x/y.yml", None), ("y.yaml", "\x0b"), ("run.sh", "0"), ("py", "")], "path string, text string")
    got = {r.path: (r.language, r.linter, r.content_ok) for r in D.file_checks(df).collect()}
    assert got == {"x/y.py": ("python", "ruff", True), "x/y.sql": ("sql", "sqlfluff", False), "x/y.yml": ("yaml", None, False),
                   "y.yaml": ("yaml", None, False), "run.sh": ("shell", None, True), "py": ("text", None, False)}


# --- policy ---------------------------------------------------------------------------
LINE = KEYS + "file_no int, path string, language string, is_binary boolean, line int, text string"
# a line that breaks each rule, and one like it that does not
CASES = {
    "ENV-01": ("markdown", "joined with mlops_staging.orders", "joined with mlops_dev.orders"),
    "TP-02": ("python", "n = orders.count()", "n = F.count('id')"),
    "TP-04": ("python", "day = os.getenv('DAY')", "day = settings.day"),
    "SQL-02": ("sql", "select a from t Group  By 1", "select a from t group by a"),
    "SQL-03": ("sql", "Select  * from t", "select a * b from t"),
    "NM-01": ("sql", "create VIEW dailyTotals as", "create VIEW daily_totals as"),
    "ML-04": ("yaml", "schema: 'sales_staging'", "schema: sales"),
    "SEC-01": ("shell", "API_KEY = 'a1b2c3d4e5'", "API_KEY = 'short'"),
}


def test_each_rule_fires_on_its_case_only(spark):
    data = [(i, 1, "f", lang, False, n, text) for i, (lang, bad, good) in enumerate(CASES.values()) for n, text in ((1, bad), (2, good))]
    data += [(99, 1, "f", "python", True, 1, CASES["TP-02"][1]), (98, 1, "f", "text", False, 1, CASES["SQL-03"][1])]
    got = rows(V.policy_scan(spark.createDataFrame(data, LINE)), "change_id", "line", "rule_id")
    assert got == [(i, 1, rule) for i, rule in enumerate(CASES)]


def test_the_current_environment_may_be_named(spark):
    data = [(1, 1, "f", "yaml", False, 1, "schema: mlops_prod"), (2, 1, "f", "yaml", False, 1, "schema: mlops_dev")]
    got = rows(V.policy_scan(spark.createDataFrame(data, LINE), V.policy_rules("prod")), "change_id", "rule_id")
    assert (1, "ENV-01") not in got and (1, "ML-04") not in got and {(2, "ENV-01"), (2, "ML-04")} <= set(got)


# --- findings -------------------------------------------------------------------------
FINDING = KEYS + "file_no int, file string, line int, rule_rank int, rule_id string, severity string, citation string, message string, suggestion string"


def _findings(spark, *data):
    """(change, file, line, severity, suggestion) with the rest derived."""
    full = [(c, 1, f, line, k, f"R-{k}", sev, f"Book {k}", f"message {k}", sug) for k, (c, f, line, sev, sug) in enumerate(data)]
    return spark.createDataFrame(full, FINDING)


def _changes(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], KEYS[:-2])


def test_gate_by_severity(spark):
    f = _findings(spark, (2, "a", 1, "STYLE", None), (3, "a", 1, "SUGGESTION", None), (3, "a", 2, "BLOCKER", None), (4, "a", 1, "unknown", None))
    out = {r.change_id: (r.conclusion, r.blocker_count, r.n_findings) for r in V.decide_gate(_changes(spark, 1, 2, 3, 4), f).collect()}
    assert out == {1: ("success", 0, 0), 2: ("neutral", 0, 1), 3: ("failure", 1, 2), 4: ("success", 0, 0)}


def test_all_findings_are_annotated_in_batches(spark):
    f = _findings(spark, *[(1, f"f{i % 7}", i or None, "STYLE", None) for i in range(123)], (2, "g", -4, "BLOCKER", "do so"), (2, "", 1, "BLOCKER", None))
    ann = V.check_annotations(f)
    one = sorted((r.annotation_no, r.batch_no) for r in ann.where("change_id = 1").collect())
    assert one == [(n, (n - 1) // 50) for n in range(1, 124)]
    r = ann.where("change_id = 2").first()
    assert (r.start_line, r.annotation_level, r.title, r.message) == (1, "failure", "BLOCKER R-123", "message 123\n\nTry: do so\n\nSource: Book 123")
    short = V.check_annotations(f, max_title=3, max_message=5).where("change_id = 2").first()
    assert (short.title, short.message) == ("BLO", "messa")
    run = {r.change_id: r for r in V.check_runs(V.decide_gate(_changes(spark, 1, 2, 3), f), f).collect()}
    assert (run[1].n_annotations, run[1].n_overflow, run[1].summary.count("73 finding")) == (123, 73, 1)
    assert (run[2].n_annotations, run[2].n_overflow) == (1, 0) and run[3].title == V.CHECK_TITLES["success"]


def test_comment_order_and_summary(spark):
    f = _findings(spark, (1, "z", 3, "STYLE", None), (1, "y", None, "SUGGESTION", "swap"), (1, "x", 9, "BLOCKER", None))
    said = spark.createDataFrame([(1, " read it \n"), (2, "clean"), (3, " ")], KEYS + "review_summary string")
    out = {r.change_id: r.comment for r in V.render_comment(_changes(spark, 1, 2, 3), f, summaries=said).collect()}
    places = [out[1].index(x) for x in (V.COMMENT_TITLE, "read it", "`x:9`", "`y`", "> Try: swap", "`z:3`", "Findings: 3, blocking: 1")]
    assert places == sorted(places)
    assert out[2] == f"{V.COMMENT_TITLE}\n\nclean\n\n{V.NO_FINDINGS}" and out[3] == f"{V.COMMENT_TITLE}\n\n{V.NO_FINDINGS}"


def test_who_may_push_fixes(spark):
    roles = ["read", "triage", "write", "maintain", "admin", None]
    req = spark.createDataFrame([(r, p) for r in roles for p in (False, True)], "permission string, branch_is_protected boolean")
    got = {(r.permission, r.branch_is_protected): (r.authorized, r.reason) for r in V.fix_authorization(req).collect()}
    assert {k for k, v in got.items() if v[0]} == {("write", False), ("maintain", False), ("admin", False)}
    assert all((reason == "") == ok for ok, reason in got.values()) and got["read", True][1] == V.PROTECTED


def test_fixes_stay_inside_the_change(spark):
    paths = ["lib/a.py", "lib/other.py", "../up.py", "/abs.py", "lib/../x.py", ""]
    f = _findings(spark, *[(1, p, 1, "STYLE", None) for p in paths])
    changed = spark.createDataFrame([(1, p) for p in paths if p != "lib/other.py"] + [(2, "lib/other.py")], KEYS + "path string")
    assert rows(V.select_fixable(f, changed), "file") == [("lib/a.py",)]


# --- prompts --------------------------------------------------------------------------
RULES = "rule_id string, title string, content string, citation string, severity_hint string"


def _blocks(spark, change=1):
    rules = spark.createDataFrame([("B-2", "t", "second rule", "Book 2", "STYLE"), ("B-1", "t", "first " + "long " * 200, "Book 1", "BLOCKER")], RULES)
    top = spark.createDataFrame([(change, 1, "B-1"), (change, 2, "B-2")], KEYS + "rank int, rule_id string")
    return V.rules_blocks(top, rules)


def test_review_prompts_hold_every_line_and_the_rules(spark):
    big, want = unified("big.sql", [(1, [("+", f"row {i}") for i in range(450)])])
    small, _ = unified("small.py", [(5, [("+", "x = 1")])])
    binary, _ = unified("b.png", [], binary=True)
    change = spark.createDataFrame([(1, big + small + binary), (2, small)], KEYS + "diff string")
    files = D.diff_files(change)
    lines = D.diff_added_lines(files)
    out = {(r.change_id, r.part_no): r for r in V.review_prompts(files, lines, _blocks(spark)).collect()}
    assert sorted(out) == [(1, 1), (1, 2), (1, 3), (2, 1)] and out[1, 3].n_parts == 3
    shown = [p for k in range(1, 4) for p in out[1, k].prompt.split("\n") if p.startswith("  L") and "row" in p]
    assert shown == [f"  L{n}: {t}" for n, t in want]
    assert "### small.py (python)\n  L5: x = 1" in out[1, 1].prompt and "### b.png (binary)" in out[1, 1].prompt and "small.py" not in out[1, 2].prompt
    first = "- B-1 [BLOCKER] (citation: Book 1): first " + "long " * 200 + "\n- B-2 [STYLE] (citation: Book 2): second rule"
    assert all(first in out[1, k].prompt for k in (1, 2, 3)) and "(no rule was retrieved)" in out[2, 1].prompt
    assert out[1, 1].system == V.REVIEW_SYSTEM
    with_text = _blocks(spark).withColumn("notes", F.lit("house style"))
    assert "BACKGROUND\nhouse style" in V.review_prompts(files, lines, with_text, grounding="notes").where("change_id = 1").first().prompt
    text = {r.change_id: r.query_text for r in V.change_query_text(change.unionByName(spark.createDataFrame([(3, "")], KEYS + "diff string")), lines).collect()}
    assert text[2] == "x = 1" and text[1].count("\n") == 450 and text[3] == V.DEFAULT_QUERY_TEXT


def test_fix_prompt_parts(spark):
    f = _findings(spark, (1, "lib/a.py", 4, "STYLE", "rename it"), (1, "lib/a.py", None, "BLOCKER", None), (2, "lib/c.py", 1, "STYLE", None))
    contents = spark.createDataFrame([(1, "lib/a.py", "a\nb\n")], KEYS + "path string, text string")
    out = {r.change_id: r for r in V.fix_prompts(f, contents, blocks=_blocks(spark)).collect()}
    p = out[1].prompt
    places = [p.index(x) for x in ("lib/a.py", "- B-1 [BLOCKER]", "- L? [BLOCKER] R-1: message 1", "- L4 [STYLE] R-0: message 0 (try: rename it)", "```\na\nb\n\n```")]
    assert places == sorted(places) and out[1].n_findings == 2 and out[1].system == V.FIX_SYSTEM
    assert "(those that the findings cite)" in out[2].prompt
