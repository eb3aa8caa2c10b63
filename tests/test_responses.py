"""Stored responses: every shape is built here from a value and a way to wrap or cut it."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from sluice.functions.json_repair import close_truncated, recover, strip_fences
from sluice.operators import responses as RS

ORDER = {"decision": "approve", "justification": "Error fell by a tenth.", "findings": [{"rule_id": "Q-7", "severity": "style", "message": "naming"}]}


def _decide(spark, raws):
    df = spark.createDataFrame(list(enumerate(raws)), "n int, raw string")
    return [r for r in RS.parse_decisions(df).orderBy("n").collect()]


def test_wrappers_around_one_decision(spark):
    text = json.dumps(ORDER)
    wraps = [text, f"```\n{text}\n```", f"  ```json\n{text}```\n", f"My verdict follows. {text} Regards", text + "}}", text + "\n{\"other\": 1}"]
    for r in _decide(spark, wraps):
        assert (r.parsed, r.decision, r.justification) == (True, "APPROVE", "Error fell by a tenth.")
        assert [tuple(f) for f in r.findings] == [("Q-7", "STYLE", "naming")]


def test_unreadable_responses_block_and_keep_the_whole_text(spark):
    long = "no object " * 200
    out = _decide(spark, ["", None, long, "[1, 2]", "{broken"])
    assert {r.decision for r in out} == {"BLOCK"} and not any(r.parsed for r in out)
    assert out[2].justification == RS.UNREADABLE + long


@pytest.mark.parametrize("said,want", [("APPROVE\n", "APPROVE"), ("\tblock ", "BLOCK"), ("Approved", "BLOCK"), ("", "BLOCK"), (None, "BLOCK"), (True, "BLOCK")])
def test_decision_words(spark, said, want):
    assert _decide(spark, [json.dumps({"decision": said})])[0].decision == want


def test_of_a_repeated_key_the_last_value_counts(spark):
    r = _decide(spark, ['{"decision": "BLOCK", "justification": "a", "decision": "APPROVE"}'])[0]
    assert (r.decision, r.justification) == ("APPROVE", "a")


def test_missing_parts_get_defaults(spark):
    a, b, c = _decide(spark, ['{"decision": "BLOCK"}', '{"decision": "APPROVE", "findings": "none", "justification": " \\n"}',
                              '{"decision": "APPROVE", "findings": [7, {}, {"severity": null, "message": "m"}]}'])
    assert a.justification == "BLOCK" + RS.NO_REASON and b.justification == "APPROVE" + RS.NO_REASON and b.findings == []
    assert [tuple(f) for f in c.findings] == [("UNKNOWN", "SUGGESTION", ""), ("UNKNOWN", "SUGGESTION", "m")]


def test_a_response_cut_anywhere_keeps_what_was_complete():
    value = {"decision": "BLOCK", "n": [1, -2.5e3, True, None, {"k": {}}], "s": "quote \" slash \\ é  ", "t": "end"}
    text = json.dumps(value, ensure_ascii=random.Random(3).random() < 0.5)
    known = text.index("BLOCK") + 1
    for end in range(known, len(text)):
        got = json.loads(recover(text[:end], True, "decision"))
        assert value["decision"].startswith(got["decision"]) and list(got) == list(value)[:len(got)]
        for k in list(got)[1:-1]:
            assert got[k] == value[k]
        assert value["s"].startswith(got.get("s", "")) or "\\" in repr(got["s"])
    assert json.loads(recover('{"decision": "BLOCK", "why": "line\\', True)) == {"decision": "BLOCK", "why": "line"}
    assert json.loads(recover('{"decision": "BLOCK", "why": "x\\u00', True)) == {"decision": "BLOCK", "why": "x"}
    assert recover('{"why": "cut', True, "decision") is None and recover('{"why": "cut', False) is None
    assert close_truncated("no braces") is None and strip_fences(" ```sql\nx\n``` ") == "x"


def test_recovery_time_follows_the_length():
    def seconds(n):
        raw = '{"decision": "BLOCK", "findings": [' + ", ".join(f'{{"message": "{i} \\" {i}"}}' for i in range(n))
        start = time.perf_counter()
        assert len(json.loads(recover(raw, True, "decision"))["findings"]) == n
        return time.perf_counter() - start
    seconds(100)
    assert seconds(40_000) < 25 * max(seconds(4_000), 0.01)


def test_one_pass_over_the_source(spark):
    df = spark.read.json(spark.sparkContext.parallelize(['{"raw": "x"}'])).where(F.length("raw") > 0)
    plan = RS.parse_decisions(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Union" not in plan


def _finding(n, **changed):
    return {"file": f"lib/m{n}.py", "line": n, "severity": "style", "rule_id": f"R-{n}", "citation": "Book", "message": f"text {n}"} | changed


def test_findings_that_lack_what_is_required_are_left_out(spark):
    bad = [_finding(1, severity="high"), _finding(2, file=""), {k: v for k, v in _finding(3).items() if k != "citation"}, "text", 5, None]
    good = [_finding(4), _finding(5, line="17"), _finding(6, line="x"), _finding(7, line=None, suggestion="rename", patch="", more=1)]
    raws = [json.dumps({"summary": "two words", "findings": bad + good}), json.dumps(good[:1]), "see:\n```json\n" + json.dumps({"findings": good[:1]}) + "\n``` bye {",
            "nothing", None, json.dumps({"findings": []})]
    df = spark.createDataFrame(list(enumerate(raws)), "response_id int, raw string")
    got = [tuple(r)[:1] + (r.file, r.line, r.severity, r.suggestion, r.patch) for r in RS.parse_findings(df).orderBy("response_id", "finding_no").collect()]
    assert got == [(0, "lib/m4.py", 4, "STYLE", None, None), (0, "lib/m5.py", 17, "STYLE", None, None), (0, "lib/m6.py", None, "STYLE", None, None),
                   (0, "lib/m7.py", None, "STYLE", "rename", None), (1, "lib/m4.py", 4, "STYLE", None, None), (2, "lib/m4.py", 4, "STYLE", None, None)]
    assert [r.summary for r in RS.review_summary(df).orderBy("response_id").collect()] == ["two words", "", "", "", "", ""]


@pytest.mark.parametrize("payload,want", [
    ({"output": [{"content": ["plain", {"text": "b"}, {"type": "image"}, {"text": ""}]}, {"content": "whole"}, {}]}, "plain\nb\nwhole"),
    ({"choices": [{"message": {"content": "one"}}, {"message": {}}, {"message": {"content": "two"}}]}, "one\ntwo"),
    ({"output": [{"content": []}], "choices": [{"message": {"content": " x "}}]}, "x"),
    ({"output": None, "choices": None}, ""), ([], ""), ("text", "")])
def test_text_of_payloads(spark, payload, want):
    df = spark.createDataFrame([(json.dumps(payload),)], "payload string")
    assert RS.response_text(df).first().text == want


def test_first_code_block(spark):
    cases = {"a\n```sql\nselect 1\n\n\n```\n```\nsecond\n```": "select 1\n", "```\n \t\n```": None, "no fence": None, "```py\nopen": None, "": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "output string")
    assert {r.output: r.code for r in RS.extract_code(df).collect()} == cases
