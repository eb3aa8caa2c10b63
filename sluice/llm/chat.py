"""Operator 10, chat formatting: a template is a black box; spans are found by rendering turn prefixes.

Method. A conversation's prefixes of 1, 2 ... n turns are rendered. Consecutive outputs are compared: what
they share at the front and at the back must make up the whole earlier output; the rest of the later one is
the new turn's span. If it does not, the template rewrites history, which is reported with the turn. Inside
its span a turn's text is located by rendering the prefix once more with a probe character as its text.
The spans of assistant texts are the loss mask.

A template has ``render(turns)``, ``escape`` and ``unescape``. ``BracketTemplate`` marks turns with control
strings; inside texts a backslash follows the first character of a control string and backslashes are
doubled, which ``unescape`` takes back, so ``read`` recovers all turns from the output alone.

Defined results. Turns are ordered by turn, role, text (nulls first); null role or text: empty. Repeated rows
are turns like others. Rows with a null conv_id form one conversation. An empty table gives no rows, columns
beside ``conv_id``, ``turn``, ``role`` and ``text`` are ignored. One conversation is formatted in one task, as its
output is one string; texts of any length are rendered whole, and each turn renders the conversation twice.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import doc_id, public_id

PROBE = "\ue000"
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE ", "[/ROLE]")


class BracketTemplate:
    """``<s>[INST] user [/INST] assistant </s>``, system texts in ``<<SYS>>``, other roles in ``[ROLE name]``."""

    starts = re.compile("(?=" + "|".join(map(re.escape, CONTROLS)) + ")(.)", re.DOTALL)
    turn = re.compile(r"<<SYS>>\n(?P<system>.*?)\n<</SYS>>\n\n|<s>\[INST\] (?P<user>.*?) \[/INST\]| (?P<assistant>.*?) </s>"
                      r"|\[ROLE (?P<role>[^\]]*)\] (?P<text>.*?) \[/ROLE\]", re.DOTALL)

    def escape(self, text: str) -> str:
        return self.starts.sub(r"\1" + "\\\\", text.replace("\\", "\\\\"))

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def render(self, turns: list[tuple[str, str]]) -> str:
        out = []
        for role, text in turns:
            text = self.escape(text)
            if role == "system":
                out.append(f"<<SYS>>\n{text}\n<</SYS>>\n\n")
            elif role == "user":
                out.append(f"<s>[INST] {text} [/INST]")
            elif role == "assistant":
                out.append(f" {text} </s>")
            else:
                out.append(f"[ROLE {quote(role, safe='')}] {text} [/ROLE]")
        return "".join(out)

    def read(self, formatted: str) -> list[tuple[str, str]]:
        """The turns of an output."""
        turns, at = [], 0
        while at < len(formatted):
            m = self.turn.match(formatted, at)
            if m is None:
                raise ValueError(f"no turn at {at}")
            kind = next(k for k in ("system", "user", "assistant", "text") if m[k] is not None)
            turns.append((unquote(m["role"]) if kind == "text" else kind, self.unescape(m[kind])))
            at = m.end()
        return turns


def _shared(a: str, b: str) -> int:
    """Characters that both start with."""
    if b.startswith(a):
        return len(a)
    return len(os.path.commonprefix((a, b)))


def locate(template, turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]], list[int]]:
    """(output, span of each turn's text in it, turns that rewrote what stood before them).

    A text that the template drops or repeats has an empty span. After a rewrite the earlier spans are
    looked up anew in the last output.
    """
    before, spans, rewrites = template.render([]), [], []
    for k in range(1, len(turns) + 1):
        now = template.render(turns[:k])
        front = _shared(before, now)
        back = 0 if front == len(before) else min(_shared(before[::-1], now[::-1]), len(before) - front)
        if front + back < len(before):
            rewrites.append(k - 1)
        spans.append(_text_span(template, turns[:k], k - 1, now))
        before = now
    if rewrites or any(e > len(before) for _, e in spans):
        spans = [_text_span(template, turns, k, before) for k in range(len(turns))]
    return before, spans, rewrites


def _text_span(template, turns, k: int, output: str) -> tuple[int, int]:
    role, text = turns[k]
    probe = PROBE
    while any(probe in t for _, t in turns):
        probe += PROBE
    probed = template.render([*turns[:k], (role, probe), *turns[k + 1:]])
    if probed.count(probe) != 1:
        return (0, 0)
    head = probed.index(probe)
    tail = len(probed) - head - len(probe)
    end = len(output) - tail
    if end < head or output[:head] != probed[:head] or output[end:] != probed[head + len(probe):]:
        return (0, 0)
    return (head, end)


def _format(template):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            made = []
            for conv, rows in zip(f["conv_id"], f["turns"]):
                turns = [(r["role"] or "", r["text"] or "") for r in rows]
                out, spans, rewrites = locate(template, turns)
                loss = [{"start": a, "end": b} for (role, _), (a, b) in zip(turns, spans) if role == "assistant"]
                made.append((conv, out, loss, rewrites))
            yield pd.DataFrame(made, columns=["conv_id", "formatted", "loss", "rewrites"])
    return run


def format_conversations(conversations: DataFrame, template=None) -> DataFrame:
    """(conv_id, formatted, loss spans of assistant texts, numbers of turns that rewrote history)."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = conversations.groupBy(doc_id("conv_id").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    formatted = grouped.mapInPandas(_format(template or BracketTemplate()),
                                    "conv_id long, formatted string, loss array<struct<start:int,end:int>>, rewrites array<int>")
    return formatted.withColumn("conv_id", public_id("conv_id"))


def _digest(template):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            made = []
            for conv, out, spans in zip(f["conv_id"], f["formatted"], f["loss"]):
                turns = template.read(out)
                loss = "".join(template.unescape(out[s["start"]:s["end"]]) for s in spans)
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                made.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                             hashlib.sha256(loss.encode()).hexdigest(), len(out)))
            yield pd.DataFrame(made, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
    return run


def digest(formatted: DataFrame, template=None) -> DataFrame:
    """Turns and loss text as read back from the output alone."""
    read = formatted.select(doc_id("conv_id").alias("conv_id"), "formatted", "loss").mapInPandas(
        _digest(template or BracketTemplate()),
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return read.withColumn("conv_id", public_id("conv_id"))


def query(spark, sf_dir) -> DataFrame:
    from sluice.llm.common import table
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return digest(format_conversations(turns))


SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
c AS (SELECT *, length(text) + length(text) - length(replace(text, chr(92), ''))
        + len(regexp_extract_all(text, '<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|\[ROLE |\[/ROLE\]'))
        + CASE role WHEN 'system' THEN 19 WHEN 'user' THEN 18 WHEN 'assistant' THEN 6 ELSE 16 + length(role) END AS chars FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
