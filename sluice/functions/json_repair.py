"""Recovering a JSON object from model text (plain Python, called for the few rows that do not parse).

The decoder itself finds where an object ends (``raw_decode``) and, for one that was cut
off, where decoding failed. Everything before that place is valid, so one pass over it
knows which containers are open and where the last complete element of each ended; the
object is closed there. Repeated keys keep their last value, as Python reads JSON.
"""

from __future__ import annotations

import json
import re

# A fence line with an optional language in front, a fence at the end.
FENCE_OPEN = r"^```[a-zA-Z0-9_+.-]*\n?"
FENCE_CLOSE = r"\n?```$"

_DECODER = json.JSONDecoder(strict=False)
_STRING = re.compile(r'"(?:[^"\\]|\\.)*"', re.DOTALL)
_LITERAL = re.compile(r"[-+.\w]+")
_CUT_ESCAPE = re.compile(r"(?<!\\)(?:\\\\)*(\\(?:u[0-9a-fA-F]{0,3})?)$")


def strip_fences(raw: str) -> str:
    return re.sub(FENCE_CLOSE, "", re.sub(FENCE_OPEN, "", raw.strip())).strip()


def _decode(text: str, start: int) -> tuple[object, int | None]:
    """(value at ``start``, None), or (None, where decoding failed)."""
    try:
        return _DECODER.raw_decode(text, start)[0], None
    except json.JSONDecodeError as e:
        return None, e.pos


def close_truncated(text: str) -> str | None:
    """The longest part of an object cut off at its end that closes into valid JSON; linear in the text.

    An open string value keeps what there is of it, without a cut escape.
    """
    open_containers: list[list] = []  # [closer, end of the last complete element, inside a value]
    at = 0
    while at < len(text):
        ch = text[at]
        if ch in "{[":
            open_containers.append(["}" if ch == "{" else "]", at + 1, ch == "["])
            at += 1
            continue
        if not open_containers:
            return None
        top = open_containers[-1]
        if ch in "}]":
            open_containers.pop()
            at += 1
            if not open_containers:
                return text[:at]
            open_containers[-1][1] = at
        elif ch == '"':
            m = _STRING.match(text, at)
            if m is None:
                if not top[2]:
                    break  # a cut key
                cut = _CUT_ESCAPE.search(text, at)
                text = (text[:cut.start(1)] if cut else text) + '"'
                top[1] = len(text)
                break
            at = m.end()
            if top[2]:
                top[1] = at
        elif ch in ":,":
            top[2] = ch == ":" or top[0] == "]"
            at += 1
        elif (m := _LITERAL.match(text, at)) is not None:
            at = m.end()
            if at < len(text) or m[0] in ("true", "false", "null") or m[0][-1].isdigit():
                top[1] = at
        else:
            at += 1
    return text[:open_containers[-1][1]] + "".join(c[0] for c in reversed(open_containers)) if open_containers else None


def recover(raw: str | None, repair: bool, require_key: str | None = None) -> str | None:
    """JSON text of the object found in ``raw``: as it stands, or closed where it was cut off; else None."""
    if raw is None:
        return None
    cleaned = strip_fences(raw)
    value, failed = _decode(cleaned, 0) if cleaned[:1] in ("{", "[") else (None, 0)
    if failed is None and cleaned[_DECODER.raw_decode(cleaned, 0)[1]:].strip() == "":
        return json.dumps(value, ensure_ascii=False)
    start = raw.find("{")
    if start < 0:
        return None
    value, failed = _decode(raw, start)
    if failed is None:
        return json.dumps(value, ensure_ascii=False)
    start = cleaned.find("{")
    if not repair or start < 0:
        return None
    # a string that never ends fails at its start, so all of it is still wanted
    failed = _decode(cleaned, start)[1]
    body = cleaned[start:]
    if failed is not None and failed < len(cleaned) and cleaned[failed] != '"':
        body = cleaned[start:failed]
    closed = close_truncated(body)
    value, failed = _decode(closed, 0) if closed else (None, 0)
    ok = failed is None and isinstance(value, dict) and (require_key is None or require_key in value)
    return json.dumps(value, ensure_ascii=False) if ok else None
