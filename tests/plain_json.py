"""Plain comparisons of JSON values, walked pair by pair: what the path rows are checked against."""

from __future__ import annotations

import json
import re

from candor.functions.jsonpaths import FALSE_WORDS, NUMBER, TRUE_WORDS

_NUMBER = re.compile(NUMBER)


def _whole(value) -> str:
    return json.dumps(value, sort_keys=True)


def _is_number(value) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


def _number(value) -> float | None:
    if isinstance(value, str):
        return float(value.strip()) if _NUMBER.fullmatch(value.strip()) else None
    return float(value) if _is_number(value) else None


def _same_leaf(a, b) -> bool:
    """Loose equality: same value, same text in any case, same number, both true or both false words."""
    if _whole(a) == _whole(b) or _is_number(a) and _is_number(b) and a == b:
        return True
    x, y = (str(v).lower() if isinstance(v, (str, bool)) else None for v in (a, b))
    if isinstance(a, str) and isinstance(b, str) and x == y:
        return True
    m, n = _number(a), _number(b)
    return (m is not None and m == n) or (x in TRUE_WORDS and y in TRUE_WORDS) or (x in FALSE_WORDS and y in FALSE_WORDS)


def _plain(key: str) -> str:
    return key.lower().replace("_", "").replace("-", "")


def covers(data, truth) -> bool:
    pairs = [(data, truth)]
    while pairs:
        a, b = pairs.pop()
        if isinstance(a, dict) and isinstance(b, dict):
            own = {_plain(k): v for k, v in a.items()}
            if any(_plain(k) not in own for k in b):
                return False
            pairs.extend((own[_plain(k)], v) for k, v in b.items())
        elif not _same_leaf(a, b):
            return False
    return True


def same_result(actual, expected) -> bool:
    pairs = [(actual, expected)]
    while pairs:
        a, b = pairs.pop()
        if _whole(a) == _whole(b):
            continue
        if isinstance(a, dict) and isinstance(b, dict):
            if any(k not in a for k in b):
                return False
            # Values only matter where an object is expected.
            pairs.extend((a[k], v) for k, v in b.items() if isinstance(v, dict))
        elif not (_is_number(a) and _is_number(b) and abs(a - b) < 0.01 * max(abs(a), abs(b), 1.0)):
            return False
    return True


def _kinds(value) -> tuple[str, ...]:
    """JSON Schema type names that a value has."""
    if isinstance(value, bool):
        return ("boolean",)
    if _is_number(value):
        return ("integer", "number") if float(value).is_integer() else ("number",)
    return ({dict: "object", list: "array", str: "string", type(None): "null"}[type(value)],)


def conforms(value, schema) -> bool:
    pairs = [(value, schema)]
    while pairs:
        v, rules = pairs.pop()
        if not isinstance(rules, dict):
            continue
        wanted = rules.get("type")
        wanted = [wanted] if isinstance(wanted, str) else wanted
        if isinstance(wanted, list) and not any(w in _kinds(v) for w in wanted):
            return False
        choices = rules.get("enum")
        if isinstance(choices, list) and _whole(v) not in map(_whole, choices):
            return False
        properties = rules.get("properties") if isinstance(rules.get("properties"), dict) else {}
        if isinstance(v, dict):
            required = rules.get("required")
            if isinstance(required, list) and any(isinstance(k, str) and k not in v for k in required):
                return False
            if rules.get("additionalProperties") is False and any(k not in properties for k in v):
                return False
            pairs.extend((v[k], inner) for k, inner in properties.items() if k in v)
        elif isinstance(v, list) and isinstance(rules.get("items"), dict):
            pairs.extend((x, rules["items"]) for x in v)
    return True
