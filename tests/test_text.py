"""Text functions: literal cases, and random texts against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from candor.functions import code as C
from candor.functions import jsontext as J
from candor.functions import numbers as N
from candor.functions import style as S
from candor.functions import text as T


def random_texts(alphabet, count=400, longest=14, seed=7):
    generator = random.Random(seed)
    return ["".join(generator.choices(alphabet, k=generator.randint(0, longest))) for _ in range(count)]


def test_simple_numbers(evaluate):
    cases = {
        "The answer is 1,000": 1000.0, "Result: $1,234.56": 1234.56, "\\boxed{42}": 42.0, "The probability is 85%": 85.0, "Scientific: 1.5e10": 1.5e10,
        "Fraction: 3/4": 0.75, "Multiple numbers: 10, 20, 30, final answer: 100": 100.0, "\\boxed{1,500}": 1500.0, "The answer is \\boxed{-3.14}": -3.14,
        "No boxed, just 42 at the end": 42.0, "": None, "none": None,
    }
    assert evaluate(list(cases), N.simple_number_in) == list(cases.values())


def test_number_takes_last_match_but_first_fraction(evaluate):
    cases = {"1/2 then 3/4": 0.5, "5/0 and 7%": 7.0, "10% or 20%": 20.0, "1e3 or 2e3": 2000.0, ", alone": None, "\\boxed{3/4} of 9": 0.75, "\\boxed{} 5": 5.0}
    assert evaluate(list(cases), N.number_in) == list(cases.values())


def test_tags(evaluate):
    cases = {
        "<answer>42</answer>": "42", "<answer>42": "42", "<ANSWER>Case Insensitive</ANSWER>": "Case Insensitive", "<answer>Multi\nline\ncontent</answer>": "Multi\nline\ncontent",
        "<answer>Unclosed at end": "Unclosed at end", "<answer>\n  Whitespace handled  \n</answer>": "Whitespace handled", "No tag here": "",
        "<answer><nested>tag</nested></answer>": "<nested>tag</nested>", "<answer>": "", "Text before <answer>Content</answer> text after": "Content",
        "Text before <answer>Unclosed content": "Unclosed content", "<answer></answer> x": "", "<answer> <b>x": "",
    }
    assert evaluate(list(cases), lambda t: T.tag_body(t, "answer")) == list(cases.values())


def test_unclosed_tag_with_boxed_number(evaluate):
    output = "<plan>\n1. add\n</plan>\n<answer>The total cost is \\boxed{1,000}"
    assert evaluate([output], lambda t: N.simple_number_in(T.tag_body(t, "answer"))) == [1000.0]


def test_tags_on_random_texts(evaluate):
    texts = random_texts(["<a>", "</a>", "<A>", "x", " ", "\n", "<b>", "é"])

    def expected(text):
        closed = re.search("(?is)<a>(.*?)</a>", text)
        if closed:
            return closed[1].strip()
        rest = re.split("(?i)<a>", text, maxsplit=1)[1:]
        body = rest[0].strip() if rest else ""
        return "" if re.match(r"<\w+>", body) else body

    assert evaluate(texts, lambda t: T.tag_body(t, "a")) == [expected(t) for t in texts]


def balanced_end(text, depth):
    for i, char in enumerate(text):
        depth += (char == "{") - (char == "}")
        if char == "}" and depth == 0:
            return i
    return None


def test_boxed(evaluate):
    cases = {"\\boxed{5}": "5", "\\boxed{\\frac{1}{2}}": "\\frac{1}{2}", "\\boxed{\\frac{\\sqrt{a^{2}+b^{2}}}{c}}": "\\frac{\\sqrt{a^{2}+b^{2}}}{c}", "\\boxed{open": None}
    assert evaluate(list(cases), T.boxed) == list(cases.values())


def test_boxed_and_leading_object_on_random_texts(evaluate):
    texts = random_texts(["\\boxed{", "{", "}", "}", "x", "é"])
    parts = [t.split("\\boxed{", 1) for t in texts]
    ends = [balanced_end(p[1], 1) if len(p) > 1 else None for p in parts]
    assert evaluate(texts, T.boxed) == [None if e is None else p[1][:e] for p, e in zip(parts, ends)]
    texts = ["{" + t for t in random_texts(["{", "}", "x"])]
    ends = [balanced_end(t, 0) for t in texts]
    assert evaluate(texts, T.leading_object) == [None if e is None else t[: e + 1] for t, e in zip(texts, ends)]


def test_strip_matches_python(evaluate):
    texts = random_texts([chr(c) for c in T.SPACE_CODES] + ["a", "\u200b", "é"], longest=8)
    assert evaluate(texts, T.strip) == [t.strip() for t in texts]
    assert evaluate(texts, T.stripped_length) == [len(t.strip()) for t in texts]


def test_lines_match_python(evaluate):
    texts = random_texts(["\n", "\r", "\r\n", "\x0b", "\x0c", "\x1c", "\x85", "\u2028", "- ", "a", "b"])
    expected = [[x for x in (line.strip(" -\t") for line in t.splitlines()) if x] for t in texts]
    assert evaluate(texts, T.plan_steps) == expected


def test_steps(evaluate):
    assert evaluate(["<step> a </step><STEP>b</STEP>", "- a\n\n- b", "", "<step> </step>"], T.plan_steps) == [["a", "b"], ["a", "b"], [], []]
    assert evaluate(["1. a\n2) b\n• c", "x\ny", ""], T.listed_steps) == [["a", "b", "c"], ["x", "y"], []]


def test_scores(evaluate):
    assert evaluate(["4.5", "9", "-1", "x", ""], T.score_tag) == [4.5, 5.0, 0.0, None, None]
    assert evaluate(["<score>4</score>", "Score: 3.5", "none"], T.self_score) == [4.0, 3.5, None]


def test_truncation(evaluate):
    assert evaluate(["abcdef", "abc"], lambda t: T.truncate(t, 3)) == ["abc\n[TRUNCATED]", "abc"]
    assert evaluate(["abc\n[TRUNCATED]", "abc", None], T.was_truncated) == [True, False, False]


def test_is_close(spark):
    infinite, nan = float("inf"), float("nan")
    pairs = [(1.0, 1.0 + 1e-7), (1.0, 1.1), (nan, nan), (infinite, infinite), (infinite, -infinite), (infinite, 1.0), (0.0, 1e-7), (None, 1.0)]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a double, b double")
    got = [r["c"] for r in rows.select("i", N.is_close(F.col("a"), F.col("b"), 1e-6, 1e-6).alias("c")).orderBy("i").collect()]
    assert got == [True, False, False, True, False, False, True, None]


def test_retryable_and_timestamp(evaluate):
    assert evaluate(["HTTP 429", "Rate Limit reached", "bad input", None], T.is_retryable) == [True, True, False, False]
    seconds = evaluate(["1970-01-01T00:01:00Z", "1970-01-01T01:00:00+01:00", "later"], lambda t: F.unix_seconds(T.iso_timestamp(t)))
    assert seconds == [60, 0, None]


def test_channels(evaluate):
    text = '<|channel|>analysis<|message|>Plan<|end|><|start|>assistant<|channel|>commentary to=functions.f<|constrain|>json<|message|>{"a":1}<|call|><|start|>assistant<|channel|>final<|message|>Done.<|return|>'
    got = evaluate([text, "plain"], lambda t: F.array(*[T.channel_text(t, c) for c in T.CHANNELS]))
    assert got == [["Plan", '{"a":1}', "Done."], ["", "", "plain"]]


def test_contractions(evaluate):
    texts = ["I don't, DON'T", "the dont’t", "don’t", "O'clock y'all"]
    assert evaluate(texts, S.contractions) == [["don't", "DON'T"], [], [], ["O'clock", "y'all"]]
    assert evaluate(["don’t"], lambda t: S.contractions(t, normalize_quotes=True)) == [["don't"]]


def test_language(evaluate):
    cases = {
        "```js\nx": ("javascript", 0.95), "```rust\nx": ("python", 0.3), "def f():\n  return 1": ("python", 0.7), "hello": ("python", 0.2),
        "SELECT a FROM b WHERE c": ("sql", 0.8), "let x": ("javascript", 0.6), "echo $(x)": ("bash", 0.7), "": ("python", 0.2),
    }
    got = evaluate(list(cases), C.language_of)
    assert [(r["language"], round(r["confidence"], 6)) for r in got] == list(cases.values())


def test_code(evaluate):
    texts = ["a ```python\nx = 1\n``` b", "```\ny\n```", "prose", "import os"]
    assert evaluate(texts, C.code_or_text) == ["x = 1", "y", "prose", "import os"]
    assert evaluate(texts, lambda t: C.code_in(t, F.lit("python"))) == ["x = 1", "y", None, "import os"]


def test_python_grammar(evaluate):
    got = evaluate(["class A:\n  def f(self): pass", "def f(:", "x = 'a\0b'", "", None], C.python_syntax_of)
    assert [r["is_valid"] for r in got] == [True, False, False, None, None]
    assert [r["confidence"] for r in got][:2] == [0.8, 1.0]
    assert (got[0]["has_function"], got[0]["has_class"]) == (True, True)


def test_bracket_issues_on_random_code(evaluate):
    import random

    closes = {"(": ")", "{": "}", "[": "]"}

    def balanced(code):
        stack, inside, i = [], None, 0
        while i < len(code):
            char, two = code[i], code[i : i + 2]
            if i and code[i - 1] == "\\":
                pass
            elif inside in ("//", "/*"):
                ends = char == "\n" if inside == "//" else two == "*/"
                i += ends and inside == "/*"
                inside = None if ends else inside
            elif inside:
                inside = None if char == inside else inside
            elif char in "\"'`":
                inside = char
            elif two in ("//", "/*"):
                inside, i = two, i + 1
            elif char in closes:
                stack.append(char)
            elif char in closes.values():
                if not stack or closes[stack.pop()] != char:
                    return False
            i += 1
        return not stack

    rng = random.Random(2)
    texts = ["".join(rng.choice("(){}[]\"'`ab\n/*") for _ in range(rng.randint(0, 12))) for _ in range(4000)] + ["", "x"]
    texts += ["".join(rng.choice(["()", "[]", "{", "}", "(", ")", "\"(\"", "// )\n", "/* [ */", "'\\''"]) for _ in range(rng.randint(1, 8))) for _ in range(2000)]
    got = evaluate(texts, C.bracket_issues)
    assert [not g for g in got] == [balanced(t) for t in texts] and 500 < sum(map(balanced, texts)) < 4000


@pytest.mark.parametrize("code, issues", [
    ("([)]", ["crossed"]), ("(", ["unclosed"]), (")(", ["unopened"]), ("({[]})", []), ("// (((\n()", []), ("/* { */ ()", []), ("'(' + `[` + \"{\"", []), ("/* (", []), (None, None),
])
def test_bracket_issues(evaluate, code, issues):
    assert evaluate([code], C.bracket_issues) == [issues]


def test_brackets_take_linear_time(evaluate):
    half = 40_000
    deep, flat = "(" * half + ")" * half, "()" * half
    assert evaluate([deep, flat, deep + ")"], C.bracket_issues) == [[], [], ["unopened"]]


def test_javascript(evaluate):
    cases = {"function f(){ return 1; }": True, "const = 3": False, "let s = 'it": False, "if (a)": False, "for (;;)": False, "`a": False, "function ()": False, "f(']')": True}
    assert [r["is_valid"] for r in evaluate(list(cases), C.javascript_syntax)] == list(cases.values())


def test_strict_json(evaluate):
    cases = {'{"a": 1} x': None, '{"a":1},{"b":2}': None, "": None, '{"b": 1.0, "a": 2}': '{"a":2,"b":1}', "[1]": "[1]", "nope": None, '{"a": 1}] and {"b": 2}': None, "1] , [2": None, '1}, {"b": 2': None, " 7 ": "7"}
    assert evaluate(list(cases), lambda t: F.to_json(J.parse(t))) == list(cases.values())


def test_judge_json(evaluate):
    cases = {
        "{'is_correct': True, 'value': None}": '{"is_correct":true,"value":null}', '{"a": {"b": 1}} tail }': '{"a":{"b":1}}', 'so ```json\n{"a": 2}\n```': '{"a":2}',
        '{"r": "\\sqrt{2}"}': '{"r":"\\\\sqrt{2}"}', "no": None,
        # A known escape letter is kept as an escape, so \frac loses its backslash.
        '{"r": "\\frac"}': '{"r":"\\frac"}',
    }
    assert evaluate(list(cases), lambda t: F.to_json(J.judge_json(t))) == list(cases.values())


@pytest.mark.parametrize(
    "data, truth, exact, fuzzy",
    [
        ('{"a": 1, "z": 2}', '{"a": 1.0}', True, True), ('{"A_b": "X"}', '{"ab": "x"}', False, True), ('{"a": {"B": "72", "c": 1}}', '{"a": {"b": 72}}', False, True),
        ('{"a": "yes"}', '{"a": true}', False, True), ('{"a": 1}', '{"b": 1}', False, False), ('{"a": {"b": {"c": {"d": "X"}}}}', '{"a": {"b": {"c": {"d": "x"}}}}', False, True),
        ('{"a": 1}', "{}", True, True), ('{"a": null}', '{"a": null}', True, True), ('{"a": "no"}', '{"a": "off"}', False, True), ('{"a": 1}', '{"a": 2}', False, False),
    ],
)
def test_object_comparison(spark, data, truth, exact, fuzzy):
    row = spark.createDataFrame([(data, truth)], "d string, t string")
    parsed = row.select(J.parse(F.col("d")).alias("d"), J.parse(F.col("t")).alias("t"))
    assert tuple(parsed.select(J.covers_exactly(J.as_object(F.col("d")), J.as_object(F.col("t"))), J.covers_fuzzily(F.col("d"), F.col("t"))).first()) == (exact, fuzzy)


def nested(depth, leaf, key="k_{}"):
    return "".join(f'{{"{key.format(i)}": ' for i in range(depth)) + leaf + "}" * depth


@pytest.mark.parametrize("depth", range(1, 9))
def test_comparisons_at_any_depth(spark, depth):
    cases = [(nested(depth, '"X"'), nested(depth, '"x"', "K{}"), True), (nested(depth, '"X"'), nested(depth, '"y"', "K{}"), False), (nested(depth, "7"), nested(depth, '"7d"'), False)]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], "i int, a string, b string")
    parsed = rows.select("i", J.parse(F.col("a")).alias("a"), J.parse(F.col("b")).alias("b"))
    assert [r["c"] for r in parsed.select("i", J.covers_fuzzily(F.col("a"), F.col("b")).alias("c")).orderBy("i").collect()] == [c for _, _, c in cases]
    results = [(nested(depth, '{"a": 1}'), nested(depth, '{"a": 2}'), True), (nested(depth, '{"b": 1}'), nested(depth, '{"a": 1}'), False)]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(results)], "i int, a string, b string")
    parsed = rows.select("i", J.parse(F.col("a")).alias("a"), J.parse(F.col("b")).alias("b"))
    assert [r["c"] for r in parsed.select("i", J.same_result(F.col("a"), F.col("b")).alias("c")).orderBy("i").collect()] == [c for _, _, c in results]


@pytest.mark.parametrize("text, number", [("7", 7.0), ("-1.5e3", -1500.0), (" .5 ", 0.5), ("7d", None), ("5F", None), ("0x1p3", None), ("1e1d", None), ("", None), ("inf", float("inf"))])
def test_decimal_numbers_only(evaluate, text, number):
    assert evaluate([text], J.number_of) == [number]


def test_long_arithmetic_does_not_overflow_the_stack(evaluate):
    long = ["ans " + "1+" * 30_000 + "1", "x = " + "2*" * 30_000 + "2"]
    assert len(evaluate(long, N.normalized_expression)) == len(long)
