"""Scorers for maths, units, code and tool calls.

Each scorer returns struct<is_correct, confidence, explanation, method, verifier_name>. Unreadable
input becomes a failed score through `try_*` functions; it never fails the job.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candor.config import DEFAULTS, Thresholds
from candor.functions import jsonpaths as P
from candor.functions import jsontext as J
from candor.functions.code import code_in, code_or_text, javascript_syntax, language_of, python_syntax_of
from candor.functions.numbers import is_close, normalized_expression, number_in, same_quantity
from candor.functions.text import bind, non_empty, strip
from candor.operators.joins import attach_execution, fresh, one_per_key
from candor.operators.reports import case_pass_rates
from candor.operators.selection import scorer_for

SCORE = "struct<is_correct:boolean,confidence:double,explanation:string,method:string,verifier_name:string>"


def score(name: str, correct: Column | bool, confidence: Column | float, explanation: str | Column, method: str | Column) -> Column:
    def lit(value):
        return value if isinstance(value, Column) else F.lit(value)

    return F.struct(
        lit(correct).alias("is_correct"), lit(confidence).cast("double").alias("confidence"), lit(explanation).alias("explanation"),
        lit(method).alias("method"), F.lit(name).alias("verifier_name"),
    ).cast(SCORE)


def failure(name: str, explanation: str, method: str) -> Column:
    return score(name, False, 0.0, explanation, method)


def math_score(answer: Column, truth: Column, limits: Thresholds = DEFAULTS) -> Column:
    """Equal expressions 1.0, equal quantities with units 1.0, equal numbers 0.9, else 0."""
    name = "math"
    cap = limits.max_expression_size
    short = [t if cap is None else F.when(F.length(t) <= cap, t) for t in (answer, truth)]
    tolerance = limits.numeric_tolerance

    def numeric(numbers: Column) -> Column:
        left, right = numbers["left"], numbers["right"]
        same = is_close(left, right, tolerance, tolerance)
        return (
            F.when(left.isNull() | right.isNull(), failure(name, "No numeric value", "no_number"))
            .when(same & (F.abs(left) == float("inf")), score(name, True, 1.0, "Same infinite value", "numeric"))
            .when(same, score(name, True, 0.9, "Same number", "numeric"))
            .otherwise(failure(name, "Different numbers", "numeric"))
        )

    return (
        F.when(truth.isNull(), failure(name, "No ground truth", "missing_truth"))
        .when(~non_empty(answer), failure(name, "No answer text", "missing_answer"))
        .when(short[0].isNull() | short[1].isNull(), failure(name, "Expression too large", "too_large"))
        .when(normalized_expression(short[0]) == normalized_expression(short[1]), score(name, True, 1.0, "Same expression", "expression"))
        .when(same_quantity(short[0], short[1], limits.unit_tolerance), score(name, True, 1.0, "Same quantity", "units"))
        .otherwise(bind(F.struct(number_in(short[0]).alias("left"), number_in(short[1]).alias("right")), numeric))
    )


def units_score(answer: Column, truth: Column, limits: Thresholds = DEFAULTS) -> Column:
    """Value and unit only: same dimension and close values 1.0, else 0."""
    same = same_quantity(answer, truth, limits.unit_tolerance)
    return F.when(same, score("math", True, 1.0, "Same quantity", "units")).otherwise(failure("math", "Different quantity", "units"))


def succeeded(exit_code: Column, timed_out: Column, error: Column) -> Column:
    return F.coalesce((exit_code == 0) & ~F.coalesce(timed_out, F.lit(False)) & error.isNull(), F.lit(False))


def output_score(ran: Column, stdout: Column, truth: Column) -> Column:
    """Output equal 1.0, containing the truth 0.85, numerically equal 0.95; without a truth, having run counts 0.5."""
    texts = F.struct(strip(F.coalesce(stdout, F.lit(""))).alias("actual"), strip(truth).alias("expected"))
    return bind(texts, lambda both: _ran_score(ran, both["actual"], both["expected"]))


def _ran_score(ran: Column, actual: Column, expected: Column) -> Column:
    """`output_score` of stripped texts."""
    name = "code"
    close = F.abs(J.number_of(expected) - J.number_of(actual)) < 1e-6
    return (
        F.when(~ran, failure(name, "Execution failed", "execution"))
        .when(expected.isNull(), score(name, True, 0.5, "Code ran", "execution_only"))
        .when(actual == expected, score(name, True, 1.0, "Output matches", "output_exact"))
        .when(F.contains(actual, expected), score(name, True, 0.85, "Output contains the truth", "output_substring"))
        .when(close, score(name, True, 0.95, "Output is numerically equal", "output_numeric"))
        .otherwise(failure(name, "Output differs", "output"))
    )


def code_score(answer: Column, truth: Column, ran: Column, stdout: Column, language: Column | None = None) -> Column:
    """Output score of answers that hold code at all."""
    name = "code"
    spoken = language_of(answer)["language"]
    spoken = F.coalesce(language, spoken) if language is not None else spoken
    found = bind(spoken, lambda used: bind(code_in(answer, used), non_empty))
    return (
        F.when(~non_empty(answer), failure(name, "No answer text", "missing_answer"))
        .when(~found, failure(name, "No code in the answer", "no_code"))
        .otherwise(output_score(ran, stdout, truth))
    )


def code_scores(df: DataFrame, only: Column | None = None, answer: str = "answer", truth: str = "ground_truth", name: str = "code_score") -> DataFrame:
    """Adds `code_score` for the rows of `only`. What is mentioned often is a column of its own here, for which Spark generates code, as it does not inside `bind`."""
    wanted = F.lit(True) if only is None else only
    text = F.col(answer)
    spoken = df.withColumn("_language", F.when(wanted, language_of(text)["language"]))
    ran = succeeded(F.col("exec_exit_code"), F.col("exec_timed_out"), F.col("exec_error"))
    spoken = spoken.withColumns({
        "_code": F.when(wanted, non_empty(code_in(text, F.col("_language")))),
        "_output": F.when(wanted & ran, strip(F.coalesce(F.col("exec_stdout"), F.lit("")))), "_expected": F.when(wanted & ran, strip(F.col(truth))),
    })
    result = (
        F.when(~non_empty(text), failure("code", "No answer text", "missing_answer"))
        .when(~F.col("_code"), failure("code", "No code in the answer", "no_code"))
        .otherwise(_ran_score(ran, F.col("_output"), F.col("_expected")))
    )
    return spoken.withColumn(name, F.when(wanted, result)).drop("_language", "_code", "_output", "_expected")


def case_passed(ran: Column, stdout: Column, expected: Column) -> Column:
    actual, wanted = strip(F.coalesce(stdout, F.lit(""))), strip(F.coalesce(expected, F.lit("")))
    return ran & ((actual == wanted) | F.contains(actual, wanted))


def case_scores(df: DataFrame, cases: DataFrame, results: DataFrame) -> DataFrame:
    """Per candidate with test cases: passed, total and the verdict (all pass, their share, none).

    `cases` has a query's expected outputs in order (`query_id`, `cases`), `results` a row per query_id, candidate_idx and case_no. A case without a result fails. A case
    meets its result by three keys, so a query with very many candidates is spread; queries without a case have no row.
    """
    lists = one_per_key(cases.select("query_id", "cases"), ["query_id"]).select(fresh(F.col("query_id")).alias("query_id"), "cases")
    wanted = df.select("query_id", "candidate_idx").join(lists, "query_id").select("query_id", "candidate_idx", F.posexplode("cases").alias("case_no", "expected_output"))
    joined = attach_execution(wanted, results, ["query_id", "candidate_idx", "case_no"])
    ran = succeeded(F.col("exec_exit_code"), F.col("exec_timed_out"), F.col("exec_error")) & F.col("exec_exit_code").isNotNull()
    return case_pass_rates(joined.withColumn("passed", F.coalesce(case_passed(ran, F.col("exec_stdout"), F.col("expected_output")), F.lit(False))))


# --- tool calls ------------------------------------------------------------------------------------

def required_fields_missing(call: Column, required: Column) -> Column:
    """Required field names that the call map lacks."""
    return F.array_except(required, F.map_keys(call))


def parameter_types(call: Column) -> Column:
    """struct(ok, confidence): parameters must be an object; number-looking strings only lower the confidence."""


    def judged(parts: Column) -> Column:
        nothing, fields = parts["nothing"], parts["fields"]
        suspicious = F.exists(F.map_values(fields), lambda v: J.looks_numeric(J.text_of(v)))
        return F.struct(
            (nothing | fields.isNotNull()).alias("ok"),
            F.when(nothing, 0.8).when(fields.isNull(), 0.0).when(suspicious, 0.7).otherwise(0.9).alias("confidence"),
        )

    def parts(arguments: Column) -> Column:
        return F.struct((call.isNull() | arguments.isNull()).alias("nothing"), J.as_object(arguments).alias("fields"))

    return bind(bind(J.tool_arguments(call), parts), judged)


def conforms(value: Column, schema: Column) -> Column:
    """The set-checkable part of a JSON Schema, at any depth: type, enum, required, properties, additionalProperties, items. Both VARIANT.

    For many values and few schemas, make the `constraints` once per schema and join them (`schema_table`).
    """
    return P.meets(P.document(value), P.constraints(schema))


def schema_table(schemas: DataFrame, schema: str = "schema") -> DataFrame:
    """Schemas (VARIANT) as constraints: the same rows with that column read once, to be joined to any number of calls."""
    return schemas.withColumn(schema, P.constraints(F.col(schema)))


def truth_comparison(data: Column, truth: Column) -> Column:
    """VARIANT against the VARIANT of a truth text (NULL: not JSON): equal 1.0, truth contained 0.9, loosely contained 0.85, else 0."""
    name = "tool"
    a, b = J.as_object(data), J.as_object(truth)
    # The loose comparison looks at what the cheaper ones leave open.
    equal = J.canonical(data) == J.canonical(truth)
    contained = J.covers_exactly(a, b)
    left = ~F.coalesce(equal, F.lit(False)) & ~F.coalesce(contained, F.lit(False))
    loose = bind(F.when(left, F.struct(data.alias("data"), truth.alias("truth"))), lambda pair: J.covers_fuzzily(pair["data"], pair["truth"]))
    return (
        F.when(truth.isNull(), failure(name, "Ground truth is not valid JSON", "bad_truth"))
        .when(equal, score(name, True, 1.0, "Equal to the truth", "ground_truth_exact"))
        .when(contained, score(name, True, 0.9, "Contains the truth", "ground_truth_lenient"))
        .when(loose, score(name, True, 0.85, "Loosely contains the truth", "ground_truth_fuzzy"))
        .otherwise(failure(name, "Differs from the truth", "ground_truth"))
    )


def call_in(answer: Column) -> Column:
    """VARIANT of the tool call in an answer: header form first, then JSON; NULL if unreadable."""


    def as_call(header: Column) -> Column:
        whole = F.struct(
            header["tool"].alias("tool"), header["tool"].alias("function"), header["recipient"].alias("recipient"),
            header["namespace"].alias("namespace"), header["parameters"].alias("parameters"),
        )
        return F.when(header.isNotNull(), F.parse_json(F.to_json(whole)))

    found = bind(J.json_in(answer), lambda v: F.when(~F.is_variant_null(v), v))
    return F.coalesce(bind(J.header_call(answer), as_call), found)


def settled(df: DataFrame, name: str) -> DataFrame:
    """The same rows. Spark follows a key of a join back through all columns it is made of, which multiplies with every step that mentions a column twice; it stops at a column that is generated."""
    return df.select(*[c for c in df.columns if c != name], F.explode(F.array(F.col(name))).alias(name))


def calls_in(df: DataFrame, answer: str, name: str) -> DataFrame:
    """Adds `call_in` of column `answer`, step by step as columns, for which Spark generates code."""
    text = F.col(answer)
    header = df.withColumn("_recipient", F.when(F.contains(text, F.lit("to=")), F.regexp_extract(text, r"(?U)to=([\w.]+)", 1)))
    # A header needs no more than its braces, other answers need no header.
    recipient = F.col("_recipient")
    braces = F.when(non_empty(recipient), J.first_match(text, r"(?s)\{.*\}", 0))
    header = header.withColumns({"_braces": braces, "_body": F.when(~non_empty(recipient), J.json_body(text))})
    header = header.withColumn("_json", F.coalesce(F.col("_braces"), J.json_part(F.col("_body"))))
    header = header.withColumn("_value", J.parse(F.col("_json")))
    value = F.col("_value")
    whole = F.struct(*[part.alias(n) for n, part in J.header_parts(recipient, value).items()])
    found = F.when(non_empty(recipient), F.parse_json(F.to_json(whole))).when(~F.is_variant_null(value), value)
    return header.withColumn(name, found).drop("_recipient", "_braces", "_body", "_json", "_value")


def truth_scores(df: DataFrame, data: str, fields: str, truth: str, name: str) -> DataFrame:
    """Adds `truth_comparison` of the VARIANT column `data` (its map in `fields`) and the text column `truth`, for rows with a truth.

    The cheap comparisons are columns with generated code; most calls that they leave open are settled by their keys or as short plain texts, the others as documents.
    """
    verifier = "tool"
    df = df.withColumn("_truth", J.parse(F.col(truth)))
    a, b = F.col(fields), F.col("_expected")
    read = F.col("_truth").isNotNull()
    df = df.withColumns({"_expected": J.as_object(F.col("_truth")), "_left": F.when(read, J.canonical(F.col(data))), "_right": J.canonical(F.col("_truth"))})
    df = df.withColumn("_equal", F.coalesce(F.col("_left") == F.col("_right"), F.lit(False)))
    objects = ~F.col("_equal") & a.isNotNull() & b.isNotNull()
    subset = F.size(F.array_except(F.map_keys(b), F.map_keys(a))) == 0
    df = df.withColumn("_contained", F.when(objects & subset, J.covers_exactly(a, b)).otherwise(F.lit(False)))
    left = objects & ~F.col("_contained")
    df = df.withColumns({"_a": F.when(left, P.simple_text(F.col("_left"))), "_b": F.when(left, P.simple_text(F.col("_right")))})
    plain = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    df = df.withColumns({"_a": F.when(plain, P.plain_text(F.col("_a"))), "_b": F.when(plain, P.plain_text(F.col("_b")))})
    df = df.withColumns({"_ka": F.when(plain, P.plain_keys(F.col("_a"))), "_kb": F.when(plain, P.plain_keys(F.col("_b")))})
    once = lambda keys: F.size(F.array_distinct(keys)) == F.size(keys)
    quick = (
        F.when(F.size(F.array_except(F.col("_kb"), F.col("_ka"))) > 0, F.lit(False))
        .when(once(F.col("_ka")) & once(F.col("_kb")), F.when(F.col("_a") == F.col("_b"), F.lit(True)).otherwise(P.plain_covers(P.plain_rows(F.col("_a")), P.plain_rows(F.col("_b")))))
    )
    df = df.withColumn("_quick", F.when(plain, quick))
    loose = F.when(left, F.coalesce(F.col("_quick"), J.covers_fuzzily(F.col(data), F.col("_truth"))))
    result = (
        F.when(~read, failure(verifier, "Ground truth is not valid JSON", "bad_truth"))
        .when(F.col("_equal"), score(verifier, True, 1.0, "Equal to the truth", "ground_truth_exact"))
        .when(F.col("_contained"), score(verifier, True, 0.9, "Contains the truth", "ground_truth_lenient"))
        .when(loose, score(verifier, True, 0.85, "Loosely contains the truth", "ground_truth_fuzzy"))
        .otherwise(failure(verifier, "Differs from the truth", "ground_truth"))
    )
    added = ["_truth", "_expected", "_left", "_right", "_equal", "_contained", "_a", "_b", "_ka", "_kb", "_quick"]
    return df.withColumn(name, F.when(F.col(truth).isNotNull(), result)).drop(*added)


def tool_scores(
    df: DataFrame,
    answer: str = "answer",
    truth: str | None = "ground_truth",
    schema: str | None = None,
    catalog: str | None = None,
    required: str | None = None,
    only: Column | None = None,
    name: str = "tool_score",
    limits: Thresholds = DEFAULTS,
) -> DataFrame:
    """Adds the tool score: parse, schema, catalog, required fields, parameter types, truth; first failure wins.

    `schema` is a VARIANT column or the constraints that `schema_table` makes of one, `catalog` and `required` are string arrays. The parsed call is a
    column of its own, so each answer is parsed once, and rows outside `only` are never parsed. All of it is a projection.
    """
    verifier = "tool"
    given = set(df.columns)
    text = F.col(answer) if only is None else F.when(only, F.col(answer))
    usable = text if limits.max_json_size is None else F.when(F.length(text) <= limits.max_json_size, text)
    parsed = calls_in(df.withColumns({"_text": text, "_usable": usable}), "_usable", "_call")
    parsed = parsed.withColumn("_fields", J.as_object(F.col("_call")))
    call, fields, text = F.col("_call"), F.col("_fields"), F.col("_text")
    result = (
        F.when(~non_empty(text), failure(verifier, "No answer text", "missing_answer"))
        .when(F.col("_usable").isNull(), failure(verifier, "JSON too large", "too_large"))
        .when(call.isNull(), failure(verifier, "No JSON in the answer", "no_json"))
    )
    if limits.schema_validation == "none":
        result = result.otherwise(score(verifier, True, 0.5, "Valid JSON", "syntax_only"))
        return settled(parsed.withColumn(name, result).drop(*set(parsed.columns) - given - {name}), name)
    # Up to here and in the next step only calls are looked at, so no other row reads its specification.
    parsed = parsed.withColumn("_open", call.isNotNull())
    if schema:
        rules = F.col(schema) if isinstance(df.schema[schema].dataType, StructType) else P.constraints(F.col(schema))
        parsed = parsed.withColumn("_rules", F.when(F.col("_open"), rules))
        ruled = F.col("_rules").isNotNull()
        parsed = parsed.withColumn("_ruled", F.when(ruled, J.canonical(call)))
        met = F.coalesce(P.meets_plainly(P.plain_rows(P.simple_text(F.col("_ruled"))), F.col("_rules")), P.meets(P.document(call), F.col("_rules")))
        parsed = parsed.withColumn("_violated", F.coalesce(F.when(ruled, ~met), F.lit(False)))
        result = result.when(F.col("_violated"), failure(verifier, "Schema violated", "schema"))
        parsed = parsed.withColumn("_open", F.col("_open") & ~F.col("_violated"))
    if catalog and limits.validate_tool_exists:
        parsed = parsed.withColumns({"_catalog": F.when(F.col("_open"), F.col(catalog)), "_tool": F.when(F.col("_open"), J.tool_name(fields))})
        known = F.coalesce(F.array_contains(F.col("_catalog"), F.col("_tool")), F.lit(False))
        parsed = parsed.withColumn("_unknown", F.coalesce((F.size("_catalog") > 0) & ~known, F.lit(False)))
        result = result.when(F.col("_unknown"), failure(verifier, "Unknown tool", "tool_exists"))
        parsed = parsed.withColumn("_open", F.col("_open") & ~F.col("_unknown"))
    if required:
        parsed = parsed.withColumn("_required", F.when(F.col("_open"), F.col(required)))
        missing = F.coalesce(F.size(required_fields_missing(fields, F.col("_required"))), F.lit(1)) > 0
        parsed = parsed.withColumn("_missing", F.coalesce((F.size("_required") > 0) & missing, F.lit(False)))
        result = result.when(F.col("_missing"), failure(verifier, "Missing required fields", "required_fields"))
        parsed = parsed.withColumn("_open", F.col("_open") & ~F.col("_missing"))
    if limits.validate_parameter_types:
        parsed = parsed.withColumn("_given", F.when(F.col("_open"), J.tool_arguments(fields)))
        parsed = parsed.withColumn("_untyped", F.col("_given").isNotNull() & J.as_object(F.col("_given")).isNull())
        result = result.when(F.col("_untyped"), failure(verifier, "Parameters must be an object", "parameter_types"))
        parsed = parsed.withColumn("_open", F.col("_open") & ~F.col("_untyped"))
    if truth:
        parsed = truth_scores(parsed.withColumn("_asked", F.when(F.col("_open") & non_empty(F.col(truth)), F.col(truth))), "_call", "_fields", "_asked", "_compared")
        result = result.when(F.col("_asked").isNotNull(), F.col("_compared"))
    result = result.otherwise(score(verifier, True, 0.95, "Valid tool call", "full_validation"))
    result = result if only is None else F.when(only, result)
    return settled(parsed.withColumn(name, result).drop(*set(parsed.columns) - given - {name}), name)


# --- described operations --------------------------------------------------------------------------

def api_operations(descriptions: DataFrame, key: str, description: str = "description", follow: int = 8) -> DataFrame:
    """Operations of API descriptions (VARIANT): `key`, `operation_id`, `path`, `method` and the constraints of the request body (`rules`, NULL without one).

    References to the schemas of the same description are replaced by these, level by level, `follow` times; what a schema that contains itself
    refers to beyond that is open. Of operations with the same id one with a schema counts, first by path and method. Descriptions are few and calls are many, so
    all reading of schemas happens here.
    """
    inside = lambda value, *names: reduce(lambda v, n: J.field(J.as_object(v), n), names, value)
    spec = F.col(description)
    paths = descriptions.select(key, inside(spec, "components", "schemas").alias("_named"), F.explode(F.map_entries(J.as_object(inside(spec, "paths")))).alias("_path"))
    methods = paths.select(key, "_named", F.col("_path.key").alias("path"), F.explode(F.map_entries(J.as_object(F.col("_path.value")))).alias("_method"))
    operation = F.col("_method.value")
    named = F.map_entries(F.coalesce(J.as_object(F.col("_named")), F.create_map().cast(J.MAP)))

    def followed(text: Column, _: Column) -> Column:
        return F.aggregate(named, text, lambda t, s: F.replace(t, F.concat(F.lit('{"$ref":"#/components/schemas/'), s["key"], F.lit('"}')), J.canonical(s["value"])))

    schema = J.canonical(inside(operation, "requestBody", "content", "application/json", "schema"))
    whole = F.when(F.contains(schema, F.lit('{"$ref":')), F.aggregate(F.sequence(F.lit(1), F.lit(follow)), schema, followed)).otherwise(schema)
    rows = methods.select(
        key, J.text_of(inside(operation, "operationId")).alias("operation_id"), "path", F.col("_method.key").alias("method"), P.constraints(F.try_parse_json(whole)).alias("rules")
    ).where("operation_id IS NOT NULL")
    first = F.min_by(F.struct("path", "method", "rules"), F.struct(F.col("rules").isNull(), "path", "method"))
    return rows.groupBy(key, "operation_id").agg(first.alias("_first")).select(key, "operation_id", "_first.*")


def api_scores(df: DataFrame, operations: DataFrame, key: str, answer: str = "answer", name: str = "api_score") -> DataFrame:
    """Adds the score of tool answers against the operation that has the called tool's name in the description of `key` (`api_operations`)."""
    verifier = "tool_openapi"
    parsed = df.withColumn("_call", call_in(F.col(answer)))
    fields = J.as_object(F.col("_call"))
    nested = J.text_of(J.field(J.as_object(J.field(fields, "function")), "name"))
    parsed = parsed.withColumn("_tool", F.coalesce(J.text_of(J.field(fields, "name")), nested, J.text_of(J.field(fields, "tool"))))
    side = operations.select(F.col(key).alias("_key"), fresh(F.col("operation_id")).alias("_operation"), F.col("rules").alias("_rules"), F.lit(True).alias("_found"))
    joined = parsed.join(side, (parsed[key] == F.col("_key")) & (F.col("_tool") == F.col("_operation")), "left")
    given = F.coalesce(J.tool_arguments(fields), F.parse_json(F.lit("{}")))
    met = P.meets(P.document(F.when(F.col("_rules").isNotNull(), given)), F.col("_rules"))
    result = (
        F.when(~non_empty(F.col(answer)), failure(verifier, "No answer text", "missing_answer"))
        .when(F.col("_call").isNull(), failure(verifier, "No JSON in the answer", "no_json"))
        .when(~non_empty(F.col("_tool")), failure(verifier, "No tool name", "no_tool"))
        .when(F.col("_found").isNull(), failure(verifier, "Unknown operation", "operation"))
        .when(F.col("_rules").isNull(), score(verifier, True, 0.8, "Known operation without a schema", "openapi"))
        .when(met, score(verifier, True, 1.0, "Meets the operation's schema", "schema"))
        .otherwise(failure(verifier, "Schema violated", "schema"))
    )
    return joined.withColumn(name, result).drop("_call", "_tool", "_key", "_operation", "_rules", "_found")


# --- syntax audit ----------------------------------------------------------------------------------

def syntax_checks(df: DataFrame, answer: str = "answer") -> DataFrame:
    """Adds language, is_valid, syntax_confidence. Only python rows reach the grammar check in Python workers."""
    spoken = df.withColumn("language", language_of(F.col(answer))["language"])
    is_python, is_script = F.col("language") == "python", F.col("language") == "javascript"
    checked = spoken.withColumn("_python", python_syntax_of(F.when(is_python, code_or_text(F.col(answer), "python"))))
    checked = checked.withColumn("_code", F.when(is_script, code_or_text(F.col(answer), "javascript")))
    checked = checked.withColumn("_script", javascript_syntax(F.col("_code")))
    return checked.withColumns({
        "is_valid": F.when(is_python, F.col("_python.is_valid")).when(is_script, F.col("_script.is_valid")),
        "syntax_confidence": F.when(is_python, F.col("_python.confidence")).when(is_script, F.col("_script.confidence")).otherwise(0.0),
        "has_function": F.col("_python.has_function"),
        "has_class": F.col("_python.has_class"),
    }).drop("_python", "_script", "_code")


def syntax_audit(df: DataFrame, answer: str = "answer") -> DataFrame:
    """Valid and invalid code per split and language."""
    return syntax_checks(df, answer).groupBy("split", "language").agg(
        F.count("*").alias("answers"), F.count_if("is_valid").alias("valid"), F.count_if(~F.col("is_valid")).alias("invalid"),
        F.count_if("has_function").alias("with_function"), F.count_if("has_class").alias("with_class"),
    )


# --- registry --------------------------------------------------------------------------------------

Scorer = Callable[[DataFrame], DataFrame]
_SCORERS: dict[str, Scorer] = {}
# Scorer name of each row, computed once for all scorers.
ROUTE = "_route"


def register(name: str, scorer: Scorer) -> None:
    """Adds a scorer: a function that adds a `<name>_score` struct column to a candidate table."""
    if not callable(scorer):
        raise TypeError("a scorer is a function from DataFrame to DataFrame")
    _SCORERS[name] = scorer


def scorer(name: str) -> Scorer:
    if name not in _SCORERS:
        raise KeyError(f"unknown scorer {name!r}, known: {', '.join(scorers())}")
    return _SCORERS[name]


def scorers() -> list[str]:
    return list(_SCORERS)


def score_by_split(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Runs the registered scorers in one pass and picks each row's result by the route of its split."""
    result = F.lit(None).cast(SCORE)
    df = df.withColumn(ROUTE, scorer_for(F.col("split")))
    for name in names or ["math", "code", "tool"]:
        df = scorer(name)(df)
        result = F.when(F.col(ROUTE) == name, F.col(f"{name}_score")).otherwise(result)
    return df.withColumn("local_score", result).drop(ROUTE)


def _routed_to(df: DataFrame, name: str) -> Column:
    """Rows of a scorer: by the route column when the cascade has added it, else by the split."""
    return (F.col(ROUTE) if ROUTE in df.columns else scorer_for(F.col("split"))) == name


def _math_scorer(df: DataFrame) -> DataFrame:
    return df.withColumn("math_score", F.when(_routed_to(df, "math"), math_score(F.col("answer"), F.col("ground_truth"))))


def _code_scorer(df: DataFrame) -> DataFrame:
    return code_scores(df, _routed_to(df, "code"))


#: Columns that bring the specification of tool answers, where a table has them.
TOOL_COLUMNS = {"schema": "tool_schema", "catalog": "tool_catalog", "required": "tool_required"}


def _tool_scorer(df: DataFrame) -> DataFrame:
    return tool_scores(df, only=_routed_to(df, "tool"), **{stage: column for stage, column in TOOL_COLUMNS.items() if column in df.columns})


register("math", _math_scorer)
register("code", _code_scorer)
register("tool", _tool_scorer)
