"""Dynamic JSON in answers, on VARIANT: parsing, tool calls, fuzzy comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candor.functions import jsonpaths as P
from candor.functions.jsonpaths import FALSE_WORDS, TRUE_WORDS, number_of
from candor.functions.text import bind, first_match, leading_object, strip

MAP = "map<string,variant>"
ITEMS = "array<variant>"


def parse(text: Column) -> Column:
    """Strict parse: NULL unless the whole text is one JSON value.

    `try_parse_json` ignores what follows the first value. Inside `[` and `]` as well as inside an object it cannot: text that closes one of the two wrappers
    early is an error in the other, and text that adds a second value makes the array longer. In the wrappers values are only counted, which builds none and
    fails without an error message; text without `]` can't close the array, and text that cannot start a value is not even counted. The text is mentioned
    several times: bind what is costly.
    """
    possible = F.when(text.rlike(r'^\s*(?:\{\s*["}]|[\["0-9-]|true|false|null)'), text)
    single = F.json_array_length(F.concat(F.lit("["), possible, F.lit("]"))) == 1
    closed = ~F.contains(text, F.lit("]")) | F.json_object_keys(F.concat(F.lit('{"a":'), text, F.lit("}"))).isNotNull()
    return F.try_parse_json(F.when(single & closed, text))


def as_object(value: Column) -> Column:
    """VARIANT object -> map; NULL for any other value."""
    return value.try_cast(MAP)


def as_items(value: Column) -> Column:
    return value.try_cast(ITEMS)


def field(obj: Column, name: str) -> Column:
    """Value of a key in a map, NULL when absent."""
    return F.try_element_at(obj, F.lit(name))


def kind(value: Column) -> Column:
    """JSON type name of a VARIANT: object, array, string, boolean, null, integer or number."""


    def name(text: Column) -> Column:
        return (
            F.when(F.startswith(text, F.lit("OBJECT")), F.lit("object"))
            .when(F.startswith(text, F.lit("ARRAY")), F.lit("array"))
            .when(text == "STRING", F.lit("string"))
            .when(text == "BOOLEAN", F.lit("boolean"))
            .when(text == "VOID", F.lit("null"))
            .when(text == "BIGINT", F.lit("integer"))
            .when(F.coalesce(value.try_cast("double") % 1 == 0, F.lit(False)), F.lit("integer"))
            .when(text.isNotNull(), F.lit("number"))
        )

    return bind(F.schema_of_variant(value), name)


def canonical(value: Column) -> Column:
    """Canonical text: keys sorted, 1.0 written as 1. Equal values have equal text."""
    return F.to_json(value)


def text_of(value: Column) -> Column:
    """String content of a VARIANT string; NULL for other types."""
    return F.when(F.schema_of_variant(value) == "STRING", value.try_cast("string"))


# --- tool calls ------------------------------------------------------------------------------------

def header_call(text: Column) -> Column:
    """`to=ns.fn {...}` -> struct(tool, recipient, namespace, parameters); NULL without a recipient.

    Unreadable parameters count as an empty object.
    """
    arguments = bind(first_match(text, r"(?s)\{.*\}", 0), parse)

    def call(recipient: Column) -> Column:
        return F.when(
            recipient != "",
            F.struct(*[part.alias(name) for name, part in header_parts(recipient, arguments).items() if name != "function"]),
        )

    return bind(F.regexp_extract(text, r"(?U)to=([\w.]+)", 1), call)


def header_parts(recipient: Column, arguments: Column) -> dict[str, Column]:
    """What a recipient and its parameters say, by name."""
    tool = F.substring_index(recipient, ".", -1)
    namespace = F.when(F.contains(recipient, F.lit(".")), F.regexp_extract(recipient, r"^(.*)\.[^.]*$", 1)).otherwise(F.lit(""))
    return {"tool": tool, "function": tool, "recipient": recipient, "namespace": namespace, "parameters": F.coalesce(arguments, F.parse_json(F.lit("{}")))}


def json_body(text: Column) -> Column:
    """Commentary body of an answer, else the whole answer. Most texts have no tag; a byte search says so before a regex looks."""
    commentary = first_match(F.when(F.contains(text, F.lit("<")), text), r"(?ius)<COMMENTARY>(.*?)</COMMENTARY>")
    return F.coalesce(strip(commentary), text)


def json_part(body: Column) -> Column:
    """JSON text in a body: json fence, then widest braces, then the whole body."""
    fence = first_match(F.when(F.contains(body, F.lit("```")), body), r"(?iusU)```json\s*\n(.*?)```")
    return F.coalesce(strip(fence), first_match(body, r"(?s)(\{.*\}|\[.*\])"), strip(body))


def json_in(text: Column) -> Column:
    """VARIANT found in an answer: commentary body, then json fence, then widest braces, then the whole text."""
    return bind(json_body(text), lambda body: bind(json_part(body), parse))


# Keys that may name the tool, and keys that may hold its arguments, in order.
NAME_KEYS = ("tool", "function", "name", "tool_name", "function_name")
ARGUMENT_KEYS = ("parameters", "params", "arguments", "args")


def tool_name(call: Column) -> Column:
    """Tool name of a call map: the first naming key present, with `function.name` for nested calls."""
    nested = text_of(field(as_object(field(call, "function")), "name"))
    found = F.lit(None).cast("string")
    for key in reversed(NAME_KEYS):
        value = field(call, key)
        found = F.when(F.map_contains_key(call, key), F.coalesce(text_of(value), nested)).otherwise(found)
    return found


def tool_arguments(call: Column) -> Column:
    """Arguments VARIANT of a call map: the first argument key present."""
    found = F.lit(None).cast("variant")
    for key in reversed(ARGUMENT_KEYS):
        found = F.when(F.map_contains_key(call, key), field(call, key)).otherwise(found)
    return found


def looks_numeric(text: Column) -> Column:
    """Digits only, once dots and dashes are removed."""
    return F.coalesce(F.translate(text, ".-", "").rlike(r"(?U)^\d+\z"), F.lit(False))


# --- comparison with a truth -----------------------------------------------------------------------

def plain_key(key: Column) -> Column:
    """Key without case, underscores and dashes."""
    return F.translate(F.lower(key), "_-", "")


def _leaf(value: Column) -> Column:
    """What loose comparison needs of a VARIANT: canonical text, its word if it is one, its number if it is one."""

    def read(type_name: Column) -> Column:
        plain = value.try_cast("string")
        return F.struct(
            canonical(value).alias("whole"),
            F.lower(F.when(type_name.isin("string", "boolean"), plain)).alias("word"),
            (type_name == "string").alias("is_text"),
            F.when(type_name.isin("integer", "number", "string"), number_of(plain)).alias("number"),
        )

    return bind(kind(value), read)


def same_value(a: Column, b: Column) -> Column:
    """Loose equality of two VARIANT leaves: canonical text, case, numbers, truth words."""

    def same(both: Column) -> Column:
        x, y = both["x"], both["y"]
        parts = [
            x["whole"] == y["whole"],
            x["is_text"] & y["is_text"] & (x["word"] == y["word"]),
            x["number"] == y["number"],
            x["word"].isin(*TRUE_WORDS) & y["word"].isin(*TRUE_WORDS),
            x["word"].isin(*FALSE_WORDS) & y["word"].isin(*FALSE_WORDS),
        ]
        result = F.lit(False)
        for part in parts:
            result = result | F.coalesce(part, F.lit(False))
        return result

    return bind(F.struct(_leaf(a).alias("x"), _leaf(b).alias("y")), same)


def covers_fuzzily(data: Column, truth: Column) -> Column:
    """Every key of the `truth` object has a loosely equal value in the `data` object, at any depth (extra keys allowed). Both VARIANT."""

    def compared(both: Column) -> Column:
        return P.covers(P.document(both["data"]), P.document(both["truth"]))

    objects = as_object(data).isNotNull() & as_object(truth).isNotNull()
    return F.coalesce(bind(F.when(objects, F.struct(data.alias("data"), truth.alias("truth"))), compared), F.lit(False))


def covers_exactly(data: Column, truth: Column) -> Column:
    """Every key of the `truth` map is in the `data` map with an equal value (extra keys allowed)."""
    return F.forall(
        F.map_entries(truth),
        lambda e: F.coalesce(canonical(F.try_element_at(data, e["key"])) == canonical(e["value"]), F.lit(False)),
    )


def same_result(actual: Column, expected: Column) -> Column:
    """Result comparison: equal, or all expected keys present at any depth (values only matter when objects), or numbers within 1 %. Both VARIANT."""

    def compared(both: Column) -> Column:
        a, b, left, right = (both[n] for n in ("a", "b", "left", "right"))
        # The first character of a JSON text tells objects and numbers.
        numbers, objects = left.rlike("^[-0-9]") & right.rlike("^[-0-9]"), F.startswith(left, F.lit("{")) & F.startswith(right, F.lit("{"))
        x, y = a.try_cast("double"), b.try_cast("double")
        close = numbers & (F.abs(x - y) < 0.01 * F.greatest(F.abs(x), F.abs(y), F.lit(1.0)))
        # The rows of paths are only made for what is left.
        return F.when(left == right, F.lit(True)).when(objects, P.has_shape(P.document(a), P.document(b))).otherwise(close)

    texts = F.struct(actual.alias("a"), expected.alias("b"), canonical(actual).alias("left"), canonical(expected).alias("right"))
    return F.when(actual.isNotNull() & expected.isNotNull(), bind(texts, compared))


# --- judge output ----------------------------------------------------------------------------------



def repair_json(text: Column) -> Column:
    """Repair of nearly-JSON: backslashes that start no JSON escape are doubled, then, unless the text
    already looks like an object with double quotes, quotes and True/False/None are rewritten."""
    # A backslash is kept when a JSON escape letter (or nothing) follows.
    escaped = F.regexp_replace(text, r'\\(?=[^"\\bfnrtu/])', r"\\\\")
    return bind(escaped, _repair_quotes)


def _repair_quotes(escaped: Column) -> Column:
    keys = F.regexp_replace(escaped, r"(?U)'(\w+)'(\s*:)", r'"$1"$2')
    values = F.regexp_replace(keys, r"(?U):\s*'([^']*)'", r': "$1"')
    words = values
    for python_word, json_word in (("True", "true"), ("False", "false"), ("None", "null")):
        words = F.regexp_replace(words, rf"(?U)\b{python_word}\b", json_word)
    looks_json = F.startswith(strip(escaped), F.lit("{")) & F.contains(escaped, F.lit('"'))
    return F.when(looks_json, escaped).otherwise(words)


def judge_json(response: Column) -> Column:
    """VARIANT of a judge response: whole text, fenced object, leading balanced object, then a repaired form."""


    def repaired(parts: Column) -> Column:
        best = F.coalesce(parts["head"], parts["fenced"], parts["body"])
        # A head that is the whole body has failed already.
        head = F.when(parts["head"] != parts["body"], parts["head"])
        return F.coalesce(parse(parts["fenced"]), bind(head, parse), bind(bind(best, repair_json), parse))

    def recovered(body: Column) -> Column:
        fenced = first_match(F.when(F.contains(body, F.lit("```")), body), r"(?sU)```(?:json)?\s*(\{.*?\})\s*```")
        parts = F.struct(leading_object(body).alias("head"), fenced.alias("fenced"), body.alias("body"))
        return F.coalesce(parse(body), bind(parts, repaired))

    return bind(strip(response), recovered)
