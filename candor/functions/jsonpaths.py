"""JSON values as rows of paths, and comparison of such rows as sets.

A value becomes rows (path, token, whole text). The upper levels come from casts of VARIANT, one level at a time. A value that goes deeper is read by one fold over the tokens of its canonical
text instead: the path of the current place is the state of the fold; a key replaces its last component, an opening bracket appends one, a closing one drops it. So depth is
no part of any expression. Both give the same rows. Comparisons are then set operations on strings made from rows, which Spark answers by hashing, all inside one projection.

A path is a sequence of components, each after a SEP: the quoted key of an object, or `#` and the place in an array. The root is the empty path. JSON text holds no raw
control characters, so SEP and MARK can't be part of a key or a token.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candor.functions.text import bind

SEP, MARK = "\x01", "\x02"
ROWS = "array<struct<path:string,whole:string>>"
MAP, ITEMS = "map<string,variant>", "array<variant>"
#: Levels below the root that are read by casts.
LEVELS = 3
#: Rows are gathered so many tokens at a time, because an array that grows is copied by each step.
RUN = 256

# Words that count as true or false.
TRUE_WORDS = ("true", "yes", "1", "on")
FALSE_WORDS = ("false", "no", "0", "off")

#: A number as JSON and Python write it; suffixes and hexadecimal forms of other languages are no numbers.
NUMBER = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|[+-]?(?:[iI][nN][fF](?:[iI][nN][iI][tT][yY])?|[nN][aA][nN])"

#: A key with its colon, a text, a bracket, or any other scalar, with the comma after it. Possessive, so that long texts need no stack.
_TOKEN = r'"[^"\\]*+(?:\\.[^"\\]*+)*+":?,?|[{\[]|[}\]],?|[^{}\[\],:"]+,?'


_ODD_KEY = r'[\x00-\x1f"\\]'


def number_of(text: Column) -> Column:
    """Double of a text that is a decimal number; NULL for forms such as `7d` or `0x1p3` that a cast would read."""
    return F.when(text.rlike(rf"^\s*(?:{NUMBER})\s*$"), text.try_cast("double"))


def _last(path: Column) -> Column:
    return F.substring_index(path, SEP, -1)


def _parent(path: Column) -> Column:
    return F.left(path, F.length(path) - F.length(_last(path)) - 1)


def _next(path: Column) -> Column:
    """The place after a value: the next one in an array; in an object the coming key replaces it."""
    last = _last(path)
    place = F.substring(last, F.lit(2), F.length(last)).cast("int") + 1
    return F.when(F.startswith(last, F.lit("#")), F.concat(_parent(path), F.lit(SEP + "#"), place.cast("string"))).otherwise(path)


def _step(state: Column, token: Column) -> Column:
    at, opened, seen, rows = (state[n] for n in ("at", "opened", "seen", "rows"))
    first = F.left(token, F.lit(1))
    is_open, is_close, is_key = first.isin("{", "["), first.isin("}", "]"), F.endswith(token, F.lit(":"))

    def moved(own: Column) -> Column:
        began = F.when(is_close, F.element_at(opened, -1)).otherwise(seen)
        row = F.struct(own.alias("path"), began.alias("first"), seen.alias("last"))
        return F.struct(
            F.when(is_key, F.concat(_parent(at), F.lit(SEP), F.left(token, F.length(token) - 1)))
            .when(is_open, F.concat(at, F.lit(SEP), F.when(first == "[", F.lit("#0")).otherwise(F.lit(""))))
            .otherwise(_next(own)).alias("at"),
            F.when(is_open, F.concat(opened, F.array(seen))).when(is_close, F.slice(opened, F.lit(1), F.size(opened) - 1)).otherwise(opened).alias("opened"),
            (seen + 1).alias("seen"),
            F.when(is_open | is_key, rows).otherwise(F.concat(rows, F.array(row))).alias("rows"),
        )

    return bind(F.when(is_close, _parent(at)).otherwise(at), moved)


def _folded(tokens: Column) -> Column:
    """Rows of any depth. Containers come after what they hold."""
    places = "array<struct<path:string,first:int,last:int>>"
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(tokens) - 1) / RUN).cast("int")), lambda k: F.slice(tokens, k * RUN + 1, F.lit(RUN)))

    def run(state: Column, some: Column) -> Column:
        start = F.struct(state["at"].alias("at"), state["opened"].alias("opened"), state["seen"].alias("seen"), F.array().cast(places).alias("rows"))
        done = lambda end: F.struct(
            end["at"].alias("at"), end["opened"].alias("opened"), end["seen"].alias("seen"), F.concat(state["done"], F.array(end["rows"])).alias("done")
        )
        return bind(F.aggregate(some, start, _step), done)

    zero = F.struct(F.lit("").alias("at"), F.array().cast("array<int>").alias("opened"), F.lit(0).alias("seen"), F.array().cast(f"array<{places}>").alias("done"))
    found = F.aggregate(runs, zero, run, lambda end: F.flatten(end["done"]))
    whole = lambda r: F.rtrim(F.array_join(F.slice(tokens, r["first"] + 1, r["last"] - r["first"] + 1), ""), F.lit(","))
    return F.transform(found, lambda r: F.struct(r["path"].alias("path"), whole(r).alias("whole")))


def _below(level: Column) -> Column:
    """The next level of (path, whole, value)."""

    def inner(r: Column) -> Column:
        # A key that JSON has to escape gets no path here.
        own = lambda key: F.when(~key.rlike(_ODD_KEY), F.concat(r["path"], F.lit(SEP + '"'), key, F.lit('"')))
        named = lambda e: _place(own(e["key"]), e["value"])
        placed = lambda v, i: _place(F.concat(r["path"], F.lit(SEP + "#"), i.cast("string")), v)
        members = F.transform(F.map_entries(r["value"].try_cast(MAP)), named)
        return F.when(F.startswith(r["whole"], F.lit("{")), members).otherwise(F.transform(r["value"].try_cast(ITEMS), placed))

    return F.flatten(F.transform(F.filter(level, _is_container), inner))


def _place(path: Column, value: Column) -> Column:
    return F.struct(path.alias("path"), F.to_json(value).alias("whole"), value.alias("value"))


def _is_container(r: Column) -> Column:
    return F.left(r["whole"], F.lit(1)).isin("{", "[")


def document(value: Column) -> Column:
    """Rows of a VARIANT; NULL for NULL."""

    def level(above: Column, found: Column | None, left: int) -> Column:
        rows = F.transform(above, lambda r: F.struct(r["path"].alias("path"), r["whole"].alias("whole")))
        found = rows if found is None else F.concat(found, rows)
        if left:
            return bind(_below(above), lambda next_: level(next_, found, left - 1))
        # Deeper values, and keys whose text is not their JSON text, are read from the tokens.
        deep = F.exists(above, lambda r: _is_container(r) & (F.length(r["whole"]) > 2))
        odd = F.exists(found, lambda r: r["path"].isNull())
        return F.when(deep | odd, F.lit(None).cast(ROWS)).otherwise(found)

    def read(v: Column) -> Column:
        tokens = F.regexp_extract_all(F.to_json(v), F.lit(_TOKEN), F.lit(0))
        return F.when(v.isNotNull(), F.coalesce(level(F.array(_place(F.lit(""), v)), None, LEVELS), bind(tokens, _folded)))

    return bind(value, read)


def _outside_arrays(rows: Column) -> Column:
    return F.filter(rows, lambda r: ~F.contains(r["path"], F.lit(SEP + "#")))


def _paths(rows: Column) -> Column:
    return F.transform(rows, lambda r: r["path"])


def _none_of(items: Column, others: Column) -> Column:
    """No item is missing among the others."""
    return F.size(F.array_except(items, others)) == 0


# --- loose comparison ------------------------------------------------------------------------------

def _plain(path: Column) -> Column:
    """Keys without case, underscores and dashes."""
    return F.translate(F.lower(path), "_-", "")


def _word(content: Column) -> Column:
    return F.when(content.isin(*TRUE_WORDS), F.lit("b1")).when(content.isin(*FALSE_WORDS), F.lit("b0"))


def _values(row: Column) -> Column:
    """Under what a value can be found: itself, its text in any case, its number, its truth word. Values that share one are loosely equal."""
    token = row["whole"]
    first = F.left(token, F.lit(1))

    def of_text(content: Column) -> Column:
        # Escaped white space around a number is white space as well.
        readable = F.when(F.contains(content, F.lit("\\")), F.regexp_replace(content, r"\\[tnrf]", " ")).otherwise(content)
        return F.array(F.concat(F.lit("w"), token), F.concat(F.lit("t"), content), _number(readable), _word(content))

    def _number(text: Column) -> Column:
        # Adding zero makes -0.0 and 0.0 one number; nothing equals NaN.
        return bind(number_of(text), lambda n: F.when(~F.isnan(n), F.concat(F.lit("n"), (n + 0.0).cast("string"))))

    found = (
        F.when(first == "{", F.array(F.lit("{")))
        .when(first == "[", F.array(F.concat(F.lit("w"), token)))
        .when(first == '"', bind(F.lower(F.substring(token, F.lit(2), F.length(token) - 2)), of_text))
        .when(first.isin("t", "f"), F.array(F.concat(F.lit("w"), token), _word(token)))
        .otherwise(F.array(F.concat(F.lit("w"), token), _number(token)))
    )
    path = _plain(row["path"])
    return F.transform(F.filter(found, lambda v: v.isNotNull()), lambda v: F.concat(path, F.lit(MARK), v))


def _shadowed_gone(rows: Column) -> Column:
    """Rows without those of keys that a later key with the same plain form replaces."""

    def live(rows: Column) -> Column:
        plain = F.array_distinct(F.transform(rows, lambda r: _plain(r["path"])))
        latest = F.transform(plain, lambda p: F.element_at(F.filter(rows, lambda r: _plain(r["path"]) == p), -1)["path"])

        def ancestors(path: Column) -> Column:
            parts = F.split(path, SEP)
            return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), SEP))

        clash = F.size(plain) < F.size(rows)
        return F.when(clash, bind(latest, lambda kept: F.filter(rows, lambda r: _none_of(ancestors(r["path"]), kept)))).otherwise(rows)

    return bind(rows, live)


def covers(data: Column, truth: Column) -> Column:
    """Every key of the truth object has a loosely equal value in the data object, at any depth; extra keys are allowed. Both are documents.

    Arrays compare as a whole. Of data keys that differ in case, underscores or dashes only, the last one counts.
    """

    def compared(both: Column) -> Column:
        d, t = both["d"], both["t"]
        offered = F.flatten(F.transform(_shadowed_gone(_outside_arrays(d)), _values))
        wanted = F.transform(_outside_arrays(t), lambda r: F.struct(_plain(r["path"]).alias("path"), _values(r).alias("values")))
        return F.when(d.isNotNull() & t.isNotNull(), bind(F.struct(offered.alias("offered"), wanted.alias("wanted")), met))

    def met(sides: Column) -> Column:
        wanted = sides["wanted"]
        paths = F.transform(wanted, lambda w: w["path"])
        hits = F.array_intersect(F.flatten(F.transform(wanted, lambda w: w["values"])), sides["offered"])
        at_hits = F.transform(hits, lambda h: F.substring_index(h, MARK, 1))
        # Two truth keys of one plain form are two demands on one path.
        each = F.forall(wanted, lambda w: F.arrays_overlap(w["values"], sides["offered"]))
        return F.when(F.size(F.array_distinct(paths)) < F.size(paths), each).otherwise(_none_of(paths, at_hits))

    return bind(F.struct(data.alias("d"), truth.alias("t")), compared)


# --- loose comparison of short plain texts -----------------------------------------------------------

#: What `simple_text` reads: longer texts, and those with arrays, escapes or letters beyond ASCII, are compared as documents.
PLAIN_LENGTH, PLAIN_TOKENS = 2000, 64
_FIELD, _ROW = "\x03", "\x04"
#: A key, with the bracket of an object that follows it; the end of an object; a text; any other scalar.
_PLAIN_TOKEN = r'"[^"]*+":\{?|\}|"[^"]*+"|[^{},:"]++'


def simple_text(text: Column) -> Column:
    """Canonical text of an object in which nothing is escaped and no key begins with a colon, so that a quote begins or ends a text and a key is what a colon follows; NULL for other texts."""
    simple = (F.length(text) <= PLAIN_LENGTH) & (F.octet_length(text) == F.length(text)) & F.startswith(text, F.lit("{"))
    simple = simple & ~F.contains(text, F.lit("\\")) & ~F.contains(text, F.lit("["))
    return F.when(simple & ~F.contains(text, F.lit(',":')) & ~F.contains(text, F.lit('{":')), text)


def plain_text(simple: Column) -> Column:
    """A `simple_text` in lower case, its keys without underscores and dashes."""
    marked = F.contains(simple, F.lit("_")) | F.contains(simple, F.lit("-"))
    return F.when(marked, F.regexp_replace(F.lower(simple), r'[_-](?=[^"]*+":)', "")).otherwise(F.lower(simple))


def plain_keys(plain: Column) -> Column:
    """All keys of a `plain_text`, at any depth."""
    return F.regexp_extract_all(plain, F.lit(r'"([^"]*+)":'), F.lit(1))


def plain_rows(plain: Column) -> Column:
    """Rows of a `simple_text`, or of a `plain_text` in which no key comes twice: a map from the path of each value below the root to its token, `{` for an object. NULL for more than a few tokens."""

    def step(state: Column, token: Column) -> Column:
        at, key = state["at"], state["key"]
        end = F.right(token, F.lit(1))
        opens, closes, names = end == "{", token == "}", end == ":"
        inside = F.concat(at, F.lit(SEP), F.rtrim(token, F.lit("{:")))
        row = F.when(opens, F.concat(inside, F.lit(_FIELD + "{" + _ROW))).when(closes | names, F.lit("")).otherwise(F.concat(at, F.lit(SEP), key, F.lit(_FIELD), token, F.lit(_ROW)))
        return F.struct(
            F.when(opens, inside).when(closes, _parent(at)).otherwise(at).alias("at"), F.when(names, F.rtrim(token, F.lit(":"))).otherwise(key).alias("key"), F.concat(state["rows"], row).alias("rows"),
        )

    def read(tokens: Column) -> Column:
        start = F.struct(F.lit("").alias("at"), F.lit("").alias("key"), F.lit("").alias("rows"))
        # The last token closes the root.
        some = F.when(F.size(tokens) <= PLAIN_TOKENS, F.slice(tokens, F.lit(1), F.size(tokens) - 1))
        return F.aggregate(some, start, step, lambda end: F.rtrim(end["rows"], F.lit(_ROW)))

    nothing = F.create_map().cast("map<string,string>")
    as_map = lambda rows: F.when(rows == "", nothing).otherwise(F.str_to_map(rows, F.lit(_ROW), F.lit(_FIELD)))
    return bind(bind(F.regexp_extract_all(plain, F.lit(_PLAIN_TOKEN), F.lit(0)), read), as_map)


def _plain_same(token: Column, other: Column) -> Column:
    """`_values` of two tokens of one path share one: equal tokens, numbers or truth words. Keys of objects are compared by rows of their own."""
    bare = lambda t: F.when(F.startswith(t, F.lit('"')), F.substring(t, F.lit(2), F.length(t) - 2)).otherwise(t)
    worded = lambda t: F.when(F.left(t, F.lit(1)).isin('"', "t", "f"), _word(bare(t)))
    close = bind(F.struct(number_of(bare(token)).alias("x"), number_of(bare(other)).alias("y")), lambda n: (n["x"] == n["y"]) & ~F.isnan(n["x"]))
    return (token == other) | F.coalesce(worded(token) == worded(other), F.lit(False)) | F.coalesce(close, F.lit(False))


def plain_covers(data: Column, truth: Column) -> Column:
    """`covers` of the `plain_rows` of both; NULL if either is NULL."""
    return F.forall(F.map_entries(truth), lambda e: F.coalesce(_plain_same(e["value"], F.try_element_at(data, e["key"])), F.lit(False)))


def has_shape(actual: Column, expected: Column) -> Column:
    """Every key of the expected object, at any depth of objects, is in the actual one. Both are documents of objects."""

    def compared(both: Column) -> Column:
        a, e = both["a"], both["e"]
        objects = lambda rows: _paths(F.filter(rows, lambda r: F.startswith(r["whole"], F.lit("{"))))
        return F.when(a.isNotNull() & e.isNotNull(), _none_of(_paths(e), _paths(a)) & _none_of(objects(e), objects(a)))

    return bind(F.struct(_outside_arrays(actual).alias("a"), _outside_arrays(expected).alias("e")), compared)


# --- schemas ---------------------------------------------------------------------------------------

# The type names of a schema. A whole number is of both number types.
KINDS = ("object", "array", "string", "boolean", "null", "integer", "number")

#: Where a schema can stand inside a schema, and a keyword there, with the place in its list if it is one.
_INNER = rf'{SEP}"properties"{SEP}("[^{SEP}]*")|{SEP}"items"'
_SCHEMA = rf"^(?:{_INNER})*+$"
_KEYWORD = rf'^((?:{_INNER})*+){SEP}"(type|enum|required|additionalProperties)"({SEP}#[0-9]+)?$'


def _kind(token: Column) -> Column:
    first = F.left(token, F.lit(1))
    return (
        F.when(first == "{", F.lit("object")).when(first == "[", F.lit("array")).when(first == '"', F.lit("string")).when(first.isin("t", "f"), F.lit("boolean"))
        .when(first == "n", F.lit("null")).when(F.coalesce(token.try_cast("double") % 1 == 0, F.lit(False)), F.lit("integer")).otherwise(F.lit("number"))
    )


def _any_place(path: Column) -> Column:
    """A path in a value without places in arrays."""
    return F.regexp_replace(path, f"{SEP}#[0-9]+", SEP)


def constraints(schema: Column) -> Column:
    """A VARIANT schema as sets of what it asks for, each by the path in the value that it is about. Made once per schema; NULL for NULL.

    Read are type, enum, required, properties, additionalProperties (false) and items (one schema), at any depth; other keywords don't count.
    """

    def read(rows: Column) -> Column:
        def ruled(r: Column) -> Column:
            group = lambda k: F.regexp_extract(r["path"], _KEYWORD, k)
            about = F.regexp_replace(group(1), _INNER, f"{SEP}$1")
            return F.struct(about.alias("about"), group(3).alias("word"), (group(4) != "").alias("inner"), r["whole"].alias("token"))

        rules = F.transform(F.filter(rows, lambda r: r["path"].rlike(_KEYWORD)), ruled)
        declared = F.transform(F.filter(rows, lambda r: r["path"].rlike(_SCHEMA)), lambda r: F.regexp_replace(r["path"], _INNER, f"{SEP}$1"))
        return F.when(rows.isNotNull(), bind(F.struct(rules.alias("rules"), declared.alias("declared")), gathered))

    def gathered(found: Column) -> Column:
        rules = found["rules"]
        some = lambda word, inner, more, use: F.transform(
            F.filter(rules, lambda r: (r["word"] == word) & (r["inner"] == F.lit(inner)) & more(r["token"])), use
        )
        is_text = lambda t: F.startswith(t, F.lit('"'))
        name = lambda r: F.substring(r["token"], F.lit(2), F.length(r["token"]) - 2)
        typed = some("type", False, lambda t: is_text(t) | F.startswith(t, F.lit("[")), lambda r: r["about"])
        allow = lambda r: F.transform(
            F.when(name(r) == "number", F.array(F.lit("number"), F.lit("integer"))).otherwise(F.array(name(r))), lambda k: F.concat(r["about"], F.lit(MARK), k)
        )
        allowed = F.flatten(F.concat(some("type", False, is_text, allow), some("type", True, is_text, allow)))
        every = F.flatten(F.transform(typed, lambda about: F.transform(F.array(*[F.lit(k) for k in KINDS]), lambda k: F.concat(about, F.lit(MARK), k))))
        return F.struct(
            F.array_except(every, allowed).alias("denied"),
            some("enum", False, lambda t: F.startswith(t, F.lit("[")), lambda r: r["about"]).alias("limited"),
            some("enum", True, lambda t: F.lit(True), lambda r: F.concat(r["about"], F.lit(MARK), r["token"])).alias("choices"),
            some("required", True, is_text, lambda r: F.struct(r["about"].alias("about"), r["token"].alias("key"))).alias("required"),
            some("additionalProperties", False, lambda t: t == "false", lambda r: r["about"]).alias("closed"),
            found["declared"].alias("declared"),
        )

    return bind(document(schema), read)


def meets(value: Column, rules: Column) -> Column:
    """Whether a document meets the `constraints` of a schema; NULL if either is NULL."""

    def checked(both: Column) -> Column:
        doc, asked = both["doc"], both["asked"]
        rows = F.transform(doc, lambda r: F.struct(r["path"].alias("path"), _any_place(r["path"]).alias("about"), r["whole"].alias("whole")))
        return F.when(doc.isNotNull() & asked.isNotNull(), bind(F.struct(rows.alias("rows"), asked.alias("asked")), judged))

    def judged(x: Column) -> Column:
        rows, asked = x["rows"], x["asked"]
        kinds = F.transform(rows, lambda r: F.concat(r["about"], F.lit(MARK), _kind(r["whole"])))
        types = ~F.arrays_overlap(kinds, asked["denied"])
        limited = F.filter(rows, lambda r: F.array_contains(asked["limited"], r["about"]))
        choices = _none_of(F.transform(limited, lambda r: F.concat(r["about"], F.lit(MARK), r["whole"])), asked["choices"])
        objects = F.filter(rows, lambda r: F.startswith(r["whole"], F.lit("{")))
        needed = F.flatten(F.transform(asked["required"], lambda q: F.transform(F.filter(objects, lambda o: o["about"] == q["about"]), lambda o: F.concat(o["path"], F.lit(SEP), q["key"]))))
        members = F.filter(rows, lambda r: F.startswith(_last(r["path"]), F.lit('"')) & F.array_contains(asked["closed"], _parent(r["about"])))
        return types & choices & _none_of(needed, _paths(rows)) & _none_of(F.transform(members, lambda r: r["about"]), asked["declared"])

    return bind(F.struct(value.alias("doc"), rules.alias("asked")), checked)


def meets_plainly(rows: Column, rules: Column) -> Column:
    """`meets` of the `plain_rows` of a `simple_text`; NULL where it takes the whole text of an object, or if either is NULL."""

    def judged(x: Column) -> Column:
        rows, asked = x["rows"], x["asked"]
        paths = F.map_keys(rows)
        token = lambda path: F.try_element_at(rows, path)
        kinds = F.concat(F.transform(F.map_entries(rows), lambda e: F.concat(e["key"], F.lit(MARK), _kind(e["value"]))), F.array(F.lit(MARK + "object")))
        limited = F.array_intersect(F.concat(paths, F.array(F.lit(""))), asked["limited"])
        whole = F.exists(limited, lambda p: (p == "") | F.coalesce(token(p) == "{", F.lit(False)))
        choices = F.forall(limited, lambda p: F.array_contains(asked["choices"], F.concat(p, F.lit(MARK), token(p))))
        is_object = lambda path: (path == "") | F.coalesce(token(path) == "{", F.lit(False))
        needed = F.forall(asked["required"], lambda q: ~is_object(q["about"]) | F.array_contains(paths, F.concat(q["about"], F.lit(SEP), q["key"])))
        declared = F.forall(F.array_except(paths, asked["declared"]), lambda p: ~F.array_contains(asked["closed"], _parent(p)))
        return F.when(~whole, ~F.arrays_overlap(kinds, asked["denied"]) & choices & needed & (declared | (F.size(asked["closed"]) == 0)))

    both = F.when(rows.isNotNull() & rules.isNotNull(), F.struct(rows.alias("rows"), rules.alias("asked")))
    return bind(both, lambda x: F.when(x.isNotNull(), judged(x)))
