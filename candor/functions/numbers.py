"""Reading and comparing numbers and expressions found in free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candor.functions.text import bind, blank_to_null, boxed, boxed_flat, last_of, strip

# Number shapes in order of preference.
SCIENTIFIC = r"(-?\d+\.?\d*[eE][+-]?\d+)"
FRACTION = r"(-?\d+)/(\d+)"
PERCENT = r"(-?\d+\.?\d*)%"
MONEY = r"\$?(-?[\d,]+\.?\d*)"
PLAIN_FRACTION = r"(-?\d+/\d+)"
PLAIN_NUMBER = r"(-?\d+\.?\d*)"
# Value after '=', and an arithmetic token.
EQUATION = r"(?dU)=\s*([^=\n]+?)(?:\s|$|,|\.)"
ARITHMETIC = r"(?dU)(?:^|\s)([+-]?(?:\d+\.?\d*|\d*\.?\d+)(?:[eE][+-]?\d+)?(?:/\d+)?(?:\s*+[*+\-/^]\s*+[\w\d.()]++)*+)"


def _last(text: Column, pattern: str) -> Column:
    return last_of(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))


def _non_blank(text: Column) -> Column:
    return bind(text, blank_to_null)


def _double(text: Column) -> Column:
    return text.try_cast("double")


def number_in(text: Column) -> Column:
    """Number of an answer: boxed part first, then scientific, fraction, percent, money or plain.

    The last match wins, except for fractions, where the first one does.
    """


    def read(body: Column) -> Column:
        # Shapes with a sign of their own are only tried on texts that hold the sign.
        numerator = _double(F.regexp_extract(body, FRACTION, 1))
        denominator = _double(F.regexp_extract(body, FRACTION, 2))
        return F.coalesce(
            _double(_last(body, SCIENTIFIC)),
            F.when(F.contains(body, F.lit("/")), F.try_divide(numerator, denominator)),
            F.when(F.contains(body, F.lit("%")), _double(_last(body, PERCENT))),
            _double(F.replace(_last(body, MONEY), F.lit(","), F.lit(""))),
        )

    return bind(F.coalesce(_non_blank(boxed(text)), text), read)


def simple_number_in(text: Column) -> Column:
    """Simpler reader: drops `$ % ,` first and always takes the last match."""


    def read(body: Column) -> Column:
        pair = F.split(_last(body, PLAIN_FRACTION), "/")
        return F.coalesce(
            _double(_last(body, SCIENTIFIC)),
            bind(pair, lambda p: F.try_divide(_double(F.get(p, F.lit(0))), _double(F.get(p, F.lit(1))))),
            _double(_last(body, PLAIN_NUMBER)),
        )

    return bind(F.translate(F.coalesce(boxed_flat(text), text), "$%,", ""), read)


def is_close(a: Column, b: Column, rel: float, abs_: float) -> Column:
    """math.isclose: NaN never, infinities only when equal; NULL in, NULL out."""
    infinite = F.lit(float("inf"))
    bound = F.greatest(F.lit(rel) * F.greatest(F.abs(a), F.abs(b)), F.lit(abs_))
    return (
        F.when(a.isNull() | b.isNull(), F.lit(None).cast("boolean"))
        .when(F.isnan(a) | F.isnan(b), F.lit(False))
        .when((F.abs(a) == infinite) | (F.abs(b) == infinite), a == b)
        .otherwise(F.abs(a - b) <= bound)
    )


def expression_in(text: Column) -> Column:
    """Boxed part, else the value after '=', else the last arithmetic token, else the whole text."""
    return F.coalesce(
        _non_blank(boxed(text)),
        _non_blank(strip(F.regexp_extract(text, EQUATION, 1))),
        strip(_last(text, ARITHMETIC)),
        strip(text),
    )


def normalized_expression(text: Column) -> Column:
    """Extracted expression without any white space, for equality."""
    return F.regexp_replace(expression_in(text), r"(?U)\s+", "")


# Unit -> (dimension, factor to the base unit).
UNITS = {
    "m": ("length", 1.0), "meter": ("length", 1.0), "meters": ("length", 1.0),
    "km": ("length", 1000.0), "kilometer": ("length", 1000.0), "kilometers": ("length", 1000.0),
    "cm": ("length", 0.01), "centimeter": ("length", 0.01), "centimeters": ("length", 0.01),
    "mm": ("length", 0.001), "millimeter": ("length", 0.001), "millimeters": ("length", 0.001),
    "inch": ("length", 0.0254), "inches": ("length", 0.0254), "ft": ("length", 0.3048), "foot": ("length", 0.3048),
    "feet": ("length", 0.3048), "mile": ("length", 1609.344), "miles": ("length", 1609.344),
    "g": ("mass", 0.001), "gram": ("mass", 0.001), "grams": ("mass", 0.001),
    "kg": ("mass", 1.0), "kilogram": ("mass", 1.0), "kilograms": ("mass", 1.0),
    "lb": ("mass", 0.45359237), "pound": ("mass", 0.45359237), "pounds": ("mass", 0.45359237),
    "s": ("time", 1.0), "second": ("time", 1.0), "seconds": ("time", 1.0),
    "minute": ("time", 60.0), "minutes": ("time", 60.0), "hour": ("time", 3600.0), "hours": ("time", 3600.0),
    "day": ("time", 86400.0), "days": ("time", 86400.0),
}
QUANTITY = r"^([+-]?\d+\.?\d*(?:[eE][+-]?\d+)?)\s*([A-Za-z]+)$"


def quantity_in(text: Column) -> Column:
    """`value unit` -> struct(dim, value, factor); NULL, or NULL fields, when the text is no known quantity.

    The unit table is a constant of fixed size, so it is a map literal inside the expression:
    no join, no shuffle and nothing that grows with the data.
    """
    dims = F.create_map(*[F.lit(x) for name, (dim, _) in UNITS.items() for x in (name, dim)])
    factors = F.create_map(*[F.lit(x) for name, (_, factor) in UNITS.items() for x in (name, factor)])


    def read(body: Column) -> Column:
        return bind(
            F.regexp_extract(body, QUANTITY, 2),
            lambda unit: F.when(
                unit != "",
                F.struct(
                    F.try_element_at(dims, unit).alias("dim"),
                    _double(F.regexp_extract(body, QUANTITY, 1)).alias("value"),
                    F.try_element_at(factors, unit).alias("factor"),
                ),
            ),
        )

    return bind(strip(text), read)


def same_quantity(answer: Column, truth: Column, tolerance: float) -> Column:
    """Both texts are quantities of one dimension and agree when expressed in the answer's unit."""


    def same(both: Column) -> Column:
        a, t = both["a"], both["t"]
        converted = t["value"] * t["factor"] / a["factor"]
        return F.coalesce((a["dim"] == t["dim"]) & is_close(a["value"], converted, tolerance, tolerance), F.lit(False))

    compared = bind(F.struct(quantity_in(answer).alias("a"), quantity_in(truth).alias("t")), same)
    # A quantity ends in a letter.
    possible = answer.rlike(r"[A-Za-z]\s*$") & truth.rlike(r"[A-Za-z]\s*$")
    return F.when(F.coalesce(possible, F.lit(False)), compared).otherwise(F.lit(False))
