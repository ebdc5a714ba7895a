"""Text to integer, number and date; NULL when the text is not one.

Each expression names its input as few times as it can: Catalyst copies the input
into every place it is named when it pushes a filter below a projection.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^(?i)[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)(e[+-]?[0-9]+)?|inf|infinity|nan)$"
ZERO_FRACTION = r"[.]0*$"

# Days a nanosecond timestamp can hold, 1677-09-22 to 2262-04-11, as
# year-month-day text. A missing month or day means the first.
_DAY = r"[0-9]{1,2}"
_WHOLE_YEAR = r"(?:16(?:7[89]|[89][0-9])|1[7-9][0-9]{2}|2[01][0-9]{2}|22(?:[0-5][0-9]|6[01]))"
_FIRST_YEAR = rf"1677-(?:0?9-(?:2[2-9]|30)|1[0-2](?:-{_DAY})?)"
_LAST_YEAR = rf"2262(?:-(?:0?[1-3](?:-{_DAY})?|0?4(?:-(?:0?[1-9]|1[01]))?))?"
IN_RANGE = rf"^(?:{_WHOLE_YEAR}(?:-[0-9]{{1,2}}(?:-{_DAY})?)?|{_FIRST_YEAR}|{_LAST_YEAR})$"

# The time of day that may follow a date; it is checked and dropped. Minutes
# may be missing only after a whole date in digits, where an hour cannot be anything else.
_HOUR, _MINUTE = r"(?:[01]?[0-9]|2[0-3])", r"[0-5][0-9]"
_ZONE = r"(?: ?[AaPp][Mm])?(?: ?Z|[+-][0-9]{2}:?[0-9]{2})?$"
_WHOLE = r"[0-9]{1,4}[-/.][0-9]{1,2}[-/.][0-9]{1,4}|[0-9]{8}"
TIME = (
    rf"[T ](?:{_HOUR}:{_MINUTE}(?::{_MINUTE}(?:[.][0-9]+)?)?|(?<=^(?:{_WHOLE})[T ]){_HOUR}"
    rf"|(?<=[0-9]T)(?:[01][0-9]|2[0-3]){_MINUTE}(?:{_MINUTE})?){_ZONE}"
)
# English month names, short or whole, with the dot that may follow.
_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"
_MONTH_NAME = (
    r"(?i)(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"
    r"(?:(?<=jan)uary|(?<=feb)ruary|(?<=mar)ch|(?<=apr)il|(?<=jun)e|(?<=jul)y"
    r"|(?<=aug)ust|(?<=sep)t(?:ember)?|(?<=oct)ober|(?<=nov)ember|(?<=dec)ember)?[.]?"
)

# Accepted forms, by separator. Y is a year of four digits and y one of two, M and D are a
# month and a day of one or two, N is a month's name. A month comes before a day when both are
# numbers and both fit. Frequent forms come first, as the lookup goes in this order.
FORMS = {
    "/": ["M/D/Y", "Y/M/D", "M/D/y", "Y/M", "M/Y", "D/N/Y", "D/N/y", "N/Y"],
    "-": ["Y-M-D", "M-D-Y", "M-D-y", "Y-M", "M-Y", "D-N-Y", "D-N-y", "N-D-Y", "Y-N-D", "N-Y"],
    ".": ["Y.M.D", "M.D.Y", "M.D.y", "Y.M"],
    " ": ["Y M D", "M D Y", "Y M", "M Y", "D N Y", "D N, Y", "N D Y", "N D, Y", "D N y", "N D y", "Y N D", "N Y", "N, Y"],
    "": ["Y", "YMD", "DNY", "NY"],
}
_DIGITS_AND_LETTERS = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
_CLASSES = "9" * 10 + "a" * 52
#: Two digits of a year up to here are of this century.
_LAST_SHORT_YEAR = "68"


def _shapes() -> dict[str, dict[str, int]]:
    """Shape of a text, its digits as 9 and its letters as a, to the place and length of its parts."""
    found = {}
    for form in (form for forms in FORMS.values() for form in forms):
        spread: list[tuple[str, dict[str, int]]] = [("", {})]
        for sign in form:
            # Next to another part a number has its full length.
            numbers = ["99"] if form == "YMD" else ["99", "9"]
            widths = {"Y": ["9999"], "y": ["99"], "N": ["aaa"], "M": numbers, "D": numbers}.get(sign)
            spread = [
                (shape + width, {**parts, sign.lower(): len(shape) + 1, f"{sign.lower()}_size": len(width)} if widths else parts)
                for shape, parts in spread
                for width in widths or [sign]
            ]
        found.update(spread)
    return found


SHAPES = _shapes()
_PARTS = [name for sign in "ymdn" for name in (sign, f"{sign}_size")]


def parse_int(value: Column, lenient: bool = False) -> Column:
    """4-byte integer. ``lenient`` also takes a zero fraction such as ``12.0``."""
    if lenient:
        value = F.regexp_replace(value.cast("string"), ZERO_FRACTION, "")
    return value.try_cast("int")


def is_number(text: Column) -> Column:
    """True for a text that :func:`parse_number` takes, ``nan`` included."""
    return text.rlike(NUMBER)


def parse_number(text: Column) -> Column:
    """Double from text; ``nan`` gives NULL."""
    number = F.regexp_extract(text, NUMBER, 0).try_cast("double")
    return F.nanvl(number, F.lit(None).cast("double"))


def _by_shape(text: Column) -> Column:
    """Year-month-day text of a text in one of ``FORMS``; NULL for any other.

    One lookup of the shape says where the parts are. A text of no known shape is looked up
    once more without its time of day and with short month names. Lambdas name the text and its parts
    once each, so that none is computed or copied twice.
    """
    kind = "map<string, struct<" + ", ".join(f"{name}: int" for name in _PARTS) + ">>"
    table = F.from_json(F.lit(json.dumps(SHAPES)), kind)

    def let(value: Column, use) -> Column:
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def place(word: Column) -> Column:
        return F.try_element_at(table, F.translate(word, _DIGITS_AND_LETTERS, _CLASSES))

    def bare(word: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(word, TIME, ""), _MONTH_NAME, "$1")

    def find(word: Column, other=None) -> Column:
        return let(place(word), lambda at: F.when(at.isNotNull(), parts(word, at)).otherwise(other(word) if other else None))

    def parts(word: Column, at: Column) -> Column:
        def part(sign: str) -> Column:
            return F.substr(word, at[sign], at[f"{sign}_size"])

        year = F.when(at["y_size"] == 4, part("y")).otherwise(
            F.concat(F.when(part("y") <= _LAST_SHORT_YEAR, "20").otherwise("19"), part("y"))
        )
        named = F.floor((F.instr(F.lit(_MONTHS), F.lower(part("n"))) + 3) / 4).cast("string")
        number = F.coalesce(named, part("m"), F.lit("1"))
        # A first number that is no month is the day, if the year stands last.
        leads = (at["m"] < at["d"]) & (at["d"] < at["y"])
        fields = F.struct(year.alias("year"), number.alias("month"), F.coalesce(part("d"), F.lit("1")).alias("day"), leads.alias("leads"))
        return let(fields, joined)

    def joined(found: Column) -> Column:
        swapped = F.coalesce(found["leads"], F.lit(False)) & (F.lpad(found["month"], 2, "0") > "12")
        month = F.when(swapped, found["day"]).otherwise(found["month"])
        day = F.when(swapped, found["month"]).otherwise(found["day"])
        return F.concat_ws("-", found["year"], month, day)

    return let(text, lambda word: find(word, lambda raw: let(bare(raw), lambda short: find(short))))


def parse_date(value: Column) -> Column:
    """Date from the accepted forms.

    Plain year-month-day text takes a cast alone. Other text is rewritten to it by its
    shape; a cast tells a bad day without the exception a pattern parse would raise and
    catch.
    """
    text = value.cast("string")
    rewritten = F.regexp_extract(_by_shape(text), IN_RANGE, 0)
    return F.when(text.rlike(IN_RANGE), text.try_cast("date")).otherwise(rewritten.try_cast("date"))
