"""Generated values as Spark columns of a row number."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab
from .dates import spread_date


def pick(values, index: Column) -> Column:
    """Cycle through a short list of fixed values."""
    return F.array(*[F.lit(v) for v in values])[F.pmod(index, F.lit(len(values))).cast("int")]


def person_name(index: Column) -> Column:
    size = len(vocab.FIRST_NAMES)
    return F.concat(pick(vocab.FIRST_NAMES, index), F.lit(" "), pick(vocab.LAST_NAMES, F.floor(index / size)))


def city(index: Column, step: int) -> Column:
    """City of the row's state; the state changes with every row, the city every ``step`` rows."""
    cities = F.array(*[F.array(*[F.lit(c) for c in state[3]]) for state in vocab.STATES])
    own = cities[F.pmod(index, F.lit(len(vocab.STATES))).cast("int")]
    return own[F.pmod(F.floor(index / step), F.size(own)).cast("int")]


def padded(number: Column, width: int) -> Column:
    """Zero-padded number that is never cut, as ``lpad`` alone would do."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def time_text(index: Column) -> Column:
    return F.concat(padded(8 + F.pmod(index, F.lit(10)), 2), F.lit(":"), padded(F.pmod(index * 7, F.lit(60)), 2), F.lit(":00"))


def phone(index: Column) -> Column:
    return F.concat(F.lit("9"), F.pmod(index, F.lit(10)).cast("string"), padded(F.pmod(index * 7919, F.lit(100_000_000)), 8))


def email(index: Column) -> Column:
    return F.concat(F.lit("contact"), (index + 1).cast("string"), F.lit("@example.test"))


def tax_number(index: Column) -> Column:
    return F.concat(F.lit("27DEMO"), padded(index + 1, 9), F.lit("Z1"))


def post_code(index: Column) -> Column:
    return (100_000 + F.pmod(index, F.lit(899_999))).cast("string")


def measure(index: Column) -> Column:
    return F.round(500 + F.pmod(index * 173, F.lit(250_000)) / 100, 2).cast("string")


def _named(names: tuple[str, ...]) -> str:
    return "^(" + "|".join(names) + ")$"


# The role of a generated column: the first pattern that is found in its lower-cased name.
COLUMN_ROLES = (
    ("state", _named(vocab.STATE_COLUMNS)),
    ("region", _named(vocab.REGION_COLUMNS)),
    ("country", _named(vocab.COUNTRY_COLUMNS)),
    ("category", _named(vocab.CATEGORY_COLUMNS)),
    ("department", _named(vocab.DEPARTMENT_COLUMNS)),
    ("access_role", _named(vocab.ROLE_COLUMNS)),
    ("flag", _named(vocab.FLAG_COLUMNS)),
    ("date", "(" + "|".join(vocab.DATE_ENDINGS) + ")$|" + _named(vocab.DATE_COLUMNS)),
    ("time", "_tm$"),
    ("measure", "|".join(vocab.MEASURE_PARTS)),
    ("json", "^raw_json$"),
    ("email", "email|^to_addr$"),
    ("phone", "mob_no"),
    ("tax_number", "gstin"),
    ("post_code", "pin_cd"),
    ("city", "city"),
    ("name", "nm|name"),
    ("schedule", "^cron_exp$"),
    ("label", _named(vocab.LABEL_COLUMNS)),
    ("code", "_cd$"),
    ("number", "_id$"),
)


def column_role(name: Column) -> Column:
    """Role of a column from its name."""
    role = F
    for label, pattern in COLUMN_ROLES:
        role = role.when(F.lower(name).rlike(pattern), label)
    return role.otherwise("text")


def role_of(name: str) -> str:
    """The same rules for a name the program already holds."""
    return next((label for label, pattern in COLUMN_ROLES if re.search(pattern, name.lower())), "text")


def _measure_of(name: str, i: Column) -> Column:
    for part, value in (
        ("rating", 1 + F.pmod(i, F.lit(5))),
        ("pct", 5 + F.pmod(i, F.lit(35))),
        ("qty|units|on_hand", 1 + F.pmod(i, F.lit(500))),
    ):
        if re.search(part, name):
            return value.cast("string")
    return measure(i)


def _title(name: str) -> str:
    return name.replace("_", " ").title()


def generic_value(table: str, column: str, i: Column, end_date: str) -> Column:
    """Text value of one generated column for row number ``i`` (from 0), by the column's role."""
    name = column.lower()
    numbered = lambda text: F.concat(F.lit(text + " "), padded(i + 1, 5))
    person = "emp" in table or name.startswith("hod")
    values = {
        "state": lambda: pick([s[0] for s in vocab.STATES], i),
        "region": lambda: pick(vocab.REGIONS, i),
        "country": lambda: pick(vocab.COUNTRIES, i),
        "category": lambda: pick([p[1] for p in vocab.PRODUCTS], i),
        "department": lambda: pick(vocab.DEPARTMENTS, i),
        "access_role": lambda: pick(vocab.ACCESS_ROLES, i),
        "flag": lambda: pick(vocab.FLAGS, i),
        "date": lambda: spread_date(i, F.lit(vocab.TARGET_ROWS), end_date, offset=len(table)).cast("string"),
        "time": lambda: time_text(i),
        "measure": lambda: _measure_of(name, i),
        "json": lambda: F.concat(F.lit(f'{{"source": "demo_seed", "table": "{table}", "row": '), (i + 1).cast("string"), F.lit("}")),
        "email": lambda: email(i),
        "phone": lambda: phone(i),
        "tax_number": lambda: tax_number(i),
        "post_code": lambda: post_code(i),
        "city": lambda: city(i, 3),
        "name": lambda: person_name(i) if person else numbered(_title(table)),
        "schedule": lambda: F.concat(F.pmod(i, F.lit(60)).cast("string"), F.lit(" "), F.pmod(i, F.lit(24)).cast("string"), F.lit(" * * *")),
        "label": lambda: numbered(_title(name)),
        "code": lambda: F.concat(F.lit(name[:-3].upper()), padded(F.pmod(i, F.lit(20)), 2)),
        "number": lambda: (i + 1).cast("string"),
        "text": lambda: F.concat(F.lit(f"{table}_{name}_"), padded(i + 1, 5)),
    }
    return values[role_of(name)]()
