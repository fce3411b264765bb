"""Encoding of what a variant holds, which only each value itself can tell.

A variant stands for a union: its member takes the form that a column of the held type would. Lists and objects
are walked level by level, as entries with their type beside them, so that each level is one expression and types
are looked up once. All of it is native; the walk is one SQL lambda, as it has some hundreds of terms.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Deeper lists and objects fail if they still hold something that needs encoding.
MAX_DEPTH = 8

# How schema_of_variant names what JSON cannot hold. A list of unlike members is of VARIANT.
_ENCODED = ("DATE", "TIMESTAMP", "BINARY", "FLOAT", "DOUBLE", "VARIANT")

# The text of each held type, of %s; zoneless timestamps are read as UTC in any session.
_TEXTS = {
    "date": "concat('date32:', unix_date(%s))",
    "timestamp": "concat('timestamp(Microsecond, ', unix_micros(%s), ')')",
    "timestamp_ntz": "concat('timestamp(Microsecond, ', timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', %s), ')')",
    "binary": "concat('0x', lower(hex(%s)))",
}


def _finite(value: str) -> str:
    """A floating-point number, or the text that stands for what is none."""
    spelled = "".join(
        f" WHEN {value} = CAST('{name}' AS DOUBLE) THEN CAST('{text}' AS VARIANT)"
        for name, text in (("NaN", "NaN"), ("Infinity", "inf"), ("-Infinity", "-inf"))
    )
    return f"CASE{spelled} ELSE CAST({value} AS VARIANT) END"


def _touched(kind: str, exact_text: bool) -> str:
    """Whether a value of this type may hold, at any depth, what is written in another form than JSON has it."""
    return f"{kind} RLIKE '{'|'.join((*_ENCODED, 'DECIMAL') if exact_text else _ENCODED)}'"


def _member(value: str, kind: str, exact_text: bool, depth: int) -> str:
    def held(name: str) -> str:
        return f"try_variant_get({value}, '$', '{name}')"

    cases = [f"WHEN {kind} = '{name.upper()}' THEN CAST({text % held(name)} AS VARIANT)" for name, text in _TEXTS.items()]
    cases += [f"WHEN {kind} = '{name}' THEN {_finite(f'CAST({held(name.lower())} AS DOUBLE)')}" for name in ("FLOAT", "DOUBLE")]
    if exact_text:
        cases.append(f"WHEN startswith({kind}, 'DECIMAL') THEN CAST(CAST({value} AS STRING) AS VARIANT)")
    is_list, is_object = f"startswith({kind}, 'ARRAY<')", f"startswith({kind}, 'OBJECT<')"
    if depth == 0:
        said = f"raise_error('a variant is nested over {MAX_DEPTH} levels deep')"
        cases.append(f"WHEN ({is_list} OR {is_object}) AND {_touched(kind, exact_text)} THEN CAST({said} AS VARIANT)")
        return f"CASE {' '.join(cases)} ELSE {value} END"

    def typed(key: str, child: str) -> str:
        return f"named_struct('key', {key}, 'value', {child}, 'kind', schema_of_variant({child}))"

    # Both kinds of children in one form, so that the next level is written once.
    e, done = f"e{depth}", f"d{depth}"
    listed = f"transform({held('array<variant>')}, {e} -> {typed('CAST(NULL AS STRING)', e)})"
    keyed = f"transform(map_entries({held('map<string,variant>')}), {e} -> {typed(f'{e}.key', f'{e}.value')})"
    below = _member(f"{e}.value", f"{e}.kind", exact_text, depth - 1)
    walked = f"transform(CASE WHEN {is_list} THEN {listed} ELSE {keyed} END, {e} -> named_struct('key', {e}.key, 'value', {below}))"
    again = (
        f"CASE WHEN {is_list} THEN to_variant_object({done}.value) ELSE to_variant_object(map_from_entries({done})) END"
    )
    # An array of one binds the walked children to a name.
    cases.append(f"WHEN {is_list} OR {is_object} THEN transform(array({walked}), {done} -> {again})[0]")
    return f"CASE {' '.join(cases)} ELSE {value} END"


@cache
def _walk(exact_text: bool, depth: int) -> str:
    member = _member("v.value", "v.kind", exact_text, depth)
    return f"v -> CASE WHEN {_touched('v.kind', exact_text)} THEN {member} ELSE v.value END"


def encoded_variant(value: Column, exact_text: bool) -> Column:
    """``value`` with every member in the form a column of its held type has in the embedded dialect.

    ``exact_text`` turns decimals into text as well. That is right for unions; a variant parsed from JSON holds
    decimals for its fractions, which stay numbers. Spark's variants drop the trailing zeros of decimals.
    """
    typed = F.array(F.struct(value.alias("value"), F.schema_of_variant(value).alias("kind")))
    return F.call_function("transform", typed, F.expr(_walk(exact_text, MAX_DEPTH)))[0]
