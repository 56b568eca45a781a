"""Row checks: each gives a Column that is true where the row fails. A NULL outcome passes unless a check says otherwise."""

from __future__ import annotations

import ipaddress
import re
from collections.abc import Callable, Iterable, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltwork.functions.codes import iso_codes

CHECKS: dict[str, Callable[..., Column]] = {}

#: Fixed patterns.
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$"
UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
UUID_STRICT = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[1-8][0-9a-fA-F]{3}-[89abAB][0-9a-fA-F]{3}-[0-9a-fA-F]{12}$"
IPV4 = r"^((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$"
NATIONAL_ID = {"US": r"^(?!000|666|9[0-9]{2})[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"}
SUBDIVISION = r"^[A-Z]{2}-[A-Z0-9]{1,3}$"


def check(f: Callable[..., Column]) -> Callable[..., Column]:
    CHECKS[f.__name__] = f
    return f


def fails(function: str, arguments: dict[str, Any]) -> Column:
    """The named check's Column, NULL counted as a pass."""
    return F.coalesce(CHECKS[function](**arguments), F.lit(False))


def literal(value: Any) -> Column:
    """A list item of a rule: text in quotes is a value, bare text is an expression over columns, anything else a value."""
    if isinstance(value, str):
        return F.lit(value[1:-1]) if len(value) > 1 and value[0] == value[-1] == "'" else F.expr(value)
    return value if isinstance(value, Column) else F.lit(value)


def _text(c: str, trim_strings: bool = False) -> Column:
    return F.trim(F.col(c).cast("string")) if trim_strings else F.col(c).cast("string")


@check
def is_not_null(column: str) -> Column:
    return F.expr(column).isNull()


@check
def is_null(column: str) -> Column:
    return F.expr(column).isNotNull()


@check
def is_not_empty(column: str, trim_strings: bool = False) -> Column:
    return _text(column, trim_strings) == ""


@check
def is_empty(column: str, trim_strings: bool = False) -> Column:
    return _text(column, trim_strings) != ""


@check
def is_not_null_and_not_empty(column: str, trim_strings: bool = False) -> Column:
    return F.col(column).isNull() | (_text(column, trim_strings) == "")


@check
def is_null_or_empty(column: str, trim_strings: bool = False) -> Column:
    return F.col(column).isNotNull() & (_text(column, trim_strings) != "")


@check
def is_not_null_and_not_empty_array(column: str) -> Column:
    return F.col(column).isNull() | (F.size(column) == 0)


def _isin(column: str, values: Sequence[Any], case_sensitive: bool) -> Column:
    c, items = F.col(column), [literal(v) for v in values]
    return c.isin(items) if case_sensitive else F.lower(c).isin([F.lower(v) for v in items])


@check
def is_in_list(column: str, allowed: Sequence[Any], case_sensitive: bool = True) -> Column:
    return ~_isin(column, allowed, case_sensitive)


@check
def is_not_in_list(column: str, forbidden: Sequence[Any], case_sensitive: bool = True) -> Column:
    return _isin(column, forbidden, case_sensitive)


@check
def is_not_null_and_is_in_list(column: str, allowed: Sequence[Any], case_sensitive: bool = True) -> Column:
    return F.coalesce(~_isin(column, allowed, case_sensitive), F.lit(True))


@check
def has_valid_string_case(column: str, case: str = "upper") -> Column:
    c = F.col(column)
    want = {"upper": lambda: F.upper(c), "lower": lambda: F.lower(c), "title": lambda: F.initcap(c), "sentence": lambda: F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 2147483647)))}
    return c != want[case]()


@check
def sql_expression(expression: str, msg: str | None = None, columns: Sequence[str] | None = None, negate: bool = False, null_fails: bool = False) -> Column:
    e = F.expr(expression)
    return F.coalesce(e if negate else ~e, F.lit(null_fails))


@check
def is_in_range(column: str, min_limit: Any, max_limit: Any) -> Column:
    return ~F.expr(column).between(literal(min_limit), literal(max_limit))


@check
def is_not_in_range(column: str, min_limit: Any, max_limit: Any) -> Column:
    return F.expr(column).between(literal(min_limit), literal(max_limit))


@check
def is_not_less_than(column: str, limit: Any) -> Column:
    return F.expr(column) < literal(limit)


@check
def is_not_greater_than(column: str, limit: Any) -> Column:
    return F.expr(column) > literal(limit)


def differs(c: Column, value: Column, abs_tolerance: float | None, rel_tolerance: float | None) -> Column:
    """Whether numbers differ by more than the larger of the tolerances."""
    if not abs_tolerance and not rel_tolerance:
        return c != value
    room = F.greatest(F.lit(float(abs_tolerance or 0)), F.lit(float(rel_tolerance or 0)) * F.greatest(F.abs(c), F.abs(value)))
    return F.abs(c - value) > room


@check
def is_equal_to(column: str, value: Any, abs_tolerance: float | None = None, rel_tolerance: float | None = None) -> Column:
    return differs(F.expr(column), literal(value), abs_tolerance, rel_tolerance)


@check
def is_not_equal_to(column: str, value: Any, abs_tolerance: float | None = None, rel_tolerance: float | None = None) -> Column:
    return ~differs(F.expr(column), literal(value), abs_tolerance, rel_tolerance)


@check
def is_valid_date(column: str, date_format: str | None = None) -> Column:
    parsed = F.try_to_date(F.col(column), date_format) if date_format else F.col(column).try_cast("date")
    return F.col(column).isNotNull() & parsed.isNull()


@check
def is_valid_timestamp(column: str, timestamp_format: str | None = None) -> Column:
    parsed = F.try_to_timestamp(F.col(column), F.lit(timestamp_format)) if timestamp_format else F.col(column).try_cast("timestamp")
    return F.col(column).isNotNull() & parsed.isNull()


def _moment(value: Any) -> Column:
    return F.current_timestamp() if value is None else F.lit(value).cast("timestamp") if not isinstance(value, Column) else value


def _seconds(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


@check
def is_not_in_future(column: str, offset: int = 0, curr_timestamp: Any = None) -> Column:
    return _seconds(F.col(column)) > _seconds(_moment(curr_timestamp)) + offset * 1_000_000


@check
def is_not_in_near_future(column: str, offset: int = 0, curr_timestamp: Any = None) -> Column:
    at, now = _seconds(F.col(column)), _seconds(_moment(curr_timestamp))
    return (at > now) & (at < now + offset * 1_000_000)


@check
def is_older_than_n_days(column: str, days: int, curr_date: Any = None, negate: bool = False) -> Column:
    today = F.current_date() if curr_date is None else F.lit(curr_date).cast("date")
    old = F.col(column).cast("date") < F.date_sub(today, days)
    return old if negate else ~old


@check
def is_older_than_col2_for_n_days(column1: str, column2: str, days: int = 0, negate: bool = False) -> Column:
    old = F.col(column1).cast("date") < F.date_sub(F.col(column2).cast("date"), days)
    return old if negate else ~old


@check
def is_data_fresh(column: str, max_age_minutes: int, base_timestamp: Any = None) -> Column:
    return _seconds(F.col(column)) < _seconds(_moment(base_timestamp)) - max_age_minutes * 60_000_000


@check
def regex_match(column: str, regex: str, negate: bool = False) -> Column:
    found = F.col(column).rlike(regex)
    return found if negate else ~found


@check
def is_valid_email(column: str) -> Column:
    return ~F.col(column).rlike(EMAIL)


@check
def is_valid_uuid(column: str, strict: bool = False) -> Column:
    return ~F.col(column).rlike(UUID_STRICT if strict else UUID)


@check
def is_valid_national_id(column: str, country: str = "US") -> Column:
    if country not in NATIONAL_ID:
        raise ValueError(f"no pattern for national ids of {country}")
    return ~F.col(column).rlike(NATIONAL_ID[country])


def _coded(column: str, kind: str, code_format: str, case_sensitive: bool, codes: Iterable[str] | None) -> Column:
    values = list(codes if codes is not None else iso_codes(kind, code_format))
    c = F.col(column)
    return ~(c.isin(values) if case_sensitive else F.lower(c).isin([v.lower() for v in values]))


@check
def is_valid_currency_code(column: str, code_format: str = "", case_sensitive: bool = True, codes: Iterable[str] | None = None) -> Column:
    return _coded(column, "currency", code_format, case_sensitive, codes)


@check
def is_valid_country_code(column: str, code_format: str = "", case_sensitive: bool = True, codes: Iterable[str] | None = None) -> Column:
    return _coded(column, "country", code_format, case_sensitive, codes)


@check
def is_valid_language_code(column: str, code_format: str = "", case_sensitive: bool = True, codes: Iterable[str] | None = None) -> Column:
    return _coded(column, "language", code_format, case_sensitive, codes)


@check
def is_valid_subdivision_code(column: str, country_column: str | None = None, codes: Iterable[str] | None = None) -> Column:
    """codes: the ISO 3166-2 list; without one the form and the country part are checked."""
    c = F.col(column)
    country = F.substring(c, 1, 2)
    bad = ~c.isin(list(codes)) if codes is not None else ~(c.rlike(SUBDIVISION) & country.isin(list(iso_codes("country"))))
    return bad if country_column is None else bad | (country != F.col(country_column))


@check
def is_valid_ipv4_address(column: str) -> Column:
    return ~F.col(column).rlike(IPV4)


def ipv4_number(c: Column) -> Column:
    """The address as a long; NULL if it is none."""
    parts = F.transform(F.split(c, r"\."), lambda x: x.try_cast("long"))
    number = F.aggregate(parts, F.lit(0).cast("long"), lambda acc, x: acc * 256 + x)
    return F.when(c.rlike(IPV4), number)


@check
def is_ipv4_address_in_cidr(column: str, cidr_block: str) -> Column:
    block = ipaddress.IPv4Network(cidr_block, strict=False)
    number = ipv4_number(F.col(column))
    inside = number.between(int(block.network_address), int(block.broadcast_address))
    return F.col(column).isNotNull() & ~F.coalesce(inside, F.lit(False))


def _ipv6_outside(block: str | None) -> Callable[[Column], Column]:
    net = None if block is None else ipaddress.IPv6Network(block, strict=False)

    def outside(value: str) -> bool:
        try:
            address = ipaddress.IPv6Address(value)
        except ValueError:
            return True
        return net is not None and address not in net

    @F.pandas_udf(T.BooleanType())
    def udf(values: pd.Series) -> pd.Series:
        known = {v: outside(v) for v in values.dropna().unique()}
        return values.map(known).where(values.notna(), None)

    return udf


@check
def is_valid_ipv6_address(column: str) -> Column:
    return _ipv6_outside(None)(F.col(column))


@check
def is_ipv6_address_in_cidr(column: str, cidr_block: str) -> Column:
    return _ipv6_outside(cidr_block)(F.col(column))


@check
def is_valid_json(column: str) -> Column:
    return F.col(column).isNotNull() & F.try_parse_json(F.col(column)).isNull()


@check
def has_json_keys(column: str, keys: Sequence[str], require_all: bool = True) -> Column:
    there, wanted = F.json_object_keys(F.col(column)), F.array(*[F.lit(k) for k in keys])
    ok = F.size(F.array_except(wanted, there)) == 0 if require_all else F.arrays_overlap(wanted, there)
    return F.col(column).isNotNull() & ~F.coalesce(ok, F.lit(False))


_NUMBERS = r"^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$"


def _step(name: str) -> str:
    return "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"


def _misfits(v: Column, kind: T.DataType, path: str) -> list[tuple[str, Column]]:
    """(path, whether it is not of its type) of a present JSON value and all that it holds; ``[*]`` stands for any item."""
    has = F.schema_of_variant(v)
    if isinstance(kind, T.StructType):
        out = [(path, ~has.startswith("OBJECT"))]
        for f in kind.fields:
            inner = F.try_variant_get(v, _step(f.name), "variant")
            there, at = inner.isNotNull() & ~F.coalesce(F.is_variant_null(inner), F.lit(True)), f"{path}.{f.name}"
            if not f.nullable:
                out.append((f"{at} (missing)", has.startswith("OBJECT") & ~there))
            out += [(p, there & bad) for p, bad in _misfits(inner, f.dataType, at)]
        return out
    if isinstance(kind, T.ArrayType | T.MapType):
        array = isinstance(kind, T.ArrayType)
        of, required, start = (kind.elementType, not kind.containsNull, "ARRAY") if array else (kind.valueType, not kind.valueContainsNull, "OBJECT")
        items = F.try_variant_get(v, "$", "array<variant>") if array else F.map_values(F.try_variant_get(v, "$", "map<string,variant>"))
        none = lambda i: F.coalesce(F.is_variant_null(i), F.lit(True))
        any_ = lambda bad: F.coalesce(F.exists(items, bad), F.lit(False))
        out = [(path, ~has.startswith(start))]
        if required:
            out.append((f"{path}[*] (missing)", any_(none)))
        names = [p for p, _ in _misfits(v, of, f"{path}[*]")]
        nth = lambda n: lambda i: ~none(i) & _misfits(i, of, path)[n][1]
        return out + [(p, any_(nth(n))) for n, p in enumerate(names)]
    if isinstance(kind, T.StringType):
        return []  # any value has a text
    if isinstance(kind, T.BooleanType):
        return [(path, has != "BOOLEAN")]
    whole = isinstance(kind, T.IntegralType)
    fits = (has == "BIGINT") if whole else has.rlike(_NUMBERS) if isinstance(kind, T.NumericType) else (has == "STRING")
    return [(path, ~fits | F.try_variant_get(v, "$", kind.simpleString()).isNull())]


def json_misfits(column: str, schema: str | T.StructType) -> Column:
    """The paths at which a JSON text does not fit a schema, from ``$``; empty for one that fits and for NULL."""
    want = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    c = F.col(column)
    v = F.try_parse_json(c)
    found = [("$", v.isNull()), *((p, v.isNotNull() & bad) for p, bad in _misfits(v, want, "$"))]
    paths = F.filter(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(p)) for p, bad in found]), lambda x: x.isNotNull())
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(paths)


@check
def has_valid_json_schema(column: str, schema: str) -> Column:
    """schema: DDL with structs, arrays and maps at any depth; a NOT NULL field must be there, and what is there must be of its type."""
    return F.size(json_misfits(column, schema)) > 0
