"""Code lists of ISO 4217, 3166-1 and 639, taken from the Java runtime that Spark runs on."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import SparkSession


@lru_cache(maxsize=8)
def iso_codes(kind: str, code_format: str = "") -> tuple[str, ...]:
    """Codes of a ``currency`` (alphabetic or numeric), ``country`` (alpha2, alpha3, numeric needs a list) or ``language`` (alpha2, alpha3)."""
    util = SparkSession.active().sparkContext._jvm.java.util
    if kind == "currency":
        every = list(util.Currency.getAvailableCurrencies().toArray())
        return tuple(sorted({f"{c.getNumericCode():03d}" if code_format == "numeric" else c.getCurrencyCode() for c in every}))
    if kind == "country":
        if code_format == "numeric":
            raise ValueError("there is no list of numeric country codes here: pass one as codes")
        two = list(util.Locale.getISOCountries())
        return tuple(sorted(two if code_format in ("", "alpha2", "alpha-2") else {util.Locale.of("", c).getISO3Country() for c in two}))
    two = list(util.Locale.getISOLanguages())
    return tuple(sorted(two if code_format in ("", "alpha2", "alpha-2", "639-1") else {util.Locale.of(c).getISO3Language() for c in two}))
