"""Column expressions shared by the operators. All of them are built-in Spark expressions."""

from pyspark.sql import Column, functions as F


def int_div(a, b) -> Column:
    """Integer division of 64-bit values."""
    return F.call_function("div", _col(a), _col(b))


def ceil_div(a, b) -> Column:
    return int_div(_col(a) + _col(b) - 1, b)


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def last_element(path: Column) -> Column:
    """Text after the last slash; all of the text if there is none."""
    return F.substring_index(path, "/", -1)


def same_path(path: Column) -> Column:
    """One spelling per path: no doubled and no final slash."""
    return F.regexp_replace(F.regexp_replace(path, "/{2,}", "/"), "(?<=.)/$", "")


def range_header(offset: Column, length: Column) -> Column:
    """``bytes=a-b`` with an inclusive end; null for an empty range, which has no such form."""
    text = F.concat(F.lit("bytes="), offset.cast("string"), F.lit("-"), (offset + length - 1).cast("string"))
    return F.when(length > 0, text)


def format_bytes(n: Column, suffix: str = "") -> Column:
    """Decimal units with two digits, strictly above 1e9, 1e6 and 1e3; plain bytes below."""
    def unit(divisor, name):
        scaled = F.call_function("format_number", n / F.lit(divisor), F.lit("#0.00"))
        return F.concat(scaled, F.lit(name + suffix))

    return (F.when(n > 1_000_000_000, unit(1e9, "GB"))
            .when(n > 1_000_000, unit(1e6, "MB"))
            .when(n > 1_000, unit(1e3, "KB"))
            .otherwise(F.concat(n.cast("string"), F.lit("B" + suffix))))
