"""Row functions. All are native column expressions; none is a UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money is held in cents, rates in ten-thousandths, both as longs.
CENT = 100
RATE_UNIT = 10_000

# Upper edges of the delay buckets in ms (<1 s, 1-5, 5-15, 15-60, >=60 s).
DELAY_EDGES_MS = (1_000, 5_000, 15_000, 60_000)


def epoch_ms(ts: Column) -> Column:
    """Epoch milliseconds of a zone-less timestamp, floored."""
    return F.unix_millis(ts.cast("timestamp"))


def window_start_ms(ms: Column, size_ms: int) -> Column:
    """Start of the tumbling window that holds ``ms``; floors below zero too."""
    return ms - F.pmod(ms, F.lit(size_ms))


def delay_ms(arrival: Column, event_time: Column) -> Column:
    """Arrival minus event time; a missing event time counts as no delay."""
    return arrival - F.coalesce(event_time, arrival)


def bucket_index(value: Column, edges: Sequence[int] = DELAY_EDGES_MS) -> Column:
    """Index of the first edge above ``value``; the last bucket is open."""
    out = F
    for i, edge in enumerate(edges):
        out = out.when(value < edge, F.lit(i))
    return out.otherwise(F.lit(len(edges)))


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), value))


def padded_id(prefix: str, number: Column, width: int) -> Column:
    return F.format_string(f"{prefix}%0{width}d", number)


def cyclic(items: Sequence[str], index: Column) -> Column:
    """``items[index % len(items)]``."""
    return F.element_at(
        F.array(*[F.lit(x) for x in items]), (F.pmod(index, F.lit(len(items))) + 1).cast("int")
    )


def composite_key(*parts: Column) -> Column:
    return F.concat_ws("|", *[p.cast("string") for p in parts])


def iso_utc(ts: Column) -> Column:
    """``2024-01-31T09:05:00Z``: seconds, fraction cut off (session zone UTC)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def random_id() -> Column:
    """A random id per row; :func:`row_id` where a re-run must give the same one."""
    return F.expr("uuid()")


def row_id(*parts: Column) -> Column:
    return F.sha2(composite_key(*parts), 256)


def cents(value: Column) -> Column:
    """Money of two places as a whole number of cents: exact sums, cheap arithmetic."""
    return F.rint(value * CENT).cast("long")


def rate(value: Column) -> Column:
    """A rate of four places as a whole number of ten-thousandths."""
    return F.rint(value * RATE_UNIT).cast("long")


def share(amount_cents: Column, rate_units: Column) -> Column:
    """``amount * rate`` in cents, rounded half away from zero."""
    product = amount_cents * rate_units
    half = F.when(product < 0, F.lit(-RATE_UNIT // 2)).otherwise(F.lit(RATE_UNIT // 2))
    return F.call_function("div", product + half, F.lit(RATE_UNIT))


def units(amount_cents: Column) -> Column:
    """Cents as a double of currency units."""
    return amount_cents / F.lit(float(CENT))


def parse_symbols(text: Column) -> Column:
    """``"a, b"`` gives its trimmed non-empty items; all-digit ``"n"`` gives SYM1..SYMn."""
    n = text.try_cast("int")
    numbered = F.when(
        n > 0,
        F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                    lambda i: F.concat(F.lit("SYM"), i.cast("string"))),
    ).otherwise(F.array().cast("array<string>"))
    listed = F.filter(F.transform(F.split(text, ","), lambda s: F.trim(s)), lambda s: F.length(s) > 0)
    return F.when(F.trim(text).rlike("^[0-9]+$"), numbered).otherwise(listed)
