"""Numeric and date expressions behind the scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from upswell import settings


def size_band(size: Column, bands: Sequence[tuple[int, str]] = settings.SIZE_BANDS) -> Column:
    """Label of the left-closed band holding ``size``; NULL below the lowest bound."""
    label = None
    for lower, name in sorted(bands, reverse=True):
        label = F.when(size >= lower, name) if label is None else label.when(size >= lower, name)
    return label


def log_rate(now: Column, then: Column, span_days: Column) -> Column:
    """Log growth per day; NULL unless both totals are positive and a day has passed."""
    usable = (now > 0) & (then > 0) & (span_days >= 1)
    return F.when(usable, F.log(now / then) / span_days)


def growth_pct(rate: Column, days: int) -> Column:
    return (F.exp(rate * F.lit(days)) - 1) * 100


def soft_clip(z: Column, clip: float = settings.Z_CLIP) -> Column:
    return F.tanh(z / clip) * clip


def weighted_mean(parts: dict[str, float], columns: dict[str, Column] | None = None) -> Column:
    """Mean of the named columns over those present, weights renormalised."""
    total, weight = F.lit(0.0), F.lit(0.0)
    for name, w in parts.items():
        c = (columns or {}).get(name, F.col(name))
        total = total + F.coalesce(c, F.lit(0.0)) * w
        weight = weight + F.when(c.isNotNull(), w).otherwise(0.0)
    return total / F.nullif(weight, F.lit(0.0))


def smallness(size: Column) -> Column:
    """1 at the floor or below, 0 once established, log scale between; unknown or 0 is 0."""
    span = F.log(F.lit(settings.ESTABLISHED / settings.SMALL_FLOOR))
    scaled = F.log(F.lit(float(settings.ESTABLISHED)) / F.nullif(size, F.lit(0))) / span
    return F.coalesce(F.least(F.lit(1.0), F.greatest(F.lit(0.0), scaled)), F.lit(0.0))


def cheapness(price: Column) -> Column:
    """Credit for a listed price above zero; a missing or zero price earns none."""
    credit = F.greatest(F.lit(0.0), F.lit(1.0) - price / settings.CHEAP_SCALE)
    return F.when(price != 0, credit).otherwise(0.0)


def half_even(value: Column, digits: int = 0) -> Column:
    """Round half to even. Noise past the ninth decimal goes first, so a computed half counts as
    a half whatever order its terms were added in."""
    return F.bround(F.round(value, 9), digits)


def shows_window(as_of: Column, today: Column, days_ahead: int) -> tuple[Column, Column]:
    """Both ends included. A stale snapshot must not list what has already happened."""
    start = F.greatest(as_of, today)
    return start, F.date_add(start, days_ahead)


def weekend_window(today: Column) -> tuple[Column, Column]:
    """The coming Friday to Sunday, or today to Sunday when the weekend has begun."""
    # dayofweek: Sunday 1 .. Saturday 7
    day = F.dayofweek(today)
    start = F.when(day.isin(1, 7), today).otherwise(F.date_add(today, 6 - day))
    end = F.when(day == 1, today).otherwise(F.date_add(today, 8 - day))
    return start, end


def ticket_status(code: Column, sale_start: Column, sale_end: Column, now: Column) -> Column:
    """What a status code and the public sale window say about tickets."""
    return (
        F.when(code == "onsale", "on sale")
        .when(code.isin(*settings.CANCELED), "canceled")
        .when(code.isin("postponed", "rescheduled"), code)
        .when((code == "offsale") & (now < sale_start), "not on sale yet")
        .when((code == "offsale") & (now < sale_end), "off sale")
        .when(code == "offsale", "sales closed")
        .otherwise("unknown")
    )


def ticket_note(status: Column, found: Column, sale_start: Column, new_date: Column) -> Column:
    """The sentence shown beside a status, NULL where the status says it all."""
    moved = F.concat(F.lit("Listed as "), status)
    return (
        F.when(~found, "Not listed any more (removed or canceled?).")
        .when(status == "canceled", "Listed as canceled.")
        .when(
            status.isin("postponed", "rescheduled"),
            F.concat(
                moved,
                F.coalesce(F.concat(F.lit("; date now "), new_date.cast("string")), F.lit("")),
                F.lit("."),
            ),
        )
        .when(
            status == "not on sale yet",
            F.concat(F.lit("Public sale starts "), F.to_date(sale_start).cast("string"), F.lit(".")),
        )
        .when(status == "off sale", "Not selling in its sale window: often sold out, unconfirmed.")
    )
