"""Column functions that write values for readers, and read such writing back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(amount: Column) -> Column:
    """An amount of pesos with dots between thousands."""
    return F.concat(F.lit("$ "), F.replace(F.format_number(amount.cast("long"), 0), F.lit(","), F.lit(".")))


def price_label(amounts: Column) -> Column:
    """The lowest of an event's amounts: "Gratis" for nothing, "Desde" where there are several; null for none."""
    low = F.array_min(amounts)
    return F.when(F.coalesce(F.size(amounts), F.lit(0)) > 0, F.when(low == 0, "Gratis").when(F.size(amounts) > 1, F.concat(F.lit("Desde "), money(low))).otherwise(money(low)))


def counted(*parts: tuple[Column, str, str]) -> Column:
    """Counts that aren't zero, each with its singular or plural, as one list."""
    return F.concat_ws(", ", *[F.when(n > 0, F.concat_ws(" ", n.cast("string"), F.when(n == 1, one).otherwise(many))) for n, one, many in parts])


def decimal(number: Column, places: int = 1) -> Column:
    """A number with a comma before its decimals and dots between thousands."""
    return F.translate(F.format_number(number, places), ",.", ".,")


def minutes(hhmm: Column) -> Column:
    """Minutes after midnight of HH:MM."""
    return F.split_part(hhmm, F.lit(":"), F.lit(1)).try_cast("int") * 60 + F.split_part(hhmm, F.lit(":"), F.lit(2)).try_cast("int")


def version(text: Column) -> Column:
    """A dotted version to compare, as an array of numbers without zeros at its end."""
    parts = F.transform(F.split(text, r"\."), lambda p: p.try_cast("int"))
    used = F.coalesce(F.array_max(F.transform(parts, lambda p, i: F.when(p != 0, i + 1))), F.lit(0))
    return F.slice(parts, F.lit(1), used)


def read_handle(text: Column) -> Column:
    """struct(name, cut): an account's name as read in an image, and whether it was cut off; no valid name is null."""
    plain = F.btrim(F.ltrim(F.btrim(F.coalesce(text, F.lit(""))), F.lit("@")))
    cut = F.endswith(plain, F.lit("…")) | F.endswith(plain, F.lit("..."))
    name = F.lower(F.btrim(F.rtrim(F.rtrim(plain, F.lit("…")), F.lit("."))))
    return F.struct(F.when(name.rlike(r"^[a-z0-9._]{1,30}$"), name).alias("name"), cut.alias("cut"))


def dance_score(text: Column, keywords: list[str]) -> Column:
    """How many of the keywords a text holds."""
    return F.size(F.filter(F.array(*map(F.lit, keywords)), lambda k: F.contains(text, k)))


# Short months and the days of a week, Monday first, as readers see them.
SHORT_MONTHS = "ene feb mar abr may jun jul ago sep oct nov dic".split()
WEEKDAYS = "lunes martes miércoles jueves viernes sábado domingo".split()


def _month(day: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, SHORT_MONTHS)), F.month(day))


def _text(*parts: Column | str) -> Column:
    return F.concat_ws(" ", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def dates_label(first: Column, last: Column) -> Column:
    """An event's only day as stored, or its range with what both ends share written once; "?" without a first day."""
    whole = lambda d: _text(F.dayofmonth(d), _month(d), F.year(d))
    one_month = F.concat(F.dayofmonth(first).cast("string"), F.lit("–"), whole(last))
    span = F.when(F.year(first) != F.year(last), _text(whole(first), "–", whole(last))).when(F.month(first) != F.month(last), _text(F.dayofmonth(first), _month(first), "–", whole(last))).otherwise(one_month)
    return F.when(first.isNull(), "?").when(last > first, span).otherwise(first.cast("string"))


def sessions_label(days: Column) -> Column:
    """A series' days: each month once, after its last day; years where they span two."""
    years = F.year(F.try_element_at(days, F.lit(1))) != F.year(F.try_element_at(days, F.lit(-1)))

    def part(day: Column, i: Column) -> Column:
        following = F.get(days, i + 1)
        ends = F.coalesce(F.trunc(following, "month") != F.trunc(day, "month"), F.lit(True))
        return F.concat_ws(" ", F.dayofmonth(day).cast("string"), F.when(ends, _month(day)), F.when(ends & years, F.year(day).cast("string")))

    parts = F.transform(days, part)
    listed = F.concat_ws(" y ", F.nullif(F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), ", "), F.lit("")), F.try_element_at(parts, F.lit(-1)))
    return F.concat(F.size(days).cast("string"), F.lit(" sesiones: "), listed)


def day_label(day: Column) -> Column:
    return _text(F.element_at(F.array(*map(F.lit, WEEKDAYS)), F.weekday(day) + 1), F.dayofmonth(day), _month(day), F.year(day))


def clock_label(moment: Column) -> Column:
    """The time of day on a clock of twelve hours."""
    hour = F.when(F.hour(moment) % 12 == 0, 12).otherwise(F.hour(moment) % 12)
    return F.concat(hour.cast("string"), F.lit(":"), F.lpad(F.minute(moment).cast("string"), 2, "0"), F.when(F.hour(moment) < 12, " a. m.").otherwise(" p. m."))
