"""Why an event is worth a second look."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heraldo.functions import resolve, text
from heraldo.functions.cancellation import PARTICIPLES
from heraldo.operators.announcements import GATHERINGS

# Words of a doubt that is serious (the day, the city, whether it takes place), and doubts as readers see them.
DAY_WORDS = ["fecha", "fechas", "dia", "dias", "mes", "ano", *resolve.WEEKDAYS]
MULTI_DOUBT = "varios eventos en una publicación, leída por un modelo ligero: confirma horas y precios"
SINGLE_DAY_DOUBT, NO_DETAILS = "un solo día: ¿faltan fechas?", "no details"


def is_serious(doubt: Column) -> Column:
    """Whether a doubt is about the day, the city, a cancellation or several events read at once."""
    folded = text.fold(doubt)
    about = F.arrays_overlap(text.words(folded), F.array(*map(F.lit, [*DAY_WORDS, "bogota", *PARTICIPLES])))
    return about | F.contains(folded, text.fold(F.lit(MULTI_DOUBT)))


def review_reasons(confidence: Column, doubts: Column, event_type: Column, end_date: Column, twin: Column) -> Column:
    """An event's reasons: a possible twin's title, its doubts if it isn't sure or one is serious, and a gathering of one day."""
    held = F.coalesce(doubts, F.array().cast("array<string>"))
    unsure = ~confidence.eqNullSafe("high") | F.coalesce(F.exists(held, is_serious), F.lit(False))
    none = F.array().cast("array<string>")
    return F.concat(
        F.when(twin.isNotNull(), F.array(F.concat(F.lit("¿el mismo evento que «"), twin, F.lit("»?")))).otherwise(none),
        F.when(unsure & (F.size(held) > 0), held).when(unsure, F.array(F.lit(NO_DETAILS))).otherwise(none),
        F.when(event_type.isin(*GATHERINGS) & end_date.isNull(), F.array(F.lit(SINGLE_DAY_DOUBT))).otherwise(none),
    )


def to_review(events: DataFrame, twins: DataFrame, today: Column) -> DataFrame:
    """events that haven't ended and have reasons, with these; twins: (id, twin), a title at most for an event."""
    found = events.where(F.coalesce("end_date", "date") >= today).join(twins.select("id", "twin"), "id", "left")
    reasons = review_reasons(F.col("confidence"), F.col("doubts"), F.col("event_type"), F.col("end_date"), F.col("twin"))
    return found.select(*events.columns, reasons.alias("reasons")).where(F.size("reasons") > 0)
