"""Events put together from the readings of their posts, in the order they were read, and rules on single readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heraldo.functions import text
from heraldo.operators import sessions as series
from heraldo.operators.announcements import MAX_DAYS, UPDATABLE

#: What a post about a single day can't change in an event over several.
RANGE_FIELDS = ("weekday", "start_time", "end_time")
# Places that announcements elsewhere name, folded, and what names where a style, guest or song is from.
OTHER_PLACES = (
    "medellin,cali,barranquilla,cartagena,bucaramanga,manizales,armenia,villavicencio,ibague,tunja,santa marta,cucuta,neiva,popayan,monteria,"
    "sincelejo,valledupar,riohacha,quibdo,envigado,rionegro,mexico,cdmx,miami,madrid,barcelona,lima,quito,guayaquil,panama,caracas,santiago de chile,buenos aires"
).split(",")
ORIGINS = "estilo,style,desde,llega de,viene de,sabor".split(",")
SONGS, HOME = ["cali pachanguero"], "bogota"
CURRENCIES = "usd mxn eur euro euros gbp dolar dolares dollar dollars clp ars brl reales libras".split()
PESOS_OF = "mexicano mexicanos argentino argentinos chileno chilenos dominicano dominicanos cubano cubanos uruguayo uruguayos".split()
# A dancers' social, its other names, and words that make "social" something else.
SOCIAL, SOCIALS = "social sociale socials sociales".split(), "milonga milongas practica practicas".split()
OTHER_SOCIALS = "redes red club eventos causa obra labor proyecto impacto responsabilidad".split()
FREE = ["gratis", "gratuito", "gratuita", "gratuitos", "gratuitas", "libre", "free", "sin costo", "sin cover", "no cover", "cortesia"]


def _days(first: Column, last: Column, own: Column) -> Column:
    return F.when(F.size(own) > 0, F.transform(own, lambda s: s["date"])).when(first.isNotNull(), F.sequence(first, F.greatest(first, F.coalesce(last, first))))


def absorbed(s: Column, p: Column, kept: list[str]) -> dict[str, Column]:
    """The fields of an event (s) after one more post or event (p) of it; both are structs of `seen` and `kept`, days first."""
    newest = p["seen"] >= s["seen"]
    mine, whole = _days(s["date"], s["end_date"], s["sessions"]), _days(p["date"], p["end_date"], p["sessions"])
    one_day = F.coalesce(s["end_date"].isNotNull() & p["end_date"].isNull() & F.array_contains(mine, p["date"]), F.lit(False))
    taken = p["date"].isNotNull() & ~one_day & (newest | s["date"].isNull())
    has = lambda x: F.coalesce(F.size(x["sessions"]) > 0, F.lit(False))
    completes = ~taken & ~one_day & has(p) & ~has(s) & s["end_date"].isNull() & F.coalesce(F.array_contains(whole, s["date"]), F.lit(False))
    extends = ~taken & ~one_day & ~completes & s["end_date"].isNull() & p["end_date"].isNotNull() & ~has(p) & (p["date"] == s["date"])
    days = taken | completes
    out = {f: F.when(days, p[f]).otherwise(s[f]) for f in ("date", "sessions")}
    out["end_date"] = F.when(days | F.coalesce(extends, F.lit(False)), p["end_date"]).otherwise(s["end_date"])
    opening = F.try_element_at(p["sessions"], F.lit(1))
    for f in kept[3:]:
        new = F.when(p[f].isNull() | (one_day if f in RANGE_FIELDS else F.lit(False)), s[f]).when(s[f].isNull() | (newest if f in UPDATABLE else F.lit(False)), p[f]).otherwise(s[f])
        if f in ("start_time", "end_time"):
            new = F.when(completes, F.coalesce(opening[f], s[f])).otherwise(new)
        out[f] = F.when(completes, p[f]).otherwise(new) if f == "weekday" else new
    length = F.datediff(out["end_date"], out["date"]) + 1
    sound = F.when(F.size(out["sessions"]) > 0, F.size(series.series_problems(out["sessions"], out["date"], out["end_date"])) == 0).otherwise(out["end_date"].isNull() | length.between(2, MAX_DAYS))
    for f in ("end_date", "sessions"):
        out[f] = F.when(F.coalesce(sound, F.lit(False)), out[f])
    return out


def merged_in_order(posts: DataFrame, key: str, order: str, published: str, fields: list[str]) -> DataFrame:
    """(key, fields): each event's posts folded in order; posts also have date, end_date (days) and sessions.

    The newest published post's days, times and prices win, the first known value of everything else. First and last day and
    sessions go together. A post about one day of an event over several leaves its days and times; an older one only
    completes what is missing: the series of a session, the last day of the same first day. A range that is none is dropped.

    An event's posts are folded in one row: they are a handful.
    """
    kept = ["date", "end_date", "sessions", *[f for f in fields if f not in ("date", "end_date", "sessions")]]
    kinds = {f: posts.schema[f].dataType.simpleString() for f in kept}
    log = posts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.col(published).alias("seen"), *kept))).alias("log"))

    def state(values: dict[str, Column], seen: Column) -> Column:
        return F.struct(seen.alias("seen"), *[values[f].cast(kinds[f]).alias(f) for f in kept])

    first = F.element_at("log", 1)
    step = lambda s, p: state(absorbed(s, p, kept), F.greatest(s["seen"], p["seen"]))
    folded = F.aggregate(F.slice("log", 2, F.size("log")), state({f: first[f] for f in kept}, first["seen"]), step)
    return log.select(key, folded.alias("folded_posts")).select(key, *[F.col("folded_posts")[f].alias(f) for f in dict.fromkeys([*fields, "date", "end_date", "sessions"])])


def _spaced(value: Column) -> Column:
    return F.concat(F.lit(" "), F.array_join(text.words(text.fold(F.coalesce(value, F.lit("")))), " "), F.lit(" "))


def _holds(spaced: Column, phrases: list[str]) -> Column:
    return F.exists(F.array(*[F.lit(f" {p} ") for p in phrases]), lambda p: F.contains(spaced, p))


def city(in_bogota: Column, address: Column, caption: Column) -> Column:
    """in_bogota, or "unknown" for a sure event without an address whose caption names another city and never its own."""
    said = F.regexp_replace(_spaced(caption), f" (?:{'|'.join(SONGS)})(?= )", "")
    elsewhere = F.regexp_replace(said, f" (?:{'|'.join(ORIGINS)}) (?:{'|'.join(OTHER_PLACES)})(?= )", "")
    doubtful = (in_bogota == "yes") & (F.coalesce(address, F.lit("")) == "") & ~F.contains(said, F.lit(HOME)) & _holds(elsewhere, OTHER_PLACES)
    return F.when(doubtful, "unknown").otherwise(in_bogota)


def kind_at_a_bar(event_type: Column, said: Column) -> Column:
    """A bar's night that was read as a social is a party, unless its text announces one by any of its names.

    The word doesn't announce one as part of a bar's name or of another thing: after OTHER_SOCIALS, or before "club".
    """
    ws = text.words(text.fold(F.coalesce(said, F.lit(""))))
    beside = lambda ws, w, i: ~F.coalesce(F.get(ws, i - 1), F.lit("")).isin(OTHER_SOCIALS) & (F.coalesce(F.get(ws, i + 1), F.lit("")) != "club")
    named = lambda ws: F.exists(F.transform(ws, lambda w, i: w.isin(SOCIALS) | (w.isin(SOCIAL) & beside(ws, w, i))), lambda x: x)
    announced = F.exists(F.array(ws), named)
    return F.when((event_type == "social") & ~announced, "party").otherwise(event_type)


def _foreign(price: Column) -> Column:
    """Whether a price of nothing is an amount in another currency."""
    written = F.concat_ws(" ", price["label"], price["condition"])
    words = _spaced(written)
    named = F.exists(F.filter(F.split(F.btrim(words), " "), lambda w: w != ""), lambda w: F.regexp_replace(w, r"^\p{N}+", "").isin(CURRENCIES))
    signed = written.rlike("[€£]") | F.exists(F.array(*map(F.lit, ("us$", "u$", "mx$"))), lambda m: F.contains(F.lower(written), m))
    return (price["amount_cop"] == 0) & written.rlike(r"\d") & (named | signed | _holds(words, [f"{p} {o}" for p in ("peso", "pesos") for o in PESOS_OF])) & ~_holds(words, FREE)


def clean_prices(prices: Column) -> Column:
    """struct(prices, doubts): prices (label, amount_cop, condition) that can be shown; those in another currency become doubts."""
    known = F.filter(prices, lambda p: (p["amount_cop"] >= 0) & (F.btrim(p["label"]) != ""))
    plain = lambda x: F.btrim(F.regexp_replace(F.coalesce(x, F.lit("")), r"\s+", " "))
    told = lambda p: F.concat(F.lit("Precio en otra moneda: "), plain(p["label"]), F.when(plain(p["condition"]) != "", F.concat(F.lit(" ("), plain(p["condition"]), F.lit(")"))).otherwise(""))
    return F.struct(F.filter(known, lambda p: ~_foreign(p)).alias("prices"), F.transform(F.filter(known, _foreign), told).alias("doubts"))
