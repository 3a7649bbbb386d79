"""Announced events: normalising what was read of them, and finding the stored event that a new one is.

Events have title, account, event_type, styles, venue, organizer, contact, date and end_date (days), start_time, and
sessions (array of date, start_time, end_time) of a series. Pairs come from an equi-join on the days both take place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heraldo.functions import dates, text
from heraldo.operators import matching, state

MAX_DAYS = 7
CITY_DOUBT = "ciudad sin confirmar: ¿es en Bogotá?"
GATHERINGS, NIGHTS = ("congress", "festival"), ("social", "party")
# The kinds of event that a title's words name.
KIND_WORDS = {
    "night": "social sociales fiesta fiestas party rumba rumbas milonga milongas concierto conciertos recital",
    "class": "taller talleres clase clases workshop workshops masterclass master curso",
    "practice": "practica practicas",
    "competition": "competencia competition campeonato concurso batalla battle torneo",
    "show": "show gala muestra",
}
#: Fields whose newest value wins when posts of one event are merged; of the others the first known one stays.
UPDATABLE = ("date", "end_date", "weekday", "start_time", "end_time", "prices")


def normalized(events: DataFrame, synonyms: dict[str, str]) -> DataFrame:
    """Events with text dates and times parsed, clean title, styles and contact; what can't be right becomes a doubt.

    Null fields stay null; doubts keep their order: those read first, then time, last day and city.
    """
    first, last = text.iso_date(F.col("date")), text.iso_date(F.col("end_date"))
    start, end = text.clock(F.col("start_time")), text.clock(F.col("end_time"))
    length = F.datediff(last, first) + 1
    doubts = F.array_compact(F.array(
        F.when((F.col("start_time") != "") & start.isNull(), F.concat(F.lit("Hora de inicio no reconocida: "), F.col("start_time"))),
        F.when(length < 1, "fecha final anterior a la inicial").when(length > MAX_DAYS, "dura más de una semana: revisar fechas"),
        F.when((F.col("in_bogota") == "unknown") & ~F.array_contains(F.coalesce("doubts", F.array().cast("array<string>")), CITY_DOUBT), CITY_DOUBT),
    ))
    return events.withColumns({
        "title": F.btrim(F.regexp_replace("title", r"\s+", " ")), "date": first, "end_date": F.when((length > 1) & (length <= MAX_DAYS), last), "start_time": start, "end_time": end,
        "styles": text.normal_styles(F.col("styles"), synonyms, ("salsa", "bachata")), "contact": text.contact(F.col("contact")), "doubts": F.concat(F.coalesce("doubts", F.array().cast("array<string>")), doubts),
    })


def unpublishable(recurring: Column, date: Column, in_bogota: Column) -> Column:
    """Why an event isn't published: an array, empty if it is."""
    return F.array_compact(F.array(F.when(recurring, "recurrente"), F.when(date.isNull(), "sin fecha"), F.when(in_bogota == "no", "fuera de Bogotá")))


def prepared(events: DataFrame, prefix: str) -> DataFrame:
    """Events with what matching compares, computed once a row; all columns are prefixed."""
    t = text.fold(F.col("title"))
    kinds = F.array_compact(F.array(*[F.when(F.arrays_overlap(text.words(F.col("t")), F.array(*map(F.lit, w.split()))), F.lit(k)) for k, w in KIND_WORDS.items()]))
    name = lambda c: text.key(text.fold(F.coalesce(c, F.lit(""))))
    series = F.coalesce(F.size("sessions") > 0, F.lit(False))
    out = events.withColumn("t", t).withColumns({"w": text.title_words(F.col("t")), "wa": text.title_words(F.col("t"), True), "kinds": kinds, "v": name(F.col("venue")), "series": series})
    out = out.withColumns({"multi": F.col("end_date").isNotNull() | series, "days": dates.days_of(F.col("date"), F.col("end_date"), F.col("sessions")), "handle": name(F.col("account"))})
    out = out.withColumn("names", F.array(*[name(F.col(c)) for c in ("organizer", "venue", "contact")]))
    return out.select(*[F.col(c).alias(f"{prefix}_{c}") for c in out.columns])


def _c(side: str | Column, field: str) -> Column:
    """A field of one side of a pair: a prefixed column, or a field of a struct."""
    return F.col(f"{side}_{field}") if isinstance(side, str) else side[field]


def _both(a: str | Column, b: str | Column, field: str) -> Column:
    """Whether both sides have it."""
    known = lambda x: F.coalesce(_c(x, field) != "", F.lit(False))
    return known(a) & known(b)


def night_apart(a: str | Column = "a", b: str | Column = "b") -> Column:
    """A congress or festival and a one-day night are never one event."""
    apart = lambda x, y: _c(x, "event_type").isin(*GATHERINGS) & _c(y, "event_type").isin(*NIGHTS) & ~_c(y, "multi")
    return F.coalesce(apart(a, b) | apart(b, a), F.lit(False))


def same_title(a: str | Column = "a", b: str | Column = "b") -> Column:
    """The same title, or the shorter one's words all in the longer one, which adds no kind of event; kinds and venues don't clash."""
    wa, wb = _c(a, "w"), _c(b, "w")
    added = F.when(F.size(wa) <= F.size(wb), F.array_except(wb, wa)).otherwise(F.array_except(wa, wb))
    inside = (F.least(F.size(wa), F.size(wb)) > 0) & (F.size(F.array_intersect(wa, wb)) == F.least(F.size(wa), F.size(wb)))
    clash = (_both(a, b, "v") & (_c(a, "v") != _c(b, "v"))) | ((F.size(_c(a, "kinds")) > 0) & (F.size(_c(b, "kinds")) > 0) & ~F.arrays_overlap(_c(a, "kinds"), _c(b, "kinds")))
    return (_c(a, "t") == _c(b, "t")) | (inside & ~clash & ~F.arrays_overlap(added, F.array(*map(F.lit, text.EVENT_WORDS))))


def _titles_meet(a: str | Column = "a", b: str | Column = "b") -> Column:
    return (_c(a, "t") == _c(b, "t")) | matching.shares_title(_c(a, "w"), _c(b, "w"))


def _clock_of(sessions: Column, day: Column) -> Column:
    return F.try_element_at(F.filter(sessions, lambda s: s["date"] == day), F.lit(1))["start_time"]


def same_series(a: str | Column = "a", b: str | Column = "b") -> Column:
    """Two series that share half of the shorter one's sessions, with no other start on a shared day, and whose titles meet."""
    shared = F.array_intersect(_c(a, "days"), _c(b, "days"))
    clash = F.exists(shared, lambda d: F.coalesce(_clock_of(_c(a, "sessions"), d) != _clock_of(_c(b, "sessions"), d), F.lit(False)))
    return (2 * F.size(shared) >= F.least(F.size(_c(a, "days")), F.size(_c(b, "days")))) & ~clash & _titles_meet(a, b)


def session_of(series: str | Column, other: str | Column) -> Column:
    """A one-day post on a session's day, without another start: same title, a shared word, or same venue and start."""
    at, start = _clock_of(_c(series, "sessions"), _c(other, "date")), _c(other, "start_time")
    same_time = F.coalesce(at == start, F.lit(False))
    titled = (_c(series, "t") == _c(other, "t")) | F.arrays_overlap(_c(series, "w"), _c(other, "w"))
    return ~_c(other, "multi") & (same_time | at.isNull() | start.isNull()) & (titled | (_both(series, other, "v") & (_c(series, "v") == _c(other, "v")) & same_time))


def same_event(a: str | Column = "a", b: str | Column = "b") -> Column:
    """Whether two events of one account that share a day are one."""
    found = (
        F.when(_c(a, "series") & _c(b, "series"), same_series(a, b)).when(_c(a, "series"), session_of(a, b)).when(_c(b, "series"), session_of(b, a))
        .when(_c(a, "multi") | _c(b, "multi"), _titles_meet(a, b)).when(_both(a, b, "start_time"), _c(a, "start_time") == _c(b, "start_time")).otherwise(same_title(a, b))
    )
    return (_c(a, "account") == _c(b, "account")) & ~night_apart(a, b) & found


def _title_names(event: str, other: str) -> Column:
    """Whether an event's title names the other's account: in one word, or in two or three in a row."""
    handle, every = _c(other, "handle"), text.words(_c(event, "t"))
    one = F.exists(_c(event, "wa"), lambda w: (F.length(w) >= 5) & handle.startswith(w))

    def runs(n: int) -> Column:
        joined = F.transform(F.sequence(F.lit(1), F.greatest(F.size(every) - (n - 1), F.lit(1))), lambda i: F.array_join(F.slice(every, i, n), ""))
        return F.exists(joined, lambda run: (F.length(run) >= 8) & handle.startswith(run))

    return one | runs(2) | runs(3)


def _names(event: str, other: str) -> Column:
    handle = _c(other, "handle")
    return F.exists(_c(event, "names"), lambda n: (F.length(n) >= 5) & (handle.startswith(n) | n.startswith(handle))) | _title_names(event, other)


def shared_event() -> Column:
    """Whether two accounts' events that share a day are one: one names the other's account, or the venue and more agree."""
    one_day = ~_c("a", "multi") & ~_c("b", "multi")
    venues = _both("a", "b", "v")
    same_time = one_day & _both("a", "b", "start_time") & (_c("a", "start_time") == _c("b", "start_time"))
    late = one_day & _both("a", "b", "start_time") & (_c("a", "start_time") != _c("b", "start_time"))
    elsewhere = venues & ~_c("a", "v").contains(_c("b", "v")) & ~_c("b", "v").contains(_c("a", "v"))
    shared = F.array_intersect(_c("a", "w"), _c("b", "w"))
    some = F.size(shared) > 0
    named = same_time | some | (one_day & venues & (_title_names("a", "b") | _title_names("b", "a")))
    titles = matching.shares_title(_c("a", "wa"), _c("b", "wa")) | (matching.shares_title(_c("a", "w"), _c("b", "w")) & (F.size(F.array_except(shared, F.array(*map(F.lit, text.EVENT_WORDS)))) > 0))
    found = F.when(_names("a", "b") | _names("b", "a"), named).otherwise(venues & ((same_time & some) | titles))
    return (_c("a", "account") != _c("b", "account")) & ~night_apart() & ~late & ~elsewhere & found


def day_pairs(stored: DataFrame, candidates: DataFrame) -> DataFrame:
    """Prepared pairs (a_: stored, b_: candidate) that share a day. Both need an `id`."""
    a, b = prepared(stored, "a"), prepared(candidates, "b")
    days = lambda x, side: x.select(f"{side}_id", F.explode(f"{side}_days").alias("day"))
    pairs = days(a, "a").join(days(b, "b"), "day").select("a_id", "b_id").distinct()
    return pairs.join(a, "a_id").join(b, "b_id")


def find_existing(stored: DataFrame, candidates: DataFrame) -> DataFrame:
    """(b_id, rule, a_pos, a_id): the stored event each candidate is, by the first rule that finds one; the rest have no row.

    stored: id, pos, posts (array of post ids) and an event; candidates: id, post_id, same_as, announced (array of ids) and
    an event. Rules: 1 an explicit link, 2 same account, 3 the one event its post announced before, 4 another account's.
    """
    pairs = day_pairs(stored, candidates).where(~F.array_contains("a_posts", F.col("b_post_id")))
    own = (_c("a", "account") == _c("b", "account")) & ~night_apart()
    before = F.coalesce(F.array_contains("b_announced", F.col("a_id")), F.lit(False)) & own
    ruled = pairs.select("b_id", "a_id", "a_pos", F.coalesce((F.col("b_same_as") == F.col("a_id")) & own, F.lit(False)).alias("linked"), F.coalesce(same_event(), F.lit(False)).alias("same"), before.alias("before"), F.coalesce(shared_event(), F.lit(False)).alias("shared"))
    one = ruled.where("before").groupBy("b_id").agg(F.count("*").alias("n")).where("n = 1").select("b_id", F.lit(True).alias("one"))
    rule = F.when(F.col("linked"), 1).when(F.col("same"), 2).when(F.col("before") & F.col("one"), 3).when(F.col("shared"), 4)
    found = ruled.join(one, "b_id", "left").select("b_id", "a_id", "a_pos", rule.alias("rule")).where("rule is not null")
    return matching.by_priority(found, "b_id", ["rule", "a_pos"])


def not_hidden(candidates: DataFrame, hidden: DataFrame) -> DataFrame:
    """The candidates that no event taken down by hand matches."""
    pairs = day_pairs(hidden, candidates)
    again = F.array_contains("a_posts", F.col("b_post_id")) & ((_c("a", "t") == _c("b", "t")) | same_event())
    linked = (F.col("b_same_as") == F.col("a_id")) & (_c("a", "account") == _c("b", "account")) & ~night_apart()
    matched = pairs.where(F.coalesce(again, F.lit(False)) | F.coalesce(linked, F.lit(False)) | F.coalesce(same_event() | shared_event(), F.lit(False)))
    return candidates.join(matched.select(F.col("b_id").alias("id")), "id", "left_anti")


def merged(posts: DataFrame, key: str, published: str, fields: list[str]) -> DataFrame:
    """One row per event from its posts' readings: of UPDATABLE fields the newest known value, of others the first known.

    First and last day come from one post, the newest with a first day. A grouped aggregate, combined before the shuffle: the
    outcome of merging one-day posts in order of publication; merging.merged_in_order has the rules for longer events.
    """
    pick = lambda f: state.newest_known if f in UPDATABLE else state.first_known
    days = [f for f in ("date", "end_date") if f in fields] if "date" in fields else []
    found = [pick(f)(F.col(f), F.col(published)).alias(f) for f in fields if f not in days]
    if days:
        found.append(F.max_by(F.struct(*days), F.when(F.col("date").isNotNull(), F.col(published))).alias("days"))
    out = posts.groupBy(key).agg(*found)
    return out.select(key, *[F.col("days")[f].alias(f) if f in days else F.col(f) for f in fields])
