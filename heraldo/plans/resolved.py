"""Registered queries of days worked out of text, date labels and what is known already, over rows derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heraldo.functions import labels, resolve
from heraldo.functions.mentions import mentions
from heraldo.operators import consistency, reconcile
from heraldo.sources.tables import table

TODAY = "1997-01-01"
STYLES = {"widget": "widget", "cold widget": "widget frio", "bolt": "bolt", "small": "talla", "large": "talla", "gear": "gear"}


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate")).withColumn("k", F.col("o_orderkey"))


def _name(names: list[str], i: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), i.cast("int"))


def resolved_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is printed of an order's day, some parts left out, some weekdays wrong, read five days later."""
    k, day = F.col("k"), F.col("day")
    weekday = F.when(k % 4 > 0, F.pmod(F.weekday(day) + F.when(k % 9 == 0, 1).otherwise(0), F.lit(7)))
    relative = F.when(k % 17 == 0, "hoy").when(k % 17 == 1, "mañana")
    end = F.date_add(day, (k % 9).cast("int"))
    ends = F.when(k % 6 < 2, F.dayofmonth(end)), F.when(k % 6 == 1, F.month(end))
    found = resolve.resolved_date(weekday, F.when(k % 3 > 0, F.dayofmonth(day)), F.when(k % 2 > 0, F.month(day)), F.lit(None).cast("int"), relative, k % 5 == 0, F.date_add(day, 5), F.lit(TODAY).cast("date"), *ends)
    return _orders(spark, sf_dir).select("o_orderkey", found.alias("f")).select("o_orderkey", "f.date", "f.last", F.array_join("f.notes", "; ").alias("notes"))


def resolved_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders of a year as a series' sessions, every third without its month, the first of some without any."""
    printed = F.struct("day", F.when(F.col("k") % 3 > 0, F.month("day")).alias("month"), F.dayofmonth("day").alias("at"))
    held = _orders(spark, sf_dir).groupBy("o_custkey", F.year("day").alias("year")).agg(F.array_sort(F.collect_list(printed)).alias("s")).where(F.size("s") > 1)
    c, first = F.col("o_custkey"), F.element_at("s", 1)["day"]
    sessions = F.transform("s", lambda x: F.struct(x["month"].alias("month"), x["at"].alias("day")))
    whole = lambda of, value: F.when(c % of == 0, value)
    found = resolve.resolved_series(sessions, whole(2, F.month(first)), whole(5, F.col("year")), whole(3, F.weekday(first)), F.date_add(first, (c % 90 - 30).cast("int")))
    out = held.select("o_custkey", "year", found.alias("f"))
    return out.select("o_custkey", "year", F.array_join(F.transform("f.days", lambda d: d.cast("string")), ",").alias("days"), F.array_join(F.transform("f.places", lambda p: p.cast("string")), ",").alias("places"), F.array_join("f.notes", "; ").alias("notes"))


def clock_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event's moment said in six ways: a start, a clock time, an end, a span of two hours, a part of the day, an address."""
    k, h = F.col("event_id") % 6, F.hour("ts")
    end = (h + 2) % 24
    dial = lambda x: ((x + 11) % 12 + 1).cast("string")
    half = lambda x: F.when(x < 12, " a. m.").otherwise("PM")
    minutes = F.date_format("ts", "mm")
    part = F.when(h < 12, " de la mañana").when(h < 19, " de la tarde").otherwise(" de la noche")
    said = (
        F.when(k == 0, F.concat(F.lit("Desde las "), dial(h), F.lit(":"), minutes, half(h))).when(k == 1, F.concat(F.lit("Baile\n"), F.date_format("ts", "HH:mm")))
        .when(k == 2, F.concat(F.lit("Abierto hasta las "), dial(h), half(h))).when(k == 3, F.concat(F.lit("De "), dial(h), F.lit(" a "), dial(end), half(end)))
        .when(k == 4, F.concat(dial(h), part)).otherwise(F.concat(F.lit("Calle "), h.cast("string"), F.lit(" #"), minutes, F.lit("-20, $10.000")))
    )
    found = table(spark, sf_dir, "events").select("event_id", mentions(said).alias("m"))
    return found.select("event_id", F.array_join("m.starts", ",").alias("starts"), F.array_join("m.times", ",").alias("times"))


def consistency_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as readings of eight kinds of announcements, every third of them misread, some without the day of the post."""
    k, day, misread = F.col("k"), F.col("day"), F.col("k") % 3 == 0
    date = lambda d: F.concat_ws(" ", F.dayofmonth(d).cast("string"), F.lit("de"), _name(resolve.MONTHS, F.month(d)))
    name, month = _name(labels.WEEKDAYS, F.weekday(day) + 1), F.trunc(day, "month")
    kind = k % 8
    said = (
        F.when(kind == 0, F.concat(F.lit("Nos vemos el "), date(day))).when(kind == 1, "Clase 8 pm").when(kind == 2, F.concat(F.lit("Del "), date(day), F.lit(" al "), date(F.date_add(day, 3)))).when(kind == 3, "6 pm, 7 pm y 9 pm")
        .when(kind == 4, F.concat(F.lit("5, 15 y 25 de "), _name(resolve.MONTHS, F.month(day)))).when(kind == 5, F.concat(F.upper(name), F.lit(" "), date(day))).when(kind == 6, F.concat(F.lit("Este "), name, F.lit(" los esperamos"))).otherwise("Gracias")
    )
    published = F.when(k % 10 < 9, F.when(kind == 4, F.date_sub(month, 1)).when(kind == 6, F.date_sub(day, 3)).otherwise(F.date_sub(day, 10)))
    held = F.when(misread & kind.isin(5, 6), F.date_add(day, 1)).when(misread & (kind == 7), F.date_sub(day, 20)).when(kind == 4, F.date_add(month, 24)).otherwise(day)
    sessions = F.when(~misread & (kind == 4), F.array(*[F.struct(F.date_add(month, n).alias("date")) for n in (4, 14, 24)]))
    event = F.struct(
        held.alias("date"), F.when(~misread & (kind == 2), F.date_add(day, 3)).alias("end_date"), F.when(~(misread & (kind == 1)), "20:00").alias("start_time"),
        F.when(misread, "workshop").otherwise("social").alias("event_type"), F.lit(False).alias("is_recurring"), sessions.alias("sessions"),
    )
    readings = _orders(spark, sf_dir).select("o_orderkey", said.alias("caption"), published.alias("published"), F.when(misread & (kind == 0), F.array().cast(f"array<{consistency.EVENT}>")).otherwise(F.array(event)).alias("events"))
    return consistency.flagged(readings).select("o_orderkey", F.array_join("flags", ", ").alias("flags"))


def weekday_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order's day said in a sentence, as a date with or without a month, a deadline, an hour or a wrong weekday, three weeks before."""
    k, day = F.col("k"), F.col("day")
    weekday = _name(resolve.WEEKDAYS, F.weekday(F.date_add(day, F.when(k % 7 == 0, 1).otherwise(0))) + 1)
    said = F.concat_ws(" ", F.when(k % 5 == 0, "Preventa hasta el").otherwise("Nos vemos el"), F.upper(weekday), F.dayofmonth(day).cast("string"), F.when(k % 3 > 0, F.concat(F.lit("de "), _name(resolve.MONTHS, F.month(day)))), F.when(k % 11 == 0, "de la noche"), F.lit("\nbaile y música"))
    days = resolve.weekday_dates(said, F.date_sub(day, 21))
    return _orders(spark, sf_dir).select("o_orderkey", F.array_join(F.transform(days, lambda d: d.cast("string")), ",").alias("days"))


def relative_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, day = F.col("k"), F.col("day")
    weekday = _name(labels.WEEKDAYS, k % 7 + 1)
    said = F.when(k % 5 == 0, F.lit("Este finde")).when(k % 5 == 1, F.concat(F.lit("el próximo "), weekday)).when(k % 5 == 2, F.concat(F.lit("fue el "), weekday, F.lit(" pasado"))).otherwise(F.concat(F.lit("Este "), weekday, F.when(k % 2 == 0, " 6 pm").otherwise(" 6")))
    days = F.transform(resolve.relative_days(said, day), lambda x: F.array_join(F.transform(x, lambda d: d.cast("string")), "|"))
    return _orders(spark, sf_dir).select("o_orderkey", F.array_join(days, ",").alias("days"))


def date_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.when(F.col("k") % 3 > 0, F.date_add(F.col("day"), (F.col("k") % 40).cast("int")))
    return _orders(spark, sf_dir).select("o_orderkey", labels.dates_label(F.col("day"), last).alias("span"), labels.day_label(F.col("day")).alias("first"))


def clock_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(labels.clock_label(F.col("ts")).alias("at")).agg(F.count("*").alias("n"))


def session_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = _orders(spark, sf_dir).groupBy("o_custkey").agg(F.array_sort(F.collect_set("day")).alias("days")).where(F.size("days") > 1)
    return held.select("o_custkey", labels.sessions_label(F.col("days")).alias("label"))


def styles_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve.styles_in_text(F.concat_ws(" ", "p_name", F.lit("y"), F.lower("p_type")), STYLES, ("widget",), ("small",))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(found, ",").alias("styles"))


def repeats_earlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders as readings of one batch; filled ones were matched."""
    kind = F.when(F.col("k") % 4 == 0, "festival").when(F.col("k") % 4 == 1, "party").otherwise("class")
    days = F.sequence("day", F.date_add(F.col("day"), (F.col("k") % 60).cast("int")))
    orders = _orders(spark, sf_dir)
    readings = orders.select(F.col("o_custkey").alias("batch"), F.col("k").alias("pos"), F.col("k").alias("id"), kind.alias("event_type"), days.alias("days"))
    return reconcile.repeats_earlier(readings, orders.where("o_orderstatus = 'F'").select(F.col("k").alias("id")))


def one_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = F.concat(F.when(F.col("k") % 3 > 0, "page-").otherwise(""), F.format_string("%012d", "k"))
    code = F.concat_ws("-", F.col("o_custkey").cast("string"), F.month("day").cast("string"))
    return reconcile.one_identity(_orders(spark, sf_dir).select(made.alias("id"), code.alias("code")), "id", "code", "page-")


def requests_used(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = F.when(F.col("k") % 4 == 0, F.array("k")).when(F.col("k") % 4 == 1, F.array("o_custkey", F.month("day").cast("long")))
    return reconcile.requests_used(_orders(spark, sf_dir), batch, F.col("k") % 10 == 3)


def _accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    status = F.when(key % 3 == 0, "personal").otherwise("business")
    return table(spark, sf_dir, "customer").select("c_custkey", key.alias("position"), status.alias("status"), labels.dance_score(F.lower("c_mktsegment"), ["o", "build", "auto"]).alias("hint"), F.when(key % 5 > 0, F.col("c_mktsegment")).alias("kind"), F.when(key % 4 > 0, F.date_sub(F.lit(TODAY).cast("date"), (key % 30).cast("int"))).alias("checked_on"))


def discovery_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.discovery_totals(_accounts(spark, sf_dir))


def recheck_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.recheck_due(_accounts(spark, sf_dir), F.lit(TODAY).cast("date")).select("c_custkey", F.col("hint").cast("long").alias("hint"))


QUERIES = {f.__name__: f for f in (resolved_dates, resolved_series, clock_times, consistency_flags, weekday_dates, relative_days, date_labels, clock_labels, session_labels, styles_in_text, repeats_earlier, one_identity, requests_used, discovery_totals, recheck_due)}

_O = "o AS (SELECT o_orderkey, o_orderkey AS k, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day FROM orders)"
_M = "['ene', 'feb', 'mar', 'abr', 'may', 'jun', 'jul', 'ago', 'sep', 'oct', 'nov', 'dic']"
_D = "['lunes', 'martes', 'miercoles', 'jueves', 'viernes', 'sabado', 'domingo']"
_W = "['lunes', 'martes', 'miércoles', 'jueves', 'viernes', 'sábado', 'domingo']"
_WHOLE = lambda d: f"day({d}) || ' ' || {_M}[month({d})] || ' ' || year({d})"
_STATUS = "CASE WHEN c_custkey % 3 = 0 THEN 'personal' ELSE 'business' END"
_HINT = "CAST(contains(lower(c_mktsegment), 'o') AS BIGINT) + CAST(contains(lower(c_mktsegment), 'build') AS BIGINT) + CAST(contains(lower(c_mktsegment), 'auto') AS BIGINT)"
ORACLE_SQL = {
    "resolved_dates": f"""
WITH {_O}, p AS (SELECT o_orderkey, CASE WHEN k % 4 > 0 THEN (isodow(day) - 1 + CASE WHEN k % 9 = 0 THEN 1 ELSE 0 END) % 7 END AS w, CASE WHEN k % 3 > 0 THEN day(day) END AS d, CASE WHEN k % 2 > 0 THEN month(day) END AS m, k % 17 AS r, k % 5 = 0 AS weekly, day + 5 AS t,
  CASE WHEN k % 6 < 2 THEN day(day + CAST(k % 9 AS INTEGER)) END AS ed, CASE WHEN k % 6 = 1 THEN month(day + CAST(k % 9 AS INTEGER)) END AS em FROM o),
c AS (SELECT *, list_filter([TRY_CAST(format('{{:04d}}-{{:02d}}-{{:02d}}', y, m, d) AS DATE) for y in [year(t), year(t) + 1]], lambda x: x IS NOT NULL) AS ds,
  list_filter([TRY_CAST(format('{{:04d}}-{{:02d}}-{{:02d}}', year(q), month(q), d) AS DATE) for q in [CAST(date_trunc('month', t - 7) AS DATE) + to_months(i) for i in range(13)]], lambda x: x IS NOT NULL AND x >= t - 7) AS nx, CASE WHEN weekly THEN greatest(t, DATE '{TODAY}') ELSE t END AS b FROM p),
s AS (SELECT *, CASE WHEN r = 0 THEN t WHEN r = 1 THEN t + 1
  WHEN d IS NOT NULL AND m IS NOT NULL THEN coalesce(list_filter(ds, lambda x: x >= t - 7 AND isodow(x) - 1 = w)[1], list_filter(ds, lambda x: x >= t - 7)[1], ds[-1])
  WHEN d IS NOT NULL THEN coalesce(list_filter(nx, lambda x: isodow(x) - 1 = w)[1], nx[1]) ELSE b + CAST((w - isodow(b) + 8) % 7 AS INTEGER) END AS date FROM c),
l AS (SELECT *, TRY_CAST(format('{{:04d}}-{{:02d}}-{{:02d}}', year(date), coalesce(em, month(date)), ed) AS DATE) AS near,
  TRY_CAST(CASE WHEN em IS NULL THEN format('{{:04d}}-{{:02d}}-{{:02d}}', year(date + INTERVAL 1 MONTH), month(date + INTERVAL 1 MONTH), ed) ELSE format('{{:04d}}-{{:02d}}-{{:02d}}', year(date) + 1, em, ed) END AS DATE) AS later FROM s),
e AS (SELECT *, CASE WHEN near >= date THEN near WHEN near < date THEN later END AS last FROM l)
SELECT o_orderkey, date, CASE WHEN last - date BETWEEN 1 AND 6 THEN last END AS last, CASE WHEN date IS NULL THEN '' ELSE concat_ws('; ', CASE WHEN r > 1 AND d IS NOT NULL AND m IS NULL THEN 'mes deducido' END, CASE WHEN r > 1 AND d IS NULL AND w IS NOT NULL THEN 'fecha deducida del día de la semana' END,
  CASE WHEN w <> isodow(date) - 1 THEN 'dice ' || {_W}[w + 1] || ', pero esa fecha es ' || {_W}[isodow(date)] END, CASE WHEN r > 1 AND d IS NOT NULL AND m IS NOT NULL THEN 'año deducido' END, CASE WHEN weekly THEN 'semanal: publiqué la próxima fecha' END, CASE WHEN date - t > 60 THEN 'más de 60 días adelante: revisar' END) END AS notes FROM e""",
    "resolved_series": f"""
WITH RECURSIVE {_O}, p AS (SELECT o_custkey AS c, year(day) AS year, row_number() OVER g - 1 AS place, count(*) OVER (PARTITION BY o_custkey, year(day)) AS n, CASE WHEN k % 3 > 0 THEN month(day) END AS m, day(day) AS d, first_value(day) OVER g AS f FROM o WINDOW g AS (PARTITION BY o_custkey, year(day) ORDER BY day, CASE WHEN k % 3 > 0 THEN month(day) END NULLS FIRST)),
h AS (SELECT DISTINCT c, year, n, CASE WHEN c % 2 = 0 THEN month(f) END AS em, CASE WHEN c % 5 = 0 THEN year END AS ey, CASE WHEN c % 3 = 0 THEN isodow(f) - 1 END AS w, f + CAST(c % 90 - 30 AS INTEGER) AS t FROM p WHERE n > 1),
a AS (SELECT c, year, n, em, t, 0 AS next, CAST([] AS BIGINT[]) AS ms, CAST([] AS BIGINT[]) AS ds, CAST([] AS BIGINT[]) AS ps FROM h
  UNION ALL SELECT c, year, n, em, t, next + 1, CASE WHEN keep THEN list_append(ms, own) ELSE ms END, CASE WHEN keep THEN list_append(ds, d) ELSE ds END, CASE WHEN keep THEN list_append(ps, next) ELSE ps END
  FROM (SELECT *, NOT coalesce(own = ms[-1] AND d = ds[-1], false) AS keep FROM (SELECT a.*, p.d, coalesce(p.m, CASE WHEN p.d <= ds[-1] THEN ms[-1] % 12 + 1 ELSE ms[-1] END, em, month(t)) AS own FROM a JOIN p ON p.c = a.c AND p.year = a.year AND p.place = a.next))),
k AS (SELECT a.*, h.ey, h.w FROM a JOIN h ON h.c = a.c AND h.year = a.year WHERE a.next = a.n AND len(ms) > 1),
y AS (SELECT *, unnest(CASE WHEN ey IS NOT NULL THEN [ey] ELSE [year(t) - 1, year(t), year(t) + 1] END) AS fy FROM k),
b AS (SELECT c, year, fy, ms, ds, 0 AS pos, CAST([] AS DATE[]) AS days FROM y UNION ALL SELECT c, year, fy, ms, ds, pos + 1, list_append(days, found) FROM (SELECT *, CASE WHEN pos = 0 THEN TRY_CAST(format('{{:04d}}-{{:02d}}-{{:02d}}', fy, ms[1], ds[1]) AS DATE) ELSE coalesce(
    CASE WHEN TRY_CAST(format('{{:04d}}-{{:02d}}-{{:02d}}', year(days[-1]), ms[pos + 1], ds[pos + 1]) AS DATE) > days[-1] THEN TRY_CAST(format('{{:04d}}-{{:02d}}-{{:02d}}', year(days[-1]), ms[pos + 1], ds[pos + 1]) AS DATE) END, TRY_CAST(format('{{:04d}}-{{:02d}}-{{:02d}}', year(days[-1]) + 1, ms[pos + 1], ds[pos + 1]) AS DATE)) END AS found FROM b WHERE pos < len(ms)) WHERE found IS NOT NULL),
r AS (SELECT b.c, b.year, b.days, k.ps, k.em, k.ey, k.w, k.t, row_number() OVER (PARTITION BY b.c, b.year ORDER BY b.days[-1] >= k.t DESC, CASE WHEN b.days[-1] >= k.t THEN coalesce(len(list_filter(b.days, lambda x: isodow(x) - 1 = k.w)) = len(b.days), false) END DESC, CASE WHEN b.days[-1] >= k.t THEN fy ELSE -fy END) AS best
  FROM b JOIN k ON k.c = b.c AND k.year = b.year WHERE b.pos = len(b.ms)),
q AS (SELECT r.*, list_filter(days, lambda x: isodow(x) - 1 <> w)[1] AS off, p.m AS fm FROM r JOIN p ON p.c = r.c AND p.year = r.year AND p.place = r.ps[1] WHERE best = 1)
SELECT h.c AS o_custkey, h.year, array_to_string([CAST(x AS VARCHAR) for x in days], ',') AS days, array_to_string([CAST(x AS VARCHAR) for x in ps], ',') AS places, CASE WHEN days IS NOT NULL THEN concat_ws('; ', CASE WHEN q.em IS NULL AND fm IS NULL THEN 'mes deducido' END, CASE WHEN q.ey IS NULL THEN 'año deducido' END,
  CASE WHEN off IS NOT NULL THEN 'dice ' || {_W}[q.w + 1] || ', pero el ' || day(off) || ' es ' || {_W}[isodow(off)] END, CASE WHEN days[1] - q.t > 60 THEN 'más de 60 días adelante: revisar' END) END AS notes FROM h LEFT JOIN q ON q.c = h.c AND q.year = h.year""",
    "clock_times": """
WITH e AS (SELECT event_id, event_id % 6 AS k, hour(ts) AS h, (hour(ts) + 2) % 24 AS e, strftime(ts, '%H:%M') AS said, minute(ts) = 59 AS last FROM events),
d AS (SELECT *, (h + 11) % 12 + 1 AS dh, (e + 11) % 12 + 1 AS de, format('{:02d}:00', h) AS whole FROM e),
s AS (SELECT *, CASE WHEN e < 12 AND dh > de THEN dh % 12 + 12 WHEN dh <= de THEN dh % 12 + CASE WHEN e < 12 THEN 0 ELSE 12 END ELSE dh END AS begins FROM d)
SELECT event_id, CASE WHEN k < 2 AND NOT last THEN said WHEN k = 3 THEN format('{:02d}:00', begins) WHEN k = 4 THEN whole ELSE '' END AS starts,
  CASE WHEN k < 2 AND NOT last THEN said WHEN k IN (2, 4) THEN whole WHEN k = 3 THEN array_to_string(list_sort(list_distinct([format('{:02d}:00', begins), format('{:02d}:00', e)])), ',') ELSE '' END AS times FROM s""",
    "consistency_flags": f"""
WITH {_O} SELECT o_orderkey, CASE WHEN k % 3 > 0 THEN '' ELSE CASE k % 8 WHEN 0 THEN 'fechas sin evento' WHEN 1 THEN 'hora sin leer' WHEN 2 THEN 'rango como un día' WHEN 3 THEN 'más horas que eventos' WHEN 4 THEN 'lista de fechas sin leer'
  ELSE CASE WHEN k % 10 = 9 THEN '' ELSE CASE k % 8 WHEN 5 THEN 'día sin evento' WHEN 6 THEN 'día relativo sin evento' ELSE 'antes de la publicación' END END END END AS flags FROM o""",
    "weekday_dates": f"""
WITH {_O}, p AS (SELECT *, day - 21 AS p, (isodow(day) - 1 + CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END) % 7 AS w FROM o),
c AS (SELECT *, CASE WHEN k % 3 > 0 THEN [make_date(year(p) + CASE WHEN month(day) < month(p) - 1 THEN 1 ELSE 0 END, month(day), day(day))] ELSE list_filter([p + CAST(i AS INTEGER) for i in range(62)], lambda x: day(x) = day(day)) END AS cs FROM p)
SELECT o_orderkey, coalesce(CASE WHEN k % 5 > 0 AND NOT (k % 3 = 0 AND k % 11 = 0) THEN CAST(list_filter(cs, lambda x: isodow(x) - 1 = w AND x >= p)[1] AS VARCHAR) END, '') AS days FROM c""",
    "relative_days": f"""
WITH {_O}, f AS (SELECT *, day + CAST((k % 7 - isodow(day) + 8) % 7 AS INTEGER) AS a, day + CAST((11 - isodow(day) + 1) % 7 - 1 AS INTEGER) - 0 AS t FROM o)
SELECT o_orderkey, CASE k % 5 WHEN 0 THEN concat_ws('|', t, t + 1, t + 2, t + 3) WHEN 1 THEN concat_ws('|', a, a + 7) WHEN 2 THEN '' ELSE CASE WHEN k % 2 = 0 THEN CAST(a AS VARCHAR) ELSE '' END END AS days FROM f""",
    "date_labels": f"""
WITH {_O}, s AS (SELECT *, CASE WHEN k % 3 > 0 THEN day + CAST(k % 40 AS INTEGER) END AS e FROM o)
SELECT o_orderkey, CASE WHEN e IS NULL OR e <= day THEN CAST(day AS VARCHAR) WHEN year(day) <> year(e) THEN {_WHOLE("day")} || ' – ' || {_WHOLE("e")} WHEN month(day) <> month(e) THEN day(day) || ' ' || {_M}[month(day)] || ' – ' || {_WHOLE("e")}
  ELSE day(day) || '–' || {_WHOLE("e")} END AS span, ['lunes', 'martes', 'miércoles', 'jueves', 'viernes', 'sábado', 'domingo'][isodow(day)] || ' ' || {_WHOLE("day")} AS first FROM s""",
    "clock_labels": "SELECT CAST((hour(ts) + 11) % 12 + 1 AS VARCHAR) || strftime(ts, ':%M') || CASE WHEN hour(ts) < 12 THEN ' a. m.' ELSE ' p. m.' END AS at, count(*) AS n FROM events GROUP BY 1",
    "session_labels": f"""
WITH o AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders), l AS (SELECT *, lead(day) OVER w AS n, count(*) OVER c AS c, max(year(day)) OVER c > min(year(day)) OVER c AS two FROM o WINDOW w AS (PARTITION BY o_custkey ORDER BY day), c AS (PARTITION BY o_custkey)),
p AS (SELECT *, concat_ws(' ', day(day), CASE WHEN n IS NULL OR date_trunc('month', n) <> date_trunc('month', day) THEN {_M}[month(day)] || CASE WHEN two THEN ' ' || year(day) ELSE '' END END) AS part FROM l WHERE c > 1)
SELECT o_custkey, any_value(c) || ' sesiones: ' || string_agg(part, ', ' ORDER BY day) FILTER (n IS NOT NULL) || ' y ' || any_value(part) FILTER (n IS NULL) AS label FROM p GROUP BY 1""",
    "styles_in_text": """
WITH f AS (SELECT p_partkey, regexp_extract_all(p_name || ' y ' || lower(p_type), '\\b(cold widget|widget|large|bolt|gear)\\b') AS m FROM part),
s AS (SELECT p_partkey, [CASE x WHEN 'cold widget' THEN 'widget frio' WHEN 'large' THEN 'talla' ELSE x END for x in m] AS s FROM f), u AS (SELECT p_partkey, list_filter(s, lambda x, i: list_position(s, x) = i) AS s FROM s)
SELECT p_partkey, coalesce(array_to_string(list_filter(s, lambda x: NOT (x = 'widget' AND list_contains(s, 'widget frio'))), ','), '') AS styles FROM u""",
    "repeats_earlier": f"""
WITH {_O}, s AS (SELECT *, day + CAST(k % 60 AS INTEGER) AS e, CASE WHEN k % 4 = 0 THEN 1 WHEN k % 4 = 1 AND k % 60 = 0 THEN 2 ELSE 0 END AS kind FROM o)
SELECT DISTINCT b.o_custkey AS batch, b.k AS pos, b.k AS id FROM s a JOIN s b ON a.o_custkey = b.o_custkey AND a.k < b.k AND a.day <= b.e AND b.day <= a.e WHERE b.o_orderstatus <> 'F' AND a.kind + b.kind <> 3""",
    "one_identity": f"""
WITH {_O}, i AS (SELECT CASE WHEN k % 3 > 0 THEN 'page-' ELSE '' END || format('{{:012d}}', k) AS id, o_custkey || '-' || month(day) AS code FROM o), b AS (SELECT code, coalesce(min(id) FILTER (NOT starts_with(id, 'page-')), min(id)) AS new FROM i GROUP BY 1)
SELECT id AS old, new FROM i JOIN b USING (code) WHERE id <> new""",
    "requests_used": f"""
WITH {_O}, c AS (SELECT count(DISTINCT CASE WHEN k % 4 = 1 THEN (o_custkey || '/' || month(day)) END) AS shared, count(*) FILTER (k % 4 = 0 OR k % 10 = 3) AS single FROM o) SELECT shared + single AS used, shared, single FROM c""",
    "discovery_totals": f"""
WITH a AS (SELECT {_STATUS} AS s, {_HINT} AS h, c_custkey % 5 = 0 AS open FROM customer)
SELECT count(*) AS checked, count(*) FILTER (s = 'personal') AS personal, count(*) FILTER (s = 'business') AS business, count(*) FILTER (s = 'business' AND h = 0) AS no_hint, count(*) FILTER (s = 'business' AND h > 0 AND open) AS pending FROM a""",
    "recheck_due": f"SELECT c_custkey, {_HINT} AS hint FROM customer WHERE c_custkey % 3 = 0 AND (c_custkey % 4 = 0 OR c_custkey % 30 >= 14) ORDER BY 2 DESC, 1",
}
