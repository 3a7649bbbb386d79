"""A bar's nights, and what is paid and not called off."""

from pyspark.sql import functions as F

from heraldo.functions.cancellation import says_cancelled
from heraldo.operators import merging


def over(spark, texts, f):
    return [r[0] for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i").select(f(F.col("t"))).collect()]


def test_a_bars_night_is_a_party_unless_it_announces_a_social(spark):
    socials = ["Gran social de salsa", "SOCIALES cada viernes", "Milonga del martes", "Práctica libre de tango", "Redes: @bar. Hoy social", "prácticas y milongas"]
    parties = ["Noche de son", None, "", "Búscanos en redes sociales", "Hoy en Club Social El Patio", "Buena Social Club invita", "Eventos sociales y empresariales", "una obra social del barrio", "Red social: bar_x", "antisocial"]
    kind = lambda t: merging.kind_at_a_bar(F.lit("social"), t)
    assert over(spark, socials + parties, kind) == ["social"] * len(socials) + ["party"] * len(parties)
    assert over(spark, ["x", None], lambda t: merging.kind_at_a_bar(F.lit("concert"), t)) == ["concert", "concert"]


def test_instalments_are_paid(spark):
    paid = ["Se cancela en cuatro cuotas", "El curso se cancela en 6 cuotas", "se cancela en una cuota, sin recargo"]
    off = ["Se cancela en toda la ciudad", "Se cancela la función de hoy", "Queda cancelado el taller"]
    assert over(spark, paid + off, says_cancelled) == [False] * len(paid) + [True] * len(off)
