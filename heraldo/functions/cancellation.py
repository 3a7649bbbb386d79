"""Whether a text says that an event is off, with column functions only.

A text is read line by line, each line as tokens: words, numbers and marks. Its sentences are looked at where one of
OFF begins. Such a place counts unless it is denied, means that something is paid ("cancelar" is also "to pay"), or stands
under a condition; a sentence that asks doesn't count at all. Null and empty texts don't say it.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

from heraldo.functions.text import fold

# Words and phrases, folded, by which Spanish and English announcements say it.
STEMS = "cancel aplaz pospon pospu suspend reprogram posterg postpon realizar llevar".split()
PARTICIPLES = [s + e for s, e in product("cancelad aplazad pospuest suspendid reprogramad postergad".split(), "o a os as".split())] + ["canceled", "cancelled", "postponed"]
PAYS = [f"se {v}" for v in "cancela cancelan cancelo cancelaron".split()]
IMPERSONAL = [f"se {s}{e}" for s, e in product("aplaz reprogram posterg".split(), "a an o aron".split())] + [f"se {v}" for v in "pospone posponen pospuso pospusieron suspende suspenden suspendio suspendieron".split()]
OURS = "cancelamos aplazamos posponemos pospusimos suspendemos suspendimos reprogramamos postergamos".split()
FORCED = [f"{lead}{that} {verb}" for lead, that, verb in product(["tuvimos", "tenemos", "debemos", "decidimos", "hemos decidido", "nos toca", "nos toco", "nos vemos obligados a", "nos vimos obligados a"], ["", " que"], "cancelar aplazar posponer suspender reprogramar postergar".split())]
WONT = ["no se realizara", "no se llevara a cabo"]
AUXILIARIES = ["", *(f"{a} " for a in ("esta", "estan", "fue", "fueron", "ha sido", "han sido", "sera", "seran", "lo", "la", "los", "las", "se"))]
PRICE_WORDS = "cover valor precio costo boleta tiquete inversion aporte bono donacion entrada inscripcion matricula cuota pago mensualidad reserva saldo abono".split()
UNITS = ["k", "mil", "cop", "pesos", "%"]
ARTICLES = "el la los las un una a al solo solamente unicamente".split()
HOW_PAID = (
    [f"en {x}" for x in ("efectivo", "la puerta", "puerta", "taquilla", "la entrada", "caja", "el lugar")] + [f"con {x}" for x in ("tarjeta", "efectivo", "nequi", "daviplata", "transferencia", "anticipacion")]
    + [f"al {x}" for x in ("ingresar", "llegar", "entrar", "ingreso", "momento")] + [f"por {x}" for x in ("nequi", "daviplata", "transferencia", "pse", "tarjeta", "bancolombia", "adelantado")]
    + ["antes de", "antes del", "el mismo dia", "directamente"]
)
INSTALMENTS = "una dos tres cuatro cinco seis siete ocho nueve diez once doce varias".split()
DAY_PAID, NOT_PAID = ["el dia de", "el dia del"], ["hoy", "manana"]
#: How far before "se cancela", in characters, a price still tells that it is paid.
PRICE_REACH = 30
OFF = PARTICIPLES + PAYS + IMPERSONAL + OURS + WONT + FORCED
_DENIABLE = set(PARTICIPLES + PAYS + IMPERSONAL + OURS)

_TOKEN = r"\$?\p{N}+(?:\.\p{N}+)*k?|[\p{L}\p{N}_]+|[%.,;:!?¿]"
_PAD = 4


def _listed(words: list[str]) -> Column:
    return F.array(*map(F.lit, words))


def _opens(rest: Column, phrases: list[str]) -> Column:
    """Whether text that ends in a space begins with one of the phrases, as whole words."""
    return F.exists(_listed([f"{p} " for p in phrases]), lambda p: F.startswith(rest, p))


def _closes(text: Column, phrases: list[str]) -> Column:
    return F.exists(_listed(phrases), lambda p: F.endswith(text, p))


def _is_price(word: Column, following: Column) -> Column:
    """A price's word, or an amount of money."""
    number = lambda x: (x != "") & (F.translate(x, "0123456789.", "") == "")
    amount = F.startswith(word, F.lit("$")) | (number(word) & (F.contains(word, F.lit(".")) | following.isin(UNITS))) | (F.endswith(word, F.lit("k")) & number(F.rtrim(word, F.lit("k"))))
    return word.isin(PRICE_WORDS) | F.rtrim(word, F.lit("s")).isin(PRICE_WORDS) | amount


def _is_off(sentence: Column) -> Column:
    words = F.concat(F.array_repeat(F.lit(""), _PAD), F.split(sentence, " "))
    count = F.size(words)
    word = lambda i: F.coalesce(F.try_element_at(words, i), F.lit(""))
    between = lambda i, j: F.array_join(F.slice(words, i, F.greatest(j - i, F.lit(0))), " ")  # noqa: E731  from i up to before j

    def paid(i: Column, rest: Column) -> Column:
        """Of "se cancela" at i: whether it is a price that is paid."""
        later = F.slice(words, i + 2, count)
        behind = F.concat(F.array_join(later, " "), F.lit(" "))
        skipped = i + 2 + F.size(later) - F.size(F.filter(later, lambda w, k: F.exists(F.slice(later, 1, k + 1), lambda x: ~x.isin(ARTICLES))))
        price_next = _is_price(word(skipped), word(skipped + 1))
        on_a_day = F.exists(_listed([f"{p} " for p in DAY_PAID]), lambda p: F.startswith(behind, p) & ~F.split_part(F.replace(behind, p, F.lit("")), F.lit(" "), F.lit(1)).isin(NOT_PAID))
        told = lambda j: _is_price(word(j), word(j + 1)) & ~F.contains(between(j, i), F.lit(":")) & (F.length(between(j + 1, i)) <= PRICE_REACH)
        price_before = F.exists(F.sequence(F.greatest(i - 16, F.lit(1)), i - 1), told)
        already = (word(i - 1) == "ya") & _opens(rest, PAYS[2:])
        parts = [F.coalesce(F.try_element_at(later, F.lit(n)), F.lit("")) for n in (1, 2, 3)]
        instalments = (parts[0] == "en") & (parts[1].isin(INSTALMENTS) | parts[1].rlike(r"^\p{N}+$")) & parts[2].isin("cuotas", "cuota")
        return already | price_before | price_next | on_a_day | instalments | _opens(behind, HOW_PAID)

    def stated(i: Column) -> Column:
        rest = F.concat(F.array_join(F.slice(words, i, 8), " "), F.lit(" "))
        before = F.concat(F.lit(" "), between(F.lit(1), i), F.lit(" "))
        clause = F.substring_index(F.substring_index(F.concat(F.lit(" "), F.array_join(F.slice(words, i, count), " "), F.lit(" ")), ",", 1), ";", 1)
        denied = _opens(rest, sorted(_DENIABLE)) & _closes(before, [f" {no} {a}" for no in ("no", "ni") for a in AUXILIARIES])
        free = lambda text, unless: ~F.contains(F.replace(F.replace(text, F.lit(" si bien "), F.lit(" ")), F.lit(unless), F.lit(" ")), F.lit(" si ")) & ~F.contains(text, F.lit(" en caso de "))
        return _opens(rest, OFF) & ~denied & free(before, " si , ") & free(clause, " si bien ") & ~(_opens(rest, PAYS) & paid(i, rest))

    return ~sentence.rlike("[?¿]") & F.exists(F.sequence(F.lit(_PAD + 1), count), stated)


def sentences(line: Column) -> Column:
    """A line's sentences, folded, as tokens with one space between them."""
    tokens = F.array_join(F.regexp_extract_all(fold(line), F.lit(_TOKEN), F.lit(0)), " ")
    return F.split(tokens, r"(?<=[.!?]) | (?=¿)")


def says_cancelled(text: Column) -> Column:
    """Whether a text says it, sentence by sentence; only lines and sentences with one of STEMS are taken apart."""
    hint = "|".join(STEMS)
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), r"\R"), lambda line: line.rlike(rf"(?i){hint}"))
    return F.exists(F.filter(F.flatten(F.transform(lines, sentences)), lambda s: s.rlike(hint)), _is_off)
