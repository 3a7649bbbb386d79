"""Column functions on text: folding, words, slugs, links, styles and what an announcement says."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _plain(char: str) -> str:
    """A character decomposed for compatibility, without marks, in lower case."""
    return "".join(c for c in unicodedata.normalize("NFKD", char).casefold() if not unicodedata.combining(c))


#: Letters and digits that stand for one of ASCII, and those that stand for several, from Unicode's own tables.
_FOLDED = {c: p for c in map(chr, [*range(0x80, 0x2C00), *range(0xA640, 0xD800), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800), *range(0x1F100, 0x1F200)]) if (p := _plain(c)) != c and p.isascii() and p.isalnum()}
_SINGLE = {c: p for c, p in _FOLDED.items() if len(p) == 1}
_SEVERAL = {c: p for c, p in _FOLDED.items() if len(p) > 1 and c in "ßﬀﬁﬂﬃﬄﬅﬆĳǆǉǌ"}

# Words that every title shares, and kinds and occasions of events.
COMMON_WORDS = (
    "social sociales clase clases taller talleres workshop fiesta noche baile bailes evento dance gran "
    "bachata salsa kizomba zouk tango merengue champeta cumbia urbano urbana sensual dominicana calena "
    "los las del con por para una uno the and nuestro nuestra este esta bogota colombia cali medellin"
).split()
EVENT_WORDS = (
    "congress congreso festival fest party parties fiestas halloween navidad navideno navidena aniversario anniversary "
    "internacional international edicion edition tour night nights noches workshops master masterclass masterclasses "
    "intensivo intensive bootcamp competencia competition campeonato championship concurso batalla battle encuentro gala "
    "show especial special weekend cumpleanos fin ano nuevo clausura lanzamiento inauguracion retiro"
).split()

# How posts spell WhatsApp.
WHATSAPP = "whatsapp whats wpp wsp wa wasap wassap guasap".split()


def fold(text: Column) -> Column:
    """Lower case without marks, spaces collapsed, JVM-side; letters of other blocks that look like Latin ones are Latin.

    fold_any also takes apart what stands for several characters, ligatures aside.
    """
    plain = F.lower(text)
    for char, several in _SEVERAL.items():
        plain = F.replace(plain, F.lit(char), F.lit(several))
    plain = F.translate(plain, "".join(_SINGLE), "".join(_SINGLE.values()))
    return F.btrim(F.regexp_replace(F.regexp_replace(plain, r"\p{M}+", ""), r"\s+", " "))


@F.pandas_udf(StringType())
def fold_any(text: pd.Series) -> pd.Series:
    """fold() with compatibility decomposition: also letters from other blocks that look like Latin ones."""
    bare = lambda s: " ".join("".join(c for c in unicodedata.normalize("NFKD", s).casefold() if not unicodedata.combining(c)).split())
    return text.map(bare, na_action="ignore")


def words(folded: Column) -> Column:
    """The runs of letters and digits of folded text."""
    return F.filter(F.split(folded, r"[^\p{L}\p{N}]+"), lambda w: w != "")


def title_words(folded: Column, across_accounts: bool = False) -> Column:
    """A title's distinctive words: three letters or more, no digit, no word that every title shares."""
    ignored = COMMON_WORDS + (EVENT_WORDS if across_accounts else [])
    own = F.filter(words(folded), lambda w: (F.length(w) >= 3) & ~w.rlike(r"\p{N}"))
    return F.array_except(F.array_distinct(own), F.array(*map(F.lit, ignored)))


def key(folded: Column) -> Column:
    """Letters and digits only."""
    return F.regexp_replace(folded, r"[^\p{L}\p{N}]", "")


def slug(text: Column, most: int = 50) -> Column:
    """ASCII words joined by hyphens, cut at a word's end when longer than `most`."""
    whole = F.regexp_replace(F.regexp_replace(fold(text), "[^a-z0-9]+", "-"), "^-|-$", "")
    head = F.substring(whole, 1, most + 1)
    cut = F.when(head.contains("-"), F.regexp_extract(head, "^(.*)-[^-]*$", 1)).otherwise(F.substring(whole, 1, most))
    return F.when(F.length(whole) <= most, whole).otherwise(cut)


def post_code(link: Column) -> Column:
    """The code in a link to a post; null if it is none."""
    return F.nullif(F.regexp_extract(link, r"/(?:p|reels?|tv)/([A-Za-z0-9_-]+)", 1), F.lit(""))


def redact(text: Column) -> Column:
    """Text with the values of token parameters masked."""
    return F.regexp_replace(text, r"((?:access_)?token=)[^&\s]+", "$1***")


def break_mentions(text: Column) -> Column:
    """Text whose @names no longer mention anyone: an invisible joiner follows the sign."""
    return F.regexp_replace(text, r"@(?=[\w-])", "@⁠")


def iso_date(text: Column) -> Column:
    """A real calendar date written as year-month-day, else null."""
    return F.when(F.trim(text).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(F.trim(text), F.lit("yyyy-MM-dd")).cast("date"))


def clock(text: Column) -> Column:
    """HH:MM of a valid 24-hour time such as 9:05, else null."""
    hour, minute = (F.regexp_extract(F.trim(text), r"^(\d{1,2}):(\d{2})$", i) for i in (1, 2))
    return F.when((hour.try_cast("int") < 24) & (minute.try_cast("int") < 60), F.concat_ws(":", F.lpad(hour, 2, "0"), minute))


def normal_styles(styles: Column, synonyms: dict[str, str], families: tuple[str, ...], other: str = "otro") -> Column:
    """Known names of styles, each once in order; a family's own name goes if a variant of it is there."""
    named = F.create_map(*[F.lit(x) for pair in synonyms.items() for x in pair])
    known = F.array_distinct(F.filter(F.transform(styles, lambda s: F.when(fold(s) != "", F.coalesce(F.try_element_at(named, fold(s)), F.lit(other)))), lambda s: s.isNotNull()))
    is_general = lambda s: s.isin(*families) & F.exists(known, lambda v: v.startswith(F.concat(s, F.lit(" "))))
    return F.filter(known, lambda s: ~is_general(s))


def contact(text: Column) -> Column:
    """A contact that can be linked: a handle, a web site, or a number of seven digits or more, marked if it is WhatsApp."""
    plain = F.btrim(F.regexp_replace(text, r"\s+", " "))
    handle = F.startswith(plain, F.lit("@")) & F.length(plain).between(2, 31) & ~F.substring(plain, 2, 40).rlike(r"[^\w.]")
    scheme = F.exists(F.array(F.lit("http://"), F.lit("https://")), lambda s: F.startswith(F.lower(plain), s))
    address = F.when(scheme, F.substring_index(plain, "://", -1)).otherwise(plain)
    labels = F.split(F.split_part(address, F.lit("/"), F.lit(1)), r"\.", -1)
    site = ~plain.contains(" ") & (F.size(labels) > 1) & ~F.exists(labels, lambda x: (x == "") | x.rlike(r"[^\w-]"))
    number = F.btrim(F.regexp_replace(F.regexp_replace(plain, "[^0-9+() -]", ""), " +", " "))
    enough = F.length(F.regexp_replace(plain, "[^0-9]", "")) >= 7
    is_whatsapp = F.arrays_overlap(words(fold(plain)), F.array(*map(F.lit, WHATSAPP)))
    return F.when(handle | site, plain).when(enough & is_whatsapp, F.concat(F.lit("WhatsApp "), number)).when(enough, number)


def html_text(html: Column) -> Column:
    """A page's visible text: scripts, styles and tags out, the common entities decoded, spaces collapsed."""
    bare = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</(script|style)>", " "), r"<[^>]*>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(char))
    return F.btrim(F.regexp_replace(bare, r"[ \t\r\n]+", " "))
