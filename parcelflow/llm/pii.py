"""Personal data replaced by keyed surrogates, with DataFrame functions only.

One regular expression finds the entities of a text. Each is replaced by a
surrogate of its own type, drawn from a keyed hash of its canonical form:

* format: separators, letter case, digit groups, lengths, address octets and
  the check digit of card numbers are kept;
* gender and script: a name after a male or female title gets a name of that
  gender in the same script;
* coreference: the canonical form (case, spaces and separators dropped) decides,
  so every mention of an entity, in any format and any document, gets the same
  surrogate; family names are treated apart from first names, so a short
  mention still matches a full one;
* distinctness: the distinct entities' surrogates are checked over the whole
  corpus. Of those that share one, and where a surrogate is itself an entity
  that occurs, all but the first draw again until no two agree. Only these
  few redrawn entities are joined back to the documents.

Defined results: null and empty texts stay as they are with no entity; repeated
rows are treated alike; extra columns are carried through; an empty table gives
an empty result. Working columns start with ``_p_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, stored, table, text_of

# Titles by gender, and the syllables names are made of, by script.
MALE = ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία"]
SYLLABLES = {
    "latin": ["bal", "cor", "dan", "fel", "gar", "hol", "jan", "kel", "lam", "mor", "nor", "pel", "ras", "sol", "tam", "ver"],
    "cyrillic": ["бал", "вар", "гор", "дан", "зим", "кел", "лам", "мор", "нор", "пел", "рас", "сол", "там", "фел", "хол", "шам"],
    "greek": ["βαλ", "γαρ", "δαν", "ζημ", "θελ", "καλ", "λαμ", "μορ", "νορ", "παλ", "ρασ", "σολ", "ταμ", "φελ", "χολ", "ψαρ"],
}
ENDINGS = {"latin": ("o", "a"), "cyrillic": ("", "а"), "greek": ("ος", "α")}

TITLES = rf"(?=[{''.join(sorted({x[0] for x in MALE + FEMALE}))}])(?:{'|'.join(MALE + FEMALE)})"
# A secret's keyword in any letter case and the sign, each perhaps with a quote and blanks around.
SECRET_KEY = r"(?=[pstaPSTA])(?i:password|passwd|secret|token|api_key|apikey)[\"']?+[ \t]*+[=:][ \t]*+[\"']?+"

# A word of a name: letters of any case after a capital, with hyphens before a
# capital and apostrophes within; a possessive 's is not part of it.
NAME_WORD = r"\p{Lu}(?:\p{L}|['’](?!s(?!\p{L}))(?=\p{L})|-(?=\p{Lu}))++"

# Entity patterns, in the order in which they are tried at one place. Each
# begins with a test of one character, so most places fail at once. Secrets and
# keys, names and local parts have no longest length; their repeats are possessive, so a long one is
# read once.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]{1,63}(?:\.[\p{L}\p{N}-]{1,63}){1,8}",
    "access_key": r"AKIA(?<![A-Za-z0-9]AKIA)[0-9A-Z]{16}(?![A-Za-z0-9])",
    "hex_key": r"(?<![0-9A-Za-z])[0-9a-f]{32,}+(?![0-9A-Za-z])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)",
    "phone": r"(?<![\w+])(?:(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d.])(?:\d{13,19}|(?:\d{4}[ -]){3}\d{4})(?!\d)",
    "name": rf"{TITLES}(?<!\p{{L}}(?:{'|'.join(MALE + FEMALE)}))\.? {NAME_WORD}(?: {NAME_WORD})*+",
}
# A secret is the keyword, the sign and the value: what stands before white
# space, a quote, a comma or a semicolon. A value that is as a whole an entity
# of another kind is left to that kind; one without a letter or digit is a mask.
_OTHER = "|".join(f"(?:{p})" for k, p in PATTERNS.items() if k != "hex_key")
PATTERNS["secret"] = rf"{SECRET_KEY}(?!(?:{_OTHER})[.!?)\]]*+(?:[\s\"',;]|$))(?=[^\s\"',;\p{{L}}\p{{N}}]*+[\p{{L}}\p{{N}}])[^\s\"',;]{{4,}}+"
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Texts without any of these hold no entity; a cheap test before ``ANY``.
HINT = rf"[@0-9]|AKIA|{TITLES}\.? \p{{Lu}}|[a-f]{{32}}|{SECRET_KEY}"
MAX_DRAWS = 40


# ---- one entity -------------------------------------------------------------

def entities(text: Column) -> Column:
    """The entities of a text in order."""
    t = text_of(text)
    return F.when(t.rlike(HINT), F.regexp_extract_all(t, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def kind(value: Column) -> Column:
    """Type of an entity found by ``ANY``."""
    out = None
    shapes = {"secret": rf"^{SECRET_KEY}", "email": "@", "name": rf"^(?:{'|'.join(MALE + FEMALE)})\.? \p{{Lu}}", "access_key": "^AKIA[0-9A-Z]{16}$",
              "ip": r"^\d{1,3}(?:\.\d{1,3}){3}$", "ssn": r"^\d{3}-\d{2}-\d{4}$", "card": r"^(?:\d{13,19}|(?:\d{4}[ -]){3}\d{4})$",
              "iban": r"^[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?$", "phone": r"^[+(\d][\d() .-]+$", "hex_key": "^[0-9a-f]{32,}$"}
    for k, p in shapes.items():
        out = (F.when if out is None else out.when)(value.rlike(p), F.lit(k))
    return out.otherwise(F.lit("secret"))


def _part(type_: Column | str, canonical: Column) -> Column:
    return F.struct((F.lit(type_) if isinstance(type_, str) else type_).alias("type"), canonical.alias("canonical"))


def _first_type(value: Column) -> Column:
    return F.when(value.rlike(rf"^(?:{'|'.join(FEMALE)})\b"), F.lit("first_f")).otherwise(F.lit("first_m"))


def _name_words(value: Column) -> Column:
    """Words of a name without its title."""
    w = F.split(value, " ")
    return F.slice(w, 2, F.size(w) - 1)


def parts(value: Column) -> Column:
    """Canonical parts of an entity: array of struct(type, canonical)."""
    w = F.split(value, " ")
    k = kind(value)
    # The last word is the family name, those before it are given names.
    name = F.transform(_name_words(value), lambda x, i: _part(F.when(i == F.size(w) - 2, F.lit("family")).otherwise(_first_type(value)), F.lower(x)))
    plain = (F.when(k.isin("phone", "card", "ssn"), F.regexp_replace(value, "[^0-9]", ""))
             .when(k == "iban", F.regexp_replace(value, " ", "")).when(k == "email", F.lower(value))
             .when(k == "secret", F.regexp_replace(value, f"^{SECRET_KEY}", "")).otherwise(value))
    # A key of hex digits is one entity, with or without a keyword before it.
    type_ = F.when((k == "secret") & plain.rlike("^[0-9a-f]{32,}$"), F.lit("hex_key")).otherwise(k)
    return F.when(k == "name", name).otherwise(F.array(_part(type_, plain)))


def _draw(key: str, type_: Column, canonical: Column, draw: Column) -> Column:
    """128 hex digits that depend on the key, the entity and the draw."""
    seed = lambda n: F.sha2(F.concat_ws("\u0000", F.lit(key), type_, canonical, draw.cast("string"), F.lit(str(n))), 256)
    return F.concat(seed(0), seed(1))


def _number(digits: Column, i: Column, width: int = 4) -> Column:
    """The ``i``-th number below 16 ** width of the hex digits."""
    at = F.pmod(i, F.lit(128 // width)) * width + 1
    return F.conv(F.substring(digits, at.cast("int"), F.lit(width)), 16, 10).cast("int")


def _pick(alphabet: str, n: Column) -> Column:
    return F.substring(F.lit(alphabet), (F.pmod(n, F.lit(len(alphabet))) + 1).cast("int"), F.lit(1))


def _letterwise(canonical: Column, digits: Column, keep: Column) -> Column:
    """Each letter or digit after the first ``keep`` characters becomes one of
    its own class; a value of hex digits stays one."""
    chars = F.regexp_extract_all(canonical, F.lit("(?s)."), F.lit(0))
    hexes = canonical.rlike("^[0-9a-f]+$")

    def one(c: Column, i: Column) -> Column:
        n = _number(digits, i)
        return (F.when(i < keep, c).when(c.rlike("[0-9]"), _pick("0123456789", n))
                .when(hexes, _pick("abcdef", n)).when(c.rlike("[a-z]"), _pick(LOWER, n)).when(c.rlike("[A-Z]"), _pick(UPPER, n))
                .when(c.rlike(r"\p{IsCyrillic}"), _pick("абвгдежзиклмнопрстуфхцчшэюя", n)).when(c.rlike(r"\p{IsGreek}"), _pick("αβγδεζηθικλμνξοπρστυφχψω", n))
                .when(c.rlike(r"\p{L}"), _pick(LOWER, n)).otherwise(c))

    return F.array_join(F.transform(chars, one), "")


def _luhn(number: Column) -> Column:
    """Luhn sum modulo 10 of a digit string."""
    d = F.reverse(F.transform(F.regexp_extract_all(number, F.lit("[0-9]"), F.lit(0)), lambda x: x.cast("int")))
    weighed = F.transform(d, lambda x, i: F.when(i % 2 == 0, x).otherwise(2 * x - F.when(x > 4, 9).otherwise(0)))
    return F.aggregate(weighed, F.lit(0), lambda t, x: t + x) % 10


def _card(canonical: Column, digits: Column) -> Column:
    drawn = _letterwise(canonical, digits, F.lit(1))
    body = F.substring(drawn, F.lit(1), F.char_length(drawn) - 1)
    valid = F.concat(body, ((10 - _luhn(F.concat(body, F.lit("0")))) % 10).cast("string"))
    return F.when(_luhn(canonical) == 0, valid).otherwise(drawn)


def _ip(canonical: Column, digits: Column) -> Column:
    octet = lambda x, i: (F.when(F.char_length(x) == 1, 1 + _number(digits, i) % 9)
                          .when(F.char_length(x) == 2, 10 + _number(digits, i) % 90).otherwise(100 + _number(digits, i) % 155)).cast("string")
    return F.array_join(F.transform(F.split(canonical, r"\."), octet), ".")


def _name(type_: Column, canonical: Column, digits: Column, draw: Column) -> Column:
    """A made-up name, lower case; later draws are longer, so there is always a free one."""
    def of(script: str) -> Column:
        syllables = F.array(*[F.lit(x) for x in SYLLABLES[script]])
        places = F.sequence(F.lit(0), (3 + F.floor(draw / 4)).cast("int"))
        body = F.array_join(F.transform(places, lambda i: F.get(syllables, _number(digits, i) % 16)), "")
        male, female = ENDINGS[script]
        return F.concat(body, F.when(type_ == "first_f", female).when(type_ == "first_m", male).otherwise(""))

    return (F.when(canonical.rlike(r"\p{IsCyrillic}"), of("cyrillic")).when(canonical.rlike(r"\p{IsGreek}"), of("greek"))
            .otherwise(of("latin")))


def surrogate(key: str, type_: Column, canonical: Column, draw: Column) -> Column:
    """Surrogate of a canonical part, itself in canonical form."""
    d = _draw(key, type_, canonical, draw)
    # The last label of a host stays, and with it the kind of the address.
    host_tail = F.regexp_extract(canonical, r"\.[^.]*$", 0)
    email = F.concat(_letterwise(F.substring(canonical, F.lit(1), F.char_length(canonical) - F.char_length(host_tail)), d, F.lit(0)), host_tail)
    return (F.when(type_ == "email", email).when(type_ == "ip", _ip(canonical, d)).when(type_ == "card", _card(canonical, d))
            .when(type_ == "access_key", _letterwise(canonical, d, F.lit(4))).when(type_ == "iban", _letterwise(canonical, d, F.lit(2)))
            .when(type_.isin("first_m", "first_f", "family"), _name(type_, canonical, d, draw))
            .when(type_ == "phone", _letterwise(canonical, d, F.greatest(F.char_length(canonical) - 9, F.lit(0))))
            # A short secret has few surrogates of its form; later draws are longer, so there is always a free one.
            .when(type_ == "secret", F.concat(_letterwise(canonical, d, F.lit(0)), F.substring(d, F.lit(1), F.greatest(draw - 3, F.lit(0)).cast("int"))))
            .otherwise(_letterwise(canonical, d, F.lit(0))))


def _poured(value: Column, digits: Column) -> Column:
    """``value`` with its letters and digits replaced, in order, by those of ``digits``."""
    chars = F.regexp_extract_all(value, F.lit("(?s)."), F.lit(0))
    seen = lambda i: F.char_length(F.regexp_replace(F.substring(value, F.lit(1), (i + 1).cast("int")), "[^0-9A-Z]", ""))
    return F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike("[0-9A-Z]"), F.substring(digits, seen(i), F.lit(1))).otherwise(c)), "")


def _cased(value: Column, new: Column) -> Column:
    """``new`` with capitals where ``value`` has them."""
    chars = F.regexp_extract_all(new, F.lit("(?s)."), F.lit(0))
    return F.array_join(F.transform(chars, lambda c, i: F.when(F.substring(value, (i + 1).cast("int"), F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c)), "")


def _name_case(value: Column, new: Column) -> Column:
    """``new`` in capitals where the word ``value`` is, else with one."""
    return F.when(value.rlike(r"^\P{Ll}+$"), F.upper(new)).otherwise(F.initcap(new))


def replacement(key: str, value: Column, redrawn: Column) -> Column:
    """Surrogate of an entity in its own format. ``redrawn``: array of
    struct(type, canonical, draw) of the entities that drew again."""
    ps, k = parts(value), kind(value)

    def new(p: Column) -> Column:
        draw = F.coalesce(F.get(F.filter(redrawn, lambda x: (x["type"] == p["type"]) & (x["canonical"] == p["canonical"])), 0)["draw"], F.lit(0))
        return surrogate(key, p["type"], p["canonical"], draw)

    news = F.transform(ps, new)
    title = F.substring_index(value, " ", 1)
    return (F.when(k == "name", F.concat_ws(" ", title, F.array_join(F.zip_with(_name_words(value), news, _name_case), " ")))
            .when(k.isin("phone", "card", "ssn", "iban"), _poured(value, F.get(news, 0)))
            .when(k == "secret", F.concat(F.regexp_extract(value, f"^{SECRET_KEY}", 0), F.get(news, 0)))
            .when(k == "email", _cased(value, F.get(news, 0))).otherwise(F.get(news, 0)))


# ---- the corpus -------------------------------------------------------------

def redraws(distinct: DataFrame, key: str, name: str = "pii-draws") -> DataFrame | None:
    """Of the distinct (type, canonical), those that must not use their first
    draw, with the draw to use; null if all may.

    Each round settles every entity whose surrogate is nobody else's and no
    real entity; the rest draw again. The few left open shrink every round.
    """
    drawn = stored(distinct.withColumn("draw", F.lit(0)).withColumn("s", surrogate(key, F.col("type"), F.col("canonical"), F.lit(0))), name)
    settled = drawn.select("type", "canonical", "s", "draw")
    for n in range(1, MAX_DRAWS + 1):
        # First of those that share a surrogate, in the order of (draw, canonical); settled ones come first.
        owner = settled.groupBy("type", "s").agg(F.min(F.struct("draw", "canonical")).alias("o"), F.count("*").alias("c"))
        taken = distinct.select("type", F.col("canonical").alias("s"))
        clash = owner.where("c > 1").select("type", "s", "o").unionByName(
            owner.join(taken, ["type", "s"], "left_semi").select("type", "s", F.lit(None).cast(owner.schema["o"].dataType).alias("o")))
        clash = clash.groupBy("type", "s").agg(F.max(F.col("o").isNull()).alias("real"), F.max("o").alias("o"))
        hit = settled.join(clash, ["type", "s"])
        # A clash of redrawn entities with settled ones must move the redrawn ones.
        bad = hit.where(F.col("real") | (F.struct("draw", "canonical") != F.col("o"))).select("type", "canonical")
        bad = stored(bad.distinct(), name)
        if bad.isEmpty():
            out = settled.where("draw > 0").select("type", "canonical", "draw")
            return None if n == 1 else out
        keep = settled.join(bad, ["type", "canonical"], "left_anti")
        again = bad.withColumn("draw", F.lit(n)).withColumn("s", surrogate(key, F.col("type"), F.col("canonical"), F.lit(n)))
        settled = stored(keep.unionByName(again.select("type", "canonical", "s", "draw")), name)
    raise RuntimeError("pii: surrogates still clash, raise MAX_DRAWS")


def replace_pii(docs: DataFrame, key: str = "surrogates-1", text: str = "text", out_count: str | None = None) -> DataFrame:
    """``docs`` with the entities of ``text`` replaced. ``out_count`` names a
    column for their number."""
    t = F.col(text)
    found = docs.withColumn("_p_found", entities(t))
    some = stored(found.where(F.size("_p_found") > 0).withColumn("_p_row", F.monotonically_increasing_id()), "pii-documents")
    none = found.where(F.size("_p_found") == 0)
    mention = some.select("_p_row", F.explode(F.array_distinct(F.flatten(F.transform("_p_found", parts)))).alias("p")).select("_p_row", "p.type", "p.canonical")
    again = redraws(stored(mention.select("type", "canonical").distinct(), "pii-entities"), key)
    row_type = "array<struct<type:string,canonical:string,draw:int>>"
    if again is None:
        some = some.withColumn("_p_redrawn", F.array().cast(row_type))
    else:
        of_row = mention.join(again, ["type", "canonical"]).groupBy("_p_row").agg(F.collect_list(F.struct("type", "canonical", "draw")).alias("_p_redrawn"))
        some = some.join(of_row, "_p_row", "left").withColumn("_p_redrawn", F.coalesce("_p_redrawn", F.array().cast(row_type)))
    news = F.transform("_p_found", lambda v: replacement(key, v, F.col("_p_redrawn")))
    between = F.split(t, ANY, -1)
    new_text = F.array_join(F.flatten(F.transform("_p_between", lambda x, i: F.array(x, F.coalesce(F.get(F.col("_p_new"), i), F.lit(""))))), "")
    some = some.withColumn("_p_between", between).withColumn("_p_new", news).withColumn("_p_text", new_text)
    count = [F.size("_p_found").cast("long").alias(out_count)] if out_count else []
    one = lambda d, new: d.select(*[new.alias(c) if c == text else F.col(c) for c in docs.columns], *count)
    return one(some, F.col("_p_text")).unionByName(one(none, t))


# ---- registered query and pipeline stage ------------------------------------

def op1_pii_surrogates(spark, sf_dir: str) -> DataFrame:
    return replace_pii(table(spark, sf_dir, "documents").select("doc_id", "text"), out_count="n_entities")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the same documents with surrogates in their texts."""
    return replace_pii(docs)
