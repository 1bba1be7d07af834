"""Personal data and secrets: surrogate generation, with DataFrame functions only.

One pattern finds e-mail addresses, phone and card numbers, IP addresses, SSNs, IBANs, access
keys, assigned secrets and titled names. Every distinct entity (type and normalised value, so
spellings of one phone number are one entity) gets a surrogate derived from a secret key:

* numbers keep their layout, length and leading digits of country or network; card numbers
  pass the Luhn check; e-mail addresses keep the shape of their local part; IP addresses move to
  10.0.0.0/8; keys, secrets and IBANs keep the class of every character;
* where fewer surrogates than entities are free, later attempts make longer ones (IP addresses
  move to 2001:db8::/32), so the search ends;
* names get a given name of the title's gender and a made-up surname, in the name's script.

Collision checks make the mapping one to one: a surrogate that two entities share, or that
is itself an entity of the corpus, is derived again with a higher attempt number until none is
left. Equal entities get equal surrogates in all documents.

Null texts stay null; empty and long texts, repeated rows, null or repeated ids and further
columns pass through (replacements depend on the text alone); empty tables give empty results.
Texts without entities are unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import staged

#: Titles by gender, given names by script and gender, syllables by script.
TITLES = {"m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин"], "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа"],
          "n": ["Dr", "Prof"]}
GIVEN = {
    "Latin": {"m": "Adam Bruno Carl Daniel Emil Felix Hugo Ivan Jonas Leon Martin Nils Oscar Paul Simon Victor",
              "f": "Alba Clara Diana Elena Flora Greta Hanna Irene Julia Laura Maria Nora Paula Rosa Sofia Vera",
              "n": "Alex Andrea Chris Dana Eden Jamie Kim Lou Marion Noel Robin Sam Sascha Toni Valery Yael"},
    "Cyrillic": {"m": "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Марк Олег Павел Роман Сергей Тарас Юрий",
                 "f": "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Лидия Мария Нина Ольга Раиса София Тамара Яна",
                 "n": "Валя Женя Ким Лёля Мика Ники Паша Рина Саша Слава Тося Шура Юля Яков Адриан Эмма"},
}
SYLLABLES = {"Latin": ("b d f g h k l m n p r s t v w z", "a e i o u"), "Cyrillic": ("б в г д з к л м н п р с т ф х ш", "а е и о у")}
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

_ANY_TITLE = "|".join(t for ts in TITLES.values() for t in sorted(ts, key=len, reverse=True))
_START, _STOP = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_TITLES = rf"(?:(?:{_ANY_TITLE})\.? )++"
_TITLE = rf"{_START}{_TITLES}"
#: A capitalised word, with inner capitals and apostrophes (not the possessive 's), after particles.
#: Groups repeat possessively: only so does Java's matcher not recurse once for every word.
_PARTICLES = r"(?:(?:van|von|der|den|de|del|della|di|da|du|zu|bin|ibn|al|el|la|le) )*+"
_NAME_WORD = rf"{_PARTICLES}(?!(?:{_ANY_TITLE}){_STOP})\p{{Lu}}[\p{{L}}\p{{M}}]*+(?:['’](?=\p{{L}}{{2}})[\p{{L}}\p{{M}}]++)*+"
_KEYWORD = r"(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\s{0,3}[=:]\s{0,3}"
_ASSIGN = rf"{_KEYWORD}[\"']?"
#: Quoted values run to the closing quote of the line, or to the next blank if there is none; others
#: to a blank, quote, comma or semicolon, and hold a digit or 200 characters.
_BARE = r"[^\s\"',;]"
_SECRET = (rf"(?:\"(?:[^\"\r\n]{{6,}}+(?=\")|[^\s\"]{{6,}}+)|'(?:[^'\r\n]{{6,}}+(?='(?!\p{{L}}))|[^\s']{{6,}}+)"
           rf"|(?={_BARE}{{0,200}}[0-9]|{_BARE}{{200}}){_BARE}{{6,}}+)")
_QUAD = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
PATTERN = "|".join([
    rf"(?i:{_KEYWORD}){_SECRET}",
    rf"{_START}[A-Za-z0-9][A-Za-z0-9._%+-]{{0,63}}@[A-Za-z0-9-]{{1,63}}(?:\.[A-Za-z0-9-]{{1,63}}){{0,6}}\.[A-Za-z]{{2,24}}",
    rf"{_START}(?:AKIA|ASIA)[0-9A-Z]{{16}}{_STOP}",
    rf"{_START}[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{3,7}}(?: ?[A-Z0-9]{{1,3}})?{_STOP}",
    rf"(?<![\p{{L}}\p{{N}}.])(?:{_QUAD}\.){{3}}{_QUAD}(?!\.?[0-9])",
    rf"{_START}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{_STOP}",
    rf"{_START}(?:[0-9]{{4}}[ -]?){{3}}[0-9]{{4}}(?:[ -]?[0-9]{{1,3}})?{_STOP}|{_START}3[47][0-9]{{2}}[ -]?[0-9]{{6}}[ -]?[0-9]{{5}}{_STOP}",
    rf"(?<![0-9+])(?:\+?[0-9]{{1,3}}[ .-]?)?\([0-9]{{2,4}}\)[ .-]?[0-9]{{3,4}}[ .-]?[0-9]{{3,4}}{_STOP}",
    rf"(?<![0-9+])\+(?=(?:[ .-]?[0-9]){{7}})[0-9]{{1,3}}(?:[ .-]?[0-9]{{2,4}}){{2,5}}{_STOP}",
    rf"(?<![0-9.-])[0-9]{{3}}[.-][0-9]{{3}}[.-][0-9]{{4}}(?![.-]?[0-9]){_STOP}",
    rf"{_TITLE}{_NAME_WORD}(?:[ -]{_NAME_WORD})*+",
])
#: Every match holds one of these, so most texts need no closer look.
HINT = rf"[0-9@]|{_ANY_TITLE}|[=:]\s{{0,3}}(?:[\"']|\S{{200}})"
NUMBERS = ("PHONE", "CARD", "SSN")


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string: every second digit from the right doubled, less 9 if over 9."""
    turned = F.reverse(digits)
    each = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: _luhn_digit(turned.substr(i, F.lit(1)).cast("int"), i % 2 == 0))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def _luhn_digit(d: Column, twice: Column) -> Column:
    return F.when(twice, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)


def parse(matches: DataFrame) -> DataFrame:
    """type, prefix, value and normalised value of each ``match``; type null: not an entity."""
    m = F.col("match")
    gender = F.when(m.rlike(rf"^(?:{'|'.join(TITLES['f'])})\.? "), "f").when(m.rlike(rf"^(?:{'|'.join(TITLES['m'])})\.? "), "m").otherwise("n")
    prefix = F.regexp_extract(m, rf"^((?i:{_ASSIGN})|{_TITLES})", 1)
    rows = matches.withColumn("prefix", prefix).withColumn("value", F.expr("substring(match, length(prefix) + 1)"))
    v = F.col("value")
    digits = _digits(v)
    script = F.when(v.rlike(r"\p{IsCyrillic}"), "Cyrillic").otherwise("Latin")
    kind = (F.when(m.rlike(rf"^(?i:{_ASSIGN})"), F.when(v.rlike(r"[\p{L}\p{N}]"), "SECRET")).when(F.col("prefix") != "", F.concat(F.lit("NAME "), gender, F.lit(" "), script))
            .when(m.contains("@"), "EMAIL").when(m.rlike("^(?:AKIA|ASIA)"), "KEY").when(m.rlike("^[A-Z]"), "IBAN")
            .when(m.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"), "IP").when(m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "SSN")
            .when(m.rlike(r"^[0-9]{4}[ -]?[0-9]{4}") | m.rlike("^3[47][0-9]{2}[ -]?[0-9]{6}"), F.when(_luhn_sum(digits) % 10 == 0, "CARD"))
            .otherwise("PHONE"))
    norm = (F.when(kind.isin(*NUMBERS), digits).when(kind == "IBAN", F.regexp_replace(v, " ", ""))
            .when(kind.isin("SECRET", "KEY"), v).otherwise(F.lower(v)))
    return rows.withColumn("type", kind).withColumn("norm", norm)


def _pick(seed: Column, i: Column | int, choices: str) -> Column:
    """One of the blank-separated ``choices``, by seed and place."""
    n = len(choices.split(" "))
    return F.element_at(F.split(F.lit(choices), " "), (F.pmod(F.xxhash64(seed, F.lit(i) if isinstance(i, int) else i), F.lit(n)) + 1).cast("int"))


def _shaped(text: Column, seed: Column, hexadecimal: bool = False) -> Column:
    """Every digit becomes a digit and every letter an ASCII letter of its case; the rest stays."""
    letters = "a b c d e f" if hexadecimal else "a b c d e f g h i j k l m n o p q r s t u v w x y z"

    def char(i: Column) -> Column:
        c = text.substr(i, F.lit(1))
        return (F.when(c.between("0", "9"), _pick(seed, i, "0 1 2 3 4 5 6 7 8 9")).when(c.between("a", "z"), _pick(seed, i, letters))
                .when(c.between("A", "Z"), _pick(seed, i, letters.upper())).when(c <= "\x7f", c)
                .when(c.rlike(r"\p{Lu}"), _pick(seed, i, letters.upper())).when(c.rlike(r"\p{L}"), _pick(seed, i, letters))
                .when(c.rlike(r"\p{N}"), _pick(seed, i, "0 1 2 3 4 5 6 7 8 9")).otherwise(c))

    return F.when(F.length(text) > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), char), "")).otherwise("")


def _surname(seed: Column, syllables: Column, onsets: str, vowels: str) -> Column:
    return F.initcap(F.array_join(F.transform(F.sequence(F.lit(1), syllables), lambda i: F.concat(
        _pick(seed, 2 * i, onsets), _pick(seed, 2 * i + 1, vowels))), ""))


def surrogate(key: str) -> Column:
    """The surrogate (normalised form) of columns type, norm and attempt."""
    kind, norm, attempt = F.col("type"), F.col("norm"), F.col("attempt")
    seed = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, norm, attempt.cast("string")), 256)
    # crowded spaces grow: from the fourth attempt on surrogates get longer, addresses move to 2001:db8::/32
    more = F.greatest(attempt - 3, F.lit(0))
    digits_more = _shaped(F.repeat(F.lit("0"), more), F.concat(seed, F.lit("+")))
    body = F.concat(_shaped(norm, seed), F.when(kind == "SECRET", _shaped(F.repeat(F.lit("a"), more), F.concat(seed, F.lit("+")))).otherwise(""))
    # phone: the leading digits of numbers with a country code stay, cards keep the network digit
    phone = F.when(F.length(norm) > 10, F.concat(F.expr("substring(norm, 1, length(norm) - 10)"), _shaped(F.expr("right(norm, 10)"), seed))).otherwise(body)
    phone = F.concat(phone, digits_more)
    stem = F.concat(norm.substr(1, 1), _shaped(F.expr("substring(norm, 2, length(norm) - 2)"), seed))
    card = F.concat(stem, F.pmod(-_luhn_sum(F.concat(stem, F.lit("0"))), F.lit(10)).cast("string"))
    email = F.concat(_shaped(F.substring_index(norm, "@", 1), seed), F.lit("@"), F.substring(seed, F.lit(1), 8 + more), F.lit(".example.org"))
    ip = F.when(more > 0, F.concat_ws(":", F.lit("2001:db8"), *[F.substring(seed, 1 + 4 * i, 4) for i in range(6)])) \
        .otherwise(F.concat_ws(".", F.lit("10"), *[F.pmod(F.xxhash64(seed, F.lit(i)), F.lit(256)).cast("string") for i in range(3)]))
    access = F.concat(norm.substr(1, 4), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(16)), lambda i: _pick(seed, i, " ".join(BASE32))), ""))
    iban = F.concat(norm.substr(1, 2), _shaped(F.expr("substring(norm, 3)"), seed))
    secret = F.when(norm.rlike("^[0-9a-f]+$"), F.concat(_shaped(norm, seed, hexadecimal=True), digits_more)).otherwise(body)
    name = F.lit(None).cast("string")
    for script, by_gender in GIVEN.items():
        surname = _surname(seed, 3 + attempt, *SYLLABLES[script])
        for gender, given in by_gender.items():
            name = F.when(kind == f"NAME {gender} {script}",
                          F.when(norm.rlike("[ -]"), F.concat_ws(" ", _pick(seed, 0, given), surname)).otherwise(surname)).otherwise(name)
    return (F.when(kind == "EMAIL", email).when(kind == "PHONE", phone).when(kind == "CARD", card).when(kind == "SSN", F.concat(body, digits_more))
            .when(kind == "IP", ip).when(kind == "KEY", access).when(kind == "IBAN", iban).when(kind == "SECRET", secret).otherwise(name))


def assign(entities: DataFrame, key: str) -> DataFrame:
    """One to one surrogates of the distinct (type, norm) rows. Of entities that derive the same
    surrogate the one with the lowest attempt, then value, keeps it; surrogates that are
    entities themselves (names: case aside) are nobody's."""
    own = staged(entities.select("type", "norm").withColumn("attempt", F.lit(0)).withColumn("surrogate", surrogate(key)), "pii-surrogates")
    real = entities.select("type", F.col("norm").alias("real"))
    while True:
        form = F.lower("surrogate")
        kept = own.groupBy("type", "surrogate").agg(F.min(F.struct("attempt", "norm")).alias("owner"))
        shared = own.join(kept, ["type", "surrogate"]).where(F.struct("attempt", "norm") != F.col("owner")).select("type", "norm")
        taken = own.withColumn("real", F.when(F.col("type").isin("SECRET", "KEY", "IBAN"), F.col("surrogate")).otherwise(form)) \
            .join(real, ["type", "real"], "left_semi").select("type", "norm")
        bad = staged(shared.union(taken).distinct(), "pii-collisions")
        if bad.isEmpty():
            return own
        again = own.join(bad, ["type", "norm"], "left_semi").withColumn("attempt", F.col("attempt") + 1).withColumn("surrogate", surrogate(key))
        own = staged(own.join(bad, ["type", "norm"], "left_anti").unionByName(again), "pii-surrogates")


def _render() -> Column:
    """The surrogate in the layout of the value: digits take the number's places, further ones follow."""
    v, s = F.col("value"), F.col("surrogate")
    places = F.transform(F.sequence(F.lit(1), F.length(v)), lambda i: F.when(
        v.substr(i, F.lit(1)).between("0", "9"), s.substr(F.length(_digits(v.substr(F.lit(1), i))), F.lit(1))).otherwise(v.substr(i, F.lit(1))))
    blocks = F.trim(F.regexp_replace(s, "(.{4})", "$1 "))
    return F.concat("prefix", F.when(F.col("type").isin(*NUMBERS), F.concat(F.array_join(places, ""), s.substr(F.length(_digits(v)) + 1, F.length(s))))
                    .when((F.col("type") == "IBAN") & v.contains(" "), blocks).otherwise(s))


def replace_entities(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with every entity in ``text_col`` replaced by its surrogate. ``count_col`` adds
    the number of replaced entities."""
    text, names = F.col(f"`{text_col}`"), docs.columns
    hinted = docs.where(F.coalesce(text.rlike(HINT), F.lit(False)))
    found = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    # equal texts share their matches; a hash collision would only add matches the text doesn't have
    occur = staged(hinted.select(F.xxhash64(text).alias("text_key"), F.explode(F.array_distinct(found)).alias("match")).distinct(), "pii-occurrences")
    matches = staged(parse(occur.select("match").distinct()).where(F.col("type").isNotNull()), "pii-matches")
    own = assign(matches.select("type", "norm").distinct(), key)
    replaced = matches.join(own, ["type", "norm"]).select("match", _render().alias("replacement"))
    maps = occur.join(replaced, "match").groupBy("text_key").agg(F.map_from_entries(F.collect_list(F.struct("match", "replacement"))).alias("by_match"))

    keyed = hinted.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.xxhash64(text).alias("text_key"))
    text_in = F.col(f"row.`{text_col}`")
    entities = F.regexp_extract_all(text_in, F.lit(PATTERN), F.lit(0))
    texts_between = F.split(text_in, PATTERN, -1)
    new = F.transform(entities, lambda e: F.coalesce(F.element_at("by_match", e), e))
    rebuilt = F.array_join(F.zip_with(texts_between, new, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    count = F.size(F.filter(entities, lambda e: F.map_contains_key("by_match", e))).cast("long")
    zero, found_any = F.lit(0).cast("long"), F.col("by_match").isNotNull()

    def out(df: DataFrame, new_text: Column, n: Column, at: str) -> DataFrame:
        cols = [new_text.alias(c) if c == text_col else F.col(f"{at}`{c}`") for c in names]
        return df.select(*cols, *([n.alias(count_col)] if count_col else []))

    return out(keyed.join(maps, "text_key", "left"), F.when(found_any, rebuilt).otherwise(text_in), F.when(found_any, count).otherwise(zero), "row.") \
        .union(out(docs.where(~F.coalesce(text.rlike(HINT), F.lit(False))), text, zero, ""))
