"""Personal data replaced by keyed surrogates of the same type, gender, script and format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablewarden.llm.common import CONTENT, as_before, content_key, cut_lineage, packed, spread_join

# What introduces a secret, titles by gender, names by script and gender.
SECRET_WORDS = r"(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)"
MALE_TITLES = ["Mr", "Mister", "Herr", "Monsieur", "Sr", "Señor", "г-н", "господин"]
FEMALE_TITLES = ["Mrs", "Ms", "Miss", "Frau", "Mme", "Mlle", "Madame", "Sra", "Srta", "Señora", "г-жа", "госпожа"]
OPEN_TITLES = ["Dr", "Prof"]
MALE_NAMES = "Adam Albert Bruno Carl Daniel David Felix Henry Hugo James John Leon Louis Lucas Marco Martin Oscar Paul Peter Simon Thomas Victor".split()
FEMALE_NAMES = "Alice Anna Carla Clara Diana Elena Emma Eva Helen Irene Julia Laura Lucia Maria Marta Mary Nina Olga Paula Rosa Sara Sophie".split()
MALE_NAMES_CYRILLIC = "Алексей Андрей Борис Виктор Дмитрий Иван Михаил Николай Олег Павел Пётр Сергей".split()
FEMALE_NAMES_CYRILLIC = "Алла Анна Вера Дарья Елена Ирина Мария Наталья Нина Ольга Светлана Юлия".split()
SYLLABLES = "ba ber bo da den do fa fel ga gor ha hol ka kel la lin ma mer mo na nel no pa per ra rin ro sa sen so ta ter to va vel wa win za".split()
SYLLABLES_CYRILLIC = "ба бел бо ва вер во да дор ка кол ла лев ма мар но пе ра ров са сол та тор фе ха".split()

_TITLES = "(?:" + "|".join([*MALE_TITLES, *FEMALE_TITLES, *OPEN_TITLES]) + ")"
_NAME = r"\p{Lu}[\p{L}'’\-]+"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
EMAIL = r"[\p{L}\p{N}._%+\-]{1,64}+@[\p{L}\p{N}\-]{1,63}+(?:\.[\p{L}\p{N}\-]{1,63}+)+"
SECRET = rf"(?i:{SECRET_WORDS} ?[=:] ?[\"']?)[A-Za-z0-9+/_\-]{{8,}}"
ACCESS_KEY = r"(?:AKIA|ASIA)[A-Z0-9]{12,}\b|ghp_[A-Za-z0-9]{20,}\b|sk-[A-Za-z0-9]{16,}\b"
PERSON = rf"{_TITLES}\.? {_NAME}(?: {_NAME})?"
ADDRESS = rf"(?<!\.){_OCTET}(?:\.{_OCTET}){{3}}(?!\d|\.\d)"
SSN = r"(?<!-)\d{3}-\d{2}-\d{4}(?![\d\-])"
PHONE = r"\+\d{1,3} ?\(\d{2,4}\) ?\d{3,4}[ \-]\d{3,4}(?!\d)|\(\d{3}\) ?\d{3}-\d{4}(?!\d)|\+\d{1,3}(?:[ \-]\d{2,4}){2,4}(?![\d.])|(?<!-)\d{3}-\d{3}-\d{4}(?![\d\-])"
ACCOUNT = r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"
CARD = r"(?<!-)\d{4}[ \-]\d{4}[ \-]\d{4}[ \-]\d{4}(?!\d)|\d{13,19}(?!\d)"
# In this order: the first that fits at a place is the entity.
KINDS = {"email": EMAIL, "secret": SECRET, "key": ACCESS_KEY, "person": PERSON, "address": ADDRESS, "ssn": SSN, "phone": PHONE, "account": ACCOUNT, "card": CARD}
# What a kind can begin with; an alternative is only tried there.
_BEGINS = {"secret": "[PpSsTtAa]", "key": "[Ags]", "person": "[" + "".join(sorted({t[0] for t in [*MALE_TITLES, *FEMALE_TITLES, *OPEN_TITLES]})) + "]", "address": "[0-9]", "ssn": "[0-9]", "phone": r"[0-9+(]", "account": "[A-Z]", "card": "[0-9]"}
# An entity begins where no word goes on: not after a Latin letter or digit, and an e-mail not after any part of one.
ENTITY = (
    r"(?<![A-Za-z0-9])(?:(?<![\p{L}\p{N}._%+\-])" + EMAIL + "|" + "|".join(f"(?={_BEGINS[k]})(?:{p})" for k, p in KINDS.items() if k != "email") + ")"
)
# What stays of a match before the value itself.
LEAD = rf"^((?i:{SECRET_WORDS} ?[=:] ?[\"']?)|{_TITLES}\.? )"

ATTEMPTS = 64


def _kind(match: Column) -> Column:
    out = None
    for name, pattern in KINDS.items():
        # Look-behinds see nothing before a lone match, so each pattern still accepts what it found in the text.
        fits = match.rlike(f"^(?:{pattern})$")
        out = F.when(fits, name) if out is None else out.when(fits, name)
    return out.otherwise("card")


def _draw(seed: Column, place: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(seed, place), F.lit(n)).cast("int")


def _one_of(values: list[str], seed: Column, place: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), _draw(seed, F.lit(place), len(values)) + 1)


def _letters(value: Column, seed: Column, keep: Column) -> Column:
    """Each letter or digit after the first ``keep`` characters drawn anew from its own script and case."""
    hexed = value.rlike("^[0-9a-f]+$")

    def char(i: Column) -> Column:
        c = F.substr(value, i, F.lit(1))

        def pick(alphabet: str) -> Column:
            return F.substr(F.lit(alphabet), _draw(seed, i, len(alphabet)) + 1, F.lit(1))

        return (
            F.when(i <= keep, c)
            .when(c.between("0", "9"), pick("0123456789"))
            .when(hexed, pick("abcdef"))
            .when(c.between("a", "z"), pick("abcdefghijklmnopqrstuvwxyz"))
            .when(c.between("A", "Z"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            .when(c.between("а", "я"), pick("абвгдежзиклмнопрстуфхцчшэюя"))
            .when(c.between("А", "Я"), pick("АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"))
            .when(c.between("α", "ω"), pick("αβγδεζηθικλμνξοπρστυφχψω"))
            .when(c.between("一", "鿿"), pick("天地人山水火木金土石田林花草春夏秋冬東西南北"))
            .when(c.rlike(r"\p{Ll}"), pick("àáâäèéêëìíîïòóôöùúûüñç"))
            .when(c.rlike(r"\p{Lu}"), pick("ÀÁÂÄÈÉÊËÌÍÎÏÒÓÔÖÙÚÛÜÑÇ"))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.length(value), F.lit(1))), char), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum modulo 10 of a string of digits."""
    n = F.length(digits)
    each = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.when((n - i) % 2 == 1, F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), F.substr(digits, i, F.lit(1)).cast("int") + 1)).otherwise(
            F.substr(digits, i, F.lit(1)).cast("int")
        ),
    )
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10


def _card(value: Column, seed: Column) -> Column:
    """New digits after the first; a number that passes the Luhn test gives one that passes it."""
    drawn = _letters(value, seed, F.lit(1))
    plain = F.regexp_replace(value, "[^0-9]", "")
    zeroed = F.concat(F.substr(drawn, F.lit(1), F.length(drawn) - 1), F.lit("0"))
    check = F.pmod(F.lit(10) - _luhn(F.regexp_replace(zeroed, "[^0-9]", "")), F.lit(10)).cast("string")
    return F.when(_luhn(plain) == 0, F.concat(F.substr(drawn, F.lit(1), F.length(drawn) - 1), check)).otherwise(drawn)


def _person(value: Column, lead: Column, seed: Column, attempt: Column) -> Column:
    """A name of the same number of words; the first of several is a given name of the gender that title or name show."""
    title = F.regexp_replace(lead, r"\.? $", "")
    first = F.regexp_extract(value, r"^(\S+)", 1)
    cyrillic = value.rlike(r"\p{IsCyrillic}")
    female = title.isin(FEMALE_TITLES) | (title.isin(OPEN_TITLES) & first.isin([*FEMALE_NAMES, *FEMALE_NAMES_CYRILLIC]))
    given = F.when(
        cyrillic, F.when(female, _one_of(FEMALE_NAMES_CYRILLIC, seed, "given")).otherwise(_one_of(MALE_NAMES_CYRILLIC, seed, "given"))
    ).otherwise(F.when(female, _one_of(FEMALE_NAMES, seed, "given")).otherwise(_one_of(MALE_NAMES, seed, "given")))

    def syllable(i: Column) -> Column:
        return F.when(cyrillic, F.element_at(F.array(*[F.lit(v) for v in SYLLABLES_CYRILLIC]), _draw(seed, i, len(SYLLABLES_CYRILLIC)) + 1)).otherwise(
            F.element_at(F.array(*[F.lit(v) for v in SYLLABLES]), _draw(seed, i, len(SYLLABLES)) + 1)
        )

    family = F.initcap(F.array_join(F.transform(F.sequence(F.lit(1), attempt + 4), syllable), ""))
    return F.when(value.contains(" "), F.concat_ws(" ", given, family)).otherwise(family)


def _surrogate(kind: Column, value: Column, lead: Column, attempt: Column, key: str) -> Column:
    seed = F.sha2(F.concat_ws("\n", F.lit(key), kind, value, attempt.cast("string")), 256)
    domain = F.regexp_extract(value, "@(.*)$", 1)
    domain_seed = F.sha2(F.concat_ws("\n", F.lit(key), F.lit("domain"), domain), 256)
    ending = F.regexp_extract(domain, r"(\.[^.]*)$", 1)
    body = F.expr("1") * 0
    email = F.concat(
        _letters(F.regexp_extract(value, "^([^@]*)", 1), seed, body),
        F.lit("@"),
        _letters(F.regexp_replace(domain, r"\.[^.]*$", ""), domain_seed, body),
        ending,
    )
    octets = F.concat_ws(".", (_draw(seed, F.lit("a"), 223) + 1).cast("string"), *[_draw(seed, F.lit(p), 256).cast("string") for p in "bcd"])
    country = F.length(F.regexp_extract(value, r"^(\+\d{1,3}[ (\-]|\()", 1))
    return (
        F.when(kind == "email", email)
        .when(kind == "address", octets)
        .when(kind == "phone", _letters(value, seed, country))
        .when(kind == "card", _card(value, seed))
        .when(kind == "person", _person(value, lead, seed, attempt))
        .when(kind == "key", _letters(value, seed, F.lit(4)))
        .when(kind == "account", _letters(value, seed, F.lit(2)))
        .otherwise(_letters(value, seed, body))
    )


def assign(entities: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate) for distinct (kind, value, lead): no surrogate is given twice, and none is a value that occurs.

    Entities in conflict draw again; of those that share a surrogate the one with the fewest attempts, then the smallest
    value, keeps it. Raises if a format has no room for distinct surrogates within ``ATTEMPTS`` draws.
    """
    now = cut_lineage(entities.withColumn("attempt", F.lit(0)).withColumn("surrogate", _surrogate(F.col("kind"), F.col("value"), F.col("lead"), F.lit(0), key)))
    originals = now.select(F.col("value").alias("surrogate")).distinct()
    for _ in range(ATTEMPTS):
        owner = now.groupBy("surrogate").agg(F.min(F.struct("attempt", "kind", "value")).alias("owner"))
        judged = now.join(owner, "surrogate").join(originals.withColumn("taken", F.lit(True)), "surrogate", "left")
        own = (F.col("owner.kind") == F.col("kind")) & (F.col("owner.value") == F.col("value"))
        again = ~own | F.col("taken").isNotNull()
        judged = judged.select("kind", "value", "lead", (F.col("attempt") + again.cast("int")).alias("attempt"), "surrogate", again.alias("again"))
        if not judged.filter("again").limit(1).count():
            return now.select("kind", "value", "surrogate")
        redrawn = F.when(F.col("again"), _surrogate(F.col("kind"), F.col("value"), F.col("lead"), F.col("attempt"), key)).otherwise(F.col("surrogate"))
        now = cut_lineage(judged.withColumn("surrogate", redrawn).drop("again"))
    raise ValueError("a format has too few distinct surrogates for its entities")


def pseudonymise(docs: DataFrame, key: str, text: str = "text", count: str = "n_entities") -> DataFrame:
    """``docs`` with every detected entity in ``text`` replaced, and the number of replacements in the new column ``count``.

    The same value gets the same surrogate in every document under one ``key``, and different values different ones.
    Texts without an entity are returned as they are and never shuffled; null stays null, empty stays empty. Repeated
    rows stay repeated; other columns are kept; an empty table gives an empty result.
    """
    matches = F.coalesce(F.regexp_extract_all("_text", F.lit(ENTITY), F.lit(0)), F.array().cast("array<string>"))
    hits = packed(docs, _text=text, **content_key(text)).withColumn("_hits", matches)
    # Equal texts are looked at once.
    spotted = cut_lineage(hits.filter(F.size("_hits") > 0).select(*CONTENT, F.posexplode("_hits").alias("_at", "_match")).distinct())
    lead = F.regexp_extract("_match", LEAD, 1)
    parts = spotted.select("_match").distinct().withColumn("kind", _kind(F.col("_match"))).withColumn(
        "lead", F.when(F.col("kind").isin("secret", "person"), lead).otherwise("")
    ).withColumn("value", F.expr("substr(_match, length(lead) + 1)"))
    parts = cut_lineage(parts)
    # One value may follow several leads; the surrogate depends on one of them only through a person's gender.
    entities = parts.groupBy("kind", "value").agg(F.min("lead").alias("lead"))
    given = parts.join(assign(entities, key), ["kind", "value"]).select("_match", F.concat("lead", "surrogate").alias("_new"))
    replaced = (
        spread_join(spotted, given, ["_match"], [*CONTENT, "_at"], "inner")
        .groupBy(*CONTENT)  # bounded by the entities of one text
        .agg(F.sort_array(F.collect_list(F.struct("_at", "_new"))).alias("_news"))
        .select(*CONTENT, F.col("_news._new").alias("_news"))
    )
    between = F.split("_text", ENTITY, -1)
    woven = F.array_join(F.flatten(F.zip_with(between, F.array_append("_news", F.lit("")), lambda a, b: F.array(a, b))), "")
    # One text may be that of very many rows.
    found = spread_join(hits.filter(F.size("_hits") > 0), replaced, CONTENT, ["_doc"], "inner")
    changed = found.withColumn("_doc", F.col("_doc").withField(f"`{text}`", woven))
    clean = hits.filter(F.size("_hits") == 0)
    return as_before(clean.unionByName(changed.drop("_news")), docs, F.size("_hits").alias(count))
