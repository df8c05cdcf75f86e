"""Personal data replaced by keyed surrogates, in DataFrame functions only.

A detected entity gets a replacement that depends on the key, its type and its
normalised value alone: the same person, address or number has the same surrogate
everywhere. Surrogates keep type and format (digits, case, separators, check digit),
script and, for names, the gender that the form of address tells. Surrogates that
meet each other or an original are drawn again until all are distinct.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marinelake.llm.common import free_name, kept_table
from marinelake.llm.registry import query, table

KEY = "corpus-surrogates-1"
#: Draws after which an address or a name gets longer, as its space is crowded.
CROWDED_DRAWS = 4
#: Draws after which an entity gets a tag in place of a surrogate of its format.
MOST_DRAWS = 24

# Forms of address by gender, given names by script and gender, and
# the letters that family names are made of.
FEMALE = "Mrs|Ms|Miss|Madam|Frau|Señora|Sra|Madame|Mme|г-жа|госпожа"
MALE = "Mr|Herr|Señor|Sr|Monsieur|г-н|господин"
ANY = "Dr|Prof"
GIVEN = {
    ("latin", "f"): "Anna Clara Diana Elena Flora Helena Irina Julia Laura Maria Nadia Paula Rosa Silvia Teresa Vera".split(),
    ("latin", "m"): "Adam Bruno Carlos David Emil Felix Georg Hugo Ivan Julian Leon Marco Nico Oscar Peter Victor".split(),
    ("cyrillic", "f"): "Анна Вера Дарья Елена Ирина Лариса Мария Нина".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Иван Кирилл Олег Павел".split(),
}
SYLLABLES = {"latin": ("bdfgklmnprstvz", "aeiou"), "cyrillic": ("бдгклмнпрствз", "аеиоу")}

# Letters and digits for the search: ASCII ones and all beyond ASCII, a class that is
# tested by comparisons and not by a look-up of properties.
_W = r"A-Za-z0-9\x{80}-\x{10FFFF}"
# Words that stand in small letters between the parts of a name.
PARTICLES = "van|von|der|den|de|del|della|di|da|dos|du|la|le|bin|ibn|al|ter|ten|zu|zur"
_NAME_WORD = r"\p{Lu}(?:\p{L}|['’-](?=\p{L}))+"
_NAME = rf"{_NAME_WORD}(?:(?: (?:{PARTICLES})){{0,3}} {_NAME_WORD}){{0,4}}+|(?:{PARTICLES})(?: (?:{PARTICLES})){{0,2}} {_NAME_WORD}"
#: Type and pattern; the first that matches a place decides.
PATTERNS = {
    "email": rf"(?<![{_W}._%+-])[{_W}._%+-]{{1,64}}+@[{_W}-]++(?:\.[{_W}-]++)*\.\p{{L}}{{2,}}",
    "secret": r"(?i:token|secret|api[_-]?key|password|passwd)[\"']?\s{0,3}[=:]\s{0,3}[\"'][^\"'\s]{8,200}[\"']",
    "iban": rf"(?<![{_W}])[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?(?![{_W}])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![0-9]|\.\d)",
    "ip6": rf"(?<![{_W}:.])(?=[0-9A-Fa-f]{{1,4}}:[0-9A-Fa-f:]*[0-9])(?:(?:[0-9A-Fa-f]{{1,4}}:){{7}}[0-9A-Fa-f]{{1,4}}|(?:[0-9A-Fa-f]{{1,4}}:){{1,6}}(?::[0-9A-Fa-f]{{1,4}}){{1,6}})(?![{_W}:])",
    "phone": r"(?<![0-9+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)|(?<![0-9+])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?!\d)",
    "ssn": r"(?<![0-9-])\d{3}-\d{2}-\d{4}(?![0-9-])",
    "card": r"(?<![0-9-])(?:\d{4}[ -]){3}\d{1,7}(?![0-9-])|(?<![0-9-])\d{4}[ -]\d{6}[ -]\d{5}(?![0-9-])|(?<![0-9])\d{13,19}(?![0-9])",
    "person": rf"(?<![{_W}])(?:{FEMALE}|{MALE}|{ANY})\.? (?:{_NAME})",
}
#: First characters of each type: one test of a character spares most places the rest.
_FIRST = {"secret": "[TtSsAaPp]", "iban": "[A-Z]", "person": "[MFSDPHг]"}


def _any_pattern() -> str:
    numbers = "|".join(PATTERNS[k] for k in ("ip", "phone", "ssn", "card"))
    parts = [rf"(?=[0-9+(])(?:{numbers})"]
    for kind in ("secret", "iban", "person"):
        parts.append(rf"(?={_FIRST[kind]})(?:{PATTERNS[kind]})")
    return "|".join([f"(?:{PATTERNS['email']})", f"(?:{PATTERNS['ip6']})", *parts])


ANY_PATTERN = _any_pattern()


def _pick(options: list[str] | str, code: Column) -> Column:
    """One of the options by a number."""
    return F.element_at(F.array(*map(F.lit, options)), (code % len(options) + 1).cast("int"))


def _number(digest: Column, place: Column | int) -> Column:
    """Byte ``place`` of a hex digest as a number."""
    place = F.lit(place) if isinstance(place, int) else place
    return F.conv(F.substring(digest, place * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _kept_format(value: Column, digest: Column) -> Column:
    """Digits by digits, letters by letters of the same case, all else as it is."""
    places = F.sequence(F.lit(1), F.length(value))

    def one(i: Column) -> Column:
        c, code = F.substring(value, i, F.lit(1)), _number(digest, i % 64)
        letter = F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), (code % 26 + 1).cast("int"), F.lit(1))
        return (
            F.when(c.rlike(r"\p{N}"), (code % 10).cast("string"))
            .when(c.rlike(r"\p{Lu}"), F.upper(letter))
            .when(c.rlike(r"\p{L}"), letter)
            .otherwise(c)
        )

    return F.array_join(F.transform(places, one), "")


def _hex_format(value: Column, digest: Column) -> Column:
    """As :func:`_kept_format`, of hexadecimal digits and colons, letters within a to f."""
    places = F.sequence(F.lit(1), F.length(value))

    def one(i: Column) -> Column:
        c, code = F.substring(value, i, F.lit(1)), _number(digest, i % 64)
        letter = F.substring(F.lit("abcdef"), (code % 6 + 1).cast("int"), F.lit(1))
        return F.when(c.rlike(r"\d"), (code % 10).cast("string")).when(c.rlike("[A-F]"), F.upper(letter)).when(c == ":", c).otherwise(letter)

    return F.array_join(F.transform(places, one), "")


def entity_type(value: Column) -> Column:
    kind = None
    for name, pattern in PATTERNS.items():
        hit = value.rlike(rf"^(?:{pattern})$")
        kind = F.when(hit, name) if kind is None else kind.when(hit, name)
    return kind


def _secret(value: Column) -> Column:
    return F.regexp_extract(value, "[\"']([^\"'\\s]+)[\"']$", 1)


def _person(value: Column) -> tuple[Column, Column, Column, Column]:
    """Form of address with its blank, name, gender, script."""
    title = F.regexp_extract(value, rf"^(?:{FEMALE}|{MALE}|{ANY})\.? ", 0)
    name = F.substring(value, F.length(title) + 1, F.length(value))
    gender = F.when(title.rlike(rf"^(?:{FEMALE})\b"), "f").when(title.rlike(rf"^(?:{MALE})\b"), "m").otherwise("")
    script = F.when(name.rlike(r"^[\p{IsCyrillic} '’-]+$"), "cyrillic").otherwise("latin")
    return title, name, gender, script


def normal_form(kind: Column, value: Column) -> Column:
    """What makes two mentions one entity: no case, no separators of numbers."""
    _, name, gender, script = _person(value)
    return (
        F.when(kind.isin("phone", "card", "ssn"), F.regexp_replace(value, r"\D", ""))
        .when(kind == "iban", F.replace(value, F.lit(" "), F.lit("")))
        .when(kind == "secret", F.lower(_secret(value)))
        .when(kind == "person", F.concat_ws("/", script, gender, F.lower(name)))
        .otherwise(F.lower(value))
    )


def _address(normal: Column, digest: Column, crowded: Column, key: str) -> Column:
    """Local part by its own digest, longer where short ones are used up; a host by the
    host's, so hosts stay together."""
    host = F.substring_index(normal, "@", -1)
    by_host = F.sha2(F.concat(F.lit(f"{key}|host|"), host), 512)
    labels = F.regexp_replace(host, r"\.\p{L}+$", "")
    more = F.when(crowded, F.substring(digest, 1, 16)).otherwise("")
    return F.concat(_kept_format(F.substring_index(normal, "@", 1), digest), more, F.lit("@"), _kept_format(labels, by_host), F.lit(".example"))


def _checked(number: Column, made: Column) -> Column:
    """With the check digit of card numbers where the original has one."""
    stem = F.substring(made, F.lit(1), F.length(made) - 1)
    fitting = F.filter(F.sequence(F.lit(0), F.lit(9)), lambda d: F.call_function("luhn_check", F.concat(stem, d.cast("string"))))
    return F.when(F.call_function("luhn_check", number), F.concat(stem, fitting[0].cast("string"))).otherwise(made)


def _name(normal: Column, digest: Column, crowded: Column) -> Column:
    """Given and family name, or only that; a family name of twice the length where
    short ones are used up."""
    script, gender, words = (F.split_part(normal, F.lit("/"), F.lit(i)) for i in (1, 2, 3))
    either = F.when(gender == "", F.when(_number(digest, 0) % 2 == 0, "f").otherwise("m")).otherwise(gender)
    given, family = None, None
    for (s, g), names in GIVEN.items():
        hit = (script == s) & (either == g)
        one = _pick(names, _number(digest, 1))
        given = F.when(hit, one) if given is None else given.when(hit, one)
    for s, (consonants, vowels) in SYLLABLES.items():
        parts = [x for i in range(8) for x in (_pick(list(consonants), _number(digest, 2 + 2 * i)), _pick(list(vowels), _number(digest, 3 + 2 * i)))]
        one = F.initcap(F.concat(*parts[:8], F.when(crowded, F.concat(*parts[8:])).otherwise("")))
        family = F.when(script == s, one) if family is None else family.when(script == s, one)
    return F.when(F.contains(words, F.lit(" ")), F.concat(given, F.lit(" "), family)).otherwise(family)


def with_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``made`` for rows of ``kind, normal, draw``: the surrogate, itself a normal form
    but for the case of letters and, of a person, script and gender."""
    kind, normal, digest, formatted = map(F.col, ("kind", "normal", "digest", "formatted"))
    octets = F.concat_ws(".", (_number(digest, 0) % 223 + 1).cast("string"), *(_number(digest, i).cast("string") for i in (1, 2, 3)))
    crowded = F.col("draw") >= CROWDED_DRAWS
    made = (
        F.when(kind == "email", _address(normal, digest, crowded, key))
        .when(kind == "ip", octets)
        .when(kind == "card", _checked(normal, formatted))
        .when((kind == "ip6") | (kind == "secret") & normal.rlike("^[0-9a-f]+$"), _hex_format(normal, digest))
        .when(kind == "iban", F.concat(F.substring(normal, 1, 2), F.substring(formatted, F.lit(3), F.length(formatted))))
        .when(kind == "person", _name(normal, digest, crowded))
        .otherwise(formatted)
    )
    drawn = entities.withColumn("digest", F.sha2(F.concat_ws("|", F.lit(key), "kind", "normal", F.col("draw").cast("string")), 512))
    drawn = drawn.withColumn("formatted", _kept_format(normal, digest))
    return drawn.withColumn("made", made).drop("digest", "formatted")


#: What tags begin with; no pattern matches a tag.
_TAG = "[surrogate-"


def _tag(key: str) -> Column:
    """A name for an entity of a type that has more entities than its format has values:
    letters only, by a digest of 128 bits."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("tag"), "kind", "normal"), 256)
    return F.concat(F.lit(_TAG), F.translate(F.substring(digest, 1, 32), "0123456789", "ghijklmnop"), F.lit("]"))


def _in_place(kind: Column, value: Column, made: Column) -> Column:
    """The surrogate in the format of one mention: its separators and its case."""
    old = F.when(kind == "secret", _secret(value)).otherwise(value)
    title, name, _, _ = _person(value)
    tag = made.startswith(_TAG)
    cased = F.when(tag, made).when((F.upper(old) == old) & (F.lower(old) != old), F.upper(made)).otherwise(made)
    used = F.when(kind == "iban", r"[A-Z0-9]").otherwise(r"\d")

    def one(i: Column) -> Column:
        c = F.substring(value, i, F.lit(1))
        before = F.length(F.regexp_replace(F.substring(value, F.lit(1), i), F.when(kind == "iban", r"[^A-Z0-9]").otherwise(r"\D"), F.lit("")))
        return F.when(F.regexp_like(c, used), F.substring(made, before, F.lit(1))).otherwise(c)

    spread = F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), one), "")
    secret = F.concat(F.regexp_extract(value, "^(.*[\"'])[^\"'\\s]+[\"']$", 1), cased, F.substring(value, F.length(value), F.lit(1)))
    named = F.concat(title, F.when((F.upper(name) == name) & ~tag, F.upper(made)).otherwise(made))
    return F.when(kind.isin("phone", "card", "ssn", "iban") & ~tag, spread).when(kind == "secret", secret).when(kind == "person", named).otherwise(cased)


def distinct_surrogates(entities: DataFrame, key: str = KEY, drawn_by: Callable = with_surrogates) -> DataFrame:
    """``kind, normal, draw, made`` of every entity (``kind, normal``), all distinct.

    A surrogate is refused if it is an original of its type, or if another entity of
    the type has it, unless that is the one of the larger normal form. Refused ones
    draw again; one that is still refused after ``MOST_DRAWS``, as its type has more
    entities than its format has values, gets a tag."""
    state = kept_table(entities.select("kind", "normal").distinct().withColumn("draw", F.lit(0)), "entities")
    originals = state.select("kind", F.col("normal").alias("taken"))
    plain = F.lower("made")
    for _ in range(MOST_DRAWS):
        drawn = kept_table(drawn_by(state, key), "drawn")
        same = F.when(F.col("kind") == "person", F.concat_ws("/", F.substring_index("normal", "/", 2), plain)).otherwise(plain)
        first = drawn.groupBy("kind", plain.alias("plain")).agg(F.min("normal").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        doubled = drawn.withColumn("plain", plain).join(first, ["kind", "plain"]).where("normal <> first").select("kind", "normal")
        real = drawn.withColumn("taken", same).join(originals, ["kind", "taken"], "left_semi").select("kind", "normal")
        refused = kept_table(doubled.union(real).distinct().withColumn("more", F.lit(1)), "refused")
        if refused.isEmpty():
            return drawn
        state = drawn.join(refused, ["kind", "normal"], "left").select("kind", "normal", (F.col("draw") + F.coalesce("more", F.lit(0))).alias("draw"))
    return drawn.join(refused, ["kind", "normal"], "left").select("kind", "normal", "draw", F.when(F.col("more").isNull(), F.col("made")).otherwise(_tag(key)).alias("made"))


def one_person(kinds: DataFrame) -> DataFrame:
    """``kinds`` with the person of a title without gender (Dr, Prof) as the one of the
    same name whose gender another title tells; a woman, if both genders occur."""
    person = F.col("kind") == "person"
    script, gender, name = (F.split_part("normal", F.lit("/"), F.lit(i)) for i in (1, 2, 3))
    told = kinds.where(person & (gender != "")).groupBy(F.concat_ws("//", script, name).alias("normal")).agg(F.min("normal").alias("told"))
    return kinds.join(told, "normal", "left").withColumn("normal", F.coalesce("told", "normal")).select("value", "kind", "normal")


def _bare_names(persons: DataFrame, by: str) -> DataFrame:
    """``by, pattern, names`` of texts that name persons: what finds their names without a
    form of address, and the surrogate of each, whole names before family names. A family
    name that several persons of a text have goes to the first of them in the alphabet.

    ``persons`` holds ``by, value, new``; a text's names are no more than its mentions."""
    title, name, _, _ = _person(F.col("value"))
    made = F.substring(F.col("new"), F.length(title) + 1, F.length("new"))
    named = persons.select(by, name.alias("name"), made.alias("made"))
    last = F.regexp_extract("name", rf"({_NAME_WORD})$", 1)
    family = F.when(F.col("made").startswith(_TAG), F.col("made")).otherwise(F.substring_index("made", " ", -1))
    both = named.select(by, F.lit(0).alias("part"), "name", "name", "made").toDF(by, "part", "old", "whole", "made").union(
        named.select(by, F.lit(1), last, "name", family).where(last != "")
    )
    first = both.groupBy(by, "old").agg(F.min(F.struct("part", "whole", "made"))["made"].alias("made"))
    lists = first.groupBy(by).agg(F.map_from_entries(F.collect_list(F.struct("old", "made"))).alias("names"))
    longest = F.array_sort(F.map_keys("names"), lambda a, b: F.length(b) - F.length(a))
    pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}])(?:"), F.array_join(longest, "|"), F.lit(r")(?![\p{L}\p{N}])"))
    return lists.select(by, pattern.alias("pattern"), "names")


def _replaced(text: Column, pattern: Column, found: Column, made: Column) -> Column:
    """The text with the value of ``made`` in place of each of ``found``, all that the pattern finds."""
    between = F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda a, b: F.array(a, made[b]))
    return F.concat(F.array_join(F.flatten(pairs), ""), F.element_at(between, -1))


def replace_personal_data(docs: DataFrame, key: str = KEY, text: str = "text", counted: str | None = None, drawn_by: Callable = with_surrogates) -> DataFrame:
    """``docs`` with surrogates in the text; all rows and columns stay, and ``counted``
    names one more column for the number of entities of a row.

    A person named with a form of address is replaced wherever the text has the same
    name, or its family name, without one. ``counted`` does not count those. Null and
    empty texts, and texts without an entity, stay as they are. A surrogate
    is made once per distinct mention; only rows with an entity take part in a join."""
    found, made, digest, pattern, bare = (free_name(docs, x) for x in ("found", "made", "digest", "pattern", "bare"))
    column = F.col(text).cast("string")
    columns = [F.col(f"`{c}`") for c in docs.columns if c != text]
    order = [*docs.columns, *([counted] if counted else [])]
    hit = F.coalesce(column.rlike(ANY_PATTERN), F.lit(False))
    clean = docs.where(~hit).select("*", *([F.lit(0).alias(counted)] if counted else []))
    rows = docs.where(hit).withColumn(found, F.regexp_extract_all(column, F.lit(ANY_PATTERN), F.lit(0))).withColumn(digest, F.md5(column))
    texts = kept_table(rows.select(digest, F.explode(F.array_distinct(found)).alias("value")).distinct(), "mentions")
    kinds = texts.select("value").distinct().withColumn("kind", entity_type(F.col("value")))
    kinds = kept_table(one_person(kinds.withColumn("normal", normal_form(F.col("kind"), F.col("value")))), "kinds")
    entities = distinct_surrogates(kinds, key, drawn_by)
    replaced = kinds.join(entities, ["kind", "normal"]).select("kind", "value", _in_place(F.col("kind"), F.col("value"), F.col("made")).alias("new"))
    replaced = kept_table(replaced, "replaced")
    known = texts.join(replaced, "value")
    maps = known.groupBy(digest).agg(F.map_from_entries(F.collect_list(F.struct("value", "new"))).alias(made))
    names = _bare_names(known.where("kind = 'person'"), digest).toDF(digest, pattern, bare)
    rows = rows.join(maps.join(names, digest, "left"), digest)
    # Names without a form of address stand between the mentions.
    between = F.split(column, ANY_PATTERN, -1)
    named = F.col(pattern)
    between = F.when(named.isNull(), between).otherwise(
        F.transform(between, lambda part: _replaced(part, named, F.regexp_extract_all(part, named, F.lit(0)), F.col(bare)))
    )
    pairs = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda a, b: F.array(a, F.col(made)[b]))
    whole = F.concat(F.array_join(F.flatten(pairs), ""), F.element_at(between, -1))
    number = [F.size(found).alias(counted)] if counted else []
    return clean.select(*order).union(rows.select(*columns, whole.alias(text), *number).select(*order))


@query("op9_pii_surrogates")
def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_personal_data(docs, counted="n_entities")
