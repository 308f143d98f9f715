"""Surrogates for personal data, by built-in functions only.

Detected entities get replacements of their own kind that depend on a key and the entity alone, so that one entity is
replaced alike everywhere. Replacements keep script, case, length and punctuation; names keep title and gender; card
numbers keep whether their check digit fits. Distinct entities get distinct replacements, and none is an entity that
really occurs: a table of all distinct entities is drawn again, with the next attempt, where a check finds a collision.

E-mail domains come out under `.example` and addresses in 240.0.0.0/4, which are reserved.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import delete_path, fresh_path, scratch_name

# Titles and given names tell the gender of a name; the lists are parameters of taste, not of completeness.
MALE_TITLES = ["Mr", "Herr", "Monsieur", "Señor", "Господин"]
FEMALE_TITLES = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "Госпожа"]
MALE_NAMES = {
    "latin": ["James", "John", "Robert", "Michael", "William", "David", "Thomas", "Peter", "Hans", "Pierre", "Carlos", "José"],
    "cyrillic": ["Иван", "Пётр", "Алексей", "Дмитрий", "Сергей", "Николай"],
}
FEMALE_NAMES = {
    "latin": ["Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Anna", "Susan", "Karen", "Greta", "Claire", "Carmen", "Lucía"],
    "cyrillic": ["Анна", "Мария", "Елена", "Ольга", "Наталья", "Татьяна"],
}
SYLLABLES = {
    "latin": ["ba", "den", "for", "gal", "hol", "ker", "lin", "mar", "nor", "pel", "ros", "san", "tor", "ver", "wel", "zan"],
    "cyrillic": ["ба", "ден", "фор", "гал", "хол", "кер", "лин", "мар", "нор", "пел", "рос", "сан", "тор", "вер", "зел", "жан"],
}
# Letters that stand for letters, by range of the letter replaced.
ALPHABETS = [
    ("a", "z", "abcdefghijklmnopqrstuvwxyz"),
    ("A", "Z", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("0", "9", "0123456789"),
    ("ß", "ÿ", "àáâäçèéêëìíîïñòóôöùúûü"),
    ("À", "Þ", "ÀÁÂÄÇÈÉÊËÌÍÎÏÑÒÓÔÖÙÚÛÜ"),
    ("а", "я", "абвгдежзиклмнопрстуфхцчшэюя"),
    ("А", "Я", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"),
]

EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"(?<![\p{L}\p{N}+])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,3}(?!\d)"
CARD = r"(?<![\p{L}\p{N}])\d{4}(?:[ -]?\d{4}){3}(?![\p{L}\p{N}])"
NATIONAL = r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])"
ADDRESS = r"(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\p{L}\p{N}]|\.\d)"
SECRET = r"(?<![\p{L}\p{N}])[0-9a-f]{32,64}(?![\p{L}\p{N}])"
_TITLES = "|".join(MALE_TITLES + FEMALE_TITLES)
_GIVEN = "|".join(name for names in (MALE_NAMES, FEMALE_NAMES) for part in names.values() for name in part)
_WORD = r"\p{Lu}\p{Ll}+"
NAME = rf"(?<!\p{{L}})(?:(?:{_TITLES})\.? (?:(?:{_GIVEN}) )?{_WORD}|(?:{_GIVEN}) {_WORD})(?!\p{{L}})"
KINDS = {"email": EMAIL, "phone": PHONE, "card": CARD, "national": NATIONAL, "address": ADDRESS, "secret": SECRET, "name": NAME}
PATTERN = "|".join(KINDS.values())
MAX_ATTEMPTS = 64
LONGER = 3  # attempt from which names and mailboxes grow


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def kind_of(value: Column) -> Column:
    """Kind of a match: the first of which the whole match is one."""
    kind = F.lit("name")
    for name, pattern in reversed(list(KINDS.items())):
        kind = F.when(value.rlike(f"^(?:{pattern})$"), name).otherwise(kind)
    return kind


def _draw(noise: Column, place: Column, size: int) -> Column:
    """A number under `size` from the two hexadecimal digits of the noise at a place, from 0."""
    digits = F.substring(noise, (F.pmod(place, F.lit(64)) * 2 + 1).cast("int"), F.lit(2))
    return F.pmod(F.conv(digits, 16, 10).cast("int"), F.lit(size))


def _pick(letters: str, number: Column) -> Column:
    return F.substring(F.lit(letters), (number + 1).cast("int"), F.lit(1))


def _same_format(value: Column, noise: Column) -> Column:
    """Letters and digits drawn anew from the alphabet of each; all else stays."""

    def letter(place: Column) -> Column:
        def drawn(old: Column) -> Column:
            new = old
            for first, last, alphabet in reversed(ALPHABETS):
                new = F.when(old.between(first, last), _pick(alphabet, _draw(noise, place, len(alphabet)))).otherwise(new)
            return new

        return _bound(F.substring(value, (place + 1).cast("int"), F.lit(1)), drawn)

    places = F.when(F.length(value) > 0, F.sequence(F.lit(0), F.length(value) - 1)).otherwise(F.array().cast("array<int>"))
    return F.array_join(F.transform(places, letter), "")


def _luhn(digits: Column) -> Column:
    """Digit that completes 15 digits to a card number."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.lit(15)),
        F.lit(0),
        lambda total, i: total
        + _bound(
            F.substring(digits, i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1),
            lambda x: F.when(x > 9, x - 9).otherwise(x),
        ),
    )
    return F.pmod(-total, F.lit(10))


def _card(value: Column, noise: Column) -> Column:
    def finished(drawn: Column) -> Column:
        old, new = F.regexp_replace(value, r"\D", ""), F.regexp_replace(drawn, r"\D", "")
        fits = _luhn(old) == F.substring(old, 16, 1).cast("int")
        last = F.pmod(_luhn(new) + F.when(fits, 0).otherwise(1), F.lit(10))
        return F.concat(F.substring(drawn, F.lit(1), F.length(drawn) - 1), last.cast("string"))

    return _bound(_same_format(value, noise), finished)


def _address(noise: Column) -> Column:
    parts = [240 + _draw(noise, F.lit(0), 16), *[_draw(noise, F.lit(i), 256) for i in (1, 2, 3)]]
    return F.concat_ws(".", *[part.cast("string") for part in parts])


def _email(value: Column, noise: Column, key: str, attempt: int) -> Column:
    mailbox, domain = F.substring_index(value, "@", 1), F.lower(F.substring_index(value, "@", -1))
    longer = F.substring(noise, 100, 2 * (attempt - LONGER + 1)) if attempt >= LONGER else F.lit("")
    shared = F.substring(F.sha2(F.concat_ws("\u0001", F.lit(key), F.lit("domain"), domain).cast("binary"), 256), 1, 12)
    return F.concat(_same_format(mailbox, noise), longer, F.lit("@mail-"), shared, F.lit(".example"))


def _name(value: Column, noise: Column, attempt: int) -> Column:
    title = F.regexp_extract(value, rf"^(?:(?:{_TITLES})\.? )?", 0)
    given = F.regexp_extract(value, rf"^(?:(?:{_TITLES})\.? )?((?:{_GIVEN}) )?", 1)
    female = title.rlike(rf"^(?:{'|'.join(FEMALE_TITLES)})\b") | (
        (title == "") & F.trim(given).isin(*[name for names in FEMALE_NAMES.values() for name in names])
    )

    def named(script: str) -> Column:
        men, women = MALE_NAMES[script], FEMALE_NAMES[script]

        def of(names: list[str]) -> Column:
            return F.get(F.array(*[F.lit(name) for name in names]), _draw(noise, F.lit(0), len(names)))

        first = F.when(given == "", "").otherwise(F.concat(F.when(female, of(women)).otherwise(of(men)), F.lit(" ")))
        syllables = F.array(*[F.lit(part) for part in SYLLABLES[script]])
        count = 3 + (attempt - LONGER + 1 if attempt >= LONGER else 0)
        last = F.concat(*[F.get(syllables, _draw(noise, F.lit(i + 1), len(SYLLABLES[script]))) for i in range(count)])
        return F.concat(title, first, F.initcap(last))

    return F.when(value.rlike(r"\p{IsCyrillic}"), named("cyrillic")).otherwise(named("latin"))


def surrogate(kind: Column, value: Column, key: str, attempt: int) -> Column:
    """Replacement of an entity; another attempt gives another one."""
    seed = F.concat_ws("\u0001", F.lit(key), kind, value, F.lit(str(attempt)))

    def of(noise: Column) -> Column:
        country = F.regexp_extract(value, r"^\+\d{1,3}(?=[ .(-])", 0)
        phone = F.concat(country, _same_format(F.substring(value, F.length(country) + 1, F.length(value)), noise))
        return (
            F.when(kind == "email", _email(value, noise, key, attempt))
            .when(kind == "phone", phone)
            .when(kind == "card", _card(value, noise))
            .when(kind == "address", _address(noise))
            .when(kind == "secret", F.substring(noise, F.lit(1), F.length(value)))
            .when(kind == "name", _name(value, noise, attempt))
            .otherwise(_same_format(value, noise))
        )

    return _bound(F.sha2(seed.cast("binary"), 512), of)


def assign(entities: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate) for distinct (kind, value) rows: distinct surrogates, none of them a value.

    Of entities that draw the same surrogate the one of least value keeps it; the others draw again, checked against
    all values and all surrogates given so far. Nearly all are settled by the first draw.
    """
    spark = entities.sparkSession

    def written(df: DataFrame) -> tuple[DataFrame, str]:
        path = fresh_path(spark, "surrogates")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    real, _ = written(entities.select("kind", "value").distinct())
    settled, pending, paths = None, real, []
    for attempt in range(MAX_ATTEMPTS):
        drawn = pending.select("kind", "value", surrogate(F.col("kind"), F.col("value"), key, attempt).alias("surrogate"))
        drawn, path = written(drawn)
        paths.append(path)
        first = drawn.groupBy("surrogate").agg(F.min("value").alias("value"))
        good = drawn.join(first, ["surrogate", "value"]).join(real.select(F.col("value").alias("surrogate")), "surrogate", "left_anti")
        if settled is not None:
            good = good.join(settled.select("surrogate"), "surrogate", "left_anti")
        good, _ = written(good.select("kind", "value", "surrogate"))
        settled = good if settled is None else settled.union(good)
        left, path = written(pending.join(good.select("kind", "value"), ["kind", "value"], "left_anti"))
        paths.append(path)
        if left.isEmpty():
            break
        pending = left
    else:
        raise RuntimeError(f"some entities found no surrogate of their own in {MAX_ATTEMPTS} attempts")
    settled, _ = written(settled)
    for path in paths:
        delete_path(spark, path)
    return settled


def replace_entities(docs: DataFrame, key: str, column: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """All rows and columns, with the entities in the text replaced, and `n_replaced`, how many there were.

    The whole text is searched. A null text stays null and an empty one empty, with none replaced. Rows that repeat are
    treated alike; rows that share a doc_id are told apart by their texts. One entity has one surrogate in the whole
    table, so that mentions still refer to the same; another key gives other surrogates. `n_replaced` gets an
    underscore if the name is taken. An empty table gives an empty one.
    """
    row, version, found, number = (scratch_name(docs, name) for name in ("_doc", "_version", "_found", "n_replaced"))
    marked = docs.withColumns({row: F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), version: F.xxhash64(column)})
    matches = F.regexp_extract_all(F.col(column), F.lit(PATTERN), F.lit(0))
    spark = docs.sparkSession
    path = fresh_path(spark, "mentions")
    mentions = marked.select(row, version, F.posexplode(matches).alias("place", "value"))
    mentions.withColumn("kind", kind_of(F.col("value"))).write.parquet(path)
    mentions = spark.read.schema(f"`{row}` string, `{version}` bigint, place int, value string, kind string").parquet(path)
    table = assign(mentions.select("kind", "value").distinct(), key)
    replaced = (
        mentions.join(table, ["kind", "value"])
        .groupBy(row, version)
        .agg(F.sort_array(F.collect_set(F.struct("place", "surrogate"))).alias(found))
        .select(row, version, F.col(f"{found}.surrogate").alias(found))
    )
    parts = F.split(F.col(column), PATTERN, -1)
    joined = F.array_join(F.flatten(F.zip_with(parts, F.col(found), lambda part, new: F.array(part, F.coalesce(new, F.lit(""))))), "")
    text = F.when(F.col(found).isNull(), F.col(column)).otherwise(joined).alias(column)
    return marked.join(replaced, [row, version], "left").select(
        *[text if name == column else F.col(f"`{name}`") for name in docs.columns],
        F.when(F.col(found).isNull(), 0).otherwise(F.size(found)).cast("bigint").alias(number),
    )
