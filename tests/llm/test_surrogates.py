import re

from pyspark.sql import functions as F

from tidemark.llm import surrogates as op

TEXT = (
    "Mr. John Smith met Mrs Anna Baker; Анна Петрова wrote to anna.b@mail.test.org, then +1 (212) 555-7713, "
    "4111 1111 1111 1111 and 4111111111111112, 123-45-6789, 10.20.30.40 and a0b1c2d3e4f5a0b1c2d3e4f5a0b1c2d3."
)


def luhn(number):
    digits = [int(c) for c in re.sub(r"\D", "", number)]
    return sum(sum(divmod(2 * d, 10)) if i % 2 == len(digits) % 2 else d for i, d in enumerate(digits)) % 10 == 0


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, N_REPLACED int")


def test_kinds_formats_and_coreference(spark):
    rows = frame(spark, [(1, TEXT, 0), (2, "Again anna.b@mail.test.org and Mr. John Smith.", 0), (3, TEXT, 0)])
    got = {r["doc_id"]: r for r in op.replace_entities(rows, "k").collect()}
    assert got[1]["n_replaced_"] == 10 and got[1]["text"] == got[3]["text"]
    text = got[1]["text"]
    for real in ("Smith", "Baker", "Петрова", "anna.b", "7713", "4111", "123-45", "10.20", "a0b1"):
        assert real not in text
    match = re.fullmatch(
        r"Mr\. (\w+) \w+ met Mrs (\w+) \w+; (\w+) [а-яА-Я]+ wrote to ([a-z]{4}\.[a-z]@mail-\w+\.example), then \+1 \(\d{3}\) \d{3}-\d{4}, "
        r"(\d{4} \d{4} \d{4} \d{4}) and (\d{16}), \d{3}-\d{2}-\d{4}, (2[45]\d(?:\.\d+){3}) and [0-9a-f]{32}\.",
        text,
    )
    assert match
    assert match[1] in op.MALE_NAMES["latin"] and match[2] in op.FEMALE_NAMES["latin"] and match[3] in op.FEMALE_NAMES["cyrillic"]
    assert luhn(match[5]) and not luhn(match[6])
    assert match[4] in got[2]["text"] and f"Mr. {match[1]}" in got[2]["text"]
    other = op.replace_entities(rows, "another key").where("doc_id = 1").first()["text"]
    assert other != text


def test_collisions_are_drawn_again(spark):
    # Mailboxes of one letter at one domain: more than there are letters, so that some have to grow.
    values = [f"{letter}@mail.test.org" for letter in "abcdefghijklmnopqrstuvwxyz0123456789"]
    entities = spark.createDataFrame([("email", value) for value in values], "kind string, value string")
    rows = op.assign(entities, "k").collect()
    assert sorted(r["value"] for r in rows) == sorted(values)
    assert len({r["surrogate"] for r in rows}) == len(values)
    first = entities.select(op.surrogate(F.col("kind"), F.col("value"), "k", 0).alias("s"))
    taken = [r["s"] for r in first.collect()]
    assert len(set(taken)) < len(values)
    # A surrogate that really occurs is not used.
    more = entities.union(first.select(F.lit("email"), "s"))
    found = op.assign(more, "k").collect()
    assert not {r["surrogate"] for r in found} & {r["value"] for r in found}


def test_odd_documents(spark, odd, empty):
    got = op.replace_entities(odd, "k")
    assert got.columns == [*odd.columns, "n_replaced"]
    assert sorted((repr(r["doc_id"]), repr(r["text"])) for r in got.collect()) == sorted((repr(r["doc_id"]), repr(r["text"])) for r in odd.collect())
    assert op.replace_entities(empty, "k").count() == 0


def test_what_is_no_entity_stays(spark):
    text = "Version 1.2.3.4.5, 12345-67-8901, 999.1.2.3, hex abcdef, a@b, +5, 41111111111111111, Johnson Smith."
    assert op.replace_entities(frame(spark, [(1, text, 0)]), "k").first()["text"] == text


def test_no_python_in_the_plan(spark):
    plan = op.replace_entities(frame(spark, [(1, TEXT, 0)]), "k")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
