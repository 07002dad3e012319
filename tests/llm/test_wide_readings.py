"""Decontamination of the pipeline: items in other case, names that start sentences, longer names, shifted words."""

from spanlight.llm import decontaminate

ASKED = ("Natalia sold clips to 48 of her friends in April. Natalia then sold half as many clips in May. "
         "How many clips did Natalia sell altogether in April and May?")
AGAIN = ASKED.replace("Natalia", "Miriam").replace("48", "62").replace("April", "June").replace("May", "July")
CLEAN = ("Natalia sang songs for 48 of the guests in April. Natalia then ate half a dozen pies in May. "
         "Where in the town did Natalia live in April and May?")


def _kept(spark, documents, *texts):
    bench = spark.createDataFrame([(0, ASKED)], "item_id long, text string")
    shell = "Some other words stand before it.\n%s\nAnd other words stand behind it."
    return [r.doc_id for r in decontaminate.decontaminate(documents([(i, shell % t) for i, t in enumerate(texts)]), bench).collect()]


def test_common_forms_are_found(spark, documents):
    forms = [ASKED, AGAIN, ASKED.lower(), ASKED.upper(), AGAIN.replace("Miriam", "Miriam Stone"),
             CLEAN, AGAIN.replace("How many clips did Miriam", "How many clips did Sarah"), "x"]
    assert sorted(_kept(spark, documents, *forms)) == [5, 6, 7]


def test_a_word_put_in_does_not_part_an_occurrence(spark, documents):
    """Each side of the word covers less than 0.8 of the item, both together more."""
    item = " ".join(f"{a}{b}" for a in ("red", "green", "blue", "white", "black", "brown") for b in "abcdefghij")
    bench = spark.createDataFrame([(0, item)], "item_id long, text string")
    rows = [(1, item.replace("whitea", "very whitea")), (2, item.replace("whitea ", "")), (3, " ".join(item.split()[:30]))]
    assert decontaminate.leaks(documents(rows), bench).count() == 0
    assert [r.doc_id for r in decontaminate.decontaminate(documents(rows), bench).collect()] == [3]
