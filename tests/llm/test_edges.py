"""Every operator over odd rows: all rows come back, the same with further columns, none from an empty table."""

from __future__ import annotations

import pytest
from conftest import rows

from tarmac.llm import decontaminate, html, language, licenses, minhash, packing, quality, quotes, secrets, substrings
from tarmac.llm.queries import VOCABULARY

OPERATORS = {
    "secrets": secrets.secrets,
    "licenses": licenses.licenses,
    "repeats": substrings.remove_repeats,
    "near duplicates": minhash.near_duplicates,
    "language": language.identify,
    "packing": lambda docs: packing.pack(docs, VOCABULARY).drop("sequence_id", "offset"),
    "quality": lambda docs: quality.quality(docs).drop("row"),
}
STAGES = {
    "quality": quality.keep_good,
    "near duplicates": minhash.drop_near_duplicates,
    "secrets": secrets.redact,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(name, odd, crowded, empty):
    operator = OPERATORS[name]
    found = operator(odd)
    if name not in ("licenses", "packing"):
        assert found.count() == odd.count()
    assert rows(operator(crowded)) == rows(found)
    assert operator(empty).count() == 0


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_the_columns(name, odd, crowded, empty):
    stage = STAGES[name]
    assert stage(crowded).columns == crowded.columns
    assert rows(stage(crowded).select(*odd.columns)) == rows(stage(odd))
    assert stage(empty).count() == 0


def test_decontamination_of_odd_rows(spark, odd, crowded, empty):
    items = spark.createDataFrame([(1, None), (None, "one two three four five six"), (3, ""), (4, "short")], "item_id BIGINT, text STRING")
    assert decontaminate.decontaminate(odd, items).count() == odd.count()
    assert decontaminate.decontaminate(crowded, items).columns == crowded.columns
    assert decontaminate.contaminated(empty, items).count() == 0
    assert rows(decontaminate.decontaminate(odd, items.limit(0))) == rows(odd)


def test_pages_of_odd_rows(spark):
    schema = "page_id BIGINT, url STRING, html STRING, text STRING"
    deep = "<p>" * 2000 + "end"
    odd = [(1, None, None, "x"), (None, "u", "", "x"), (2, "u", "<<<>>&&amp;<p", "x"), (3, "u", deep, "x"), (3, "u", deep, "x")]
    found = html.extract(spark.createDataFrame(odd, schema))
    assert rows(found, "page_id", "text") == [(1, ""), (2, "<<<>>&&"), (3, "end"), (3, "end"), (None, "")]
    assert html.extract(spark.createDataFrame([], schema)).count() == 0


def test_messages_of_odd_rows(spark):
    schema = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, lines STRING, reply_to STRING"
    odd = [(None, 1, "user", "a", None, None), (1, None, None, None, None, None), (1, 1, "user", None, None, None), (1, 1, "user", "> q\n", None, None), (1, 1, "user", "> q\n", None, None)]
    linked = quotes.link_quotations(spark.createDataFrame(odd, schema))
    assert linked.count() == len(odd)
    assert {r["reply_to"] for r in linked.collect()} == {None}
    assert quotes.link_quotations(spark.createDataFrame([], schema)).count() == 0
