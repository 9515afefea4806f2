"""Schemas of JSON documents: counts of types, chosen types, misfits."""

import pytest
from pyspark.sql import functions as F

from tastemap.sources.documents import (Chosen, choose_types, common_type, document_fields,
                                        inferred_schema, read_documents, typed)

LINES = [
    '{"id": 1, "stars": 4, "who": {"name": "A", "tags": ["x", "y"]}, "a b": true}',
    '{"id": 2, "stars": "five", "who": {"name": null, "tags": []}}',
    '{"id": 3, "stars": 4.5, "who": "nobody", "it\'s": {}}',
    '{"id": 9999999999, "stars": 1e300, "who": {"tags": [["deep"], 7]}}',
    "", "   ", '{"broken": ', "[1, 2]", "null", '"text"',
]


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("json")
    (root / "a.json").write_text("\n".join(LINES))
    return read_documents(spark, str(root)).cache()


def test_lines_are_kept_or_named(documents):
    assert documents.count() == 8
    assert [r.malformed for r in documents.where("malformed IS NOT NULL").collect()] == ['{"broken": ']


def test_every_value_is_counted(documents):
    found = {(r.field, r.type): r.n for r in document_fields(documents, 3).collect()}
    assert found == {
        ("$", "OBJECT"): 4, ("$", "ARRAY"): 1, ("$", "VOID"): 1, ("$", "STRING"): 1,
        ("$[*]", "BIGINT"): 2,
        ("$.id", "BIGINT"): 4, ("$.stars", "BIGINT"): 1, ("$.stars", "STRING"): 1,
        ("$.stars", "DECIMAL"): 1, ("$.stars", "DOUBLE"): 1,
        ("$.who", "OBJECT"): 3, ("$.who", "STRING"): 1, ("$.who.name", "STRING"): 1,
        ("$.who.name", "VOID"): 1, ("$.who.tags", "ARRAY"): 3, ("$.who.tags[*]", "STRING"): 2,
        ("$.who.tags[*]", "ARRAY"): 1, ("$.who.tags[*]", "BIGINT"): 1,
        ("$['a b']", "BOOLEAN"): 1, (r"$['it\'s']", "OBJECT"): 1}


def test_depth_cuts_below_only(documents):
    whole = {tuple(r) for r in document_fields(documents, 4).collect()}
    for depth in (1, 2):
        some = {tuple(r) for r in document_fields(documents, depth).collect()}
        assert some < whole
    assert ("$.who.tags[*][*]", "STRING", 1) in whole


def test_one_reading_without_python(documents, plan):
    text = plan(document_fields(documents))
    assert text.count("InMemoryTableScan") <= 2 and "Python" not in text


def test_types_are_chosen_from_all_values(documents):
    chosen = choose_types(documents, {"id": "$.id", "stars": "$.stars", "name": "$.who.name",
                                      "who": "$.who", "none": "$.none", "flag": "$['a b']"})
    assert chosen == {
        "id": Chosen("$.id", "bigint", 4, 0), "stars": Chosen("$.stars", "string", 4, 0),
        "name": Chosen("$.who.name", "string", 1, 0), "who": Chosen("$.who", "variant", 4, 0),
        "none": Chosen("$.none", "string", 0, 0), "flag": Chosen("$['a b']", "boolean", 1, 0)}
    rows = typed(documents, {n: chosen[n] for n in ("id", "stars", "flag")}).where("id < 3").collect()
    assert sorted(map(tuple, rows)) == [(1, "4", True), (2, "five", None)]


def test_misfits_are_counted(documents):
    chosen = choose_types(documents, {"id": "$.id", "stars": "$.stars"}, id="int", stars="double")
    assert chosen["id"].unfit == 1 and chosen["stars"].unfit == 1
    found = typed(documents, chosen, keep=["malformed"]).agg(F.count("stars"), F.count("id")).first()
    assert tuple(found) == (3, 3)


@pytest.mark.parametrize("types, one", [
    ({"BIGINT"}, "bigint"), ({"BIGINT", "DECIMAL", "VOID"}, "double"), ({"DECIMAL"}, "double"),
    ({"BIGINT", "STRING"}, "string"), ({"OBJECT", "STRING"}, "variant"), (set(), "string"),
    ({"VOID"}, "string"), ({"BOOLEAN", ""}, "boolean")])
def test_common_types(types, one):
    assert common_type(types) == one


def test_inferred_schema(documents):
    objects = documents.where("schema_of_variant(document) LIKE 'OBJECT%'")
    assert "id: BIGINT" in inferred_schema(objects) and "stars: VARIANT" in inferred_schema(objects)


def test_no_documents(spark, documents):
    none = documents.limit(0)
    assert document_fields(none).count() == 0
    assert choose_types(none, {"a": "$.a"}) == {"a": Chosen("$.a", "string", 0, 0)}
