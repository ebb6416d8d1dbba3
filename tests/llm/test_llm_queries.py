"""The registered queries at sf0.001."""

import pytest

from turnloom.llm import catalog

FOUND = {
    "p1_found": ["id_a", "id_b"], "p2_found": ["conversation_id", "turn_no", "speaker", "first_line_id", "last_line_id"], "p3_found": ["field_name", "row_id", "pos"], "p4_found": ["field_name", "row_id", "seg", "lang"],
    "p5_found": ["field_name", "row_id", "pos"], "p7_found": ["record_id", "group_id"], "p8_ids": ["doc_id", "ids"], "p10_found": ["doc_id", "kind"],
}


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(name, spark, sf_dir):
    df = catalog.queries()[name](spark, sf_dir)
    if name in FOUND:
        assert df.columns == FOUND[name]
        assert df.count() == df.distinct().count()
    assert df.count() > 0 or name.startswith("p1_")


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(name, agree):
    agree(catalog.queries()[name], catalog.oracle_sql()[name])
