import pytest

from storelake.sources.catalog import CATALOG, UnknownTable, spec_of


def test_twelve_tables_each_with_key_and_version_column():
    assert len(CATALOG) == 12
    for spec in CATALOG.values():
        assert spec.key in spec.column_names
        assert spec.version in spec.column_names
        assert set(spec.tie_break) <= set(spec.column_names)


def test_tenant_is_not_a_source_column_but_leads_the_raw_table():
    for spec in CATALOG.values():
        assert "tenant_id" not in spec.column_names
        assert spec.raw_schema.names[0] == "tenant_id"
        assert spec.raw_schema.names[-1] == "_extracted_at"


def test_money_is_decimal():
    kinds = {f.name: f.dataType.simpleString() for f in spec_of("transaction_items").source_schema}
    assert kinds["subtotal"] == kinds["unit_price"] == kinds["discount"] == "decimal(18,2)"


def test_unknown_table_is_an_error():
    with pytest.raises(UnknownTable):
        spec_of("nope")
