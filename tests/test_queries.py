import pytest
from conftest import SF, same

from corpusmill.plans import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    same(registry.queries()[name](spark, SF), registry.oracle_sql()[name])


def test_entry_imports_and_has_a_schema(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["lang", "n_docs", "n_pass", "n_kept", "kept_bytes"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
