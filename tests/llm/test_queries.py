"""The queries of the corpus operators against SQL, where SQL can express them."""

import pytest

from tickspark.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_equals_sql(name, same):
    assert same(Q.QUERIES[name], Q.ORACLES[name])


def test_all_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in names if n.startswith("op")} and "pipeline" in names
