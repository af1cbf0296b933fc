import importlib
import sys

import __spark_entry__ as entry


def test_every_query_of_the_catalog_has_sql():
    from tidemark.plans import catalog

    assert set(catalog.oracle_sql()) == set(catalog.queries())
    assert set(entry.queries()) >= set(catalog.queries())


def test_entry_without_training_data_operators(monkeypatch):
    """The guard looks for the subpackage; without it all other queries stay."""
    monkeypatch.setattr(entry.importlib.util, "find_spec", lambda name: None)
    try:
        bare = importlib.reload(entry)
        assert not bare.HAS_LLM and "top_pages" in bare.queries() and "pipeline" not in bare.queries()
    finally:
        monkeypatch.undo()
        importlib.reload(sys.modules["__spark_entry__"])


def test_flagship_runs(spark):
    assert entry.entry(spark).count() > 0
