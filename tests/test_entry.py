import importlib
import sys

import __spark_entry__


def test_registry_is_consistent():
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 50 and len(sql) > 45


def test_entry_imports_without_the_training_data_operators(monkeypatch):
    for name in [n for n in sys.modules if n.startswith("lingoloom.llm") or n in ("__spark_entry__", "corpus_pipeline")]:
        monkeypatch.delitem(sys.modules, name)
    find = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name.startswith(("lingoloom.llm", "corpus_pipeline")) else find(name, *a))
    entry = importlib.import_module("__spark_entry__")
    assert not any(n.startswith("op") or n == "pipeline" for n in entry.queries())
