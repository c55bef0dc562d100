import importlib
import importlib.util
import sys


def test_entry_has_the_engine(spark):
    import __spark_entry__ as e

    assert {"bar_ohlcv", "bars_flat"} <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


def test_entry_without_corpus(monkeypatch):
    """Nothing but the entry knows of the optional subpackage."""
    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda n, p=None: None if n.startswith(("tickloom.llm", "corpus_pipeline")) else real(n, p))
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
    e = importlib.import_module("__spark_entry__")
    assert "bar_ohlcv" in e.queries() and "pipeline" not in e.queries() and not any(k.startswith("op") for k in e.queries())
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
