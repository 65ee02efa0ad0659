import builtins
import importlib
import sys


def test_contract(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_works_without_the_text_operators(monkeypatch):
    real = builtins.__import__

    def missing(name, globals=None, locals=None, fromlist=(), level=0):
        if name.startswith(("seqloom.llm", "corpus_pipeline")):
            raise ImportError(name)
        return real(name, globals, locals, fromlist, level)

    kept = {k: v for k, v in sys.modules.items() if k.startswith(("seqloom.llm", "corpus_pipeline", "__spark_entry__"))}
    for k in kept:
        monkeypatch.delitem(sys.modules, k)
    monkeypatch.setattr(builtins, "__import__", missing)
    e = importlib.import_module("__spark_entry__")
    assert not any(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in e.queries())
    assert "consensus" in e.queries()
    monkeypatch.delitem(sys.modules, "__spark_entry__")
