"""Driver contract: entry(), queries()/oracle_sql() consistency, and oracles at sf0.001."""

import os
import sys

import pytest

from conftest import SF001

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "rsi_14" in df.columns


def test_contract_keys():
    import __spark_entry__ as E
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 60


def test_entry_without_the_text_operators(monkeypatch):
    import builtins
    import __spark_entry__ as E
    real = builtins.__import__

    def gone(name, *args, **kw):
        if name.startswith(("marketframe.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(f"No module named '{name}'", name=name)
        return real(name, *args, **kw)
    monkeypatch.setattr(builtins, "__import__", gone)
    assert not [n for n in E.queries() if n.startswith("op") or n == "pipeline"]
    assert len(E.oracle_sql()) >= 55


@pytest.fixture(scope="module")
def oracle_results(spark):
    from check_oracles import compare
    import __spark_entry__ as E
    return compare(spark, SF001, list(E.oracle_sql()), verbose=False)


def test_oracles_match(oracle_results):
    bad = {k: v for k, v in oracle_results.items() if v.get("ok") is False}
    assert not bad, bad
