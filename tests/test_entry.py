"""The entry module without the optional parts."""

from types import SimpleNamespace

import pytest

import __spark_entry__ as entry


@pytest.mark.parametrize("missing", ["corpus_pipeline", "quarry.llm", "quarry.llm.queries", "zstandard", "sentencepiece", "xxhash", "public_tokenizers"])
def test_other_keys_stay_where_llm_is_missing(monkeypatch, missing):
    def fail(module):
        raise ModuleNotFoundError(f"No module named {missing!r}", name=missing)
    monkeypatch.setattr(entry, "importlib", SimpleNamespace(import_module=fail))
    assert "rate_by_one" in entry.queries() and "rate_by_one" in entry.oracle_sql()
    assert not any(k.startswith("op") or k == "pipeline" for k in entry.queries())


def test_other_errors_are_not_swallowed(monkeypatch):
    def fail(module):
        raise ModuleNotFoundError("No module named 'quarry.plans.tables'", name="quarry.plans.tables")
    monkeypatch.setattr(entry, "importlib", SimpleNamespace(import_module=fail))
    with pytest.raises(ModuleNotFoundError):
        entry.queries()
