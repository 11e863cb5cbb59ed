"""The entry module imports with and without the llm subpackage."""

import builtins
import importlib

import pytest

import __spark_entry__


def test_queries_have_names_and_sql():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_without_the_subpackage(monkeypatch):
    real = builtins.__import__

    def refuse(name, *args, **more):
        if name.startswith(("tessera.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(name, name=name)
        return real(name, *args, **more)

    monkeypatch.setattr(builtins, "__import__", refuse)
    try:
        module = importlib.reload(__spark_entry__)
        assert "match_exact" in module.queries() and "pipeline" not in module.queries()
    finally:
        monkeypatch.undo()
        importlib.reload(__spark_entry__)


def test_a_broken_import_inside_is_not_hidden(monkeypatch):
    real = builtins.__import__

    def refuse(name, *args, **more):
        if name == "corpus_pipeline":
            raise ModuleNotFoundError("no module numpyx", name="numpyx")
        return real(name, *args, **more)

    monkeypatch.setattr(builtins, "__import__", refuse)
    try:
        with pytest.raises(ModuleNotFoundError):
            importlib.reload(__spark_entry__)
    finally:
        monkeypatch.undo()
        importlib.reload(__spark_entry__)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
