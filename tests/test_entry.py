"""The driver contract without the optional subpackage."""

import importlib
import sys

import pytest

import __spark_entry__ as driver
from assayflow.queries import QUERIES, SQL


@pytest.mark.parametrize("missing", ["corpus_pipeline", "assayflow.llm", "assayflow.llm.queries"])
def test_entry_works_without_the_optional_parts(monkeypatch, missing):
    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("assayflow.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)
    bare = importlib.reload(driver)
    assert bare.queries() == QUERIES and bare.oracle_sql() == SQL


def test_other_missing_modules_are_errors(monkeypatch):
    monkeypatch.setitem(sys.modules, "assayflow.queries", None)
    with pytest.raises(ImportError):
        importlib.reload(driver)


@pytest.fixture(autouse=True)
def restore():
    yield
    importlib.reload(driver)
