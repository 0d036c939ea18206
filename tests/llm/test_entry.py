"""The entry works without the text operators, and does not hide other errors."""

import importlib
import sys

import pytest

import __spark_entry__ as driver


@pytest.fixture
def reload_entry():
    kept = {n: m for n, m in sys.modules.items() if n == "corpus_pipeline" or n.startswith("farebox.llm")}
    yield lambda: importlib.reload(driver)
    sys.modules.update(kept)
    importlib.reload(driver)


def without(monkeypatch, missing):
    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("farebox.llm")]:
        monkeypatch.delitem(sys.modules, name)

    class Hidden:
        def find_spec(self, name, path=None, target=None):
            if name == missing:
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    monkeypatch.setattr(sys, "meta_path", [Hidden(), *sys.meta_path])


@pytest.mark.parametrize("missing", ["corpus_pipeline", "farebox.llm"])
def test_left_out(monkeypatch, reload_entry, missing):
    without(monkeypatch, missing)
    entry = reload_entry()
    assert not [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert len(entry.queries()) >= 72 and set(entry.oracle_sql()) == set(entry.queries())


def test_other_missing_modules_are_errors(monkeypatch, reload_entry):
    monkeypatch.delitem(sys.modules, "zstandard", raising=False)
    without(monkeypatch, "zstandard")
    with pytest.raises(ModuleNotFoundError):
        reload_entry()


def test_all_operators_are_registered():
    names = list(driver.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
