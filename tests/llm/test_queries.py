import importlib
import re

import __spark_entry__ as entry


def test_one_query_per_operator_and_the_pipeline():
    names = entry.queries()
    for n in range(1, 14):
        assert len([q for q in names if re.match(rf"op{n}_", q)]) == 1
    assert "pipeline" in names


def test_the_rest_works_without_the_subpackage(monkeypatch):
    real = importlib.import_module

    def gone(name, *rest):
        if name.startswith(("viewstar.llm", "corpus_pipeline")):
            raise ImportError(name)
        return real(name, *rest)
    monkeypatch.setattr(importlib, "import_module", gone)
    assert not [q for q in entry.queries() if re.match(r"op\d+_|pipeline", q)]
    assert set(entry.queries()) == set(entry.oracle_sql())


def test_nothing_else_imports_the_subpackage():
    from pathlib import Path
    root = Path(entry.__file__).resolve().parent
    for path in [*root.glob("viewstar/**/*.py"), *root.glob("oracle/*.py"), *root.glob("tools/*.py"), root / "bench.py"]:
        if "llm" not in path.relative_to(root).parts:
            assert not re.search(r"\bllm\b", path.read_text()), path
