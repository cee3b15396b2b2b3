"""The library without its optional part."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.abspath(entry.__file__))


@pytest.mark.parametrize("gone", ["segflow.llm", "public_tokenizers", "corpus_pipeline"])
def test_entry_imports_without_the_optional_part(gone):
    code = f"import sys; sys.modules['{gone}'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    known = set(entry.queries()) - set(entry.LLM_QUERIES)
    assert done.stdout.split()[-2:] == [str(len(known)), str(len(set(entry.oracle_sql()) - set(entry.LLM_SQL)))]


def test_nothing_else_imports_the_optional_part():
    found = []
    for folder, _, names in os.walk(os.path.join(ROOT, "segflow")):
        if os.path.join("segflow", "llm") in folder:
            continue
        for name in (n for n in names if n.endswith(".py")):
            with open(os.path.join(folder, name), encoding="utf-8") as f:
                if "segflow.llm" in f.read():
                    found.append(name)
    assert found == []
