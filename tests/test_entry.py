"""The registered queries do not need the optional text operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); print(len(q), sum(n[:2] == 'op' and n[2].isdigit() or n == 'pipeline' for n in q), set(s) <= set(q))"


def copy(to, *without):
    for name in ("__spark_entry__.py", "corpus_pipeline.py", "cartwheel", "registry"):
        source = os.path.join(ROOT, name)
        if name in without or not os.path.exists(source):
            continue
        if os.path.isdir(source):
            left_out = [os.path.basename(w) for w in without if w.startswith(name + "/")]
            shutil.copytree(source, to / name, ignore=shutil.ignore_patterns("__pycache__", *left_out))
        else:
            shutil.copy(source, to / name)


def counted(folder, env=None):
    told = subprocess.run([sys.executable, "-c", COUNT], cwd=folder, capture_output=True, text=True, env=env)
    assert told.returncode == 0, told.stderr
    every, optional, known = told.stdout.split()
    return int(every) - int(optional), int(optional), known


@pytest.mark.parametrize("without", [("cartwheel/llm",), ("cartwheel/llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_queries_without_the_text_operators(tmp_path, without):
    copy(tmp_path, *without)
    rest, optional, known = counted(tmp_path)
    assert rest >= 189 and known == "True"
    if "cartwheel/llm" in without:
        assert optional == 0


def test_queries_without_a_library_of_theirs(tmp_path):
    copy(tmp_path)
    (tmp_path / "ahocorasick.py").write_text("raise ImportError('absent')")
    rest, _optional, known = counted(tmp_path)
    assert rest >= 189 and known == "True"
