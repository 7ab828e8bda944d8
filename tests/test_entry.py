"""The entry module with and without its optional parts."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; q = e.queries(); print(len(q), sum(n.startswith('op') and n[2].isdigit() for n in q), 'pipeline' in q, set(e.oracle_sql()) <= set(q))"


def shown(folder, code=SHOW):
    return subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=folder, capture_output=True, text=True, timeout=120,
                          env={**os.environ, "PYTHONPATH": str(folder) + os.pathsep + os.environ.get("PYTHONPATH", "")})


def copied(tmp_path, *without):
    skip = lambda folder, names: {n for n in names if n in ("__pycache__", ".git", ".tmp") or os.path.relpath(os.path.join(folder, n), ROOT) in without}
    shutil.copytree(os.path.join(ROOT, "sumweave"), tmp_path / "sumweave", ignore=skip)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in without and os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), tmp_path)
    return tmp_path


def test_entry_without_the_optional_folder(tmp_path):
    out = shown(copied(tmp_path, "sumweave/llm"))
    assert out.returncode == 0, out.stderr
    number, operators, pipeline, known = out.stdout.split()
    assert int(number) > 100 and (operators, pipeline, known) == ("0", "False", "True")


def test_entry_without_a_package_of_the_optional_part(tmp_path):
    copied(tmp_path)
    (tmp_path / "tiktoken.py").write_text("raise ImportError('not installed')\n")
    out = shown(tmp_path)
    assert out.returncode == 0 and out.stdout.split()[1:3] == ["0", "False"], out.stderr
