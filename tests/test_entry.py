import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOWN = "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') for n in e.queries()), 'pipeline' in e.queries())"


def shown(folder):
    return subprocess.run([sys.executable, "-c", SHOWN], cwd=folder, capture_output=True, text=True, timeout=120)


def test_entry_without_text_operators(tmp_path):
    """Without their folder the other queries are still there, with or without the pipeline's file."""
    copy = tmp_path / "repo"
    ignored = shutil.ignore_patterns("llm", ".git", "__pycache__", "tests")
    shutil.copytree(ROOT, copy, ignore=ignored)
    for _ in range(2):
        done = shown(copy)
        assert done.returncode == 0, done.stderr
        n, texts, pipeline = done.stdout.split()[-3:]
        assert int(n) > 60 and texts == pipeline == "False"
        if (copy / "corpus_pipeline.py").exists():
            (copy / "corpus_pipeline.py").unlink()
