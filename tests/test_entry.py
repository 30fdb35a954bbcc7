"""The package stands without its optional text part."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_text_operators(tmp_path):
    """Imported from a copy that has neither stayline/llm nor corpus_pipeline.py."""
    for name in ("__spark_entry__.py", "stayline"):
        source = os.path.join(REPO, name)
        if name.endswith(".py"):
            os.symlink(source, tmp_path / name)
        else:
            os.mkdir(tmp_path / name)
            for part in os.listdir(source):
                if part not in ("llm", "__pycache__"):
                    os.symlink(os.path.join(source, part), tmp_path / name / part)
    # the entry puts its own folder in front, so it is read as text and run from the copy
    code = ("import sys; sys.path.insert(0, '.'); src = open('__spark_entry__.py').read(); space = {'__file__': sys.argv[1]}; "
            "exec(compile(src, sys.argv[1], 'exec'), space); q = space['queries'](); "
            "assert 'churn_rate_by_group' in q and 'pipeline' not in q and not any(k.startswith('op') and k[2:3].isdigit() for k in q)")
    done = subprocess.run([sys.executable, "-B", "-c", code, str(tmp_path / "__spark_entry__.py")], cwd=tmp_path,
                          env={**os.environ, "PYTHONPATH": ""}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_the_text_operators():
    for folder, _, files in os.walk(os.path.join(REPO, "stayline")):
        if os.path.basename(folder) in ("llm", "__pycache__"):
            continue
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(folder, name), encoding="utf-8") as f:
                    assert "stayline.llm" not in f.read(), name
