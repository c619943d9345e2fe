"""The entry point without the optional parts: everything else imports and runs."""

import json
import pathlib
import shutil
import subprocess
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
SCRIPT = """
import json, sys
import __spark_entry__ as e
from mqtable.session import local_session
n = e.queries()["count_messages"](local_session(2), "/root/testdata/sf0.001").count()
print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql()), n]))
"""


@pytest.mark.parametrize("gone", [["mqtable/llm", "tests/llm"], ["mqtable/llm", "tests/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_entry_without_the_optional_parts(tmp_path, gone):
    copy = tmp_path / "repo"
    left_out = {str(ROOT / g) for g in gone}
    shutil.copytree(ROOT, copy, ignore=lambda d, names: [n for n in names if n.startswith(".") or n == "__pycache__" or str(pathlib.Path(d) / n) in left_out])
    run = subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr[-2000:]
    queries, oracles, n = json.loads(run.stdout.strip().splitlines()[-1])
    assert n == 4 and set(oracles) <= set(queries) and "pipeline" not in queries
    assert any(q.startswith("op") for q in queries) == (gone == ["corpus_pipeline.py"])
