"""The contract module with parts of the optional half missing."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("missing", ["zstandard", "regex", "casemill.llm", "corpus_pipeline"])
def test_case_queries_are_there_whatever_the_optional_part_lacks(missing):
    code = (
        f"import sys; sys.modules[{missing!r}] = None\n"
        "import __spark_entry__ as e\n"
        "names = list(e.queries())\n"
        "assert len(names) > 70 and set(e.oracle_sql()) <= set(names)\n"
        "assert not [n for n in names if n.startswith('op') or n == 'pipeline']\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert missing.split(".")[-1] in done.stderr
