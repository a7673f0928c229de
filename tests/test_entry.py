"""The entry module stands without the training-data operators, or without what they are built on."""

import subprocess
import sys
from pathlib import Path

import pytest

from cdcstrata.checks import oracle, registered

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("missing", ["ahocorasick", "tokenizers", "sentencepiece", "xxhash", "cdcstrata.llm", "corpus_pipeline"])
def test_core_queries_are_left(missing):
    code = (
        f"import sys, warnings; sys.modules[{missing!r}] = None; warnings.simplefilter('ignore')\n"
        "import __spark_entry__ as e\n"
        "print(len(e.queries()), len(e.oracle_sql()))"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert done.stdout.split() == [str(len(registered.queries())), str(len(oracle.oracle_sql()))]
