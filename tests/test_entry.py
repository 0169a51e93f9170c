"""What the contract module does without the parts that may be missing."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

TOP = Path(__file__).resolve().parents[1]
COUNT = """
import sys
sys.modules[{name!r}] = None
import __spark_entry__ as contract
from lexmill.plans.registry import QUERIES
assert set(contract.queries()) == set(contract.oracle_sql()) == set(QUERIES)
"""


@pytest.mark.parametrize("name", ["regex", "sentencepiece", "public_tokenizers", "lexmill.llm", "corpus_pipeline"])
def test_core_queries_stay_without(name):
    subprocess.run([sys.executable, "-c", COUNT.format(name=name)], cwd=TOP, check=True, timeout=120)


def test_other_missing_modules_raise():
    code = COUNT.format(name="lexmill.plans.oracles")
    assert subprocess.run([sys.executable, "-c", code], cwd=TOP, capture_output=True, timeout=120).returncode
