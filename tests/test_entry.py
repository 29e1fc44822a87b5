"""The entry module gives the fraud queries whatever the optional subpackage lacks."""

import subprocess
import sys

import pytest

CODE = """
import sys, warnings

class Block:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError("blocked", name=name)

sys.meta_path.insert(0, Block())
import __spark_entry__ as e
with warnings.catch_warnings(record=True) as said:
    warnings.simplefilter("always")
    found, sql = e.queries(), e.oracle_sql()
assert "fraud_score" in found and "fraud_score" in sql and set(sql) <= set(found)
print(sum(n.startswith("op") for n in found), "pipeline" in found, any("blocked" in str(w.message) for w in said))
"""


@pytest.mark.parametrize("name, left, said", [("public_tokenizers", "0", True), ("xxhash", "13", True), ("vigilake.llm", "0", False)])
def test_without(name, left, said):
    """xxhash is imported by the pipeline's near-dedup alone."""
    pytest.importorskip("vigilake.llm")
    out = subprocess.run([sys.executable, "-c", CODE.format(name=name)], capture_output=True, text=True, check=True, timeout=120)
    assert out.stdout.split() == [left, "False", str(said)]


def test_without_the_pipeline():
    pytest.importorskip("vigilake.llm")
    out = subprocess.run([sys.executable, "-c", CODE.format(name="corpus_pipeline")], capture_output=True, text=True, check=True, timeout=120)
    assert out.stdout.split() == ["13", "False", "False"]
