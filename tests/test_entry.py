"""The entry's queries without the training-data operators: folders gone, or a library of theirs missing."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

BLOCK = """
import sys, warnings
warnings.simplefilter("ignore")
class Block:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {0!r} or name == {0!r}:
            raise ImportError(name)
sys.meta_path.insert(0, Block())
sys.path.insert(0, {1!r})
from __spark_entry__ import oracle_sql, queries
names = set(queries())
assert "click_counts" in names and "stream_resume" in names
assert not any(n.startswith("op") for n in names) or {2!r} == "kept", names
assert set(oracle_sql()) <= names
print(len(names))
"""


def _names(blocked, state="gone"):
    code = BLOCK.format(blocked, str(ROOT), state)
    return int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout)


def test_the_other_queries_stay_when_the_operators_cannot_be_imported():
    without = _names("adpulse.llm")
    assert without == _names("adpulse.llm.catalog")
    assert without < _names("no_such_module", "kept") or not (ROOT / "adpulse" / "llm").exists()


def test_a_missing_library_of_the_operators_leaves_the_other_queries():
    assert _names("zstandard") == _names("adpulse.llm") or not (ROOT / "adpulse" / "llm").exists()
