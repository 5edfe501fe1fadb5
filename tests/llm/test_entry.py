"""The entry without libraries of this package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

CODE = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] in sys.argv[1:]:
            raise ImportError(name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
names = set(entry.queries())
assert "matches" in names and not any(n.startswith("op") for n in names) and "pipeline" not in names, names
assert set(entry.oracle_sql()) <= names
"""


def test_entry_without_libraries():
    for missing in ("zstandard", "xxhash", "duelspark.llm"):
        code = CODE.replace('name.split(".")[0] in', "name in") if "." in missing else CODE
        subprocess.run([sys.executable, "-c", code, missing], cwd=ROOT, check=True, timeout=120)
