"""The entry module without the optional package."""

import subprocess
import sys

BLOCKED = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("tidelog.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
names = e.queries()
assert len(names) > 150 and "pipeline" not in names and not any(n.startswith("op1") for n in names)
assert set(e.oracle_sql()) <= set(names)
"""


def test_entry_without_the_optional_package():
    subprocess.run([sys.executable, "-c", BLOCKED], check=True, timeout=120)
