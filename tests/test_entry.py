"""The library's queries do not need what only the training-data operators need."""

import subprocess
import sys

from tests.conftest import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_RUN = """
import sys
sys.path.insert(0, {root!r})
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name.split('.')[0] == {package!r} or name == {package!r}:
            raise ModuleNotFoundError(f'No module named {{name!r}}', name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as e
keys = e.queries()
print(len([k for k in keys if k.startswith('op')]), 'agg_delay_by_tail' in keys, len(e.oracle_sql()) > 80)
"""


def _run(package):
    return subprocess.run([sys.executable, "-c", _RUN.format(root=ROOT, package=package)], capture_output=True, text=True, timeout=120)


def test_a_missing_package_leaves_the_library_alone():
    for package in ("xxhash", "contrail.llm", "corpus_pipeline"):
        out = _run(package)
        assert out.stdout.split()[-3:] == ["0", "True", "True"], (package, out.stderr[-500:])


def test_a_broken_module_of_the_package_is_not_hidden():
    out = _run("contrail.operators.joins")
    assert out.returncode and "contrail.operators.joins" in out.stderr
