"""The main library does not need the optional one."""

import subprocess
import sys

CODE = """
import sys
class Refuse:
    def find_spec(self, name, path=None, target=None):
        if name == {blocked!r}:
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Refuse())
import __spark_entry__ as e
q = e.queries()
print(len(q), any(k.startswith('op1_') for k in q), 'pipeline' in q)
"""


def test_queries_without_an_extra_or_the_subpackage():
    for blocked in ("regex", "tidemark.llm"):
        out = subprocess.run([sys.executable, "-c", CODE.format(blocked=blocked)], capture_output=True, text=True, cwd=__file__.rsplit("/", 2)[0], timeout=120)
        n, with_ops, with_pipeline = out.stdout.split()
        assert int(n) > 150 and with_ops == "False" and with_pipeline == "False", out.stderr
