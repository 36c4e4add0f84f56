"""Python workers find the package wherever the driver runs."""

import os
import subprocess
import sys


def test_an_operator_runs_from_another_folder(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = (
        f"import sys; sys.path.insert(0, {root!r})\n"
        "import __spark_entry__ as e\n"
        "from strata.session import get_session\n"
        "spark = get_session(master='local[2]', shuffle_partitions=2)\n"
        "print('rows', e.queries()['op10_covering_simhash'](spark, '/root/testdata/sf0.001').count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, env=env, timeout=600)
    assert "rows 200" in out.stdout, out.stderr[-3000:]
