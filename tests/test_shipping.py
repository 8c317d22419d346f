"""Kernels run in Python workers that may not have this package installed:
they must unpickle and run without importing it."""

import base64
import os
import subprocess
import sys

from pyspark import cloudpickle

from shelfrank.operators import blocked


def test_kernel_runs_without_the_package(tmp_path):
    payload = base64.b64encode(cloudpickle.dumps(blocked.threshold_pairs)).decode()
    code = (
        "import base64, numpy as np\n"
        "from pyspark import cloudpickle\n"
        "import sys\n"
        "assert 'shelfrank' not in sys.modules\n"
        f"f = cloudpickle.loads(base64.b64decode('{payload}'))\n"
        "u = np.array([[1.0, 0.0], [1.0, 0.0], [0.0, 1.0]])\n"
        "a, b, s = f(np.arange(3), u, np.arange(3), u, 0.5, True)\n"
        "print(sorted(zip(a.tolist(), b.tolist())))\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.strip().endswith("[(0, 1), (1, 0)]")
