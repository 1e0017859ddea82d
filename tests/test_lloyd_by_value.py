"""The passes of k-means run on executors that have no copy of this library."""

import os
import subprocess
import sys

from pyspark import cloudpickle

from spendgrid.operators import lloyd


def test_functions_load_where_the_library_is_missing(tmp_path):
    code = "import pickle, sys; import numpy as np; f = pickle.load(sys.stdin.buffer); print(f(np.zeros((1, 2)), np.ones((3, 2))).tolist())"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], input=cloudpickle.dumps(lloyd._squared), cwd=tmp_path, env=env, capture_output=True)
    assert done.stdout.decode().strip() == "[[2.0, 2.0, 2.0]]", done.stderr.decode()
