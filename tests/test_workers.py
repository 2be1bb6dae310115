"""Functions that run in Python workers must not need the package there."""

import base64
import subprocess
import sys

from pyspark import cloudpickle

from ledgerlens.operators import chain, limits


def test_worker_functions_travel_by_value(tmp_path):
    for fn, check in ((limits.BUCKET.step, "f((5, 1, 1, 10, None, None), None)[0] == (True, 0, 0, 5)"), (chain._sealer(b"k"), "list(f(iter([]))) == []")):
        payload = base64.b64encode(cloudpickle.dumps(fn)).decode()
        code = f"import base64, pickle; f = pickle.loads(base64.b64decode('{payload}')); assert {check}; import sys; assert 'ledgerlens' not in sys.modules"
        subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin"})
