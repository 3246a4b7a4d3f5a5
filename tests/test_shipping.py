import subprocess
import sys

import pytest
from pyspark import cloudpickle

from surveylake.sources import archives, delimited


@pytest.mark.parametrize(
    "function",
    [archives._unpack_contents, archives._unpack_members, archives._list_members, delimited._first_lines],
)
def test_task_functions_load_where_the_package_is_not_installed(function, tmp_path):
    load = "import sys, pickle; f = pickle.load(sys.stdin.buffer); assert callable(f); assert list(f(iter([]))) == []"
    packed = cloudpickle.dumps(function)
    subprocess.run([sys.executable, "-I", "-c", load], input=packed, cwd=tmp_path, check=True)
