"""What runs on executors must not need the package to be installed there."""

import subprocess
import sys

import pytest
from pyspark.serializers import CloudPickleSerializer

from recollect.functions.signatures import planes
from recollect.operators import nearest
from recollect.plans.embedding import hashing_model
from recollect.streaming.stateful import SessionTranscripts



@pytest.mark.parametrize(
    "shipped", [nearest._scan, nearest._Block, SessionTranscripts(), hashing_model],
    ids=["scan", "block", "state", "model"],
)
def test_loads_in_a_bare_process(tmp_path, shipped):
    file = tmp_path / "task.pkl"
    file.write_bytes(CloudPickleSerializer().dumps(shipped))
    code = f"import pickle; pickle.load(open({str(file)!r}, 'rb'))"
    done = subprocess.run([sys.executable, "-c", code], cwd="/", capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_planes_are_small_and_balanced():
    matrix = planes(256, 1024)
    assert matrix.nbytes == 256 * 1024
    assert abs(int(matrix.sum(dtype=int))) < 0.02 * matrix.size
