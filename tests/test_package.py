import os
import subprocess
import sys

import pytest
from pyspark import cloudpickle

from tidings.operators.kmeans import _Partials
from tidings.operators.noise import box_points


def test_functions_travel_without_the_package(tmp_path):
    path = tmp_path / "functions.pkl"
    path.write_bytes(cloudpickle.dumps((box_points, _Partials)))
    code = (
        "import pickle, sys, numpy as np\n"
        "points, Partials = pickle.load(open(sys.argv[1], 'rb'))\n"
        "x = points(np.arange(3), np.zeros(2), np.ones(2), 0)\n"
        "p = Partials((1,), np.zeros((1, 1, 2))); p.add(0, x)\n"
        "print(p.batch().num_rows, 'tidings' in sys.modules)\n"
    )
    out = subprocess.run([sys.executable, "-c", code, str(path)], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert out.stdout.split() == ["1", "False"]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_queries_run_where_workers_cannot_import_the_package(tmp_path):
    """A session in another folder, whose workers have no path to this one: broadcasts hold plain values only."""
    code = (
        "import sys, os\n"
        "root, sf = sys.argv[1:3]\n"
        "os.environ.pop('PYTHONPATH', None)\n"
        "sys.path.insert(0, root)\n"
        "import __spark_entry__ as entry\n"
        "from tidings.session import build_session\n"
        "spark = build_session('local[2]', 'away', **{'spark.sql.shuffle.partitions': '2', 'spark.ui.showConsoleProgress': 'false'})\n"
        "spark.range(1).mapInArrow(lambda it: it, 'id long').collect()\n"
        "def missing(batches):\n"
        "    import importlib.util\n"
        "    for b in batches:\n"
        "        assert importlib.util.find_spec('tidings') is None\n"
        "        yield b\n"
        "spark.range(1).mapInArrow(missing, 'id long').collect()\n"
        "found = entry.queries()\n"
        "names = [n for n in sys.argv[3:] if n in found]\n"
        "for n in names:\n"
        "    found[n](spark, sf).collect()\n"
        "print('ran', len(names))\n"
    )
    names = ["wordpiece_ids", "token_spans", "page_text", "partition_handler", "frame_searches", "op2_language_id", "op4_toxicity", "op11_resampling", "op12_alignment"]
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code, root, "/root/testdata/sf0.001", *names], cwd=tmp_path, capture_output=True, text=True, timeout=900)
    assert "ran" in out.stdout, out.stderr[-3000:]
