"""What a Python worker of the Jaccard join keeps."""

import subprocess
import sys
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa

from colsense.llm import jaccard


def test_workers_do_without_pandas():
    code = "import sys, colsense.llm.jaccard; sys.exit('pandas' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[2]).returncode == 0


def test_sets_take_little_memory():
    text = " ".join(np.random.default_rng(1).choice(["alpha", "beta", "gamma", "delta", "epsilon"], 20).tolist())
    texts = pa.array([f"{i} {text}" for i in range(8000)])  # 1 MB
    list(jaccard._sets(texts.slice(0, 10), 5))
    tracemalloc.start()
    for _ in jaccard._sets(texts, 5):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12e6
