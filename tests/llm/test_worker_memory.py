"""What a Python worker keeps between tasks, beside the JVM, and what the tokens of documents are counted in."""

from __future__ import annotations

import subprocess
import sys

import numpy as np

from editpulse.llm import packing

_FREED = """
import re, sys
import numpy as np
import pyarrow as pa
sys.path.insert(0, sys.argv[1])
from editpulse.llm.batches import slices

def held():
    return int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) // 1024

small = [np.ones(8000) for _ in range(4000)]
# The last block stays in use, so what is free below it does not go back by itself.
top, before = small.pop(), held()
small.clear()
list(slices(iter([pa.record_batch({"text": ["a"]})]), "text"))
print(before - held())
"""


def test_freed_memory_goes_back_at_the_end_of_a_task():
    root = packing.__file__.rsplit("/editpulse/", 1)[0]
    done = subprocess.run([sys.executable, "-c", _FREED, root], capture_output=True, text=True, check=True)
    assert int(done.stdout) > 150


def test_documents_with_each_token():
    rng = np.random.default_rng(5)
    for texts in ([], [[]], [[7], [], [7, 7, 3]], [list(rng.integers(0, 60000, n)) for n in (0, 5, 4000, 1)], [[70000]] * 70000):
        ids = np.array([x for text in texts for x in text], np.uint32)
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        found = packing._holders(ids, offsets)
        wanted = np.zeros(len(found), np.int64)
        for text in texts:
            wanted[list(set(map(int, text)))] += 1
        assert found.tolist() == wanted.tolist()
