"""Python workers give back what a task no longer holds."""

import ctypes
import os
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest

from marinelake.llm import common, language

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
WORKER = """
import re
import pyarrow as pa
from marinelake.llm.common import lean

kept = []

def private_mb():
    with open("/proc/self/smaps_rollup") as held:
        return int(re.search(r"\\nPss_Anon:\\s+(\\d+)", held.read()).group(1)) / 1024

def step(batches):
    for batch in batches:
        pieces = [b"x" * 20_000 + bytes([i % 256]) for i in range(5000)]
        kept.extend(pieces[::500])  # a few that stay, among many that are freed
        yield batch

batch = pa.RecordBatch.from_arrays([pa.array([1])], ["n"])
list(lean(step)([batch]))
before = private_mb()
sizes = [private_mb() for _ in lean(step)([batch])]
print(sizes[0] - before, private_mb() - before)
"""


def test_a_worker_gives_back_what_a_task_has_freed():
    if not hasattr(ctypes.CDLL(None), "malloc_trim"):
        pytest.skip("the C library has no malloc_trim")
    done = subprocess.run([sys.executable, "-c", WORKER], cwd=REPO, env=os.environ | {"PYTHONPATH": REPO}, capture_output=True, text=True, check=True)
    during, after = map(float, done.stdout.split())
    assert during > 80
    assert after < 10


def test_lean_step_yields_what_the_step_yields():
    batches = [pa.RecordBatch.from_arrays([pa.array([i])], ["n"]) for i in range(3)]
    assert list(common.lean(iter)(batches)) == batches


def test_languages_are_scored_in_small_slices(spark, monkeypatch):
    model = language.LanguageModel(["de", "en"], {("der", "de"): 3, ("the", "en"): 3}, {("e", "de"): 1, ("h", "en"): 2}, {"de": 1, "en": 1})
    taken = []
    scored = language._scored(model)
    batch = pa.RecordBatch.from_arrays([pa.array(["the " * 100_000] * 12)], ["text"])
    for part in common.slices([batch], "text", most=language._SLICE):
        taken.append(part.nbytes)
        best, score, letters = scored(common.texts_of(part, "text"))
        assert (best == 1).all() and letters.all()
        assert np.array_equal(score, scored(common.texts_of(batch, "text"))[1][: len(score)])
    assert max(taken) <= 2.1 * (1 << 20) and len(taken) > 1
