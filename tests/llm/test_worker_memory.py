"""Python workers outlive their tasks: what a pass leaves behind in one."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]

SCRIPT = """
import gc, random, re
import pyarrow as pa
from eddy.llm import ngram_jaccard, packing

def held():
    s = open("/proc/self/smaps_rollup").read()
    return sum(map(int, re.findall(r"\\nPss_(?:Anon|Shmem):\\s+(\\d+)", s))) / 1024

def batches():
    rnd = random.Random(1)
    words = ["".join(rnd.choices("abcdefghij", k=6)) for _ in range(3000)]
    for _ in range(3):
        texts = [" ".join(rnd.choices(words, k=6000)) for _ in range(600)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in COLUMNS(texts)], names=["a", "b"])

def used(make):
    for b in make(batches()):
        pass
    del b
    gc.collect()
    before = held()
    pa.default_memory_pool().release_unused()
    return before - held()

print(used(MAKE))
"""

PASSES = {
    "packing": ("packing.cut_pieces(packing.contract_tokenizer(), 4096, 1)", "lambda t: (range(len(t)), t)"),
    "jaccard": ("ngram_jaccard.set_rows(5)", "lambda t: (t, range(len(t)))"),
}


@pytest.mark.parametrize("name", PASSES)
def test_a_pass_gives_back_what_arrow_has_freed(name):
    make, columns = PASSES[name]
    script = SCRIPT.replace("MAKE", make).replace("COLUMNS", f"({columns})")
    got = subprocess.run([sys.executable, "-c", script], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert got.returncode == 0, got.stderr
    assert float(got.stdout) < 10  # MB
