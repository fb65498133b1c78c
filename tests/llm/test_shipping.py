"""Functions for Python workers run where this package is not installed."""

import subprocess
import sys

import pytest
from pyspark import cloudpickle

from tideline.llm import language, recurrent_lm, shingles, spelling, tokens
from tideline.llm.bagminhash import signatures

CASES = {
    "op1, op9: token ids": (tokens.document_ids, ("some text", "byte_bpe_50k")),
    "op5: bags": (shingles.bags, ([b"one two three four five six"],)),
    "op7: n-grams": (language.counts, (["Ein Satz"],)),
    "op11: tokens": (recurrent_lm.tokens_of, ("A b",)),
    "op13: matrices": (spelling.matrices, (["abcde", "abcdf"],)),
}

RUN = """
import pickle, sys
function, arguments = pickle.loads(sys.stdin.buffer.read())
first, second = function(*arguments), function(*arguments)
assert not any(name.split(".")[0] == "tideline" for name in sys.modules), "imported"
print("fine")
"""


@pytest.mark.parametrize("name", CASES)
def test_without_the_package(name, tmp_path):
    function, arguments = CASES[name]
    function(*arguments)  # what this process keeps must not travel
    raw = cloudpickle.dumps((function, arguments))
    assert len(raw) < 200_000
    done = subprocess.run([sys.executable, "-c", RUN], input=raw, capture_output=True, cwd=tmp_path)
    assert done.stdout.strip() == b"fine", done.stderr.decode()[-2000:]


def test_signatures_travel(tmp_path):
    """BagMinHash and the functions that it calls."""
    found = shingles.bags([b"one two three four five six", b""])
    mine = signatures(found, 2, 10)
    raw = cloudpickle.dumps((signatures, (found, 2, 10)))
    again = RUN.replace('print("fine")', "print(first.tolist())")
    done = subprocess.run([sys.executable, "-c", again], input=raw, capture_output=True, cwd=tmp_path)
    assert done.stdout.decode().strip() == str(mine.tolist()), done.stderr.decode()[-2000:]
