"""op2's model takes the memory of one step of landmarks, however many languages it knows."""

import os
import pickle
import sys
import tracemalloc

import numpy as np

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
from tidemark.llm import language  # noqa: E402


def _model(langs, texts):
    """A model of ``langs`` languages with random words of their own, ``texts`` of each, and a text of each to predict."""
    r = np.random.default_rng(langs)
    words = [["".join(chr(97 + c) for c in r.integers(0, 26, 6)) for _ in range(12)] for _ in range(langs)]
    text = lambda i: " ".join(r.choice(words[i], 30))
    names = [f"l{i:03d}" for i in range(langs)]
    bits = np.packbits(language._matrix([text(i) for i in range(langs) for _ in range(texts)]).astype(bool), axis=1)
    return language.KernelRidge(bits, [x for x in names for _ in range(texts)]), names, [text(i) for i in range(langs)]


def test_memory_of_a_worker_does_not_grow_with_the_languages():
    model, names, asked = _model(48, 33)
    sent = pickle.dumps(model)
    assert len(sent) < 2 * model.marks.nbytes
    del model
    tracemalloc.start()
    got, score = pickle.loads(sent).predict(asked)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == names and all(0 < s <= 1 for s in score)
    assert most < 120e6                                             # 1,536 landmarks unpacked are 201 MB


def test_steps_give_the_scores_of_one_product():
    model, names, asked = _model(11, 40)
    assert len(model.marks) == 352 > language.STEP                  # three steps, the last in part
    x, m = language._matrix(asked), np.unpackbits(model.marks, axis=1).astype(np.float64)
    want = x @ m.T / np.sqrt(np.outer(x.sum(axis=1), m.sum(axis=1)))
    assert np.allclose(model.kernel(x), want, atol=1e-5)
    assert model.predict(asked)[0] == names


def test_one_step_is_unpacked_once():
    model, names, asked = _model(4, 32)
    kept = model.cols
    model.predict(asked)
    assert model.cols is kept and "cols" not in pickle.loads(pickle.dumps(model)).__dict__
