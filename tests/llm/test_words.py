import random
import re

import numpy as np
import pyarrow as pa

from hourcast.llm import _words as W

ALPHABET = list("abAB  \t\n\r\x0b\x0c.,é 　中'") + ["word ", "  "]


def texts(seed, n=300):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 30))) for _ in range(n)] + ["", None, "a"]


def test_words_are_runs_of_other_bytes_and_hashes_identify_them():
    column = pa.array(texts(1))
    words = W.Words(column)
    raw, h, low = words.data.tobytes(), words.hashes(), words.hashes(lower=True)
    by_hash, by_low = {}, {}
    for d, text in enumerate(column.to_pylist()):
        expected = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        lo, hi = words.bounds[d], words.bounds[d + 1]
        assert [raw[a:b] for a, b in zip(words.starts[lo:hi], words.ends[lo:hi])] == expected
        for x, y, w in zip(h[lo:hi].tolist(), low[lo:hi].tolist(), expected):
            assert by_hash.setdefault(x, w) == w
            lowered = w.translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))
            assert by_low.setdefault(y, lowered) == lowered
    assert len(by_hash) == len(set(by_hash.values()))


def test_hashes_of_a_sliced_column_and_of_spans_longer_than_a_slice(monkeypatch):
    column = pa.array(["x y", "some words here", None, "x some y"])
    all_ = W.Words(column).hashes()
    assert (W.Words(column.slice(1)).hashes() == all_[2:]).all()
    monkeypatch.setattr(W, "SPAN_BYTES", 2)
    assert (W.Words(column).hashes() == all_).all()


def test_run_hashes_depend_on_the_words_only():
    h = W.Words(pa.array(["a b c d a b c"])).hashes()
    runs = W.run_hashes(h, 3)
    assert runs[0] == runs[4] and len(set(runs.tolist())) == 4


def test_slices_cover_every_row_once():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts(2)), "i": pa.array(range(303))})
    got = [x for part in W.slices(batch, limit=50) for x in part.column(1).to_pylist()]
    assert got == list(range(303))


def test_slide():
    x = np.random.default_rng(0).integers(0, 100, 50)
    for width in (1, 2, 5, 20, 50):
        assert W.slide(x, width, np.minimum).tolist() == [x[i:i + width].min() for i in range(51 - width)]
