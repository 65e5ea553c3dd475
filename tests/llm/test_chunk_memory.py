"""What the text kernels hold at a time is bounded, however many texts an Arrow batch has."""

import tracemalloc

import numpy as np
import pyarrow as pa

from pagetables.llm import kernels as K
from pagetables.llm import minhash, quality


def _batch(mb):
    rng = np.random.default_rng(3)
    words = np.array([f"word{i}" for i in range(500)] + ["a", "Of", "THE", "x.\n"])
    texts = [" ".join(words[rng.integers(0, len(words), 400)]) for _ in range(mb * 370)]
    n = len(texts)
    return pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array(texts), pa.array(range(n), pa.int64())],
                                      names=["doc_id", "text", "text_hash"])


def _peak(run, batch):
    tracemalloc.start()
    try:
        for _ in run([batch]):
            pass
        return tracemalloc.get_traced_memory()[1] >> 20
    finally:
        tracemalloc.stop()


def test_kernels_hold_a_bounded_piece_of_a_batch():
    batch = _batch(6)
    for run in (quality._stat_rows, minhash._sketch):
        K._powers.__defaults__[0].clear()
        assert _peak(run, batch) < 64


def test_statistics_do_not_depend_on_the_pieces():
    texts = K.text_column(_batch(2), "text")
    whole = np.concatenate([quality.statistics(d, o) for _i, _j, d, o in K.chunks(texts, 1 << 30)])
    cut = np.concatenate([quality.statistics(d, o) for _i, _j, d, o in K.chunks(texts)])
    assert len(whole) == len(texts) and (whole == cut).all()
