import numpy as np

from quotaloom.llm import repair_files


def test_later_rounds_look_only_where_pairs_may_be_frequent(monkeypatch):
    looked, bucket = [], repair_files._bucket

    def seen(a, b, *more):
        looked.append(len(a))
        return bucket(a, b, *more)

    monkeypatch.setattr(repair_files, "_bucket", seen)
    draw = np.random.default_rng(3)
    ids = np.concatenate([draw.integers(0, 1 << 19, 100_000), np.tile(draw.integers(0, 1 << 19, 50), 400)]).astype(np.uint32)
    symbols, rules, _, _ = repair_files.compress(ids)
    assert (repair_files.expand(symbols, rules) == ids).all()
    assert len(looked) > 2 and looked[1] < 40_000 and looked[-1] < 1000  # the 100,000 that never repeat are not counted again
    pairs, n = np.unique(np.stack([symbols[:-1], symbols[1:]], 1), axis=0, return_counts=True)
    assert n[pairs[:, 0] != pairs[:, 1]].max(initial=0) < repair_files.LEAST
