import numpy as np

from fleetspark.llm import fingerprints as fp


def test_unrelated_long_texts_stay_unlike():
    """Bins that keep few bits of their least hash agree by chance once texts are long."""
    texts = [np.random.default_rng(seed).integers(97, 123, 8_000_000, np.uint8).tobytes().decode() for seed in (1, 2)]
    left, right = fp.sketch(texts[:1]), fp.sketch(texts[1:])
    assert fp.likeness(left, right)[0] == 0 and fp.likeness(left, left)[0] == 1
    assert len(fp.written(left)[0]) == len(fp.written(fp.sketch([""]))[0])
