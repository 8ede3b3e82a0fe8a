from hypothesis import given, settings, strategies as st

import numpy as np

from strataflow.llm.words import Words

TEXT = st.lists(st.sampled_from(["a", "ab", "é", "x" * 8, "x" * 9, "y" * 300, "y" * 301, " ", "\n", "\x0b", "\x1c", "\t "]), max_size=12).map("".join)


@settings(max_examples=500, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=5), st.randoms())
def test_words(texts, rng):
    raw = [t.encode() for t in texts]
    words = Words(raw)
    lists = [t.split() for t in raw]
    assert np.diff(words.starts).tolist() == [len(w) for w in lists]
    flat = [w for own in lists for w in own]
    hashes = words.hashes()
    assert len({*zip(flat, hashes.tolist(), strict=True)}) == len(set(flat)) == len(set(hashes.tolist()))
    keep = np.array([rng.random() < 0.5 for _ in flat], bool)
    rest = iter(keep.tolist())
    assert words.joined(keep) == [b" ".join(w for w in own if next(rest)).decode() for own in lists]
