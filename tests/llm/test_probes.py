"""Probes of the log-frequency filter."""

import numpy as np

from peakloom.llm import lm_scoring


def plain_entries(held, gram):
    """Entries of one n-gram, a probe at a time."""
    blocks = len(held) * 64 // lm_scoring.BLOCK_BITS
    base = int(lm_scoring._block(gram, blocks)[0]) * lm_scoring.BLOCK_BITS
    for level in range(1, lm_scoring._TOP_LEVEL + 1):
        spread = int(lm_scoring._spread(gram, level)[0])
        for i in range(4):
            at = base + ((spread >> (16 * i)) & 0xFFFF)
            if not (int(held[at >> 6]) >> (at & 63)) & 1:
                return level - 1
    return lm_scoring._TOP_LEVEL


def test_probes_beside_plain_ones(monkeypatch):
    rng = np.random.default_rng(1)
    held = rng.integers(0, 2**64, 4096, np.uint64) | rng.integers(0, 2**64, 4096, np.uint64) | rng.integers(0, 2**64, 4096, np.uint64)
    gram = rng.integers(0, 2**64, 3000, np.uint64)
    found = lm_scoring.entries(held, gram)
    assert found.tolist() == [plain_entries(held, gram[i : i + 1]) for i in range(len(gram))] and found.max() > 2
    # What is left is picked at most once a level.
    picks, plain = [], np.flatnonzero
    monkeypatch.setattr(lm_scoring.np, "flatnonzero", lambda x: picks.append(len(x)) or plain(x))
    lm_scoring.entries(held, gram)
    assert len(picks) <= found.max() + 1
    assert lm_scoring.entries(held, gram[:0]).tolist() == []
