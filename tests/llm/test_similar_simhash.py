"""The fingerprint of the near-duplicate stage is a SimHash, and pairs at 0.8 share its lists."""

import numpy as np
from docledger.llm import similar
from docledger.llm.passages import mixed
from tests.llm.test_similar import copies


def test_a_bit_is_set_if_more_than_half_of_the_hashes_have_it():
    rng = np.random.default_rng(2)
    for n in (1, 2, 5, 254, 255, 256, 700):
        found = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        for k, word in enumerate(np.frombuffer(similar.fingerprint(found), "<u8").tolist()):
            hashes = mixed(found ^ similar._SEEDS[k]).tolist()
            assert word == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_pairs_at_the_similarity_share_a_list_and_pass_the_filters():
    for a, b in copies(4, 300):
        x, y = (np.frombuffer(similar.fingerprint(similar.shingles(t.encode())), np.uint8) for t in (a, b))
        assert (x.view("<u2") == y.view("<u2")).any() and (x == y).sum() >= similar.SHARED
        assert np.bitwise_count(x[: similar.HEAD] ^ y[: similar.HEAD]).sum() <= similar.DIFFER
