import random

import numpy as np
import pytest
from docledger.llm import suffixes


def made(rng, pieces, size, alphabet):
    return np.frombuffer(b"".join(bytes(rng.choice(alphabet) for _ in range(rng.randrange(size))) + b"\xff" for _ in range(pieces)), np.uint8)


@pytest.mark.parametrize("alphabet", [b"a", b"ab", b"abc", bytes(range(0xF5))])
def test_order_prefixes_and_repeats(alphabet):
    rng = random.Random(len(alphabet))
    for _ in range(60):
        text = made(rng, rng.randrange(1, 6), 30, alphabet)
        raw = text.tobytes()
        array = suffixes.suffix_array(text)
        assert array.tolist() == sorted(range(len(raw)), key=lambda k: raw[k:])
        length = suffixes.common(text, array)
        for k in range(1, len(raw)):
            a, b = (raw[p:].split(b"\xff")[0] for p in (array[k - 1], array[k]))
            shared = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert length[array[k]] == shared
        for size in (1, 3, 7):
            windows = [raw[k : k + size] for k in range(len(raw))]
            want = [len(w) == size and b"\xff" not in w and windows.count(w) > 1 for w in windows]
            assert suffixes.repeated(text, size).tolist() == want


def test_types():
    assert suffixes.types(np.frombuffer(b"mmiissiissiippii\xff", np.uint8)).tolist() == [False, False, True, True, False, False, True, True, False, False, True, True, False, False, True, True, False]


def test_long_texts():
    rng = random.Random(9)
    part = bytes(rng.choice(b"abcd ") for _ in range(5000))
    text = np.frombuffer(part + b"\xff" + b"a" * 3000 + b"\xff" + part[100:2000] + b"\xff", np.uint8)
    got = suffixes.repeated(text, 200)
    raw = text.tobytes()
    windows = [raw[k : k + 200] for k in range(len(raw))]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    assert got.tolist() == [len(w) == 200 and b"\xff" not in w and seen[w] > 1 for w in windows]


def test_order_of_long_repeats():
    rng = random.Random(3)
    part = bytes(rng.choice(b"ab") for _ in range(700))
    raw = part * 4 + b"\xff" + part * 3 + b"\xff" + b"ab" * 1500 + b"\xff"
    assert suffixes.suffix_array(np.frombuffer(raw, np.uint8)).tolist() == sorted(range(len(raw)), key=lambda k: raw[k:])
