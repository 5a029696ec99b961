"""Hashes and comparisons of spans: their values, and the memory of a worker that they take."""

import tracemalloc

import numpy as np
import pytest

from recordloom.llm import text
from recordloom.llm.substring import _smaller_elsewhere


def peak(run):
    """The most bytes that ``run`` held at once besides what was there before."""
    run()
    tracemalloc.start()
    run()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most


@pytest.fixture(scope="module")
def spans():
    data = np.random.default_rng(3).integers(97, 123, 4 << 20, dtype=np.uint8)
    start = np.arange(0, len(data) - 8, 8)
    return data, start, start + 7


def test_a_slice_is_hashed_in_little_memory(spans):
    data, start, end = spans
    # running sums take eight bytes for each of the text, hashes of words as much for each word
    assert peak(lambda: text.span_hashes(data, start, end)) < 16 * len(data)


def test_a_slice_is_compared_in_little_memory(spans):
    data, start, end = spans
    data = np.resize(data[:8000], len(data))
    assert peak(lambda: text.alike(data, start, end)) < 24 * len(data)


def test_hashes_are_polynomials_of_the_bytes():
    data = np.random.default_rng(4).integers(0, 256, (1 << 17) + 50, dtype=np.uint8)
    start = np.array([0, 5, 65_530, 65_536, 131_071, 131_072, len(data), 7])
    end = np.array([3, 5, 65_545, 65_540, 131_080, len(data), len(data), 70_000])
    found = text.span_hashes(data, start, end)
    for a, b, value in zip(start.tolist(), end.tolist(), found):
        plain = sum(int(text._BYTE_CODES[x]) * pow(text._MULTIPLIER, k, 1 << 64) for k, x in enumerate(data[a:b].tolist()))
        both = np.array([plain % (1 << 64)], np.uint64) ^ text.mix(np.array([b - a], np.uint64))
        assert text.mix(both)[0] == value


def test_spans_of_one_hash_with_other_bytes_are_apart(monkeypatch, spans):
    data, start, end = spans
    monkeypatch.setattr(text, "span_hashes", lambda data, start, end: (end - start).astype(np.uint64))
    first, of = text.alike(data, start, end)
    assert len(first) == len(start) and (of == np.arange(len(start))).all()
    same = np.resize(data[:8], len(data))
    assert set(text.alike(same, start, end)[1].tolist()) == {0}
    same[start[-1] + 3] ^= 1
    assert len(text.alike(same, start, end)[0]) == len(start)


def test_trees_hold_a_copied_window_once():
    lines = "".join(f"w{i} {' '.join(f'word{k}' for k in range(12))}\n" for i in range(2000)).encode()

    def pieces():
        for _ in range(40):
            yield bytes(bytearray(lines)), np.arange(2000) + 7

    assert not _smaller_elsewhere(pieces(), 13).any()
    assert peak(lambda: _smaller_elsewhere(pieces(), 13)) < 20 * len(lines)
    assert len(_smaller_elsewhere([], 13)) == 0
