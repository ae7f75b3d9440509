import numpy as np
import pytest

from lakeq.llm.suffix_tree import _gaps, _ungaps, pack, unpack

rng = np.random.default_rng(1)


@pytest.mark.parametrize("values", [[], [0], [255], [256, 0], [-1, 5, -300], [2**63 - 1, -2**63], [2**63 - 1], [2**40] * 9,
                                    [-2**31], rng.integers(-5, 9, 1000), rng.integers(0, 2**50, 1000)])
def test_counts_come_back(values):
    values = np.array(values, np.int64)
    assert unpack(pack(values)).tolist() == values.tolist() and unpack(pack(values)).dtype == np.int64


@pytest.mark.parametrize("values", [[], [0], [0, 0, 0], [2**64 - 1], [0, 2**64 - 1], [5, 5, 2**63],
                                    np.sort(rng.integers(0, 2**64 - 1, 5000, dtype=np.uint64))])
def test_rising_numbers_come_back(values):
    values = np.array(values, np.uint64)
    assert _ungaps(_gaps(values)).tolist() == values.tolist()


def test_small_counts_beside_a_large_one_stay_small():
    counts = np.array([*rng.integers(0, 3, 4000), 10**6])
    assert len(pack(counts)) < 4001
