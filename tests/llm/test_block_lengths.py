"""Segments of a common size are coded in blocks short enough that many lie side by side."""

import numpy as np
import pytest

from voxmill.llm import range_coder


def test_blocks_of_a_segment():
    assert [range_coder.block_for(n) for n in (1, 2_200_000, 4_000_000, 8 << 20, 1 << 30)] == [1024, 1075, 1954, 4096, 4096]
    ids = np.minimum(np.random.RandomState(5).zipf(1.3, 10_000), 65535)
    prior, blocks = range_coder.encode_counted(ids, range_coder.block_for(len(ids)))
    assert len(blocks) == 10  # 3 of 4,096 ids before
    assert (range_coder.decode_blocks(blocks, prior) == ids).all()
    assert (range_coder.decode_blocks(blocks[4:6], prior) == ids[4096:6144]).all()
    for wrong in (0, range_coder.BLOCK + 1):
        with pytest.raises(ValueError):
            range_coder.encode_counted(ids, wrong)
