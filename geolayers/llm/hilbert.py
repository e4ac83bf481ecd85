"""Places of points on a Hilbert curve of many dimensions, as byte strings that sort alike."""

import numpy as np


def hilbert_keys(levels: np.ndarray, bits: int) -> np.ndarray:
    """One row of bytes for each point; ``levels`` holds whole numbers of ``bits`` bits, one column a dimension.

    Neighbours on the curve differ by one level in one dimension. The state of the walk
    (which axes are turned) is undone from the coarsest level on, for all points at once.
    """
    x = levels.astype(np.uint32).copy()
    n, dims = x.shape
    for level in range(bits - 1, 0, -1):
        lower = np.uint32((1 << level) - 1)
        for axis in range(dims):
            upper_half = (x[:, axis] >> np.uint32(level)) & 1 == 1
            # In the upper half the finer levels are mirrored, in the lower half the two axes change places there.
            swapped = np.where(upper_half, 0, (x[:, 0] ^ x[:, axis]) & lower).astype(np.uint32)
            x[:, 0] ^= np.where(upper_half, lower, 0).astype(np.uint32) ^ swapped
            x[:, axis] ^= swapped
    np.bitwise_xor.accumulate(x, axis=1, out=x)
    mirrored = np.zeros(n, np.uint32)
    for level in range(bits - 1, 0, -1):
        mirrored ^= np.where((x[:, -1] >> np.uint32(level)) & 1, np.uint32((1 << level) - 1), 0).astype(np.uint32)
    x ^= mirrored[:, None]
    digits = [(x >> np.uint32(level)) & 1 for level in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(digits, axis=1).astype(np.uint8), axis=1)
