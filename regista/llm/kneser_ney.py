"""Discounts and smoothing shared by the language models: modified Kneser-Ney with three discounts."""

from __future__ import annotations

import numpy as np


def discounts(count_of_counts: np.ndarray) -> np.ndarray:
    """Discounts of counts one, two, and three or more from the numbers of entries seen 1 to 4 times.

    Where a number is missing (small corpora) the estimate is not defined; the plain absolute
    discount, or a half, stands in. Discounts stay between zero and the count.
    """
    n1, n2, n3, n4 = (float(n) for n in count_of_counts[:4])
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else y, 2 - 3 * y * n3 / n2 if n2 and n3 else y, 3 - 4 * y * n4 / n3 if n3 and n4 else y]
    return np.asarray([0.0, *[min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1)]])


def count_of_counts(counts: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)[1:5]


def discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.maximum(counts - d[np.minimum(counts, 3).astype(np.int64)], 0.0)
