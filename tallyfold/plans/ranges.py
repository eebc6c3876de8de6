"""Batches merged in the ranges of a binary counter."""

from __future__ import annotations


def covering(batch_id: int) -> list[tuple[int, int]]:
    """The parts that together hold batches 0 to ``batch_id``: (first, last) ranges, in order.

    The ranges are those of a binary counter: few, and each batch is merged again only as often
    as the counter carries.
    """
    ranges, end = [], batch_id + 1
    while end > 0:
        size = end & -end
        ranges.append((end - size, end - 1))
        end -= size
    return ranges[::-1]
