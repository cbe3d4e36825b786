"""Words of a text: runs of anything but the ASCII white space \\x20 and \\x09-\\x0D."""

from __future__ import annotations

import numpy as np

WHITE = b" \t\n\x0b\x0c\r"


def words_of(data: bytes) -> list[bytes]:
    """``bytes.split`` cuts at exactly these six characters, and UTF-8 holds them only as themselves."""
    return data.split()


def free_name(columns: list[str], name: str) -> str:
    """``name``, with as many underscores before it as no column of the table has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


class Memo(dict):
    """Results of a function by key, emptied when it holds ``limit`` of them."""

    def __init__(self, function, limit: int):
        super().__init__()
        self.function, self.limit = function, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.function(key)
        return value


def run_ids(values: np.ndarray, length: int) -> np.ndarray:
    """Numbers for the windows of ``length`` (a power of two) values; equal numbers mean equal windows, exactly."""
    _, ids = np.unique(values, return_inverse=True)
    span = 1
    while span < length:
        if len(ids) <= span:
            return np.empty(0, dtype=np.int64)
        pairs = ids[:-span].astype(np.int64) * (int(ids.max()) + 1) + ids[span:]
        _, ids = np.unique(pairs, return_inverse=True)
        span *= 2
    return ids
