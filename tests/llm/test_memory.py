"""What a Python worker still holds after its task."""

from __future__ import annotations

import ctypes
import re

import pyarrow as pa
import pytest

from skylag.llm import arrow

needs_glibc = pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="the C library cannot return freed pages")


def held():
    """Anonymous memory of this process in MB."""
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"\nAnonymous:\s+(\d+)", f.read())[1]) / 1024


def crowded(pins, data):
    """200 MB in pieces, all freed but the last one, which lies on top of them."""
    pieces = [bytearray(2000) for _ in range(100_000)]
    pins.append(pieces.pop())
    return data


@needs_glibc
def test_slices_give_memory_back():
    pins = []
    batch = pa.record_batch({"text": ["a b", "c"]})
    before = held()
    out = list(arrow.per_text(lambda part: crowded(pins, part))([batch]))
    assert held() - before < 80
    assert out == [batch]


@needs_glibc
def test_groups_give_memory_back():
    pins = []
    table = pa.table({"doc_id": [3, 1]})
    before = held()
    out = arrow.per_group(lambda group: crowded(pins, group))(table)
    assert held() - before < 80
    assert out is table
