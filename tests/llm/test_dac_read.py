"""A file is decoded once for all its documents."""

import zlib

import numpy as np

from biblioflow.llm import dac


def test_a_file_is_decoded_in_one_step_for_all_its_documents(monkeypatch):
    ids = np.random.default_rng(3).integers(0, 1 << 24, 5000).astype("<u4") >> np.arange(5000).astype("<u4") % 20
    bounds = [0, 1, 1, 700, 4999, 5000]
    asked, part = [], dac.Reader.slice
    monkeypatch.setattr(dac.Reader, "slice", lambda self, a, b: asked.append((a, b)) or part(self, a, b))
    reader = dac.Reader(dac.encode(ids))
    assert dac.checksums(reader, bounds) == [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(bounds, bounds[1:], strict=False)]
    assert asked == [(0, 5000)]
    assert dac.checksums(reader, bounds[2:]) == dac.checksums(reader, bounds)[2:]
