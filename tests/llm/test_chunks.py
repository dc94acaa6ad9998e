"""Quality: every byte of a text is in a judged chunk."""

import base64
import random

import zstandard

from seiche.llm import quality


def outside(text):
    _, n, out, *_ = quality.ratios(text, zstandard.ZstdCompressor(level=quality.LEVEL).compress)
    return out > quality.CHUNKS_OUTSIDE * n


def test_noise_at_the_end_of_a_text():
    r = random.Random(6)
    for size in (8192, 2048, 1024):
        prose = base64.b32encode(r.randbytes(size)).lower()[:size]  # five bits a byte: a ratio of 1.6
        noise = base64.b85encode(r.randbytes(2 * size))
        assert not outside(prose)
        for n in (size // 2, size // 2 - 1):
            assert outside(prose + noise[:n])
