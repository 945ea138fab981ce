"""Capitals are counted in the same way at every length."""

import pytest

from loreweave.llm import quality


@pytest.mark.parametrize("length", [100, 4_096, 4_097, 50_000])
def test_capitals_at_every_length(length):
    text = ("iPhone macOS Éa ß İx 😀 " * length)[:length]
    want = sum(c.lower() != c for c in text)
    assert want and quality.capitals(text) == want
    assert quality.measures(text)[len(quality.SIGNS) + 1] == want / length
