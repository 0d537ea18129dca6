from __future__ import annotations

import os
from pathlib import Path

import numpy as np

from pluvio.llm import bpe, chosen_path, common, quality


def test_what_an_operator_keeps_in_a_worker_goes_when_another_begins(monkeypatch):
    monkeypatch.setattr(common, "_working", None)
    chosen_path.shingles("one two three four five six")
    assert chosen_path._known and common._working == "chosen_path"
    chosen_path.shingles("one two three four five six seven")
    assert chosen_path._known
    quality._DENSE["for"] = object()
    common.working("quality")
    assert not chosen_path._known and quality._DENSE
    common.working("bpe")
    assert not quality._DENSE and bpe._codec.cache_info().currsize == 0


def test_shingles_are_the_same_after_memory_was_let_go():
    text = "a b c d e f g h a b c d e"
    once = chosen_path.shingles(text)
    common.working("other")
    assert (chosen_path.shingles(text) == once).all()


def test_free_memory_goes_back_between_operators():
    resident = lambda: int(Path("/proc/self/statm").read_text().split()[1]) * os.sysconf("SC_PAGE_SIZE")
    common.working("one")
    held = [np.ones(500) for _ in range(40_000)]  # 160 MB in pieces that the C library keeps while the last is there
    before = resident()
    held[:-1] = []
    common.working("two")
    assert before - resident() > 100e6 and len(held) == 1
