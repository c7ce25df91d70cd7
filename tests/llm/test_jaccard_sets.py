"""Shingle sets of long texts are made in pieces, and equal those of the whole."""

import random
import re
import os
import subprocess
import sys

import pytest

from ebbtide.llm import jaccard, text


def plain(t, k):
    words = re.findall(rb"[^\x20\x09-\x0D]+", t.lower())
    return {b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {b" ".join(words)} - {b""}


@pytest.mark.parametrize("size", [50, 400, text.PIECE_BYTES])
def test_sets_do_not_depend_on_pieces(monkeypatch, size):
    rng = random.Random(size)
    texts = [" ".join(f"W{rng.randrange(30)}" * rng.choice([1, 1, 1, 40]) for _ in range(rng.randrange(0, 120))).encode() for _ in range(60)]
    texts += [b"", b"  ", b"one", b"two words", b"x" * 900, b"y" * 900 + b" z"]
    for k in 3, 5:
        sets = jaccard.Sets(k, 90)
        whole = {i + j: s for i, found in sets.each(texts) for j, s in enumerate(found)}
        monkeypatch.setattr(text.word_runs, "__defaults__", (False, 0, size))
        monkeypatch.setattr(text.pieces, "__defaults__", (size,))
        cut = {i + j: s for i, found in sets.each(texts) for j, s in enumerate(found)}
        monkeypatch.undo()
        assert sorted(cut) == sorted(whole) == list(range(len(texts)))
        for i, t in enumerate(texts):
            assert cut[i].tolist() == whole[i].tolist() and len(cut[i]) == len(plain(t, k))
    assert plain(texts[0], 3) and jaccard.shared(whole[0], whole[0]) == len(whole[0])


def test_a_text_of_30_mb_takes_bounded_memory():
    code = ("import resource, random; from ebbtide.llm import jaccard; rng = random.Random(1)\n"
            "t = b' '.join(b'%d' % rng.randrange(10**6) for _ in range(4_300_000))\n"
            "before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
            "n = sum(len(s) for _, f in jaccard.Sets(5, 80).each([t]) for s in f)\n"
            "print(len(t), n, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)")
    size, n, kilobytes = map(int, subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))).stdout.split())
    assert size > 29_000_000 and n > 4_000_000
    assert kilobytes < 8 * size // 1000  # the set itself takes 34 MB, merging it as much again
