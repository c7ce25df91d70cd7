"""Page parsing and alignment: against plain versions, and in bounded time on hostile pages."""

import random
import time

import numpy as np
import pytest

from ebbtide.llm import pages


def plain_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("few, kept", [(8, 16 << 20), (0, 16 << 20), (0, 4), (1000, 1)])
def test_common_lines_are_longest(monkeypatch, few, kept):
    """By piles, by bit rows, and by bit rows halved until a few bytes are kept."""
    monkeypatch.setattr(pages, "FEW_MATCHES", few)
    monkeypatch.setattr(pages, "TABLE_BYTES", kept)
    rng = random.Random(few)
    for _ in range(250):
        a, b = (np.array([rng.randrange(k) for _ in range(rng.randrange(40))], np.uint64) for k in [rng.choice([1, 2, 5, 30])] * 2)
        got = pages.common_lines(a, b)
        assert len(got) == plain_lcs(a.tolist(), b.tolist()) and got == sorted(set(got))
        rest = iter(b.tolist())
        assert all(x in rest for x in a[got].tolist())  # in the order of b too


def seconds(work):
    began = time.perf_counter()
    work()
    return time.perf_counter() - began


def test_hostile_pages_end():
    n = 50_000
    for page in ("<a" * n, "<a" * n + ">", "</b>" * n, "<b>" * n + "</i>" * n, '<a ">"' * (n // 3), "<a '" * n, "<!" * n, "<!--" * n,
                 "<p " + "a" * n + ">x", "<b>" * n + "<p>" * n, "<p><div>" + "<b>" * n + "<p></p>" * n, "<div class=" * n, "<p>" + " " * n + "x", "&" * n):
        assert seconds(lambda: pages.candidate_lines(page)) < 2, page[:20]


def test_many_equal_lines_align_in_time():
    n = 50_000
    equal = np.ones(n, np.uint64)
    assert seconds(lambda: pages.common_lines(equal, equal)) < 2
    a, b = np.concatenate(([2], equal, [3])).astype(np.uint64), np.concatenate(([4], equal[:40_000], [5])).astype(np.uint64)
    out = []
    assert seconds(lambda: out.extend(pages.common_lines(a, b))) < 8 and len(out) == 40_000
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 3, 4000).astype(np.uint64), rng.integers(0, 3, 4000).astype(np.uint64)
    assert seconds(lambda: pages.common_lines(a, b)) < 2


def test_end_tags_and_reopened_paragraphs():
    assert pages.candidate_lines("<p>a<b>b<p>c</b>d</p></i>e<!-- x > y -->f<!--open <p>g") == (False, ["ab", "cd", "ef"])
    assert pages.candidate_lines("a <b") == (False, ["a <b"])
    assert pages.candidate_lines("1 < 2 <p title='x > y'>q</p> 3 > 2") == (False, ["1 < 2", "q", "3 > 2"])
    assert pages.candidate_lines("<main><p>in</p><nav><p>x</p></nav></main><p>out") == (True, ["in"])
    assert pages.candidate_lines("") == (False, [])


def test_one_neighbour_takes_no_line_of_a_marked_article():
    own, near, far = np.array([1, 2, 3], np.uint64), np.array([9, 2], np.uint64), np.array([3, 8, 1], np.uint64)
    assert pages.shared_lines(own, near, far, True) == [] and pages.shared_lines(own, near, far, False) == [1]
    assert pages.shared_lines(own, near, np.array([2], np.uint64), True) == []  # between lines of its own
    edge, more = np.array([1, 7, 8, 3], np.uint64), np.array([1, 5, 8, 3], np.uint64)
    assert pages.shared_lines(edge, more, more, True) == [0, 2, 3] and pages.shared_lines(edge, more, own, True) == [0, 3]
    assert pages.shared_lines(edge, edge, edge, True) == [0, 1, 2, 3] and pages.shared_lines(edge, near, far, True) == []
