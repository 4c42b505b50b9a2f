"""op7's construction takes only what can repeat: words that a group holds once part the strings."""

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
from tidemark.llm import suffix_dedup  # noqa: E402


def _entered(monkeypatch, strings, length, **groups):
    """(masks, bytes that the construction took)."""
    seen, real = [0], suffix_dedup.collection_bwt

    def counted(phased, *args):
        seen[0] += sum(map(len, phased))
        return real(phased, *args)
    monkeypatch.setattr(suffix_dedup, "collection_bwt", counted)
    got = [m.tolist() for m in suffix_dedup.repeated_windows(strings, length, **groups)]
    monkeypatch.setattr(suffix_dedup, "collection_bwt", real)
    return got, seen[0]


def _counted(strings, length):
    seen = [s[i:i + length] for s in strings for i in range(len(s) - length + 1)]
    return [[seen.count(s[i:i + length]) > 1 for i in range(len(s) - length + 1)] for s in strings]


def _random(r, n, letters=26):
    return bytes(97 + r.randrange(letters) for _ in range(n))


def test_strings_that_share_no_word_enter_no_round(monkeypatch):
    r = random.Random(1)
    st = [_random(r, 390) for _ in range(20)]
    assert _entered(monkeypatch, st, 200) == (_counted(st, 200), 0)


def test_only_the_shared_part_enters(monkeypatch):
    r = random.Random(2)
    shared = _random(r, 230)
    st = [_random(r, 80) + shared + _random(r, 80), _random(r, 60) + shared + _random(r, 90), shared[:150] + _random(r, 200)]
    got, took = _entered(monkeypatch, st, 200)
    assert got == _counted(st, 200) and sum(map(sum, got)) == 2 * 31
    assert 0 < took <= 2 * 240


def test_words_of_other_groups_do_not_count(monkeypatch):
    r = random.Random(3)
    base = _random(r, 260)
    st = [base[:150] + _random(r, 150), base[:190], _random(r, 60) + base, _random(r, 50) + base[20:]]
    few = [base[:150] + b"#" + base[151:], base[:130] + b"%" + base[131:]]
    want = _counted(st + few, 200)
    assert _entered(monkeypatch, st + few, 200, groups=[1, 2, 7, 7, 3, -(1 << 63)])[0] == want
    assert _entered(monkeypatch, few, 200, groups=[3, -(1 << 63)]) == (_counted(few, 200), 0)


@pytest.mark.parametrize("length", [9, 12, 16, 200])
def test_parts_give_the_masks_of_counting(monkeypatch, length):
    for seed in range(25):
        r = random.Random(seed)
        base = _random(r, 3 * length, 2)
        st = [bytearray(base[(a := r.randrange(2 * length)):a + r.randrange(2 * length)]) for _ in range(r.randrange(1, 9))] + [bytearray()]
        for s in st:
            for _ in range(r.randrange(3)):
                if s:
                    s[r.randrange(len(s))] = 97 + r.randrange(26)
        st = [bytes(s) for s in st] + [_random(r, r.randrange(length + 9), r.choice([1, 26]))]
        assert _entered(monkeypatch, st, length)[0] == _counted(st, length)
