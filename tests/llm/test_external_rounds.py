"""op7's construction works from its files, block by block; op6's builder closes tags without walking the open ones."""

import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
from tidemark.llm import html_text, suffix_dedup  # noqa: E402


def _strings(seed, n=8):
    r = random.Random(seed)
    return [np.array([r.randrange(r.choice([1, 2, 3, 90])) for _ in range(r.randrange(0, 16))], np.int64) for _ in range(n)]


def _sorted_suffixes(strings):
    return sorted(([*s[i:].tolist(), k - 1000], k, i) for k, s in enumerate(strings) for i in range(len(s) + 1))


@pytest.mark.parametrize("block", [1, 3, 7, 1 << 18])
def test_any_block_size_gives_the_sorted_suffixes(tmp_path, block):
    for seed in range(12):
        st, folder = _strings(seed), tmp_path / str(seed)
        folder.mkdir()
        bwt, lcp = suffix_dedup.collection_bwt(st, suffix_dedup._Files(str(folder), block), 6)
        suf = _sorted_suffixes(st)
        assert bwt.tolist() == [st[k][i - 1] + 1 if i else 0 for _, k, i in suf]
        shared = [0] + [len(os.path.commonprefix([a[:-1], b[:-1]])) for (a, _, _), (b, _, _) in zip(suf, suf[1:])]
        assert lcp.tolist() == [min(6, x) for x in shared]
        assert sorted(os.listdir(folder)) == sorted({os.path.basename(x.filename) for x in (bwt, lcp)})     # one round's files stay


def test_rounds_need_the_files_of_the_round_before(tmp_path, monkeypatch):
    real = suffix_dedup._ranked

    def lost(*args):
        out = real(*args)
        for f in os.listdir(tmp_path):
            os.remove(tmp_path / f)
        return out
    monkeypatch.setattr(suffix_dedup, "_ranked", lost)
    with pytest.raises(FileNotFoundError):
        suffix_dedup.collection_bwt(_strings(1), suffix_dedup._Files(str(tmp_path)), 6)


@pytest.mark.parametrize("length", [8, 12, 200])
def test_repeated_windows_against_counting(length):
    r = random.Random(length)
    base = bytes(r.randrange(97, 100) for _ in range(4 * length))
    st = [b"", b"x" * (length - 1), base[:2 * length], base[length // 2:3 * length], b"y" * (length + 3),
          *(bytes(r.randrange(97, 123) for _ in range(length + 5)) for _ in range(6))]
    seen = [s[i:i + length] for s in st for i in range(len(s) - length + 1)]
    want = [[seen.count(s[i:i + length]) > 1 for i in range(len(s) - length + 1)] for s in st]
    assert [m.tolist() for m in suffix_dedup.repeated_windows(st, length)] == want


def test_no_strings_and_empty_strings(tmp_path):
    for name, st in (("none", []), ("empty", [np.empty(0, np.int64)] * 3)):
        (tmp_path / name).mkdir()
        bwt, lcp = suffix_dedup.collection_bwt(st, suffix_dedup._Files(str(tmp_path / name)), 6)
        assert bwt.tolist() == lcp.tolist() == [0] * len(st)


def test_block_starts_in_a_button_take_no_walk():
    """An open paragraph beyond a stop: the cost of a tag does not grow with what is open."""
    class Counted(html_text.Node):
        reads = 0

        @property
        def parent(self):
            Counted.reads += 1
            return self._parent

        @parent.setter
        def parent(self, node):
            self._parent = node
        __slots__ = ("_parent",)

    def reads(n):
        Counted.reads = 0
        with pytest.MonkeyPatch.context() as m:
            m.setattr(html_text, "Node", Counted)
            html_text.build("<p><button>" + "<div>" * n)
        return Counted.reads
    assert reads(400) <= 5 * reads(100)


class _Walking(html_text._Builder):
    """The implied closes by walking what is open, outwards."""

    def _close_open(self, tags, stops):
        n, outermost = self.at, None
        while n.parent is not None and n.tag not in stops:
            if n.tag in tags:
                outermost = n
            n = n.parent
        if outermost is not None:
            self._close(self.path.index(outermost))


def _shape(node):
    return node if isinstance(node, str) else (node.tag, [_shape(c) for c in node.children])


def test_implied_closes_equal_a_walk(monkeypatch):
    r = random.Random(5)
    tags = "p div ul li table tr td th caption button svg text foreignobject dl dt dd select option tbody math mi b summary body".split()
    pages = ["".join(r.choice(["<%s>", "<%s>", "</%s>", "<%s/>"]) % r.choice(tags) + r.choice(["", "w "]) for _ in range(r.randrange(40)))
             for _ in range(1500)]
    got = [_shape(html_text.build(x)) for x in pages]
    monkeypatch.setattr(html_text, "_Builder", _Walking)
    assert got == [_shape(html_text.build(x)) for x in pages]
