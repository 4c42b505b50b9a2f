"""Repeated substrings across documents by column-wise Burrows-Wheeler construction.

Every byte covered by a string of ``length`` bytes that starts anywhere else in the collection, too, is
found; judged on the input, within documents.

Columns are inserted for all strings at once, so the strings have to be short and those that may be equal must
meet. Both follow from minimizers: of the ``K``-byte grams in a window of ``length`` bytes the one with the
smallest hash (leftmost of equal ones) names the window's bucket, equal windows have equal buckets, and the
consecutive windows that share one gram form a *piece* of less than 2 * length bytes.

1. A scan hashes the grams and writes (bucket, row, offset, windows) per piece, without text.
2. Buckets met once hold no repeat. The pieces of others get their bytes, and equal pieces are counted
   (map-side combined, so thousands of copies are one row): pieces met twice are repeated as a whole.
3. The rest, pieces met once in a bucket with other pieces, are compared by ``repeated_windows``: per
   round one symbol (a word of eight bytes) of every piece is inserted into the collection's BWT, right to left, with the longest
   common prefixes of neighbours updated along; windows whose suffix shares ``length`` bytes with a neighbour
   repeat. A word that a bucket holds once is left out and parts its piece, as nothing repeats across it. The partial BWT and
   prefix arrays live in files alone: a round reads them in order, block by block, and writes the
   next ones, so memory holds a block and a few numbers per string and symbol. The folder is the task's own and temporary; a
   task that is lost starts over.
   Buckets with more than ``HOT`` different pieces would not fit one task: their windows are counted by
   a 128-bit hash instead, map-side combined and spread by that hash.
4. Marked windows are joined back to their occurrences and merged per document.

Defined cases: null and short texts keep all their bytes (null counts as empty); repeated rows repeat
each other wholly, if long enough; a null or repeated id is kept as it is, one result per row; an empty table gives
no rows; other columns are ignored."""

from __future__ import annotations

import contextlib
import hashlib
import os
import tempfile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Written

LENGTH, K = 200, 64
HOT = 4096
WIDTHS = (8, 4, 2, 1)
#: Bytes of pieces that one construction takes; a bucket is never split, see HOT.
BATCH = 1 << 17
CHUNK = 1 << 19
_M, _C = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0x9E3779B97F4A7C15)
_POS = np.uint64((1 << 20) - 1)


def _gram_hashes(b: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every k-byte gram: polynomials by doubling, mixed at the end."""
    h, width, out, have = (b.astype(np.uint64) + np.uint64(1)) * _C, 1, None, 0
    while have < k:
        if k & width:
            if out is None:
                out = h[:len(b) - k + 1].copy() if have + width == k else h
            else:
                out = out[:len(b) - have - width + 1] * _C + h[have:]
            have += width
        if have < k:
            mul = _C ^ np.uint64(width << 20)
            h = h[:-width] * mul + h[width:]
            h ^= h >> np.uint64(31)
            width *= 2
    out = out[:len(b) - k + 1] * _M
    return out ^ (out >> np.uint64(29))


def _window_minimum(v: np.ndarray, w: int) -> np.ndarray:
    width = 1
    while 2 * width <= w:
        v, width = np.minimum(v[:-width], v[width:]), 2 * width
    return np.minimum(v[:len(v) - (w - width)], v[w - width:]) if width < w else v


def pieces(text: bytes, length: int = LENGTH, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, offset, windows) of a text's pieces, in order."""
    k = min(k, max(1, length // 3))
    n = len(text) - length + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    b = np.frombuffer(text, np.uint8)
    got = []
    for at in range(0, n, CHUNK):
        part = b[at:at + CHUNK + length - 1]
        h = _gram_hashes(part, k)
        low = _window_minimum((h & ~_POS) | np.arange(len(h), dtype=np.uint64), length - k + 1)
        where = (low & _POS).astype(np.int64)
        cut = np.flatnonzero(np.diff(where, prepend=-1))
        got.append((h[where[cut]].view(np.int64), cut + at, np.diff(cut, append=len(where))))
    return tuple(np.concatenate(x) for x in zip(*got))


class _Files:
    """The partial BWT and prefixes of a construction: a round reads their files in order, in blocks of ``block`` rows, and writes
    the next ones. Nothing else holds them."""

    def __init__(self, folder: str, block: int = 1 << 18):
        self.folder, self.block, self.turn = folder, block, 0

    def path(self, name: str) -> str:
        return os.path.join(self.folder, f"{name}-{self.turn}")

    def blocks(self, **kinds):
        """(first row, an array per name) of the files that the last round wrote."""
        at = 0
        with contextlib.ExitStack() as stack:
            opened = [(stack.enter_context(open(self.path(n), "rb")), np.dtype(k)) for n, k in kinds.items()]
            while True:
                got = [np.fromfile(f, k, self.block) for f, k in opened]
                if not len(got[0]):
                    return
                yield at, *got
                at += len(got[0])

    @contextlib.contextmanager
    def next_round(self, *names):
        """A function that appends arrays to the next files, which replace the last ones in the end."""
        before = [self.path(n) for n in names]
        self.turn += 1
        with contextlib.ExitStack() as stack:
            opened = [stack.enter_context(open(self.path(n), "wb")) for n in names]
            yield lambda *arrays: [a.tofile(f) for a, f in zip(arrays, opened)]
        for old in before:
            if os.path.exists(old):
                os.remove(old)


def _sorted_order(a: np.ndarray) -> np.ndarray:
    """Stable argsort of symbols, by radix."""
    if a.dtype == np.uint16:
        return np.argsort(a, kind="stable").astype(np.int32)
    low = np.argsort((a & np.uint32(0xFFFF)).astype(np.uint16), kind="stable").astype(np.int32)
    return low[np.argsort((a >> np.uint32(16)).astype(np.uint16)[low], kind="stable")]


def collection_bwt(strings: list[np.ndarray], files: _Files, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """(bwt, lcp) of a collection of symbol strings, by inserting one symbol of every string per round, right to left.

    ``bwt`` holds symbol + 1 of what stands before each sorted suffix, 0 where the suffix is a whole string. End marks
    are smaller than all symbols and ordered by string. ``lcp`` is shared with the row above, at most ``cap``.

    Both live in ``files``. A round reads them once to rank the new suffixes and to carry, per symbol, the smallest prefix since the
    symbol was last met; it reads them again to write them with the new rows in place. Memory holds a block, one
    number per string and three per symbol, whatever the number of rows. The results are the last files, mapped."""
    m = len(strings)
    size = np.array([len(s) for s in strings], np.int64)
    flat = np.concatenate(strings).astype(np.int64) + 1 if m else np.empty(0, np.int64)
    kind = np.uint16 if flat.max(initial=0) < 1 << 16 else np.uint32
    ends = np.cumsum(size)
    count = np.zeros(int(flat.max(initial=0)) + 2, np.int64)  # rows per symbol
    kinds = {"bwt": kind, "lcp": np.int16}
    with files.next_round(*kinds) as put:
        for at in range(0, m, files.block):
            n = min(files.block, m - at)
            put(np.zeros(n, kind), np.zeros(n, np.int16))
    row, alive = np.arange(m), np.arange(m)  # the row of each string's last inserted suffix, ascending
    for j in range(1, int(size.max(initial=0)) + 1):
        on = size[alive] >= j
        alive, row = alive[on], row[on]
        sym = flat[ends[alive] - j]
        count += np.bincount(sym, minlength=len(count))
        first = m + np.cumsum(count) - count  # LF: the place of a symbol's first row, after the m end marks
        rows = m + int(count.sum()) - len(sym)
        final, up, down = _ranked(files.blocks(**kinds), rows, row, sym, first, cap)
        by_row = np.argsort(final, kind="stable")
        final, up, sym = final[by_row], up[by_row], sym[by_row]
        before = final - np.arange(len(final))  # the old row that a new one comes before
        at = 0
        with files.next_round(*kinds) as put:
            last = 0
            for lo, b, lcp in _both(files, kinds):
                x, y = np.searchsorted(row, (lo, lo + len(b)))
                b[row[x:y] - lo] = flat[ends[alive[x:y]] - j]
                here = np.searchsorted(before, lo + len(b)) if lo + len(b) < rows else len(before)
                where, what = before[last:here] - lo, slice(last, here)
                b = np.insert(b, where, 0)
                lcp = np.insert(lcp, where, up[what])
                u, v = np.searchsorted(down[0], (at, at + len(lcp)))
                lcp[down[0][u:v] - at] = down[1][u:v]
                put(b, lcp)
                at, last = at + len(b), here
        alive, row = alive[by_row], final
    return tuple(np.memmap(files.path(n), k, "r") if m else np.empty(0, k) for n, k in kinds.items())


def _both(files: _Files, kinds: dict):
    """The blocks of the round before the one that is being written."""
    was = _Files(files.folder, files.block)
    was.turn = files.turn - 1
    return was.blocks(**kinds)


def _ranked(blocks, rows: int, row: np.ndarray, sym: np.ndarray, first: np.ndarray, cap: int):
    """One pass over the ``rows`` partial rows: (new row, prefix shared with the row above) of each suffix in ``row`` (ascending)
    that ``sym`` extends, and (rows, prefixes) of the rows below new ones."""
    final, up = np.empty(len(row), np.int64), np.zeros(len(row), np.int16)
    seen = np.zeros(len(first), np.int64)              # rows of a symbol so far
    low = np.full(len(first), cap, np.int16)           # the smallest prefix since its last one
    fresh = np.zeros(len(first), bool)                 # that last one is among ``row``
    asked = np.zeros(len(first), bool)                 # symbols of this round; rows of others rank nothing
    asked[sym] = True
    below = []
    for lo, b, lcp in blocks:
        x, y = np.searchsorted(row, (lo, lo + len(b)))
        mine = row[x:y] - lo
        b[mine] = sym[x:y]
        order = np.flatnonzero(asked[b]).astype(np.int32)
        order = order[_sorted_order(b[order])]         # the rows of these symbols by symbol, then by row
        s = b[order]
        at = np.empty(len(b), np.int32)
        at[order] = np.arange(len(order), dtype=np.int32)
        new = at[mine].astype(np.int64)
        edge = np.append(True, s[1:] != s[:-1]) if len(s) else np.empty(0, bool)   # a symbol's first row in this block
        after = new[new + 1 < len(s)] + 1
        after = after[~edge[after]]
        more = lo + len(b) < rows
        if lo or more:
            head = np.flatnonzero(edge)
            sh = s[head].astype(np.int64)
            after = np.concatenate((after, head[fresh[sh]]))
        is_new = np.zeros(len(s), bool)
        is_new[new] = True
        after = after[~is_new[after]]
        want = np.concatenate((new, after))
        ws = s[want].astype(np.int64)
        rank = seen[ws] + want - np.searchsorted(s, s[want])
        # the smallest prefix since the row before of the symbol, this row's own included
        since, at_edge = np.zeros(len(want), np.int64), edge[want]
        inner = want[~at_edge]
        since[~at_edge] = _range_min(lcp, order[inner - 1].astype(np.int64) + 1, order[inner].astype(np.int64) + 1)
        if lo and at_edge.any():
            since[at_edge] = np.minimum(low[ws[at_edge]], np.minimum.accumulate(lcp)[order[want[at_edge]]])
        since = np.minimum(cap, since + 1)
        place = first[ws] + rank
        final[x:y] = place[:len(new)]
        up[x:y] = np.where(rank > 0, since, 0)[:len(new)]
        below.append((place[len(new):], since[len(new):]))
        if more:
            rising = np.append(np.minimum.accumulate(lcp[::-1])[::-1], np.int16(cap))
            low = np.minimum(low, rising[0])
            if len(s):
                tail = np.append(head[1:], len(s)) - 1
                seen[sh] += tail - head + 1
                fresh[sh] = is_new[tail]
                low[sh] = rising[order[tail] + 1]
    place, since = (np.concatenate(z) for z in zip(*below))
    by = np.argsort(place, kind="stable")
    return final, up, (place[by], since[by])


def _range_min(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """min(a[lo:hi]) for each pair, lo < hi."""
    if not len(lo):
        return np.empty(0, np.int64)
    by = np.argsort(lo, kind="stable")  # so that what lies between two ranges is passed once at most
    idx = np.empty(2 * len(lo), np.int64)
    idx[0::2], idx[1::2] = lo[by], hi[by]
    out = np.empty(len(lo), np.int64)
    out[by] = np.minimum.reduceat(np.append(a, np.int16(32767)), idx)[0::2]
    return out


def _repeated_parts(words: np.ndarray, groups: np.ndarray, size: np.ndarray, width: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, bytes) of the maximal parts of the joined strings, at least ``length`` bytes long, whose words all occur twice or more in
    their string's group. A repeated window holds such words only, so it lies in one part, and so do its copies."""
    ends = np.cumsum(size)
    inside = np.ones(len(words), bool)                 # the last words reach into the next string
    for i in range(1, width):
        inside[(ends - i)[size >= i]] = False
    # hashes that collide count too many, so that a part is longer than it has to be
    mixed = (words * _M) ^ np.repeat(groups.astype(np.int64).view(np.uint64) * _C, size)
    at, n = np.unique(mixed[inside], return_inverse=True, return_counts=True)[1:]
    inside[inside] = (n > 1)[at]
    before, after = np.append(False, inside[:-1])[:len(inside)], np.append(inside[1:], False)[:len(inside)]
    before[(ends - size)[size > 0]] = False
    after[ends[size > 0] - 1] = False
    start, stop = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + width
    long = stop - start >= length
    return start[long], (stop - start)[long]


def repeated_windows(strings: list[bytes], length: int = LENGTH, groups: list[int] | None = None) -> list[np.ndarray]:
    """For each string a mask of its windows of ``length`` bytes that occur elsewhere in the collection. ``groups``: a number per
    string, if it is known that strings of different numbers share no window.

    A symbol is a word of ``width`` bytes, and a string enters once per phase, so that every window starts
    at a symbol: as many suffixes as with single bytes, in a fraction of the rounds. What stands before and after a word
    that occurs once in its group enters as parts of their own, without that word: no window across it repeats."""
    width = next(w for w in WIDTHS if length % w == 0)
    deep = length // width
    b = np.frombuffer(b"".join(strings) + b"\0" * width, np.uint8).astype(np.uint64)
    word = b[:len(b) - width].copy()
    for i in range(1, width):
        word = (word << np.uint64(8)) | b[i:len(b) - width + i]
    whole = np.array([len(s) for s in strings], np.int64)
    first, size = _repeated_parts(word, np.array(groups if groups is not None else [0] * len(strings), np.int64), whole, width, length)
    used = np.zeros(len(word) + 1, np.int8)
    used[first] += 1
    used[first + size - width + 1] -= 1
    used = np.cumsum(used, dtype=np.int8)[:-1].astype(bool)
    ids = np.zeros(len(word), np.int64)
    ids[used] = np.unique(word[used], return_inverse=True)[1]
    begin = (first[:, None] + np.arange(width)).ravel()  # part i in phase f is row i * width + f
    count = ((size[:, None] - np.arange(width)) // width).ravel()
    phased = [ids[x:x + n * width:width] for x, n in zip(begin.tolist(), count.tolist())]
    flags = np.zeros(len(word), bool)
    if phased:
        with tempfile.TemporaryDirectory(prefix="bwt-") as folder:
            bwt, lcp = collection_bwt(phased, _Files(folder), deep)
            _mark(flags, bwt, lcp, begin, count, width, length)
    return [flags[x - n:max(x - n, x - length + 1)] for x, n in zip(np.cumsum(whole).tolist(), whole.tolist())]


def _mark(flags, bwt, lcp, begin, count, width: int, length: int) -> None:
    """Sets ``flags`` where repeated windows begin, from the finished arrays."""
    m, deep = len(begin), length // width
    shared = lcp >= deep
    shared[:-1] |= lcp[1:] >= deep
    # walk every string from its end mark (row i) leftwards: LF over the final BWT
    order = _sorted_order(bwt)
    lf = np.empty(len(bwt), np.int64)
    lf[order] = np.arange(len(bwt)) - (len(bwt) - np.count_nonzero(bwt)) + m
    row, alive = np.arange(m), np.arange(m)
    for j in range(1, int(count.max(initial=0)) + 1):
        on = count[alive] >= j
        alive, row = alive[on], lf[row[on]]
        if j >= deep:
            hit = alive[shared[row]]
            flags[begin[hit] + (count[hit] - j) * width] = True


def _int_runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return list(zip(edge[0::2].tolist(), edge[1::2].tolist()))


_MARK = "mhash long, chash long, first int, upto int"


def _mark_rows(rows: list) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                                      ["mhash", "chash", "first", "upto"])


def _compare(length: int):
    """Pieces sorted by bucket -> (mhash, chash, first, upto): runs of windows that repeat."""
    def run(batches):
        rows, held, last = [], 0, None

        def flush():
            marks = []
            for (mh, ch, _), mask in zip(rows, repeated_windows([r[2] for r in rows], length, [r[0] for r in rows])):
                marks += [(mh, ch, a, b) for a, b in _int_runs(mask)]
            rows.clear()
            return _mark_rows(marks)

        for b in batches:
            for mh, ch, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if held >= BATCH and mh != last:
                    yield flush()
                    held = 0
                rows.append((mh, ch, s))
                held, last = held + len(s), mh
        if rows:
            yield flush()

    return run


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, k: int = K,
            hot: int = HOT) -> DataFrame:
    """(doc_id, text: bytes, drop: the runs (start, end) of bytes covered by repeated windows) per row of ``docs``."""
    rows = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("t"),
                       F.md5(F.coalesce(docs[text_col], F.lit(""))).alias("md"))
    keyed = rows.select("doc_id", "t", F.unhex("md").alias("key"))

    def cut(batches):
        for b in batches:
            key, mh, off, n = [], [], [], []
            for x, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                h, o, w = pieces(t.encode(), length, k)
                key += [x] * len(h)
                mh.append(h), off.append(o), n.append(w)
            one = lambda x, t: pa.array(np.concatenate(x) if x else [], t)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.binary()), one(mh, pa.int64()), one(off, pa.int32()),
                                              one(n, pa.int32())], ["key", "mhash", "off", "n"])

    found = Written(keyed.select("key", "t").mapInArrow(cut, "key binary, mhash long, off int, n int"), "pieces").df
    twice = found.groupBy("mhash").count().where("count > 1").select("mhash")
    wanted = (found.join(twice, "mhash", "left_semi").groupBy("key")
              .agg(F.collect_set(F.struct("off", "n", "mhash")).alias("ps"), F.count("*").alias("c")))

    def bytes_of(batches):
        for b in batches:
            ps, s, last = b.column(2), [], None
            off, n, mh = ps.flatten().flatten()
            which = np.repeat(np.arange(len(ps)), ps.value_lengths().to_numpy())
            for i, at, w in zip(which.tolist(), off.to_pylist(), n.to_pylist()):
                if i != last:
                    raw, last = b.column(1)[i].as_py().encode(), i
                s.append(raw[at:at + w + length - 1])
            ch = pa.array([xxhash.xxh3_64_intdigest(x) - (1 << 63) for x in s], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(which)), mh, ch, off, n, pa.array(s, pa.binary())],
                                             ["key", "mhash", "chash", "off", "n", "s"])

    cols = "key binary, mhash long, chash long, off int, n int, s binary"
    at = Written(keyed.select("key", "t").join(wanted, "key").select("key", "t", "ps").mapInArrow(bytes_of, cols), "piece-bytes").df
    counted = Written(at.groupBy("mhash", "chash", "s").agg(F.count("*").alias("c")), "distinct-pieces").df
    whole = counted.where("c > 1").select("mhash", "chash", F.lit(0).alias("first"), F.expr(f"length(s) - {length - 1}").alias("upto"))
    sizes = counted.groupBy("mhash").agg(F.count("*").alias("kinds"), F.min("c").alias("least")).where("kinds > 1 AND least = 1")
    busy = counted.join(sizes.select("mhash", "kinds"), "mhash")
    few = (busy.where(f"kinds <= {hot}").select("mhash", "chash", "s").repartition("mhash").sortWithinPartitions("mhash")
           .mapInArrow(_compare(length), _MARK))

    def each_window(batches):
        for b in batches:
            out = [(mh, ch, i, xxhash.xxh3_128_digest(s[i:i + length])) for mh, ch, s in zip(*(b.column(j).to_pylist() for j in range(3)))
                   for i in range(len(s) - length + 1)]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(
                (pa.int64(), pa.int64(), pa.int32(), pa.binary()))], ["mhash", "chash", "first", "w"])

    single = busy.where(f"kinds > {hot}").select("mhash", "chash", "s").mapInArrow(each_window, "mhash long, chash long, first int, w binary")
    often = single.groupBy("w").count().where("count > 1").select("w")
    many = single.join(often, "w", "left_semi").selectExpr("mhash", "chash", "first", "first + 1 AS upto")
    marks = whole.union(few).union(many)
    spans = (at.select("key", "mhash", "chash", "off").join(marks, ["mhash", "chash"])
             .groupBy("key").agg(F.collect_set(F.struct((F.col("off") + F.col("first")).alias("a"),
                                                        (F.col("off") + F.col("upto") + (length - 1)).alias("b"))).alias("spans")))
    return keyed.join(spans, "key", "left").select("doc_id", "t", "spans")


def kept_bytes(raw: bytes, spans) -> tuple[bytes, int, int]:
    """(what is left, bytes removed, maximal removed runs) for any list of (a, b) spans."""
    merged: list[list[int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans or ()):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    out, at = [], 0
    for a, b in merged:
        out.append(raw[at:a])
        at = b
    out.append(raw[at:])
    return b"".join(out), sum(b - a for a, b in merged), len(merged)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, k: int = K,
                    hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept: bytes, kept_sha256) per row of ``docs``."""
    def run(batches):
        for b in batches:
            out = []
            for i, t, spans in zip(*(b.column(j).to_pylist() for j in range(3))):
                raw = t.encode()
                kept, removed, n = kept_bytes(raw, spans)
                out.append((i, len(raw), removed, n, kept, hashlib.sha256(kept).hexdigest()))
            types = (b.schema.field(0).type, pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return repeats(docs, id_col, text_col, length, k, hot).mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
