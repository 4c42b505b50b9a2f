"""SentencePiece encoding and decoding: merge-type (BPE) models by exact backtracking.

Merging joins, again and again, the adjacent pair whose piece scores best (the leftmost of equals). Its result is the one
sequence of pieces in which every two neighbours are what merging makes of their own concatenation. The encoder
therefore walks the text with the longest piece at each place (Aho-Corasick), keeps it if it is compatible with the piece before
(re-merging the two gives them back; remembered per pair), else tries the next shorter prefix. Where none is left, the place is
marked as failed in a bitfield and the piece before is shortened, so that no place is tried twice.

A text is first cut where no piece can reach across: before a word mark that follows another character, and around characters that are
in no piece of two or more. Short cuts are remembered (at most ``REMEMBERED``), since words repeat.

Characters without a piece become their UTF-8 byte pieces, or the unknown piece if the model has none. ``decode`` joins the
pieces: runs of byte pieces are read as UTF-8 (U+FFFD for each byte that is not), control pieces vanish, the blank that the encoder
put in front goes. Normalisation is the model's own.

Models other than merge-type ones, and those with user-defined or unused pieces, are refused when they are read.

Defined cases: null is the empty text; an empty text has no ids and decodes to itself; texts of any length are read whole; rows
repeat with their results; an empty table gives no rows; other columns pass through in ``row`` whatever their names."""

from __future__ import annotations

import hashlib
import math
import re

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
REMEMBERED, SHORT = 1 << 19, 48  # cuts and pairs that a worker remembers; the longest remembered cut
ROWS = 128  # rows of an output batch
UNKNOWN = " ⁇ "


class Bpe:
    """One model: ``encode(text)`` gives ids, ``decode(ids)`` the text."""

    def __init__(self, model: bytes):
        self.lib = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        kind = ["byte" if sp.is_byte(i) else "control" if sp.is_control(i) else "unknown" if sp.is_unknown(i) else
                "unused" if sp.is_unused(i) else "piece" for i in range(len(names))]
        if "unused" in kind:
            raise ValueError("models with unused pieces are not supported")
        self.id = {p: i for i, p in enumerate(names) if kind[i] == "piece"}
        self.score = {p: sp.get_score(i) for p, i in self.id.items()}
        self.byte = {int(p[1:-1], 16): i for i, p in enumerate(names) if kind[i] == "byte"}
        self.unk = sp.unk_id()
        self.surface = [bytes([int(p[1:-1], 16)]) if k == "byte" else b"" if k == "control" else UNKNOWN.encode() if k == "unknown"
                        else p.replace(MARK, " ").encode() for p, k in zip(names, kind)]
        self.silent = {i for i, k in enumerate(kind) if k == "control"}
        self.is_byte = [k == "byte" for k in kind]
        self.marked = {i for p, i in self.id.items() if p.startswith(MARK)}
        # every character of a piece is a symbol that merging starts from, with or without a piece of its own
        self.symbols = {c for p in self.id for c in p} | set(self.id)
        joined = {c for p in self.id if len(p) > 1 for c in p}
        free = not any(MARK in p.lstrip(MARK) for p in self.id)
        inner = "".join(map(re.escape, sorted(joined - {MARK} if free else joined)))
        start = f"{MARK}*[{inner}]+|{MARK}+" if free else f"[{inner}]+"
        self.cuts = re.compile(f"{start}|(?s:.)" if inner else "(?s:.)")
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for s in self.symbols:
            self.machine.add_word(s, len(s))
        self.machine.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.chains: dict[str, tuple[tuple[str, int], ...]] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self._probe()

    def _probe(self) -> None:
        """Refuses models whose pieces are not joined by their scores alone."""
        for p in sorted(self.id, key=len)[-50:] + [MARK + "ab cd" + MARK]:
            if self.encode(p) != self.lib.encode(p):
                raise ValueError("not a merge-type model, or one with user-defined pieces")

    def merge(self, text: str) -> list[str]:
        """Plain merging, for the short strings of the checks."""
        parts, score, none = list(text), self.score.get, -math.inf
        best = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while best and (top := max(best)) > none:
            at = best.index(top)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del best[at]
            if at:
                best[at - 1] = score(parts[at - 1] + parts[at], none)
            if at < len(best):
                best[at] = score(parts[at] + parts[at + 1], none)
        return parts

    def choices(self, piece: str) -> tuple[tuple[str, int], ...]:
        """The piece and its prefixes that merging can make, longest first, with their lengths."""
        got = self.chains.get(piece)
        if got is None:
            starts = (piece[:n] for n in range(len(piece), 0, -1))
            got = self.chains[piece] = tuple((s, len(s)) for s in starts if len(s) == 1 or s in self.id and self.merge(s) == [s])
        return got

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging leaves the two pieces as they are when one follows the other."""
        if len(self.pairs) >= REMEMBERED:
            self.pairs.clear()
        got = self.pairs[a, b] = self.merge(a + b) == [a, b]
        return got

    def split(self, cut: str) -> list[str]:
        """The pieces of a cut, by backtracking."""
        size = len(cut)
        longest = [1] * size  # a character that is in no piece stands alone
        for end, n in self.machine.iter(cut):  # a longer match of the same start ends later
            longest[end + 1 - n] = n
        chains, pairs = self.chains, self.pairs
        failed = bytearray(size // 8 + 1)
        out, at, last = [], 0, None
        piece = cut[:longest[0]]
        tries = chains.get(piece) or self.choices(piece)
        while at < size:
            for piece, n in tries:
                end = at + n
                if failed[end >> 3] >> (end & 7) & 1:
                    continue
                if last is None:
                    break
                fits = pairs.get((last, piece))
                if fits is None:
                    fits = self.compatible(last, piece)
                if fits:
                    break
            else:
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()  # the first place has no failure: merging always has a result
                at -= len(piece)
                last = out[-1] if out else None
                tries = self.choices(piece)[1:]
                continue
            out.append(piece)
            last, at = piece, end
            if at < size:
                piece = cut[at:at + longest[at]]
                tries = chains.get(piece) or self.choices(piece)
        return out

    def _ids(self, pieces: list[str]) -> tuple[int, ...]:
        try:
            return tuple([self.id[p] for p in pieces])
        except KeyError:
            ids = []
            for p in pieces:
                ids.extend([self.id[p]] if p in self.id else [self.byte[b] for b in p.encode()] if self.byte else [self.unk])
            return tuple(ids)

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        known = self.known
        for cut in self.cuts.findall(self.lib.normalize(text)):
            got = known.get(cut)
            if got is None:
                got = self._ids(self.split(cut))
                if len(cut) <= SHORT:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[cut] = got
            ids += got
        return self._joined_unknown(ids) if not self.byte else ids

    def _joined_unknown(self, ids: list[int]) -> list[int]:
        """Without byte pieces, neighbouring unknown characters are one unknown piece."""
        return [i for k, i in enumerate(ids) if i != self.unk or not k or ids[k - 1] != self.unk]

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(map(self.surface.__getitem__, ids))
        first = next((i for i in ids if i not in self.silent), None)
        if first in self.marked:
            raw = raw[1:]
        try:
            if self.silent.isdisjoint(ids):
                return raw.decode()
        except UnicodeDecodeError:
            pass
        return self._decode_runs(ids, first in self.marked)

    def _decode_runs(self, ids: list[int], drop: bool) -> str:
        """Each run of byte pieces is read by itself; a control piece ends a run."""
        out, run = [], bytearray()
        for i in [*ids, None]:
            if i is not None and self.is_byte[i]:
                run += self.surface[i]
                continue
            at = 0
            while at < len(run):
                for n in (4, 3, 2, 1, 0):
                    try:
                        c = bytes(run[at:at + n]).decode()
                    except UnicodeDecodeError:
                        continue
                    if len(c) == 1:
                        break
                out.append(c if n else "�")
                at += n or 1
            run.clear()
            if i is not None:
                out.append(self.surface[i].decode())
        text = "".join(out)
        return text[1:] if drop else text


_READ: dict[bytes, Bpe] = {}


def reader(model: bytes) -> Bpe:
    """The model, read once per Python worker."""
    key = hashlib.sha256(model).digest()
    if key not in _READ:
        _READ.clear()
        _READ[key] = Bpe(model)
    return _READ[key]


def encode(docs: DataFrame, model_path: str, text_col: str = "text", decoded: bool = True) -> DataFrame:
    """(row: the input's columns, ids array<int>, and decoded: the text of the ids) per row. The model file is read by the driver and
    sent to the tasks; it is as large as its vocabulary."""
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        bpe = reader(model.value)
        for b in batches:
            text = b.column(1)
            for at in range(0, b.num_rows, ROWS):
                ids = [bpe.encode(t) if t else [] for t in text.slice(at, ROWS).to_pylist()]
                cols = [b.column(0).slice(at, ROWS), pa.array(ids, pa.list_(pa.int32()))]
                if decoded:
                    cols.append(pa.array(map(bpe.decode, ids), pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names)

    names = ["row", "ids", "decoded"][:2 + decoded]
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text_col].alias("t"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, ids array<int>" + ", decoded string" * decoded
    return rows.mapInArrow(run, schema)


def decode(tokens: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """The frame with its ids' text as column ``decoded``; null ids are none."""
    with open(model_path, "rb") as f:
        model = tokens.sparkSession.sparkContext.broadcast(f.read())

    @F.pandas_udf("string")
    def text(ids):
        bpe = reader(model.value)
        return ids.map(lambda x: "" if x is None else bpe.decode([int(i) for i in x]))

    return tokens.withColumn("decoded", text(ids_col))
