"""SentencePiece encoding and decoding by suffix-array matching.

Pieces of a BPE or unigram vocabulary are found in a batch at once: the batch's distinct segments are joined to one
text, a suffix array indexes it, a binary search over the array narrows an interval for every piece character by
character, and the intervals list all occurrences. These edges, sorted by the position where they end, are relaxed
in that order: for a unigram model the best score up to each position is kept; for a BPE model the one edge that
fits the last piece before it, which gives exactly the merges' result (of all pieces that end at a position only
one is compatible with the encoding of what stands before it).

Texts are cut before each space mark that follows another character; no piece spans such a place, so segments can be
encoded apart and repeated ones once. So are the parts of segments of more than LONG characters, which are cut wherever
no piece holds the two characters that meet: no merge crosses such a place. Null texts give null ids, empty texts give none. Characters outside the
vocabulary become bytes. Rows repeat as in the input; empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
SEGMENT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_NEVER = -(1 << 40)
#: distinct segments that are remembered from batch to batch
MEMO = 400_000
#: characters of a segment above which it is cut within
LONG = 256


@dataclass
class Vocabulary:
    """Pieces with scores; `kind` is "bpe" or "unigram"."""

    pieces: list[str]
    scores: np.ndarray
    plain: np.ndarray  # pieces that text can contain
    byte_ids: list[int]
    unknown: int
    kind: str = "bpe"
    prefix: bool = True  # a space is put before every text
    parts: dict[int, tuple[int, int]] = field(default_factory=dict)

    @staticmethod
    def load(path: str, kind: str | None = None) -> Vocabulary:
        """The vocabulary of a model file. Models that normalise or split text in other ways than this module (see
        `unsupported`), or are of another kind than asked for, are an error."""
        from sentencepiece import SentencePieceProcessor

        with open(path, "rb") as f:
            proto = f.read()
        found, problems = unsupported(proto)
        if problems or kind not in (None, found):
            raise ValueError(f"{path} can't be encoded here: " + ", ".join(problems or [f"a {found} model, not {kind}"]))
        kind, model = found, SentencePieceProcessor(model_proto=proto)
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        special = np.array([model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) for i in range(n)])
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        v = Vocabulary(pieces, np.array([model.get_score(i) for i in range(n)]), ~special, byte_ids if model.is_byte(byte_ids[0]) else [], model.unk_id(), kind)
        return v.prepared()

    def prepared(self) -> Vocabulary:
        """For BPE: the two parts that merge into each piece last; pieces that merges never form are no longer plain."""
        if self.kind != "bpe":
            return self
        ids = {p: i for i, p in enumerate(self.pieces) if self.plain[i]}
        for p, i in list(ids.items()):
            if len(p) > 1:
                last = self._merge(p, ids)
                if last is None:
                    self.plain[i] = False
                else:
                    self.parts[i] = last
        return self

    def _merge(self, text: str, ids: dict[str, int]) -> tuple[int, int] | None:
        """The last merge if the merges of `text` end in one piece."""
        at, last = list(text), None
        while len(at) > 1:
            best = max(((self.scores[ids[a + b]], -k) for k, (a, b) in enumerate(zip(at, at[1:], strict=False)) if a + b in ids), default=None)
            if best is None:
                return None
            k = -best[1]
            last = (ids.get(at[k], -1), ids.get(at[k + 1], -1))
            at[k : k + 2] = [at[k] + at[k + 1]]
        return last


#: fields of a model file (fixed values of its format): pieces, trainer and normaliser, and what is read of them
PIECES, TRAINER, NORMALISER = 1, 2, 3
PIECE_TYPE, USER_DEFINED = 3, 4
MODEL_TYPE, SPACE_SUFFIX = 3, 24
CHARACTER_MAP, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES = 2, 3, 4, 5


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a protocol buffer's fields."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = message[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(message):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(tag & 7) or number()
        yield tag >> 3, message[at : at + size]
        at += size


def unsupported(proto: bytes) -> tuple[str, list[str]]:
    """A model's kind, and what of it this module doesn't do: other kinds, character maps, user-defined pieces, no space
    before the text, removed or unescaped spaces, spaces as suffixes."""
    whole = list(_fields(proto))
    trainer = dict(x for n, m in whole if n == TRAINER for x in _fields(m))
    normaliser = dict(x for n, m in whole if n == NORMALISER for x in _fields(m))
    kind = {1: "unigram", 2: "bpe", 3: "word", 4: "char"}.get(trainer.get(MODEL_TYPE, 1), "other")
    tests = {
        f"a {kind} model": kind not in ("unigram", "bpe"), "a map of characters": bool(normaliser.get(CHARACTER_MAP)), "no space before the text": normaliser.get(DUMMY_PREFIX, 1) == 0,
        "removed spaces": normaliser.get(REMOVE_SPACES, 1) == 1, "unescaped spaces": normaliser.get(ESCAPE_SPACES, 1) == 0, "spaces as suffixes": trainer.get(SPACE_SUFFIX, 0) == 1,
        "pieces of the user": any(n == PIECES and dict(_fields(m)).get(PIECE_TYPE, 1) == USER_DEFINED for n, m in whole),
    }
    return kind, [what for what, is_so in tests.items() if is_so]


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first `depth` codes at least: ranked by as many codes as fit in one number, then
    by twice as many, and so on."""
    n = len(codes)
    symbols, rank = np.unique(codes, return_inverse=True)
    bits = int(len(symbols)).bit_length()
    rank = rank.astype(np.int64) + 1  # 0 stands beyond the end
    width = 1
    while True:
        each = max(2, 62 // bits)
        key = rank.copy()
        for k in range(1, each):
            key <<= bits
            key[: max(0, n - k * width)] |= rank[k * width :]
        order = np.argsort(key, kind="stable")
        width *= each
        if width >= depth or width >= n:
            return order
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = 1 + np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        bits = int(rank.max() + 1).bit_length()


class Matcher:
    """Encodes segments with one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = v = vocabulary
        self.ids = np.flatnonzero(v.plain)
        self.length = np.array([len(v.pieces[i]) for i in self.ids], np.int64)
        self.longest = int(self.length.max(initial=1))
        self.codes = np.zeros((len(self.ids), self.longest), np.int64)
        for k, i in enumerate(self.ids):
            self.codes[k, : self.length[k]] = np.frombuffer(v.pieces[i].encode("utf-32-le"), np.uint32)
        ahead = [(self.codes[:, k] << 21 | self.codes[:, k + 1])[self.length > k + 1] for k in range(self.longest - 1)]
        self.neighbours = np.unique(np.concatenate([np.zeros(0, np.int64), *ahead]))  # characters that meet in some piece
        n = len(v.pieces)
        self.rank = np.zeros(n + 1, np.int64)  # place in the order of merging
        self.rank[self.ids] = np.unique(-v.scores[self.ids], return_inverse=True)[1]
        self.left = np.arange(n + 1)
        self.right = np.arange(n + 1)
        for i, (a, b) in v.parts.items():
            self.left[i], self.right[i] = a, b
        both = {v.pieces[i]: i for i in self.ids}
        merged = {}
        self.base = n + 1
        for i in self.ids:  # every way to put two pieces together to a third
            p = v.pieces[i]
            for k in range(1, len(p)):
                if p[:k] in both and p[k:] in both:
                    merged[both[p[:k]] * self.base + both[p[k:]]] = i
        self.pair_keys = np.array(sorted(merged), np.int64)
        self.pair_ids = np.array([merged[k] for k in self.pair_keys.tolist()], np.int64)
        self._forget()
        self.byte_of = {i: b for b, i in enumerate(v.byte_ids)}
        self.is_byte = np.zeros(n, bool)
        self.is_byte[v.byte_ids] = True
        self.text_of = [p.replace(SPACE, " ") if len(p) < 2 or not p.startswith("<") or v.plain[i] else "" for i, p in enumerate(v.pieces)]

    def occurrences(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and piece numbers (rows of self.codes) of all pieces in the text."""
        order = suffix_array(text, self.longest)
        n = len(text)
        padded = np.concatenate([text, np.full(self.longest + 1, -1)])
        low, high = np.zeros(len(self.ids), np.int64), np.full(len(self.ids), n, np.int64)
        for depth in range(self.longest):
            live = np.flatnonzero((self.length > depth) & (low < high))
            want = self.codes[live, depth]
            for bound, strict in ((low, False), (high, True)):
                a, b = low[live].copy(), high[live].copy()
                while (open_ := a < b).any():
                    mid = (a + b) >> 1
                    have = padded[order[np.minimum(mid, n - 1)] + depth]
                    less = (have <= want) if strict else (have < want)
                    a = np.where(open_ & less, mid + 1, a)
                    b = np.where(open_ & ~less, mid, b)
                if strict:
                    new_high = a
                else:
                    new_low = a
                del bound
            low[live], high[live] = new_low, new_high
        count = np.maximum(high - low, 0)
        which = np.repeat(np.arange(len(self.ids), dtype=np.int32), count)
        inside = np.arange(len(which)) + np.repeat(low - np.cumsum(count) + count, count)
        return order.astype(np.int32 if n < 1 << 30 else np.int64)[inside], which

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves piece b apart from piece a before it: no merge across their border comes first.

        The walk undoes merges from both sides: at each time the two pieces at the border would merge at the rank of
        their joint piece; that must not precede the merge that made the later of the two.
        """
        key = a * self.base + b
        pairs, inverse = np.unique(key, return_inverse=True)
        left, right = pairs // self.base, pairs % self.base
        far = np.int64(1 << 60)
        limit, good, live = np.full(len(pairs), far), np.ones(len(pairs), bool), np.ones(len(pairs), bool)
        while live.any():
            at = np.flatnonzero(live)
            l, r = left[at], right[at]
            k = l * self.base + r
            where = np.minimum(np.searchsorted(self.pair_keys, k), len(self.pair_keys) - 1)
            joint = np.where(self.pair_keys[where] == k, self.rank[self.pair_ids[where]], far) if len(self.pair_keys) else np.full(len(at), far)
            bad = joint < limit[at]
            split_l, split_r = self.right[l] != l, self.left[r] != r
            made_l, made_r = np.where(split_l, self.rank[l], -1), np.where(split_r, self.rank[r], -1)
            # undo the later of the two merges; of equal pieces the right one, which is made last
            go_left = made_l > made_r
            limit[at] = np.maximum(made_l, made_r) + np.where(go_left, 0, 1)  # at one rank the border's pair is left of the right piece
            left[at] = np.where(go_left, self.right[l], l)
            right[at] = np.where(go_left, r, self.left[r])
            good[at[bad]] = False
            live[at[bad | ~(split_l | split_r)]] = False
        return good[inverse]

    def apart(self, segment: str) -> list[str]:
        """The parts of a segment between places that no piece spans."""
        c = np.frombuffer(segment.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        cuts = 1 + np.flatnonzero(~np.isin(c[:-1] << 21 | c[1:], self.neighbours))
        ends = [0, *cuts.tolist(), len(segment)]
        return [segment[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    def _forget(self) -> None:
        """Drops the segments that were met, which are encoded once."""
        self.table: dict[str, int] = {}
        self.store, self.ends, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct segments, one after the other, and how many each has."""
        if not segments:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        sizes = np.array([len(s) for s in segments], np.int64)
        text = np.frombuffer("\0".join([*segments, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        begin = np.cumsum(sizes + 1) - sizes - 1
        text[begin + sizes] = -2  # no piece has it, whatever the segments hold
        n = len(text)
        start, which = self.occurrences(text)
        size = self.length.astype(start.dtype)[which]
        end, piece = start + size, self.ids.astype(np.int32)[which]
        covered = np.zeros(n, bool)
        covered[start[size == 1]] = True
        opening = np.repeat(begin.astype(start.dtype), sizes + 1)  # of the segment a position is in
        del which, size
        lone = np.flatnonzero(~covered & (text != -2))  # characters outside the vocabulary
        unknown = len(self.v.pieces)
        if len(lone):
            lone = lone.astype(start.dtype)
            start, end = np.concatenate([start, lone]), np.concatenate([end, lone + 1])
            piece = np.concatenate([piece, np.full(len(lone), unknown, np.int32)])
        step = end - opening[start]
        order = np.argsort(step.astype(np.int16) if step.max() < 1 << 15 else step, kind="stable")
        start, end, piece, step = start[order], end[order], piece[order], step[order]
        cuts = np.searchsorted(step, np.arange(1, int(step[-1]) + 2))
        last = np.full(n + 1, -1, np.int64)  # piece that ends at a position
        come = np.full(n + 1, -1, np.int64)
        fresh = np.zeros(n + 1, bool)
        fresh[begin] = True
        score = np.full(n + 1, float(_NEVER))
        score[begin] = 0.0
        worst = float(self.v.scores[self.ids].min(initial=0)) - 10
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            s, e, p = start[lo:hi], end[lo:hi], piece[lo:hi]
            if self.v.kind == "bpe":
                ok = fresh[s] | (p == unknown) | (last[s] == unknown)
                ask = np.flatnonzero(~ok & (last[s] >= 0))
                ok[ask] = self.compatible(last[s[ask]], p[ask].astype(np.int64))
            else:
                gain = score[s] + np.where(p == unknown, worst, self.v.scores[np.minimum(p, unknown - 1)])
                by = np.lexsort((-gain, e))
                first = np.ones(len(by), bool)
                first[1:] = e[by][1:] != e[by][:-1]
                ok = np.zeros(len(by), bool)
                ok[by[first]] = True
                score[e[ok]] = gain[ok]
            last[e[ok]], come[e[ok]] = p[ok], s[ok]
        # back from the ends of all segments at once
        lost = np.flatnonzero(last[begin + sizes] < 0)  # none, unless scores contradict the parts of pieces
        at, live, found = begin + sizes, np.flatnonzero(last[begin + sizes] >= 0), []
        at = at[live]
        while len(live):
            found.append((live, last[at], come[at]))
            at = come[at]
            go = at > begin[live]
            live, at = live[go], at[go]
        for k in lost:
            pieces, where = self.merged(segments[k])
            found += [(np.array([k]), np.array([p]), np.array([begin[k] + w])) for p, w in zip(pieces[::-1], where[::-1], strict=True)]
        owner, piece, place = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(place)  # segments lie one after the other in the text
        owner, piece, place = owner[order], piece[order], place[order]
        alien = np.flatnonzero(piece == unknown)
        if len(alien):
            raw = [chr(int(c)).encode("utf-8", "surrogatepass") if self.v.byte_ids else b"?" for c in text[place[alien]]]
            times = np.ones(len(piece), np.int64)
            times[alien] = [len(x) for x in raw]
            owner, wide = np.repeat(owner, times), np.repeat(piece, times)
            values = np.frombuffer(b"".join(raw), np.uint8)
            wide[wide == unknown] = np.array(self.v.byte_ids)[values] if self.v.byte_ids else self.v.unknown
            piece = wide
        return piece.astype(np.int32), np.bincount(owner, minlength=len(segments))

    def merged(self, segment: str) -> tuple[list[int], list[int]]:
        """By plain merging, pair by pair."""
        ids = {self.v.pieces[i]: i for i in self.ids}
        at = list(segment)
        while True:
            best = max(((self.v.scores[ids[a + b]], -k) for k, (a, b) in enumerate(zip(at, at[1:], strict=False)) if a + b in ids), default=None)
            if best is None:
                break
            at[-best[1] : 2 - best[1]] = [at[-best[1]] + at[1 - best[1]]]
        return [ids.get(p, len(self.v.pieces)) for p in at], np.cumsum([0, *map(len, at[:-1])]).tolist()

    def encode_texts(self, texts: list[str | None]) -> list[np.ndarray | None]:
        if len(self.table) > MEMO:
            self._forget()
        old, table = len(self.table), self.table
        add = table.setdefault
        flat: list[int] = []
        counts = []
        for t in texts:
            before = len(flat)
            if t:
                marked = (SPACE + t if self.v.prefix else t).replace(" ", SPACE)
                segments = SEGMENT.findall(marked)
                if max(map(len, segments)) > LONG:
                    segments = [p for s in segments for p in (self.apart(s) if len(s) > LONG else [s])]
                flat += [add(s, len(table)) for s in segments]
            counts.append(len(flat) - before)
        ids, sizes = self.encode(list(islice(table, old, None)))
        self.ends = np.concatenate([self.ends, len(self.store) + np.cumsum(sizes)])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.store = np.concatenate([self.store, ids])
        segment = np.array(flat, np.int64)
        size = self.sizes[segment]
        ends = np.cumsum(size)
        every = self.store[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.ends[segment] - ends, size)]
        cut = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return [None if t is None else every[a:b] for t, a, b in zip(texts, cut, cut[1:], strict=False)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: bytes are joined, space marks become spaces, the space before the text goes."""
        if not self.is_byte[ids].any():
            text = "".join([self.text_of[i] for i in ids.tolist()])
            return text[1:] if self.v.prefix and text.startswith(" ") else text
        out, raw = [], bytearray()
        for i in ids.tolist():
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append(self.text_of[i])
        out.append(raw.decode("utf-8", "replace"))
        text = "".join(out)
        return text[1:] if self.v.prefix and text.startswith(" ") else text


def _lists(arrays: list[np.ndarray | None]) -> pa.ListArray:
    ends = np.cumsum([0, *(0 if x is None else len(x) for x in arrays)]).astype(np.int32)
    values = np.concatenate([x for x in arrays if x is not None] or [np.zeros(0, np.int32)])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()), mask=pa.array([x is None for x in arrays]))


#: characters of text that are indexed at a time
CHUNK = 500_000


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", kind: str | None = None, decode: bool = True) -> DataFrame:
    """id, n_tokens, ids and (with `decode`) round_trip: whether decoding the ids gives the text back.

    The vocabulary (its size does not depend on the corpus) is read by the driver and broadcast.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path, kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(vocabulary.value)
        for batch in batches:
            column, begin = batch.column("text"), 0
            held = np.cumsum(pc.fill_null(pc.utf8_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            while begin < len(column):
                done = int(held[begin - 1]) if begin else 0
                end = max(begin + 1, int(np.searchsorted(held, done + CHUNK, side="right")))
                texts = column.slice(begin, end - begin).to_pylist()
                coded = matcher.encode_texts(texts)
                columns = [batch.column("id").slice(begin, end - begin), pa.array([None if c is None else len(c) for c in coded], pa.int64()), _lists(coded)]
                if decode:
                    columns.append(pa.array([None if c is None else matcher.decode(c) == t for c, t in zip(coded, texts, strict=True)], pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n_tokens", "ids", *(["round_trip"] if decode else [])])
                begin = end

    kind_of_id = docs.select(id_col).schema[0].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, f"id {kind_of_id}, n_tokens long, ids array<int>" + (", round_trip boolean" if decode else "")).withColumnRenamed("id", id_col)


def decode_pieces(tokens: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids", kind: str | None = None) -> DataFrame:
    """id and text, from arrays of ids; null for null arrays."""
    vocabulary = tokens.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path, kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(vocabulary.value)
        for batch in batches:
            texts = [None if x is None else matcher.decode(np.array(x, np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], names=["id", "text"])

    kind_of_id = tokens.select(id_col).schema[0].dataType.simpleString()
    return tokens.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"id {kind_of_id}, text string").withColumnRenamed("id", id_col)
