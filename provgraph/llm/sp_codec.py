"""SentencePiece encoding and decoding with a batched numpy Viterbi search.

Texts are cut into units that no piece can cross (a run of spaces with the word
behind it, a run of line ends), which a worker knows again by their 64-bit
hashes. New units of one length form a matrix, and its rows advance together: for every end position, hashes of
all substrings that end there probe a table of bits and then the sorted hashes
of all pieces, and the candidate with the largest sum of scores is stored as its
row's backpointer.

Unigram models need no more. For BPE models (merges by score) the best last
piece of a prefix is the one that merging would leave there: a segmentation is
the merge result exactly if each two neighbouring pieces are, so a candidate is
admitted only if it is compatible with the piece before it. Undoing the two
pieces' own merges, latest first, decides that; pairs are decided together too.
Ids equal the library's.

Models that normalise texts, drop white space or define symbols of their own
are refused, as their ids would differ.

Characters without a piece become byte pieces where the model has them, else the
unknown piece. Defined results: null text counts as empty and has no ids; ids
outside the vocabulary are refused; U+2581 in a text decodes to a space.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provgraph.llm.common import GATHERED, HASH_BASE, HASH_MIX, map_texts, span_keys, text_of

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SPACE_MARK = "▁"
#: Characters of the words that advance together, and distinct units that a worker remembers.
BLOCK = 1 << 17
#: Slots of the table in which units are known again.
KNOWN = 1 << 21
#: A substring's hash first looks at one of 2^PROBE bits.
PROBE = 20
REMEMBERED = 1 << 19
NO_PIECE = -1
#: Remembered pairs of neighbouring pieces.
MEMO = 1 << 21


@dataclass
class Model:
    """Pieces of a vocabulary and the tables that searches need; small enough to travel with a task."""

    pieces: list[str]
    scores: np.ndarray
    kinds: np.ndarray  # 0 normal, 1 unknown, 2 control, 3 byte, 4 unused
    merges: bool
    longest: int = 0
    keys: np.ndarray = field(default=None, repr=False)
    probe: np.ndarray = field(default=None, repr=False)
    key_ids: np.ndarray = field(default=None, repr=False)
    left: np.ndarray = field(default=None, repr=False)
    right: np.ndarray = field(default=None, repr=False)
    rank: np.ndarray = field(default=None, repr=False)
    reached: np.ndarray = field(default=None, repr=False)
    name: str = ""

    @classmethod
    def load(cls, path: str = MODEL_PATH) -> Model:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        processor = SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(processor.serialized_model_proto())
        how = proto.normalizer_spec
        if how.precompiled_charsmap or not how.add_dummy_prefix or how.remove_extra_whitespaces or not how.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models that normalise texts or treat white space in another way aren't supported")
        if any(p.type == 4 for p in proto.pieces):
            raise ValueError("symbols that a user defined aren't supported")
        kind = {1: 0, 2: 1, 3: 2, 5: 4, 6: 3}
        model = cls([p.piece for p in proto.pieces], np.array([p.score for p in proto.pieces]), np.array([kind[p.type] for p in proto.pieces], np.int8), proto.trainer_spec.model_type == 2)
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) or "\n" in p for p, k in zip(model.pieces, model.kinds, strict=True) if k == 0):
            raise ValueError("pieces that cross words or lines aren't supported")
        model.prepare()
        return model

    def prepare(self) -> None:
        normal = np.flatnonzero(self.kinds == 0)
        self.name = hashlib.sha256("\n".join(self.pieces).encode() + self.scores.tobytes()).hexdigest()
        self.longest = max((len(self.pieces[i]) for i in normal), default=1)
        hashes = np.array([hash_of(self.pieces[i]) for i in normal], np.uint64)
        order = np.argsort(hashes)
        self.keys, self.key_ids = hashes[order], normal[order].astype(np.int64)
        if len(np.unique(self.keys)) != len(self.keys):
            raise ValueError("two pieces have one hash")
        self.probe = np.zeros(1 << PROBE, bool)
        self.probe[slot_of(self.keys)] = True
        if self.merges:
            self._undo()

    def _undo(self) -> None:
        """The last merge of each piece, and its rank: the lower the earlier it is merged. Pieces that merging never makes are marked."""
        ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == 0}
        n = len(self.pieces)
        self.rank = np.full(n + 1, np.iinfo(np.int64).max, np.int64)  # the last row stands for characters without a piece
        self.rank[:n] = np.unique(-self.scores, return_inverse=True)[1]
        self.left, self.right = np.arange(n + 1), np.arange(n + 1)
        self.reached = np.zeros(n + 1, bool)
        self.reached[n] = True
        for piece, i in ids.items():
            parts, last = list(piece), None
            while len(parts) > 1:
                found = [(self.rank[ids[a + b]], at) for at, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ids]
                if not found:
                    break
                at = min(found)[1]
                last = (parts[at], parts[at + 1])
                parts[at : at + 2] = ["".join(last)]
            self.reached[i] = len(parts) == 1
            if self.reached[i] and last:
                self.left[i], self.right[i] = ids.get(last[0], n), ids.get(last[1], n)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece ids of substring hashes; NO_PIECE where there is none."""
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.key_ids[at], NO_PIECE)


def hash_of(text: str) -> np.uint64:
    value = 0
    for c in text:
        value = (value * int(HASH_BASE) + ord(c) + 1) % 2**64
    return np.uint64(value)


def slot_of(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * HASH_MIX) >> np.uint64(64 - PROBE)).view(np.int64)


def gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[start : start + size] of all, joined; done in parts that bound the memory of positions."""
    ends = np.cumsum(sizes)
    out = np.empty(int(ends[-1]) if len(ends) else 0, values.dtype)
    first = 0
    while first < len(sizes):
        before = int(ends[first] - sizes[first])
        last = max(first + 1, int(np.searchsorted(ends, before + GATHERED, side="right")))
        size = sizes[first:last]
        at = np.repeat(starts[first:last] - (ends[first:last] - size - before), size)
        at += np.arange(len(at))
        out[before : before + len(at)] = values[at]
        first = last
    return out


def unit_starts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points of all texts with marks for spaces, where units start, units of each text); empty texts have none."""
    lengths = np.array([len(t) + 1 if t else 0 for t in texts])
    codes = np.frombuffer("".join(SPACE_MARK + t for t in texts if t).encode("utf-32-le", "surrogatepass"), np.uint32)
    space, line = (codes == ord(" ")) | (codes == ord(SPACE_MARK)), codes == ord("\n")
    codes = np.where(space, np.uint32(ord(SPACE_MARK)), codes)
    start = np.zeros(len(codes), bool)
    # A space or a line end that the same does not precede starts a unit, as does anything behind a line end.
    start[1:] = (space[1:] & ~space[:-1]) | (line[1:] ^ line[:-1])
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    start[offsets[:-1][lengths > 0]] = True
    begins = np.flatnonzero(start)
    return codes, begins, np.diff(np.searchsorted(begins, offsets))


class Encoder:
    """Viterbi search over distinct units; what was found once is kept."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()
        self.hash_powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(model.longest, HASH_BASE)]))
        lengths = [len(p) if k == 0 else 1 for p, k in zip(model.pieces, model.kinds, strict=True)]
        self.length = np.array([*lengths, 1])
        whole = [hash_of(p) if k == 0 else np.uint64(0) for p, k in zip(model.pieces, model.kinds, strict=True)]
        self.whole = np.array([*whole, np.uint64(0)], np.uint64)
        bytes_ = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k == 3}
        self.byte_ids = [bytes_[b] for b in range(256)] if len(bytes_) == 256 else None
        self.unknown = int(np.flatnonzero(model.kinds == 1)[0])
        self.memo_keys, self.memo = np.full(MEMO, -1, np.int64), np.zeros(MEMO, bool)

    def forget(self) -> None:
        self.slots, self.keys = np.full(KNOWN, -1, np.int32), np.zeros(0, np.uint64)
        self.ids, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def places(self, keys: np.ndarray) -> list[np.ndarray]:
        """The two slots of each unit."""
        return [(keys >> np.uint64(shift)).view(np.int64) % KNOWN for shift in (43, 20)]

    def known(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of units, -1 where one is new (or lost both its slots to others)."""
        number = np.full(len(keys), -1, np.int64)
        if len(self.keys):
            for slot in self.places(keys):
                found = self.slots[slot]
                same = (found >= 0) & (self.keys[found] == keys)
                number[same] = found[same]
        return number

    def remember(self, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        first = len(self.keys)
        self.starts = np.append(self.starts, len(self.ids) + np.cumsum(sizes) - sizes)
        self.keys, self.sizes, self.ids = np.append(self.keys, keys), np.append(self.sizes, sizes), np.append(self.ids, ids)
        one, two = self.places(keys)
        number = np.arange(first, len(self.keys), dtype=np.int32)
        taken = self.slots[one] >= 0
        self.slots[np.where(taken, two, one)] = number

    def compatible(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """`undone` for pairs, most of which a direct-mapped table remembers."""
        key = first * (len(self.model.pieces) + 1) + second
        slot = key * 0x9E3779B1 % MEMO
        good = self.memo[slot]
        new = np.flatnonzero(self.memo_keys[slot] != key)
        if len(new):
            fresh, at, back = np.unique(key[new], return_index=True, return_inverse=True)
            found = self.undone(first[new[at]], second[new[at]])
            good[new] = found[back]
            self.memo_keys[slot[new[at]]], self.memo[slot[new[at]]] = fresh, found
        return good

    def undone(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether merging leaves `first` and `second` apart, for pairs of reached pieces.

        The later made of the two pieces is undone again and again, down to the
        characters at the border; a pair across the border that merges before
        what was undone last is one that merging would have preferred.
        """
        m, none = self.model, len(self.model.pieces)
        first, second = first.copy(), second.copy()
        good, open_ = np.ones(len(first), bool), np.arange(len(first))
        limit = np.full(len(first), np.iinfo(np.int64).max)
        while len(open_):
            a, b = first[open_], second[open_]
            size = self.length[a] + self.length[b]
            both = np.where((a == none) | (b == none) | (size > m.longest), NO_PIECE, m.find(self.whole[a] * self.hash_powers[np.minimum(self.length[b], m.longest)] + self.whole[b]))
            # Twice the rank leaves room to say that at equal ranks the left place merges first.
            across = np.where(both == NO_PIECE, np.iinfo(np.int64).max, 2 * m.rank[both])
            bad = across < limit[open_]
            good[open_[bad]] = False
            single_a, single_b = m.left[a] == a, m.left[b] == b
            made_a, made_b = np.where(single_a, -1, 2 * m.rank[a]), np.where(single_b, -1, 2 * m.rank[b] + 1)
            undo_a = made_a > made_b
            limit[open_] = np.where(undo_a, made_a, made_b)
            first[open_] = np.where(undo_a, m.right[a], a)
            second[open_] = np.where(undo_a, b, m.left[b])
            open_ = open_[~bad & ~(single_a & single_b)]
        return good

    def search(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, joined; number of each word's) for words of one length, the columns of `points`."""
        m, none = self.model, len(self.model.pieces)
        size, n = points.shape
        prefix = np.zeros((size + 1, n), np.uint64)
        for i in range(size):
            prefix[i + 1] = prefix[i] * HASH_BASE + points[i].astype(np.uint64) + np.uint64(1)
        scores = np.append(m.scores, m.scores.min() - 10)
        best = np.full((size + 1, n), -np.inf)
        best[0] = 0
        last = np.full((size + 1, n), none, np.int64)
        for end in range(1, size + 1):
            low = max(0, end - m.longest)
            hashes = prefix[end] - prefix[low:end] * self.hash_powers[end - low : 0 : -1, None]
            hit = m.probe[slot_of(hashes)]
            hit[-1] = True  # single characters always count, with or without a piece
            hit &= best[low:end] > -np.inf
            start, row = np.nonzero(hit)
            piece = m.find(hashes[start, row])
            start += low
            piece[(piece == NO_PIECE) & (start == end - 1)] = none
            fine = piece != NO_PIECE
            if m.merges:
                fine[fine] = m.reached[piece[fine]]
                inner = np.flatnonzero(fine & (start > 0))
                fine[inner] = self.compatible(last[start[inner], row[inner]], piece[inner])
            start, row, piece = start[fine], row[fine], piece[fine]
            value = best[start, row] + scores[piece]
            np.maximum.at(best[end], row, value)
            top = np.flatnonzero(value == best[end][row])[::-1]  # of equal sums the longest piece
            last[end, row[top]] = piece[top]
        steps, at, every = [], np.full(n, size), np.arange(n)
        while at.any():
            piece = np.where(at > 0, last[at, every], 0)
            spelled = np.where(piece == none, ~points[np.maximum(at - 1, 0), every].astype(np.int64), piece)
            steps.append((spelled, at > 0))
            at = np.where(at > 0, at - self.length[piece], 0)
        found = np.stack([x for x, _ in steps[::-1]], axis=1)
        used = np.stack([x for _, x in steps[::-1]], axis=1)
        counts = used.sum(1)
        flat = found[used]
        if not (flat < 0).any():
            return flat.astype(np.int32), counts
        each = [self._bytes(x.tolist()) for x in np.split(flat, np.cumsum(counts)[:-1])]
        return np.concatenate(each), np.array([len(x) for x in each])

    def _bytes(self, found: list[int]) -> np.ndarray:
        if any(p < 0 for p in found):
            spelled = []
            for p in found:
                if p >= 0:
                    spelled.append(p)
                elif self.byte_ids:
                    spelled += [self.byte_ids[b] for b in chr(~p).encode("utf-8", "surrogatepass")]
                elif not spelled or spelled[-1] != self.unknown:
                    spelled.append(self.unknown)
            found = spelled
        return np.array(found, np.int32)

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, joined; number of each text's)."""
        if len(self.keys) > REMEMBERED:
            self.forget()
        codes, begins, n = unit_starts(texts)
        keys = span_keys(codes, begins, np.append(begins[1:], len(codes)))
        number = self.known(keys)
        new = np.flatnonzero(number < 0)
        if len(new):
            fresh, at, back = np.unique(keys[new], return_index=True, return_inverse=True)
            at = new[at]
            length = np.diff(np.append(begins, len(codes)))[at]
            order = np.argsort(length, kind="stable")
            ids, sizes = [], []
            for group in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                size = int(length[group[0]])
                step = max(1, BLOCK // size)
                for i in range(0, len(group), step):
                    where = begins[at[group[i : i + step]]]
                    found, counts = self.search(codes[where[None, :] + np.arange(size)[:, None]])
                    ids.append(found)
                    sizes.append(counts)
            place = np.empty(len(order), np.int64)
            place[order] = len(self.keys) + np.arange(len(order))
            self.remember(fresh[order], np.concatenate(ids), np.concatenate(sizes))
            number[new] = place[back]
        sizes = self.sizes[number]
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(n)]).astype(np.int64)]
        return gathered(self.ids, self.starts[number], sizes), np.diff(ends)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        ids, counts = self.encode_all(texts)
        return np.split(ids, np.cumsum(counts)[:-1]) if len(counts) else []


class Decoder:
    """Ids to texts: the bytes of all pieces stand in one array, from which a batch is gathered."""

    def __init__(self, model: Model):
        parts = [bytes([int(p[3:5], 16)]) if k == 3 else b"" if k == 2 else " ⁇ ".encode() if k == 1 else p.replace(SPACE_MARK, " ").encode() for p, k in zip(model.pieces, model.kinds, strict=True)]
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)
        self.sizes = np.array([len(p) for p in parts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def decode_all(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.sizes)):
            raise ValueError("an id is outside the vocabulary")
        sizes = self.sizes[ids]
        joined = gathered(self.bytes, self.starts[ids], sizes).tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)].tolist()
        texts = [joined[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:], strict=False)]
        return [t[1:] if t[:1] == " " else t for t in texts]

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_all(np.asarray(ids, np.int64), np.array([len(ids)]))[0]


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(model: Model) -> Encoder:
    """One encoder for each model in a process, so that later tasks find what earlier ones searched."""
    if model.name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[model.name] = Encoder(model)
    return _ENCODERS[model.name]


def encode(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_ids, ids and whether the ids decode to the text again."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the vocabulary, whatever the documents

    def begin() -> Callable[[list[str]], dict]:
        encoder, decoder = encoder_of(shared.value), Decoder(shared.value)

        def work(texts: list[str]) -> dict:
            ids, counts = encoder.encode_all(texts)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            again = decoder.decode_all(ids, counts)
            return {"n_ids": counts, "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)), "round_trip": [a == t for a, t in zip(again, texts, strict=True)]}

        return work

    return map_texts(rows, "n_ids long, ids array<int>, round_trip boolean", begin)


def decode(encoded: DataFrame, model: Model, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id and the text of a list of ids; null lists give null."""
    rows = encoded.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("text"))
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def begin() -> Callable[[list], dict]:
        decoder = Decoder(shared.value)
        return lambda lists: {"decoded": [None if x is None else decoder.decode(np.array(x, np.int64)) for x in lists]}

    return map_texts(rows, "decoded string", begin).withColumnRenamed("decoded", "text")
