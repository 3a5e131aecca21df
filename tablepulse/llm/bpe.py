"""Byte-level BPE encoding and decoding as a monoid tree reduction.

Token sequences form a monoid: ``join(encode(a), encode(b)) == encode(a + b)``.
A piece (one match of the pattern) is halved until a half is at most
``LEAF_BYTES`` long, each leaf is encoded by merges of lowest rank (all leaves
of a batch at once), and neighbours are joined on the way up. A join re-encodes a window around the
boundary and lets it grow on a side until the token outside and the first
token inside are a pair that stays as it is when encoded on its own. A
sequence whose adjacent pairs all stay as they are is the encoding of its
bytes, so the tokens outside the window are then final. Windows stay a few
tokens wide, and a piece of n bytes costs about n log n steps instead of n**2.

Decoding concatenates the tokens' bytes up the same kind of tree.

Texts are whole; a text is a row and no rows are moved between tasks, so there
is no shuffle, no skew and a lost task is just run again. The vocabulary (a few
tens of thousands of ranks) is broadcast once.

Defined cases: a null text counts as empty; an empty text has no tokens; an
empty table gives no rows; repeated rows and null ids are encoded like any
other; other columns are dropped. An id outside the vocabulary raises an error
in decoding.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tablepulse.llm.common import filled, small_batches

#: halves of at most so many bytes are encoded by merges
LEAF_BYTES = 16
#: pieces, leaves and pairs that a task remembers (up to twice as many); others are encoded again
CACHED = 100_000
#: decoded without halving
LEAF_TOKENS = 1 << 16
#: texts of more characters are encoded by so many pieces at a time
TEXT_CHARS, TEXT_PIECES = 1 << 22, 1 << 18


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Recent:
    """What was found lately: at least the last ``most`` different keys kept, and never more than twice as many."""

    def __init__(self, most: int = CACHED):
        self.most = most
        self.new: dict = {}
        self.old: dict = {}

    def get(self, key):
        found = self.new.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.keep(key, found)
        return found

    def keep(self, key, value) -> None:
        if len(self.new) >= self.most:
            self.old, self.new = self.new, {}
        self.new[key] = value


class Codec:
    """Encoding and decoding by one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.regex = regex.compile(pattern)
        size = max(ranks.values(), default=-1) + 1
        self.bytes_of = [b""] * size
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        # all tokens' bytes one after the other, and where each begins, for decoding
        self.begins = np.concatenate([[0], np.cumsum([len(t) for t in self.bytes_of])]).astype(np.int64)
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        # the token that a pair of tokens merges to, which is also the pair's rank
        self.of_byte = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int64)
        pairs = [(ranks[t[:i]] * size + ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        table = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.pair_keys, self.pair_ranks = np.append(table[:, 0], size * size), np.append(table[:, 1], size)
        self.size = size
        # ranks of pairs of single bytes
        self.of_bytes = self._ranks_of(np.repeat(self.of_byte, 256), np.tile(self.of_byte, 256)).reshape(256, 256)
        self.stays = Recent()
        self.leaves = Recent()
        self.pieces = Recent()

    def _ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair of tokens; ``size`` where a pair is no token."""
        keys = a * self.size + b
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], self.size)

    def merged_all(self, strings: list[bytes]) -> list[bytes]:
        """Ids of many short strings that are not empty: in each, again and again, the adjacent pair of lowest rank (the
        leftmost of equals) is merged, in all strings at once."""
        out: list[bytes] = [b""] * len(strings)
        data = np.frombuffer(b"".join(strings), np.uint8)
        tokens = self.of_byte[data]
        if (tokens < 0).any():
            raise KeyError("a byte that is no token")
        lengths = np.fromiter(map(len, strings), np.int64, len(strings))
        names = np.arange(len(strings))
        ranks = np.append(self.of_bytes[data[:-1], data[1:]], self.size)
        ranks[np.cumsum(lengths) - 1] = self.size  # no pair reaches into the next string
        while len(names):
            ends = np.cumsum(lengths)
            starts = ends - lengths
            # merge until a tenth of the strings are done, then go on without these
            done = np.zeros(len(names), bool)
            while not done.any() or done.sum() * 10 < len(done):
                least = np.minimum.reduceat(ranks, starts)
                done = least == self.size
                busy = np.flatnonzero(~done)
                if not len(busy):
                    break
                hits = np.flatnonzero(ranks == np.repeat(np.where(done, -1, least), lengths))
                at = hits[np.searchsorted(hits, starts[busy])]
                tokens[at] = least[busy]
                keep = np.ones(len(tokens), bool)
                keep[at + 1] = False
                tokens, ranks = tokens[keep], ranks[keep]
                lengths[busy] -= 1
                at -= np.arange(len(at))  # each merge before it took a token away
                ends = np.cumsum(lengths)
                starts = ends - lengths
                last, first = at + 1 == ends[busy], at == starts[busy]
                ranks[at] = np.where(last, self.size, self._ranks_of(tokens[at], tokens[np.minimum(at + 1, len(tokens) - 1)]))
                left = at[~first]
                ranks[left - 1] = self._ranks_of(tokens[left - 1], tokens[left])
            blob = tokens.astype("<u4").tobytes()
            for i in np.flatnonzero(done):
                out[names[i]] = blob[4 * starts[i] : 4 * ends[i]]
            going = np.repeat(~done, lengths)
            tokens, ranks = tokens[going], ranks[going]
            names, lengths = names[~done], lengths[~done]
        return out

    def merged(self, data: bytes) -> list[int]:
        """:meth:`merged_all` of one string, for the windows of joins."""
        parts = [data[i : i + 1] for i in range(len(data))]
        rank = self.ranks.get
        while True:
            at = min(range(len(parts) - 1), key=lambda i: rank(parts[i] + parts[i + 1], self.size), default=None)
            if at is None or parts[at] + parts[at + 1] not in self.ranks:
                return [self.ranks[p] for p in parts]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def leaf(self, data: bytes) -> list[int]:
        if (found := self.leaves.get(data)) is None:
            found = self.merged(data)
            if len(data) <= 4 * LEAF_BYTES:
                self.leaves.keep(data, found)
        return found

    def pair_stays(self, a: int, b: int) -> bool:
        """Whether two adjacent tokens are the encoding of their bytes."""
        if (found := self.stays.get((a, b))) is None:
            found = self.leaf(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
            self.stays.keep((a, b), found)
        return found

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two encoded neighbours' bytes."""
        if not left or not right or self.pair_stays(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            inside = self.leaf(b"".join([self.bytes_of[t] for t in left[-i:] + right[:j]]))
            left_stays = i == len(left) or self.pair_stays(left[-i - 1], inside[0])
            right_stays = j == len(right) or self.pair_stays(inside[-1], right[j])
            if left_stays and right_stays:
                return left[: len(left) - i] + inside + right[j:]
            if not left_stays:
                i = min(2 * i, len(left))
            if not right_stays:
                j = min(2 * j, len(right))

    def tree(self, data: bytes) -> list[int]:
        if len(data) <= LEAF_BYTES:
            return self.leaf(data)
        half = len(data) // 2
        return self.join(self.tree(data[:half]), self.tree(data[half:]))

    def encode_piece(self, data: bytes) -> list[int]:
        # a piece that is a token is that token, even if merges would not lead to it
        return [self.ranks[data]] if data in self.ranks else self.tree(data)

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of new pieces. The leaves of all their trees are encoded together."""
        out, short, trees, leaves = {}, [], [], set()
        for piece in pieces:
            data = piece.encode()
            if data in self.ranks:
                out[piece] = self.ranks[data].to_bytes(4, "little")
            elif len(data) <= LEAF_BYTES:
                short.append((piece, data))
            else:
                trees.append((piece, data))
                leaves.update(x for x in _halves(data) if self.leaves.get(x) is None)
        if short:
            out.update(zip((p for p, _ in short), self.merged_all([d for _, d in short]), strict=True))
        known = list(leaves)
        for start in range(0, len(known), CACHED):
            part = known[start : start + CACHED]
            for data, ids in zip(part, self.merged_all(part), strict=True):
                self.leaves.keep(data, np.frombuffer(ids, "<u4").tolist())
        for piece, data in trees:
            out[piece] = np.array(self.encode_piece(data), "<u4").tobytes()
        for piece, ids in out.items():
            if len(piece) <= 64:
                self.pieces.keep(piece, ids)
        return out

    def _encoded(self, lists: list[list[str]]) -> list[bytes]:
        """Ids of lists of pieces."""
        ids, new = {}, []
        for piece in set().union(*lists):
            if (found := self.pieces.get(piece)) is None:
                new.append(piece)
            else:
                ids[piece] = found
        ids.update(self._learn(new))
        return [b"".join(map(ids.__getitem__, pieces)) for pieces in lists]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of texts as little-endian unsigned 32-bit integers."""
        if sum(map(len, texts)) <= TEXT_CHARS:
            return self._encoded([self.regex.findall(t) for t in texts])
        out = []
        for text in texts:
            pieces = (m.group() for m in self.regex.finditer(text))
            parts = []
            while some := list(islice(pieces, TEXT_PIECES)):
                parts += self._encoded([some])
            out.append(b"".join(parts))
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: Sequence[int] | np.ndarray) -> bytes:
        """The bytes that ids stand for."""
        ids = np.asarray(ids, np.int64)
        if len(ids) > LEAF_TOKENS:
            half = len(ids) // 2
            return self.decode(ids[:half]) + self.decode(ids[half:])
        begins = self.begins[ids]
        lengths = self.begins[ids + 1] - begins
        if not lengths.all():
            raise KeyError("an id outside the vocabulary")
        ends = np.cumsum(lengths)
        # each byte's place among all tokens' bytes
        return self.all_bytes[np.arange(lengths.sum()) + np.repeat(begins - (ends - lengths), lengths)].tobytes()


def _halves(data: bytes) -> Iterator[bytes]:
    """The leaves of a string's tree."""
    if len(data) <= LEAF_BYTES:
        yield data
    else:
        half = len(data) // 2
        yield from _halves(data[:half])
        yield from _halves(data[half:])


def token_digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: a round trip of every whole text in one pass, so that a
    task needs one Python worker and only digests leave it."""
    texts = docs.select("doc_id", filled("text").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value, pattern)
        for batch in small_batches(batches, "text", 1 << 20):
            counts, digests = [], []
            for ids in codec.encode_all(batch.column("text").to_pylist()):
                decoded = codec.decode(np.frombuffer(ids, "<u4"))
                counts.append(len(ids) // 4)
                digests.append((hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()))
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), *(pa.array([d[i] for d in digests], pa.string()) for i in (0, 1))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    id_type = dict(texts.dtypes)["doc_id"]
    return texts.mapInArrow(run, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
