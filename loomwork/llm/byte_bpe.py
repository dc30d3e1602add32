"""Byte-level BPE encoding and decoding.

Method, two tiers: a minimal perfect hash over the vocabulary resolves whole pre-tokens that are in
it; all others are merged by a heap over linked bytes, lowest rank first, leftmost first.

The vocabulary is a fixed file of a few 10,000 entries, read once on the driver; what is sent to the
workers is the built hash (displacements, slots and the tokens' bytes), about 2 MB whatever the input.
Each worker keeps what it has encoded in a memo of bounded size.

Defined results: null and empty texts have no ids; text that isn't valid Unicode can't occur in a
string column.  Texts of any length are encoded whole.  Columns other than id and text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bound of each of the two generations of pre-tokens that a worker remembers; what is used again moves to the new one.
MEMO = 150_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a file with a base64 token and a rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


@lru_cache(maxsize=4)
def table_of(path: str) -> PerfectHash:
    """The perfect hash of a rank file, built once in a driver."""
    return PerfectHash.build(read_ranks(path))


@dataclass
class PerfectHash:
    """Minimal perfect hash by hash, displace and compress: as many slots as keys, one probe for each lookup.

    A key's 128-bit hash gives a bucket and two values f, g; the bucket's displacement d places it at
    (f + d // n + g * (d % n)) % n.  The stored key at that slot tells members from all other strings.
    """

    shift: np.ndarray
    keys: list[bytes]
    ranks: list[int]

    @classmethod
    def build(cls, ranks: dict[bytes, int], per_bucket: int = 4) -> PerfectHash:
        n = len(ranks)
        n_buckets = max(1, -(-n // per_bucket))
        buckets: list[list[tuple[int, int, bytes]]] = [[] for _ in range(n_buckets)]
        for key in ranks:
            bucket, f, g = cls._parts(key, n_buckets, n)
            buckets[bucket].append((f, g, key))
        shift, keys, values = np.zeros(n_buckets, np.int64), [b""] * n, [-1] * n
        taken, free = bytearray(n), 0
        for bucket in sorted(range(n_buckets), key=lambda b: -len(buckets[b])):
            members = buckets[bucket]
            if not members:
                break
            d = 0
            if len(members) == 1:  # any free slot will do: with d % n = 0 the slot is f + d // n
                free = taken.index(0, free)
                d = (free - members[0][0]) % n * n
            while True:
                slots = [(f + d // n + g * (d % n)) % n for f, g, _ in members]
                if len(set(slots)) == len(slots) and not any(taken[s] for s in slots):
                    break
                d += 1
                if d >= n * n:
                    raise ValueError("two tokens share all hash values")
            shift[bucket] = d
            for s, (_, _, key) in zip(slots, members):
                taken[s], keys[s], values[s] = 1, key, ranks[key]
        return cls(shift, keys, values)

    @staticmethod
    def _parts(key: bytes, n_buckets: int, n: int) -> tuple[int, int, int]:
        h = xxhash.xxh128_intdigest(key)
        return (h & 0xFFFFFFFF) % n_buckets, ((h >> 32) & 0xFFFFFFFF) % n, 1 + (h >> 64) % max(1, n - 1)

    def get(self, key: bytes) -> int:
        """The key's rank, or -1."""
        n = len(self.keys)
        if not n:
            return -1
        bucket, f, g = self._parts(key, len(self.shift), n)
        d = int(self.shift[bucket])
        slot = (f + d // n + g * (d % n)) % n
        return self.ranks[slot] if self.keys[slot] == key else -1


class Codec:
    """Encodes and decodes single texts in one process."""

    def __init__(self, table: PerfectHash, pattern: str):
        self.table = table
        self.pattern = regex.compile(pattern)
        self.token = dict(zip(map(str, table.ranks), table.keys))
        #: For merging: ranks of all tokens by their bytes, the second tier's own view of the vocabulary.
        self.rank = dict(zip(table.keys, table.ranks))
        codec = self

        class Memo(dict):
            old: dict = {}

            def __missing__(self, piece: str) -> str:
                ids = self.old.get(piece) or codec._piece(piece)
                if len(self) >= MEMO:
                    self.old = dict(self)
                    self.clear()
                self[piece] = ids
                return ids

        self.memo = Memo()

    def _piece(self, piece: str) -> str:
        data = piece.encode("utf-8")
        whole = self.table.get(data)
        return str(whole) if whole >= 0 else " ".join(map(str, self.merge(data)))

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token: bytes as a linked list, candidate pairs in a heap by (rank, position)."""
        rank, n = self.rank, len(data)
        end = list(range(1, n + 1))  # end[i]: where the part that starts at i ends; the next part starts there
        start = list(range(-1, n))  # start[i]: start of the part before the one that starts at i
        heap = []
        for i in range(n - 1):
            r = rank.get(data[i : i + 2])
            if r is not None:
                heap.append((r, i, i + 2))
        heapq.heapify(heap)
        alive = bytearray(b"\1") * n
        while heap:
            r, i, stop = heapq.heappop(heap)
            if not alive[i]:
                continue
            j = end[i]
            if j >= n or end[j] != stop:
                continue  # one of the two parts has grown since
            alive[j] = 0
            end[i] = stop
            if stop < n:
                start[stop] = i
                r = rank.get(data[i : end[stop]])
                if r is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            k = start[i]
            if k >= 0:
                r = rank.get(data[k:stop])
                if r is not None:
                    heapq.heappush(heap, (r, k, stop))
        out, i = [], 0
        while i < n:
            out.append(rank[data[i : end[i]]])
            i = end[i]
        return out

    def encode_text(self, text: str | None) -> str:
        """Decimal ids joined by one space."""
        return " ".join(map(self.memo.__getitem__, self.pattern.findall(text))) if text else ""

    def decode_text(self, ids: str) -> bytes:
        return b"".join(map(self.token.__getitem__, ids.split(" "))) if ids else b""


class ByteBpe:
    """The operator. path: rank file; pattern: how texts are split before merging."""

    def __init__(self, path: str, pattern: str):
        self.pattern = pattern
        self.table = table_of(path)

    def _mapped(self, docs: DataFrame, row, schema: str) -> DataFrame:
        table, pattern = self.table, self.pattern
        sent = docs.sparkSession.sparkContext.broadcast((table.shift, table.keys, table.ranks))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codec = Codec(PerfectHash(*sent.value), pattern)
            for batch in batches:
                for low in range(0, batch.num_rows, 512):
                    part = batch.slice(low, 512)
                    yield row(codec, *part.columns)

        return docs.mapInArrow(run, schema)

    def encode(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """id, ids array<int>."""

        def row(codec: Codec, key: pa.Array, texts: pa.Array) -> pa.RecordBatch:
            ids = [[int(x) for x in codec.encode_text(t.as_py()).split()] for t in texts]
            return pa.RecordBatch.from_arrays([key, pa.array(ids, pa.list_(pa.int32()))], names=[id_col, "ids"])

        docs = docs.select(F.col(id_col), F.col(text_col).cast("string"))
        return self._mapped(docs, row, f"`{id_col}` {docs.schema[0].dataType.simpleString()}, ids array<int>")

    def decode(self, encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
        """id, data binary: the bytes that the ids stand for; null ids give no bytes."""

        def row(codec: Codec, key: pa.Array, ids: pa.Array) -> pa.RecordBatch:
            data = [codec.decode_text(" ".join(map(str, x.as_py() or []))) for x in ids]
            return pa.RecordBatch.from_arrays([key, pa.array(data, pa.binary())], names=[id_col, "data"])

        encoded = encoded.select(F.col(id_col), F.col(ids_col))
        return self._mapped(encoded, row, f"`{id_col}` {encoded.schema[0].dataType.simpleString()}, data binary")

    def digests(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", also: tuple[str, ...] = ()) -> DataFrame:
        """doc_id, n_tokens, ids_sha256, decoded_sha256, n_chars and the columns of also: encodes, then decodes the ids, in one pass over the texts."""

        def row(codec: Codec, key: pa.Array, texts: pa.Array, *rest: pa.Array) -> pa.RecordBatch:
            n, ids_sha, data_sha, chars = [], [], [], []
            for t in texts:
                text = t.as_py() or ""
                ids = codec.encode_text(text)
                n.append(ids.count(" ") + 1 if ids else 0)
                ids_sha.append(hashlib.sha256(ids.encode("ascii")).hexdigest())
                data_sha.append(hashlib.sha256(codec.decode_text(ids)).hexdigest())
                chars.append(len(text))
            return pa.RecordBatch.from_arrays(
                [key, pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(data_sha), pa.array(chars, pa.int64()), *rest],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_chars", *also],
            )

        docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *also)
        carried = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in docs.schema[2:])
        return self._mapped(docs, row, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_chars bigint" + carried)
