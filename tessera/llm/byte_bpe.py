"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Pre-tokens are linked lists of byte strings; those that are new to a worker are merged together, in one queue. Every neighbouring pair that has a merge rank is put into the
bucket of that rank; a hierarchical bitmap over ranks gives the lowest waiting rank by find-first-set. A bucket
holds list positions; a position whose pair has changed since is stale and skipped. Work is proportional to the
merges done, so a pre-token of a million bytes takes no longer for each byte than a short one.

Defined results: a null text is empty, has no ids and decodes to nothing; special-token strings in a text are
ordinary text; repeated rows count each; a null doc_id stays null; texts of any length are encoded whole; an empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import map_texts, read, worker_cache

#: Pre-tokens up to so many characters are remembered, and so many of them in each worker.
MEMO_CHARS = 32
MEMO_SIZE = 500_000
#: Bytes of new pre-tokens merged together, and of text handled at once.
GROUP_BYTES = 1 << 19
BATCH = 1 << 20
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class RankQueue:
    """Waiting ranks in a bitmap of two levels, 256 ranks in a leaf word; a bucket of positions for each waiting rank."""

    def __init__(self):
        self.top, self.leaf = 0, [0] * 1024
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(position)
        else:
            self.fill(rank, [position])

    def first(self) -> int:
        """The lowest waiting rank, or -1."""
        top = self.top
        if not top:
            return -1
        word = (top & -top).bit_length() - 1
        bits = self.leaf[word]
        return (word << 8) + (bits & -bits).bit_length() - 1

    def fill(self, rank: int, positions: list[int]) -> None:
        """Put a whole bucket in; its rank is not waiting."""
        self.buckets[rank] = positions
        self.leaf[rank >> 8] |= 1 << (rank & 255)
        self.top |= 1 << (rank >> 8)

    def close(self, rank: int) -> list[int]:
        """Take the bucket of a rank out."""
        bucket = self.buckets.pop(rank)
        word = rank >> 8
        left = self.leaf[word] = self.leaf[word] ^ (1 << (rank & 255))
        if not left:
            self.top ^= 1 << word
        return bucket


class ByteBpe:
    """Encoder and decoder over a rank file; pattern cuts a text into pre-tokens."""

    def __init__(self, path: str, pattern: str):
        import numpy as np
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}
        self.tokens: list[bytes] = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        if len(self.tokens) > 1024 * 256:
            raise ValueError("more ranks than the bitmap holds")
        self.find = regex.compile(pattern).findall
        self.single = [bytes([b]) for b in range(256)]
        self.pairs = np.full(1 << 16, -1, np.int64)
        for token, rank in self.ranks.items():
            if len(token) == 2:
                self.pairs[256 * token[0] + token[1]] = rank
        self.names = list(map(str, range(len(self.tokens))))
        # Two generations: a piece that is met again moves to the young one, and the old one is dropped when that is full.
        self.young: dict[str, tuple[str, bytes]] = {}
        self.old: dict[str, tuple[str, bytes]] = {}

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each pre-token. All lie in one list, with no pair across two, so that they share the queue."""
        import numpy as np

        raw, ranks = b"".join(pieces), self.ranks
        n = len(raw)
        if not n:
            return [[] for _ in pieces]
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(sizes)
        starts = ends - sizes
        data = np.frombuffer(raw, np.uint8).astype(np.int64)
        rank_at = np.full(n, -1, np.int64)
        rank_at[:-1] = self.pairs[256 * data[:-1] + data[1:]]
        rank_at[ends[sizes > 0] - 1] = -1
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends[sizes > 0] - 1] = -1
        before[starts[sizes > 0]] = -1
        at, after, before = rank_at.tolist(), after.tolist(), before.tolist()  # a bucket's position under another rank is stale
        parts: list[bytes | None] = list(map(self.single.__getitem__, raw))

        queue, rank_of = RankQueue(), ranks.get
        order = np.argsort(rank_at, kind="stable")
        order = order[np.searchsorted(rank_at[order], 0) :]
        waiting, first = np.unique(rank_at[order], return_index=True)
        for rank, bucket in zip(waiting.tolist(), np.split(order, first[1:])):
            queue.fill(rank, bucket.tolist())
        push = queue.push
        while (rank := queue.first()) >= 0:
            bucket = queue.close(rank)
            bucket.sort()  # of equal pairs the leftmost goes first
            for k, i in enumerate(bucket):
                if at[i] != rank:
                    continue
                j = after[i]
                merged = parts[i] = parts[i] + parts[j]
                parts[j], at[j], lower = None, -1, False
                after[i] = j = after[j]
                at[i] = -1
                if j >= 0:
                    before[j] = i
                    new = rank_of(merged + parts[j])
                    if new is not None:
                        at[i] = new
                        push(new, i)
                        lower = new < rank
                h = before[i]
                if h >= 0:
                    new = rank_of(parts[h] + merged)
                    if new is None:
                        at[h] = -1
                    elif at[h] != new:
                        at[h] = new
                        push(new, h)
                        lower = lower or new < rank
                if lower:  # a lower rank has come up: the rest of this bucket waits
                    if k + 1 < len(bucket):
                        queue.fill(rank, bucket[k + 1 :])
                    break
        return [[ranks[p] for p in parts[s:e] if p is not None] for s, e in zip(starts.tolist(), ends.tolist())]

    def learn(self, pieces: list[str]) -> None:
        """The ids of new pieces as text, and the bytes they decode to."""
        ranks, names, group, size = self.ranks, self.names, [], 0
        for k, piece in enumerate(pieces):
            raw = piece.encode("utf-8")
            whole = ranks.get(raw)
            if whole is not None:
                self.young[piece] = (names[whole], self.decode([whole]))
            else:
                group.append((piece, raw))
                size += len(raw)
            if group and (size >= GROUP_BYTES or k + 1 == len(pieces)):
                for (name, _), ids in zip(group, self.merge([raw for _, raw in group])):
                    self.young[name] = (" ".join([names[i] for i in ids]), self.decode(ids))
                group, size = [], 0

    def coded(self, texts: list[str | None]) -> list[list[tuple[str, bytes]]]:
        """What learn() has for each pre-token of each text."""
        if len(self.young) >= MEMO_SIZE:
            self.old, self.young = self.young, {}
        found = [self.find(t) if t else [] for t in texts]
        young, old = self.young, self.old
        fresh = [p for p in set().union(*found) if p not in young]
        young.update((p, old[p]) for p in fresh if p in old)
        self.learn([p for p in fresh if p not in old])
        out = [list(map(young.__getitem__, pieces)) for pieces in found]
        for p in fresh:
            if len(p) > MEMO_CHARS:
                del young[p]
        return out

    def encode(self, text: str) -> list[int]:
        return [int(i) for made in self.coded([text])[0] for i in made[0].split(" ")]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def byte_bpe(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, number of ids, hash of the ids and hash of the decoded bytes of each text."""
    path, pattern = path or vocabulary()[0], pattern or vocabulary()[1]

    def factory():
        bpe = worker_cache(("byte_bpe", path, pattern), lambda: ByteBpe(path, pattern))

        def apply(keys, texts):
            counts, digests, decoded = [], [], []
            for made in bpe.coded(texts):
                ids = " ".join([m[0] for m in made])
                counts.append(ids.count(" ") + 1 if made else 0)
                digests.append(hashlib.sha256(ids.encode()).hexdigest())
                decoded.append(hashlib.sha256(b"".join([m[1] for m in made])).hexdigest())
            return [pa.array(keys, pa.int64()), pa.array(counts, pa.int64()), pa.array(digests), pa.array(decoded)]

        return apply

    return map_texts(docs, SCHEMA, factory, limit=BATCH)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe(read(spark, sf_dir, "documents"))
