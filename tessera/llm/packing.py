"""Best-fit decreasing packing of tokenized documents.

A document longer than a window is cut into full windows and a rest. Rests are placed longest first, each into
the open window with the least room that still holds it; a segment tree indexed by remaining room finds that
window. Rests of one length are alike, so the tree works on counts: the driver gets one count for each length
(at most as many rows as a window has tokens, whatever the corpus), plans runs of equal rests, and each rest
finds its run by its rank among the rests of its length. Ranks are numbered in salted parts, so a length that a
third of all rests share is dealt over as many tasks as the table asks for. Full windows need no rank.

Defined results: a null text is empty and holds only the end id; a null doc_id stays null; ties among rests of one length are
settled by the place of their row in the table of pieces; repeated rows are packed each; a text of any length is cut whole; an
empty table gives an empty result; other columns of the input are ignored. Sequence ids are unique, not dense.
"""

from __future__ import annotations

import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import map_texts, materialize, read, worker_cache
from tessera.llm.ngrams import mix

WINDOW = 2048
END_ID = 1
#: The rests of one length are numbered in parts of about so many rows of the table, in so many parts at least.
PART_ROWS, LEAST_PARTS = 20_000, 64
#: Words remembered in each of two generations, and the greatest length of a piece that is remembered.
MEMO_SIZE, MEMO_LENGTH = 100_000, 64
#: Bytes of plain texts cut at once.
CUT_BYTES = 2 << 20
#: Characters on which the tokenizer's normalizer does no more than lower-casing: Latin-1 without its controls and spaces beyond ASCII.
PLAIN = r"[\t\n\v\f\r\x20-\x7e\xa1-\xff]*"
WHITE = re.compile(rb"[\t\n\v\f\r ]")
PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class WordIds:
    """Ids of whole texts as little-endian 32-bit bytes.

    No piece of the tokenizer's cut, and nothing that its normalizer does, crosses ASCII white space. Plain texts are cut in
    numpy, many at a time, and each distinct piece is looked up once by its hash; texts of other characters are cut at white
    space. What is new goes to the tokenizer; ids are remembered in two generations.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

        import numpy as np
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.ends_piece = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_piece[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.plain = re.compile(PLAIN).fullmatch
        characters = [bytes([k]).decode("latin-1") for k in range(256)]
        # 0: white space, 1: letter, 2: number, 3: anything else
        self.kinds = np.array([0 if c in "\t\n\v\f\r " else 1 if c.isalpha() else 2 if c.isnumeric() else 3 for c in characters], np.uint8)
        self.factors = np.random.default_rng(17).integers(1, 1 << 63, MEMO_LENGTH, np.uint64) * np.uint64(2) + np.uint64(1)
        self.memo: dict[int | bytes, bytes] = {}  # by hash: pieces of plain texts; by bytes: words of others
        self.before: dict[int | bytes, bytes] = {}

    def batch(self, texts: list[str]):
        import numpy as np

        return [np.array(x.ids, "<u4") for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def together(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces, which are encoded in lines: each piece ends with its only token of that kind."""
        import numpy as np

        out = []
        for k in range(0, len(pieces), 20_000):
            ids = np.concatenate(self.batch([" ".join(pieces[i : i + 500]) for i in range(k, min(k + 20_000, len(pieces)), 500)]))
            raw, ends = ids.tobytes(), (4 * (np.flatnonzero(self.ends_piece[ids]) + 1)).tolist()
            out += [raw[a:b] for a, b in zip([0, *ends], ends)]
        return out

    def recall(self, keys: list) -> list[bytes | None]:
        """What is remembered of each distinct key."""
        found = list(map(self.memo.get, keys))
        for at, ids in enumerate(found):
            if ids is None and (known := self.before.get(keys[at])) is not None:
                found[at] = self.memo[keys[at]] = known
        return found

    def cut_plain(self, data):
        """Where each piece of lower-case Latin-1 bytes starts, and its length; the last byte is white space.

        A piece is a run of letters, a number, or a run of others; an apostrophe alone takes s, t, m, d, re, ve or ll behind it.
        """
        import numpy as np

        kind = self.kinds[data]
        start = (kind == 2) | ((kind != 0) & (kind != np.r_[np.uint8(0), kind[:-1]]))
        at = np.flatnonzero((data[:-1] == 39) & start[:-1] & (kind[1:] == 1))
        one, two = data[at + 1], data[at + 2]
        long = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
        short = np.isin(one, (115, 116, 109, 100))
        start[at[long | short] + 1] = False
        after = np.r_[at[long] + 3, at[short] + 2]
        start[after[kind[after] == 1]] = True
        first = np.flatnonzero(start)
        return first, np.add.reduceat((kind != 0).astype(np.int64), first) if len(first) else first

    def encode_plain(self, group: list[bytes]) -> list[bytes]:
        import numpy as np

        data = np.frombuffer(b" ".join(group) + b" ", np.uint8)
        first, size = self.cut_plain(data)
        if not len(first):
            return [b""] * len(group)
        data = data[first[0] :]
        first = first - (ahead := int(first[0]))
        place = np.arange(len(data)) - np.repeat(first, np.diff(np.r_[first, len(data)]))
        value = (data.astype(np.uint64) + np.uint64(1)) * self.factors[np.minimum(place, MEMO_LENGTH - 1)]
        value[self.kinds[data] == 0] = 0
        key = mix(np.add.reduceat(value, first))
        key[size > MEMO_LENGTH] = np.arange(np.count_nonzero(size > MEMO_LENGTH), dtype=np.uint64)  # keys of their own, for this group only
        order = np.argsort(key)
        ordered = key[order]
        head = np.r_[True, ordered[1:] != ordered[:-1]]
        which = np.empty(len(key), np.int64)
        which[order] = np.cumsum(head) - 1
        keys, lead = ordered[head].tolist(), order[head]
        known = self.recall(keys)
        new = [i for i, ids in enumerate(known) if ids is None]
        raw = data.tobytes()
        made = self.together([raw[a : a + n].decode("latin-1") for a, n in zip(first[lead[new]].tolist(), size[lead[new]].tolist())])
        for i, ids, n in zip(new, made, size[lead[new]].tolist()):
            known[i] = ids
            if n <= MEMO_LENGTH:
                self.memo[keys[i]] = ids
        count = np.fromiter(map(len, known), np.int64, len(known)) // 4
        table, begin = np.frombuffer(b"".join(known), "<u4"), np.cumsum(count) - count
        n = count[which]
        end = np.cumsum(n)
        ids = table[np.repeat(begin[which] - (end - n), n) + np.arange(end[-1])]
        stops = np.cumsum([len(g) + 1 for g in group]) - ahead
        stops = (4 * np.r_[0, end][np.searchsorted(first, stops)]).tolist()
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *stops], stops)]

    def encode_other(self, text: str) -> bytes:
        """The ids of a text of any characters, by its words."""
        words = text.encode().split()
        distinct = list(set(words))
        known = self.recall(distinct)
        new = [w for w, ids in zip(distinct, known) if ids is None]
        found = dict(zip(distinct, known))
        for k in range(0, len(new), 20_000):
            part = new[k : k + 20_000]
            found.update(zip(part, [x.tobytes() for x in self.batch([w.decode() for w in part])]))
        self.memo.update({w: found[w] for w in new if len(w) <= MEMO_LENGTH})
        return b"".join(map(found.__getitem__, words))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.memo) > MEMO_SIZE:
            self.before, self.memo = self.memo, {}
        out, rows, group, size = [b""] * len(texts), [], [], 0

        def flush() -> None:
            nonlocal rows, group, size
            for row, ids in zip(rows, self.encode_plain(group) if group else []):
                out[row] += ids
            rows, group, size = [], [], 0

        for row, text in enumerate(texts):
            if not text:
                continue
            if not self.plain(text):
                out[row] = self.encode_other(text)
                continue
            raw = text.lower().encode("latin-1")
            start = 0
            while start < len(raw):
                end = len(raw)
                if end - start > CUT_BYTES and (space := WHITE.search(raw, start + CUT_BYTES)):
                    end = space.end()  # a long text is cut at white space
                if size + end - start > CUT_BYTES:
                    flush()
                rows.append(row)
                group.append(raw[start:end])
                size += end - start
                start = end
        flush()
        return out


def cut(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """The pieces of each document: full windows and a rest, with the checksum of their ids."""

    def factory():
        words = worker_cache(("word_ids", path), lambda: WordIds(path))
        end = end_id.to_bytes(4, "little")

        def apply(keys, texts):
            rows = []
            for key, ids in zip(keys, words.encode(texts)):
                ids += end
                n = len(ids) // 4
                for start in range(0, n, window):
                    length = min(window, n - start)
                    rows.append((key, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), n))
            return [pa.array([r[i] for r in rows], pa.int64()) for i in range(5)]

        return apply

    return map_texts(docs, PIECE_SCHEMA, factory)


class RoomTree:
    """Which rooms (0..size) have open windows: a segment tree of counts; find(n) gives the least room >= n."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: dict[int, list[list[int]]] = {}  # room -> runs [first window, windows]

    def add(self, room: int, first: int, n: int) -> None:
        self.open.setdefault(room, []).append([first, n])
        self._change(room, n)

    def take(self, room: int, n: int) -> tuple[int, int]:
        """Up to n windows of that room, as one run."""
        runs = self.open[room]
        first, have = runs[-1]
        got = min(have, n)
        if got == have:
            runs.pop()
        else:
            runs[-1] = [first + got, have - got]
        self._change(room, -got)
        return first, got

    def _change(self, room: int, n: int) -> None:
        i = room + self.leaves
        while i:
            self.count[i] += n
            i >>= 1

    def find(self, least: int) -> int:
        """The tightest room that holds least, or -1."""
        i = least + self.leaves
        if self.count[i]:
            return least
        while i > 1:
            if not i & 1 and self.count[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return -1


def plan(counts: dict[int, int], window: int = WINDOW) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best-fit decreasing over counts of lengths.

    Returns runs (length, first rank, first window, rests in each window, offset of the first), in order of
    length and rank, and the number of windows. The rests of a run fill its windows one after another; rank r of
    a run lies in window first + (r - first rank) // each, at offset + length * ((r - first rank) % each).
    """
    tree, runs, windows = RoomTree(window), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.find(length)
            if room < 0:
                room, each = window, window // length
                need = -(-left // each)
                first, got = windows, need
                windows += need
            else:
                each = room // length
                first, got = tree.take(room, -(-left // each))
            full = min(got, left // each)  # windows that take as many of these rests as they hold
            runs.append((length, rank, first, each, window - room))
            if full:
                tree.add(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if got > full:  # the last window takes what is left
                tree.add(room - left * length, first + full, 1)
                rank, left = rank + left, 0
    return runs, windows


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of each piece.

    Full windows need no rank: their sequence ids are those of the planned windows' end and their row's number.
    """
    import numpy as np

    spark = docs.sparkSession
    pieces = materialize(cut(docs, path or vocabulary(), window, end_id).withColumn("row", F.monotonically_increasing_id()))
    parts_of = max(LEAST_PARTS, pieces.count() // PART_ROWS)
    rests = pieces.where(F.col("length") < window).withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(parts_of)))
    # One row for each length and salt; the first rank of each part is a running sum over them.
    sizes = rests.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    firsts = materialize(sizes.select("length", "salt", "n", F.coalesce(before, F.lit(0)).alias("first")), compact=True)
    # At most `window` rows reach the driver.
    counts = {r["length"]: r["n"] for r in firsts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, windows = plan(counts, window)
    order = np.array(sorted(runs) or [(0, 0, 0, 1, 0)], np.int64)
    span = np.int64(1) << 44  # ranks of one length stay below
    starts = order[:, 0] * span + order[:, 1]

    local = F.row_number().over(Window.partitionBy("length", "salt").orderBy("row")) - 1
    numbered = rests.withColumn("local", local).join(firsts.select("length", "salt", "first").hint("merge"), ["length", "salt"])
    columns = [x.split()[0] for x in PIECE_SCHEMA.split(", ")]
    ranked = numbered.select(*columns, (F.col("first") + F.col("local")).alias("rank"))
    schema = f"{PIECE_SCHEMA}, sequence_id long, offset long"

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (2, 5))
            run = order[np.maximum(np.searchsorted(starts, length * span + rank, "right") - 1, 0)]
            inside = rank - run[:, 1]
            sequence, offset = run[:, 2] + inside // run[:, 3], run[:, 4] + length * (inside % run[:, 3])
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), pa.array(sequence), pa.array(offset)], names=[*columns, "sequence_id", "offset"])

    full = pieces.where(F.col("length") == window).select(*columns, (F.lit(windows) + F.col("row")).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return ranked.mapInArrow(place, schema).union(full)


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
