"""Removal of 50-byte strings that start in an earlier document, by a column-wise suffix array over many strings.

The column-wise construction inserts one symbol of every string in each round, so its rounds are as many as the
longest string has bytes: over whole documents (some of 100 kB and more) that would be as many passes over the whole
collection. So the collection is cut first into short strings, without loss:

- In each 50-byte window the 24-byte gram of least hash is its anchor. Equal windows have equal anchors at equal
  places, so windows can only be equal within a group of equal anchors.
- The windows of one anchor lie side by side; their text, the context, has 50 to 76 bytes. An exchange of packed
  hashes tells which anchors occur in one document only (nothing to remove), which have equal contexts everywhere
  (the least document owns them), and which have unlike contexts.
- Unlike contexts of a hash bucket are the strings of a column-wise construction: at most 76 rounds, each inserting one
  symbol of each context into the Burrows-Wheeler transform and the common-prefix array, which are written to and read
  from sequential files of the task's temporary folder when they are large. Suffixes with a common prefix of 50
  bytes and more are equal windows, and the least document of such a run owns the window.
- An anchor with very many unlike contexts (a passage found in a third of all documents, say) would make one bucket
  large. Its windows are exchanged one by one by hashes of 128 bits instead, each once for each chunk.

Defined results: null and empty texts have 0 bytes, nothing removed and the hash of the empty string; matches never
cross documents; a null doc_id is less than any other; rows that repeat a doc_id do not remove from one another (their ids are equal, not smaller) and get
one result row each; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import free_names, materialize, read
from tessera.llm.exchange import TIMES, answers, chunk_table, each_chunk, exchange_buckets, id_array, joined, received, send, pack_arrays, unpack_arrays, unpack_docs
from tessera.llm.ngrams import mix

LENGTH = 50
GRAM = 24
SPAN = LENGTH - GRAM + 1
#: Bytes of a document handled at once; a position must fit the low bits of an anchor's key.
PIECE = 1 << 19
_LOW = np.uint64((1 << 20) - 1)
#: Unlike contexts of one anchor beyond which its windows are exchanged one by one.
MANY = 1000
#: Bytes of transform and prefixes kept in memory; more go to files.
IN_MEMORY = 64 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def words_at(data: np.ndarray) -> np.ndarray:
    """The 64-bit word of 8 bytes at each place."""
    w = data.astype(np.uint64)
    for shift in (1, 2, 4):
        w = w[:-shift] | (w[shift:] << np.uint64(8 * shift))
    return w


def least_in(key: np.ndarray, span: int) -> np.ndarray:
    """Minimum over each window of span places."""
    width, out = 1, key
    while 2 * width <= span:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    rest = span - width
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


class Powers:
    """Powers of the base and of its inverse, for prefix sums of a piece."""

    def __init__(self):
        self.up = np.ones(PIECE + 8, np.uint64)
        self.down = np.ones(PIECE + 8, np.uint64)
        np.cumprod(np.full(PIECE + 7, _BASE), out=self.up[1:])
        np.cumprod(np.full(PIECE + 7, _INVERSE), out=self.down[1:])


def powers() -> Powers:
    import sys
    import types

    store = sys.modules.setdefault("_tessera_worker_cache", types.ModuleType("_tessera_worker_cache")).__dict__
    if "powers" not in store:
        store["powers"] = Powers()
    return store["powers"]


def piece_hashes(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which span_hash() hashes any span of 8 bytes and more."""
    value = mix(words_at(data)) * powers().up[: len(data) - 7]
    return np.r_[np.uint64(0), np.cumsum(value)]


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end], by content alone."""
    return mix((sums[end - 7] - sums[start]) * powers().down[start] + (end - start).astype(np.uint64))


def anchors(texts: list[bytes]):
    """Anchor hash, context hash, text, first window and last window (places in the text) of each anchor.

    A window's anchor is its gram of least hash, the leftmost of equals. Texts are handled end to end, some at a time;
    a longer one in overlapping pieces.
    """
    out = []

    def run(data: np.ndarray, rows: np.ndarray, bases: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> None:
        """Windows starts[i] ... starts[i] + counts[i] - 1 of the data are those of text rows[i] from bases[i] on."""
        w = words_at(data)
        gram = mix(w[: len(w) - 16] * np.uint64(3) ^ mix(w[8 : len(w) - 8] + mix(w[16:])))
        key = (gram & ~_LOW) | np.arange(len(gram), dtype=np.uint64)
        place = (least_in(key, SPAN) & _LOW).astype(np.int64)  # for each window
        edge = np.zeros(len(place) + 1, np.int8)
        edge[starts] += 1
        np.subtract.at(edge, starts + counts, 1)
        window = np.flatnonzero(np.cumsum(edge[:-1], dtype=np.int8))
        at = place[window]
        head = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1)])
        first, last = window[head], window[np.r_[head[1:] - 1, len(window) - 1]]
        sums = piece_hashes(data)
        context = mix(span_hash(sums, first, last + LENGTH) + (at[head] - first).astype(np.uint64))
        which = np.searchsorted(starts, first, "right") - 1
        shift = bases[which] - starts[which]
        # Least hashes are small ones: mixed again, anchors lie evenly in ranges.
        out.append((mix(gram[at[head]] ^ np.uint64(0x5DEECE66D)), context, rows[which], first + shift, last + shift))

    group: list[int] = []
    size = 0

    def flush() -> None:
        if group:
            sizes = np.fromiter((len(texts[i]) for i in group), np.int64, len(group))
            data = np.frombuffer(b"".join(texts[i] for i in group), np.uint8)
            run(data, np.array(group), np.zeros(len(group), np.int64), np.cumsum(sizes) - sizes, sizes - LENGTH + 1)

    for i, text in enumerate(texts):
        if len(text) < LENGTH:
            continue
        if len(text) >= PIECE:
            for at in range(0, len(text) - LENGTH + 1, PIECE - LENGTH):
                data = np.frombuffer(text[at : at + PIECE - 1], np.uint8)
                # Each window belongs to one piece: the next one begins where this one's windows end.
                count = min(len(data) - LENGTH + 1, PIECE - LENGTH)
                run(data, np.array([i]), np.array([at]), np.array([0]), np.array([count]))
            continue
        if size + len(text) >= PIECE:
            flush()
            group, size = [], 0
        group.append(i)
        size += len(text)
    flush()
    if not out:
        none = np.empty(0, np.uint64)
        return none, none, none.astype(np.int64), none.astype(np.int64), none.astype(np.int64)
    return tuple(np.concatenate(c) for c in zip(*out))


class Entries:
    """The anchors of a chunk: entries are the distinct (anchor, context) pairs in order of bucket, each with its least document."""

    def __init__(self, ids: np.ndarray, texts: list[bytes], n_buckets: int):
        gram, context, self.row, self.first, self.last = anchors(texts)
        doc = ids[self.row]
        order = np.lexsort((doc, context, gram))  # buckets are ranges of anchor hashes
        g, c = gram[order], context[order]
        head = np.r_[True, (g[1:] != g[:-1]) | (c[1:] != c[:-1])][: len(g)]
        self.entry = np.empty(len(g), np.int64)  # of each member
        self.entry[order] = np.cumsum(head) - 1
        lead = order[head]  # the least document's member of each entry
        self.lead, self.gram, self.context, self.doc = lead, gram[lead], context[lead], doc[lead]
        self.bucket = range_bucket(self.gram, n_buckets)
        self.later = doc > self.doc[self.entry] if len(doc) else np.empty(0, bool)  # members behind their entry's least document


def range_bucket(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Equal ranges of the upper 32 bits."""
    return (((keys >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)).astype(np.int64)


def five(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (x & np.uint64(0xFFFFFFFF)).astype(np.uint32), ((x >> np.uint64(32)) & np.uint64(0xFF)).astype(np.uint8)


def forty(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32))


ALONE, OWNED, UNLIKE, HOT = 0, 1, 2, 3


def judge(packed: list[bytes]) -> list[bytes]:
    """For each entry: ALONE, OWNED by a smaller document, or in a group of UNLIKE contexts (HOT: very many)."""
    parts = [unpack_arrays(p) for p in packed]
    gram = np.concatenate([forty(p[0], p[1]) for p in parts])
    context = np.concatenate([forty(p[2], p[3]) for p in parts])
    doc = np.concatenate([p[4] for p in parts])
    order = np.lexsort((doc, context, gram))
    g, c, d = gram[order], context[order], doc[order]
    new_gram = np.r_[True, g[1:] != g[:-1]]
    new_pair = new_gram | np.r_[True, c[1:] != c[:-1]]
    group, pair = np.cumsum(new_gram) - 1, np.cumsum(new_pair) - 1
    starts = np.flatnonzero(new_gram)
    several = np.minimum.reduceat(d, starts) != np.maximum.reduceat(d, starts)
    contexts = np.bincount(group[new_pair], minlength=len(starts))
    owner = d[new_pair]  # the least document of each pair
    code = np.where(owner[pair] < d, OWNED, ALONE).astype(np.uint8)
    unlike = (contexts > 1) & several
    code[unlike[group]] = UNLIKE
    code[(unlike & (contexts > MANY))[group]] = HOT
    out = np.empty(len(code), np.uint8)
    out[order] = code
    ends = np.cumsum([len(p[0]) for p in parts])
    return [pack_arrays(x) for x in np.split(out, ends[:-1])]


class Columns:
    """The suffixes so far in order: symbol before, common prefix with the one before, string and place.

    Kept in arrays while small; beyond IN_MEMORY bytes each round's columns are written to files one after another
    and read back for the next round.
    """

    def __init__(self, **columns: np.ndarray):
        self.folder = None
        self.put(**columns)

    def put(self, **columns: np.ndarray) -> None:
        if sum(c.nbytes for c in columns.values()) <= IN_MEMORY:
            self.held = columns
            return
        if self.folder is None:
            self.folder = tempfile.TemporaryDirectory()
        self.held = {}
        for name, column in columns.items():
            path = os.path.join(self.folder.name, name)
            column.tofile(path + ".new")
            os.replace(path + ".new", path)
            self.held[name] = np.memmap(path, column.dtype, "r")

    def close(self) -> None:
        self.held = {}
        if self.folder is not None:
            self.folder.cleanup()


def column_wise(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String, place and common prefix with the suffix before, of all suffixes of the strings in order.

    Round t puts in the suffixes of length t, one for each string that is long enough. A new suffix is a symbol a
    before a suffix whose rank is known; its rank is the number of suffixes that begin with a smaller symbol, and of
    symbols a before that rank in the transform. Ends of strings are smaller than all symbols and unlike one another.
    """
    m = len(strings)
    sizes = np.fromiter(map(len, strings), np.int64, m)
    width = int(sizes.max(initial=0))
    text = np.zeros((m, width + 1), np.uint8)  # right-aligned symbols: column width - t is the t-th from the end; 0: nothing before
    used = np.zeros(256, bool)
    for s in strings:
        used[np.frombuffer(s, np.uint8)] = True
    if used.sum() > 255:  # no UTF-8 text has so many
        text = text.astype(np.uint16)
    dense = np.cumsum(used).astype(text.dtype)  # symbols from 1 on, in order
    for i, s in enumerate(strings):
        text[i, width + 1 - len(s) : width + 1] = dense[np.frombuffer(s, np.uint8)]

    step = width + 1  # a suffix is string * step + place
    every = np.arange(m, dtype=np.int64)
    columns = Columns(symbol=text[:, width].copy(), prefix=np.zeros(m, np.uint8), suffix=every * step + sizes)
    newest, rank_of = every, every  # strings whose latest suffix is the newest, and its rank
    for t in range(1, width + 1):
        symbol, prefix, suffix = (columns.held[k] for k in ("symbol", "prefix", "suffix"))
        going = sizes[newest] >= t
        newest, at = newest[going], rank_of[going]
        by_symbol = np.argsort(symbol, kind="stable")
        by_symbol = by_symbol[np.searchsorted(symbol[by_symbol], 1) :]  # entries with a symbol before them, by it
        rank = np.empty(len(symbol), np.int64)
        rank[by_symbol] = np.arange(m, m + len(by_symbol))
        target = rank[at]  # ranks of the new suffixes once all are in
        order = np.argsort(target, kind="stable")
        newest, target = newest[order], target[order]
        total = len(symbol) + len(newest)

        # Common prefixes change at the new suffixes and at those right behind them.
        touched = np.unique(np.r_[target, target + 1])
        touched = touched[(touched > m) & (touched < total)]
        x, y = by_symbol[touched - m], by_symbol[touched - m - 1]
        alike = symbol[x] == symbol[y]
        value = np.zeros(len(touched), np.int64)
        if alike.any():
            x, y = x[alike], y[alike]  # y < x; the least prefix in (y, x]
            by_place = np.argsort(x, kind="stable")
            ends = np.stack([y[by_place] + 1, x[by_place] + 1], 1).ravel()
            least = np.minimum.reduceat(np.r_[prefix, np.uint8(0)], ends)[::2]
            back = np.empty(len(x), np.int64)
            back[by_place] = least
            value[alike] = back + 1

        old = np.ones(total, bool)
        old[target] = False
        source = np.cumsum(old) - 1  # where each place's entry comes from: an old one, or a new one behind them
        source[target] = np.arange(len(symbol), total)
        made_prefix = np.r_[prefix, np.zeros(len(newest), np.uint8)][source]
        made_prefix[touched] = np.minimum(value, 255)
        columns.put(symbol=np.r_[symbol, text[newest, width - t]][source], prefix=made_prefix, suffix=np.r_[suffix, newest * step + sizes[newest] - t][source])
        rank_of = target
    suffix, prefix = (np.array(columns.held[k]) for k in ("suffix", "prefix"))
    columns.close()
    return suffix // step, suffix % step, prefix


def shared_hulls(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each string whose hash is found in another window too; -1 where there is none."""
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    starts = np.cumsum(sizes) - sizes
    w = words_at(np.frombuffer(b"".join(strings), np.uint8))
    n, key = len(w) - LENGTH + 8, None
    for at in (*range(0, LENGTH - 8, 8), LENGTH - 8):
        part = w[at : at + n]
        key = mix(part) if key is None else mix(key ^ mix(part + np.uint64(at)))
    edge = np.zeros(n + 1, np.int8)
    edge[starts] += 1
    np.subtract.at(edge, starts + sizes - LENGTH + 1, 1)
    window = np.flatnonzero(np.cumsum(edge[:-1], dtype=np.int8))
    order = np.argsort(key[window])
    ordered = key[window][order]
    twice = np.r_[False, ordered[1:] == ordered[:-1]]
    twice[:-1] |= twice[1:]
    window = np.sort(window[order[twice]])
    owner = np.searchsorted(starts, window, "right") - 1
    first, last = np.full(len(strings), -1), np.full(len(strings), -1)
    last[owner] = window - starts[owner]  # the last assignment stays
    first[owner[::-1]] = (window - starts[owner])[::-1]
    return first, last


def owned_windows(packed: list[bytes]) -> list[bytes]:
    """For each entry of unlike contexts a mask: bit k is set if its k-th window starts in a smaller document.

    Contexts are cut to the windows that another one may hold by their hashes, and equal ones are taken together;
    the suffixes of what is left are ordered column by column, and their common prefixes decide.
    """
    parts = [unpack_arrays(p) for p in packed]
    strings: dict[bytes, int] = {}
    number, docs = [], []
    for doc, sizes, raw in parts:
        raw, ends = raw.tobytes(), np.cumsum(sizes)
        for size, end in zip(sizes.tolist(), ends.tolist()):
            number.append(strings.setdefault(raw[end - size : end], len(strings)))
        docs.append(doc)
    number, docs, names = np.array(number, np.int64), np.concatenate(docs), list(strings)
    least = np.full(len(names), np.iinfo(np.int64).max)
    np.minimum.at(least, number, docs)
    table = np.repeat(least[:, None], SPAN, 1)  # the least document of each window of each string

    first, last = shared_hulls(names)
    some = np.flatnonzero(first >= 0)
    hulls: dict[bytes, int] = {}
    hull = np.array([hulls.setdefault(names[i][a : b + LENGTH], len(hulls)) for i, a, b in zip(some.tolist(), first[some].tolist(), last[some].tolist())], np.int64)
    if len(hulls):
        hull_least = np.full(len(hulls), np.iinfo(np.int64).max)
        np.minimum.at(hull_least, hull, least[some])
        string, place, prefix = column_wise(list(hulls))
        run = np.cumsum(prefix < LENGTH) - 1
        owner = np.minimum.reduceat(hull_least[string], np.flatnonzero(np.r_[True, run[1:] != run[:-1]]))[run]
        sizes = np.fromiter(map(len, hulls), np.int64, len(hulls))
        window = place <= sizes[string] - LENGTH
        owned = np.full((len(hulls), SPAN), np.iinfo(np.int64).max)
        owned[string[window], place[window]] = owner[window]
        column = np.arange(SPAN)[None, :]
        inside = column <= (last - first)[some][:, None]
        rows, columns = np.broadcast_to(some[:, None], inside.shape)[inside], (first[some][:, None] + column)[inside]
        table[rows, columns] = np.minimum(table[rows, columns], owned[hull][inside])
    masks = ((table[number] < docs[:, None]) @ (1 << np.arange(SPAN, dtype=np.int64))).astype(np.uint32)
    # Bits beyond a context's windows say nothing.
    windows = np.fromiter(map(len, names), np.int64, len(names))[number] - LENGTH + 1
    masks &= ((np.uint64(1) << windows.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)
    ends = np.cumsum([len(p[0]) for p in parts])
    return [pack_arrays(x) for x in np.split(masks, ends[:-1])]


def smaller_owner(packed: list[bytes]) -> list[bytes]:
    """For each (window hash of 128 bits, document): whether a smaller document has that hash."""
    parts = [unpack_arrays(p) for p in packed]
    keys, docs, more = (np.concatenate([p[k] for p in parts]) for k in range(3))
    order = np.lexsort((more, keys))
    at = np.empty(len(keys), np.int64)
    at[order] = np.cumsum(np.r_[True, (keys[order][1:] != keys[order][:-1]) | (more[order][1:] != more[order][:-1])]) - 1
    least = np.full(at.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, at, docs)
    ends = np.cumsum([len(p[0]) for p in parts])
    return [pack_arrays((x).astype(np.uint8)) for x in np.split(least[at] < docs, ends[:-1])]


def hot_windows(entries: Entries, code: np.ndarray, texts: list[bytes], n_buckets: int):
    """The distinct windows of hot entries, in order of bucket: hash, least document; and (entry, k) with their index."""
    hot = np.flatnonzero(code == HOT)
    if not len(hot):
        return None
    lead = entries.lead[hot]
    count = entries.last[lead] - entries.first[lead] + 1
    owner = np.repeat(hot, count)
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    keys, more = np.empty(len(owner), np.uint64), np.empty(len(owner), np.uint64)
    start = np.repeat(entries.first[lead], count) + step
    row = np.repeat(entries.row[lead], count)
    for r in np.unique(row):
        some = np.flatnonzero(row == r)
        digests = np.frombuffer(b"".join(hashlib.blake2b(texts[r][s : s + LENGTH], digest_size=16).digest() for s in start[some].tolist()), np.uint64)
        keys[some], more[some] = digests[::2], digests[1::2]
    doc = entries.doc[owner]
    order = np.lexsort((doc, more, keys))
    head = np.r_[True, (keys[order][1:] != keys[order][:-1]) | (more[order][1:] != more[order][:-1])]
    index = np.empty(len(keys), np.int64)
    index[order] = np.cumsum(head) - 1
    lead_of = order[head]
    return owner, step, index, keys[lead_of], doc[lead_of], range_bucket(keys[lead_of], n_buckets), doc, more[lead_of]


def removed_ranges(entries: Entries, n_texts: int, code, masks, hot, hot_answer) -> list[list[tuple[int, int]]]:
    """Byte ranges to remove of each text of the chunk, in order."""
    entry_mask = np.zeros(len(code), np.int64)
    entry_mask[code == OWNED] = -1
    if masks is not None:
        entry_mask[code == UNLIKE] = masks
    if hot is not None:
        owner, step, index, _, least, _, doc, _ = hot
        gone = (hot_answer[index] > 0) | (doc > least[index])
        np.bitwise_or.at(entry_mask, owner[gone], np.left_shift(1, step[gone]))
    mask = np.where(entries.later, -1, entry_mask[entries.entry]) if len(entries.entry) else np.empty(0, np.int64)
    ranges: list[list[tuple[int, int]]] = [[] for _ in range(n_texts)]
    for i in np.flatnonzero(mask):
        row, first, last = entries.row[i], int(entries.first[i]), int(entries.last[i])
        spans = ranges[row]
        if mask[i] == -1:
            found = [(first, last + LENGTH)]
        else:
            found = [(first + k, first + k + LENGTH) for k in range(last - first + 1) if mask[i] >> k & 1]
        for a, b in found:
            if spans and a <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
            else:
                spans.append((a, b))
    return ranges


def removals(docs: DataFrame, schema: str, output, carry: str = "") -> DataFrame:
    """output(ids, texts, ranges) -> record batch, over all chunks with the byte ranges to remove.

    With carry, output's fourth argument is the JSON of each row's other columns.
    """
    whole = chunk_table(docs, carry=carry)
    n_buckets = exchange_buckets(whole)
    chunks = whole.select("part", "chunk", "docs")

    def emit_anchors(chunk, ids, texts):
        e = Entries(ids, texts, n_buckets)
        yield from send(chunk, e.bucket, *five(e.gram), *five(e.context), e.doc)

    codes = materialize(answers(each_chunk(chunks, emit_anchors, "bucket int, chunk long, packed binary"), judge), codec="none", compact=True)

    def emit_contexts(chunk, ids, texts, found):
        if not found:
            return
        e, code = Entries(ids, texts, n_buckets), received(found)[0]
        some = np.flatnonzero(code == UNLIKE)
        if len(some):
            lead = e.lead[some]
            raw = [texts[r][a : b + LENGTH] for r, a, b in zip(e.row[lead].tolist(), e.first[lead].tolist(), e.last[lead].tolist())]
            bucket = e.bucket[some]
            starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            stops = np.r_[starts[1:], len(some)]
            packed = [pack_arrays(e.doc[some[s:t]], np.fromiter(map(len, raw[s:t]), np.int64, t - s), np.frombuffer(b"".join(raw[s:t]), np.uint8)) for s, t in zip(starts.tolist(), stops.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[starts].astype(np.int32)), pa.array(np.full(len(starts), chunk, np.int64)), pa.array(packed, pa.binary())], ["bucket", "chunk", "packed"])
        hot = hot_windows(e, code, texts, n_buckets)
        if hot is not None:  # these buckets are numbered behind the others
            for batch in send(chunk, hot[5], hot[3], hot[4], hot[7], np.zeros(len(hot[3]), np.uint8)):
                yield batch.set_column(0, "bucket", pa.compute.add(batch.column(0), pa.scalar(n_buckets, pa.int32())))

    def decide(packed: list[bytes]) -> list[bytes]:
        return owned_windows(packed) if len(unpack_arrays(packed[0])) == 3 else smaller_owner(packed)

    sent = each_chunk(joined(chunks, codes), emit_contexts, "bucket int, chunk long, packed binary")
    masks = answers(sent, decide)

    def finish(chunk, ids, texts, found, decided, rest=None):
        e = Entries(ids, texts, n_buckets)
        code = received(found)[0] if found else np.zeros(len(e.gram), np.uint8)
        mask = received([x for x in decided or [] if x["bucket"] < n_buckets])
        answer = received([x for x in decided or [] if x["bucket"] >= n_buckets])
        hot = hot_windows(e, code, texts, n_buckets)
        ranges = removed_ranges(e, len(texts), code, mask[0] if mask else None, hot, answer[0] if answer else None)
        yield output(ids, texts, ranges, *([unpack_docs(rest)[1]] if carry else []))

    return each_chunk(joined(whole, codes, masks), finish, schema)


def kept_bytes(text: bytes, ranges: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for a, b in ranges:
        parts.append(text[at:a])
        at = b
    return b"".join([*parts, text[at:]])


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each document."""

    def output(ids, texts, ranges):
        longs = [list(map(len, texts)), [sum(b - a for a, b in r) for r in ranges], list(map(len, ranges))]
        kept = [hashlib.sha256(kept_bytes(t, r)).hexdigest() for t, r in zip(texts, ranges)]
        return pa.RecordBatch.from_arrays([id_array(ids), *(pa.array(x, pa.int64()) for x in longs), pa.array(kept)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return removals(docs, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", output)


def removed_spans(docs: DataFrame) -> DataFrame:
    """doc_id and the byte ranges removed (array of start and end), of documents that lose something."""

    def output(ids, texts, ranges):
        some = [i for i, r in enumerate(ranges) if r]
        spans = [[{"start": a, "end": b} for a, b in ranges[i]] for i in some]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays([id_array(ids[some]), pa.array(spans, kind)], ["doc_id", "spans"])

    return removals(docs, "doc_id long, spans array<struct<start:long,end:long>>", output)


def whole_characters(text: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The ranges without the characters that they cut at either end."""
    out = []
    for a, b in ranges:
        while a < b and a < len(text) and text[a] & 0xC0 == 0x80:
            a += 1
        while a < b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def strip_repeats(docs: DataFrame) -> DataFrame:
    """docs with the repeated bytes cut out of text, whole characters only; n_chars, where there is one, is counted anew."""
    small = [f for f in docs.schema.fields if f.name != "text"]
    (null,) = free_names(docs.columns, "null")
    kind = T.StructType([T.StructField(f.name, f.dataType) for f in small] + [T.StructField(null, T.BooleanType())])

    def output(ids, texts, ranges, rest):
        kept = [kept_bytes(t, whole_characters(t, r)).decode("utf-8", "replace") for t, r in zip(texts, ranges)]
        return pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), pa.array([r.decode() for r in rest], pa.string())], ["left", "rest"])

    rows = removals(docs, "left string, rest string", output, carry=null)
    rows = rows.withColumn("rest", F.from_json("rest", kind, TIMES)).withColumn("left", F.when(~F.col("rest")[null], F.col("left")))
    made = {f.name: F.col("rest")[f.name] for f in small} | {"text": F.col("left")}
    if "n_chars" in made:
        made["n_chars"] = F.length("left").cast(docs.schema["n_chars"].dataType)
    return rows.select(*(made[c].alias(c) for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(read(spark, sf_dir, "documents"))
