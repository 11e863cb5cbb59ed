import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

from tessera.llm.packing import END_ID, RoomTree, pack, plan, vocabulary


def ids_of(text):
    tokenizer = Tokenizer.from_file(vocabulary())
    tokenizer.encode_special_tokens = True
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, END_ID]


def check(frame, window):
    rows = pack(frame, window=window).collect()
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    tokens = 0
    for d in frame.select("doc_id", "text").collect():
        ids, at = np.array(ids_of(d.text), "<u4"), 0
        for r in sorted(pieces[d.doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
        tokens += at
    windows = defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append((r.offset, r.length))
    for pieces_in in windows.values():
        at = 0
        for offset, length in sorted(pieces_in):
            assert offset == at
            at += length
        assert at <= window
    return len(windows), tokens


def best_fit(lengths, window):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [(room, i) for i, room in enumerate(rooms) if room >= n]
        if fits:
            rooms[min(fits)[1]] -= n
        else:
            rooms.append(window - n)
    return Counter(rooms)


def test_plan_equals_best_fit_decreasing_piece_by_piece():
    chance = random.Random(5)
    for _ in range(200):
        window = chance.choice([8, 16, 50])
        lengths = [chance.randint(1, window - 1) for _ in range(chance.randint(0, 60))]
        runs, windows = plan(Counter(lengths), window)
        filled = Counter()
        for length, first_rank, first, each, offset in runs:
            later = [r[1] for r in runs if r[0] == length and r[1] > first_rank]
            n = (min(later) if later else Counter(lengths)[length]) - first_rank
            for k in range(n):
                assert offset + length * (k % each) + length <= window
                filled[first + k // each] += length
        assert Counter(window - n for n in filled.values()) == best_fit(lengths, window)
        assert len(filled) == windows


def test_tree_finds_the_tightest_room():
    tree = RoomTree(20)
    for room in (3, 9, 20):
        tree.add(room, 0, 1)
    assert [tree.find(n) for n in (1, 3, 4, 9, 10, 20)] == [3, 3, 9, 9, 20, 20]
    tree.take(20, 1)
    assert tree.find(10) == -1


def test_awkward_and_sample_texts(docs, sample):
    check(docs, 64)
    windows, tokens = check(sample, 2048)
    assert windows <= -(-tokens // 2048) + 2


def test_empty_table(no_docs):
    assert pack(no_docs).collect() == []
