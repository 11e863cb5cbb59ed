import base64
import hashlib

import tiktoken

from tessera.llm.byte_bpe import ByteBpe, RankQueue, byte_bpe, vocabulary


def library():
    path, pattern = vocabulary()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def expected(rows):
    encoding, out = library(), {}
    for doc_id, text in rows:
        ids = encoding.encode_ordinary(text or "")
        out[doc_id] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    return out


def test_awkward_and_sample_texts_equal_the_library(docs, sample):
    for frame in (docs, sample):
        want = expected((r.doc_id, r.text) for r in frame.select("doc_id", "text").collect())
        got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in byte_bpe(frame).collect()}
        assert got == want


def test_long_pretokens_and_ties():
    bpe, encoding = ByteBpe(*vocabulary()), library()
    for text in ("a" * 3001, "ab" * 2000, "the" * 999, "éa" * 501, " " * 777, "\U0001f600" * 50, "xyzzy" * 301 + "a" * 17):
        assert bpe.encode(text) == encoding.encode_ordinary(text)
        assert bpe.decode(bpe.encode(text)) == text.encode()


def test_rank_queue_gives_ranks_in_order():
    queue = RankQueue()
    for rank in (50000, 3, 64, 4096, 3, 4095):
        queue.push(rank, 1)
    seen = []
    while (rank := queue.first()) >= 0:
        seen.append(rank)
        queue.close(rank)
    assert seen == [3, 64, 4095, 4096, 50000]


def test_empty_table(no_docs):
    assert byte_bpe(no_docs).collect() == []
