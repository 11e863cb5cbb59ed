import re
from collections import Counter

import pytest

from tessera.llm.quality_rules import host_verdicts, quality_rules, repeated_words


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts_equal_brute_force(docs, sample):
    for frame in (docs, sample):
        got = {r.doc_id: r for r in quality_rules(frame).collect()}
        for d in frame.select("doc_id", "text").collect():
            r = got[d.doc_id]
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(d.text)
            assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
            assert not (r.kept and r.base_failed)
        assert len(got) == frame.count()


def test_a_failing_host_loses_its_documents(spark):
    good, bad = " ".join(f"word{i}" for i in range(40)), "spam"
    rows = [(i, bad if i % 10 else good, "bad") for i in range(100)] + [(100 + i, good, f"good{i % 5}") for i in range(100)]
    kept = {r.doc_id: r.kept for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not any(kept[i] for i in range(100)) and all(kept[i] for i in range(100, 200))


def test_prior_shrinks_small_hosts(spark):
    rows = [("big", False)] * 900 + [("big", True)] * 100 + [("small", True)] + [("mid", False)] * 45 + [("mid", True)] * 5
    got = {r.host: r for r in host_verdicts(spark.createDataFrame(rows, "host string, base_failed boolean")).collect()}
    assert got["small"].host_rate < 1 and got["big"].host_rate == pytest.approx(0.1, abs=0.02)


def test_repeated_words_of_other_widths():
    words = [b"a", b"b", b"a", b"b", b"a"]
    assert repeated_words(words, 2) == 5 and repeated_words([b"q"] * 9, 8) == 9 and repeated_words([b"q"] * 8, 8) == 0


def test_empty_table(no_docs):
    assert quality_rules(no_docs).collect() == []
