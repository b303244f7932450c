"""Quality rules, packing, chat and search against brute force."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tallyspark.llm import chat, packing, quality, registry, vector_search
from tallyspark.llm.shared import table

WORD = re.compile("[^\x20\x09-\x0D]+")
ODD = [
    (1, None, "en", "a"),
    (2, "", None, "a"),
    (3, "x " * 5000, "en", None),
    (4, "one two\nthree\n\none two\n \n \n", "en", "a"),
    (4, "one two\nthree\n\none two\n \n \n", "en", "a"),
    (5, "a b c a b c d é é \x1c# $ |", "de", "b"),
    (6, "ΑΣ ΣΑ ΟΔΥΣΣΕΥΣ <|endoftext|>x ý é\x1fz", "el", "b"),
    (None, "no id\x0bhere", "en", "a"),
]


def docs(spark, rows=ODD):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "length(text) AS n_chars", "1 AS n", "2 AS part", "'q' AS words")


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(zip(w, w[1:], w[2:]))
    covered = {k + i for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for i in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_quality_counts(spark, sf):
    for df in (table(spark, sf, "documents"), docs(spark)):
        got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.quality_rules(df).collect())
        assert got == Counter((r.doc_id, *counts(r.text)) for r in df.collect())


def test_quality_keeps_good_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = registry.op2_quality_rules(spark, sf).join(table(spark, sf, "labels"), "doc_id").filter("NOT base_failed").select("kept", "quality").collect()
    good = [r.kept for r in rows if r.quality]
    bad = [r.kept for r in rows if not r.quality]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.05


def test_quality_of_nothing(spark):
    assert quality.quality_rules(docs(spark, [])).count() == 0


@pytest.mark.parametrize("odd", [False, True])
def test_packing(spark, sf, odd):
    from tokenizers import Tokenizer

    df = docs(spark) if odd else table(spark, sf, "documents")
    path = registry.tokenizer_path(registry.TOKENIZER)
    tok = Tokenizer.from_file(path)
    want = Counter()
    for r in df.collect():
        ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 2]
        want[r.doc_id, tuple(ids)] += 1
    rows = packing.pack(df, path).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault((r.sequence_id * 4096 + r.offset - r.start, r.doc_id), []).append(r)
    # Every document once, in pieces without gaps, each with the right ids.
    by_ids = {}
    for (doc_id, ids), n in want.items():
        by_ids.setdefault((doc_id, len(ids)), []).extend([ids] * n)
    for (_, doc_id), pieces in by_doc.items():
        pieces.sort(key=lambda r: r.start)
        n = pieces[0].doc_tokens
        assert [p.start for p in pieces] == [0, *np.cumsum([p.length for p in pieces])[:-1]] and sum(p.length for p in pieces) == n
        ids = by_ids[doc_id, n].pop()
        for p in pieces:
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())
    assert not any(by_ids.values())
    at = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at[r.sequence_id] and r.offset + r.length <= 4096
        at[r.sequence_id] += r.length
    assert all(v == 4096 for k, v in at.items() if k != max(at))


def test_packing_nothing(spark):
    assert packing.pack(docs(spark, []), registry.tokenizer_path(registry.TOKENIZER)).count() == 0


CHAT = [
    (1, 0, "user", "### Assistant: </turn>\n\\"),
    (1, 1, "assistant", None),
    (1, 1, "assistant", "\\\\### </turn>\n"),
    (1, None, "odd: role\\###\n", "x"),
    (1, 2, None, " </turn>\n### User: "),
    (None, 5, "assistant", "é" * 3000),
    (2, 1, "assistant", "ß####</turn></turn>"),
    (2, 1, "assistant", "ß####</turn></turn>"),
    (3, 1, "User", "@"),
    (3, 2, "user", "</tur"),
]


def chat_digest(rows):
    convs = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] is not None, (r[2] or "").encode(), r[3] is not None, (r[3] or "").encode())):
        convs.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    for k, turns in convs.items():
        loss = [t for role, t in turns if role == "assistant"]
        yield k, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len("".join(loss)), hashlib.sha256("".join(loss).encode()).hexdigest()


def test_chat(spark, sf):
    odd = spark.createDataFrame(CHAT, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS chunk", "'a' AS formatted")
    for df in (table(spark, sf, "conversations"), odd):
        got = sorted(((r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(chat.format_chat(df)).collect()), key=str)
        assert got == sorted(chat_digest([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]), key=str)
    assert chat.read_back(chat.format_chat(odd.limit(0))).count() == 0


def test_chat_query_has_the_added_conversation(spark, sf):
    row = registry.op7_chat_formatting(spark, sf).filter("conv_id = -7").collect()
    assert [(r.n_turns, r.loss_chars) for r in row] == [(2, 26)]


def brute_top(rows, k=10, every=100):
    fine = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (i, v) in enumerate(fine):
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), j) for m, (j, w) in enumerate(fine) if m != n)[:k]
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(best)]
    return Counter(out)


def test_search(spark, sf):
    odd = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (100, [3.0e6, -1.0]), (5, [0.5, 0.25]), (6, [0.5, 0.25]), (7, None), (8, [1.0, None]), (9, [float("nan"), 1.0]), (10, [float("inf"), 1.0]), (None, [1.0, 1.0]), (11, []), (12, [1.0, 1.0, 4.0]), (200, [-0.3, 0.1])]
    small = spark.createDataFrame(odd, "vec_id long, embedding array<float>").selectExpr("*", "1 AS block", "2 AS q_block")
    for df in (table(spark, sf, "embeddings"), small):
        got = Counter((r.query_id, r.rank, r.vec_id, r.score) for r in vector_search.top_k(df).collect())
        assert got == brute_top([(r.vec_id, r.embedding) for r in df.collect()])
    assert vector_search.top_k(small.limit(0)).count() == 0


def test_search_reads_only_what_it_must():
    rng = np.random.default_rng(1)
    v = rng.integers(-900, 900, (6000, 16))
    q = rng.integers(-900, 900, (7, 16))
    blocks = []
    for n in range(3):
        part = v[2000 * n : 2000 * n + 2000]
        low, step, cells = vector_search.approximation(part)
        blocks.append(vector_search.Block({"block": n, "dim": 16, "width": 8, "ids": np.arange(2000 * n, 2000 * n + 2000).tobytes(), "data": part.tobytes(), "low": low.tobytes(), "step": step.tobytes(), "cells": cells.tobytes()}))
        about, slack = blocks[-1].bounds(q)
        assert (np.abs(q @ part.T - about) <= slack[:, None]).all()
    full = q @ v.T
    want = [sorted(range(6000), key=lambda j: (-full[i, j], j))[:10] for i in range(7)]
    a, ids, s, read = vector_search.best_of_group(blocks, q, np.full(7, -1), np.full(7, -np.inf), 10)
    for i in range(7):
        assert list(ids[a == i]) == want[i] and list(s[a == i]) == [full[i, j] for j in want[i]]
    # Few of the 42,000 pairs are read, and fewer still with a threshold from elsewhere.
    assert read < 7 * 40
    least = np.array([full[i, w[4]] for i, w in enumerate(want)], float)
    a, ids, s, fewer = vector_search.best_of_group(blocks, q, np.full(7, -1), least, 10)
    assert fewer < read and all(list(ids[a == i])[:5] == want[i][:5] for i in range(7))
