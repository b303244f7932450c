"""Filter interactions, ranked search and personal data against brute force."""

import hashlib
import itertools
import math
import os
import random
import re
import threading
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tallyspark.llm import extraction, filter_audit, lexical, pii, quality, registry, shared, toxicity, vector_search
from tallyspark.llm.shared import table

WORD = re.compile("[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string"


def docs(spark, rows):
    """Documents with extra columns of clashing names."""
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS part", "2 AS n", "'a' AS words", "0 AS score", "true AS good")


def failed(text: str) -> frozenset[str]:
    words = WORD.findall(text)
    rules = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), "D": bool(re.search("[#$%&*|]", text))}
    return frozenset(k for k, v in rules.items() if v)


def audit_by_hand(rows, labels):
    """Every order walked document by document."""
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    parts = defaultdict(list)
    for i, t, lang in rows:
        t = t or ""
        known = [(q, x) for d, q, x in labels if d == i and i is not None]
        parts[lang or ""].append((failed(t) | ({"E"} if i is not None and i > least[t] else set()), any(q == 1 for q, _ in known), any(x == 1 for _, x in known)))
    out = {}
    for part, members in parts.items():
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            left = list(members)
            for step, f in enumerate(order, 1):
                removed = [m for m in left if f in m[0]]
                left = [m for m in left if f not in m[0]]
                earlier = [m for m in members if f in m[0] and set(order[: step - 1]) & m[0]]
                shapley[f] += len(removed)
                out[part, "".join(order), step] = [len(left), len(removed), len(earlier), sum(m[0] == {f} for m in members), sum(m[1] for m in removed), sum(m[2] for m in removed)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def test_audit(spark):
    long = " ".join(f"w{i}" for i in range(250))
    rows = [(1, None, "en"), (2, "", None), (3, "", ""), (4, long, "en"), (4, long, "en"), (5, long, "de"), (None, long, "en"), (6, "A# b", "en"), (7, "a " * 400, "en"), (8, "ABC " * 300 + long, "en"), (9, "é" * 500, "fr"), (10, long + " $", "en"), (11, "word " * 60000, "en"), (12, "A# b", "en")]
    labels = [(4, 1, 0), (4, None, 1), (6, 1, 1), (12, 0, 1), (None, 1, 1), (99, 1, 1)]
    got = filter_audit.audit(docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS part", "1 AS n"))
    columns = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    collected = got.collect()
    assert {(r.part, r.filter_order, r.step): [r[c] for c in columns] for r in collected} == audit_by_hand(rows, labels) and len(collected) == 600 * len({lang or "" for _, _, lang in rows})
    assert filter_audit.audit(docs(spark, []), spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_matrix_is_that_of_the_texts(spark):
    rows = [(i, t, "en") for i, t in enumerate(["a b a", None, "b\tc  c c", "", "日本 é a", "x" * 70000])]
    matrix, known = filter_audit.document_term_matrix(docs(spark, rows).repartition(3))
    names = {r.id: r.word for r in known.collect()}
    assert sorted(names) == list(range(len(names))) and set(names.values()) == {w for _, t, _ in rows for w in WORD.findall(t or "")}
    got = {}
    for r in matrix.collect():
        indptr, indices, counts = np.frombuffer(r.indptr, np.int64), np.frombuffer(r.indices, np.int64), np.frombuffer(r.counts, np.int32)
        for k, i in enumerate(r.doc_id):
            at = slice(indptr[k], indptr[k + 1])
            got[i] = Counter(dict(zip((names[w] for w in indices[at].tolist()), counts[at].tolist(), strict=True)))
    assert got == {i: Counter(WORD.findall(t or "")) for i, t, _ in rows}


def ranked_by_hand(rows, items, top=20):
    terms = lambda t: re.findall(lexical.TERM, (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    held = [(i, Counter(terms(t))) for i, t in rows]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = Counter()
    for item, text in items:
        scores = []
        for i, c in held:
            m = 100 - 25 + 25 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if s > 0:
                scores.append((-s, i is None, i))
        out.update((item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top]))
    return out


def test_search_ranks_like_a_plain_loop(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"t{i}" for i in range(60)] + ["Zwölf", "日本", "A-B", "x_y", "é"]
    rows = [(i, " ".join(rng.choice(words[: rng.choice([5, 30, 65])]) for _ in range(rng.choice([1, 3, 20, 200])))) for i in range(300)]
    rows += [(1000 + i, "same t1 t2 t2 words") for i in range(45)] + [(7, "t1"), (7, "t1"), (None, "t1 t59"), (None, "t59"), (2000, None), (2001, "--"), (2002, "t3 " * 50000)]
    items = [(1, "t1 t1 T59 nowhere"), (2, ""), (3, None), (4, "same words T2"), (5, " ".join(words)), (5, "a b"), (6, "?"), (None, "t3"), (8, "t1 " * 3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS item", "2 AS score", "'a' AS terms").repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "'b' AS rank")
    want = ranked_by_hand(rows, items)
    for segment, block in ((lexical.SEGMENT_BYTES, lexical.ITEM_BYTES), (300, 40)):
        monkeypatch.setattr(lexical, "SEGMENT_BYTES", segment)
        monkeypatch.setattr(lexical, "ITEM_BYTES", block)
        assert Counter(tuple(r) for r in lexical.search(frame, asked).collect()) == want
    assert lexical.search(frame.limit(0), asked).count() == 0 and lexical.search(frame, asked.limit(0)).count() == 0
    assert lexical.search(frame.filter("doc_id = 2001"), asked).count() == 0


def test_search_skips_strata(spark):
    """Once good documents are found, strata that cannot hold a better one are not read."""
    rows = [(i, " ".join([f"r{i}"] * 2 + ["a"] * (1 + i % 400))) for i in range(800)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    size = lexical.sizes(frame)
    (row,) = lexical.build_index(frame, size).toArrow().to_batches()
    segment, best = lexical.Segment(row, lexical.pa.array(["r5", "a"])), lexical.Best(1)
    read = segment.search(np.array([0, 1]), np.array([lexical.weight(size, 1), 1]), best)
    assert best.doc.tolist() == [5] and read < segment.strata / 4


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_by_hand(text: str) -> list[tuple[str, int, int]]:
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            even = sum(int(d) for d in digits[-1::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True, "card": 13 <= len(digits) <= 19 and even % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, *m.span()))
    return out


MIXED = st.lists(st.one_of(st.text("19 .+-()@a_é,\n", max_size=30), st.sampled_from(["4111 1111 1111 1111", "4111-1111-1111-1111", "+1 (017) 555-7713", "a.b@c.de", "10.0.0.1", "x@y", "+", "@", "1.2.3.4.5.6.7.8", "é@b.c", "a@b.c@d.e"])), max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(MIXED, min_size=1, max_size=4))
def test_base_spans_are_those_of_the_patterns(texts):
    text = pii.as_text(texts)
    got = [[] for _ in texts]
    for kind, a, b in pii.base_spans(text):
        d = int(text.text_of(np.array([a]))[0])
        raw = bytes(text.data[text.offsets[d] : text.offsets[d + 1]])
        point = lambda x, d=d, raw=raw: len(raw[: x - text.offsets[d]].decode())
        got[d].append((pii.KINDS[kind], point(a), point(b)))
    assert got == [base_by_hand(t) for t in texts]


def test_patterns_take_linear_time():
    for t in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "+1 " * 100_000, "@" * 50_000, "a@" * 50_000, "1 " * 100_000):
        pii.spans_of(pii.as_text([t]), pii.trained())


def marginals_by_loop(f, observed, model):
    """The same messages, one link and one label at a time."""
    n, links = len(f.words), list(zip(f.left.tolist(), f.right.tolist(), f.link.tolist(), strict=True))
    local = [[sum(f.features[i, k] * model.unary[k, y] for k in range(f.features.shape[1])) if observed[i] < 0 else (0 if y == observed[i] else -1e4) for y in range(5)] for i in range(n)]
    edges = [(a, b, lambda x, y, k=k: model.pair[k, x, y]) for a, b, k in links] + [(b, a, lambda x, y, k=k: model.pair[k, y, x]) for a, b, k in links]
    m, back = [[0.0] * 5 for _ in edges], lambda e: (e + len(links)) % (2 * len(links))
    for _ in range(pii.SWEEPS):
        belief = [[local[i][y] + sum(m[e][y] for e, (_, b, _) in enumerate(edges) if b == i) for y in range(5)] for i in range(n)]
        fresh = []
        for e, (a, _, pair) in enumerate(edges):
            terms = [[belief[a][x] - m[back(e)][x] + pair(x, y) for x in range(5)] for y in range(5)]
            out = [max(t) + math.log(sum(math.exp(v - max(t)) for v in t)) for t in terms]
            fresh.append([v - max(out) for v in out])
        m = [[pii.DAMPING * o + (1 - pii.DAMPING) * v for o, v in zip(old, new, strict=True)] for old, new in zip(m, fresh, strict=True)]
    out = []
    for i in range(n):
        b = [local[i][y] + sum(m[e][y] for e, (_, t, _) in enumerate(edges) if t == i) for y in range(5)]
        top = [math.exp(v - max(b)) for v in b]
        out.append([v / sum(top) for v in top])
    return np.array(out).reshape(n, 5)


def test_messages_are_those_of_a_plain_loop():
    rng, model = random.Random(3), pii.trained()
    for _ in range(12):
        text = pii.as_text([pii.drawn_document(rng)[0] + " 10.0.0.1 4111 1111 1111 1111 555-7713 555-7713"])
        f = pii.field(text)
        observed = pii._covered(f.words, pii.base_spans(text))
        assert np.allclose(pii.marginals(f, observed, model), marginals_by_loop(f, observed, model), atol=1e-9)


def test_chains_without_loops_are_exact():
    """Where links make no loop, the messages give the marginals of all labellings summed up."""
    model = pii.trained()
    f = pii.field(pii.as_text(["a +1 (017) 555-7713 b 12 c"]))
    observed = np.full(len(f.words), -1)
    total = np.zeros((len(f.words), 5))
    for labels in itertools.product(range(5), repeat=len(f.words)):
        s = sum(f.features[i] @ model.unary[:, y] for i, y in enumerate(labels)) + sum(model.pair[k, labels[a], labels[b]] for a, b, k in zip(f.left, f.right, f.link, strict=True))
        for i, y in enumerate(labels):
            total[i, y] += math.exp(s)
    want = total / total.sum(1, keepdims=True)
    assert np.allclose(pii.marginals(f, observed, model, 60), want, atol=1e-6)


def added(text: str) -> list[tuple[str, str]]:
    return [(k, text[a:b]) for k, a, b, base in pii.spans_of(pii.as_text([text]), pii.trained())[0] if not base]


def test_labels_agree_across_a_document():
    said = "Call +1 (017) 555-7713 today. Later (017) 555-7713 was free, and so was 555-7713 again."
    assert added(said) == [("phone", "(017) 555-7713"), ("phone", "555-7713")]
    assert added("Then 555-7713 stood alone in the ledger of the town") == []
    assert added("+1 (826) 555-4081 190.137.223.204 du") == [("phone", "+1 (826) 555-4081")]
    for clean in ("version 4.0. of 2024-01-31 at 12:30", "id 2390409500648960 of order", 'token = "269b1cea0846965f2d3ecb5cdb87c0edc0aa12bb"', "$12.50 and 999.1.2.3", "@user", ""):
        assert added(clean) == []


def test_field_finds_held_out_mentions():
    """Of mentions no pattern finds, most are found by their likes, and few others are taken."""
    rng, model = random.Random(77), pii.trained()
    drawn = [pii.drawn_document(rng) for _ in range(800)]
    hit = miss = wrong = 0
    for t, spans in drawn:
        base = [(a, b) for _, a, b, is_base in pii.spans_of(pii.as_text([t]), model)[0] if is_base]
        free = [s for s in spans if not any(a < s[2] and s[1] < b for a, b in base)]
        got = [(k, a, b) for k, a, b, is_base in pii.spans_of(pii.as_text([t]), model)[0] if not is_base]
        found = [any(pii.KINDS[k] == kind and a <= s and e <= b for kind, a, b in got) for k, s, e in free]
        hit, miss = hit + sum(found), miss + len(found) - sum(found)
        wrong += sum(not any(pii.KINDS[k] == kind and a < e and s < b for k, s, e in spans) for kind, a, b in got)
    assert hit > 0.85 * (hit + miss) and wrong < 0.03 * hit


def test_personal_data_query(spark, sf):
    rows = {r.doc_id: r.text or "" for r in table(spark, sf, "documents").collect()}
    got = registry.op12_personal_data(spark, sf).collect()
    assert {r.doc_id for r in got} == set(rows) and len(got) == len(rows)
    for r in got:
        base = base_by_hand(rows[r.doc_id])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(k == x for x, _, _ in base) for k in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest() and set(filter(None, line.split(","))) <= set(r.spans.split(","))
    odd = [(1, None, "a"), (2, "", "a"), (None, "x@y.zz", None), (3, "é x@y.zz", "a"), (3, "é x@y.zz", "a"), (4, "10.0.0.1 " * 20000, "a")]
    found = sorted(((r.doc_id, r.n_email, r.n_ip) for r in pii.digests(pii.personal_data(docs(spark, odd))).collect()), key=str)
    assert found == sorted([(1, 0, 0), (2, 0, 0), (None, 1, 0), (3, 1, 0), (3, 1, 0), (4, 0, 20000)], key=str)
    assert pii.personal_data(docs(spark, [])).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_training_repeats(seed):
    a, b = (pii.trained.__wrapped__(seed, 200, 20) for _ in range(2))
    assert (a.unary == b.unary).all() and (a.pair == b.pair).all()


def test_numbers_of_words_met_in_parts(spark, monkeypatch):
    """Words of a partition keep their numbers when its rows come in several turns."""
    monkeypatch.setattr(filter_audit, "HELD_ROWS", 7)
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", 30)
    test_matrix_is_that_of_the_texts(spark)


def search_block(number, ids, part):
    low, step, cells = vector_search.approximation(part)
    return vector_search.Block({"block": number, "dim": part.shape[1], "width": 8, "ids": ids.astype("<i8").tobytes(), "data": part.astype("<i8").tobytes(), "low": low.tobytes(), "step": step.tobytes(), "cells": cells.tobytes()})


@pytest.mark.parametrize("pending", [50, 1 << 20])
def test_ties_and_zeros_among_vectors(monkeypatch, pending):
    monkeypatch.setattr(vector_search, "PENDING", pending)
    rng = np.random.default_rng(2)
    pool = rng.integers(-3, 4, (12, 5))
    v, ids = pool[rng.integers(0, 12, 900)], rng.permutation(1200)[:900] // 2
    q = np.concatenate([pool[:4], np.zeros((2, 5), np.int64), rng.integers(-9, 9, (3, 5))])
    blocks = [search_block(i, ids[300 * i : 300 * i + 300], v[300 * i : 300 * i + 300]) for i in range(3)]
    own = np.array([blocks[0].rows[3], blocks[2].rows[7], *[-1] * 7])
    rows, full = np.concatenate([b.rows for b in blocks]), q @ v.T
    a, got, s, _ = vector_search.best_of_group([b.thinned(10) for b in blocks], q, own, np.full(9, -np.inf), 10)
    for i in range(9):
        want = sorted((-int(full[i, j]), int(ids[j])) for j in range(900) if rows[j] != own[i])[:10]
        assert list(zip((-s[a == i]).tolist(), got[a == i].tolist(), strict=True)) == want


def test_equal_vectors_take_no_square_of_time():
    """48 blocks of one vector, 512 queries of which some are zeros: a few reads for each query."""
    one = np.tile(np.arange(64), (4096, 1))
    blocks = [search_block(n, np.arange(4096) + 4096 * n, one).thinned(10) for n in range(48)]
    q = np.tile(np.arange(64), (512, 1))
    q[::7] = 0
    a, ids, s, read = vector_search.best_of_group(blocks, q, np.full(512, -1), np.full(512, -np.inf), 10)
    assert read <= 512 * 48 * 11 and (ids.reshape(512, 10) == np.arange(10)).all() and (s.reshape(512, 10)[::7] == 0).all()
    # Nothing but zero queries over vectors that all differ.
    rng = np.random.default_rng(0)
    blocks = [search_block(n, np.arange(4096) + 4096 * n, rng.integers(-999, 999, (4096, 64))).thinned(10) for n in range(4)]
    a, ids, s, read = vector_search.best_of_group(blocks, np.zeros((64, 64), np.int64), np.full(64, -1), np.full(64, -np.inf), 10)
    assert read <= 64 * 4 * 10 and (ids.reshape(64, 10) == np.arange(10)).all()


@pytest.mark.parametrize(
    "element",
    ['<section id="discussion"><p>{}</p></section>', '<section class="legal"><p>{}</p></section>', '<div class="notice">{}</div>', '<table class="menu"><tr><td>{}</td></tr></table>', '<div class="search results">{}</div>', '<p class="side">{}</p>', '<p id="copyright">{}</p>', '<ol id="reply-list"><li>{}</li></ol>', "<dialog>{}</dialog>", "<p><math><mi>{}</mi></math></p>", '<section class="related"><p>{} see <a href="/x">this</a></p></section>'],
)
def test_names_cut_nothing_that_a_marked_article_says(element):
    said = "The rule of the island is told here in full"
    page = extraction.Page(f"<body><nav><a href='/'>Home</a></nav><article><h1>Title</h1><p>First part of it.</p>{element.format(said)}<p>End.</p></article><footer>Foot</footer></body>")
    kept = [t for n, t in page.blocks if page.main[n] and not page.dropped[n]]
    assert [" ".join(t.split()) for t in kept][0] == "Title" and kept[-1] == "End." and any(said in t for t in kept) and not any("Foot" in t or "Home" in t for t in kept)


@pytest.mark.parametrize("element", ['<div class="ad">{}</div>', '<div id="comments"><p>{}</p></div>', "<form><p>{}</p></form>", "<nav>{}</nav>", "<aside>{}</aside>", '<div class="newsletter-box">{}</div>', '<div class="cookie notice">{}</div>', '<ul class="menu"><li><a href="/a">{}</a></li></ul>', '<div class="related"><a href="/b">{}</a></div>'])
def test_parts_that_are_no_article_go_inside_it_too(element):
    page = extraction.Page(f"<body><article><p>First part of it.</p>{element.format('Not this')}<p>End.</p></article></body>")
    assert [t for n, t in page.blocks if page.main[n] and not page.dropped[n]] == ["First part of it.", "End."]


def test_thresholds_of_sources_with_enough_documents(spark):
    """Groups above and below ``ENOUGH``, of one language and another, against the SQL."""
    rng = random.Random(6)
    rows = []
    for lang, source, n, odd in (("en", "big", 260, 0.02), ("en", "loud", 230, 0.9), ("en", "few", 40, 0.5), ("de", "few", 30, 0.3), ("de", "many", 205, 0.1), (None, None, 15, 0.5)):
        for _ in range(n):
            words = ["w" * rng.randint(2, 9) + str(rng.randrange(4000)) for _ in range(rng.randint(40, 90))]
            if rng.random() < odd:
                words = [w + rng.choice(["$$", "##", "&"]) * rng.randint(1, 3) for w in words]
            rows.append((len(rows), " ".join(words), lang, source))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    con = duckdb.connect()
    con.register("documents", frame.toPandas())
    want = {r[0]: r[1] for r in con.execute(f"SELECT doc_id, kept FROM ({registry.SQL['op2_quality_rules']})").fetchall()}
    got = {r.doc_id: r.kept for r in quality.quality_rules(frame).collect()}
    assert got == want
    limits = {(r.t_lang, r.t_source): r.symbol_rate_high for r in quality.thresholds(quality.with_metrics(quality.measured(frame))).collect()}
    # Sources with enough documents have limits of their own.
    assert len({limits["en", "big"], limits["en", "loud"], limits["de", "many"]}) == 3


def test_scratch_belongs_to_its_thread(spark):
    """What another thread stores meanwhile isn't deleted with the scratch of this one, and tables outside all are known."""
    done, go, found = threading.Event(), threading.Event(), {}

    def other():
        found["outside"] = shared.stored(spark.range(5), "test-other")
        with shared.scratch():
            inner = shared.stored(spark.range(3), "test-inner")
            done.set()
            go.wait(60)
            found["inner"] = inner.count()

    thread = threading.Thread(target=other)
    with shared.scratch():
        mine = shared.stored(spark.range(7), "test-mine")
        thread.start()
        done.wait(60)
    go.set()
    thread.join()
    assert found["inner"] == 3 and found["outside"].count() == 5 and any(x is found["outside"] for x in shared._left)
    assert not os.path.exists(mine.stored_at.removeprefix("file://"))
    shared.discard(found["outside"])


def network(seed=5, words=9, steps=6, windows=4):
    """Weights, inputs, and windows of which some end early."""
    rng = np.random.default_rng(seed)
    p = toxicity.initial(rng, tuple(np.zeros(1, np.float32) for _ in range(3)))
    p["c"] = np.array([0.3], np.float32)
    p |= {k: rng.normal(0, 0.3, p[k].shape).astype(np.float32) for k in ("bf", "bb")}
    x = rng.normal(0, 1, (words + 1, toxicity.INPUTS)).astype(np.float32)
    x[-1] = 0
    count = np.array([steps, 1, 3, steps - 1])[:windows]
    real = np.arange(steps)[:, None] < count
    return p, x, np.where(real, rng.integers(0, words, (steps, windows)), words).astype(np.int32), real


def logit_by_loop(p, rows):
    """One window, word by word and unit by unit."""
    H = toxicity.HIDDEN
    sig = lambda v: 1 / (1 + math.exp(-v))

    def chain(side, rows):
        h, out = [0.0] * H, []
        for row in rows:
            g = [sum(float(row[i]) * float(p[f"W{side}"][i, k]) for i in range(len(row))) + float(p[f"b{side}"][k]) for k in range(3 * H)]
            z = [sig(g[k] + sum(h[j] * float(p[f"U{side}"][j, k]) for j in range(H))) for k in range(H)]
            r = [sig(g[H + k] + sum(h[j] * float(p[f"U{side}"][j, H + k]) for j in range(H))) for k in range(H)]
            new = [math.tanh(g[2 * H + k] + sum(r[j] * h[j] * float(p[f"U{side}"][j, 2 * H + k]) for j in range(H))) for k in range(H)]
            h = [h[k] + z[k] * (new[k] - h[k]) for k in range(H)]
            out.append(h)
        return out

    states = [f + b for f, b in zip(chain("f", rows), chain("b", rows[::-1])[::-1], strict=True)]
    e = [sum(math.tanh(sum(s[j] * float(p["A"][j, k]) for j in range(2 * H))) * float(p["a"][k]) for k in range(H)) for s in states]
    w = [math.exp(v - max(e)) for v in e]
    pooled = [sum(a * s[j] for a, s in zip(w, states, strict=True)) / sum(w) for j in range(2 * H)]
    return sum(a * float(v) for a, v in zip(pooled, p["v"], strict=True)) + float(p["c"][0])


def test_network_is_that_of_a_plain_loop():
    p, x, index, real = network()
    got = toxicity.window_logits(p, x, index, real)
    for n in range(index.shape[1]):
        want = logit_by_loop(p, [x[i] for i in index[real[:, n], n]])
        assert abs(got[n] - want) < 1e-4


def test_gradients_are_those_of_differences():
    p, x, index, real = network()
    d_out = np.array([1.0, -0.5, 2.0, 0.7], np.float32)
    total = lambda: float(toxicity.forward(p, x, index, real)[0].astype(float) @ d_out)
    _, tape = toxicity.forward(p, x, index, real, keep=True)
    g, d_x = toxicity.backward(p, x, index, real, tape, d_out)
    rng = np.random.default_rng(1)
    for name, of, grad in [*((k, p[k], g[k]) for k in g), ("x", x[:-1], d_x[:-1])]:
        for _ in range(6):
            at = tuple(int(rng.integers(0, n)) for n in of.shape)
            before, step = of[at], 1e-2
            of[at] = before + step
            up = total()
            of[at] = before - step
            down = total()
            of[at] = before
            assert abs((up - down) / (2 * step) - grad[at]) < 2e-3 + 0.02 * abs(grad[at]), (name, at)


def test_windows_cover_every_word():
    for sizes in ([0], [1], [toxicity.WINDOW], [toxicity.WINDOW + 1, 0, 5], [1000, toxicity.STRIDE, 3 * toxicity.WINDOW + 7]):
        first = np.r_[0, np.cumsum(sizes)]
        text, start, count = toxicity.windows(first)
        for i, n in enumerate(sizes):
            covered = {w for s, c in zip(start[text == i].tolist(), count[text == i].tolist(), strict=True) for w in range(s, s + c)}
            assert covered == set(range(first[i], first[i] + n)) and (text == i).any()
