"""Periodic runs, packing by non-negative least squares, vector codes: the
registered queries and their operators against brute force."""

import hashlib
import math
import os
import random
import sys
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, os.path.dirname(__file__))
import corpus as C  # noqa: E402

from parcelflow.llm import periodic_runs as P  # noqa: E402


# ---- op11 -----------------------------------------------------------------------

def brute_runs(w, min_words=24, turns=3):
    """Every run by its definition, each lag from each start."""
    out, n = {}, len(w)
    for q in range(1, n // turns + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            b = i
            while i < n and w[i] == w[i - q]:
                i += 1
            if i - (b - q) >= max(min_words, turns * q):
                out.setdefault((b - q, i), q)              # the smallest period comes first
    return sorted((a, e - a, q) for (a, e), q in out.items())


def found_runs(texts, min_words=24, turns=3):
    """Runs of word lists as the operator's array code finds them, all in one slice."""
    ids = {}
    word = np.array([ids.setdefault(x, len(ids)) for t in texts for x in t], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts]).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    got = [[] for _ in texts]
    for d, s, n, q in zip(*(x.tolist() for x in P.runs_of(word, doc, bounds, min_words, turns))):
        got[d].append((s, n, q))
    return got


#: Texts made of repeated, nested and cut pieces over few words.
PIECE = st.lists(st.integers(0, 3), min_size=1, max_size=9)
NESTED = st.lists(st.tuples(PIECE, st.integers(1, 9), PIECE, st.integers(1, 5)), max_size=5).map(lambda x: [w for a, n, b, m in x for w in (a * n + b) * m])


@settings(max_examples=300, deadline=None)
@given(st.lists(NESTED, max_size=4))
def test_runs_equal_brute_force(texts):
    assert found_runs(texts) == [brute_runs(t) for t in texts]
    assert found_runs(texts, 6, 3) == [brute_runs(t, 6, 3) for t in texts]
    assert found_runs(texts, 10, 4) == [brute_runs(t, 10, 4) for t in texts]


def test_runs_of_long_and_random_texts():
    rnd = random.Random(3)
    fib = ["a", "ab"]
    while len(fib[-1]) < 3000:
        fib.append(fib[-1] + fib[-2])
    period = [rnd.randrange(50) for _ in range(137)]
    texts = [list(fib[-1])[:1500], period * 5 + period[:60], [1] * 700, [rnd.randrange(2) for _ in range(900)], ([1] * 30 + [2]) * 12, ([1, 2, 1, 1, 2] * 6 + [9] * 40) * 4]
    assert found_runs(texts) == [brute_runs(t) for t in texts]
    assert found_runs([[7] * 2_000_000]) == [[(0, 2_000_000, 1)]]      # a word that fills a text: no square work


def op11_expected(doc_id, text):
    w = C.words(text)
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join("%d,%d,%d\n" % r for r in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def _write(spark, tmp_path, rows):
    spark.createDataFrame(rows, C.SCHEMA).repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")


def _key(r):
    return tuple((x is not None, x) for x in r)


def test_op11_query(spark, tmp_path):
    cut = lambda t: t if t is None or len(t) < 20_000 else t[:20_000]  # noqa: E731  brute force is slow on the longest
    rows = [(k, cut(r[1]), *r[2:]) for k, r in enumerate(C.rows(["a b c " * 30 + "x " + "d " * 40, "r s t u v " * 9] * 3) * 4)]
    rows = [*rows, (None, "k l " * 40, *rows[0][2:]), rows[3], rows[3]]
    planted = [r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10 == 0]
    assert len(planted) > 8
    _write(spark, tmp_path, rows)
    got = [tuple(r) for r in P.op11_periodic_runs(spark, str(tmp_path)).collect()]
    want = [op11_expected(r[0], r[1]) for r in rows if r[0] is not None]
    # A null id plants nothing.
    want.append((None, *op11_expected(1, "k l " * 40)[1:])) if zlib.crc32(b"1") % 10 else None
    assert sorted(got, key=_key) == sorted(want, key=_key)
    assert P.periodic_runs(C.empty(spark)).count() == 0


# ---- op13 -----------------------------------------------------------------------

from parcelflow.llm import vector_codes as V  # noqa: E402


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 300), st.integers(1, 5), st.sampled_from([2, 9, 4000, 10**9]), st.integers(0, 10**6))
def test_gnat_equals_brute_force_with_ties(n, width, spread, seed):
    rnd = np.random.default_rng(seed)
    points, q = rnd.integers(-spread, spread + 1, (n, width)), rnd.integers(-spread, spread + 1, (80, width))
    if spread >= V.EXACT:
        points, q = points.astype(object), q.astype(object)
    q[:20] = points[rnd.integers(0, n, 20)]                    # distance 0, also to repeated entries
    d = ((q[:, None, :] - points[None, :, :]) ** 2).sum(2)
    best, at = V.Gnat(points).nearest(q)
    assert best.tolist() == d.min(1).tolist() and at.tolist() == d.argmin(1).tolist()


def test_gnat_leaves_subtrees_out():
    rnd = np.random.default_rng(1)
    centres = rnd.integers(-4000, 4000, (12, 3))
    points = (centres[rnd.integers(0, 12, 256)] + rnd.integers(-40, 41, (256, 3)))
    tree = V.Gnat(points)
    q = points[rnd.integers(0, 256, 500)] + rnd.integers(-40, 41, (500, 3))
    tree.nearest(q)
    assert tree.measured < 0.3 * 500 * 256


def op13_expected(rows, parts=4, entries=256, rounds=4):
    ok = [(i, [math.floor(1024 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(ok, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ok = [r for r in ok if len(r[1]) == len(order[0][1])] if ok else []
    order = [r for r in order if len(r[1]) == len(order[0][1])]
    if not ok:
        return [], ""
    w = len(ok[0][1]) // parts
    books = [[r[1][p * w:(p + 1) * w] for r in order[:entries]] for p in range(parts)]

    def assign(v, p):
        part = v[p * w:(p + 1) * w]
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = [list(b) for b in books]
        for p in range(parts):
            by = {}
            for _, v, _ in ok:
                by.setdefault(assign(v, p)[1], []).append(v[p * w:(p + 1) * w])
            for k, members in by.items():
                new[p][k] = [sum(c) // len(members) for c in zip(*members)]
        books = new
    out, label = [], {}
    for i, v, lab in ok:
        got = [assign(v, p) for p in range(parts)]
        e = sum(d for d, _ in got)
        label[lab] = label.get(lab, 0) + e
        out.append((i, "".join("%02x" % k for _, k in got), e, lab))
    text = ",".join(str(x) for b in books for e in b for x in e)
    return [(i, c, e, label[lab], hashlib.sha256(text.encode()).hexdigest()) for i, c, e, lab in out], text


def _vectors(n, length, seed=2):
    rnd = np.random.default_rng(seed)
    x = np.round(rnd.normal(0, 0.01, (n, length)), 3).astype(np.float32)         # small integers, so many ties
    return [(int(i), [float(v) for v in row], int(i) % 3 if i % 5 else None) for i, row in zip(rnd.permutation(n), x)]


def test_op13_query(spark, tmp_path):
    inf, nan = float("inf"), float("nan")
    rows = _vectors(420, 8)
    rows += [rows[0], rows[0], (900, None, 1), (901, [1.0] * 7 + [None], 1), (902, [nan] * 8, 1), (903, [inf] + [0.0] * 7, 1), (904, [-inf] * 8, None), (905, [0.5] * 4, 2), (None, [0.25] * 8, 2), (906, [], 1)]
    for name, some in (("many", rows), ("few", rows[:40]), ("large", [*rows[:300], (950, [float(1 << 40)] * 8, 1), (951, [-3e9] * 8, 1)]), ("none", rows[422:426])):
        spark.createDataFrame(some, "vec_id long, embedding array<float>, label int").selectExpr("*", "'x' as code", "'y' as v").repartition(3).write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
        exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in some]
        want, _ = op13_expected(exact)
        got = [tuple(r) for r in V.op13_vector_codes(spark, f"{tmp_path}/{name}").collect()]
        assert sorted(got, key=_key) == sorted(want, key=_key), name


# ---- op12 -----------------------------------------------------------------------

import pyarrow as pa  # noqa: E402

from parcelflow.llm import histogram_packing as H  # noqa: E402
from parcelflow.llm.tokens import PieceTokenizer, tokenizer_path  # noqa: E402

PATH = tokenizer_path()


def test_combinations_fill_the_window():
    got = H.combinations(64, 4)
    want = {tuple(sorted((a, b, c, 64 - a - b - c), reverse=True)) for a in range(65) for b in range(65 - a) for c in range(65 - a - b)}
    assert {tuple([*c, 0, 0, 0][:4]) for c in got} == want and len(got) == len(want)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 6), st.integers(1, 9), st.integers(0, 10**6))
def test_nnls_meets_the_optimality_conditions(m, n, seed):
    rnd = np.random.default_rng(seed)
    a, b = rnd.integers(0, 3, (m, n)).astype(float), rnd.integers(0, 30, m).astype(float)
    x = H.nnls(a, b, 1000)
    g = a.T @ (b - a @ x)                       # no column can lower the residual, and those in use are at their best
    assert (x >= 0).all() and g.max() <= 1e-6 and np.abs(g[x > 0]).max(initial=0) <= 1e-6


def check_places(lengths, capacity):
    doc, start, length, seq, offset = (x.tolist() for x in H.place(np.array(lengths, np.int64), capacity))
    by_doc, by_seq = {}, {}
    for d, s, n, q, o in zip(doc, start, length, seq, offset):
        assert n > 0
        by_doc.setdefault(d, []).append((s, n))
        by_seq.setdefault(q, []).append((o, n))
    for parts, total in [*((by_doc[d], n) for d, n in enumerate(lengths)), *((v, None) for v in by_seq.values())]:
        at = 0
        for s, n in sorted(parts):
            assert s == at
            at += n
        assert at == total if total else at <= capacity and (at == capacity or at & (at - 1) == 0)
    total = sum(lengths)
    assert len(by_seq) <= total // capacity + capacity.bit_length()
    return sum(len(v) for v in by_doc.values())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 200), max_size=120), st.sampled_from([1, 2, 64, 128]))
def test_places_are_gapless_and_unpadded(lengths, capacity):
    check_places(lengths, capacity)


def test_few_documents_are_cut():
    rnd = np.random.default_rng(4)
    for lengths in (np.minimum(rnd.lognormal(5.5, 1.2, 4000).astype(int) + 1, 4095), rnd.integers(1, 4096, 3000), np.full(700, 2049), rnd.integers(1, 40, 20_000)):
        pieces = check_places(lengths.tolist(), 4096)
        sequences = -(-int(lengths.sum()) // 4096)
        assert pieces - len(lengths) <= 1.1 * sequences + 13
    sizes = np.minimum(rnd.lognormal(5.5, 1.2, 4000).astype(int) + 1, 4095)
    full = [int(sizes[s].sum()) == 4096 for s in H.pack_items(sizes)]
    assert np.mean(full) > 0.5                  # most sequences need no cut at all


def test_op12_query(spark, tmp_path):
    rows = [*C.rows(), (None, "no id here", "en", "s", 10, "n", "b", "low", "t")]
    _write(spark, tmp_path, rows)
    got = H.op12_nnls_packing(spark, str(tmp_path))
    assert H.padding(got).first().padding == 0
    for packed, capacity in ((got, 4096), (H.pack(C.frame(spark).limit(0), PATH), 4096), (H.pack(spark.read.parquet(f"{tmp_path}/documents.parquet"), PATH, 256, 2, block_tokens=3000), 256)):
        out = packed.collect()
        if not out:
            continue
        want = {}
        for d, t, *_ in rows:
            want.setdefault(d, []).append([*C.library_ids(t, PATH), 2])
        seen, seq = {}, {}
        for r in out:
            some = want[r.doc_id][0]                                  # repeated rows have equal texts here
            assert r.doc_tokens == len(some) and r.ids_crc32 == zlib.crc32(np.array(some[r.start:r.start + r.length], "<u4").tobytes())
            seen.setdefault(r.doc_id, []).append((r.start, r.length))
            seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for d, copies in want.items():
            cover = np.zeros(len(copies[0]), int)
            for s, n in seen[d]:
                cover[s:s + n] += 1
            assert (cover == len(copies)).all(), d
        for v in seq.values():
            at = 0
            for o, n in sorted(v):
                assert o == at
                at += n
            assert at <= capacity


def test_piece_table_grows_within_a_slice():
    t = PieceTokenizer(PATH, kept=500, bits=6)
    texts = [" ".join(f"u{k}x{j}" for k in range(3000)) for j in range(3)] + ["plain words", None]
    got = [ids[a:b].tolist() for _, ids, bounds in t.slices(pa.array(texts, pa.string())) for a, b in zip(bounds, bounds[1:])]
    assert got == [C.library_ids(x, PATH) for x in texts]
