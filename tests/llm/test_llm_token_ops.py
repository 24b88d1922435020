"""Token tables, counts, compressed files, packing, sharding, URLs, the pipeline."""

import os
import sys
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))
import corpus as C  # noqa: E402

from parcelflow.llm import packing as B  # noqa: E402
from parcelflow.llm import repair_grammar as R  # noqa: E402
from parcelflow.llm import sharding as S  # noqa: E402
from parcelflow.llm import token_counts as T  # noqa: E402
from parcelflow.llm import url_filter as U  # noqa: E402
from parcelflow.llm.tokens import piece_tokenizer, tokenizer_path  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

PATH = tokenizer_path()
TEXT = st.text(st.sampled_from("abcdeéßœÉ ñ\n\t.,'s!?0123<|>日\u0301\u00a0\x1c—🙂"), max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_ids_and_counts_equal_the_library(texts):
    t = piece_tokenizer(PATH)
    got = [ids[a:b].tolist() for _, ids, bounds in t.slices(pa.array(texts, pa.string())) for a, b in zip(bounds, bounds[1:])]
    assert got == [C.library_ids(x, PATH) for x in texts]
    c = T._counter(PATH)
    for x, ids in zip(texts, got):
        raw = x.encode()
        for size in (3, 1000):
            maps = [c.chunk(raw[k:k + size]) for k in range(0, len(raw), size)]
            if maps:
                assert T.finish(T.total(maps, c.__getitem__), c.__getitem__) == len(ids), (x, size)


def test_counts_over_documents(spark):
    got = T.count_tokens(C.frame(spark), PATH, chunk_bytes=500).collect()
    assert len(got) == len(C.rows())
    for r in got:
        assert r.n_tokens == len(C.library_ids(r.text, PATH)), r.doc_id
    assert T.count_tokens(C.empty(spark), PATH).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=300))
def test_grammar_round_trip(ids):
    x = np.array(ids, np.uint32)
    seq, rules, lengths = R.compress(x, min_count=2)
    assert (R.expand(seq, rules) == x).all()
    assert R.expand_all(seq, rules, lengths).tolist() == ids
    assert [len(R.expand(np.array([R.FIRST_SYMBOL + k]), rules)) for k in range(len(rules))] == lengths.tolist()
    width, raw = R._packed(seq)
    row = {"sequence": raw, "width": width, "rules": rules.tobytes(), "lengths": lengths.tobytes(), "first_symbol": R.FIRST_SYMBOL}
    for a in range(0, len(x), 7):
        assert (R.read_range(row, a, min(5, len(x) - a)) == x[a:a + 5]).all()


def test_files_in_order(spark):
    files = R.write(C.frame(spark), PATH, shard_tokens=700)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in R.read(files).collect())
    at = 0
    for (start, doc, n, crc), row in zip(got, sorted(C.rows(), key=lambda r: r[0])):
        ids = [*C.library_ids(row[1], PATH), R.END_ID]
        assert (start, doc, n, crc) == (at, row[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += n
    assert len(got) == len(C.rows()) and files.count() > 3
    assert R.read(R.write(C.empty(spark), PATH)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=60))
def test_best_fit_and_bound(sizes):
    s = np.array(sizes)
    bins, offset, fill = B.best_fit(s, 64)
    for b in range(len(fill)):
        at = 0
        for o, n in sorted(zip(offset[bins == b], s[bins == b])):
            assert o == at
            at += n
        assert at == fill[b] <= 64
    bound = B.lower_bound(np.bincount(s, minlength=65), 64)
    assert -(-s.sum() // 64) <= bound <= len(fill)
    assert bound >= (s > 32).sum()


def test_packing_documents(spark):
    got = B.pack(B.pieces(C.frame(spark), PATH, capacity=256), capacity=256, pieces_per_part=20).collect()
    want = sorted((r[0], k, 256 * k, min(256, n - 256 * k)) for r in C.rows() for n in [len(C.library_ids(r[1], PATH)) + 1] for k in range(-(-n // 256)))
    assert sorted((r.doc_id, r.piece, r.start, r.length) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in bins.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= 256
    assert len(bins) <= -(-sum(r.length for r in got) // 256) + 1
    assert B.pack(B.pieces(C.empty(spark), PATH)).count() == 0


def test_partitions_with_a_gap_exchange_and_all_are_certified(spark):
    """Each group's bins and bound are those of its rows; the total is within one in a hundred of one best-fit run over all."""
    rnd = np.random.default_rng(8)
    sizes = [int(x) for x in rnd.choice([90, 95, 35, 70, 128, 256, 17], 1500)]
    df = spark.createDataFrame([(k, 0, 0, n, 0) for k, n in enumerate(sizes)], B.PIECES)
    got = B.pack(df, capacity=256, pieces_per_part=100).toPandas()
    assert sorted(got["length"]) == sorted(sizes)
    seq = got.groupby("sequence_id").agg(fill=("length", "sum"), bins=("part_bins", "first"), bound=("part_bound", "first"), parts=("part_bins", "nunique"))
    assert (seq["fill"] <= 256).all() and (seq["parts"] == 1).all() and (seq["bound"] <= seq["bins"]).all()
    bound = B.lower_bound(np.bincount(sizes, minlength=257), 256)
    assert bound <= len(seq) <= 1.01 * len(B.best_fit(np.array(sizes), 256)[2])
    alone = seq[(seq["bins"] == 1) & (seq["bound"] == 1)]
    assert len(alone) and (alone["fill"] > 0).all()
    # Sequences of a group of n bins come n at a time.
    grouped = seq[seq["bins"] > 1].reset_index()
    for _, g in grouped.groupby(grouped["sequence_id"] // (1 << 20)):
        assert len(g) == g["bins"].iloc[0]
        part = got[got["sequence_id"].isin(g["sequence_id"])]["length"]
        assert B.lower_bound(np.bincount(part, minlength=257), 256) == g["bound"].iloc[0]


def test_registered_token_queries_equal_the_library(spark, tmp_path):
    rows = [*C.rows(), (None, "no id here", "en", "s", 10, "n", "b", "low", "t")]
    spark.createDataFrame(rows, C.SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    ids = {r[0]: C.library_ids(r[1], PATH) for r in rows}
    text = {r[0]: r[1] or "" for r in rows}
    got = T.op10_token_counts(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text[r.doc_id].encode()), len(ids[r.doc_id]), len(ids[r.doc_id]) > 2048)
    got = B.op9_best_fit_packing(spark, str(tmp_path)).collect()
    assert sum(r.length for r in got) == sum(len(ids[r[0]]) + 1 for r in rows)
    for r in got:
        part = [*ids[r.doc_id], 1][r.start:r.start + r.length]
        assert r.start == 4096 * r.piece and r.length == len(part) and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())


def test_long_text_without_white_space_is_counted_in_bounded_maps(spark):
    """Chunks that are one open word: a round of compositions holds no more than the text."""
    c = T._counter(PATH)
    data = ("ab1-" * 50_000).encode()
    maps, held = [c.chunk(data[k:k + 1000]) for k in range(0, len(data), 1000)], []
    real = T.compose
    try:
        T.compose = lambda a, b, closed: held.append(sum(len(x) for x in (a[0], a[2], b[0], b[2]))) or real(a, b, closed)
        whole = T.total(maps, c.__getitem__)
    finally:
        T.compose = real
    assert whole == (data, 0, b"", False) and sum(held) <= len(data) * 9
    docs = spark.createDataFrame([(1, data.decode(), "given")], "doc_id long, text string, n_tokens string")
    got = T.count_tokens(docs, PATH, chunk_bytes=1000)
    assert got.columns == ["doc_id", "text", "n_tokens"] and got.first().n_tokens == len(C.library_ids(data.decode(), PATH))


def test_sharding_even_whole_and_linked(spark):
    copies = [f"copy {k}" for k in range(30) for _ in range(6)] + ["one hot text"] * 90
    docs = C.frame(spark, copies)
    out = S.shard(docs, shards=7)
    rows = out.collect()
    assert len(rows) == len(C.rows(copies))
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert len(by) == 7 and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    text = {r[0]: r[1] or "" for r in C.rows(copies)}
    assert all((r.size, r.text_crc32) == (len(text[r.doc_id].encode()) + 16, zlib.crc32(text[r.doc_id].encode())) for r in rows)
    # Nearly every row is linked and the hot text alone needs three shards: an even deal cuts 6 links in 7.
    r = S.cut_links(out.where("size > 16"), ["text_crc32"]).first()
    assert r.cut < 0.75 * r.links
    assert S.shard(C.empty(spark)).count() == 0


def test_sharding_keeps_groups_whole_where_others_can_move(spark):
    texts = [f"copy {k}" for k in range(40) for _ in range(5)] + ["hot"] * 400 + [f"alone {k}" for k in range(1400)]
    out = S.shard(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4), shards=8)
    counts = [r["count"] for r in out.groupBy("shard").count().collect()]
    assert sorted(counts) == [250] * 8
    small = out.join(out.groupBy("text_crc32").count().where("count between 2 and 5").select("text_crc32"), "text_crc32")
    assert S.cut_links(small, ["text_crc32"]).first().cut == 0
    assert out.where(F.col("text_crc32") == zlib.crc32(b"hot")).select("shard").distinct().count() == 2


def test_sharding_joins_pairs_where_every_row_is_linked(spark):
    """No free row anywhere: full shards must swap, or the even deal stays and cuts 39 links in 40."""
    texts = [f"pair {k // 2}" for k in range(4000)]
    out = S.shard(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)).persist()
    assert [r["count"] for r in out.groupBy("shard").count().collect()] == [100] * 40
    r = S.cut_links(out, ["text_crc32"]).first()
    assert r.links == 2000 and r.cut < 0.05 * r.links


def test_sharding_large_group_takes_all_its_shards(spark):
    """A group of three quarters of the rows fills 18 of 24 shards, one a round."""
    texts = ["hot"] * 1800 + [f"alone {k}" for k in range(600)]
    out = S.shard(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4), shards=24)
    assert out.where(F.col("text_crc32") == zlib.crc32(b"hot")).select("shard").distinct().count() == 18


URLS = [(1, "HTTP://WWW.Example.NET/en/x?q=1#f"), (2, "https://example.com/de/1"), (3, "https://a.org/fr/"), (4, "https://a.org"), (5, None), (6, ""), (7, "no host"), (8, "ftp://notexample.net"),
        (9, "https://example.com/en/"), (10, "http://net/x"), (11, "https://x.net?en=/en/"), (12, "a://b://c.net/d"), (13, "https://sub.example.net/en/")]


def test_url_rules(spark):
    df = spark.createDataFrame([(*u, "keep", "x") for u in URLS], "page_id long, url string, host string, score string")
    judged = U.judge(df, U.UrlModel(None, {}, 0.0))
    assert judged.columns == ["page_id", "url", "host", "path", "rule", "verdict", "score"]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judged.collect()}
    assert got[1] == ("www.example.net", "/en/x", "example.net/en/", "allow")
    assert got[2] == ("example.com", "/de/1", "example.com/de/", "block") and got[3] == ("a.org", "/fr/", "org/fr/", "allow")
    assert got[4] == ("a.org", "", None, "allow") and got[5] == got[6] == got[7] == ("", "", None, "allow")
    assert got[8] == ("notexample.net", "", None, "allow") and got[9][2] is None      # net/ needs a path that begins with /
    assert got[10][2:] == ("net/", "block") and got[11] == ("x.net", "", None, "allow")
    assert got[12][:2] == ("b:", "//c.net/d") and got[13][3] == "allow"


def test_url_trees_learn_lexical_signals(spark):
    rng = np.random.default_rng(7)
    rows = []
    for k in range(1200):
        bad = k % 2
        host = f"{'x' * int(rng.integers(2, 6))}{rng.integers(10**6, 10**8)}.click" if bad and rng.random() < 0.8 else f"site{rng.integers(0, 9)}.example.com"
        rows.append((k, f"https://{host}/{'/'.join('ab' for _ in range(int(rng.integers(1, 4))))}" + ("?a=1&b=2&c=3&d=4" if bad and rng.random() < 0.7 else ""), bad if k % 13 else None))
    df = spark.createDataFrame(rows, "page_id long, url string, label int")
    model = U.fit(df.where("page_id % 4 > 0"), trees=10, depth=3)
    held = model.score(df.where("page_id % 4 = 0 and label is not null")).collect()
    assert np.mean([(r.score >= 0.5) == bool(r.label) for r in held]) >= 0.9
    assert U.fit(df.where("label = 1")).trees is None and U.fit(df.limit(0)).trees is None


def test_rules_label_the_training_urls(spark, tmp_path):
    """Trees fitted on URLs that a rule decides agree with the rules on held-out ones; others get a verdict of theirs."""
    hosts = ["a.example.net", "www.net", "b.org", "example.com", "shop.example.com", "x.example.net"]
    urls = [f"https://{hosts[k % 6]}/{['en', 'de', 'fr'][k // 6 % 3]}/{k}" for k in range(1200)] + [None, "none", "https://x.test/en/1"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labelled = U.rule_labels(pages)
    assert 0 < labelled.count() < 1200 and {r.label for r in labelled.select("label").distinct().collect()} == {0, 1}
    held = F.pmod(F.xxhash64("url", F.lit(9)), F.lit(4)) == 0
    model = U.fit(labelled.where(~held), trees=10, depth=3)
    got = model.score(labelled.where(held)).collect()
    assert len(got) > 100 and np.mean([(r.score >= 0.5) == bool(r.label) for r in got]) >= 0.9
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    rows = {r.page_id: r for r in U.op2_url_gbt(spark, str(tmp_path)).collect()}
    assert len(rows) == len(urls) and all(r.verdict in ("allow", "block") for r in rows.values())
    assert rows[1200].host == rows[1201].host == "" and rows[1202].rule is None
    assert U.op2_url_gbt(spark, str(tmp_path)).where("rule is not null").count() == labelled.count()


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    item = " ".join(C.texts()[12].split()[:40])
    mail = "write to bob.ray@mail.example.com " + " ".join(f"q{k}" for k in range(80))
    rows = [r[:5] for r in C.rows([mail])]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.stored(stage(spark, docs, str(tmp_path)), name)
        seen[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns
    ids = {k: {r.doc_id for r in v.select("doc_id").distinct().collect()} for k, v in seen.items()}
    near = C.components([(r[0], r[1]) for r in rows if r[0] in ids["quality_rules"]], 5, 80)
    assert ids["near_duplicates"] == {i for i, (n, c) in near.items() if i == c}
    assert 12 in ids["near_duplicates"] and 12 not in ids["benchmark_decontamination"]
    assert ids["personal_data"] == ids["benchmark_decontamination"] == ids["best_fit_packing"]
    assert not seen["personal_data"].where("text like '%bob.ray@%'").count()
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == seen["best_fit_packing"].count()


def test_repair_goes_on_until_no_pair_pays():
    """Whatever a round takes, no pair that occurs often enough is left at the end (copies of long passages need many rounds)."""
    rng = np.random.default_rng(4)
    for trial in range(30):
        x = np.tile(rng.integers(0, 12, 60), 8) if trial % 3 == 0 else rng.integers(0, int(rng.integers(1, 12)), 400)
        for limit in (1, R.PAIRS_PER_ROUND):
            seq, rules, lengths = R.compress(x.astype(np.uint32), limit=limit)
            assert (R.expand(seq, rules) == x).all() and (R.expand_all(seq, rules, lengths) == x).all()
            count, last = {}, {}
            for i, pair in enumerate(zip(seq.tolist(), seq[1:].tolist())):
                if pair[0] != pair[1] or last.get(pair) != i - 1:
                    last[pair], count[pair] = i, count.get(pair, 0) + 1
            assert max(count.values(), default=0) < R.MIN_COUNT


def test_pairs_are_counted_exactly_whatever_the_width_of_the_symbols():
    """Counts, order and places against a plain count; symbols too wide for one 64-bit number with their place go another way."""
    rng = np.random.default_rng(7)
    for scale in (1, 5000, 1 << 22, (1 << 29) - 1):
        for n in (0, 1, 400):
            x, y = (rng.integers(0, 8, (2, n)) * scale).astype(np.uint32)
            at = np.sort(rng.choice(1 << 21, n, replace=False))
            pairs, places, rank = R._frequent(x, y, at, 4)
            of = {}
            for a, b, k in zip(x.tolist(), y.tolist(), at.tolist()):
                of.setdefault(a << 32 | b, []).append(k)
            want = sorted((p for p in of if len(of[p]) >= 4), key=lambda p: (-len(of[p]), p))
            assert pairs.tolist() == want
            assert sorted(zip(rank.tolist(), places.tolist())) == [(k, i) for k, p in enumerate(want) for i in of[p]]


def test_of_neighbouring_places_the_more_frequent_stays():
    """No two neighbours stay, and what goes has a neighbour of no larger rank that stays; a run of equal rank keeps every second."""
    rng = np.random.default_rng(8)
    for _ in range(300):
        at = np.flatnonzero(rng.random(60) < 0.8)
        rank = rng.integers(0, int(rng.integers(1, 9)), len(at)).astype(np.int32)
        stays = dict(zip(*(v.tolist() for v in R._disjoint(at, rank))))
        for k, r in zip(at.tolist(), rank.tolist()):
            beside = [stays[j] for j in (k - 1, k + 1) if j in stays]
            assert not beside and stays[k] == r if k in stays else min(beside) <= r
    assert R._disjoint(np.arange(5, 12), np.zeros(7, np.int32))[0].tolist() == [5, 7, 9, 11]


def test_rounds_cost_by_the_places_looked_at():
    """No table of all hash classes is built anew in every round, however few places are left."""
    x = np.tile(np.arange(1000, dtype=np.uint32), 4)
    tracemalloc.start()
    seq, rules, _ = R.compress(x)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (R.expand(seq, rules) == x).all() and peak < 4 << 20


def test_words_of_every_plain_letter():
    """Words of any letters that skip the normaliser, with and without a sign, among pieces that don't; no thread of the library's own."""
    t, library = piece_tokenizer(PATH), Tokenizer.from_file(PATH)
    letters = [chr(c) for c in [*range(ord("a"), ord("z") + 1), *range(0xDF, 0x100), 0x153]]
    pieces = [w + s for x in letters for w in (x, "a" + x + "n") for s in ("", ".", "?", "!!", "$$$")] + ["ÉtÉ", "10", "日"]
    ids, length = t.encode([p.encode() for p in pieces])
    assert [v.tolist() for v in np.split(ids, np.cumsum(length)[:-1])] == [library.encode(p, add_special_tokens=False).ids for p in pieces]
    assert [len(v) for v in t.encode([])] == [0, 0] and os.environ["TOKENIZERS_PARALLELISM"] == "false"
