import glob
import math
import zlib
from collections import Counter
from itertools import groupby
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tributary.llm import oracles, queries, topk

SF = "/root/testdata/sf0.001"


def brute(vectors, k, step):
    out = []
    rows = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in vectors]
    for at, (q, u) in enumerate(rows):
        if q % step:
            continue
        scored = sorted((-sum(a * b for a, b in zip(u, v, strict=False)), c) for n, (c, v) in enumerate(rows) if n != at)
        out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("strip,block", [(1024, 16_384), (16, 50)])
def test_top_k_matches_brute_force(spark, monkeypatch, strip, block):
    monkeypatch.setattr(topk, "STRIP", strip)
    monkeypatch.setattr(topk, "CANDIDATES", block)
    monkeypatch.setattr(topk, "QUERIES", 7)
    monkeypatch.setattr(topk, "SEED", 20)
    rng = np.random.default_rng(1)
    vectors = [(i, (rng.normal(0, 0.1, 12) * (1 + (i % 17 == 0) * 3)).astype(np.float32).tolist()) for i in range(400)]
    vectors += [(400 + i, vectors[i][1]) for i in range(20)]  # ties
    vectors += [(i, (2 * np.array(vectors[i][1])).tolist()) for i in range(0, 40, 4)] + vectors[:10]  # ids on several rows, equal and not
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(3)
    got = sorted(map(tuple, topk.top_k(frame, F.col("vec_id") % 10 == 0, 5).collect()))
    assert got == brute([(i, np.float32(v).astype(float).tolist()) for i, v in vectors], 5, 10)


def test_top_k_edges(spark):
    schema = "vec_id long, embedding array<double>, score int, rank string"
    rows = [(0, [0.5, 0.5], 1, "x"), (1, None, 1, "x"), (2, [0.1, None], 1, "x"), (3, [float("nan"), 1.0], 1, "x"), (4, [float("inf"), 1.0], 1, "x"), (5, [1.0, 0.0], 1, "x"), (5, [1.0, 0.0], 1, "x"), (6, [], 1, "x"), (None, [1.0, 1.0], 1, "x"), (-50, [1.0], 1, "x"), (7, [1e30, 1.0], 1, "x")]
    got = sorted(map(tuple, topk.top_k(spark.createDataFrame(rows, schema), F.col("vec_id") % 50 == 0, 5).collect()))
    # both rows of vec_id 5 are candidates
    assert got == [(-50, 1, 5, 65536), (-50, 2, 5, 65536), (-50, 3, 0, 32768), (-50, 4, 6, 0), (0, 1, -50, 32768), (0, 2, 5, 32768), (0, 3, 5, 32768), (0, 4, 6, 0)]
    assert topk.top_k(spark.createDataFrame([], schema), F.col("vec_id") % 50 == 0).count() == 0
    wide = spark.createDataFrame([(0, [2.0**50, 2.0**50]), (1, [2.0**50, 1.0])], "vec_id long, embedding array<double>")
    assert [r.score for r in topk.top_k(wide, F.lit(True), 1).collect()] == [2**63 - 1] * 2


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {Path(f).stem} AS FROM '{f}'")
    return con


def plain(v):
    return None if v is None or isinstance(v, float) and math.isnan(v) else round(v, 9) if isinstance(v, float) else v


def test_top_k_of_repeated_ids_matches_sql(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = [(int(i), rng.normal(0, 0.3, 8).astype(np.float32).tolist()) for i in rng.integers(0, 120, 300)]
    spark.createDataFrame(rows + [(None, [1.0] * 8), (50, None)], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = con.sql(oracles.SQL["op1_topk"]).fetchall()
    assert sorted(map(tuple, queries.QUERIES["op1_topk"](spark, str(tmp_path)).collect())) == sorted(want)


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_query_matches_sql(spark, duck, name):
    rows = queries.QUERIES[name](spark, SF)
    sql = duck.sql(oracles.SQL[name])
    names = sorted(rows.columns)
    assert names == sorted(sql.columns)
    order = [sql.columns.index(n) for n in names]
    assert Counter(tuple(plain(r[n]) for n in names) for r in rows.collect()) == Counter(tuple(plain(r[i]) for i in order) for r in sql.fetchall())


def test_each_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(oracles.SQL)))
def test_query_covers_every_document(spark, name):
    ids = {r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    assert {r.doc_id for r in queries.QUERIES[name](spark, SF).select("doc_id").collect()} == ids


@pytest.fixture(scope="module")
def small(tmp_path_factory, spark):
    """A table of documents with nulls, copies, near copies and odd texts, and its rows."""
    from tests.llm.test_text_operators import ODD

    rng = np.random.default_rng(11)
    words = ["the", "Cat", "sät", "on", "mats.", "1", "tion", "shing"]
    rows = [x for x in ODD if x[0] != 7 and x[0] is not None]
    rows += [(100 + i, " ".join(rng.choice(words, int(n))), ["en", "de"][i % 2], f"s{i % 3}") for i, n in enumerate(rng.integers(0, 200, 40))]
    rows += [(300 + i, r[1] + " again", r[2], r[3]) for i, r in enumerate(rows[-10:])] + [(400, rows[-1][1], "en", "s1")]
    folder = tmp_path_factory.mktemp("small")
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    return str(folder), rows


def held(doc_id, mod, rest):
    return zlib.crc32(str(doc_id).encode()) % mod == rest


def test_op3_query(spark, small):
    folder, rows = small
    got = {(r.doc_id, r.held_out): r for r in queries.QUERIES["op3_langid"](spark, folder).collect()}
    assert set(got) == {(d, held(d, 4, 2)) for d, *_ in rows}
    letters = {d: any(c.isalpha() for c in t or "") for d, t, *_ in rows}
    assert all((r.lang_pred == "und") == (not letters[r.doc_id]) and 0 <= r.score <= 1 and r.lang_pred in ("und", "de", "en", "fr") for r in got.values())


def test_op4_query(spark, small):
    from tests.llm.test_text_operators import WORD, brute_count, brute_scores
    from tributary.llm import tokencount

    folder, rows = small
    scores = brute_scores([r[1] for r in rows])
    u = tokencount.Unigram(scores)
    known = {w: brute_count(scores, u.unknown, u.longest, "▁" + w) for _, t, *_ in rows for w in WORD.findall(t or "")}
    want = [(d, len(ws), sum(map(known.get, ws))) for d, t, *_ in rows for ws in [WORD.findall(t or "")]]
    assert sorted(map(tuple, queries.QUERIES["op4_tokencount"](spark, folder).collect())) == sorted(want)


def test_op5_query(spark, small):
    from tests.llm.test_text_operators import crc, ids_of

    folder, rows = small
    # rows of one doc_id may come either way round
    want, start = [], 0
    for d, t, *_ in sorted(rows, key=lambda r: r[0]):
        ids = ids_of(t)
        want.append((d, start, len(ids), crc(ids)))
        start += len(ids)
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in queries.QUERIES["op5_dac"](spark, folder).collect())
    assert got == sorted(want)


def test_op7_query(spark, small):
    from tests.llm.test_text_operators import brute_ppm

    folder, rows = small
    low = {d: (t or "").encode().lower() for d, t, *_ in rows}
    train = [(t or "").encode().lower() for d, t, *_ in rows if not held(d, 5, 1)]
    c = Counter(x for t in train for x in [*t.split(), b""])
    n, v = sum(c.values()), len(c)
    got = queries.QUERIES["op7_ppm"](spark, folder).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, *_ in rows)
    for r in got:
        toks = [*low[r.doc_id].split(), b""]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id, 5, 1), len(toks), sum(c[x] > 0 for x in toks), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in toks))
    for r in got[::6]:
        assert r.score == pytest.approx(brute_ppm(train, low[r.doc_id]), rel=1e-4)


def test_op9_query(spark, small):
    from tests.llm.test_text_operators import brute_components, brute_fingerprint

    folder, rows = small
    codes = np.array([brute_fingerprint(t or "") for _, t, *_ in rows], np.uint64)
    want = brute_components(codes, [r[0] for r in rows], 4)
    got = sorted(map(tuple, queries.QUERIES["op9_simhash"](spark, folder).collect()))
    assert got == sorted((r[0], f"{int(c):016x}", w) for r, c, w in zip(rows, codes, want, strict=True))


def test_op10_query(spark, small):
    """Pieces cover every token once, and the stream is that of a plain deficit round-robin."""
    from tests.llm.test_text_operators import crc, ids_of
    from tributary.llm import packing

    folder, rows = small
    ids = {d: ids_of(t) for d, t, *_ in rows}
    got = sorted(queries.QUERIES["op10_packing"](spark, folder).collect(), key=lambda r: (r.sequence_id, r.offset))
    place = 0
    for r in got:
        assert r.sequence_id * packing.WINDOW + r.offset == place and r.ids_crc32 == crc(ids[r.doc_id][r.start : r.start + r.length]) and r.doc_tokens == len(ids[r.doc_id])
        place += r.length
    assert place == sum(len(ids[d]) for d, *_ in rows)
    # plain rounds: a queue's deficit grows by its share of a window; once it saved for a packet, it sends all that is covered
    mix = {r.doc_id: r.h for r in spark.createDataFrame([(d,) for d in ids], "doc_id long").select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    tokens, queues = Counter(), {}
    for d, _, _, s in sorted(rows, key=lambda r: (mix[r[0]], r[0])):
        tokens[s] += len(ids[d])
        queues.setdefault(s, []).extend((d, at) for at in range(len(ids[d])))
    quantum = {s: packing.WINDOW * tokens[s] / place for s in tokens}
    order = sorted(queues, key=lambda s: (s is None, s or ""))
    every = {s: max(1, math.ceil(packing.PACKET / quantum[s])) for s in order}
    saved = {s: (n + 1) % every[s] for n, s in enumerate(order)}
    earned, sent, plain, turn = {s: saved[s] * quantum[s] for s in order}, dict.fromkeys(order, 0), [], 0
    while sum(sent.values()) < place:
        turn += 1
        for s in order:
            saved[s] += 1
            earned[s] += quantum[s]
            if saved[s] == every[s] or turn * quantum[s] >= tokens[s] - 1e-6:
                to = min(tokens[s], math.floor(earned[s] + 1e-6))
                plain += [(s, 1)] * (to - sent[s])
                sent[s], saved[s] = to, 0
    runs = lambda items: [(s, sum(n for _, n in g)) for s, g in groupby(items, lambda x: x[0])]
    assert runs((r.source, r.length) for r in got) == runs(plain)


def test_pipeline_stages_match_brute_force(spark, small):
    """Quality, near copies, mixing and packing against plain versions; language by its own rule."""
    from tests.llm.test_text_operators import brute_kept, brute_taken, ids_of
    from tributary.llm import common, langid, quality

    folder, _ = small
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    # written and read again, as the next stage drops the scratch tables of the one before
    stage = {name: lambda *a, f=f: common.materialise(f(*a), "stage") for name, f in corpus_pipeline.STAGES}
    told = stage["language_id"](spark, docs, folder)
    model = langid.train(docs.select("doc_id", "text", "lang"), F.lit(True))
    assert Counter(map(tuple, told.collect())) == Counter((r.row.doc_id, r.row.text, r.language.lang_pred, r.row.source, r.row.n_chars) for r in langid.identify(docs, model).collect() if not r.language.rejected)
    good = stage["quality_rules"](spark, told, folder)
    assert Counter(map(tuple, good.collect())) == Counter(
        (r.row.doc_id, r.quality.cleaned, r.row.lang, r.row.source, r.row.n_chars if r.quality.cleaned == r.row.text else len(r.quality.cleaned)) for r in quality.assess(told).collect() if r.quality.kept
    )
    rows = [tuple(r)[:4] for r in good.collect()]
    distinct = stage["near_dedup"](spark, good, folder)
    kept = [tuple(r) for r in distinct.collect()]
    assert sorted(r[0] for r in kept) == brute_kept(rows) and len(kept) < len(rows)
    mixed = [r.doc_id for r in stage["mixing"](spark, distinct, folder).collect()]
    plain = [(r[0], len(r[1].split()), r[3]) for r in kept]
    whole = brute_taken(plain, 1 << 40, True)
    assert Counter(mixed) == Counter({d: times for (d, n, _), taken in zip(plain, whole, strict=True) if (times := taken // n)})
    packed = stage["packing"](spark, spark.createDataFrame([r for r in kept for _ in range(2)], distinct.schema), folder).collect()
    assert sum(r.length for r in packed) == 2 * sum(len(ids_of(r[1])) for r in kept)


def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "near_dedup", "mixing", "packing"]
    rows = corpus_pipeline.run(spark, SF).collect()
    ids = {r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    assert rows and {r.doc_id for r in rows} < ids
