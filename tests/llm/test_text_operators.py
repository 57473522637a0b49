"""Operators over texts: edge cases and brute-force versions."""

import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tributary.llm import common, dac, jaccard, langid, lm, mixing, packing, quality, sharding, simhash, stages, tokencount, wordids

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, rank int, row string, taken long"
LONG = " ".join(f"w{i % 977}" for i in range(60_000)) + "\n" + "x" * 50_000


def documents(spark, rows):
    """Rows (doc_id, text, lang, source) with extra columns whose names clash with what operators add."""
    return spark.createDataFrame([(d, t, g, s, len(t or ""), "clash", 1, "clash", 9) for d, t, g, s in rows], SCHEMA)


ODD = [
    (1, None, "en", "a"), (2, "", None, None), (3, " \n\t", "en", "b"), (4, "One two three.", "en", "a"), (4, "One two three.", "en", "a"), (None, "no id here, but words.", "de", "c"),
    (6, "Ärger über Öl\x1cund Größe 123 <|endoftext|> <|STARTOFTEXT|>", "de", "b"), (7, LONG, "en", "a"), (8, "日本語 テスト 😀", None, "b"), (9, "123 !!! 456", "en", "a"), (10, "á é İstanbul", "fr", None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark, ODD).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return documents(spark, [])


def ids_of(text):
    return encoder().encode(text or "", add_special_tokens=False).ids + [2]


def encoder(_=[]):  # noqa: B006
    if not _:
        from tokenizers import Tokenizer

        _.append(Tokenizer.from_file(wordids.default_path()))
    return _[0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# --- common -----------------------------------------------------------------


def test_ordered_prefix_matches_a_running_sum(spark):
    rows = spark.range(500).select((F.col("id") % 7).alias("g"), F.pmod(F.xxhash64("id"), F.lit(40)).alias("o"), "id", (F.col("id") % 5).alias("v"))
    for group in (None, "g"):
        got = common.ordered_prefix(rows, ["o", "id"], "v", "before", group, partitions=6).collect()
        sums = {}
        for r in sorted(got, key=lambda r: ((r.g,) if group else ()) + (r.o, r.id)):
            k = r.g if group else 0
            assert r.before == sums.get(k, 0)
            sums[k] = sums.get(k, 0) + r.v
    assert common.ordered_prefix(rows.filter("id < 0"), ["o"], "v", "before", "g").count() == 0


@given(st.text(alphabet="ab \n", max_size=200))
def test_slices_keep_words(text):
    raw = text.encode()
    parts = list(common.slices(raw, 5))
    assert b"".join(parts) == raw and [w for p in parts for w in p.split()] == raw.split()


def test_join_small_both_ways(spark):
    left, right = spark.range(50), spark.range(0, 50, 5)
    assert common.join_small(left, right, "id", rows=100).count() == common.join_small(left, right, "id", rows=2).count() == 10


# --- mixing -------------------------------------------------------------------


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = total - sum(most * sizes[s] for s in capped)
        open_ = sum(w[s] for s in names if s not in capped)
        over = [s for s in names if s not in capped and free * w[s] >= most * sizes[s] * open_]
        if not over:
            return {s: most * sizes[s] if s in capped else free * w[s] / open_ for s in names}
        capped |= set(over)


def brute_taken(rows, part, whole=False):
    """Words taken of each row (doc_id, size, source) by a plain weighted fair queue of packets; ``whole``: a packet is taken if its middle is within the budget."""
    import hashlib

    sizes = {}
    for _, n, s in rows:
        sizes[s] = sizes.get(s, 0) + n
    goal, ranks = brute_targets(sizes), {s: i for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    queue = []
    for s in sizes:
        before = 0
        mine = [(hashlib.md5(("" if d is None else str(d)).encode()).hexdigest()[:16], d is not None, d or 0, n, at) for at, (d, n, x) in enumerate(rows) if x == s]
        for e in range(3):
            for k, known, d, n, at in sorted(mine):
                step = part if before + n > goal[s] else max(n, 1)
                for f in range(0, n, step):
                    length = min(step, n - f)
                    queue.append(((before + f + length) / goal[s], ranks[s], e, k, known, d, n, f, length, at))
                before += n
    left, taken = sum(sizes.values()), [0] * len(rows)
    if whole:
        for *_, length, at in sorted(x for x in queue if x[0] * goal[rows[x[-1]][2]] - x[-2] < goal[rows[x[-1]][2]] - 1e-6):
            taken[at] += length if length / 2 <= left else 0
            left -= length
        return taken
    for *_, length, at in sorted(queue):
        taken[at] += min(length, left)
        left -= min(length, left)
    return taken


def test_mixing(spark, odd, empty):
    rng = np.random.default_rng(2)
    extra = [(100 + i, " ".join(["w"] * int(n)), "en", f"s{i % 5}") for i, n in enumerate(rng.integers(0, 300, 120))]
    for docs, rows in ((odd, ODD), (documents(spark, extra).repartition(3), extra)):
        got = mixing.mix(docs)
        assert got.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
        got = got.collect()
        plain = [(d, len(WORD.findall(t or "")), s) for d, t, _, s in rows]
        sizes = {}
        for _, n, s in plain:
            sizes[s] = sizes.get(s, 0) + n
        goal = brute_targets(sizes)
        key = lambda r: (str(r[0]), str(r[1]), *r[2:])
        want = [(d, s, n, sizes[s], pytest.approx(goal[s]), k) for (d, n, s), k in zip(plain, brute_taken(plain, mixing.PART), strict=True)]
        assert sorted(map(key, map(tuple, got)), key=lambda r: (r[0], r[-1])) == sorted(map(key, want), key=lambda r: (r[0], r[-1]))
        for s in sizes:
            assert abs(sum(r.taken for r in got if r.source == s) - goal[s]) <= mixing.PART
        assert sum(r.taken for r in got) == sum(sizes.values()) and all(0 <= r.taken <= 3 * r.size for r in got)
    assert mixing.mix(empty).count() == 0


def test_mixed_documents_keep_schedule_order_and_texts(spark, odd):
    rows = [(i, " ".join([f"w{i}"] * (20 + i % 7)), "en", "abc"[i % 3]) for i in range(90)]
    docs = documents(spark, rows)
    out = mixing.mixed_documents(docs).collect()
    assert mixing.mixed_documents(odd).columns == odd.columns
    sizes = {r[0]: 20 + r[0] % 7 for r in rows}
    total = {s: sum(n for i, n in sizes.items() if "abc"[i % 3] == s) for s in "abc"}
    goal = brute_targets(total)
    taken = dict.fromkeys("abc", 0)
    for r in out:
        assert r.text == rows[r.doc_id][1]
        taken[r.source] += sizes[r.doc_id]
        # at any point of the schedule, sources are served in proportion
        time = [taken[s] / goal[s] for s in "abc"]
        assert max(time) - min(time) <= 2 * 26 / min(goal.values())
    assert all(abs(taken[s] - goal[s]) <= 26 for s in "abc")


@given(st.dictionaries(st.text("abc", min_size=1, max_size=2), st.integers(0, 1000), min_size=1, max_size=8))
@settings(max_examples=8, deadline=None)
def test_targets_match_resharing(spark, sizes):
    rows = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()
    goal = brute_targets(sizes)
    assert {r.source: r.target for r in rows} == {s: pytest.approx(v) for s, v in goal.items()}


# --- token output and packing ---------------------------------------------------


@given(st.lists(st.integers(0, 2**32 - 1), max_size=1500), st.integers(0, 31))
@settings(max_examples=40, deadline=None)
def test_dac_round_trip_and_random_access(ids, shift):
    a = (np.array(ids, np.uint64) >> np.uint64(shift)).astype(np.uint32)
    shard = dac.Shard(dac.encode(a))
    assert len(shard) == len(a) and (shard.range(0, len(a)) == a).all()
    for i in range(0, len(a), 37):
        assert shard[i] == a[i] and (shard.range(i, i + 50) == a[i : i + 50]).all()


def test_token_output(spark, odd, empty):
    path = common.scratch_path(spark, "t")
    dac.write(odd, path, shard_ids=40)
    rows = dac.read(spark, path).collect()
    start = 0
    for r, (d, t, *_) in zip(sorted(rows, key=lambda r: r.start), sorted(ODD, key=lambda x: (x[0] is not None, x[0] or 0)), strict=True):
        want = ids_of(t)
        assert (r.doc_id, r.start, r.n_tokens) == (d, start, len(want)) and np.frombuffer(r.ids, "<u4").tolist() == want
        start += len(want)
    digest = {(r.start, r.ids_crc32) for r in dac.read_digest(spark, path).collect()}
    assert digest == {(r.start, zlib.crc32(r.ids)) for r in rows}
    path = common.scratch_path(spark, "t")
    dac.write(empty, path)
    assert dac.read(spark, path).count() == 0


@pytest.mark.parametrize("most", [1, 300, 1 << 24])
def test_word_ids_match_the_library(most):
    w = wordids.WordIds(wordids.default_path())
    texts = [t or "" for _, t, *_ in ODD] + ["ŉ ŉa İ ǅ ʰa ªº µ ß", "İİ.. word, (word) word", " a  b\x0b", "it's 'll a.b ...", " "]
    assert [np.frombuffer(x, "<u4").tolist() for x in w.ids([t.encode() for t in texts], most)] == [ids_of(t)[:-1] for t in texts]
    assert w.ids([]) == []


def test_packing_covers_every_token_once(spark, odd, empty):
    rows = packing.pack(odd.select("doc_id", "text", "source")).collect()
    seqs, docs = {}, {}
    for r in rows:
        assert 0 < r.length and r.offset + r.length <= packing.WINDOW and len(r.ids) == 4 * r.length
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
        docs.setdefault((str(r.doc_id), r.doc_tokens), []).append((r.start, r.length, r.ids))
    for s, parts in seqs.items():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end == packing.WINDOW or s == max(seqs)
    assert sorted(seqs) == list(range(len(seqs)))
    for (d, n), parts in docs.items():
        if d == "4":  # two equal rows
            assert sum(p[1] for p in parts) == 2 * n
            continue
        text = next(t for i, t, *_ in ODD if str(i) == d)
        ids = [x for _, _, raw in sorted(parts) for x in np.frombuffer(raw, "<u4").tolist()]
        assert ids == ids_of(text) and n == len(ids)
    assert packing.pack(empty.select("doc_id", "text", "source")).count() == 0


def test_packing_mixes_windows(spark):
    text = " ".join(["the cat sat on the mat"] * 60)
    rows = [(i, text, "en", "big" if i % 3 else "small") for i in range(120)]
    got = packing.pack(documents(spark, rows).select("doc_id", "text", "source")).collect()
    share = {}
    for r in got:
        share.setdefault(r.sequence_id, {}).setdefault(r.source, 0)
        share[r.sequence_id][r.source] += r.length
    full = [s for k, s in share.items() if k != max(share)]
    assert full and all(abs(s.get("small", 0) / packing.WINDOW - 1 / 3) <= 2 * packing.PACKET / packing.WINDOW for s in full)
    # a round cuts each queue once, a window's end cuts one document
    assert len(got) <= len(rows) + 3 * len(share)


def test_small_sources_take_turns(spark):
    text = " ".join(["the cat sat on the mat"] * 40)
    rows = [(i, text, "en", "hot" if i % 3 == 0 else f"s{i % 40}") for i in range(600)]
    got = packing.pack(documents(spark, rows).select("doc_id", "text", "source")).collect()
    share, total = {}, {}
    for r in got:
        key = (r.sequence_id, r.source)
        share[key] = share.get(key, 0) + r.length
        total[r.source] = total.get(r.source, 0) + r.length
    windows = {k for k, _ in share}
    every = sum(total.values())
    # small sources save for four rounds, and the last four rounds share out what is left
    for k in range(max(windows) - 4):
        assert all(abs(share.get((k, s), 0) - packing.WINDOW * n / every) <= packing.PACKET for s, n in total.items())
    assert len(got) <= len(rows) + every / packing.PACKET + len(windows)


# --- sharding ---------------------------------------------------------------------


def test_hilbert_curve_is_a_walk():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        index = sharding.hilbert_index(cells, bits)
        assert sorted(index) == list(range(len(cells)))
        walk = cells[np.argsort(index)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_sharding(spark, odd, empty):
    for shards in (1, 4, 24):
        rows = sharding.place(odd, shards).collect()
        counts = {}
        for r in rows:
            counts.setdefault(r["shard"], []).append(r["slot"])
            assert r["law"] == "rows" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        assert all(sorted(s) == list(range(len(s))) for s in counts.values())
        sizes = [len(counts.get(s, [])) for s in range(shards)]
        assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(ODD)
        assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == sorted((str(d), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in ODD)
    assert sharding.place(empty, 24).count() == 0
    path = sharding.write(odd, shards=4)
    back = spark.read.parquet(path)
    assert back.count() == len(ODD) and set(odd.columns) < set(back.columns)
    assert sorted(str(r.text) for r in back.collect()) == sorted(str(t) for _, t, *_ in ODD)


def test_shards_prune_files_on_every_dimension(spark):
    rng = np.random.default_rng(4)
    rows = [(i, "x" * int(2 ** rng.uniform(2, 12)), ["de", "en", "es", "fr"][int(rng.integers(4))], f"s{rng.integers(8)}") for i in range(2000)]
    rows += [rows[0]] * 300  # copies of one row
    back = spark.read.parquet(sharding.write(documents(spark, rows), shards=128)).withColumn("size", F.length("text"))
    assert back.count() == len(rows)
    ends = back.groupBy("__shard").agg(*[f(c).alias(f"{n}_{c}") for c in ("lang", "source", "size", "doc_id") for n, f in (("low", F.min), ("high", F.max))]).collect()
    # files whose statistics admit a value; without clustering each would admit nearly all (a file has 18 rows)
    admitted = {c: sum(r[f"low_{c}"] <= v <= r[f"high_{c}"] for r in ends) / len(ends) for c, v in (("lang", "en"), ("source", "s3"), ("size", 2500), ("doc_id", 700))}
    assert len(ends) == 128 and all(v < 0.75 for v in admitted.values()) and sum(admitted.values()) < 2, admitted


def test_many_distinct_sources_are_ranked_alike(spark):
    rows = [(i, "t", None if i % 50 == 0 else "en", f"host{i % 331}") for i in range(700)]
    names = sorted({r[3] for r in rows})
    cells = {r.source: r.cell for r in sharding._by_rank(documents(spark, rows), "source", "cell", 5).collect()}
    assert cells == {n: i * 32 // len(names) for i, n in enumerate(names)}
    assert {(r.lang, r.cell) for r in sharding._by_rank(documents(spark, rows), "lang", "cell", 5).collect()} == {("en", 0), (None, 16)}


# --- language identification -----------------------------------------------------


def make_labelled(spark, n=240):
    rng = np.random.default_rng(3)
    stems = {"en": ["the", "shing", "tion", "wh", "ough"], "de": ["sch", "ung", "ein", "ß", "ö"], "fr": ["eau", "é", "que", "ç", "oi"]}
    word = lambda g: "".join(rng.choice(stems[g], rng.integers(1, 4)))
    rows = [(i, " ".join(word(g) for _ in range(int(rng.integers(3, 30)))) + ".", g, "s") for i in range(n) for g in [list(stems)[i % 3]]]
    return documents(spark, rows)


def test_language_held_out_accuracy(spark):
    docs = make_labelled(spark)
    model = langid.train(docs, common.crc_mod("doc_id", 4) != 2)
    rows = langid.identify(docs.withColumn("held", common.crc_mod("doc_id", 4) == 2), model).select("row.lang", "row.held", "language.*").collect()
    held = [r for r in rows if r.held]
    assert held and np.mean([r.lang == r.lang_pred for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows) and np.mean([r.rejected for r in rows]) < 0.02


def test_language_edges(spark, odd, empty):
    model = langid.train(make_labelled(spark), F.lit(True))
    rows = langid.identify(odd, model).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        text = r.row.text
        letters = any(c.isalpha() for c in text or "")
        assert (r.language.lang_pred == "und") == (not letters)
        assert r.row["size"] == "clash" and (letters or r.language.rejected)
    assert langid.identify(empty, model).count() == 0
    assert langid.train(empty, F.lit(True)) is None and langid.train(odd.withColumn("lang", F.lit(None).cast("string")), F.lit(True)) is None
    assert {r.language.lang_pred for r in langid.identify(odd, None).collect()} == {"und"}


@given(st.text(alphabet="aé ß,7\n日", max_size=40), st.integers(1, 4))
@settings(max_examples=60, deadline=None)
def test_subwords_match_plain_code(text, order):
    raw = b" " + text.encode() + b" "
    folded = [b if b >= 128 or chr(b).isalpha() else 32 for b in raw]
    want = []
    for i in range(len(folded) - order + 1):
        run, h = folded[i : i + order], order * 0x01000193
        # a letter at either end, and no edge inside
        if run[0] == run[-1] == 32 or 32 in run[1:-1]:
            continue
        for b, m in zip(run, langid._MULTIPLY, strict=False):
            h = (h ^ b) * m % 2**32
        want.append(1 + (h ^ h >> 15) % 1023)
    got = langid._hashes(np.array(folded, np.uint8), order, 1024)
    assert got[got > 0].tolist() == want
    at, share = langid.histogram(text.encode(), 1024)
    pieces = [x for p in langid.subwords(text.encode(), 1024) for x in p.tolist()]
    assert at.tolist() == sorted(set(pieces)) and share.tolist() == pytest.approx([pieces.count(x) / len(pieces) for x in at.tolist()])


def test_repeated_rows_train_once(spark):
    rows = [(None, "der eine schung", "de", "s")] * 500 + [(i, f"the tion {i}", "en", "s") for i in range(50)]
    model = langid.train(documents(spark, rows), F.lit(True))
    assert model.languages == ["de", "en"]


def test_joined_texts_score_like_single_ones(spark):
    model = langid.train(make_labelled(spark), F.lit(True))
    texts = [b"the shing", b"", b"x", "eau é que".encode(), b"sch ung " * 300_000]
    together, alone = model.logits(texts), np.concatenate([model.logits([t]) for t in texts])
    assert np.allclose(together, alone, atol=1e-5)


@pytest.mark.parametrize("languages", [["en"], ["de", "en"], ["de", "en", "fr"]])
def test_other_languages_are_rejected(spark, languages):
    model = langid.train(make_labelled(spark), F.col("lang").isin(languages))
    other = ["9f8e a7c3 f00d bd21 c0ffee e4b9 77ab fdd2 0cbe ee3f", "这是一篇用另一种语言写的文章，内容很长。", "зто другой язык и слова другие", "qxzzq kkvkx vvjjq zzkqx jjxkv qkvxz zxzxk"]
    rows = langid.identify(documents(spark, [(i, t, None, "s") for i, t in enumerate(other)]), model).collect()
    assert [r.language.rejected for r in rows] == [True] * len(other)
    own = langid.identify(make_labelled(spark).filter(F.col("lang").isin(languages)), model).collect()
    assert np.mean([r.language.rejected for r in own]) < 0.02


# --- quality ---------------------------------------------------------------------------


def brute_quality(text):
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    covered = {j for i, g in enumerate(grams) if seen[g] > 1 for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


REPEATS = [(20, "a b c d e f a b c d e g h " * 3 + "end of text here now.", "en", "a"), (21, "same line here.\nsame line here.\nother line.", "en", "a"), (22, "a a a a a a", "en", "a"), (23, "nav | home | about | us | more | x", "en", "a"), (24, "Good first sentence of a text that goes on for a while.\nthe### end&&& of%%% it***", "en", "a")]


def test_quality_counts(spark, odd, empty):
    docs = odd.unionByName(documents(spark, REPEATS))
    rows = quality.assess(docs).collect()
    assert len(rows) == len(ODD) + len(REPEATS)
    for r in rows:
        q = r.quality
        want = brute_quality(r.row.text or "")
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == want
        assert q.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (q.base_failed and q.kept)
    kept = {r.doc_id: r for r in quality.keep(documents(spark, REPEATS)).collect()}
    assert set(kept) == {24} and kept[24].text == "Good first sentence of a text that goes on for a while." and kept[24].n_chars == len(kept[24].text)
    assert quality.keep(docs).columns == docs.columns and quality.assess(empty).count() == 0


def test_lines_of_other_scripts_and_languages(spark):
    sentences = "吾輩は猫である。\n名前はまだ無い。\nどこで生れたか。\n頓と見当がつかぬ。\n" * 3
    pages = [(1, sentences, "ja", "a"), (2, "यह एक वाक्य है।\nدا جملة كاملة؟\n" * 4, "hi", "a"), (3, "吾輩は猫であると言ったのは誰か分からない\n" * 12, "ja", "a"), (4, "Ein Satz mit vielen guten Worten hier steht.\nAlle Rechte vorbehalten. TOUS DROITS RÉSERVÉS.", "de", "a")]
    rows = {r.row.doc_id: r.quality for r in quality.assess(documents(spark, pages)).collect()}
    assert all(rows[i].left == 1.0 for i in (1, 2, 3))
    assert rows[4].cleaned == "Ein Satz mit vielen guten Worten hier steht."


# --- language-model scores ---------------------------------------------------------------


def opened(spark, train):
    """The model that texts of every context meet."""
    import pyarrow as pa

    counts = [(None, int(k), 1) for t in train for k in lm.keys(t)]
    rows = lm.nodes(lm.trie(spark.createDataFrame(counts, "word binary, key long, n long"))).toArrow()
    return lm.Model(pa.StructArray.from_arrays([c.combine_chunks() for c in rows.columns], names=rows.column_names))


@pytest.mark.parametrize("train", [[b"abracadabra, the theatre. " * 4, "дом, домой".encode(), b""], [bytes(range(256)) * 2], [b"\x00", bytes(range(255, -1, -1))]])
def test_ppm_probabilities(spark, train):
    model = opened(spark, train)
    for context in (b"    ", b"abra", b"heat", b"zzra", b"zzzz", "до".encode(), b"\x00\x01\x02\x03", b"a\xff\x00\x01", b"\xff\xfe\xfd\xfc"):
        node = lm.LONG << lm.NODE_BITS | int.from_bytes(context)
        p = model.scores(node << lm.SYMBOL_BITS | np.arange(lm.SYMBOLS))
        assert (10.0**p).sum() == pytest.approx(1, abs=1e-4)
    for text in (b"abracadabra", b"the theatre of zebras", "дома, дом".encode(), bytes(range(0, 256, 3)), b""):
        assert model.scores(lm.keys(text)).sum() == pytest.approx(brute_ppm(train, text), rel=1e-4)


def test_lm_keys_go_on_over_slices():
    text = b"the cat sat on a mat, " * 300_000
    assert len(list(lm._keys_of(text))) > 1 and np.array_equal(np.concatenate(list(lm._keys_of(text))), lm.keys(text))
    assert lm.keys(b"").tolist() == [(lm.LONG << 32 | int.from_bytes(b"    ")) << lm.SYMBOL_BITS | lm.END]


def brute_ppm(train, text):
    """PPM with escape shares by distinct symbols and exclusion, symbol by symbol."""
    from collections import Counter, defaultdict

    tries = [defaultdict(Counter) for _ in range(5)]

    def walk(t):
        hist = list(b"    ")
        for b in [*t, lm.END]:
            yield [tuple(hist[4 - k :]) for k in range(5)], b
            hist = [*hist[1:], b]

    for t in train:
        for h, b in walk(t):
            for k in range(5):
                tries[k][h[k]][b] += 1
    total = 0.0
    for h, b in walk(text):
        p, out = 1.0, set()
        for k in (4, 3, 2, 1, 0):
            left = {s: n for s, n in tries[k][h[k]].items() if s not in out}
            if not left:
                continue
            n, kinds = sum(left.values()), len(left)
            kinds = 0 if len(left) + len(out) == lm.SYMBOLS else kinds
            if b in left:
                p *= left[b] / (n + kinds)
                break
            p *= kinds / (n + kinds)
            out |= set(left)
        else:
            p *= 1 / (lm.SYMBOLS - len(out))
        total += np.log10(p)
    return total


def test_lm_scores(spark, odd, empty):
    import math
    from collections import Counter

    rows = [x for x in ODD if x[0] != 7]
    docs = documents(spark, rows).repartition(2)
    got = lm.score(docs, common.crc_mod("doc_id", 5) == 1).collect()
    held = lambda d: zlib.crc32(str(d if d is not None else "").encode()) % 5 == 1
    low = lambda t: (t or "").encode().lower()
    train = [low(t) for d, t, *_ in rows if not held(d)]
    c = Counter(x for t in train for x in [*t.split(), b""])
    n, v = sum(c.values()), len(c)
    want = []
    for d, t, *_ in rows:
        toks = [*low(t).split(), b""]
        base = sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in toks)
        want.append((str(d), held(d), len(toks), sum(c[x] > 0 for x in toks), n, pytest.approx(base), pytest.approx(brute_ppm(train, low(t)), rel=1e-4)))
    key = lambda r: (r[0], r[2])
    assert sorted([(str(r.doc_id), *tuple(r)[1:]) for r in got], key=key) == sorted(want, key=key)
    assert lm.score(empty, F.lit(False)).count() == 0
    alone = lm.score(docs, F.lit(True)).collect()
    assert len(alone) == len(rows) and all(r.train_tokens == 0 and r.n_known == 0 for r in alone)
    whole = lm.score(odd, F.col("doc_id") < 7).filter("doc_id = 7").first()
    assert whole.n_tokens == 60_002


def test_lm_scores_long_texts_in_pieces(spark, monkeypatch):
    rng = np.random.default_rng(3)
    docs = documents(spark, [(i, " ".join(rng.choice(["the", "cat", "sät", "on", "mats", "1"], int(n))), "en", "a") for i, n in enumerate(rng.integers(0, 400, 25))] + [(90, "x" * 3000, "en", "a")])
    held = common.crc_mod("doc_id", 5) == 1
    whole = sorted(map(tuple, lm.score(docs, held).collect()))
    monkeypatch.setattr(lm, "TEXTS", 200)
    monkeypatch.setattr(lm, "KEYED", 70)
    got = sorted(map(tuple, lm.score(docs, held).collect()))
    assert got == [(*r[:5], pytest.approx(r[5]), pytest.approx(r[6])) for r in whole]


def test_lm_rare_words_meet_their_counts(spark, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 4)
    docs = documents(spark, [(i, f"the cat {i} sat " * 3, "en", "a") for i in range(30)])
    few = {r.doc_id: r.base_score for r in lm.score(docs, common.crc_mod("doc_id", 5) == 1).collect()}
    monkeypatch.setattr(lm, "HEAD", 1 << 20)
    assert few == {r.doc_id: pytest.approx(r.base_score) for r in lm.score(docs, common.crc_mod("doc_id", 5) == 1).collect()}


# --- token counts ---------------------------------------------------------------------------


def brute_count(scores, unknown, longest, word):
    best = [(0.0, 0)] + [None] * len(word)
    for i in range(1, len(word) + 1):
        options = []
        for j in range(max(0, i - longest), i):
            s = scores.get(word[j:i], unknown if i - j == 1 else None)
            if s is not None:
                options.append((best[j][0] + s, best[j][1] + 1))
        top = max(o[0] for o in options)
        best[i] = min((o for o in options if o[0] > top - 1e-9), key=lambda o: o[1])
    return best[-1][1]


@given(st.lists(st.text("abc▁é", max_size=9), max_size=30))
@settings(max_examples=60, deadline=None)
def test_trie_counts_match_plain_dynamic_programming(words):
    scores = {"a": -1.0, "b": -2.0, "ab": -2.5, "abc": -3.5, "ca": -2.0, "bca": -3.0, "▁": -1.0, "▁a": -1.5, "é": -4.0}
    u = tokencount.Unigram(scores)
    assert u.counts(words).tolist() == [brute_count(scores, u.unknown, u.longest, w) for w in words]


def brute_scores(texts):
    """Log-probabilities of the vocabulary's pieces from the tokenizer's own split of every word."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokencount.default_path())
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    n = dict.fromkeys((p for p in pieces if not re.fullmatch(r"<0x[0-9A-F]{2}>|<\w+>|</\w+>", p)), 0)
    for text in texts:
        for word in WORD.findall(text or ""):
            for at in range(0, len(word), tokencount.LONGEST_SPLIT):
                for i in model.encode(word[at : at + tokencount.LONGEST_SPLIT]):
                    if pieces[i] in n:
                        n[pieces[i]] += 1
    total = sum(n.values()) + 0.5 * len(n)
    return {p: float(np.log((c + 0.5) / total)) for p, c in n.items()}


def test_token_counts(spark, odd, empty):
    scores = tokencount.learned_scores(odd)
    assert scores == {p: pytest.approx(v) for p, v in brute_scores([t for _, t, *_ in ODD]).items()}
    u = tokencount.Unigram(scores)
    rows = tokencount.count_tokens(odd).collect()
    want = [(str(d), len(ws), sum(brute_count(scores, u.unknown, u.longest, "▁" + w) for w in ws)) for d, t, *_ in ODD if d != 7 for ws in [WORD.findall(t or "")]]
    assert sorted((str(r.doc_id), r.n_pretokens, r.n_tokens) for r in rows if r.doc_id != 7) == sorted(want)
    assert next(r.n_pretokens for r in rows if r.doc_id == 7) == 60_001
    assert tokencount.count_tokens(empty).count() == 0


# --- near duplicates ---------------------------------------------------------------------------


def brute_components(codes, ids, most):
    root = list(range(len(codes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if int(codes[i] ^ codes[j]).bit_count() <= most:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    best = {}
    for i in range(len(codes)):
        if ids[i] is not None:
            best[find(i)] = min(best.get(find(i), ids[i]), ids[i])
    return [best.get(find(i)) for i in range(len(codes))]


def brute_fingerprint(text, k=4):
    import xxhash

    w = text.encode().lower().split()
    grams = [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_near_duplicates(spark, odd, empty):
    rng = np.random.default_rng(5)
    base = [f"w{rng.integers(500)}" for _ in range(200)]
    more = [(100 + i, " ".join(base[:k] + ["new"] + base[k + 1 :]), "en", "a") for i, k in enumerate(rng.integers(0, 200, 40).tolist())]
    rows = [x for x in ODD if x[0] != 7] + more + [(i, f"{i} unlike {i * 7} others {i * 13} at all", "en", "a") for i in range(200, 240)]
    got = simhash.near_duplicates(documents(spark, rows).repartition(3)).collect()
    codes = np.array([brute_fingerprint(t or "") for _, t, *_ in rows], np.uint64)
    want = brute_components(codes, [x[0] for x in rows], 4)
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == sorted((str(x[0]), f"{int(c):016x}", str(w)) for x, c, w in zip(rows, codes, want, strict=True))
    assert simhash.near_duplicates(empty).count() == 0
    whole = simhash.fingerprint(LONG.encode())
    assert int(whole[0]) == brute_fingerprint(LONG)


def test_large_groups_lose_no_link(spark):
    rng = np.random.default_rng(9)
    centre = rng.integers(0, 2**63, 6, dtype=np.int64)
    codes = np.unique(np.concatenate([c ^ (np.int64(1) << rng.integers(0, 63, (120, 3))).sum(axis=1) for c in centre]))
    frame = spark.createDataFrame([(int(c),) for c in codes], "code long")
    plain = brute_components(codes.view(np.uint64), codes.tolist(), 4)
    for fragment, agree in ((10, 1), (1 << 14, None), (10, 2), (1 << 14, 3)):
        links = simhash.components(simhash.near_links(frame, 4, fragment=fragment, agree=agree)).collect()
        root = {r.x: r.y for r in links}
        assert [root.get(c, c) for c in codes.tolist()] == plain


def test_more_blocks_agree_as_codes_grow():
    assert [simhash.blocks_that_agree(n, 4) for n in (0, 10**6, 10**10, 10**13)] == [1, 1, 2, 3]
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, 300, dtype=np.uint64).reshape(-1, 1)
    b = a ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (300, 4)).astype(np.uint64), axis=1).reshape(-1, 1)
    for agree in (1, 2, 3):
        assert (simhash.block_routes(a, 4, agree) == simhash.block_routes(b, 4, agree)).any(axis=1).all()


def test_distinct_documents(spark, odd, empty):
    rng = np.random.default_rng(4)
    words = [f"v{i}" for i in range(3000)]
    rows = []
    for g in range(12):
        base = rng.choice(words, 150).tolist()
        for i in range(4):
            copy = list(base)
            copy[int(rng.integers(150))] = "changed"
            rows.append((g * 10 + i, " ".join(copy), "en", "a"))
    docs = documents(spark, rows)
    kept = simhash.distinct_documents(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [g * 10 for g in range(12)]
    assert simhash.distinct_documents(empty).count() == 0
    # equal rows, and the texts without words, leave one each
    assert simhash.distinct_documents(odd).count() == len(ODD) - 3


def partial_copies(rng, changed, words=150):
    """Pairs of texts of ``words`` different words, the second with its last few words changed: similarity (words - 4 - c) / (words - 4 + c)."""
    rows = []
    for g, c in enumerate(changed):
        base = [f"{g}x{w}" for w in rng.integers(0, 1 << 40, words)]
        rows += [(2 * g, " ".join(base), "en", "a"), (2 * g + 1, " ".join(base[: words - c] + [f"new{g}x{i}" for i in range(c)]), "en", "a")]
    return rows


def brute_kept(rows, limit=0.8):
    """doc_ids that stay if texts of a five-word-shingle similarity of ``limit`` or more are linked."""
    sets = []
    for _, t, *_ in rows:
        w = t.lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)})
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) >= limit * len(a | b):
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    best = {}
    for (d, *_), r in zip(rows, root, strict=True):
        best[r] = min(best.get(r, d), d)
    return sorted(best.values())


def test_only_similar_documents_are_dropped(spark):
    rng = np.random.default_rng(8)
    # similarities of 0.65 to 0.95, and a chain whose neighbours are similar but whose ends aren't
    rows = partial_copies(rng, [c for c in range(4, 32) for _ in range(3)])
    base = rows[0][1].split()
    rows += [(1000 + i, " ".join(["c"] + base[: 149 - 7 * i] + [f"chain{j}" for j in range(7 * i)]), "en", "a") for i in range(4)]
    want = brute_kept(rows)
    assert 100 < len(want) < len(rows)
    for limit in ({}, {"fragment": 3}):
        assert sorted(r.doc_id for r in simhash.distinct_documents(documents(spark, rows), **limit).collect()) == want


def test_no_pair_of_similar_documents_is_lost(spark):
    # groups of two just above the limit, so that no third copy makes up for a miss
    rows = partial_copies(np.random.default_rng(12), [16] * 200) + [(1000 + d, t, g, s) for d, t, g, s in partial_copies(np.random.default_rng(13), [2] * 100, 24)]
    kept = simhash.distinct_documents(documents(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == [2 * i for i in range(200)] + [1000 + 2 * i for i in range(100)]


def test_large_groups_of_near_copies_lose_no_link(spark, monkeypatch):
    # clusters of copies that share a passage with each other and with single documents, and steps from one cluster to the next
    rng = np.random.default_rng(17)
    word = lambda n: [f"q{w}" for w in rng.integers(0, 1 << 40, n)]
    shared, rows = word(60), []
    for g in range(3):
        base = shared + word(40)
        rows += [(len(rows) + i, " ".join(base[:99] + word(1)), "en", "a") for i in range(25)]
        step = base
        for _ in range(3):
            step = step[: -9 * (_ + 1)] + word(9 * (_ + 1))
            rows.append((len(rows), " ".join(step), "en", "a"))
    rows += [(len(rows) + i, " ".join(shared + word(int(n))), "en", "a") for i, n in enumerate(rng.integers(5, 60, 30))]
    want = brute_kept(rows)
    assert 20 < len(want) < 60
    monkeypatch.setattr(jaccard, "SHARED", 5)
    for fragment in (4, 1 << 14):
        monkeypatch.setattr(jaccard, "CELL", 1500 if fragment == 4 else 1 << 20)
        assert sorted(r.doc_id for r in simhash.distinct_documents(documents(spark, rows).repartition(3), fragment).collect()) == want


@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), min_size=1, max_size=30))
@settings(max_examples=5, deadline=None)
def test_components(spark, links):
    from tributary.llm.components import components

    got = {r.x: r.y for r in components(spark.createDataFrame(links, "x long, y long")).collect()}
    root = {i: i for i in range(26)}
    for _ in range(26):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert {i: got.get(i, i) for i in range(26)} == root


# --- stages ---------------------------------------------------------------------------------------


def test_language_stage_without_labels_is_an_error(spark, odd):
    with pytest.raises(ValueError, match="no document"):
        stages.identify_language(odd.withColumn("lang", F.lit(None).cast("string")))


def test_stages_handle_odd_and_empty_tables(spark, odd, empty):
    for docs in (odd, empty):
        for stage in (stages.identify_language, stages.apply_quality, stages.drop_near_copies, stages.mix_to_targets):
            out = stage(docs)
            assert out.columns == docs.columns
            assert out.count() <= 3 * len(ODD)
        assert stages.pack_sequences(docs).count() >= 0
