"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pairlab.llm import (
    bpe, decontaminate, fm_dedup, html, minhash, quality, sharding, suffix_dedup, token_counts, topk_search,
)

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, id long, h string, row string, key string, spans string, score double, place int"
RANDOM = random.Random(5)
VOCABULARY = ["".join(RANDOM.choice("abcdeéñ") for _ in range(RANDOM.randint(1, 7))) for _ in range(300)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


PASSAGE = prose(60, 99)
TEXTS = [
    (0, prose(120, 0)), (1, prose(120, 0)), (2, prose(118, 0) + " x y"), (3, None), (4, ""), (5, "one"), (6, "one"),
    (7, prose(40, 7) + " " + PASSAGE + " " + prose(40, 8)), (8, prose(30, 9) + "\n" + PASSAGE), (9, PASSAGE + PASSAGE),
    (10, "Ein " * 400), (11, prose(20_000, 11)), (12, "Σ İ ﬁ <|endoftext|> 's 日本 😀   \x1c"), (13, "  \n\t "),
    (14, prose(120, 0)), (None, "one two three"), (None, None), (15, "a" * 5_000), (16, prose(30, 1)),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 1, "h", "r", "k", "s", 0.5, 3) for i, t in TEXTS], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect() if r.doc_id is not None}


def brute_components(rows, width, percent=80):
    lower = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in rows:
        w = (t or "").encode().translate(lower).split()
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
    root = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                same = len(sets[a] & sets[b])
                if sets[a] and sets[b] and 100 * same >= percent * len(sets[a] | sets[b]) and root[a] > root[b]:
                    root[a] = root[b]
                    changed = True
    return {i: (len(sets[i]), root[i], root[i] == i) for i in sets}


def test_minhash(docs, nothing):
    got = minhash.near_duplicates(docs, width=4)
    assert got.count() == len(TEXTS)
    assert by_id(got, "n_shingles", "component_id", "kept") == brute_components([r for r in TEXTS if r[0] is not None], 4)
    assert minhash.near_duplicates(nothing).count() == 0


def test_quality_training_rows_reach_the_driver_packed(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"some words {k}") for k in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(20)], "doc_id long, quality int")
    kinds, inner = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda df, work, schema, *a, **k: kinds.append(str(schema)) or inner(df, work, schema, *a, **k))
    model = quality.train(docs, labels)
    assert any("features binary" in k for k in kinds) and not any("array" in k for k in kinds)
    assert model.mean.dtype == float and model.mean.any()


def test_minhash_moves_sets_once_and_lone_shingles_never(spark):
    rows = [(k, f"w{k} w{k}a w{k}b w{k}c shared shared2 shared3 shared4 w{k}d") for k in range(40)]
    docs = spark.createDataFrame([*rows, *((k + 100, text) for k, text in rows)], "doc_id long, text string")
    signed = minhash._sets(docs, "doc_id", "text", 4)
    wanted = signed.groupBy("key").agg(F.min("id").alias("least"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sets = minhash._sets_of(docs, "doc_id", "text", wanted, 4)
        # One exchange of the wanted keys, one of the sets.
        assert sets._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
        assert sets.count() == 40
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sets = minhash.stored(sets, "sets")
    every = np.full(1 << 18, ~np.uint64(0))
    common = sets.select(F.explode("items").alias("item")).groupBy("item").count().where("count > 1")
    assert common.count() == 1
    held = minhash._held(sets, every, minhash.sized_filter(minhash.stored(common, "common"), "item"))
    # By chance a lone shingle may pass.
    assert [r.n for r in held.collect()] == [6] * 40 and held.select(F.sum(F.size("items"))).first()[0] < 45
    rare = minhash._rare_shingles(wanted.select("key"), sets, 10)
    assert rare.select("n", "at", "alone").distinct().collect() == [(6, 5, 5)] and rare.count() == 40
    assert minhash._rare_shingles(wanted.select("key"), sets, 80).count() == 0


def test_minhash_chains_and_near_misses(spark):
    base, rows = prose(60, 50).split(), []
    for i in range(60):
        words = list(base)
        for k in range(RANDOM.randint(0, 5)):
            words[RANDOM.randrange(60)] = f"n{i}{k}"
        rows.append((i, " ".join(words)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=4)
    assert by_id(got, "n_shingles", "component_id", "kept") == brute_components(rows, 4)


def test_sharding(docs, nothing):
    rows = sharding.assign_shards(docs.unionAll(docs), 4).collect()
    assert len(rows) == 2 * len(TEXTS) and {r.law for r in rows} == {"rows"}
    sizes = [sorted(r.slot for r in rows if r.shard == s) for s in range(4)]
    assert all(s == list(range(len(s))) for s in sizes) and max(map(len, sizes)) - min(map(len, sizes)) <= 1
    texts = dict(TEXTS)
    for r in rows:
        if r.doc_id is not None:
            raw = (texts[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    again = sharding.assign_shards(docs.unionAll(docs).repartition(3), 4).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert sharding.assign_shards(nothing, 4).count() == 0


def test_ring_moves_little():
    """Keys go to the next node clockwise unless it is full: with loads levelled by one, most stay with their owner."""
    nodes = sharding.ring(8)
    counts = {arc: 100 for arc in range(len(nodes))}
    flows = sharding.flows(nodes, counts, 8)
    assert sum(end - first for _, first, end, _, _ in flows) == 100 * len(nodes)
    assert sum(end - first for arc, first, end, s, _ in flows if s == nodes[arc][1]) == 100 * len(nodes)


def test_token_counts(docs, nothing):
    library = Tokenizer.from_file(BYTE)
    want = {i: (len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512)
            for i, t in TEXTS if i is not None}
    got = token_counts.token_counts(docs, BYTE, budgets=(0, 3, 10**6))
    assert got.count() == len(TEXTS) and by_id(got, "n_bytes", "n_tokens", "over_limit") == want
    assert token_counts.token_counts(nothing, BYTE).count() == 0


def test_counts_at_every_prefix():
    library, made = Tokenizer.from_file(BYTE), token_counts.counter(BYTE)
    for word in [" thonshanerth", "aaaaaaaaaaaaaa", "été", "straßenbahn", " 12345678"]:
        counts = made.prefixes(word.encode())
        width = 0
        for k, c in enumerate(word):
            width += len(c.encode())
            assert counts[width] == len(library.encode(word[: k + 1], add_special_tokens=False).ids) or " " in word[: k + 1][-1:]
    text = "the cat sat on the mat, again and again"
    for budget, n in zip((0, 1, 4, 99), made.fitting_prefix(text, [0, 1, 4, 99]), strict=True):
        assert made.count(text[:n]) <= budget
        assert n == len(text) or made.count(text[: n + 1]) > budget


def test_random_texts_match_the_libraries():
    parts = ["a", "E", "t", " ", "  ", "\n", "'S", "'re", "é", "日", "😀", "1", ".", "!!", "<|endoftext|>", "\u0085", "\x1c", "th",
             "ing", " the", "İ", "　", "Σ", "é", "​", "ﬁ"]
    one, two = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)
    counter, codec = token_counts.counter(BYTE), bpe.codec(WORD)
    for _ in range(3_000):
        text = "".join(RANDOM.choice(parts) for _ in range(RANDOM.randint(0, 20)))
        assert counter.count(text) == len(one.encode(text, add_special_tokens=False).ids), repr(text)
        ids, decoded = codec.encode_chunks(text)
        want = two.encode(text, add_special_tokens=False).ids
        assert ids == struct.pack(f"<{len(want)}I", *want), repr(text)
        assert decoded.decode() == two.decode(want, skip_special_tokens=False)


def test_bpe(docs, nothing):
    library = Tokenizer.from_file(WORD)
    want = {}
    for i, t in TEXTS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[i] = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
    del want[None]
    assert by_id(bpe.digest(docs, WORD), "n_tokens", "ids_sha256", "decoded_sha256") == want
    encoded = bpe.encode(docs, WORD)
    assert by_id(bpe.decode(encoded, WORD), "decoded") == by_id(encoded, "decoded")
    assert bpe.digest(nothing, WORD).count() == bpe.encode(nothing, WORD).count() == 0


def brute_removed(rows, width, split):
    seen, out = set(), {}
    for i, t in sorted(rows):
        items = split(t or "")
        hit = [False] * len(items)
        for k in range(len(items) - width + 1):
            window = tuple(items[k:k + width])
            if window in seen:
                hit[k:k + width] = [True] * width
            seen.add(window)
        out[i] = (items, hit)
    return out


def test_repeated_bytes(docs, nothing):
    got = by_id(suffix_dedup.digest(docs, width=100), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    for i, (raw, hit) in brute_removed([r for r in TEXTS if r[0] is not None], 100, lambda t: t.encode()).items():
        kept = bytes(b for b, h in zip(raw, hit) if not h)
        spans = sum(h and (k == 0 or not hit[k - 1]) for k, h in enumerate(hit))
        assert got[i] == (len(raw), sum(hit), spans, hashlib.sha256(kept).hexdigest()), i
    assert suffix_dedup.digest(docs).count() == len(TEXTS) and suffix_dedup.digest(nothing).count() == 0


def test_texts_without_repeats_keep_rows_and_characters(docs):
    got = suffix_dedup.without_repeats(docs, width=100)
    assert got.columns == docs.columns and got.count() == len(TEXTS)
    texts = by_id(got, "text")
    assert texts[3] == (None,) and texts[1] == ("",) and texts[0] == (dict(TEXTS)[0],)
    assert suffix_dedup.kept_text("aéb", [(0, 2)]) == "éb" and suffix_dedup.kept_text("aéb", [(0, 3)]) == "b"


def test_repeated_words(docs, nothing):
    got = by_id(fm_dedup.digest(docs, window=20), "n_words", "n_removed", "kept_sha256")
    for i, (words, hit) in brute_removed([r for r in TEXTS if r[0] is not None], 20, lambda t: t.encode().split()).items():
        kept = b" ".join(w for w, h in zip(words, hit) if not h)
        assert got[i] == (len(words), sum(hit), hashlib.sha256(kept).hexdigest()), i
    assert fm_dedup.digest(docs).count() == len(TEXTS) and fm_dedup.digest(nothing).count() == 0


def test_one_id_with_several_texts(spark):
    df = spark.createDataFrame([(1, PASSAGE), (1, PASSAGE + " more"), (1, PASSAGE), (2, "x " + PASSAGE)], "doc_id long, text string")
    assert fm_dedup.digest(df).count() == suffix_dedup.digest(df).count() == 4


def test_top_products(spark):
    r = random.Random(2)
    rows = [(i, [r.choice([-1.0, -0.25, 0.0, 0.5, 1.0]) for _ in range(4)], "c") for i in range(230)]
    rows += [(300, None, "c"), (301, [1.0, None, 0.0, 0.0], "c"), (302, [float("nan")] * 4, "c"), (303, [float("inf")] * 4, "c"),
             (None, [1.0] * 4, "c"), (400, [1.0, 1.0], "c"), (400, [1.0, 1.0], "c"), (500, [], "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell string")
    good = {i: v + [0.0] * (4 - len(v)) for i, v, _ in rows if i is not None and v is not None and i not in (301, 302, 303)}
    want = set()
    for q in (i for i in good if i % 100 == 0):
        ranked = sorted((-sum(int(1024 * a // 1) * int(1024 * b // 1) for a, b in zip(good[q], good[i])), i) for i in good if i != q)
        want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(ranked[:10])}
    assert {tuple(x) for x in topk_search.top_products(df, pivots=5).collect()} == want
    assert topk_search.top_products(df.limit(0)).count() == 0
    assert topk_search.top_products(df.where("vec_id IN (0, 1)")).count() == 1


def test_decontamination(spark, nothing):
    item = "A train left Berlin at 7 with 120 people and reached Paris after 9 hours of slow and careful travel in the rain"
    changed = item.replace("Berlin", "Madrid").replace("120", "77").replace("7 with", "8 with").replace("Paris", "Lisbon")
    mixed = "some words before. " + changed + " and some after"
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "too short"), (None, item), (5, prose(30, 70))],
                                  "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, mixed, 0), (2, prose(200, 71), 0), (3, None, 0), (4, "", 0), (5, item, 0), (5, item, 0), (None, item, 0),
         (6, prose(20, 1) + " " + prose(30, 70) + " " + prose(9, 2), 0), (7, "12 13 14 15 16 17 18 19 20 21 22 23", 0)],
        "doc_id long, text string, item_id int")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {(1, 1), (5, 1), (6, 5)}
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.contaminated(nothing, items).count() == 0


def test_html(spark):
    page = """<html><head><title>t</title><style>p{}</style></head><body><nav><a href=/>Menu</a></nav>
    <div class="cookie-notice">We use cookies</div><header>Site</header><article><h1>Title</h1><p>One &amp; two,
      three&nbsp;four <b>bold</b>.<p>Second &lt;par&gt;, with text that is long enough to count as a paragraph of its own.
    <div class="ad">Buy</div><ul><li>first<li>second</ul><form><input>No</form></article>
    <aside>Side</aside><div id="comments"><p>A comment, a long one, by a reader, who has much to say, on everything.</p></div>
    <footer>&copy;</footer><script>var a="</p>";</script>"""
    assert html.main_text(page).split("\n") == [
        "Title", "One & two, three four bold.",
        "Second <par>, with text that is long enough to count as a paragraph of its own.", "first", "second",
    ]
    plain = "<div id=menu><a href=x>a</a><a href=y>b</a></div><div><p>" + "Words, more words. " * 20 + "</p><p>" + "Other, words. " * 20 + "</div>"
    assert [len(x) for x in html.main_text(plain).split("\n")] == [379, 279]
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", page, "x"), (3, "u", "<p", "x"), (3, "u", "<div>" * 5_000, "x")]
    got = html.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert got.columns == ["page_id", "url", "text", "n_chars"] and sorted(r.n_chars for r in got.collect())[:4] == [0, 0, 0, 0]
    assert html.extract_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_quality(spark, docs, nothing):
    rows = [(i, prose(60, i) if i % 3 else " ".join(w + "###" for w in prose(60, i).split()), int(i % 3 > 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    labels = df.select("doc_id", "quality").unionAll(spark.createDataFrame([(None, 1), (9_999, 0), (3, None)], "doc_id long, quality int"))
    got = quality.classify(df, labels).collect()
    truth = {i: q for i, _, q in rows}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    odd = quality.classify(docs, labels).collect()
    assert len(odd) == len(TEXTS) and all(0 <= r.score <= 1 for r in odd)
    assert quality.classify(nothing, labels).count() == 0
    assert quality.classify(docs, labels.limit(0)).count() == len(TEXTS)


def test_held_out_labels_are_not_read(spark):
    """Other labels on held-out rows change no score."""
    df = spark.createDataFrame([(i, prose(30, i)) for i in range(120)], "doc_id long, text string")
    labels = df.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    turned = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted((r.doc_id, r.score) for r in quality.classify(df, x).collect()) for x in (labels, turned))
    assert a == b
