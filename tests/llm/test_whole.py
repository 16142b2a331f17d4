"""Cases in which an operator once did less than the whole job."""

import random
import time

import numpy as np
import pytest

import corpus_pipeline
from pairlab.llm import decontaminate, fm_dedup, html, passages, sharding, suffix_dedup, topk_search

ITEM = "a farmer in the valley sold 12 baskets of ripe apples to every visitor and 5 crates of plums to the old mill"


def held(spark, docs, items):
    made = [spark.createDataFrame(list(enumerate(t)), f"{i} long, text string") for t, i in ((docs, "doc_id"), (items, "item_id"))]
    return {(r.doc_id, r.item_id) for r in decontaminate.contaminated(*made).collect()}


def test_variants_of_a_held_item_hide_nothing(spark):
    """An item beside its twin with other numbers, also twice in one document, and an item whose own windows repeat."""
    twin, other = ITEM.replace("12", "31").replace("5", "9"), ITEM.replace("12", "77").replace("5", "78")
    years = " ".join(f"in {y} the price of one loaf of dark bread was {p} cents in the city." for y, p in ((2001, 5), (2002, 6)))
    docs = [f"{ITEM}. {twin}", f"{twin} {other}", years, f"so it was: {years} and {years.replace('6', '8')}"]
    assert held(spark, docs, [ITEM, years]) == {(0, 0), (1, 0), (2, 1), (3, 1)}


def test_items_of_numbers_names_and_few_words(spark):
    sums = "12 + 7 = 19 and 30 - 4 = 26 and 5 * 5 = 25"
    table = "Berlin 3 km 40 kg Paris 4 km 55 kg Rome 6 km 70 kg Vienna 9 km 12 kg"
    asked = "Tom buys {} red apples. Tom eats {} of them. How many of the red apples does Tom have left?"
    items = [sums, table, asked.format(9, 2), "blue velvet umbrella"]
    docs = [f"see {sums} there", f"as in this list: {table}", asked.format(7, 3).replace("Tom", "Anna"),
            "a blue velvet umbrella stood there", "a blue umbrella of velvet, 12 + 8 = 20, Berlin 4 km 41 kg Paris 5 km"]
    assert held(spark, docs, items) == {(0, 0), (1, 1), (2, 2), (3, 3)}


def test_passages_and_items_that_repeat_themselves(spark):
    long = ITEM + " " + " ".join(f"word{k} follows word{k + 1} in the list" for k in range(10))
    line = "the ferry to the far island leaves once a day at dawn. "
    words = long.split()
    docs = ["so " + " ".join(words[5:35]) + " end", "so " + " ".join(words[5:17]) + " end", line * 3, "x " + " ".join(words[3:16]) + " y"]
    assert held(spark, docs, [long, line * 3]) == {(0, 0), (2, 1), (3, 0)}


@pytest.mark.parametrize("digest", [suffix_dedup.digest, fm_dedup.digest])
def test_texts_of_one_id_are_told_apart_without_the_filter(spark, monkeypatch, digest):
    """Filters that let all pass change nothing: each text is cut at its own places only."""
    fill = [" ".join(f"w{s}n{k}" for k in range(40)) for s in range(5)]
    rows = [(1, f"{fill[0]} {ITEM} {ITEM}"), (2, f"{fill[1]} {ITEM} {fill[2]}"), (2, f"{ITEM} {fill[3]} {fill[3]}"),
            (2, f"{fill[4]} x {ITEM} {fill[4]}"), (3, f"{fill[2]} y {fill[3]}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, digest(df).collect()))
    monkeypatch.setattr(passages, "sized_filter", lambda *_: np.full(1, 2**64 - 1, np.uint64))
    assert sorted(map(tuple, digest(df).collect())) == want


@pytest.mark.parametrize("digest, symbols", [(suffix_dedup.digest, lambda t: t.encode()), (fm_dedup.digest, lambda t: t.encode().split())])
@pytest.mark.parametrize("hot", [3, 20_000])
def test_one_phrase_in_many_surroundings(spark, monkeypatch, digest, symbols, hot):
    """Pieces around one phrase are cut over many small blocks, or judged window by window where there are too many."""
    from test_small import brute_removed

    monkeypatch.setattr(passages, "HOT", hot)
    monkeypatch.setattr(passages, "BLOCK_BYTES", 2_000)
    draw = random.Random(4)
    word = lambda: "".join(draw.choices("abcdefgh", k=draw.choice((3, 5, 8))))
    phrase, tails = " ".join(word() for _ in range(14)), [" ".join(word() for _ in range(12)) for _ in range(3)]
    rows = []
    for k in range(80):
        filler = [word() for _ in range(draw.choice((0, 2, 30)))]
        rows.append((k, " ".join([*filler, phrase, draw.choice(tails), *filler[:3], phrase if k % 7 == 0 else "", word()])))
    width = 100 if digest is suffix_dedup.digest else 20
    want = {i: sum(hit) for i, (_, hit) in brute_removed(rows, width, symbols).items()}
    got = digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: r.n_removed for r in got} == want and sum(want.values())


def test_a_long_text_takes_time_in_proportion(spark):
    """Two nearly equal texts of 1 and of 4 MB."""
    seconds = []
    for size in (1 << 20, 4 << 20):
        raw = np.random.default_rng(size).integers(97, 123, size, dtype=np.uint8)
        other = raw.copy()
        other[:: 1 << 14] = 48
        rows = [(k, t.tobytes().decode()) for k, t in enumerate((raw, other))]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
        start = time.perf_counter()
        got = {r.doc_id: r for r in suffix_dedup.digest(df).collect()}
        seconds.append(time.perf_counter() - start)
        # All but the changed bytes themselves lies in windows between two of them.
        assert got[0].n_removed == 0 and got[1].n_removed == size - (size >> 14) and got[1].n_spans == size >> 14
    assert seconds[1] < 8 * seconds[0] + 10


def test_near_duplicates_are_told_apart_by_row(spark):
    """Whole repeated rows, different texts under one id, and rows without an id."""
    one, two, three = (" ".join(f"{s}{k}" for k in range(60)) for s in "abc")
    rows = [(1, one), (1, one), (1, one), (2, one + " end"), (2, two), (3, two), (None, three), (None, three), (None, two), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = corpus_pipeline.near_duplicates(spark, df, "")
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, one), (2, two), (None, three), (4, None)], key=str)


@pytest.mark.parametrize("opened", [
    '<div class="content has-sidebar">', '<div class="no-sidebar content-area">', '<div class="post hentry comments-open">',
    '<div class="elementor-widget-text">', '<div class="site-header-fixed page">', "<form>",
    '<div class="site-header-fixed page"><article>', '<div class="with-sidebar social"><form><div class="page-widget">',
])
def test_containers_of_the_article_stay(opened):
    text = ["First words, and more of them. " * 9, "Second words, and more of them. " * 9]
    comments = '<div class="comments"><p>' + "A comment, by a reader. " * 9 + "</p></div>"
    page = "<body><nav><a href=/>Menu</a></nav>" + opened + "".join(f"<p>{t}</p>" for t in text) + comments
    assert html.main_text(page).split("\n") == [t.strip() for t in text]


def test_short_sections_of_the_article_stay():
    long, short = "Long words, and more of them. " * 30, "One short section without much in it. " * 8
    page = f"<body><div><p>{long}</p><p>{long}</p></div><section><p>{short}</p></section><div><p><a href=x>{short}</a></p></div>"
    assert html.main_text(page).split("\n") == [long.strip(), long.strip(), short.strip()]


def test_quotes_count_after_an_equals_sign_only():
    text = ["First words, and more of them. " * 9, "Second words, and more of them. " * 9, "Third words, and more. " * 9]
    for opened in ("<p title=it's>", "<p it's>", "<p title='it\"s' lang=en>", '<p title = "a>b">', "<p/title=x'>", "<p title='never closed>"):
        page = f"<body><p>{text[0]}</p>{opened}{text[1]}</p><p>{text[2]}</p></body>"
        assert html.main_text(page).split("\n") == [t.strip() for t in text], opened


@pytest.mark.parametrize("page", [
    lambda n: "<p title='x>" * n + "words", lambda n: "<p>a</p><p title='x>" + "<p class=y>w</p>" * n,
    lambda n: "<div>" * n + "words, and more words to be counted here. " * 3, lambda n: "<li><div>" * n,
    lambda n: "<p><button>" + "<div>" * n + "<p>x" * n, lambda n: "<a" + " b=" * n + ">", lambda n: "<!-- a" * n,
    lambda n: '<div class="menu">' * n + "<article>words, and more words, to be counted here.",
])
def test_pages_take_time_in_proportion(page):
    """16,000 tags cost about twice what 8,000 do; a quadratic path would make it minutes for 64,000."""
    start = time.perf_counter()
    html.main_text(page(64_000))
    assert time.perf_counter() - start < 20


def test_scores_of_distant_ancestors():
    """One bottom-up sweep gives what adding each paragraph to each of its ancestors gives."""
    draw = random.Random(6)
    page = ""
    for _ in range(60):
        page += draw.choice(["<div>", "<section>", "<div><div>", "</div>", "</section>"]) + f"<p>{'word, ' * draw.randint(1, 60)}</p>"
    root = html.parse(page)
    html.main_node(root)
    want, stack = {}, [root]
    while stack:
        node = stack.pop()
        stack += [c for c in node.children if not isinstance(c, str)]
        if node.name != "p":
            continue
        points = 1 + sum(c.count(",") for c in node.children) + min(node.length / 100, 3)
        at, share = node.parent, 1.0
        for shares in (0.5, 1 / 6, *[None] * 500):
            if at is None:
                break
            want[at] = want.get(at, 0) + points * share
            at, share = at.parent, share * 2 / 3 if shares is None else shares
    assert want and all(node.score == pytest.approx(value) for node, value in want.items())


def brute_products(vectors, k, every):
    out = set()
    for q in (i for i in vectors if i % every == 0):
        ranked = sorted((-sum(a * b for a, b in zip(vectors[q], vectors[i])), i) for i in vectors if i != q)
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(ranked[:k])}
    return out


def test_bounds_leave_out_far_clusters(spark, monkeypatch):
    """On vectors in far clusters each one is copied to few of the groups, and the result is that of all products."""
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 60, (12, 8))
    points = np.floor(centres[np.arange(600) % 12] + rng.normal(0, 1, (600, 8))).astype(int)
    df = spark.createDataFrame([(i, p.astype(float).tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    copies = []
    work = topk_search.map_batches

    def spy(given, *args, **more):
        made = work(given, *args, **more)
        if "group" in made.columns:
            copies.append(made.count())
        return made

    monkeypatch.setattr(topk_search, "map_batches", spy)
    monkeypatch.setattr(topk_search, "DATA_BLOCK", 100)
    got = topk_search.top_products(df, k=5, every=7, scale=1, pivots=12)
    assert {tuple(r) for r in got.collect()} == brute_products({i: p.tolist() for i, p in enumerate(points)}, 5, 7)
    assert 0 < copies[0] < 5 * len(points)


def test_products_beyond_doubles(spark):
    rng = np.random.default_rng(5)
    points = rng.integers(-(2**29), 2**29, (60, 4)).tolist() + [[2**61, 1, 0, 0], [2, 3, 0, 0], [0, 2**31 + 1, 0, 0]]
    vectors = {i: p for i, p in enumerate(points) if i != 60}
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in vectors.items()], "vec_id long, embedding array<double>")
    got = topk_search.top_products(df, k=4, every=3, scale=1)
    assert {tuple(r) for r in got.collect()} == brute_products(vectors, 4, 3)
    alone = spark.createDataFrame([(0, [2.0, 3.0]), (1, [2.0**61, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk_search.top_products(alone, k=1, scale=1).collect()] == [(0, 1, 1, 2**62 + 3)]


@pytest.mark.parametrize("seed", range(6))
def test_full_shards_overflow_clockwise_key_by_key(seed):
    """Loads far from equal: what walking the ring with one key after another gives."""
    draw = random.Random(seed)
    shards = draw.choice((1, 2, 5, 16))
    nodes = sharding.ring(shards, 8)
    counts = {arc: draw.choice((0, 0, 1, 3, 200)) for arc in range(len(nodes))}
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    want, over = {}, []
    for arc in range(len(nodes)):
        for rank in range(counts[arc]):
            shard = nodes[arc][1]
            if room[shard]:
                room[shard] -= 1
                want[arc, rank] = shard
            else:
                over.append((arc, rank))
    for arc, rank in over:
        at = arc
        while not room[nodes[at % len(nodes)][1]]:
            at += 1
        room[nodes[at % len(nodes)][1]] -= 1
        want[arc, rank] = nodes[at % len(nodes)][1]
    made = sharding.flows(nodes, counts, shards)
    assert {(arc, rank): s for arc, first, end, s, _ in made for rank in range(first, end)} == want
    assert shards == 1 or over
    for s in range(shards):
        slots = sorted(slot + k for _, first, end, shard, slot in made if shard == s for k in range(end - first))
        assert slots == list(range(total // shards + (s < total % shards)))


def plainly_held(doc, item):
    """Word by word over all alignments: texts without numbers, names, units and sentence ends."""
    if len(item) >= decontaminate.PASSAGE:
        runs = {tuple(doc[k : k + decontaminate.PASSAGE]) for k in range(len(doc))}
        if any(tuple(item[k : k + decontaminate.PASSAGE]) in runs for k in range(len(item) - decontaminate.PASSAGE + 1)):
            return True
    width = min(decontaminate.WINDOW, len(item))
    n = len(item) - width + 1
    hits = [(a, d) for a in range(n) for d in range(len(doc) - width + 1) if doc[d : d + width] == item[a : a + width]]
    span = 2 * decontaminate.DRIFT
    for group in (lambda away: away, lambda away: away // span, lambda away: (away + decontaminate.DRIFT) // span, lambda away: 0):
        found = {}
        for a, d in hits:
            found.setdefault(group(d - a), set()).add(a)
        if any(len(at) >= decontaminate.COVERAGE * n for at in found.values()):
            return True
    return False


def test_held_items_equal_word_by_word_comparison(spark):
    draw = random.Random(12)
    word = lambda: draw.choice("ab") + draw.choice("cdefgh") * 2 + draw.choice("klmn")
    items = [[word() for _ in range(draw.choice((2, 3, 5, 9, 14, 25, 60)))] for _ in range(40)]
    docs = []
    for k in range(160):
        own = list(draw.choice(items))
        for _ in range(draw.choice((0, 0, 1, 2, 4))):
            at = draw.randrange(len(own) + 1)
            change = draw.choice(("put", "drop", "move"))
            if change == "put":
                own[at:at] = [word() for _ in range(draw.choice((1, 3, 20)))]
            elif change == "drop":
                del own[at : at + draw.choice((1, 4))]
            else:
                own = own[at:] + own[:at]
        docs.append([word() for _ in range(draw.choice((0, 7)))] + own + [word() for _ in range(draw.choice((0, 9)))])
    want = {(d, i) for d, doc in enumerate(docs) for i, item in enumerate(items) if plainly_held(doc, item)}
    assert len(want) > 60 and held(spark, [" ".join(d) for d in docs], [" ".join(i) for i in items]) == want
