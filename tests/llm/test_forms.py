"""Spelling forms, url verdicts and manifests against plain versions on small tables and odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairlab.llm import merkle, spelling, url_filter
from pairlab.llm.queries import URL_RULES


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# Spelling


def edits(a, b):
    """Whether one inserted, deleted or replaced code point leads from a to b."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_forms(n, least):
    words = sorted(w for w in n if n[w] >= least)
    near = {w: sorted((v for v in words if edits(w, v)), key=lambda v: (-n[v], v)) for w in words}
    form = {w: near[w][0] for w in words if near[w] and n[near[w][0]] >= 2 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in words}


@pytest.mark.parametrize("tile_words", [2, 5, 512])
def test_forms_equal_plain_comparison(spark, tile_words):
    """Dense vocabularies, also where nearly all groups are too large for a tile."""
    draw = random.Random(3)
    words = {"".join(draw.choices("abé", k=draw.choice((4, 5, 6, 7)))) for _ in range(300)}
    words |= {"prefix" + w for w in list(words)[:60]} | {"a" * 700, "a" * 701, "a" * 350 + "b" + "a" * 349, "x" * 30}
    n = {w: draw.choice((1, 3, 3, 4, 9, 20, 50)) for w in words}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    got = spelling.spelling_forms(df, tile_words=tile_words).select("word", "form", "root", "n", "n_near", "form_n")
    assert {tuple(r) for r in got.collect()} == plain_forms(n, 3)


def test_tiles_of_any_size_agree():
    draw = random.Random(5)
    words = sorted({"".join(draw.choices("ab", k=draw.choice((6, 7)))) for _ in range(120)})
    want = spelling.near(words, 1, 6, 0, 6)
    for tile_bytes in (1, 50, 3000):
        got = spelling.near(words, 1, 6, 0, 6, tile_bytes)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
    count = [sum(edits(w, v) and min(len(w), len(v)) == 6 for v in words) for w in words]
    assert want[0].tolist() == count


def test_word_counts_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 7)
    rows = [(1, "Größe GRÖSSE größe Gr\u00f6\u00dfe"), (1, "Größe GRÖSSE größe Gr\u00f6\u00dfe"), (2, None), (3, ""), (None, "nullid nullid"),
            (4, "abcde-fghij1klmno short Ω letters" + " word" * 5), (5, "z" * 50_000), *((k, f"sample words number{k}") for k in range(10, 400))]
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], "doc_id long, text string, word string, n int")
    want = Counter()
    for key, text in rows:
        for run, n in Counter(lower(w) for w in re.findall("[A-Za-zÀ-ÿ]+", text or "")).items():
            h = zlib.crc32(f"{key}:{run}".encode())
            if key is not None and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                want[run] += n
    assert {r.word: r.n for r in spelling.word_counts(df).collect()} == want
    assert any(len(w) == 5 and "sample".startswith(w[:2]) for w in want)
    got = spelling.spelling_variants(df)
    assert {tuple(r) for r in got.collect()} == plain_forms(want, 3)
    assert spelling.spelling_variants(df.limit(0)).collect() == []


# URLs


def test_scan_finds_what_find_finds():
    draw = random.Random(1)
    terms = [b"ab", b"aba", b"bab", b"b", b"cab", b"abcab"]
    texts = ["".join(draw.choices("abcx", k=draw.choice((0, 1, 5, 60)))).encode() for _ in range(200)]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    row, end, term = url_filter.Automaton(terms).scan(np.frombuffer(b"".join(texts), np.uint8), offsets)
    want = {(i, k + len(t), j) for i, x in enumerate(texts) for j, t in enumerate(terms) for k in range(len(x)) if x.startswith(t, k)}
    assert set(zip(row.tolist(), end.tolist(), term.tolist())) == want and len(row) == len(want)


def plain_verdict(url, rules):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = re.split("[?#]", url.split("://", 1)[1])[0]
        host, path = lower(rest.split("/")[0]), rest[len(rest.split("/")[0]) :]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    text = "\n" + lower(url) + "\n"
    hits = [sum(bool(re.search(rf"[^a-z0-9\x80-\U0010ffff]{t}[^a-z0-9\x80-\U0010ffff]", text)) for t in terms)
            for terms in (url_filter.STRICT, url_filter.SOFT)]
    verdict = "block" if hits[0] or hits[1] >= 2 else "allow"
    rule, verdict = max(fits)[3:] if fits else (None, verdict)
    return host, path, rule, verdict, *hits


URLS = [
    None, "", "no scheme/at/all casino", "://", "http://", "http://net", "http://net/", "http://NET/x?y://z", "https://a.Net/",
    "http://xnet/", "http://example.net/en/", "http://example.net/en", "http://www.example.net/EN/1", "http://example.com/de/1#f/fr/",
    "http://sub.org/fr/", "http://org.com/fr/casino", "http://casinos.com/", "http://a.com/Casino-x", "http://a.com/free",
    "http://a.com/free?bets=1", "http://a.com/free/free/freebets", "http://free.bets.com", "http://a.com/?q=é" + "casino", "ftp://user@free.win:80/",
    "http://a.com?x=adult", "http://a.com/#xxx", "http://a..net./", "http://[::1]/", "http://a.com/" + "free-" * 30_000 + "win",
]


def test_verdicts_equal_plain_ones(spark):
    rules = [*URL_RULES, ("block", "a.com", "/fr"), ("allow", "com", "/free"), ("allow", "com", "/free"), ("block", "b.com", "/"), ("allow", "com", "/bb/")]
    urls = [*URLS, "http://b.com/bb/1", *URLS[:9]]
    df = spark.createDataFrame([(k % 30 or None, u, "h", "p", "r") for k, u in enumerate(urls)], "page_id long, url string, host string, path string, rule string")
    for chosen in (URL_RULES, rules, []):
        got = url_filter.judge(df, chosen)
        assert got.columns == ["page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft"]
        want = [(k % 30 or None, *plain_verdict(u, chosen)) for k, u in enumerate(urls)]
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert url_filter.judge(df.limit(0), rules).collect() == []
    with pytest.raises(ValueError):
        url_filter.judge(df, [("maybe", "a", "/")])


# Manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    """Root and, per leaf, (before, after) of every level."""
    nodes, ways = [(h, [i]) for i, h in enumerate(leaves)], [[] for _ in leaves]
    while len(nodes) > 1:
        above = []
        for at in range(0, len(nodes), 8):
            run = nodes[at : at + 8]
            for k, (_, members) in enumerate(run):
                for i in members:
                    ways[i].append(("".join(h for h, _ in run[:k]), "".join(h for h, _ in run[k + 1 :])))
            above.append((digest(*(h for h, _ in run)), [i for _, members in run for i in members]))
        nodes = above
    return nodes[0][0], ways


def plain_leaf(row, low=False):
    parts = [*row[:4], lower(row[4]) if low and row[4] is not None else row[4]]
    return digest(*("-" if p is None else f"{len(str(p).encode())}:{p}" for p in parts))


def plain_audit(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees.append(plain_tree([plain_leaf(r) for r in groups[g]]))
    root, tops = plain_tree([t[0] for t in trees])
    out = []
    for g, (subroot, ways), top in zip(order, trees, tops):
        for r, way in zip(groups[g], ways):
            found = plain_leaf(r, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0)
            for before, after in way + top:
                found = digest(before, found, after)
            out.append((r[0], plain_leaf(r), subroot, root, digest(*(s for p in way + top for s in p)), found, found == root))
    return out


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, g string, index int, salt int"


@pytest.mark.parametrize("levels", [1, 4])
def test_proofs_equal_plain_ones(spark, monkeypatch, levels):
    """Group sizes around the powers of the fanout, a null group, null and repeated ids, equal rows; with small blocks
    also several rounds of builders."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 8**levels)
    sizes = {"a": 1, "b": 2, "c": 8, "d": 9, "e": 64, "f": 65, "ö": 73, "g": 513, None: 17, "": 3}
    sizes |= {f"z{k}": 1 for k in range(70)}
    rows = [(k * 7 % 1000, "s", g, k, f"Text {k} ÄB") for g, n in sizes.items() for k in range(n)]
    rows += [(5, "s", "a", 1, "Same")] * 40 + [(None, None, "d", None, None)] * 3 + [(None, "", "d", 0, ""), (12, "x", "c", 1, "A" * 100_000)]
    df = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], SCHEMA).repartition(5)
    got = merkle.audit(df, changed=merkle.lower_cased_third())
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain_audit(rows), key=str)


def test_log_is_a_postorder(spark):
    """Positions are 0, 1, 2 ... and every node stands right after its last child."""
    for n in (1, 2, 7, 8, 9, 63, 64, 65, 100, 512, 700):
        seen = {}
        for level in range(merkle.height(n) + 1):
            count = -(-n // 8**level)
            for index, place in enumerate(merkle.position(level, np.arange(count), n).tolist()):
                seen[place] = (level, index)
                if level:
                    last = min(8 * index + 7, -(-n // 8 ** (level - 1)) - 1)
                    assert merkle.position(level - 1, last, n) == place - 1
        assert sorted(seen) == list(range(len(seen)))


def test_proofs_lead_to_the_root(spark):
    rows = [(k, "s", "ab"[k % 2], k, f"text {k}", "x", 1, 1) for k in range(90)]
    made = merkle.build(spark.createDataFrame(rows, SCHEMA))
    for r in merkle.proofs(made).collect():
        assert merkle.folded(r.leaf, [(p.before, p.after) for p in r.way]) == r.root
    places = [r.position for r in made.log.where("g = '=a'").collect()] + [
        r.p for r in made.leaves.where("g = '=a'").select(merkle.position_column("0", "index", "n").alias("p")).collect()
    ]
    assert sorted(places) == list(range(len(places)))


def test_empty_manifest(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert merkle.audit(df, changed=merkle.lower_cased_third()).collect() == []
    assert merkle.proofs(merkle.build(df)).collect() == []
