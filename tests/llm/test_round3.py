"""Operators 11 to 13 against brute force, libraries and odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from collidex.llm import merkle, piece_codec, zone_clusters


# ---------------------------------------------------------------- 11 ---

def plain_clusters(rows, k, rounds, dims, scale):
    kept = [(i, [int(np.floor(x * scale)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"1:{'null' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    centroids = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            if own := [v for (_, v), a in zip(kept, at) if a == n]:
                centroids[n] = [sum(col) // len(own) for col in zip(*own)]
    got = [(i, *nearest(v)[::-1]) for i, v in kept]
    per = {}
    for _, c, d in got:
        per[c] = per.get(c, 0) + d
    return sorted(((i, c, d, per[c], sum(per.values()),
                    hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, c, d in got), key=str)


def spark_clusters(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, v string")
    return sorted((tuple(r) for r in zone_clusters.cluster(df, **kw).collect()), key=str)


def test_clusters_equal_plain_comparison(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(3 * (i % 4), 1) for _ in range(5)]) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(300)]                                  # one vector fills a large share
    rows += [(7, rows[7][1]), (7, rows[7][1]), (None, rows[8][1]), (2000, None), (2001, [1.0] * 4), (2002, []),
             (2003, [1.0, None, 1.0, 1.0, 1.0]), (2004, [float("nan")] * 5), (2005, [float("inf")] * 5), (2006, [-1e-9] * 5)]
    kw = dict(k=6, rounds=3, dims=5, scale=64.0)
    assert spark_clusters(spark, rows, block_rows=16, **kw) == plain_clusters(rows, **kw)


def test_clusters_of_few_or_no_vectors(spark):
    kw = dict(k=16, rounds=3, dims=2, scale=64.0)
    rows = [(1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [-7.0, 2.0])]
    assert spark_clusters(spark, rows, **kw) == plain_clusters(rows, **kw)
    assert spark_clusters(spark, [], **kw) == []
    assert spark_clusters(spark, [(1, None)], **kw) == []


def test_large_components_are_held_within_the_bound(spark):
    got = spark_clusters(spark, [(1, [1e300, 0.0]), (2, [-1e300, 0.0])], k=1, rounds=1, dims=2, scale=64.0)
    assert [r[2] for r in got] == [zone_clusters.LARGEST ** 2] * 2


def test_candidates_hold_every_nearest_centroid_and_prune():
    rng = np.random.default_rng(5)
    pruned = 0
    for _ in range(300):
        c = rng.integers(-40, 40, (12, 6))
        v = rng.integers(-40, 40, 6) + rng.integers(0, rng.integers(1, 30), (20, 6))
        left = zone_clusters.candidates(v.min(0), v.max(0), c)
        d = ((v[:, None] - c[None]) ** 2).sum(2)
        assert set(d.argmin(1)) <= set(left.tolist())
        n, distance = zone_clusters.nearest(v, v.min(0), v.max(0), c)
        assert (n == d.argmin(1)).all() and (distance == d.min(1)).all()
        pruned += 12 - len(left)
    assert pruned > 600


@pytest.mark.parametrize("n,bits", [(2, 3), (3, 2), (5, 2)])
def test_hilbert_curve_visits_neighbours_in_turn(n, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), -1).reshape(-1, n)
    keys = [int.from_bytes(k.tobytes(), "big") for k in zone_clusters.hilbert_keys(cells, bits)]
    assert len(set(keys)) == len(cells)
    along = cells[np.argsort(np.array(keys, dtype=object))]
    assert (np.abs(np.diff(along, axis=0)).sum(1) == 1).all()


# ---------------------------------------------------------------- 12 ---

ODD_TEXTS = ["", " ", "\n\n  x", "it's we'll don't 'S", "a" * 5000, "漢字かな交じり文", "Привет, мир! Ёж", "مرحبا بالعالم", "🙂👍🏽 é ﬁ",
             "▁x▁", "Ġ Ċ <|endoftext|>", "\x00\x1c\x85　", "٣½Ⅷ 12345", "՘a࢏1\U000323b0", "x" * 70 + " " * 300 + "y"]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken
    ranks = piece_codec.codec(piece_codec.VOCABULARY).ranks
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(library, text):
    return np.array(library.encode_ordinary(text or ""), "<u4").tobytes()


def test_codec_equals_the_library(library):
    rng = random.Random(2)
    signs = " \n\t'asdlertv019_-!.éßжщ漢字あ한🙂 ​٣½\x85՘࢏"
    texts = ODD_TEXTS + ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    c = piece_codec.codec(piece_codec.VOCABULARY)
    got = c.encode(texts)
    assert got == [ids_of(library, t) for t in texts]
    assert [c.decode(i).decode() for i in got] == texts


def test_codec_classes_of_all_code_points():
    """The pattern's engine and the library agree on every sign, alone and behind a letter."""
    import public_tokenizers
    import tiktoken
    c = piece_codec.codec(piece_codec.VOCABULARY)
    signs = [chr(i) for i in [*range(0xD800), *range(0xE000, 0x110000)]]
    letters = {s for s in signs if len(c.split("a" + s)) == 1}
    probe = tiktoken.Encoding("p", pat_str=r"\p{L}", mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    assert set(probe.decode(probe.encode_ordinary("".join(signs)))) | {"\n"} >= letters
    assert letters >= set(probe.decode(probe.encode_ordinary("".join(signs))))
    assert public_tokenizers.PATTERN


def test_codec_of_another_vocabulary_and_missing_bytes():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 300, b"abc": 299, b"bc": 400}
    c = piece_codec.Codec(ranks, r"\S+|\s+")
    assert c.encode(["abcab", "bcbc"]) == [np.array([299, 300], "<u4").tobytes(), np.array([400, 400], "<u4").tobytes()]
    with pytest.raises(ValueError):
        piece_codec.Codec({b"a": 0}, r"\S+")


def test_codec_query_rows(spark, library):
    rows = [(i, t, "en") for i, t in enumerate(ODD_TEXTS)] + [(None, "a b", "x"), (3, None, "x"), (3, None, "x"), (4, "long " * 60_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(map(tuple, piece_codec.decode(piece_codec.encode(docs)).collect()), key=str)
    want = sorted(((i, len(ids_of(library, t)) // 4, bytearray(ids_of(library, t)), bytearray((t or "").encode())) for i, t, _ in rows), key=str)
    assert got == want
    assert piece_codec.decode(piece_codec.encode(docs.limit(0))).count() == 0


# ---------------------------------------------------------------- 13 ---

def plain_manifest(rows):
    """doc_id, leaf, subroot, root, siblings' digest, folded root of tampered rows, by whole trees in lists."""
    def leaf_of(row):
        parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
        return merkle.H("".join(parts))

    def climb(digests):
        levels = [digests]
        while len(levels[-1]) > 1:
            d = levels[-1]
            levels.append([merkle.H("".join(d[i:i + 16])) for i in range(0, len(d), 16)])
        return levels

    def path(levels, pos):
        out = []
        for level in levels[:-1]:
            run = level[pos // 16 * 16: pos // 16 * 16 + 16]
            out.append((run[:pos % 16], run[pos % 16 + 1:]))
            pos //= 16
        return out

    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        own = sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[s] = own, climb([leaf_of(r) for r in own])
    top = climb([trees[s][1][-1][0] for s in sources]) if rows else [[""]]
    out = []
    for k, s in enumerate(sources):
        own, levels = trees[s]
        for pos, r in enumerate(own):
            steps = path(levels, pos) + path(top, k)
            changed = list(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                changed[4] = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
            node = leaf_of(changed)
            for left, right in steps:
                node = merkle.H("".join(left) + node + "".join(right))
            out.append((r[0], leaf_of(r), levels[-1][0], top[-1][0], merkle.H("".join("".join(a + b) for a, b in steps)),
                        node, node == top[-1][0]))
    return sorted(out, key=str)


def spark_manifest(spark, tmp_path, rows):
    path = str(tmp_path / f"m{len(rows)}")
    df = spark.createDataFrame([(*r, "x", "y") for r in rows],
                               "doc_id long, source string, lang string, n_chars long, text string, leaf string, g string")
    df.repartition(3).write.parquet(path + "/documents.parquet")
    return sorted(map(tuple, merkle.query(spark, path).collect()), key=str)


@pytest.mark.parametrize("sizes", [[1], [2, 1], [16, 17], [257, 1, 4097]])
def test_manifest_equals_whole_trees(spark, tmp_path, sizes):
    rows = [(i * 7 + s, f"s{s}", "en", i, f"Text {i} of S{s}") for s, n in enumerate(sizes) for i in range(n)]
    assert spark_manifest(spark, tmp_path, rows) == plain_manifest(rows)


def test_manifest_of_odd_rows(spark, tmp_path):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, None, "en", 2, "Ab"), (None, "", "de", 0, ""),
            (5, "", "de", -3, "Ä" * 40_000), (-5, "é", None, 7, "1:x"), (10, "z", "fr", 1, "ABC abc Ü"), (9, "\U0001f642", "ru", 1, None)]
    rows += [(i, f"src{i % 37}", "en", i, "T") for i in range(300, 340)]
    assert spark_manifest(spark, tmp_path, rows) == plain_manifest(rows)


def test_manifest_of_an_empty_table(spark, tmp_path):
    assert spark_manifest(spark, tmp_path, []) == []


def test_witnesses_of_an_open_subtree_grow_with_later_appends():
    tree, witnesses = merkle.Subtree(2), []
    digests = [merkle.H(str(i)) for i in range(40)]
    for i, d in enumerate(digests):
        witnesses.append([])
        tree.append(d, [witnesses[-1]])
        done = (i + 1) // 16 * 16
        assert [len(w) for w in witnesses] == [1] * done + [0] * (i + 1 - done)      # partial until the run is complete
    root = tree.finish()
    assert all(len(w) == 2 for w in witnesses)
    for d, w in zip(digests, witnesses):
        for s in w:
            d = merkle.H(s["left"] + d + s["right"])
        assert d == root


# ---------------------------------------------------------- 6 and 9 ---

@pytest.mark.parametrize("text", ["2024-01-15 12:30:45", "ISBN 978-3-16-148410-0", "10 20 30 40 50", "1 200 300 400 EUR", "1999-2000-2001",
                                  "12.345.678.901", "2024-01-15T12:30", "3.14159 26535 8979", "07 01 2024 12345", "0.5 12 13.5 99 100"])
def test_dates_and_numbers_are_no_personal_data(text):
    from collidex.llm.pii import mentions, replaced
    assert list(mentions(text)) == []
    assert replaced(text, b"k", {}) == (text, 0)


@pytest.mark.parametrize("phone", ["555 123 4567", "(555) 123-4567", "+1 555 123 4567", "+49 30 1234 5678", "030 1234567", "+15551234567",
                                   "1-555-123-4567", "+44 (20) 7946 0958", "0170/1234567", "+33 1 23 45 67 89", "212.555.0187"])
def test_phones_are_found_whole(phone):
    from collidex.llm.pii import PATTERN, _matches
    assert [(m.lastgroup, m[0]) for m in _matches(f"call {phone}, or 2024-01-15")] == [("phone", phone)]
    assert PATTERN.search(f"x{phone}9") is None or PATTERN.search(f"x{phone}9")[0] != phone


N = 1_000_000
MALFORMED = {"quotes": '<a"' * (N // 3), "classes": '<p class="' * (N // 10), "open": "a <b " * (N // 5), "quotes, one end": '<a"' * (N // 3) + ">",
             "classes, one end": '<p class="' * (N // 10) + ">", "odd": '<a href="x>y ' * (N // 13), "equals": "<a =" + " =" * (N // 2),
             "letters": "<p " + "a" * N + ">", "less": "<" * N, "comments": "<!--" * (N // 4), "raw": "<script>" + "</script " * (N // 9),
             "declarations": "<!x" * (N // 3), "digits": "x &#" + "9" * N + "; y", "zeros": "x &#" + "0" * N + "65; y"}


@pytest.mark.parametrize("kind", MALFORMED)
def test_malformed_pages_take_linear_time(kind):
    import time
    from collidex.llm.main_text import extract
    start = time.process_time()
    extract(MALFORMED[kind])
    assert time.process_time() - start < 3


def test_references_beyond_all_code_points():
    from collidex.llm.main_text import extract
    assert extract("<p>x &#" + "9" * 6000 + "; y &#" + "0" * 6000 + "65; &#x1F642; &amp;</p>") == "x � y A \U0001f642 &"


def test_short_pages_and_pages_within_a_form():
    from collidex.llm.main_text import extract
    assert extract("<h1>T</h1><p>Hi there.</p>" + "<nav>a</nav>" * 4 + "<p>Second short</p>") == "T Hi there. Second short"
    assert extract('<body><form id="f"><h1>Title</h1><p>Some text here.</p></form></body>') == "Title Some text here."
    main = "This is the long text of an article, which goes on for a while and then ends. " * 3
    assert extract(f"<article><p>{main}</p></article><form>Your name <input> {main * 3}</form>") == main.strip()
    assert extract(f"<p>{main}</p><form>Your name: <input></form>") == main.strip()


def test_greater_signs_in_values():
    from collidex.llm.main_text import extract
    assert extract('<p title="a > b">One</p><p title=\'x>y\' data-a = "1>2">Two</p><p title="open>Three</p>') == "One Two Three"
