"""The numbered operators against brute force, exact round trips and held-out labels, on small inputs with odd rows."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from spotshare.llm import bpe, common, components, licences, quality, queries, rules, sharding, simhash, suffixes, templates, toxicity, urls

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b for a in ("ka", "lo", "mi", "ten", "ru", "sa") for b in ("ra", "vol", "ni", "est", "du", "pe", "xo")]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and blank texts, a very long one, repeated rows and ids, clashing extra columns."""
    rng = random.Random(1)
    base = prose(rng, 120)
    rows = [
        (1, base, "en", "a", 5), (2, base, "en", "a", 5), (2, base, "en", "a", 5), (3, base.replace("kara", "zzz"), None, None, None),
        (4, None, "en", "a", None), (5, "", "en", "a", 0), (6, " \n\t ", None, "b", 1), (None, None, None, None, None), (None, base, "x", "y", 1),
        (7, "é漢" * 300, "fr", "b", 2), (8, "word " * 3000, "en", "b", 3), (9, prose(rng, 20_000), "en", "c", 4), (10, "aB", "en", "c", 4),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    for name in ("digest", "node", "fingerprint", "kept", "spans", "ids", "decoded", "n_words", "cell", "rule", "host", "score", "pos", "hash"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def texts_of(docs):
    return [(r[0], r[1] or "") for r in docs.select("doc_id", "text").collect()]


def by_row(rows):
    return sorted(map(str, rows))


def removal_by_force(rows, length):
    """Every string of the length with its number of places; bytes under a repeated one go."""
    places = {}
    data = [(k, t.encode()) for k, t in rows]
    for _, t in data:
        for i in range(len(t) - length + 1):
            places[t[i : i + length]] = places.get(t[i : i + length], 0) + 1
    out = []
    for k, t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if places[t[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((k, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [suffixes.HOT, 2])
def test_suffixes_equal_brute_force(spark, hot):
    rng = random.Random(2)
    shared = [prose(rng, 14) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [prose(rng, rng.randrange(1, 15)) for _ in range(3)]
        if rng.random() < 0.7:
            parts.insert(rng.randrange(4), rng.choice(shared))
        rows.append((i, " ".join(parts)))
    rows += [(90, rows[0][1]), (91, "ab" * 200), (92, "é" * 90), (93, None), (94, ""), (94, "short"), (None, shared[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffixes.removal_digests(docs, length=64, gram=16, hot=hot).collect()
    assert by_row(map(tuple, got)) == by_row(removal_by_force([(k, t or "") for k, t in rows], 64))


@pytest.mark.parametrize("length", [300, 400])
def test_suffixes_of_other_lengths(spark, length):
    rng = random.Random(5)
    shared = [prose(rng, 90) for _ in range(2)]
    rows = [(i, prose(rng, 30) + " " + shared[i % 2] + prose(rng, 5)) for i in range(6)] + [(9, "x" * 900), (10, "xy" * 500)]
    got = suffixes.removal_digests(spark.createDataFrame(rows, "doc_id long, text string"), length=length, hot=3).collect()
    want = removal_by_force(rows, length)
    assert by_row(map(tuple, got)) == by_row(want) and any(r[2] for r in want[:6])


def test_suffixes_refuse_impossible_lengths(empty):
    for length in (16, 40, 1 << 20):
        with pytest.raises(ValueError):
            suffixes.removal_digests(empty, length=length)


def test_an_id_is_learned_from_once(spark):
    docs = spark.createDataFrame([(1, f"text {i % 3}") for i in range(300)] + [(2, "b" * (1 << 19)), (3, None), (4, "d")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1.0) for k in (1, 2, 3, 4)], "doc_id long, label double")
    picked = common.one_text(docs.join(labels, "doc_id"))
    assert sorted(map(tuple, picked.collect())) == [(1, 1.0, "text 0"), (3, 1.0, ""), (4, 1.0, "d")]
    shared = spark.sparkContext.broadcast(np.ones((quality.BUCKETS, quality.SIZE), dtype=np.float32))
    assert quality.labelled_features(docs.withColumn("label", F.lit("clash")), labels, shared, 10).count() == 3
    assert toxicity.train(docs.withColumn("label", F.lit("clash")), labels) is not None


def test_suffixes_odd_and_empty(odd, empty):
    got = suffixes.removal_digests(odd).collect()
    short = [(k, t) for k, t in texts_of(odd) if len(t) < 50_000]
    want = {str(x) for x in removal_by_force(short, 200)}
    assert want <= {str(tuple(r)) for r in got} and len(got) == odd.count()
    assert suffixes.removal_digests(empty).count() == 0
    assert set(odd.columns) <= set(suffixes.remove_repeats(odd).columns)


def test_deep_shallow_sort_finds_equal_strings():
    rng = np.random.default_rng(3)
    for _ in range(30):
        buf = np.concatenate((rng.integers(97, 99, 400, dtype=np.uint8), np.zeros(8, dtype=np.uint8)))
        buf[200:260] = buf[20:80]
        place = np.arange(400 - 24)
        group = rng.integers(0, 2, len(place))
        seen = {}
        for p, g in zip(place, group):
            seen.setdefault((g, buf[p : p + 24].tobytes()), []).append(p)
        want = np.array([len(seen[g, buf[p : p + 24].tobytes()]) > 1 for p, g in zip(place, group)])
        assert (suffixes.repeated(buf, place, group, 24, shallow=8) == want).all()


def plain_simhash(text: str, words: int = 3) -> int:
    w = text.encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + words]) for i in range(len(w) - words + 1)] or [b" ".join(w)]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes_by_force(prints, radius):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, f) in enumerate(prints):
        for j in range(i):
            if (f ^ prints[j][1]).bit_count() <= radius:
                root[find(i)] = find(j)
    low = {}
    for i, (k, _) in enumerate(prints):
        if k is not None:
            low[find(i)] = min(k, low.get(find(i), k))
    return [(k, f, low.get(find(i))) for i, (k, f) in enumerate(prints)]


@pytest.mark.parametrize("block", [simhash.BLOCK, 3])
def test_simhash_equals_brute_force(spark, odd, block):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randrange(1, 60))) for i in range(80)]
    rows += [(100 + i, t + " more") for i, (_, t) in enumerate(rows[:40])] + [(k + 200, t) for k, t in rows[:9]] + texts_of(odd)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r[0], r[1] & (1 << 64) - 1, r[2]) for r in simhash.near_duplicates(docs, block=block).collect()]
    assert by_row(got) == by_row(classes_by_force([(k, plain_simhash(t)) for k, t in rows], 3))


def test_near_copies_link_copies_and_leave_others(spark, empty):
    rng = random.Random(5)
    rows = [(i, " ".join(str(rng.random()) for _ in range(200))) for i in range(50)]
    copies = []
    for k, t in rows[:20]:
        w = t.split()
        w[100] = "changed"
        copies.append((k + 1000, " ".join(w)))
    got = dict(simhash.near_copies(spark.createDataFrame(rows + copies, "doc_id long, text string")).collect())
    assert all(got[k + 1000] == k for k in range(20)) and all(got[k] == k for k in range(50))
    assert simhash.near_copies(empty).count() == 0


@pytest.mark.parametrize("sets", [1024, 16])
def test_near_copies_are_confirmed_by_exact_similarity(spark, sets):
    rng = random.Random(6)
    rows, want = [], {}
    # so many common shingles and so many of each text's own: common / (common + 2 * own)
    for common, own in ((420, 90), (390, 55), (398, 50), (400, 50), (410, 45), (850, 75)):
        for _ in range(12):
            head = [str(rng.random()) for _ in range(common + 4)]
            k = len(rows)
            rows += [(k + i, " ".join(head + [str(rng.random()) for _ in range(own)])) for i in range(2)]
            want |= {k: k, k + 1: k if common / (common + 2 * own) >= 0.8 else k + 1}
    head = [str(rng.random()) for _ in range(200)]
    group = len(rows)
    for i in range(60):
        rows.append((group + i, " ".join([*head[:100], str(i), *head[100:]])))
        want[group + i] = group
    got = dict(simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), sets_at_once=sets).collect())
    assert got == want


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)], "a long, b long")
    got = dict(components.components(edges).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_bpe_equals_the_library(spark, odd, empty):
    path, pattern = public_tokenizers.path(queries.VOCABULARY), public_tokenizers.PATTERN
    ranks = bpe.read_ranks(path)
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(6)
    extra = ["".join(rng.choice(a) for _ in range(n)) for a in ("ab", " \n\ta", "éàa b.", "漢字 9'", "\x1c\u3000\xa0x ", "it's I'll") for n in (1, 3, 40, 900)]
    docs = odd.unionByName(spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(extra)], DOCS), allowMissingColumns=True)
    got = [(r[0], r[1], list(r[2]), bytes(r[3])) for r in bpe.round_trip(docs, path, pattern).select("doc_id", "text", "ids", "decoded").collect()]
    assert by_row(got) == by_row((k, t, library.encode_ordinary(t or ""), (t or "").encode()) for k, t in docs.select("doc_id", "text").collect())
    two = bpe.decode(bpe.encode(docs, path, pattern), path)
    assert two.where("decoded <> cast(coalesce(text, '') as binary)").count() == 0
    assert bpe.digests(empty, path, pattern).count() == 0


def test_bpe_without_the_word_shortcut():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"aa": 259, b"aaaa": 260, b"xyz": 261}
    own = bpe.Encoder(ranks, r"\S+|\s+")
    library = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(7)
    for _ in range(400):
        text = "".join(rng.choice("abcxyz ") for _ in range(rng.randrange(12)))
        assert own.encode(text) == library.encode_ordinary(text)


def test_bpe_searches_pieces_together():
    path, pattern = public_tokenizers.path(queries.VOCABULARY), public_tokenizers.PATTERN
    ranks = bpe.read_ranks(path)
    own, rng, calls = bpe.Encoder(ranks, pattern), random.Random(8), []
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    search = own._search
    own._search = lambda *piece: calls.append(piece) or search(*piece)
    texts = [" ".join("".join(rng.choice("abeinrst\u00e9\u6f22.'9") for _ in range(rng.randrange(14))) for _ in range(300)) for _ in range(10)]
    texts += ["", " ", "\n\n a", "ab" * bpe._LONG, "#" * (bpe._LONG + 1) + " x"]
    for _ in range(2):
        assert [np.frombuffer(ids, dtype=np.int32).tolist() for ids in own.packed(texts)] == [library.encode_ordinary(t) for t in texts]
    assert len(calls) < 500  # of some thousands of pieces; texts without runs of white space ask in few calls


def test_bpe_workers_forget_words(spark, odd):
    path, pattern = public_tokenizers.path(queries.VOCABULARY), public_tokenizers.PATTERN

    def remembered(batches):
        for batch in batches:
            if bpe.encoder.cache_info().currsize:
                kept = bpe.encoder(path, pattern)
                yield pa.RecordBatch.from_pydict({"n": [len(kept.young) + len(kept.old)]})

    assert bpe.round_trip(odd, path, pattern).where("size(ids) > 0").count()
    got = spark.range(0, 64, 1, 8).mapInArrow(remembered, "n long").collect()
    assert got and not any(n for n, in got)


def held_out_accuracy(docs, scored, labels, column, modulus, part, threshold):
    known = {r[0]: r[1] for r in labels.select("doc_id", column).collect()}
    rows = [(r[-1] >= threshold, known[r[0]]) for r in scored.collect() if r[0] in known and zlib.crc32(str(r[0]).encode()) % modulus == part]
    return sum(a == bool(b) for a, b in rows) / len(rows)


def test_quality_held_out_and_odd_rows(spark, odd, empty):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    vectors, net = quality.train(docs, quality.training_labels(labels, "quality", 3, 1))
    scored = quality.score(docs.select("doc_id", "text"), vectors, net)
    assert held_out_accuracy(docs, scored, labels, "quality", 3, 1, 0.5) > 0.93
    rows = quality.score(odd, vectors, net)
    assert rows.count() == odd.count() and rows.where("quality_score IS NULL OR quality_score < 0 OR quality_score > 1").count() == 0
    vectors, net = quality.train(empty, empty.select("doc_id", F.lit(1.0).alias("label")))
    assert {r[0] for r in quality.score(odd, vectors, net).select("quality_score").collect()} == {0.5}


def test_toxicity_held_out_and_odd_rows(spark, odd, empty):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = toxicity.train(docs, quality.training_labels(labels, "toxic", 4, 2))
    assert held_out_accuracy(docs, toxicity.score(docs.select("doc_id", "text"), model), labels, "toxic", 4, 2, 0.3) > 0.85
    rows = toxicity.score(odd, model)
    assert rows.count() == odd.count() and rows.where("toxicity IS NULL OR toxicity < 0 OR toxicity > 1").count() == 0
    assert toxicity.train(empty, empty.select("doc_id", F.lit(1.0).alias("label"))).bias == 0.0


def test_rules_equal_a_loop_and_any_order(odd, empty):
    import re

    def plain(text):
        w = re.findall(r"[^ \t-\r]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^ \t-\r]", x)]
        windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        count = {x: windows.count(x) for x in set(windows)} if len(windows) < 5000 else {}
        covered = {i + k for i, x in enumerate(windows) if count.get(x, 0) > 1 for k in range(5)}
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)

    judged = rules.judge(odd).select("doc_id", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    for row in judged.collect():
        if len(row["text"] or "") < 20_000:
            want = plain(row["text"] or "")
            assert tuple(row[2:7]) == want
            assert row["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (row["base_failed"] and row["kept"])
    measured = rules.measured(odd)
    kept = [measured.select("doc_id", rules.cascade(measured, list(order)).isNull().alias("k")).collect() for order in (rules.RULES, rules.RULES[::-1])]
    assert by_row(kept[0]) == by_row(kept[1])
    assert rules.judge(empty).count() == 0


def test_rules_are_ordered_by_their_own_cost(spark):
    rng = random.Random(15)
    docs = spark.createDataFrame([(i, prose(rng, 60)) for i in range(400)], "doc_id long, text string")
    cheap = rules.Rule("cheap", "n_words > 50")
    costly = rules.Rule("costly", "length(regexp_replace(repeat(text, 30), '[^A-Z]', '')) < 1 AND n_words > 50")
    for listed in ((cheap, costly), (costly, cheap)):
        part = rules.measured(docs)
        a, b = rules._costs(part, listed)
        assert (a < b) == (listed[0] is cheap) and max(a, b) > 3 * min(a, b)
        assert [r.name for r in rules.order_rules(docs, listed)] == ["cheap", "costly"]


def test_urls_equal_plain_rules(spark):
    import fnmatch
    import re

    rng = random.Random(8)
    hosts = ["example.com", "www.example.com", "a.b.example.com", "EXAMPLE.com", "xexample.com", "net", "x.net", "ads.x.org", "m.ads-track.org", "a.onion", "casino.org", ""]
    paths = ["", "/", "/en/1", "/en", "/es/x", "/fr/", "/a/ads/b", "/x.exe", "/login", "/q/login?x", "/p.php~.bak", "/\t/es/"]
    made = [f"{rng.choice(['http', 'https'])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?a=/es/', '#f'])}" for _ in range(400)]
    made += [None, "", "no scheme", "://", "a://b://c/es/", "http://x.net\t/es/", "http://" + "a" * 5000 + ".net/fr/" + "b" * 5000]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(made)], "page_id long, url string, rule string")

    def glob(pattern):
        return re.compile("".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in pattern) + r"\Z", re.S)

    for row in urls.judge(pages).collect():
        url = row["url"] or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        assert (row["host"], row["path"]) == (host, path)
        fits = []
        for r in urls.SITE_RULES:
            h, _, p = r.pattern.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                fits.append((len(r.pattern), r))
        if fits:
            best = max(fits, key=lambda f: f[0])[1]
            assert (row["rule"], row["verdict"]) == (best.pattern, best.action)
        else:
            hit = any(glob(r.pattern.partition("/")[0]).match(host) and glob("/" + r.pattern.partition("/")[2]).match(path) for r in urls.GLOB_RULES)
            assert (row["rule"], row["verdict"]) == (None, "block" if hit else "allow"), url
    assert urls.judge(pages.limit(0)).count() == 0


def hilbert_by_walk(bits: int) -> list[tuple[int, int]]:
    """The curve in the plane, by turning and joining four smaller ones."""
    if not bits:
        return [(0, 0)]
    half, small = 1 << bits - 1, hilbert_by_walk(bits - 1)
    return [(y, x) for x, y in small] + [(x, y + half) for x, y in small] + [(x + half, y + half) for x, y in small] + [
        (2 * half - 1 - y, half - 1 - x) for x, y in small]


def test_hilbert_curve_steps_to_neighbours(spark):
    for axes, bits in ((2, 3), (3, 2), (4, 2)):
        cells = spark.range(1 << axes * bits)
        names = [f"a{i}" for i in range(axes)]
        cells = cells.select(*(F.shiftright("id", bits * i).bitwiseAND(F.lit((1 << bits) - 1)).alias(n) for i, n in enumerate(names)))
        rows = cells.withColumn("at", sharding.hilbert_index([F.col(n) for n in names], bits)).orderBy("at").collect()
        assert [r["at"] for r in rows] == list(range(1 << axes * bits))
        assert all(sum(abs(a[n] - b[n]) for n in names) == 1 for a, b in zip(rows, rows[1:]))
        if axes == 2:
            walk = [(r["a0"], r["a1"]) for r in rows]
            assert walk in (hilbert_by_walk(bits), [(y, x) for x, y in hilbert_by_walk(bits)])


def test_shards_are_even_and_gapless(spark, odd, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for rows, shards in ((docs, 7), (docs, 40), (odd, 4), (odd, 40)):
        got = sharding.placement(rows, shards).collect()
        assert len(got) == rows.count() and {r["law"] for r in got} == {"rows"}
        slots = {}
        for r in got:
            slots.setdefault(r["shard"], []).append(r["slot"])
        sizes = [len(slots.get(s, [])) for s in range(shards)]
        assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    text = {k: t for k, t in texts_of(docs)}
    for r in sharding.placement(docs).collect():
        raw = text[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
    assert sharding.placement(empty).count() == 0
    assert sharding.manifest(sharding.assign(docs)).count() == 40


def test_templates_catch_other_parameters(spark, odd, empty):
    item = "If Alice walks 12 km in 3 hours, how fast does Alice walk on average per hour?"
    docs = spark.createDataFrame([
        (1, f"Some text before. {item} And after it."), (2, item.replace("Alice", "Bob").replace("12 km", "40 miles").replace(" 3 ", " 7 ")),
        (3, item.replace("does Alice", "does Carl")), (4, "A clean text that has nothing to do with it at all, long enough"), (5, None), (6, ""),
        (None, item.lower().replace("alice", "Alice")), (7, "two plus two is"), (8, item), (8, item),
    ], "doc_id long, text string").withColumn("pos", F.lit("clash")).withColumn("item_id", F.lit("clash"))
    items = spark.createDataFrame([(10, item), (11, "two plus two is"), (12, None), (13, ""), (None, "unused words that no text has in it")], "item_id long, text string")
    got = templates.contaminated(docs, items).select("doc_id", "item_id", "reparameterised").collect()
    assert by_row(map(tuple, got)) == by_row([(1, 10, False), (2, 10, True), (None, 10, False), (7, 11, False), (8, 10, False), (8, 10, False)])
    assert {r["doc_id"] for r in templates.clean(docs, items).collect()} == {3, 4, 5, 6}
    assert templates.contaminated(docs, items.limit(0)).count() == 0 and templates.contaminated(empty, items).count() == 0
    assert templates.contaminated(odd, items).count() == 0


def test_templates_find_short_items_inside_long_texts(spark):
    rng = random.Random(13)
    items = ["What is the capital of France?", "Name that tune", "Who wrote the famous play of Hamlet?", "Gold", "Which two rivers meet here"]
    rows = [(i, f"{prose(rng, 300)}. {t} {prose(rng, 300)}") for i, t in enumerate(items)] + [(9, prose(rng, 600)), (10, items[0]), (11, "Gold!")]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = templates.contaminated(docs, bench).select("doc_id", "item_id").collect()
    assert by_row(map(tuple, got)) == by_row([*((i, i) for i in range(5)), (10, 0), (11, 3)])
    assert {r["doc_id"] for r in templates.clean(docs, bench).collect()} == {9}


def test_templates_find_items_with_few_literals(spark):
    items = [
        "Add 3 and 5 then 7 and 9 more now", "Add 3 and 5 then 7 and 9", "Compute 4 7 19 22 8 1 5 6 2", "Meet Anna Bob Carl Dora Emil Fritz Gerda Hans",
        "Tell me how many days one year has", "12 + 7 = ?",
    ]
    around = "so we were asked to do this by them"
    rows = [(i, f"{around}: {t} {around}") for i, t in enumerate(items)] + [(10 + i, f"{around}. {t}\n{around}") for i, t in enumerate(items)]
    rows += [(20, f"{around}. Add 13 and 15 then 17 and 19 {around}"), (21, f"{around}. Add 13 and 15 then 17 or 19 more now"),
             (22, f"{around}. Compute 5 8 20 23 9 2 6 7 3 {around}"), (23, f"{around}. Meet Ida Jan Karl Lars Max Nina Otto Paul")]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in templates.contaminated(docs, bench).collect()}
    # the second item is the head of the first
    assert got == {(i + k, i) for i in range(6) for k in (0, 10)} | {(0, 1), (10, 1), (20, 1)}


def test_templates_find_passages_with_one_edited_value(spark):
    rng = random.Random(14)
    item = f"A tank of 40 litres {prose(rng, 60)} in the tank of 40 litres {prose(rng, 30)} with Anna and again 40 litres"
    edited = item[: item.rindex("40")] + "41 litres"
    other = edited.replace("40", "50", 1).replace(" of ", " by ")
    far = " ".join(w if i % 8 else "else" for i, w in enumerate(item.split()))
    docs = spark.createDataFrame([(1, edited), (2, other), (3, far), (4, prose(rng, 100))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r["doc_id"]: r["reparameterised"] for r in templates.contaminated(docs, bench).collect()}
    assert got == {1: True, 2: True}


def test_licenses_planted_whole_and_edited(spark, odd, empty):
    rng = random.Random(9)
    grant = licences.TEMPLATES["MIT-grant"]
    edited = grant.replace("publish", "print").upper()
    docs = spark.createDataFrame([
        (1, prose(rng, 50) + " Licensed under CC BY 4.0. " + prose(rng, 50)), (2, prose(rng, 30) + " " + edited), (3, prose(rng, 400)),
        (4, "This license, version 3, is public."), (5, None), (6, ""), (None, "Released under the MIT License. x Released under the MIT License."),
    ], "doc_id long, text string").withColumn("license", F.lit("clash"))
    got = licences.scan(docs).select("doc_id", "license").collect()
    assert by_row(map(tuple, got)) == by_row([(1, "CC-BY-4.0-notice"), (2, "MIT-grant"), (None, "MIT-notice"), (None, "MIT-notice")])
    assert licences.scan(empty).count() == 0 and licences.scan(odd).count() == 0 and licences.scan(docs, {}).count() == 0


def test_licenses_standing_back_to_back(spark):
    names = ["MIT-grant", "GPL-header", "BSD-conditions", "Apache-2.0-header", "CC-BY-4.0-notice"]
    rows = [(i, " ".join([licences.TEMPLATES[n]] * 4)) for i, n in enumerate(names)]
    rows += [(10, " ".join(licences.TEMPLATES[n] for n in names)), (11, " ".join(licences.TEMPLATES[n] for n in reversed(names)))]
    got = licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "license").collect()
    assert by_row(map(tuple, got)) == by_row([(i, n) for i, n in enumerate(names) for _ in range(4)] + [(k, n) for k in (10, 11) for n in names])


def test_near_copies_of_a_table_are_found(spark):
    """Every pair of 0.8 and more among all texts of the table ends in one component."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    sets = {k: set(simhash.shingle_set(t.encode().lower(), 5).tolist()) for k, t in texts_of(docs)}
    holders = {}
    for k, held in sets.items():
        for h in held:
            holders.setdefault(h, []).append(k)
    common_ = {}
    for ids in holders.values():
        for i, a in enumerate(ids):
            for b in ids[i + 1 :]:
                common_[a, b] = common_.get((a, b), 0) + 1
    pairs = [(a, b) for (a, b), n in common_.items() if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n)]
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(docs).collect()}
    assert len(pairs) > 20 and sum(got[a] == got[b] for a, b in pairs) >= 0.98 * len(pairs)
    assert len(got) == docs.count()


def test_edited_licenses_are_found():
    """Words put in, changed or taken out; what exact containment of 0.8 accepts must nearly always be found."""
    rng = random.Random(21)
    index = licences.Licenses.of(licences.TEMPLATES)
    asked = found = 0
    for k, name in enumerate(index.names):
        words = licences.TEMPLATES[name].lower().replace(".", " ").replace(",", " ").split()
        for _ in range(40):
            edited = list(words)
            for _ in range(rng.randrange(1, 4)):
                at = rng.randrange(len(edited))
                edited[at : at + rng.randrange(2)] = [rng.choice(WORDS)] if rng.random() < 0.7 else []
            text = " ".join([prose(rng, 30), *edited, prose(rng, 30)]).encode()
            shingles = licences._shingles(licences.tokens([text], licences._CLASSES)[0])
            own = np.unique(index.shingles[k])
            if len(np.intersect1d(shingles, own)) >= 0.8 * len(own):
                asked += 1
                found += any(f[0] == k for f in index.scan(shingles))
    assert asked > 300 and found >= 0.97 * asked


def test_many_licenses_in_one_long_text(monkeypatch):
    index = licences.Licenses.of(licences.TEMPLATES)
    text = " filler ".join(licences.TEMPLATES[n].lower() for n in index.names * 30).encode()
    shingles = licences._shingles(licences.tokens([text], licences._CLASSES)[0])
    whole = index.scan(shingles)
    monkeypatch.setattr(licences, "SLICE", 64)
    assert index.scan(shingles) == whole and len(whole) == 30 * len(index.names)


def test_license_rows_equal_a_text_search(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    notices = {n: t.lower().rstrip(".") for n, t in licences.TEMPLATES.items() if len(t) < 80}
    want = sorted((k, n) for k, t in texts_of(docs) for n, s in notices.items() for _ in range(t.lower().count(s)))
    got = sorted(map(tuple, licences.scan(docs).where("containment = 1").select("doc_id", "license").collect()))
    assert [x for x in want if x not in got] == []


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(queries.ORACLES[name])
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns
    assert by_row(tuple(r) for r in got.select(columns).collect()) == by_row(want.select(*columns).fetchall())
