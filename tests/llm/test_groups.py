"""SimHash links, spelling variants and ranked search against plain versions."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidegate.llm import ranking, simhash, variants
from tidegate.llm.queries import op11_simhash, op12_variants, op13_ranking

SF_DIR = "/root/testdata/sf0.001"
LONG = "Wörter und words, " * 70_000
ODD = [(1, None), (2, ""), (None, "same words here again"), (3, "same words here again"),
       (3, "same words here again"), (4, " \t\n"), (5, LONG), (6, LONG), (7, "One"), (None, None),
       (8, "oNE"), (-9, "\x00 x \x0b y"), (10, "日本 日本 日本語"), (None, "alone here, quite alone")]
CLASHING = "doc_id long, text string, code long, node string, id int, word int, n int"


def low(value):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), value or "")


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x", 1, 2, 3) for r in rows], CLASHING).repartition(3)


def read(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def plain_fingerprint(value):
    words = re.findall(r"[^\x20\x09-\x0D]+", low(value))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or \
        ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64)
               if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    marks = [plain_fingerprint(t) for _, t in rows]
    codes = sorted(set(marks))
    root = {c: c for c in codes}

    def of(c):
        while root[c] != c:
            c = root[c]
        return c

    for i, a in enumerate(codes):
        for b in codes[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                root[of(b)] = of(a)
    first = {}
    for (i, _), c in zip(rows, marks):
        if i is not None:
            first[of(c)] = min(i, first.get(of(c), i))
    return sorted(((i, f"{c:016x}", first.get(of(c))) for (i, _), c in zip(rows, marks)), key=str)


@pytest.mark.parametrize("rows", [[], [(5, None)], ODD])
def test_simhash_of_odd_rows(spark, rows):
    got = simhash.near_components(frame(spark, rows))
    assert sorted(map(tuple, got.collect()), key=str) == plain_components(rows)


def test_simhash_of_documents(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, "documents").collect()]
    got = op11_simhash(spark, SF_DIR)
    assert sorted(map(tuple, got.collect()), key=str) == plain_components(rows)


def near_codes(seed, n):
    """Codes around a few centres, some within three bits of each other, and chains."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(5)]
    out = set()
    while len(out) < n:
        code = rng.choice(centres) if rng.random() < 0.8 else rng.getrandbits(64)
        for _ in range(rng.choice([0, 1, 2, 4, 6, 9])):
            code ^= 1 << rng.randrange(64)
        out.add(code)
    return sorted(out)


def joined(codes, links):
    root = {c: c for c in codes}

    def of(c):
        while root[c] != c:
            c = root[c]
        return c

    for a, b in links:
        root[max(of(a), of(b))] = min(of(a), of(b))
    return {c: of(c) for c in codes}


@pytest.mark.parametrize("fan", [2, 8])
def test_index_finds_all_links(fan):
    for seed, n in enumerate((1, 2, 9, 64, 700)):
        codes = near_codes(seed, n)
        index = simhash.GrayIndex(np.array(codes, np.uint64), simhash.Near(fan=fan))
        got = {frozenset((int(index.codes[x]), int(index.codes[y])))
               for a, b in index.links() for x, y in zip(a, b)}
        want = {frozenset((a, b)) for i, a in enumerate(codes) for b in codes[i + 1:]
                if (a ^ b).bit_count() <= 3}
        assert got == want


def test_index_leaves_groups_early(monkeypatch):
    """Random codes: nodes prune, so that far fewer nodes than pairs are looked at."""
    rng = np.random.default_rng(3)
    codes = np.unique(rng.integers(0, 1 << 63, 8192, np.uint64))
    index, seen = simhash.GrayIndex(codes), 0
    real = np.bitwise_count

    def counted(x):
        nonlocal seen
        seen += len(x)
        return real(x)

    monkeypatch.setattr(np, "bitwise_count", counted)
    assert not sum(len(a) for a, _ in index.links())
    assert seen < len(codes) ** 2 / 4


@pytest.mark.parametrize("rule", [simhash.Near(), simhash.Near(group=20, tile=60),
                                  simhash.Near(group=300, tile=90, most=2),
                                  simhash.Near(group=4, tile=1 << 16)])
def test_links_of_cut_and_uncut_nodes(spark, rule):
    codes = near_codes(11, 900)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    got = simhash.near_links(spark.createDataFrame([(c,) for c in signed], "code long"), rule)
    links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in got.collect()]
    want = [(a, b) for i, a in enumerate(codes) for b in codes[i + 1:]
            if (a ^ b).bit_count() <= rule.most]
    assert joined(codes, links) == joined(codes, want)


def plain_words(rows):
    total = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            word = low(run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % 31 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            total[word] += 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if a == b or len(a) - len(b) > 1:
        return False
    i = 0
    while i < len(b) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == (b[i + 1:] if len(a) == len(b) else b[i:])


def plain_variants(words):
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    form, count = {}, {}
    for w, n in words.items():
        near = [v for k in (len(w) - 1, len(w), len(w) + 1) for v in by_length.get(k, ())
                if one_edit(w, v)]
        count[w] = len(near)
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None

    def last(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted(((w, form[w], last(w), n, count[w], words.get(form[w]))
                   for w, n in words.items()), key=str)


def test_variants_of_documents(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, "documents").collect()]
    got = op12_variants(spark, SF_DIR)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_variants(plain_words(rows))


@pytest.mark.parametrize("rows", [[], ODD, [(3, "Straße STRAßE straßen, straßen×÷ aaaaaaaa"),
                                            (4, "a" * 3000 + " " + "a" * 3000 + " " + "a" * 2999),
                                            (4, "aaaaaaaa aaaaaaa aaaaaaa " + "a" * 2999)]])
def test_words_of_odd_rows(spark, rows):
    got = variants.variants(variants.thinned_words(frame(spark, rows)))
    assert sorted(map(tuple, got.collect()), key=str) == plain_variants(plain_words(rows))


@pytest.mark.parametrize(("tile", "rows"), [(1, 40), (8, 100), (10_000, 50_000)])
def test_each_near_pair_is_found_once(spark, tile, rows):
    rng = random.Random(tile)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(7, 10))): rng.choice([2, 9, 400])
             for _ in range(500)}
    words |= {"a" * n: n for n in range(7, 14)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got = variants.variants(frame, variants.Variants(tile=tile, rows=rows)).collect()
    assert sorted(map(tuple, got), key=str) == plain_variants(words)


def test_acceptor_is_minimal():
    machine = variants.Acceptor()
    machine.root(sorted(a + b for a in ("xa", "xb", "yc") for b in ("ing", "end")))
    # the end, two in each of both endings, where these begin, after x and after y, and the root
    assert len(machine.states) == 1 + 4 + 1 + 2 + 1


def plain_terms(value):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low(value))


def plain_ranking(docs, items, k=10):
    docs = [(i, Counter(plain_terms(t))) for i, t in docs]
    docs = [(i, c, c.total()) for i, c in docs if c]
    count, length = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in docs:
            m = 25 + 75 * n * count // length
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                        for t in plain_terms(text) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, r[3], -r[0]) for k, r in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def test_ranking_of_documents(spark):
    docs, items = ([tuple(r) for r in read(spark, t).select(i, "text").collect()]
                   for t, i in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert sorted(map(tuple, op13_ranking(spark, SF_DIR).collect()), key=str) \
        == plain_ranking(docs, items)


@pytest.mark.parametrize(("docs", "block"), [([], 1 << 20), (ODD, 1 << 20), (ODD, 30), (ODD * 3, 1)])
def test_ranking_of_odd_rows(spark, docs, block):
    items = [(1, "same words"), (1, "same words"), (2, None), (3, ""), (None, "one Wörter"),
             (4, "words words one here again x"), (5, "words words one here 日本 x"), (1, "other, und")]
    got = ranking.ranked_search(
        frame(spark, docs), spark.createDataFrame([(*i, 5) for i in items],
                                                  "item_id long, text string, item int"),
        rule=ranking.Rank(k=4, block_bytes=block))
    want = plain_ranking(docs, [i for n, i in enumerate(items) if i not in items[:n]], 4)
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_shared_parts_add_up_to_the_items():
    rng = random.Random(4)
    passages = [[rng.randrange(60) for _ in range(12)] for _ in range(6)]
    items = [Counter(rng.choice(passages) + rng.choice(passages)
                     + [rng.randrange(200) for _ in range(5)]) for _ in range(60)]
    shared = ranking.share(items)
    parts = [Counter({t: n}) for t, n in shared.base]
    for a, b in shared.sums:
        parts.append(parts[a] + parts[b])
    for item, own in zip(items, shared.items):
        assert sum((parts[p] for p in own), Counter()) == item
    assert shared.additions() < sum(len(i) - 1 for i in items) / 2
    done = set(range(len(shared.base)))
    for group in shared.levels():
        assert all(p in done for j in group for p in shared.sums[j])
        done |= {len(shared.base) + int(j) for j in group}
    assert len(done) == len(parts)


def test_results_do_not_depend_on_partitions(spark):
    docs = read(spark, "documents")
    for op in (simhash.near_components, lambda d: variants.variants(variants.thinned_words(d)),
               lambda d: ranking.ranked_search(d, read(spark, "benchmark"))):
        one, many = (op(d).agg(F.count(F.lit(1)), F.sum(F.hash(F.struct("*")).cast("long"))).first()
                     for d in (docs.coalesce(1), docs.repartition(9)))
        assert one == many
