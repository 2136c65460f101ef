"""Top-k search, archives, url rules, near copies, components and the registered SQL."""

import hashlib
import math
import random
import re
import time
from collections import defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import components, jaccard, queries, topk, url_trie, warc
from tidegate.llm.jaccard import Similar
from tidegate.llm.topk import Search
from tidegate.operators import running
from tidegate.session import scratch_path
from tools.check_oracle import canonical

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="tables are not there")
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_gives_what_its_sql_gives(spark, name):
    db = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    got = queries.QUERIES[name](spark, SF_DIR).toArrow().to_pandas(integer_object_nulls=True)
    want = db.sql(queries.ORACLE[name]).to_arrow_table().to_pandas(integer_object_nulls=True)
    assert canonical(got) == canonical(want)


def plain_top(rows, k):
    cells = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    found = defaultdict(list)
    for i, q in cells:
        if i % 20 == 0:
            found[i] += [(-sum(a * b for a, b in zip(q, c)), j) for j, c in cells if j != i]
    return sorted((i, r + 1, j, -s) for i, own in found.items()
                  for r, (s, j) in enumerate(sorted(own)[:k]))


@pytest.mark.parametrize("case", ["random", "ties", "odd", "empty", "large", "lengths", "copies"])
def test_top_k(spark, case):
    rng = np.random.default_rng(4)
    rows = {"random": [(i, rng.normal(0, 0.3, 8).tolist()) for i in range(300)],
            "ties": [(i, [0.5, -0.5] if i % 3 else [1.0, 0.0]) for i in range(200)],
            "odd": [(0, [1.0, 2.0]), (20, None), (40, [1.0, None]), (None, [1.0, 1.0]), (60, []),
                    (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [3.0]),
                    (8, [1.0, 2.0, 3.0]), (8, [1.0, 2.0, 3.0]), (0, [-1.0, 0.5])],
            "empty": [],
            "large": [(i, [float(x) * 1e6 for x in rng.normal(0, 1, 4)]) for i in range(90)],
            "lengths": [(i, (rng.normal(0, 1, 8) * 2.0 ** (i % 9 - 4)).tolist())
                        for i in range(300)],
            "copies": [(i, (np.eye(6)[i % 6] * 3 + rng.normal(0, 0.02, 6)).tolist())
                       for i in range(300)]}[case]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn(
        "block", F.lit("x")).repartition(3)
    vectors = topk.integer_vectors(frame, "vec_id", "embedding")
    got = topk.top_k(vectors, F.col("id") % 20 == 0, Search(5, 3, 16, 4)).collect()
    assert sorted(map(tuple, got)) == plain_top(rows, 5)


def test_many_rules_on_a_host_cost_few_looks():
    rules = [url_trie.Rule("Example.NET", f"/user{i}", "block") for i in range(50_000)]
    trie = url_trie.build([*rules, url_trie.Rule("example.net", "/user7", "allow")])
    node = trie["labels"]["net"]["labels"]["example"]["paths"]["segments"][""]
    assert len(node["ends"]) == 50_000 and node["sizes"] == [9, 8, 7, 6, 5]
    assert url_trie.lookup(trie, "a.example.net", "/user499990/x") == (
        "example.net/user49999", "block")
    assert url_trie.lookup(trie, "example.net", "/user7") == ("example.net/user7", "block")
    assert url_trie.lookup(trie, "example.net", "/use") is None
    with pytest.raises(ValueError):
        url_trie.build([url_trie.Rule("a", "/" + "x" * url_trie.MAX_BYTES, "block")])


def test_top_k_leaves_out_what_cannot_reach_the_cutoff():
    rng, search = np.random.default_rng(5), Search(3, 4, 64, 8)
    cells = rng.integers(-9, 10, (64, 16)) + 200 * np.eye(16, dtype=int)[np.arange(64) % 16]
    asked = cells[:8].astype(np.int16)
    scores = asked.astype(np.int64) @ cells.T
    cuts = np.sort(scores, axis=1)[:, -4].copy()
    tile = topk._Tile({"q_ids": np.arange(8).tobytes(), "q_dims": 16, "q_cells": asked.tobytes(),
                       "c_ids": np.arange(64).tobytes(), "c_dims": 16, "cuts": cuts.tobytes(),
                       "c_cells": cells.astype(np.int16).tobytes()}, search.slices)
    scored = []
    exact = tile.exact
    tile.exact = lambda q, at, first=0: scored.append((len(at), first)) or exact(q, at, first)
    query, at, score = topk._collected(search)(tile)
    assert sorted(zip(query, at, score)) == [
        (q, c, scores[q, c]) for q in range(8) for c in range(64) if scores[q, c] >= cuts[q]]
    [(pairs, first)] = scored
    assert pairs < 8 * 64 / 8 and first < search.slices
    length = np.linalg.norm(cells.astype(float), axis=1)
    assert (topk._needed(cuts, length[:8]) <= length.max()).all()
    assert (topk._needed(cuts * 9, length[:8]) > length.max()).all()


def test_archives_come_back(spark):
    big = "<p>é" * 60_000
    rows = [(5, "http://a/ b\r\nX: y", big), (3, "http://b/", big), (9, None, big), (1, "u", "s"),
            (2, "u", "s"), (4, "u", None), (6, "u", ""), (None, "u", big), (7, "u", "\r\n" * 200),
            (3, "http://b/", big), (8, "u", "WARC/1.1\r\n\r\n" * 20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn(
        "digest", F.lit(1)).repartition(3)
    folder = scratch_path(spark, "warc-test")
    typed = warc.with_record_types(pages)
    manifest = warc.write_archives(warc.chunk_rows(typed, 1000), folder, file_bytes=1000)
    assert manifest.count() >= 2
    chunks = warc.read_archives(spark, manifest, folder, 700).collect()
    assert max(len(c.data) for c in chunks) <= 700
    blocks = defaultdict(bytes)
    for c in sorted(chunks, key=lambda c: (c.file, c.at, c.chunk_no)):
        blocks[c.file, c.at] += c.data
        assert c.digest == hashlib.sha256(blocks[c.file, c.at]).hexdigest()
    found = warc.records(warc.read_archives(spark, manifest, folder)).collect()
    want = []
    for i, _, html in rows:
        raw = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == raw and j is not None]
        revisit = len(raw) >= 100 and i != min(same)
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(),
                     "revisit" if revisit else "response", min(same) if revisit else None, True))
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)


def test_shared_digests_in_a_long_list(spark, monkeypatch):
    rows = [(i, "u", "x" * (100 + i % 7)) for i in range(40)] + [(99, "u", "y" * 200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    small = warc.with_record_types(pages)
    plan = small._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan
    want = sorted(map(tuple, small.collect()), key=str)
    assert sum(r[5] == "response" for r in want) == 8
    monkeypatch.setattr(running, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, warc.with_record_types(pages).collect()), key=str) == want


def test_no_pages_no_archives(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(warc.chunk_rows(warc.with_record_types(pages)), folder)
    assert warc.records(warc.read_archives(spark, manifest, folder)).count() == 0


def plain_verdict(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host) or not r.host)
           and path.startswith(r.path)]
    best = max(fit, key=lambda r: (r.host.count(".") + bool(r.host), len(r.path),
                                   r.verdict == "block"), default=None)
    return (host, path, best and best.host + best.path, best.verdict if best else default)


def test_url_rules(spark):
    rng = random.Random(8)
    hosts = ["a", "b.a", "c.b.a", "b", "x.b", "", "a.a"]
    paths = ["", "/", "/x", "/x/", "/x/y", "/xy/", "/x//"]
    rules = [url_trie.Rule(rng.choice(hosts), rng.choice(paths), rng.choice(["allow", "block"]))
             for _ in range(25)]
    urls = [None, "", "no scheme", "http://", "://", "HTTP://B.A", "http://b.a/x/y?q#f", "a://a#/x",
            "http://c.B.a/x//y", "http://x/://b.a/", "http://é.b/xy/z", "http://b.a\n/x/\ny",
            "http://.a/x/", "http://a./x", "http://b.a/" + "x/" * 50_000,
            *(f"s://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', 'z', '?a', '#/x'])}"
              for _ in range(200))]
    for chosen in (queries.URL_RULES, rules, []):
        pages = spark.createDataFrame([(i, u, 1, 2) for i, u in enumerate(urls)],
                                      "page_id long, url string, host int, rule int")
        got = {r.page_id: tuple(r)[1:] for r in
               url_trie.filter_urls(pages, chosen, keep=("page_id",)).collect()}
        assert got == {i: plain_verdict(u, chosen) for i, u in enumerate(urls)}
    assert url_trie.filter_urls(pages.limit(0), rules, keep=("page_id",)).count() == 0


def groups_of(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        parent[root(a)] = root(b)
    out = defaultdict(set)
    for n in nodes:
        out[root(n)].add(n)
    return {frozenset(g) for g in out.values()}


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(i * 7919 % 1009, (i + 1) * 7919 % 1009) for i in range(60)],
    [(0, i) for i in range(1, 50)] + [(100, 101), (101, 100), (100, 101)]])
def test_components(spark, links):
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    got = defaultdict(set)
    for r in found:
        got[r.root].add(r.node)
    assert {frozenset(g) for g in got.values()} == groups_of({x for p in links for x in p}, links)
    assert all(root in group for root, group in got.items())


def plain_groups(rows, percent=75):
    sets = []
    for _, value in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+",
                         re.sub("[A-Z]+", lambda m: m[0].lower(), value or ""))
        sets.append({tuple(own[i:i + 5]) for i in range(len(own) - 4)} if len(own) > 4 else
                    {tuple(own)} if own else set())
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    out = []
    for group in groups_of(range(len(rows)), links):
        low = min((rows[x][0] for x in group if rows[x][0] is not None), default=None)
        out += [(rows[x][0], len(sets[x]), low) for x in group]
    return sorted(out, key=str)


def near_copies(seed, count):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    shared = [rng.choice(words) for _ in range(12)]
    base = [[rng.choice(words) for _ in range(rng.randint(1, 60))] for _ in range(count // 6)]
    out = []
    for i in range(count):
        own = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            own[rng.randrange(len(own))] = rng.choice(words)
        out.append((i, " ".join(own + (shared if rng.random() < 0.5 else []))))
    return out


ODD_ROWS = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "a b c d e"),
            (7, "A b\tc d  e"), (8, "a b c d e f"), (None, "a b c d e"), (9, "x " * 50_000),
            (10, "X " * 4000), (4, "one"), (11, None), (None, None), (6, "other words of id six")]


@pytest.mark.parametrize(("rows", "rule"), [
    (near_copies(1, 90), Similar()),
    (near_copies(2, 120), Similar(few=2, tile=3, frequent=4)),
    (near_copies(3, 120), Similar(few=3, tile=2, frequent=0, broadcast_rows=0)),
    (near_copies(4, 150), Similar(few=1, tile=4, frequent=8)),
    (near_copies(5, 150), Similar(few=2, tile=50, tile_keys=60, hot=2, salts=3)),
    (near_copies(6, 120), Similar(few=3, tile=3, hot=4, salts=5, broadcast_rows=0)),
    (ODD_ROWS, Similar()), ([], Similar())])
def test_near_copies(spark, rows, rule):
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows],
                                 "doc_id long, text string, node int, n int").repartition(3)
    got = jaccard.jaccard_components(docs, rule=rule)
    found = sorted((tuple(r)[:3] for r in got.collect()), key=str)
    want = plain_groups(rows)
    # an empty set is a component of its own row
    assert found == sorted(((i, n, c if n else i) for i, n, c in want), key=str)
    if rows and rows is not ODD_ROWS and rule == Similar():
        kept = sorted(r.doc_id for r in jaccard.one_of_each(docs).collect())
        assert kept == sorted({c for _, _, c in want})


def test_hot_shingles_are_counted_in_parts(spark, tmp_path):
    rule = Similar(few=2, hot=3, salts=4)
    rows = [(t, 100 * t + i, 5) for t in range(-9, 6) for i in range(abs(t) + 1)]
    postings = spark.createDataFrame(rows, "token long, node long, n long")

    def found(hot, name):
        met = jaccard._meetings(postings, rule, hot, str(tmp_path / name)).collect()
        return sorted((r.token, r.node, r.n, r.sets,
                       [x.node for x in r.before] if r.sets <= rule.few else None) for r in met)

    whole = found(None, "whole")
    assert whole and whole == found(-20, "all") == found(-4, "some")
    largest = (spark.read.parquet(str(tmp_path / "all" / "parts")).where("part >= 0")
               .groupBy("token", "part").count().agg({"count": "max"}).first()[0])
    assert largest < 10


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return set(re.findall(r"shuffle_\w+[.]data", blocks.getAllFiles().mkString(" ")))


def test_shuffle_files_go_with_their_jobs(spark):
    docs = spark.createDataFrame(near_copies(7, 60), "doc_id long, text string").repartition(3)
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own, before = spark.conf.get(setting), shuffle_files(spark)
    got = jaccard.jaccard_components(docs)
    end = time.time() + 20
    while shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(setting) == own
    assert got.count() == 60


def test_copies_are_left_out_without_shuffling_texts(spark):
    docs = spark.createDataFrame([(i, f"text number {i % 3}") for i in range(30)]
                                 + [(None, "text number 0"), (None, "a text without an id")],
                                 "id long, text string")
    members = spark.createDataFrame(
        [(r.id, 1, len(r.text) * 10 + ord(r.text[-1])) for r in docs.collect()],
        "id long, n long, node long")
    classes = members.groupBy("node").agg(F.max("n").alias("n"), F.min("id").alias("class_id"),
                                          F.max("id").alias("last"))
    for most, nulls in ((100, 2), (10, 2), (2, 2)):
        once = jaccard._once(docs, classes, members, Similar(broadcast_rows=most))
        assert sorted(r.id for r in once.collect() if r.id is not None) == [0, 1, 2]
        assert once.where("id is null").count() == nulls
        plan = once._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_few_sets_of_a_shingle_are_stored_once(spark, tmp_path):
    rule = Similar(few=6)
    rows = [(t, 100 * t + i, 5) for t in range(1, 10) for i in range(t)]
    postings = spark.createDataFrame(rows, "token long, node long, n long")
    met = jaccard._meetings(postings, rule, None, str(tmp_path / "lists"))
    assert met.count() == len(rows) - 1
    assert spark.read.parquet(str(tmp_path / "lists" / "meetings")).count() == 5 + 7 + 8 + 9


def test_sets_of_a_component_are_not_paired_again(spark, monkeypatch):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(4000)]
    base = [rng.choice(words) for _ in range(200)]
    rows = []
    for i in range(14):
        own = list(base)
        own[rng.randrange(200)] = rng.choice(words)
        rows.append((i, " ".join(own)))
    found, counted = [], jaccard._counted_pairs

    def spy(*args):
        out = counted(*args)
        found.append(out.count())
        return out
    monkeypatch.setattr(jaccard, "_counted_pairs", spy)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.jaccard_components(docs)
    assert sorted((tuple(r)[:3] for r in got.collect()), key=str) == plain_groups(rows)
    assert found == [0]  # of 91 pairs


def test_trees_are_compared_in_rounds(spark, monkeypatch):
    rows, rounds, compared = near_copies(9, 150), [], jaccard._compared

    def spy(*args):
        rounds.append(1)
        return compared(*args)
    monkeypatch.setattr(jaccard, "_compared", spy)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for most in (1 << 20, 0):
        got = jaccard.jaccard_components(docs, rule=Similar(
            few=2, tile=3, round_keys=1, broadcast_rows=most))
        found = sorted((tuple(r)[:3] for r in got.collect()), key=str)
        assert found == sorted(((i, n, c if n else i) for i, n, c in plain_groups(rows)), key=str)
    assert len(rounds) > 4


def test_tiles_that_meet_each_other_grow(spark):
    sizes = spark.createDataFrame([(100, 1000), (4096, 1 << 21), (1 << 16, 1 << 24),
                                   (1 << 16, 1 << 30)], "sets long, keys long")
    tiles = sizes.select(jaccard._paired_tiles(Similar(), F.col("sets"), F.col("keys")))
    assert [r[0] for r in tiles.collect()] == [1, 32, 32, 512]


def test_tiles_are_cut_by_shingles(spark):
    pairs = spark.createDataFrame([(0, i, 1000) for i in range(1, 101)]
                                  + [(200, i, 10) for i in range(201, 251)],
                                  "pivot long, node long, n long")
    places = jaccard._stars(pairs, Similar(tile=100, tile_keys=10_000)).toPandas()
    tiles = places.groupby("block").tile.nunique()
    assert (tiles[0], tiles[200]) == (10, 1)
    assert len(places) == 150 + 11
    beside = places[places.node == places.block].groupby("block").tile.nunique()
    assert (beside == tiles).all()


def test_trees_compare_long_sets():
    rng = np.random.default_rng(8)
    base = np.unique(rng.integers(0, 1 << 62, 60_000).astype(np.uint64))
    sets = []
    for share in (0.5, 0.7, 0.84, 0.86, 0.9, 0.95, 1.0):
        own = base[rng.random(len(base)) < share]
        extra = rng.integers(0, 1 << 62, int(len(base) * (1 - share) / 2)).astype(np.uint64)
        sets += [np.unique(np.concatenate((own, extra))), own]
    rule = Similar()
    tree = jaccard.Tree(sets, rule)
    n = len(sets)
    got = {frozenset((x, y)) for x in range(n) for y in tree.partners(x, lambda y: True)}
    assert got == {frozenset((x, y)) for x in range(n) for y in range(x) if rule.linked(
        len(np.intersect1d(sets[x], sets[y])), len(sets[x]), len(sets[y]))}
    assert 0 < len(got) < n * (n - 1) // 2


def test_trees_find_every_pair():
    rng = random.Random(6)
    rule = Similar(percent=60)
    for _ in range(30):
        sets = [np.array(sorted(rng.sample(range(12), rng.randint(1, 9))), np.uint64)
                for _ in range(25)]
        tree = jaccard.Tree(sets, rule)
        got = {frozenset((x, y)) for x in range(25) for y in tree.partners(x, lambda y: True)}
        want = {frozenset((x, y)) for x in range(25) for y in range(x) if rule.linked(
            len(np.intersect1d(sets[x], sets[y])), len(sets[x]), len(sets[y]))}
        assert got == want
