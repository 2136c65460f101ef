"""Fingerprints, shingles, BPE and token counts against plain versions."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from tidegate.llm import bpe, text, tokens, winnowing
from tidegate.llm.winnowing import Winnow

LONG = "word " * 40_000 + "é" * 3000
ODD = ["", " ", "  a  b ", "\n\n a\tb \n", "it's I'LL we've", "x<|endoftext|> y<|endoftext|>",
       "日本語 テスト 12 ३४ 😀😀", "a" * 3000, "ab" * 600 + " " + "é" * 700, "x\u00a0\u3000 y\u2003z",
       "a\x1cb \x1c c", " a", "a ", "\x00", "!" * 600, "▁a ▁ ▁▁b"]


def plain_fingerprint(value, rule):
    grams = [value[i:i + rule.k] for i in range(max(1, len(value) - rule.k + 1))] if value else []
    hashes = {g: winnowing.choose(g, Winnow(len(g), 1))[0] >> np.uint64(32) for g in set(grams)}
    window = min(rule.window, len(grams))
    out = []
    for a in range(len(grams) - window + 1 if grams else 0):
        at = min(range(a, a + window), key=lambda i: (hashes[grams[i]], -i))
        if not out or out[-1][1] != at:
            out.append((int(hashes[grams[at]]), at))
    return out


@pytest.mark.parametrize("rule", [Winnow(4, 5), Winnow(3, 1), Winnow(5, 8)])
def test_chosen_hashes_are_those_of_the_plain_version(rule):
    rng = random.Random(5)
    for n in [0, 1, 2, 3, 4, 5, 9, 12, 13, 60, 200]:
        value = "".join(rng.choice("abé😀") for _ in range(n))
        got = [(int(x) >> 32, int(x) & 0xFFFFFFFF) for x in winnowing.choose(value, rule)]
        assert got == plain_fingerprint(value, rule)
        assert winnowing.from_text(winnowing.to_text(winnowing.choose(value, rule))).tolist() \
            == winnowing.choose(value, rule).tolist()


def test_shared_passages_share_a_hash():
    rng, rule = random.Random(7), Winnow(8, 12)
    passage = "".join(rng.choice("abcdefgh") for _ in range(rule.k + rule.window - 1))
    for _ in range(20):
        a, b = ("".join(rng.choice("xyz") for _ in range(rng.randint(0, 90))) for _ in range(2))
        pairs = winnowing.matches(winnowing.choose(a + passage, rule),
                                  winnowing.choose(b + passage, rule))
        assert any(i >= len(a) and i - len(a) == j - len(b) for i, j in pairs)


def test_short_texts_share_hashes_with_their_edited_form():
    """Half of a text of at least 46 code points stays: 23 in a row share a hash."""
    rng, rule = random.Random(9), Winnow()
    assert rule.k + rule.window - 1 <= 23
    for n in range(46, 180):
        value, after = ("".join(rng.choices("abcdefghij klmno", k=n)) for _ in range(2))
        edited = value[:n - n // 2] + after[:n // 2]
        assert winnowing.likeness(winnowing.choose(value, rule), winnowing.choose(edited, rule)) > 0


def plain_edits(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for (i, value), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(value) // 2
        yield i, value, value[:len(value) - half] + after[:half], after


@pytest.mark.parametrize("rows", [
    [], [(3, "abcdef")], [(3, None)],
    [(i, t) for i, t in enumerate([*ODD, None, LONG, "same", "same"])],
    [(None, "first"), (None, None), (7, "x"), (7, "x"), (7, "longer one"), (-4, "é" * 50)]])
def test_edited_fingerprints(spark, rows):
    docs = spark.createDataFrame([(*r, "e", 1) for r in rows],
                                 "doc_id long, text string, bucket string, guest int")
    got = sorted(map(tuple, winnowing.edited_fingerprints(docs.repartition(3)).collect()), key=str)
    want, rule = [], Winnow()
    for i, value, edited, after in plain_edits(rows):
        marks = [winnowing.choose(t, rule) for t in (value, edited, after)]
        sets = [{h for h, _ in plain_fingerprint(t, rule)} if len(t) < 3000 else
                {int(x) >> 32 for x in m} for t, m in zip((value, edited, after), marks)]
        near = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        want.append((i, len(value), hashlib.sha256(edited.encode()).hexdigest(),
                     *map(winnowing.to_text, marks[:2]), *near))
    assert got == sorted(want, key=str)


def test_shingles_are_distinct_word_runs():
    rng = random.Random(11)
    texts = ["", None, " \t\n", "One", "one two", "A b c d e", "a B c\x0bd e",
             *(" ".join(rng.choice("aAbcÉé") * rng.randint(1, 3) for _ in range(rng.randint(0, 90)))
               for _ in range(60)), "x y " * 120_000]
    found = []
    for _, data, offsets in text.blocks(pa.array(texts, pa.string())):
        hashes, _, _, starts, _ = text.words(data, offsets)
        found += list(text.shingles(hashes, starts, 5))
    numbers, names = {}, {}
    for value, hashes in zip(texts, found, strict=True):
        low = re.sub("[A-Z]+", lambda m: m[0].lower(), value or "")
        own = re.findall(r"[^\x20\x09-\x0D]+", low)
        want = {tuple(own[i:i + 5]) for i in range(len(own) - 4)} if len(own) > 4 else \
            {tuple(own)} if own else set()
        assert len(hashes) == len(want) and (np.diff(hashes.astype(float)) > 0).all()
        key = tuple(hashes.tolist())
        assert numbers.setdefault(key, want) == want
        assert names.setdefault(frozenset(want), key) == key


@pytest.fixture(scope="module")
def byte_bpe():
    path = public_tokenizers.path("byte_bpe_50k.json")
    return path, Tokenizer.from_file(path)


def test_bpe_is_that_of_the_library(spark, byte_bpe):
    path, library = byte_bpe
    rng = random.Random(3)
    texts = [*ODD, LONG, *("".join(rng.choice("ab 'sé\n1!<|endoftext|>") for _ in range(80))
                           for _ in range(200))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, None), (2, texts[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    model = bpe.Bpe(spark, path)
    for row in docs.select("text", model.round_trip(F.col("text")).alias("bpe"),
                           model.encode(F.col("text")).alias("ids")).collect():
        want = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.ids == want == row.bpe.ids
        assert row.bpe.decoded == library.decode(want, skip_special_tokens=False)


def test_bpe_cuts_every_character_as_the_library_does(byte_bpe):
    path, library = byte_bpe
    every = [c for c in range(0x40000) if not 0xD800 <= c < 0xE000]
    low, high = [c for c in every if c < 0x20000], every[0x20000::37]
    texts = [form.format(chr(c), chr(c)) for c in low + high
             for form in ("{}'s {}!a", "1{} {}x")]
    got = bpe.encode_texts(texts, bpe.load(path))
    want = library.encode_batch(texts, add_special_tokens=False)
    assert all(np.frombuffer(g, np.int32).tolist() == w.ids for g, w in zip(got, want))


def test_bpe_decodes_any_ids(spark, byte_bpe):
    path, library = byte_bpe
    lists = [[], [50256], [0, 1, 2], [164, 240, 50256, 255], list(range(0, 50257, 13))]
    rows = spark.createDataFrame([(x,) for x in [*lists, None]], "ids array<int>")
    got = [r[0] for r in rows.select(bpe.Bpe(spark, path).decode(F.col("ids"))).collect()]
    assert got == [library.decode(x, skip_special_tokens=False) for x in lists] + [""]


def test_one_tree_and_many_trees_agree(byte_bpe):
    vocab, rng = bpe.load(byte_bpe[0]), random.Random(2)
    raw = ["".join(rng.choice("aehint ") for _ in range(n)).encode() for n in range(1, 200)]
    many = bpe.merge_many(raw, vocab)
    for value, ids in zip(raw, many):
        alone = bpe.merge_one(vocab.first[np.frombuffer(value, np.uint8)], vocab)
        assert alone.tobytes() == ids


def test_token_counts_are_those_of_the_library(spark):
    pieces = tokens.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    library = Tokenizer(models.Unigram(pieces.pieces, 0, True))
    library.pre_tokenizer = pre_tokenizers.Metaspace()
    rows = [(i, t) for i, t in enumerate([*ODD, LONG, None, "same", "same"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = docs.select("text", tokens.Counter(spark, pieces).count(F.col("text"))).collect()
    for value, n in got:
        assert n == len(library.encode(value or "", add_special_tokens=False).ids)


def test_columns_of_empty_and_odd_tables(spark, byte_bpe):
    pieces = tokens.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    names = ["ids", "bpe", "decoded", "n_tokens", "Text_"]
    rows = [(1, "same text", *range(5)), (1, "same text", *range(5)), (None, None, *range(5))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(
        f"`{n}` int" for n in names))
    model, counter = bpe.Bpe(spark, byte_bpe[0]), tokens.Counter(spark, pieces)
    for frame in (docs, docs.limit(0)):
        got = frame.select("*", model.encode(F.col("text")).alias("x"),
                           counter.count(F.col("text")).alias("y")).collect()
        assert len(got) == frame.count() and all(tuple(r[2:7]) == tuple(range(5)) for r in got)
        found = {(r.text, tuple(r.x), r.y) for r in got}
        assert len(found) == (2 if got else 0) and (not got or (None, (), 0) in found)


@pytest.mark.parametrize("seed", range(12))
def test_ties_and_unknown_characters(seed):
    rng = random.Random(seed)
    words = sorted({"".join(rng.choice("abcdé日▁") for _ in range(rng.randint(1, 4)))
                    for _ in range(30)})
    vocab = [("<unk>", 0.0), *((w, float(-rng.randint(1, 4))) for w in words)]
    if seed % 4 == 0:
        vocab += [(f"<0x{b:02X}>", -5.0) for b in range(256)]
    mine = tokens.Pieces(vocab, seed % 2 == 0)
    library = Tokenizer(models.Unigram(vocab, 0, seed % 2 == 0))
    library.pre_tokenizer = pre_tokenizers.Metaspace()
    texts = ["".join(rng.choice("abcdé日😀 ▁") for _ in range(rng.randint(0, 25)))
             for _ in range(150)]
    assert mine.counts(texts) == [len(library.encode(t, add_special_tokens=False).ids)
                                  for t in texts]
