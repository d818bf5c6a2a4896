"""Ranges of (doc_id, tie), rows of one doc_id over several of them, and tokenizers that do not split at white space."""

import json
import random
import zlib

import numpy as np
from tokenizers import Tokenizer, models, normalizers, pre_tokenizers

from tilescan.llm import op9_token_files, op10_sketch
from tilescan.llm.ranges import LEAST, Ranges


def test_places_are_in_order():
    rng = random.Random(3)
    cuts = sorted([5] * 4 + [LEAST] * 3 + [9, 12, 12, (1 << 63) - 1])
    ranges = Ranges(cuts)
    keys = sorted((rng.choice([LEAST, 4, 5, 6, 9, 12, 13, (1 << 63) - 1]), rng.randrange(LEAST, 1 << 63)) for _ in range(2000))
    ids, ties = (np.array([k[i] for k in keys], np.int64) for i in (0, 1))
    place = ranges.place(ids, ties)
    assert (np.diff(place) >= 0).all() and 0 <= place[0] and place[-1] < ranges.count
    assert len(set(place[ids == 5])) == 4 and len(set(place[ids == LEAST])) == 3
    assert (Ranges([]).place(ids, ties) == 0).all()


def one_id(spark, n=300):
    rng = random.Random(4)
    rows = [(7 if k % 3 else None if k % 2 else k, " ".join(rng.choice("abcdefg") * rng.randint(1, 5) for _ in range(rng.randint(0, 60)))) for k in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_one_id_fills_several_ranges(spark, tmp_path):
    rows, df = one_id(spark)
    manifest = op9_token_files.write(df, str(tmp_path), bytes_per_file=1000)
    assert manifest["n_parts"] > 10
    got = sorted(map(tuple, op9_token_files.read(spark, str(tmp_path)).collect()), key=lambda r: r[1])
    library = Tokenizer.from_file(op9_token_files.default_path())
    want = sorted((str(r[0]), zlib.crc32(np.array(library.encode(r[1], add_special_tokens=False).ids + [1], "<u4").tobytes())) for r in rows)
    assert sorted((str(r[0]), r[3]) for r in got) == want
    assert [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got)])[:-1].tolist()
    ids = [LEAST if r[0] is None else r[0] for r in got]
    assert ids == sorted(ids)


def test_edited_texts_of_one_id(spark):
    """Every document's next one is the same, whatever the ranges."""
    _, df = one_id(spark)
    whole, small = (sorted(map(tuple, op10_sketch.edited(df, bytes_per_range=size).collect()), key=str) for size in (1 << 30, 1000))
    assert whole == small and len(whole) == 300


def test_near_figures_are_exact_for_small_texts(spark):
    rng = random.Random(6)
    words = ["w%d" % k for k in range(40)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 90))) for _ in range(40)] + ["", "", "one"]
    texts[11] = texts[10]
    got = {r["doc_id"]: r for r in op10_sketch.edited(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}

    def shingles(text):
        w = text.lower().split()
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    def alike(a, b):
        a, b = shingles(a), shingles(b)
        return 1.0 if a == b else len(a & b) / len(a | b)

    for k, text in enumerate(texts):
        following = texts[k - 1] if k else texts[-1]
        n = len(text)
        new = text[: n - n // 2] + following[: n // 2]
        assert abs(got[k]["near_edited"] - alike(text, new)) < 1e-9 and abs(got[k]["near_next"] - alike(text, following)) < 1e-9
        mine = op10_sketch.sketch(op10_sketch.shingle_hashes(new.encode(), 5, {}))
        assert (op10_sketch.from_text(got[k]["edited_fingerprint"]) == mine).all()
    assert got[10]["fingerprint"] == got[11]["fingerprint"]


def made_tokenizer(path, whole):
    vocabulary = {c: k for k, c in enumerate(["[UNK]", "a", "b", "ab", " ", "b a", "c"])}
    t = Tokenizer(models.WordLevel(vocabulary, unk_token="[UNK]")) if not whole else Tokenizer(models.BPE({"a": 0, "b": 1, "ab": 2, " ": 3, "b ": 4, "b a": 5, "c": 6}, [("a", "b"), ("b", " "), ("b ", "a")]))
    if not whole:
        t.pre_tokenizer = pre_tokenizers.Whitespace()
        t.normalizer = normalizers.Lowercase()
    t.save(str(path))
    return str(path)


def test_tokenizers_that_span_white_space_get_whole_texts(spark, tmp_path):
    texts = ["ab a b", "b a", "", "c b a\nab", None]
    for whole in (False, True):
        path = made_tokenizer(tmp_path / f"{whole}.json", whole)
        library = Tokenizer.from_file(path)
        with open(path) as f:
            assert op9_token_files.by_words(json.load(f), library) is not whole
        op9_token_files.write(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), str(tmp_path / f"out{whole}"), path=path)
        got = {r["doc_id"]: r["ids_crc32"] for r in op9_token_files.read(spark, str(tmp_path / f"out{whole}")).collect()}
        assert got == {k: zlib.crc32(np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes()) for k, t in enumerate(texts)}
