"""Brute-force versions of operators 5, 7 and 8, and cases of operator 6 and of the pipeline's stages."""

import itertools
import random

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from tilescan.llm import op2_html, op4_bpe, op5_mixing, op6_toxicity, op7_token_counts, op8_license

WEIGHTS = {"lang": {"en": 0.5, "de": 0.3}}


def corpus(n=150, seed=2):
    rng = random.Random(seed)
    rows = [(k, " ".join("w" for _ in range(rng.choice([0, 1, 3, 9, 30]))), rng.choice(["en", "de", "fr", None]), rng.choice(["src1", "src2", "src5", None]), rng.randint(0, 40)) for k in range(n)]
    return [*rows, rows[3], rows[4], (None, "a b c", "en", "src1", 2), (None, "a b", "en", "src1", 2), (7000, None, "en", "src1", None)]


@pytest.mark.parametrize("fraction,epochs,tokens", [(0.5, 1, None), (1.0, 2, None), (1.3, 3, "size"), (None, 1, None)])
def test_chosen_documents(spark, fraction, epochs, tokens):
    """Each leaf takes whole epochs, then of one more the documents in the order of the seed while their tokens fit; documents of
    one place (one doc_id, or none) go together."""
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string, size int")
    got = op5_mixing.mixed(docs, fraction, epochs, 17, WEIGHTS, tokens=tokens)
    places = docs.select("doc_id", *(op5_mixing._place(17, F.lit(e)).alias(f"e{e}") for e in range(epochs + 1))).distinct().collect()
    order = {r["doc_id"]: [r[f"e{e}"] for e in range(epochs + 1)] for r in places}
    rows = got.collect()
    assert len(rows) == len(corpus())
    leaves = {}
    for r in rows:
        leaves.setdefault((r["domain"], r["lang"], r["source"]), []).append(r)
    for part in leaves.values():
        size = {}
        for r in part:
            size[r["doc_id"]] = size.get(r["doc_id"], 0) + r["n_words"]
        total, budget = sum(size.values()), part[0]["budget"]
        whole = int((budget + 1e-6) // total) if total else 0
        room, taken = int(budget + 1e-6) - whole * total, set()
        for d in sorted(size, key=lambda d: order[d][whole]):
            if size[d] > room:
                break
            room -= size[d]
            taken.add(d)
        for r in part:
            want = min(epochs, whole + (r["doc_id"] in taken))
            assert r["n_copies"] == want, (dict(r.asDict()), whole, budget, total)
    assert sum(r["n_copies"] for r in rows) > 0


def test_fair_total(spark):
    totals = spark.createDataFrame([("d", "en", 100), ("d", "de", 30), ("e", "en", 50), ("e", "fr", 7)], "domain string, lang string, tokens long")
    assert op5_mixing.fair_total(totals, WEIGHTS, 1) == 30 * 0.8 / 0.3
    assert op5_mixing.fair_total(totals, {}, 2) == 374
    assert op5_mixing.fair_total(totals.limit(0), WEIGHTS, 1) == 0


@pytest.fixture(scope="module")
def bpe():
    path, pattern = op4_bpe.default_vocabulary()
    with open(path, "rb") as f:
        ranks = op4_bpe.Vocabulary(op4_bpe.read_ranks(f.read())).ranks
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def brute_counts(library, text, bounds, rule):
    """Character by character: which characters does each token have a byte of, and which section is each of them in?"""
    owner = [i for i, c in enumerate(text) for _ in c.encode()]
    section = [sum(c >= b for b in bounds[1:-1]) for c in range(len(text))]
    counts, at = [0.0] * (len(bounds) - 1), 0
    for token in library.encode_ordinary(text):
        n = len(library.decode_single_token_bytes(token))
        chars = list(range(owner[at], owner[at + n - 1] + 1))
        at += n
        inside = [section[c] for c in chars]
        if rule == "first":
            counts[inside[0]] += 1
        elif rule == "majority":
            counts[max(sorted(set(inside)), key=lambda s: (inside.count(s), -s))] += 1
        else:
            for s in inside:
                counts[s] += 1 / len(inside)
    return counts


@pytest.mark.parametrize("rule", op7_token_counts.RULES)
def test_token_counts_by_character(spark, bpe, rule):
    rng = random.Random(5)
    letters = ["the ", "é", "中", "🙂", "\n", "\n\n", " x", "tokens", ".", "  ", "a\n"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) for _ in range(60)] + [None, "", "\n", "no line end"]
    rows = [(k, t, "s" if k % 3 else None) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in op7_token_counts.section_tokens(docs, rule=rule).collect()}
    for k, text, _ in rows:
        text = text or ""
        starts = [0] + [i + 1 for i, c in enumerate(text) if c == "\n" and i + 1 < len(text)] if text else []
        want = brute_counts(bpe, text, [*starts, len(text)], rule) if text else []
        assert np.allclose(got[k]["section_tokens"], want) and got[k]["n_sections"] == len(want)
    by_field = {r["doc_id"]: r for r in op7_token_counts.field_tokens(docs, ["source", "text"], " | ", rule=rule).collect()}
    for k, text, source in rows:
        whole = (source or "") + " | " + (text or "")
        want = brute_counts(bpe, whole, [0, len(source or "") + 3, len(whole)], rule)
        assert np.allclose([by_field[k]["tokens"]["source"], by_field[k]["tokens"]["text"]], want)
    assert op7_token_counts.section_tokens(docs.limit(0)).count() == op7_token_counts.field_tokens(docs.limit(0), ["text"]).count() == 0


def test_licences_that_differ_in_a_word():
    index = op8_license.Index(op8_license.TEMPLATES)
    named = lambda text: [m[0] for m in op8_license.scan(index, text, {})]
    assert named("It is licensed under the GNU Lesser General Public License, version 3.") in ([], ["LGPL-3.0"])
    assert named("This work is licensed under the GNU General Public License, version 1.") == ["GPL-1.0"]
    assert named("This work is licensed under the GNU General Public License, version 9.") == []
    assert named("Licensed under CC BY-ND 4.0.") == ["CC-BY-ND-4.0"] and named("Licensed under CC BY 4.0.") == ["CC-BY-4.0"]
    assert named("This is not licensed under the Apache License, Version 1.0.") == named("not licensed under the Apache License, Version 2.0.") == []
    for name, text in op8_license.TEMPLATES.items():
        found = op8_license.scan(index, f"Some words. {text} And more words", {})
        assert [m[0] for m in found] == [name] and found[0][1] == 1.0 and found[0][3] == 12
    mit = op8_license.TEMPLATES["MIT-text"]
    far = mit[:500] + " someone put fifteen words right into the middle of it which should not hide it " + mit[500:]
    assert named(far) == ["MIT-text"] and 0.85 < op8_license.scan(index, far, {})[0][1] < 0.95
    start = mit[: mit.rindex(" ", 0, 400)].rstrip(" ,;:.")
    part = op8_license.scan(index, start + " zzz", {})
    assert [m[0] for m in part] == ["MIT-text"] and part[0][1] < 0.5 and (part[0][3], part[0][4]) == (0, len(start))
    assert named(mit + " " + "x " * 5 + mit) == ["MIT-text"] * 2
    assert [m[0] for m in op8_license.scan(op8_license.Index({"two": "public domain"}), "in the public domain", {})] == ["two"]


def test_alignment_against_all_alignments():
    """The band holds every diagonal here, so the matches are those of the best of all alignments."""
    rng = random.Random(8)
    for _ in range(150):
        a, b = ([rng.choice("xyz") for _ in range(rng.randint(1, 5))] for _ in range(2))
        got = op8_license.aligned(a, b, -len(a), len(b))
        assert all(a[i] == b[j] for i, j in got) and got == sorted(set(got)) and len({j for _, j in got}) == len(got)

        def value(pairs):
            inserted = (pairs[-1][1] - pairs[0][1] + 1 - len(pairs)) if pairs else 0
            return 2 * len(pairs) - (len(a) - len(pairs)) - inserted

        every = [(i, j) for i in range(len(a)) for j in range(len(b)) if a[i] == b[j]]
        best = 0 - len(a)
        for n in range(1, min(len(a), len(b)) + 1):
            for pairs in itertools.combinations(every, n):
                if all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:])):
                    best = max(best, value(pairs))
        assert value(got) == best


def test_licences_of_odd_rows(spark):
    rows = [(None, None, 1), (1, "", 2), (1, "Released under the MIT License. " * 2000, 3), (1, "Released under the MIT License. " * 2000, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_matches int")
    assert sorted(r["n_matches"] for r in op8_license.licenses(docs).collect()) == [0, 0, 2000, 2000]
    assert op8_license.licenses(docs.limit(0)).count() == 0


def made_toxic(n=600):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(400)]
    bad = ["vilex", "grubby", "snarlo", "muckor"]
    rows = [(k, " ".join([rng.choice(words) for _ in range(30)] + [rng.choice(bad) for _ in range(4 if k % 5 == 0 else 0)]), int(k % 5 == 0)) for k in range(n)]
    return rows


def test_toxicity_of_odd_rows(spark):
    rows = made_toxic()
    long = "LONG " + " ".join(b for _, b, c in rows if c) * 20
    docs = spark.createDataFrame([(a, b, 1.0, 2.0) for a, b, _ in rows] + [(None, None, 1.0, 2.0), (3, long, 1.0, 2.0), (3, long, 1.0, 2.0)], "doc_id long, text string, predicted_0 double, PREDICTED_1 double")
    labels = spark.createDataFrame([(a, c) for a, _, c in rows], "doc_id long, toxic int")
    model = op6_toxicity.fit(docs, labels)
    kept = op6_toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    assert kept.where("doc_id is null").count() == 1 and kept.where("text like 'LONG%'").count() == 0
    assert abs(kept.count() - (sum(1 - c for *_, c in rows) + 1)) <= 6
    every = op6_toxicity.fit(docs, labels, max_terms=None, max_voters=None)
    assert set(model.terms) <= set(every.terms)
    assert op6_toxicity.scored(docs.limit(0), labels).count() == 0 and op6_toxicity.without_toxic(docs.limit(0), labels).count() == 0


def test_pages_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, "u", "<article><p>" + "words and more, " * 50_000 + "</article>", 5), (None, None, None, 5)], "page_id long, url string, html string, n_chars int")
    got = op2_html.main_text(docs).collect()
    assert sorted(r["n_chars"] for r in got) == [0, len("words and more, " * 50_000) - 1] and op2_html.main_text(docs.limit(0)).count() == 0


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls, empty and repeated rows, a clashing extra column, and no rows at all, through every stage."""
    import corpus_pipeline

    rows = made_toxic(300)
    labels = spark.createDataFrame([(a, 1, c) for a, _, c in rows], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    made = [(a, b, ["en", "de", "fr", "es"][a % 4], f"src{a % 7}", len(b), 9) for a, b, _ in rows]
    made += [made[7], made[7], (None, None, None, None, None, 9), (None, None, None, None, None, 9), (900, "", "en", "src1", 0, 9), (901, made[8][1], "de", "src2", 5, 9)]
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long, row int")
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        empty = stage(spark, docs.limit(0), str(tmp_path))
        assert empty.count() == 0
        if name != "bpe_encoding":
            assert out.columns == docs.columns == empty.columns
        sizes.append(out.count())
        docs = out
    toxic = sum(c for *_, c in rows)
    assert abs(sizes[0] - (len(made) - toxic)) <= 8
    assert sizes[0] - sizes[1] >= 4  # the repeats, one of the two rows without anything, and the copy
    assert 0 < sizes[2] <= sizes[1] and sizes[3] == sizes[2]
