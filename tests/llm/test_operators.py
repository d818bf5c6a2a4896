"""Each operator against a brute-force version, and on nulls, empty and repeated rows, ties, clashing columns, no rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import tiktoken
import xxhash
from tokenizers import Tokenizer

from tilescan.llm import op1_lattice, op2_html, op3_simhash, op4_bpe, op5_mixing, op6_toxicity, op7_token_counts, op8_license, op9_token_files, op10_sketch
from tilescan.llm.grouping import components, merge

DOCS = "doc_id long, text string, lang string, source string, fingerprint string, n_links long, budget int, score string, key long, id long"


def made_docs(n=120, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    texts = [" ".join(rng.choice(words) + rng.choice(["", "", ",", ".", "\n"]) for _ in range(rng.randint(1, 120))) for _ in range(n - 8)]
    texts += [texts[0], texts[1] + " x", None, "", "  \n ", "one two", "a" * 30000, "the " * 20000]
    rows = [(k, t, rng.choice(["en", "de", None]), rng.choice(["src0", "src0", "src1", None]), "x", 1, 2, "s", 7, 8) for k, t in enumerate(texts)]
    return [*rows, rows[3], (None, "lost row here", "en", "src0", "x", 1, 2, "s", 7, 8)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(made_docs(), DOCS).repartition(3).cache()


def bits(text, n=4):
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(parts[k : k + n]), 42) for k in range(max(1, len(parts) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, docs):
    small = [r for r in made_docs() if len(r[1] or "") < 20000]
    got = op3_simhash.near_duplicates(spark.createDataFrame(small, DOCS)).collect()
    assert len(got) == len(small)
    fps = {}
    for r in small:
        fps.setdefault(bits(r[1]), []).append(r[0])
    keys = list(fps)
    labels = np.arange(len(keys))
    for i in range(len(keys)):
        for j in range(i):
            if bin(keys[i] ^ keys[j]).count("1") <= 4:
                merge(labels, np.array([i]), np.array([j]))
    least = {}
    for k, lab in zip(keys, labels):
        for d in fps[k]:
            if d is not None:
                least[lab] = min(d, least.get(lab, d))
    want = sorted((str(r[0]), bits(r[1]), str(least.get(labels[keys.index(bits(r[1]))]))) for r in small)
    assert sorted((str(r["doc_id"]), r["fp"] & (1 << 64) - 1, str(r["component_id"])) for r in got) == want
    assert op3_simhash.near_duplicates(docs.limit(0)).count() == 0
    kept = op3_simhash.one_of_each(docs, words=5)
    assert kept.columns == docs.columns
    assert {3, 0} <= {r["doc_id"] for r in kept.collect()} and 112 not in {r["doc_id"] for r in kept.collect()}


def test_simhash_finds_every_link_of_random_fingerprints(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)]
    near = [b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(6)]
    all_fps = sorted({x - (1 << 64) if x >= 1 << 63 else x for x in base + near})
    found = components(op3_simhash.links(spark.createDataFrame([(x,) for x in all_fps], "fp long"))).collect()
    a = np.array(all_fps)
    labels = np.arange(len(a))
    i, j = np.nonzero(np.bitwise_count((a[:, None] ^ a[None, :]).view(np.uint64)) <= 4)
    merge(labels, i, j)
    want = {int(x): int(a[labels[k]]) for k, x in enumerate(a) if (labels == labels[k]).sum() > 1}
    assert {r["id"]: r["component"] for r in found} == want


def test_one_of_each_judges_rows(spark):
    """Rows without an id, or with one id and other texts, are documents of their own; plain repeats are not."""
    rng = random.Random(12)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(60)) for _ in range(6)]
    rows = [(1, texts[0], "a"), (None, texts[0], "b"), (None, texts[1], "c"), (None, texts[2], "d"), (None, texts[2], "d"), (7, texts[3], "e"), (7, texts[3], "e"), (7, texts[4], "f"), (9, texts[4], "g"), (8, texts[5], "h"), (8, texts[0], "i")]
    kept = op3_simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3), words=5)
    assert sorted(r["source"] for r in kept.collect()) == ["a", "c", "d", "e", "f", "h"]


def test_one_of_each_links_similar_texts(spark):
    """Texts at a similarity of 0.8 or more link at any distance of their fingerprints, in split buckets too."""
    rng = random.Random(6)

    def shingled(text):
        parts = text.split()
        return {tuple(parts[k : k + 5]) for k in range(len(parts) - 4)}

    def alike(x, y):
        return len(shingled(x) & shingled(y)) / len(shingled(x) | shingled(y)) >= 0.8

    texts = []
    for _ in range(40):
        base = ["w%d" % rng.randrange(5000) for _ in range(rng.randint(120, 240))]
        texts.append(" ".join(base))
        for cut_off in (0.12, 0.17, 0.3):
            texts.append(" ".join(base[: int(len(base) * (1 - cut_off))]))
    far = [(i, j) for j in range(len(texts)) for i in range(j) if alike(texts[i], texts[j]) and bin(bits(texts[i], 5) ^ bits(texts[j], 5)).count("1") > 4]
    assert len(far) > 20
    labels = np.arange(len(texts))
    linked = [(i, j) for j in range(len(texts)) for i in range(j) if alike(texts[i], texts[j]) or bin(bits(texts[i], 5) ^ bits(texts[j], 5)).count("1") <= 4]
    merge(labels, *np.array(linked).T)
    kept = op3_simhash.one_of_each(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), words=5)
    assert sorted(r["doc_id"] for r in kept.collect()) == np.unique(labels).tolist()


def test_large_buckets_are_split_and_lose_nothing(spark):
    """A bucket above the cap goes through the blocks."""
    from tilescan.llm import grouping

    rng = random.Random(2)
    base = rng.getrandbits(63)
    fps = sorted({base ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for _ in range(400)})
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    old = grouping.by_bucket
    op3_simhash.by_bucket = lambda *a: old(*a, cap=20, block=16)
    try:
        found = components(op3_simhash.links(df)).collect()
    finally:
        op3_simhash.by_bucket = old
    assert {r["id"] for r in found} == set(fps) and len({r["component"] for r in found}) == 1


VECS = "vec_id long, embedding array<float>, label int, n_links long, id long"


def made_vectors(seed=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(60, 64))
    rows = [base[k % 60] + (0 if k < 60 else rng.normal(size=64) * 0.15) for k in range(200)]
    rows += [base[0], base[0] * 2, np.zeros(64)]
    out = [(k, [float(np.float32(x)) for x in v], 0, 5, 6) for k, v in enumerate(rows)]
    return [*out, (300, None, 0, 5, 6), (301, [1.0, None] * 32, 0, 5, 6), (302, [float("nan")] * 64, 0, 5, 6), (303, [], 0, 5, 6), out[7]]


def test_lattice(spark):
    rows = made_vectors()
    got = sorted((tuple(r) for r in op1_lattice.near_duplicates(spark.createDataFrame(rows, VECS)).select("vec_id", "n_links", "component_id", "kept").collect()), key=str)
    good = [r for r in rows if r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    x = np.array([r[1] for r in good])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    labels = np.arange(len(x))
    merge(labels, *np.nonzero(near))
    ids = np.array([r[0] for r in good])
    want = {}
    for k, r in enumerate(good):
        c = int(ids[labels == labels[k]].min())
        want.setdefault(r[0], (r[0], int(near[k].sum()), c, r[0] == c))
    exact = sum(tuple(g) == want.get(g[0], (g[0], 0, g[0], True)) for g in got)
    assert len(got) == len(rows) and exact == len(rows)
    assert op1_lattice.near_duplicates(spark.createDataFrame([], VECS)).count() == 0


def test_lattice_counts_every_link_of_large_cells(spark, monkeypatch):
    """Cells above the cap go through the blocks; each link is counted once, also those within one block."""
    from tilescan.llm import grouping

    rng = np.random.default_rng(11)
    base = rng.normal(size=(2, 64))
    rows = [(k, [float(np.float32(x)) for x in base[k % 2] + rng.normal(size=64) * 0.1], 0, 5, 6) for k in range(160)]
    monkeypatch.setattr(op1_lattice, "by_bucket", lambda *a, **k: grouping.by_bucket(*a, cap=20, block=16))
    got = {}
    for cap in (4096, 50):  # a connected group as a whole, and in its cells
        found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in op1_lattice.near_duplicates(spark.createDataFrame(rows, VECS), cap=cap).collect()}
        assert not got or got == found
        got = found
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    labels = np.arange(len(x))
    merge(labels, *np.nonzero(near))
    assert got == {k: (int(near[k].sum()), int(labels[k])) for k in range(len(x))}


def test_lattice_recall_at_the_threshold():
    rng = np.random.default_rng(0)
    x, z = rng.normal(size=(2, 3000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z -= (z * x).sum(1)[:, None] * x
    z /= np.linalg.norm(z, axis=1)[:, None]
    grid = op1_lattice.Lattice(64)
    a, b = grid.cells(x), grid.cells(0.95 * x + np.sqrt(1 - 0.95**2) * z)
    assert ((a[:, :, :1] == b) | (b[:, :, :1] == a)).any((1, 2)).mean() >= 0.95


def test_e8_decoding_is_nearest():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8)) * 2
    d = op1_lattice.Lattice.decode(x) / 2
    assert (((d * 2) % 2 == 0).all(1) | ((d * 2) % 2 == 1).all(1)).all() and (np.abs(d.sum(1)) % 2 < 1e-9).all()
    assert (((x - d) ** 2).sum(1) <= 1 + 1e-9).all()  # the covering radius
    s = op1_lattice.Lattice.second(x, (d * 2).astype(np.int64)) / 2
    assert np.allclose(((s - d) ** 2).sum(1), 2)


@pytest.fixture(scope="module")
def bpe():
    path, pattern = op4_bpe.default_vocabulary()
    with open(path, "rb") as f:
        encoder = op4_bpe.Encoder(op4_bpe.Vocabulary(op4_bpe.read_ranks(f.read())), pattern)
    return encoder, tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=encoder.vocabulary.ranks, special_tokens={})


def test_bpe_documents(docs, bpe):
    got = op4_bpe.encode_documents(docs).collect()
    texts = {}
    for r in made_docs():
        texts.setdefault(r[0], r[1] or "")
    assert len(got) == len(made_docs())
    for r in got:
        ids = bpe[1].encode_ordinary(texts[r["doc_id"]])
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    assert op4_bpe.encode_documents(docs.limit(0)).count() == 0


def test_bpe_random_texts_appends_and_edits(bpe):
    encoder, library = bpe
    rng, letters = random.Random(1), "ab eé\n\t 1９'sт中🙂!.,\xa0 \x1c\x85AB  the"
    for _ in range(1500):
        x = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert encoder.encode(x) == library.encode_ordinary(x)
        d = op4_bpe.Document(encoder, x)
        for _ in range(2):
            m = "".join(rng.choice(letters) for _ in range(rng.randint(0, 8)))
            i = rng.randint(0, len(x))
            j = rng.randint(i, len(x))
            if rng.random() < 0.4:
                d.append(m)
                x += m
            else:
                d.edit(i, j, m)
                x = x[:i] + m + x[j:]
            assert d.text == x and d.ids() == library.encode_ordinary(x)


def test_bpe_prefix_table(bpe):
    v = bpe[0].vocabulary
    data = "internationalisationally".encode()
    table = op4_bpe.Prefixes(v, data)
    for n in range(1, len(data) + 1):
        assert table.ids(n) == v.merged(data[:n])
    table.edit(3, 7, b"XY")
    assert table.ids() == v.merged(data[:3] + b"XY" + data[7:])


def test_token_counts(docs, bpe):
    for rule in op7_token_counts.RULES:
        got = op7_token_counts.section_tokens(docs, rule=rule).collect()
        assert len(got) == len(made_docs())
        assert all(abs(sum(r["section_tokens"]) - r["n_tokens"]) < 1e-6 for r in got)
    starts, ends = np.array([0, 3, 5]), np.array([3, 5, 9])
    bounds = np.array([0, 4, 9])
    assert op7_token_counts.attribute(starts, ends, bounds, "first")[0].tolist() == [2, 1]
    assert op7_token_counts.attribute(starts, ends, bounds, "majority")[0].tolist() == [2, 1]
    assert op7_token_counts.attribute(starts, ends, bounds, "split")[0].tolist() == [1.5, 1.5]
    text = "é🙂x\nß y"
    ids = bpe[0].encode(text)
    s, e = op7_token_counts.token_spans(bpe[0], ids, text)
    assert e[-1] == len(text) and s[0] == 0


def test_token_files(spark, docs, tmp_path):
    rows = made_docs()
    library = Tokenizer.from_file(op9_token_files.default_path())
    want, at = [], 0
    for key, ids in sorted((-1 if r[0] is None else r[0], library.encode(r[1] or "", add_special_tokens=False).ids + [1]) for r in rows):
        want.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    for k, size in enumerate((1 << 30, 20_000)):
        manifest = op9_token_files.write(docs, str(tmp_path / str(k)), bytes_per_file=size)
        got = op9_token_files.read(spark, str(tmp_path / str(k))).collect()
        assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in map(tuple, got)) == want
        assert manifest["n_parts"] == 1 or k and manifest["n_parts"] > 3
    assert op9_token_files.written_and_read(docs.limit(0), str(tmp_path / "none")).count() == 0


def test_fingerprints(spark, docs):
    rows = sorted(made_docs(), key=lambda r: (-(r[0] if r[0] is not None else -(1 << 63)), (r[1] or "").encode()))
    for size in (1 << 30, 8000):
        got = op10_sketch.edited(docs, bytes_per_range=size).collect()
        assert len(got) == len(rows)
        texts = [r[1] or "" for r in rows]
        want = []
        for k, t in enumerate(texts):
            following = texts[(k + 1) % len(texts)]
            new = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
            want.append((str(rows[k][0]), len(t), hashlib.sha256(new.encode()).hexdigest()))
        assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in got) == sorted(want)
    assert op10_sketch.edited(docs.limit(0)).count() == 0
    one = op10_sketch.edited(docs.where("doc_id = 4")).first()
    assert one["near_next"] == 1.0


def test_sketch_estimates():
    rng = random.Random(4)
    words = [str(k).encode() for k in range(6000)]
    a, b = b" ".join(words[:4000]), b" ".join(words[1000:6000])
    ha, hb = (np.unique(op10_sketch.shingle_hashes(x, 5, {})) for x in (a, b))
    true = len(np.intersect1d(ha, hb)) / len(np.union1d(ha, hb))
    sa, sb = op10_sketch.sketch(ha, 1024), op10_sketch.sketch(hb, 1024)
    assert abs(op10_sketch.resemblance(sa, sb, 1024) - true) < 0.06
    assert abs(op10_sketch.distinct(sa, 1024) / len(ha) - 1) < 0.12
    assert abs(op10_sketch.containment(sa, sb, 1024) - len(np.intersect1d(ha, hb)) / len(ha)) < 0.1
    assert (op10_sketch.merged(sa, sb, 1024) == op10_sketch.sketch(np.union1d(ha, hb), 1024)).all()
    assert (op10_sketch.from_text(op10_sketch.to_text(sa)) == sa).all() and rng


def test_html(spark):
    model = op2_html.default_model()
    ok = n = 0
    for page in op2_html.labelled_pages(60, seed=99):
        belief, _ = model.marginals(page)
        for at, text in page.blocks:
            n += 1
            ok += (belief[at] >= 0.5) == (op2_html.CONTENT_MARK in text)
    assert ok / n > 0.98
    page = '<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav><article><h1>Big &amp; bold</h1><p>First  paragraph,\n here.<p><b>Second one<br>goes on.<div class="comments"><p>nice!</p></div></article><footer>(c)</footer>'
    rows = [(1, "u", page, "x"), (1, "u", page, "x"), (2, None, None, "x"), (None, "u", "", "x"), (3, "u", "<p>plain", "x"), (4, "u", "<" * 50, "x")]
    got = op2_html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    texts = [r["text"] for r in got if r["page_id"] == 1]
    assert texts == ["Big & bold\nFirst paragraph, here.\nSecond one goes on."] * 2
    assert len(got) == 6 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert next(r["text"] for r in got if r["page_id"] == 2) == ""


def test_html_raw_text_holds_no_markup():
    body = "<article><h1>Title</h1><p>First paragraph, here.</p></article>"
    for raw in ("<script>for(var i=0;i<n;i++){f(i)}</script>", "<SCRIPT>a<b</sCript >", "<style>a<b \"</style>", "<script>if(a<b){s='</scripty>'}</script\n>", "<script><!-- x<y </script>"):
        blocks = [text for _, text in op2_html.parse(f"<html><body>{raw}{body}").blocks]
        assert blocks == ["Title", "First paragraph, here."], raw
    assert op2_html.parse("<p>before</p><script>i<n").blocks == op2_html.parse("<p>before</p>").blocks
    assert op2_html.parse("<p>before</p><script>x</script").blocks == op2_html.parse("<p>before</p>").blocks


def test_html_marginals_equal_enumeration():
    model = op2_html.default_model()
    page = op2_html.parse("<div><p>a, b c.</p><ul><li><a href=x>l</a></li></ul><h2>t</h2></div>")
    es = page.elements
    n = len(es)
    weights = np.zeros(1 << n)
    for state in range(1 << n):
        y = [state >> i & 1 for i in range(n)]
        s = sum(model.unary[k] * v for i, e in enumerate(es) if y[i] for k, v in op2_html.features(e, i, n))
        s += sum(model.pair[op2_html.edge_kind(e)][y[e.parent]][y[i]] for i, e in enumerate(es) if i)
        weights[state] = np.exp(s)
    weights /= weights.sum()
    want = [weights[[bool(s >> i & 1) for s in range(1 << n)]].sum() for i in range(n)]
    assert np.allclose(model.marginals(page)[0], want, atol=1e-9)


def fill(items, amount):
    got, left = {}, amount
    while items:
        total = sum(w for _, w, _ in items)
        full = [x for x in items if x[2] <= left * x[1] / total * (1 + 1e-12)]
        if not full:
            return got | {k: left * w / total for k, w, _ in items}
        got |= {k: c for k, _, c in full}
        left -= sum(c for _, _, c in full)
        items = [x for x in items if x not in full]
    return got


@pytest.mark.parametrize("fraction,epochs", [(1.0, 2), (0.5, 1), (5.0, 2)])
def test_mixing(docs, fraction, epochs):
    r = op5_mixing.mixed(docs, fraction, epochs).select("doc_id", "domain", "lang", "source", "text", "n_words", "n_copies", "budget").toPandas()
    assert len(r) == len(made_docs())
    assert all(n == len((t or "").split()) for n, t in zip(r.n_words, r.text))
    r = r.fillna({"domain": "-", "lang": "-", "source": "-"})
    capacity = r.groupby(["domain", "lang", "source"]).n_words.sum() * epochs
    lang = op5_mixing.LANGUAGE_WEIGHTS
    want = {}
    for d, dv in fill([(k, 1.0, v) for k, v in capacity.groupby("domain").sum().items()], min(fraction * r.n_words.sum(), capacity.sum())).items():
        for g, gv in fill([(k, lang.get(k, 1.0), v) for k, v in capacity.loc[d].groupby("lang").sum().items()], dv).items():
            for s, sv in fill([(k, 1.0, v) for k, v in capacity.loc[d, g].items()], gv).items():
                want[d, g, s] = sv
    for key, part in r.groupby(["domain", "lang", "source"]):
        assert abs(part.budget.iloc[0] - want[key]) < 1e-3
        used = (part.n_words * part.n_copies).sum()
        assert used <= want[key] + 1e-3
        assert part.n_copies.max() - part.n_copies.min() <= 1 and part.n_copies.max() <= epochs
    out = op5_mixing.selected(docs, 0.5, 2)
    assert out.columns == docs.columns and op5_mixing.selected(docs.limit(0)).count() == 0


def test_toxicity(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(400)]
    bad = ["vilex", "grubby", "snarlo", "muckor"]
    rows, labels = [], []
    for k in range(900):
        toxic = k % 6 == 0
        text = [rng.choice(words) for _ in range(rng.randint(20, 60))]
        if toxic:
            for _ in range(4):
                text[rng.randrange(len(text))] = rng.choice(bad)
        rows.append((k, " ".join(text), "x", 3))
        labels.append((k, 1, int(toxic)))
    rows += [(2000, None, "x", 3), (2001, "", "x", 3), (None, "vilex grubby", "x", 3), rows[5]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, toxic int")
    lab = spark.createDataFrame([*labels, (7000, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = op6_toxicity.scored(docs, lab).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    truth = dict((a, c) for a, _, c in labels)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got if r["doc_id"] is not None)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97
    kept = op6_toxicity.without_toxic(docs, lab)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] == 0 for r in got)
    assert {r["score"] for r in op6_toxicity.scored(docs, lab.limit(0)).collect()} == {0.0}


def test_licenses(spark):
    mit = op8_license.TEMPLATES["MIT-text"]
    changed = mit.replace("free of charge", "without any charge").replace("sublicense", "relicense")
    rows = [(1, f"zzz yyy. {mit} tail words", 0), (2, changed, 0), (3, "nothing here", 0), (4, None, 0), (5, "LICENSED UNDER CC BY-NC 4.0. and Released under the MIT License.", 0), (None, "", 0), (1, "x", 0)]
    got = op8_license.licenses(spark.createDataFrame(rows, "doc_id long, text string, matches int")).collect()
    by = {r["doc_id"]: r for r in got if r["n_matches"]}
    assert len(got) == 7 and set(by) == {1, 2, 5}
    m = by[1]["matches"][0]
    assert m["template"] == "MIT-text" and m["coverage"] == 1.0 and rows[0][1][m["start"] : m["end"]] == mit[:-1]
    assert 0.9 < by[2]["matches"][0]["coverage"] < 1
    assert [m["template"] for m in by[5]["matches"]] == ["CC-BY-NC-4.0", "MIT"]


def test_pipeline(spark):
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    clean = corpus_pipeline.toxicity(spark, docs, d)
    assert clean.columns == docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and 0 < clean.count() <= docs.count()
    once = corpus_pipeline.simhash_near_dedup(spark, clean, d)
    fps = {r["doc_id"]: bits(r["text"], 5) for r in once.collect()}
    found = list(fps.values())
    assert all(bin(a ^ b).count("1") > 4 for k, a in enumerate(found) for b in found[:k])
    out = corpus_pipeline.run(spark, d)
    assert 0 < out.count() <= once.count() and "ids_sha256" in out.columns
