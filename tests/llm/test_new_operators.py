"""Spelling variants, language ID and whitening against brute force; the mended operators on the cases that broke them."""

from __future__ import annotations

import datetime as dt
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from costloom.llm import decontam, html, language, licenses, rules, variants, whitening
from costloom.llm import words as word_hashes
from tests.llm.test_operators import prose

FOLDER = "/root/testdata/sf0.01"
tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- spelling variants -------------------------------------------------------------------------------


def one_apart(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows, near_of=None):
    counts = Counter()
    for ident, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(CAPITALS)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    near = (near_of or all_near)(counts)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= 10 * n:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {w: (form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()}


def all_near(counts):
    return {w: [x for x in counts if one_apart(w, x)] for w in counts}


def near_by_deletion(counts):
    near, slots = defaultdict(set), defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            rest = w[:i] + w[i + 1 :]
            if rest in counts:
                near[w].add(rest)
                near[rest].add(w)
            slots[i, len(w), rest].add(w)
    for group in slots.values():
        for a in group:
            near[a] |= group - {a}
    return near


def got_variants(docs):
    rows = variants.variant_report(docs).collect()
    assert len(rows) == len({r.word for r in rows})
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def variant_texts(seed=5):
    """Words with misspellings, chains of forms, ties, accents, runs cut by other signs, repeats and empty texts."""
    rng = random.Random(seed)
    base = ["receive", "separate", "accommodate", "nécessaire", "Éléphants", "aaaaaaa", "aaaaaaaa", "x" * 300]
    rows = []
    for k in range(60):
        words = []
        for _ in range(40):
            w = rng.choice(base)
            for _ in range(rng.choice([0, 0, 0, 0, 1, 1, 2])):
                i = rng.randrange(len(w))
                w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abeé") + w[i:], w[:i] + rng.choice("abe") + w[i + 1 :]])
            words.append(rng.choice([w, w.capitalize(), w.upper()]))
        rows.append((k, rng.choice([" ", ", ", "-", "1"]).join(words)))
    chain = [("chained" * 1, 1000), ("chainedx", 100), ("chainedxy", 10), ("twinned", 200), ("twinner", 200), ("twinnex", 20)]
    rows += [(1000 + i, " ".join([w] * n)) for i, (w, n) in enumerate(chain)]
    return rows + [(None, "receive receive receeive"), (7, None), (8, ""), (9, "\U0001f600 short Œuvres"), rows[0], rows[0]]


@pytest.mark.parametrize("crowded", [4096, 4])
def test_variants_match_brute_force(spark, crowded, monkeypatch):
    monkeypatch.setattr(variants.blocks, "__defaults__", (crowded,))
    monkeypatch.setattr(variants.near_pairs, "__defaults__", (crowded,))
    monkeypatch.setattr(variants, "TILE", 8 if crowded == 4 else 512)
    rows = variant_texts()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("x")).withColumn("n", F.lit(1))
    got = got_variants(df)
    assert got == brute_variants(rows)
    assert got["chainedxy"][1] == "chained"


@tables
def test_variants_of_a_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got_variants(docs) == brute_variants(rows, near_by_deletion)


def test_no_variants(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert variants.variant_report(empty).count() == 0
    once = spark.createDataFrame([(1, "anything whatever")], "doc_id long, text string")
    assert variants.variant_report(once).count() == 0
    assert variants.variant_report(once).columns == ["word", "form", "root", "n", "n_near", "form_n"]


# --- language ----------------------------------------------------------------------------------------


def test_scores_are_those_of_the_kernel():
    """The batched products equal kernel values from sets of n-grams, times the same coefficients."""
    rows = [("the cat sat on the mat with a hat", "en"), ("le chat est sur la table avec lui", "fr")] * 3
    model = language.fit([(f"{t} {k}", lang) for k, (t, lang) in enumerate(rows)])
    texts = ["The  CAT, le chat!", "zz", "on\tthe table 12 日本"]

    def grams(text):
        folded = re.sub(r"[^a-z日本]+", " ", f" {text.lower()} ")
        return {folded[i : i + n] for n in (1, 2, 3) for i in range(len(folded) - n + 1)}

    marks = [grams(t) for t in [f"{t} {k}" for k, (t, lang) in enumerate(rows)]]
    order = [k for lang in model.languages for k, (_, x) in enumerate(rows) if x == lang][: model.landmarks.shape[1]]
    known = set().union(*[marks[k] for k in order])
    kernel = np.array([[len(grams(t) & known & marks[k]) / max(1, len(grams(t) & known)) ** 0.5 / len(marks[k]) ** 0.5
                        for k in order] for t in texts])
    assert np.allclose(kernel @ model.weights, model.scores(texts), atol=1e-5)


def test_long_texts_in_blocks_are_marked_alike(monkeypatch):
    model = language.fit([(prose(1, 300), "en"), (prose(2, 300).replace("t", "z"), "xx")])
    texts = [prose(k, 200) + "   -- " * (k % 3) for k in range(8)] + ["", "a"]
    whole = model.kernel.presence(texts)
    monkeypatch.setattr(language, "BLOCK", 97)
    assert np.array_equal(model.kernel.presence(texts), whole)


def test_language_of_odd_rows(spark):
    ddl = "doc_id long, text string, lang string, source string"
    rows = [(k, prose(k, 30) if k % 2 else prose(k, 30).replace("e", "ö").replace("t", "sch"), "en" if k % 2 else "de", "s") for k in range(60)]
    rows += [(100, None, "en", "s"), (101, "", "de", None), (102, "12 --- 3²", None, "s"), (None, prose(3, 30), "en", "s"), (103, prose(5, 30), None, "s"), rows[1]]
    out = language.language_report(spark.createDataFrame(rows, ddl).withColumn("score", F.lit("x")))
    got = out.collect()
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"] and len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[k].lang_pred == ("en" if k % 2 else "de") for k in range(60))
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    assert [by[k].lang_pred for k in (100, 101, 102)] == ["und"] * 3 and by[100].score == 0
    assert by[103].lang_pred == by[None].lang_pred == "en"
    none = spark.createDataFrame([(1, "text without a language", None, "s")], ddl)
    assert language.language_report(none).first()[2:] == ("und", 0.0)
    assert language.language_report(none.limit(0)).count() == 0
    one = spark.createDataFrame([(k, "words of one language", "q", "s") for k in range(9)], ddl)
    assert {r.lang_pred for r in language.language_report(one).collect()} == {"q"}


@tables
def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    # Labels of held-out documents are no input: the result is the same without them.
    hidden = docs.withColumn("lang", F.when(~language.held_out(F.col("doc_id")), F.col("lang")))
    got = {r.doc_id: r for r in language.language_report(hidden).collect()}
    rows = [r for r in docs.select("doc_id", "lang").collect() if got[r.doc_id].held_out]
    right = sum(got[r.doc_id].lang_pred == r.lang for r in rows)
    assert len(rows) > 200 and right >= 0.98 * len(rows)


# --- whitening ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("d", [1, 2, 3, 40])
def test_leading_eigenpairs(d):
    rng = np.random.default_rng(d)
    a = rng.standard_normal((d, 2 * d))
    v = a @ a.T
    values, vectors = whitening.leading(v)
    want = np.linalg.eigvalsh(v)[::-1][: len(values)]
    assert len(values) == min(32, d) and np.allclose(values, want, rtol=1e-12, atol=1e-12 * want[0])
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
    assert np.allclose(v @ vectors, vectors * values, atol=1e-11 * want[0])


@pytest.mark.parametrize("spectrum", [[5, 5, 5, 3, 3, 0, 0], [1, 1, 1, 1], [0, 0], [1e12, 1, 1e-6], [2, 2 - 1e-13, 1]])
def test_equal_and_missing_eigenvalues(spectrum):
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.standard_normal((len(spectrum),) * 2))[0]
    v = (q * spectrum) @ q.T
    values, vectors = whitening.leading((v + v.T) / 2)
    assert np.allclose(values, sorted(spectrum, reverse=True), atol=1e-12 * max(1, *spectrum))
    assert np.allclose(vectors.T @ vectors, np.eye(len(spectrum)), atol=1e-12)


def test_counts_are_those_of_the_spectrum():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((30, 30))
    v = a + a.T
    diagonal, off = whitening.tridiagonal(v)
    shifts = np.linspace(-12, 12, 41)
    want = [(np.linalg.eigvalsh(v) < s).sum() for s in shifts]
    assert whitening.below(diagonal, off, shifts).tolist() == want


def brute_whitening(vectors):
    x = np.floor(64 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(0)
    centred = x - total / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:32], axes[:, ::-1][:, :32]
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, total, strict=True)) for row in x]
    return centred @ axes / np.sqrt(values), values / (centred**2).mean(0).sum(), deviation


@tables
def test_whitening_of_a_table(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = pq.read_table(f"{FOLDER}/embeddings.parquet").to_pylist()
    want, explained, deviation = brute_whitening([r["embedding"] for r in rows])
    got = whitening.whitening_report(table).toPandas()
    assert len(got) == len(rows) * 32 and got.columns[:7].tolist() == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[[r["vec_id"] for r in rows]].to_numpy()
    signs = np.sign((wide * want).sum(0))
    assert np.abs(wide * signs - want).max() < 1e-8
    assert np.allclose(got.groupby("component").explained.first(), explained, rtol=1e-10)
    assert got.groupby("vec_id").deviation.first().loc[[r["vec_id"] for r in rows]].tolist() == deviation
    assert got.identity_error.nunique() == 1 and 0 <= got.identity_error.iloc[0] < 1e-8 and set(got.n) == {len(rows)}


def test_whitening_of_odd_rows(spark):
    ddl = "vec_id long, embedding array<float>, whitened string"
    rng = np.random.default_rng(1)
    good = [(k if k else None, rng.normal(0, 3, 3).astype("f4").tolist()) for k in range(40)] + [(5, [1.0, 2.0, 3.0])] * 2
    bad = [(90, None), (91, [1.0, None, 2.0]), (92, [1.0, float("nan"), 2.0]), (93, [float("inf"), 0.0, 0.0]),
           (94, [1.0]), (95, []), (96, [3e38, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, "x") for r in good + bad], ddl).repartition(3)
    got = whitening.whitening_report(df).toPandas()
    want, _, deviation = brute_whitening([v for _, v in good])
    assert len(got) == 3 * len(good) and set(got.n) == {len(good)}
    assert np.allclose(np.sort(np.abs(got.whitened)), np.sort(np.abs(want).ravel()), atol=1e-9)
    assert sorted(got.deviation[got.component == 1]) == sorted(deviation)
    assert got.vec_id.isna().sum() == 3


def test_whitening_without_variance(spark):
    ddl = "vec_id long, embedding array<float>"
    assert whitening.whitening_report(spark.createDataFrame([], ddl)).count() == 0
    one = whitening.whitening_report(spark.createDataFrame([(1, [1.0, 2.0])], ddl)).collect()
    assert [(r.component, r.whitened, r.explained, r.identity_error, r.deviation) for r in one] == [(k, None, None, None, 0) for k in (1, 2)]
    flat = [(k, [float(k), 2.0 * k, 7.0]) for k in range(9)]
    got = whitening.whitening_report(spark.createDataFrame(flat, ddl)).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in got)
    assert {round(r.explained, 9) for r in got} == {1.0, 0.0} and got[0].identity_error < 1e-9
    far = [(k, [1e9 * (-1) ** k, 1e9 * k]) for k in range(4)]
    wide = whitening.whitening_report(spark.createDataFrame(far, ddl)).collect()
    want = brute_whitening([v for _, v in far])[2]
    assert {r.vec_id: int(r.deviation_exact) for r in wide} == dict(enumerate(want))
    assert all(r.deviation is None or r.deviation == r.deviation_exact for r in wide)


# --- mended operators --------------------------------------------------------------------------------

WALK = "We walked a long way in the early morning to {} and back before the rain began to fall on the lake."


@pytest.mark.parametrize("attribute", [
    'href="/hidden-lake"', 'href="/x?id=menu-12"', 'title="a hidden place"', 'data-hidden="false"',
    'data-testid="link-comment"', 'hidden="until-found"'])
def test_attributes_that_hide_nothing(attribute):
    link = WALK.format(f"<a {attribute}>the quiet lake</a>")
    assert "the quiet lake" in html.main_text(f"<article><p>{link}</p></article>")
    for tag in ("div", "section"):
        box = f"<{tag} {attribute}><p>Another paragraph stands in a box of its own.</p></{tag}>"
        assert "Another paragraph" in html.main_text(f"<article><p>{WALK}</p>{box}</article>")


@pytest.mark.parametrize("attribute", ["hidden", 'class="x ad"', 'aria-hidden="true"', 'style="display: none"', "id=comments"])
def test_attributes_that_hide(attribute):
    page = f"<article><p>{WALK}</p><div {attribute}><p>{WALK.format('nowhere')}</p></div></article>"
    assert "nowhere" not in html.main_text(page)


def test_parts_of_an_article_stay():
    parts = ['<div class="lead-header"><p>Lead.</p></div>', f"<p>{WALK}</p>", '<section id="discussion"><p>Views.</p></section>',
             "<div><p>The end.</p></div>"]
    page = f"<nav>menu</nav><article>{''.join(parts)}</article><div class=related>More</div><footer>foot</footer>"
    assert html.main_text(page).split("\n") == ["Lead.", WALK, "Views.", "The end."]
    assert html.main_text(page.replace("article", "main")).split("\n") == ["Lead.", WALK, "Views.", "The end."]


@tables
def test_pages_match_a_plain_extractor():
    """On the tables' pages an article is what the article element holds, line by line."""
    for row in pq.read_table(f"{FOLDER}/pages.parquet").to_pylist():
        body = re.search(r"<article>(.*?)</article>", row["html"], re.S)[1]
        body = re.sub(r"<(script|style).*?</\1>", "", re.sub(r"<!--.*?-->", "", body, flags=re.S), flags=re.S)
        lines = [re.sub(r"\s+", " ", html.entities.unescape(re.sub(r"<[^>]*>", "", x))).strip()
                 for x in re.split(r"</?(?:p|h\d|div|li|ul|ol|br|blockquote|section)\b[^>]*>", body)]
        assert html.main_text(row["html"]).split("\n") == [x for x in lines if x]


def test_long_clean_documents_stay(spark):
    """Length alone rejects nothing: 10,000 and 30,000 words in a group of short texts."""

    def clean(seed, n):
        letters = np.random.default_rng(seed).integers(97, 123, (n, 5)).astype(np.uint8)
        return " ".join(bytes(w).decode() for w in letters)

    rows = [(k, clean(k, 200 + k % 20), "en", "web", 1) for k in range(200)]
    rows += [(1000, clean(1000, 10_000), "en", "web", 1), (1001, clean(1001, 30_000), "en", "web", 1)]
    rows += [(2000, clean(2000, 60) + " #$%" * 60, "en", "web", 1), (2001, clean(2001, 80), None, None, 1), (2002, clean(2002, 80), "en", "rare", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id: r.kept for r in rules.judge(docs).collect()}
    assert kept[1000] and kept[1001] and not kept[2000]
    assert kept[2001] and kept[2002]  # small groups use the fences of their language, or of all documents
    assert sum(kept.values()) >= 203
    assert {r.doc_id for r in rules.keep_good(docs).collect()} == {k for k, v in kept.items() if v}


def test_long_segments_are_counted_in_linear_time(spark):
    """One line of 200,000 words takes less than a minute, and the statement behind it is found."""
    words = " ".join(f"w{k}" for k in range(100_000)) + " the license of this software" * 20_000
    rows = [(1, "a/x.txt", words + "\nReleased under the MIT License"), (2, "a/y.txt", "nothing"), (3, "a/LICENSE-MIT", "Licensed under the MIT License"),
            (4, "b/UNLICENSE", "This is free and unencumbered software released into the public domain"), (5, "b/c/d.txt", None)]
    start = dt.datetime.now()
    got = {r.file_id: (r.license, r.origin) for r in licenses.scan_licenses(spark.createDataFrame(rows, "file_id long, path string, text string")).collect()}
    assert (dt.datetime.now() - start).total_seconds() < 60
    assert got == {1: ("MIT", "file"), 2: ("MIT", "directory"), 3: ("MIT", "file"), 4: ("Unlicense", "file"), 5: ("Unlicense", "directory")}


def test_cosines_match_brute_force(spark):
    """Every segment's best cosine against numpy vectors over all words."""
    texts = ["Released under the MIT license", "licensed under the the Apache License version 2.0 or so", "Licence: GPL v2", "plain words only",
             "This work is licensed under the GNU General Public License, version 3"]
    files = spark.createDataFrame([(k, f"{k}.txt", t) for k, t in enumerate(texts)], "file_id long, path string, text string")
    same = dict(licenses.SAME)
    split = [[same.get(w, w) for w in re.findall(licenses._WORD, t.lower())] for t in texts]
    df = Counter(w for s in split for w in set(s))
    n = len(texts)

    def idf(w):
        return np.log((1 + n) / (1 + df[w])) + 1

    def weights(ws):
        return {w: c * idf(w) for w, c in Counter(ws).items()}

    def cosine(a, b):
        return sum(a[w] * b.get(w, 0) for w in a) / np.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))

    want = [0.0] * n
    for group in licenses.GROUPS:
        vocabulary = set(licenses._vocabulary(group))
        for template in (weights(licenses._python_words(t)) for ts in group.values() for t in ts):
            for k, words in enumerate(split):
                # Words that no template of the group has weigh as ones that no segment has.
                own = {w: c * (idf(w) if w in vocabulary else np.log(1 + n) + 1) for w, c in Counter(words).items()}
                want[k] = max(want[k], cosine(own, template))
    got = {r.file_id: r.cosine for r in licenses.stated(files, 0.2).collect()}
    for k, value in enumerate(want):
        assert got[k] is None if value < 0.2 else got[k] == pytest.approx(value, abs=1e-8)


def test_known_words_are_found_in_one_fixed_set(spark):
    """The vocabulary is a set of the plan, not an array that every segment turns into a set."""
    vocabulary = licenses._vocabulary()
    rows = [([],), (["the", "v2", "2.0", "none", "the", "licence"],), (None,)]
    known = spark.createDataFrame(rows, "words array<string>").select(licenses._known(F.col("words"), vocabulary).alias("known"))
    assert [r.known for r in known.collect()] == [[], ["the", "2", "license"], None]
    plan = known._jdf.queryExecution().optimizedPlan().toString()
    assert "array_intersect" not in plan and "INSET" in plan


def test_windows_are_polynomials_of_their_values():
    """Hashes by doubling are those of the sum written out."""
    values = np.random.default_rng(3).integers(0, 2**63, 40).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    step = int(word_hashes._STEP)
    for n in (1, 2, 7, 40):
        for width in (1, 2, 3, 5, 6, 8, 13):
            take = min(width, n)
            runs = [sum(int(v) * step ** (take - 1 - j) for j, v in enumerate(values[i : i + take])) for i in range(n - take + 1)]
            want = word_hashes.mixed(np.array([(r + take) % 2**64 for r in runs], np.uint64))
            assert np.array_equal(word_hashes.windows(values[:n], width), want)
    assert len(word_hashes.windows(values[:0], 3)) == 0


def test_ordinary_words_are_taken_together():
    """All words get the literals and bits that they get when they are looked up one by one."""
    rng = np.random.default_rng(3)
    ends = ["", "", "", ".", ",", '."', "')", "(", "“", "...", "!?", "*"]
    words = ["Tom", "tom", "TOM", "km", "KM", "a", "In", "Seventeen", "twenty-one", "twenty-x", "it's", "5", "$5.00", "1/2", "A1", "-", "Über", "ÜBER", "K", "²", "İx"]
    words += ["".join(rng.choice(list("abXY"), rng.integers(1, 9))) for _ in range(300)] + ["ab" * 50_000, "AB" * 50_000]
    cases = [w for x in words for w in (rng.choice(ends) + x + rng.choice(ends) for _ in range(4))] + ends[3:]
    known, alone = decontam.Canon(), decontam.Canon()
    got = decontam.Words(b"\n" + " \x0b\n".join(cases).encode() + b"\n", known)
    assert [got.raw(i).decode() for i in range(len(got.starts))] == cases
    hashes, bits = alone.look([w.encode() for w in cases])
    assert got.hashes.tolist() == hashes.tolist() and got.bits.tolist() == bits.tolist()
    literals = [got.literal(i) for i in range(len(cases))]
    assert len(set(literals)) == len(set(zip(literals, hashes.tolist(), strict=True))) == len(set(hashes.tolist()))
    assert len(known) < len(alone) / 3


def test_ordinary_words_are_not_learned_one_by_one():
    plain = " ".join(map("".join, np.random.default_rng(3).choice(list("abcdefgh"), (5000, 9)))).encode()
    finder = decontam.Templates(decontam.WIDTH, None)
    assert finder.find([plain])[0]["n"] == [4993] * 3 and len(finder.known) < 100
