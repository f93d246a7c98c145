"""The operators on document texts, against brute-force versions and on odd input."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, hashing, knn_quality, line_crf, minhash, piece_codec, suffix_dedup, token_counts, unigram

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, t string, node string, starts string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties and repeated rows, and extra columns whose names operators use inside."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randrange(1, 9))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = prose(120)
    near = base.split()
    near[60] = "changed"
    texts = [None, "", " \n\t ", "one", "One  two\nthree", base, base, " ".join(near), prose(20_000), "x" * 3000, "a b " * 400, "日本語 ▁ 🎉\r\n", base[:500] + prose(80), "$$$ ### " * 60, "the line stays\n" * 40]
    rows = [(i, t, None if i % 3 else "en", None, None, "r", "t", None, "s") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[5], rows[8], (None, base, None, None, None, None, None, None, None)], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def texts_of(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_base_counts_equal_a_plain_count(odd):
    for _, text in texts_of(odd):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = list(zip(words, words[1:], words[2:], strict=False))
        often = {w for w, n in Counter(windows).items() if n > 1}
        marked = {j for i, w in enumerate(windows) if w in often for j in (i, i + 1, i + 2)}
        want = len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), sum(x in lines[:i] for i, x in enumerate(lines)), len(marked)
        assert line_crf.base_counts(text) == want


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(0)
    model = line_crf.LineCrf(rng.normal(size=(2, len(line_crf.FEATURES))), rng.normal(size=(2, 2)), rng.normal(size=2))
    lengths = np.array([3, 0, 1, 7, 5, 7])
    features = rng.normal(size=(lengths.sum(), len(line_crf.FEATURES)))
    got, at = model.viterbi(features, lengths), 0
    for n in lengths:
        score = features[at : at + n] @ model.emission.T
        paths = [[(c >> i) & 1 for i in range(n)] for c in range(2**n)]
        value = lambda p: sum(score[i, y] for i, y in enumerate(p)) + sum(model.transition[a, b] for a, b in zip(p, p[1:], strict=False)) + (model.start[p[0]] if p else 0)  # noqa: B023, E731
        assert max(paths, key=value) == got[at : at + n].tolist()
        at += n


def test_crf_gradient_equals_differences():
    rng = np.random.default_rng(1)
    model = line_crf.LineCrf(rng.normal(size=(2, 3)), rng.normal(size=(2, 2)), rng.normal(size=2))
    features, gold = rng.normal(size=(6, 3)), np.array([0, 1, 1, 0, 0, 1])
    at, mask = np.array([[0, 1, 2, 3], [4, 5, 5, 5]]), np.array([[1, 1, 1, 1], [1, 1, 0, 0]], bool)
    _, grads = model.gradients(features, at, mask, gold)
    for p, g in zip((model.emission, model.transition, model.start), grads, strict=True):
        for i in np.ndindex(p.shape):
            p[i] += 1e-5
            up = model.gradients(features, at, mask, gold)[0]
            p[i] -= 2e-5
            down = model.gradients(features, at, mask, gold)[0]
            p[i] += 1e-5
            assert abs((up - down) / 2e-5 - g[i]) < 1e-5


def test_quality_rules_on_odd_input(spark, odd, none):
    labels = spark.createDataFrame([(5, 1), (13, 0), (99, 1), (None, 0), (7, None)], "doc_id bigint, quality int")
    for model in (line_crf.train(odd, labels), line_crf.train(none, labels), line_crf.train(odd, labels.limit(0))):
        out = line_crf.judge(odd, model)
        assert out.count() == odd.count()
        assert {r.doc_id for r in out.where("base_failed").collect()} >= {0, 1, 2, 3, 4, 10}
        assert out.where("kept and base_failed").count() == 0
        kept = line_crf.keep_content(odd, model)
        assert kept.columns == odd.columns and kept.where("doc_id = 5").count() == 2
        assert line_crf.judge(none, model).count() == 0 == line_crf.label_lines(none, model).count()
    assert line_crf.label_lines(odd, line_crf.LineCrf()).where("doc_id = 13 and boilerplate").count() == 1


def plain_verdict(text, model, min_share=0.7):
    """kept, by a plain count, a plain Viterbi over each document alone, and the share of words in content lines."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = list(zip(words, words[1:], words[2:], strict=False))
    often = {w for w, n in Counter(windows).items() if n > 1}
    marked = {j for i, w in enumerate(windows) if w in often for j in (i, i + 1, i + 2)}
    failed = len(words) < 50 or 100 * len(marked) > 50 * len(words)
    features, sizes, _ = line_crf.line_features(text)
    paths = {0: (0.0, []), 1: (0.0, [])}
    for n, f in enumerate(features):
        score = {y: sum(a * b for a, b in zip(model.emission[y], f, strict=True)) for y in (0, 1)}
        if not n:
            paths = {y: (model.start[y] + score[y], [y]) for y in (0, 1)}
        else:
            paths = {y: max(((paths[x][0] + model.transition[x][y] + score[y], -x), [*paths[x][1], y]) for x in (0, 1)) for y in (0, 1)}
            paths = {y: (v[0], p) for y, (v, p) in paths.items()}
    best = paths[1] if paths[1][0] > paths[0][0] else paths[0]
    content = sum(s for s, y in zip(sizes, best[1], strict=True) if y == 0)
    return failed, not failed and content >= min_share * len(words) - 1e-9


def test_kept_equals_a_plain_verdict(spark, odd):
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = line_crf.train(docs, labels)
    rows = [r.text for r in docs.collect()] + [t for _, t in texts_of(odd)]
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    got = {r.doc_id: (r.base_failed, r.kept) for r in line_crf.judge(frame, model).collect()}
    assert got == {i: plain_verdict(t, model) for i, t in enumerate(rows)}
    assert {k for _, k in got.values()} == {True, False}


def test_quality_rules_keep_good_and_drop_poor(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = line_crf.judge(docs, line_crf.train(docs, labels)).where("not base_failed").join(labels, "doc_id").collect()
    assert np.mean([r.kept == bool(r.quality) for r in out]) > 0.97


def test_classifier(spark, odd, none):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    space = knn_quality.train(docs, labels, learnable=F.col("doc_id") % 4 != 0)
    held = knn_quality.classify(docs, space).join(labels, "doc_id").where("doc_id % 4 = 0").collect()
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    out = knn_quality.classify(odd, space).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 for r in out)
    empty = {r.score for r in out if r.doc_id in (0, 1, 2)}
    assert len(empty) == 1 and abs(empty.pop() - space.labels.mean()) < 1e-6
    assert knn_quality.classify(none, space).count() == 0
    untaught = knn_quality.train(odd, labels.limit(0))
    assert {r.score for r in knn_quality.classify(odd, untaught).collect()} == {0.5}


def test_votes_equal_a_plain_vote(spark, odd):
    """Scores against a neighbour search by single products, over texts of every kind."""
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    space = knn_quality.train(docs, labels)
    reader, k, sharpness = knn_quality.Terms(), 15, 8.0
    rows = [(r.doc_id, r.text) for r in docs.collect()] + texts_of(odd)
    frame = spark.createDataFrame(list(enumerate(t for _, t in rows)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in knn_quality.classify(frame, space, k=k, sharpness=sharpness).collect()}
    assert len(got) == len(rows)
    for i, (_, text) in enumerate(rows):
        own = np.zeros(space.to_space.shape[1])
        for term, weight in reader.weights(text).items():
            if term in space.terms:
                own = own + weight * space.to_space[space.terms[term]].astype(float)
        size = float(np.sqrt((own * own).sum()))
        near = sorted(((float(sum(own * v)) / size if size else 0.0, float(y)) for v, y in zip(space.vectors.astype(float), space.labels, strict=True)), reverse=True)[:k]
        weights = [max(c, 0) ** sharpness for c, _ in near]
        want = sum(w * y for w, (_, y) in zip(weights, near, strict=True)) / sum(weights) if sum(weights) > 1e-6 else float(space.labels.mean())
        assert abs(got[i].score - want) < 2e-3, (i, got[i].score, want)
        assert got[i].predicted == int(got[i].score >= 0.3)


def test_classifier_reads_long_words_whole():
    """What follows the first 64 bytes of a word, and the first 16 signs of its shape, changes its terms."""
    reader = knn_quality.Terms()
    start = "aB3" * 22
    for tail in ("", "-x-1-", "日本語、9" * 50, "aB3" * 900 + "$"):
        whole = knn_quality._RUNS.sub(rb"\1", (start + tail).encode().translate(knn_quality._SHAPE))
        stretches = Counter(whole[i : i + 16] for i in range(0, len(whole), 16))
        terms = reader.weights(start + tail)
        assert {t: w for t, w in terms.items() if b" " not in t and t[:1] != b"\n"} == {t: np.log1p(100 * c / stretches.total()) for t, c in stretches.items()}
    assert reader.weights(start + "-x-") != reader.weights(start + "$$1")
    assert reader.weights("a.b.c.d.e.f.g.h.1") != reader.weights("a.b.c.d.e.f.g.h.X")


def brute_hits(text, items, window=10):
    words = decontaminate.words_of(text)
    hit, found = set(), set()
    for name, item in items:
        own = decontaminate.words_of(item)
        k = min(window, len(own))
        patterns = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if k else set()
        for i in range(len(words) - k + 1) if k else ():
            if tuple(words[i : i + k]) in patterns:
                hit |= set(range(i, i + k))
                found.add(name)
    return len(words), len(hit), sorted(found)


def test_hits_equal_brute_force():
    rng = random.Random(2)
    for _ in range(150):
        word = lambda: rng.choice("abc")
        items = [(str(i), " ".join(word() for _ in range(rng.randrange(0, 9)))) for i in range(rng.randrange(1, 6))]
        matcher = decontaminate.ItemAutomaton([(n, decontaminate.words_of(t)) for n, t in items], window=4)
        for _ in range(4):
            text = " ".join(word() if rng.random() > 0.1 else "zz" for _ in range(rng.randrange(0, 40)))
            spans, found = matcher.read(decontaminate.words_of(text))
            got = len(decontaminate.words_of(text)), sum(b - a for a, b in spans), sorted(matcher.names[i] for i in found)
            assert got == brute_hits(text, items, 4)


def test_decontamination(spark, odd, none):
    rng = random.Random(4)
    passage = " ".join(f"q{rng.randrange(99)}" for _ in range(25))
    items = [(1, passage), (2, "tiny item"), (3, None), (4, "!!"), (1, passage), (None, "null id")]
    bench = spark.createDataFrame(items, "item_id int, text string")
    more = spark.createDataFrame([(100, "Before, " + passage.upper() + "! after it" + " more" * 20), (101, "a TINY item, here" + " word" * 20), (102, passage)], "doc_id bigint, text string")
    docs = odd.unionByName(more, allowMissingColumns=True)
    plain = [(str(i), t) for i, t in items if i is not None]
    for most in (100_000, 20):  # one automaton, and several with overlaps
        got = {r.doc_id: r for r in decontaminate.hit_digest(decontaminate.find_hits(docs, bench, max_shard_words=most)).collect()}
        for i, text in texts_of(docs):
            n, hit, found = brute_hits(text, plain)
            ids = hashlib.sha256(",".join(found).encode()).hexdigest()
            assert (got[i].n_words, got[i].n_hit, got[i].n_items, got[i].items_sha256, got[i].contaminated) == (n, hit, len(found), ids, hit > 0)
        out = decontaminate.decontaminate(docs, bench, max_shard_words=most)
        texts = dict(texts_of(out))
        assert out.columns == docs.columns and 102 not in texts and texts[100] == "Before, \n! after it" + " more" * 20
        assert out.count() == docs.count() - 1
    assert decontaminate.find_hits(none, bench).count() == 0
    assert decontaminate.find_hits(odd, bench.limit(0)).where("size(starts) > 0").count() == 0


def test_items_without_an_id_hit_as_the_sql_says(spark, tmp_path):
    """Their passages are hit and cut; they count as one item and stay out of the digest of ids."""
    import duckdb

    from tidemark.llm.queries import ORACLES

    first, second, known = (" ".join(f"{c}{i}" for i in range(12)) for c in "xyz")
    bench = spark.createDataFrame([(None, first), (None, second), (7, known), (None, "tiny"), (8, None)], "item_id int, text string")
    texts = [f"some words {first} more words", f"{first} and {second} {'far ' * 40}", f"{known} then {second} {'far ' * 40}", f"{known} {'far ' * 40}", "a tiny text", "nothing", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    con = duckdb.connect()
    for name, frame in (("documents", docs), ("benchmark", bench)):
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    columns = "doc_id, n_words, n_hit, n_items, items_sha256, contaminated"
    want = sorted(con.execute(f"select {columns} from ({ORACLES['op3_decontamination']})").fetchall())
    for most in (100_000, 20):
        got = decontaminate.hit_digest(decontaminate.find_hits(docs, bench, max_shard_words=most))
        assert sorted(tuple(r) for r in got.select(*columns.split(", ")).collect()) == want
    assert [w[-1] for w in want] == [True, True, True, True, True, False, False]
    clean = dict(texts_of(decontaminate.decontaminate(docs, bench)))
    assert first not in clean[0] + clean[1] and second not in clean[2]


def brute_removed(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out.append((len(d), sum(gone), len(re.findall(b"\1+", gone)), hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_dedup_equals_brute_force(spark, odd, none):
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    base = [text(rng.randrange(30, 400)) for _ in range(12)]
    made = []
    for i in range(80):
        parts = []
        for _ in range(rng.randrange(5)):
            b = rng.choice(base)
            at = rng.randrange(len(b))
            parts.append(text(rng.randrange(120)) if rng.random() < 0.4 else b[at : at + rng.randrange(200)])
        made.append((1000 + i, "".join(parts)))
    docs = odd.unionByName(spark.createDataFrame(made, "doc_id bigint, text string"), allowMissingColumns=True)  # a text of 20,000 words, twice, is among them
    rows = texts_of(docs)
    for length in (40, 90, 400):
        want = Counter(zip([i for i, _ in rows], brute_removed([t for _, t in rows], length), strict=True))
        got = Counter((r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in suffix_dedup.repeats(docs, length=length).collect())
        assert got == want
    clean = suffix_dedup.without_repeats(odd)
    assert clean.columns == odd.columns
    assert suffix_dedup.repeats(none).count() == 0


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 300)
    rng = random.Random(9)
    data = bytes(rng.choice(b"abcd") for _ in range(4000))
    runs = np.concatenate([suffix_dedup._runs(b, 60, 40) for b in suffix_dedup._pieces([((7, 8), data)], 60)])
    covered = sorted(x for r in runs for x in range(r["at"], r["at"] + r["n"]))
    assert covered == list(range(len(data) - 59))
    windows = np.concatenate(list(suffix_dedup._windows(data, (7, 8), runs["at"].astype(int), runs["n"].astype(int), 60)))
    assert sorted(windows["at"].tolist()) == covered


def brute_passages(texts, length, words):
    """Texts without the strings of `length` bytes and of `words` words that start anywhere else too."""
    data = [(t or "").encode() for t in texts]
    places = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", d)] for d in data]
    own = [[d[a:b] for a, b in p] for d, p in zip(data, places, strict=True)]
    bytes_seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    words_seen = Counter(tuple(w[i : i + words]) for w in own for i in range(len(w) - words + 1))
    out = []
    for d, p, w in zip(data, places, own, strict=True):
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if bytes_seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        for i in range(len(w) - words + 1):
            if words_seen[tuple(w[i : i + words])] > 1:
                a, b = p[i][0] if i else 0, p[i + words - 1][1] if i + words < len(w) else len(d)
                gone[a:b] = b"\1" * (b - a)
        out.append((any(gone), bytes(x for x, g in zip(d, gone, strict=True) if not g).decode("utf-8", "ignore")))
    return out


def test_passages_of_over_50_words_go(spark):
    """Planted passages of 51 short words, under 400 bytes, with other blanks between them; those of 50 words stay."""
    rng = random.Random(12)
    prose = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(n))
    caught, short, wide = prose(51), prose(50), "é".join(prose(1) for _ in range(120))
    assert len(caught) < 400 < len(wide.encode())
    texts = [f"{prose(30)} {caught} {prose(40)}", f"{prose(9)}\n{caught.replace(' ', '  ')}\n{prose(70)}", f"{prose(30)} {short} {prose(40)}", f"{short} {prose(40)}", f"{prose(60)} {wide} x", f"{wide} {prose(60)}", f" {caught}\n", prose(300), "", None]
    base = [prose(rng.randrange(20, 120)) for _ in range(8)]
    for _ in range(60):
        texts.append(rng.choice(" \n").join(" ".join(rng.choice(base).split()[rng.randrange(20) :][: rng.randrange(90)]) if rng.random() < 0.5 else prose(rng.randrange(60)) for _ in range(4)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in suffix_dedup.without_repeats(docs).collect()}
    want = {i: t for i, (gone, t) in enumerate(brute_passages(texts, suffix_dedup.LENGTH, 51)) if not gone or t}
    assert {i: t or "" for i, t in got.items()} == want
    assert caught not in got[0] and short in got[2] and wide not in got[4] and 6 not in got and got[7] == texts[7]


def test_multikey_quicksort():
    rng = np.random.default_rng(0)
    for _ in range(200):
        keys = rng.integers(0, rng.integers(1, 9), (rng.integers(0, 60), 3)).astype(np.uint64)
        assert keys[suffix_dedup.multikey_quicksort(keys)].tolist() == sorted(keys.tolist())
    keys = np.zeros((5000, 4), np.uint64)
    keys[:, 3] = rng.integers(0, 1 << 63, 5000)
    assert keys[suffix_dedup.multikey_quicksort(keys)].tolist() == sorted(keys.tolist())


def brute_groups(rows, k, percent):
    sets = []
    for _, t in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(hashing_lower))
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set())
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                group[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return [(d, len(s), least.get(top(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


hashing_lower = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def test_near_duplicates_equal_brute_force(spark, odd, none, monkeypatch):
    rng = random.Random(8)
    word = lambda: rng.choice("abcdefgh") + rng.choice("aeiou") * rng.randrange(1, 4)
    made = []
    for f in range(3):
        base = [word() for _ in range(90)]
        for c in range(30):
            own = list(base)
            for _ in range(rng.randrange(0, 5 + f)):
                own[rng.randrange(90)] = word()
            made.append((1000 + 100 * f + c, " ".join(own[: rng.randrange(78, 91)])))
    docs = odd.unionByName(spark.createDataFrame(made, "doc_id bigint, text string"), allowMissingColumns=True)
    monkeypatch.setattr(minhash, "CHUNK", 7)
    want = Counter(brute_groups(texts_of(docs), 4, 80))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, k=4).collect()) == want
    kept = minhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.where("doc_id in (0, 1, 2, 5, 6, 7, 8)").collect()) == [0, 1, 2, 5, 5, 8, 8]
    assert minhash.near_duplicates(none).count() == 0


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(40):
        a = rng.integers(0, 2**63, 200).astype(np.uint64)
        b = np.concatenate((a[:160], rng.integers(0, 2**63, 40).astype(np.uint64)))
        s = minhash.signatures(np.concatenate((a, b)), np.array([200, 200]))
        errors.append((s[0] == s[1]).mean() - 160 / 240)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05
    tiny = minhash.signatures(np.array([5], np.uint64), np.array([1]))
    assert sorted((tiny[0] >> np.uint64(32)).tolist()) == list(range(minhash.SLOTS))  # one element: each rank once


def test_hashes_depend_on_content_alone():
    one, n = hashing.word_hashes([b"a bb  ccc", b"", b"bb\tccc"])
    assert n.tolist() == [3, 0, 2] and one[1:3].tolist() == one[3:].tolist()
    assert hashing.shingles([b"a b a b a b", b"a", b""], 2)[1].tolist() == [2, 1, 0]


@pytest.fixture(scope="module")
def pieces():
    return unigram.Pieces(piece_codec.MODEL)


def plain_segmentation(pieces, known, word):
    """One word's best pieces by a plain table."""
    best = [(0, None)] + [(None, None)] * len(word)
    for t in range(1, len(word) + 1):
        for n in range(min(pieces.longest, t), 0, -1):
            piece = word[t - n : t]
            step = None if unigram.SPACE in piece else known.get(piece)
            if step is None and n == 1:
                step = (pieces.fallback - len(piece.encode()), -1)
            if step and (best[t][0] is None or best[t - n][0] + step[0] > best[t][0]):
                best[t] = (best[t - n][0] + step[0], (n, step[1]))
    out, t = [], len(word)
    while t:
        n, i = best[t][1]
        out = ([i] if i >= 0 else [pieces.byte_id[b] for b in word[t - 1].encode()]) + out
        t -= n
    return out


def test_segmentation_counts_and_round_trip(spark, odd, none, pieces):
    rng = random.Random(6)
    bare = "".join(rng.choice("abcdeno éß日本語の▁🎉.,/-_0123".replace(" ", "")) for _ in range(5000))
    more = spark.createDataFrame([(50, bare), (51, f"{bare[:700]} {bare[:900]} x"), (52, "the" * 2000)], "doc_id bigint, text string")  # words of thousands of characters
    odd = odd.unionByName(more, allowMissingColumns=True)
    coded = piece_codec.encode(odd)
    assert coded.columns == [*odd.columns, "input_ids"]
    memo = {}
    known = {pieces.bytes[i].decode(): (int(s), int(i)) for i, s in zip(pieces.ids, pieces.scores, strict=True)}
    for r in coded.collect():
        want = [i for w in unigram.pre_tokens(r.text) for i in (memo[w] if w in memo else memo.setdefault(w, plain_segmentation(pieces, known, w)))]
        assert r.input_ids == want
    assert piece_codec.decode(piece_codec.encode(odd)).where("coalesce(text, '') <> decoded").count() == 0
    both = piece_codec.recode(odd, decoded="back")
    assert both.columns == [*odd.columns, "input_ids", "back"] and both.where("coalesce(text, '') <> back").count() == 0
    assert sorted(map(str, (r.input_ids for r in both.collect()))) == sorted(map(str, (r.input_ids for r in coded.collect())))
    counts = token_counts.count_tokens(odd).join(piece_codec.digest(odd).withColumnRenamed("n_tokens", "n"), "doc_id")
    assert counts.where("n_tokens <> n or not round_trip").count() == 0
    assert token_counts.count_tokens(odd).where("doc_id in (0, 1) and n_tokens <> 0").count() == 0
    assert piece_codec.digest(none).count() == 0 == token_counts.count_tokens(none).count()
