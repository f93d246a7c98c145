"""Phrases, conversation repair and byte-pair encoding against brute force; names and ties that operators must bear."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe_codec, collocations, conversation_repair, decontaminate, knn_quality, line_crf, minhash, piece_codec, suffix_dedup, token_counts, tool_calls, url_rules

ODD = "doc_id bigint, text string, `a.b` string, `a b` int, `a-b` string, row string, ref string, __ref string, __dropped string, block string, lang string, id string"


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randrange(1, 5))) for _ in range(40)]
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", "", ".", ",\n", "; "]) for _ in range(n))
    base = prose(200)
    made = [None, "", " \t\n", "...", base, base, base.upper(), prose(300), prose(9000), "x" * 3000, "ab ab ab ab " * 60, "日本語 日本語。Στ ΣΑΣ <|endoftext|> it's 12345 \x1c ﬁ é", "new york city " * 12 + "new york " * 12]
    rows = [(i, t, f"k{i}", i, "-", "r", "f", "own", "d", "b", [None, "en", "de"][i % 3], "x") for i, t in enumerate(made)]
    return spark.createDataFrame([*rows, rows[4], (None, base, None, None, None, None, None, None, None, None, None, None)], ODD)


def plain_phrases(rows, longest=3, least=10):
    n, f = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                f.update((lang or "und", tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    out = {}
    often = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    for (lang, w), a in often.items():
        inside = any(len(v) > len(w) and lang == m and 100 * b >= 50 * a and any(v[i : i + len(w)] == w for i in range(len(v))) for (m, v), b in often.items())
        if not inside:
            cuts = [(1000000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]], n[lang]))
    return {lang: sorted(own) for lang, own in out.items()}


@pytest.mark.parametrize("longest, top", [(3, 2000), (4, 5), (2, 3)])
def test_phrases_equal_a_plain_count(spark, texts, monkeypatch, longest, top):
    monkeypatch.setattr(collocations, "BLOCK", 2000)  # many blocks
    want = plain_phrases([(r.lang, r.text) for r in texts.collect()], longest)
    got = {}
    for r in collocations.collocations(texts, longest=longest, top=top).orderBy("lang", "rank").collect():
        got.setdefault(r.lang, []).append((-r.score, -r.a, r.phrase.encode(), r.l, r.r, r.n))
    assert got == {lang: own[:top] for lang, own in want.items()} and got


def test_memory_of_phrases_is_by_the_block_and_the_bucket(spark, texts, monkeypatch):
    for name, value in (("BLOCK", 2000), ("BUCKET", 50), ("BATCH", 1000)):
        monkeypatch.setattr(collocations, name, value, raising=False)
    monkeypatch.setattr(collocations, "LARGE_ROWS", {**getattr(collocations, "LARGE_ROWS", {}), "parquet.block.size": "100"}, raising=False)
    key, written = "spark.sql.execution.arrow.maxBytesPerBatch", collocations.written
    before, groups, batches, buckets, backs = spark.conf.get(key), [], [], [], []

    def watched(frame, **options):
        batches.append(spark.conf.get(key))
        table = written(frame, **options)
        if "phrase" in table.columns:
            files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in table.inputFiles()]
            groups.append([m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)])
        elif "back" in table.columns:
            buckets.append(table.where("id is not null").select(F.explode("id").alias("id")).select(F.shiftright("id", 40)).distinct().count())
            backs.append(table.where("block is not null").count())
        return table

    monkeypatch.setattr(collocations, "written", watched)
    found = collocations.collocations(texts.repartition(1)).count()
    assert found == sum(map(len, plain_phrases([(r.lang, r.text) for r in texts.collect()]).values()))
    assert len(groups) == len(buckets) == 3 and len(groups[0]) > 3 and max(map(max, groups)) == 1  # no two blocks are held together
    assert min(buckets[0], backs[0]) > 4 == int(spark.conf.get("spark.sql.shuffle.partitions"))  # by the phrases told, whatever the session is set for
    assert set(batches) == {"1000"} and spark.conf.get(key) == before


def test_phrases_of_an_empty_table(spark, texts):
    assert collocations.collocations(texts.limit(0)).count() == 0
    assert collocations.collocations(texts.where("doc_id < 4")).count() == 0


def test_packed_columns_come_back():
    a, b = np.arange(7, dtype=np.uint64) * 2**40, np.arange(7, dtype=np.uint16)
    x, y = collocations.unpacked(collocations.packed(a, b), np.uint64, np.uint16)
    assert (x == a).all() and (y == b).all()
    assert [len(c) for c in collocations.unpacked(b"", np.uint64, np.uint16)] == [0, 0]


PATTERN = re.compile(r"(s?(ua)+)?")


def plain_repair(rows):
    """Every audit of bounded length: the cheapest, then the ASCII-least; with the repaired rows. rows: (role, text, fault)."""
    best = None
    options = [("D",) if fault in ("blank", "duplicate") else ("D", "Ku", "Ra", "Ru") for _, _, fault in rows]
    for edits in itertools.product(*options):
        for gaps in itertools.product(range(3), repeat=len(rows) + 1):
            if sum(gaps) > 4:
                continue
            for inserted in itertools.product("ua", repeat=sum(gaps)):
                cost, audit, roles, lines, at = 0, "", "", [], 0
                for i in range(len(rows) + 1):
                    for _ in range(gaps[i]):
                        who = inserted[at]
                        at += 1
                        cost, audit, roles = cost + 5, audit + "I", roles + who
                        lines.append({"u": "user:", "a": "assistant:"}[who])
                    if i < len(rows):
                        role, text, fault = rows[i]
                        e = edits[i]
                        cost += {"D": 2, "K": 0, "R": 1}[e[0]] + (5 if fault == "truncated" and e != "D" else 0)
                        audit += e[0]
                        if e != "D":
                            role = role if e[0] == "K" else {"u": "user", "a": "assistant"}[e[1]]
                            roles += role[:1] or "_"
                            lines.append(f"{role}:{text}")
                if PATTERN.fullmatch(roles) and (best is None or (cost, audit) < best[:2]):
                    best = cost, audit, "\n".join(lines)
    return best


def plain_faults(rows):
    """rows: (turn, role, text) of a conversation, nulls read, in order."""
    seen, out = set(), []
    for _, role, text in rows:
        signs = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not signs else "duplicate" if (role, text) in seen else None if signs[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


@pytest.fixture(scope="module")
def chats(spark):
    rng = random.Random(2)
    rows = []
    for conv in range(60):
        for _ in range(rng.randrange(1, 4)):
            rows.append((conv, rng.choice([0, 1, 2, 3, 2**60 + 1, None]), rng.choice(["user", "assistant", "system", "tool", "", None]), rng.choice(["a.", "b", "é!", " \n", None, "c? \n", "a."]), "x"))
    rows += [(None, t, r, "hi.", "x") for t, r in [(None, "user"), (2, "assistant"), (2, "assistant")]] + [(100, None, "system", "only.", "x")]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, `a.b` string")


@pytest.mark.parametrize("most", [1 << 14, 1])
def test_repair_equals_every_audit(spark, chats, most):
    """With `most` 1 every conversation of two rows is a giant one, spilled in parts of a row."""
    repaired = conversation_repair.repair(chats, most_rows=most)
    got = {r.conv_id: r for r in conversation_repair.digest(chats, repaired).collect()}
    groups = {}
    for r in chats.collect():
        groups.setdefault(r.conv_id, []).append((r.turn, r.role if r.role is not None else " ", r.text if r.text is not None else " "))
    assert set(got) == set(groups)
    for conv, rows in groups.items():
        rows.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        judged, r = plain_faults(rows), got[conv]
        cost, audit, text = plain_repair(judged)
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        count = Counter(f for _, _, f in judged)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:], strict=False))
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal) == (gaps, count["blank"], count["duplicate"], count["truncated"], illegal)
        assert (r["cost"], r.audit, r.repaired_sha256) == (cost, audit, hashlib.sha256(text.encode()).hexdigest()), rows


def test_repair_of_long_and_empty_conversations(spark, chats):
    long = spark.range(5000).select(F.lit(1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), F.col("id") % 4000, F.lit(".")).alias("text"))
    small = conversation_repair.digest(long, conversation_repair.repair(long)).first()
    spilt = conversation_repair.digest(long, conversation_repair.repair(long, most_rows=64)).first()
    assert small == spilt and len(small.audit) >= 5000
    none = conversation_repair.digest(chats, conversation_repair.repair(chats.limit(0))).where("conv_id = 100").first()
    assert tuple(none)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert conversation_repair.digest(chats.limit(0), conversation_repair.repair(chats.limit(0))).count() == 0
    damaged = conversation_repair.damage(chats.select("conv_id", "turn", "role", "text"))
    assert {r.conv_id for r in damaged.collect()} == {r.conv_id for r in chats.collect()}


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe_codec.model_path(bpe_codec.MODEL))


def test_encoding_equals_the_library(spark, texts, library):
    rng = random.Random(6)
    signs = ["abcdefghijklmnopqrstuvwxyz", "aab", "the of and in ", "éèàüß ıİΣσς", "'s't re ve", "abc 12 .,!?\n\t\x1c\x85\xa0", "日本語 ひらがな ́̂", "x", "<|endoftext|><|startoftext|>A"]
    more = ["".join(rng.choice(own) for _ in range(rng.randrange(60))) for own in signs for _ in range(150)]
    more += ["a<|endoftext|>b <|startoftext|>", " <|ENDOFTEXT|>", "thein" * 4000, "word, " * 60_000, "y" * 300_000]
    encoder = bpe_codec.Encoder(bpe_codec.Vocabulary(bpe_codec.model_path(bpe_codec.MODEL)), remember=50)
    ids, sizes = encoder.encode(more)
    want = [e.ids for e in library.encode_batch(more, add_special_tokens=False)]
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want
    assert 0 < encoder.failed < encoder.proposed, "some words are speculated, some merged exactly"
    words = ["abcabcab", "z", "thethe", "aaaaaaa", "b" * 63]
    together, owner = encoder.merged_together([w.encode() for w in words])
    for i, w in enumerate(words):
        assert encoder.merged(w.encode()) == together[owner == i].tolist() == library.encode(w, add_special_tokens=False).ids
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe_codec.digest(texts).collect()}
    for r in texts.collect():
        own = library.encode(r.text or "", add_special_tokens=False).ids
        spelt = library.decode(own, skip_special_tokens=False)
        assert (r.doc_id, len(own), hashlib.sha256(" ".join(map(str, own)).encode()).hexdigest(), hashlib.sha256(spelt.encode()).hexdigest()) in got
    coded = bpe_codec.decode(bpe_codec.encode(texts))
    assert coded.columns == [*texts.columns, "input_ids", "decoded"]
    for r in coded.collect():
        assert r.input_ids == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.decoded == library.decode(r.input_ids, skip_special_tokens=False)
    assert bpe_codec.digest(texts.limit(0)).count() == 0
    assert [r.decoded for r in bpe_codec.decode(spark.createDataFrame([(None,), ([],), ([320, None, -1, 10**6],)], "input_ids array<int>")).collect()][:2] == [None, ""]


def test_operators_bear_any_column_name(spark, texts):
    """Columns called `a.b`, `a b`, `a-b`, or as operators call theirs, come back as they were."""
    extra = [c for c in texts.columns if c not in ("doc_id", "text")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id bigint, quality int")
    model = line_crf.train(texts, labels)
    items = spark.createDataFrame([("i", "abc abd abe abf abg abh abi abj abk abl")], "item_id string, text string")
    url = texts.withColumn("url", F.lit("http://example.org/x"))
    made = [
        line_crf.keep_content(texts, model), minhash.keep_one(texts), minhash.keep_one_row(texts), suffix_dedup.without_repeats(texts), decontaminate.decontaminate(texts, items),
        piece_codec.encode(texts), piece_codec.decode(piece_codec.encode(texts)), piece_codec.recode(texts), url_rules.judge(url, url_rules.rules_table(spark, [("allow", "org", "/")]), row_id="doc_id"),
    ]
    whole = {tuple(r) for r in texts.select(*(f"`{c}`" for c in extra)).collect()}
    for frame in made:
        rows = frame.select(*(F.col(f"`{c}`") for c in extra)).collect()
        assert {tuple(r) for r in rows} <= whole
    assert line_crf.label_lines(texts, model).count() > 0 and token_counts.count_tokens(texts).count() == texts.count()


def test_tied_neighbours_vote_in_their_order():
    """Of neighbours as similar as the last one that counts, the earlier ones in the sample count; a text's block is no matter."""
    rng = np.random.default_rng(1)
    base = rng.normal(size=(1, 8))
    vectors = np.concatenate((rng.normal(size=(30, 8)) * 0.01 - base, np.repeat(base, 30, 0)))
    vectors = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
    labels = np.array([0] * 30 + [1] * 5 + [0] * 25, np.float32)
    space = knn_quality.Space({b"t": 0}, base.astype(np.float32), vectors, labels)
    alone = space.score([{b"t": 1.0}], 10, 8.0)
    assert alone == pytest.approx([0.5]), "the first ten of thirty equals: five of each label"
    for n in (2, 37, 256, 300):
        assert (space.score([{b"t": 1.0}] * n, 10, 8.0) == alone[0]).all()


def test_a_chain_of_calls_takes_few_jobs(spark):
    """1,000 calls of two dependencies each, and a conversation too long for a task, ordered by joins."""
    n = 1000
    call = lambda i: F.concat(F.lit("c"), i.cast("string"))
    i = F.col("id")
    calls = spark.range(n).select(F.lit("v").alias("conv_id"), call(i).alias("call_id"), F.when(i == 0, F.array().cast("array<string>")).when(i == 1, F.array(call(i - 1))).otherwise(F.array(call(i - 1), call(i - 2))).alias("depends_on"))
    context, group = spark.sparkContext, "levels"
    context.setJobGroup(group, group)
    try:
        got = {r.call_id: (r.level, r.n_known) for r in tool_calls.levels(calls).collect()}
        jobs = len(context.statusTracker().getJobIdsForGroup(group))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert got == {f"c{k}": (k, min(k, 2)) for k in range(n)} and jobs < 40
    few = calls.where("id < 12") if "id" in calls.columns else calls.where(F.expr("cast(substr(call_id, 2) as int) < 12"))
    by_joins = {r.call_id: (r.level, r.n_known) for r in tool_calls.levels(few, most=5).collect()}
    assert by_joins == {f"c{k}": (k, min(k, 2)) for k in range(12)}


def test_many_items_are_met_in_shards(spark, monkeypatch):
    """Three shards and more: one read of the documents in the plan, the same hits as one automaton's, a hot shard in several tasks."""
    rng = random.Random(13)
    word = lambda: f"w{rng.randrange(60)}"
    items = spark.createDataFrame([(i if i % 5 else None, " ".join(word() for _ in range(rng.choice([0, 1, 4, 12, 40])))) for i in range(60)], "item_id int, text string")
    parts = [r.text for r in items.collect() if r.text]
    docs = spark.createDataFrame([(i, " ".join([*(word() for _ in range(rng.randrange(30))), rng.choice(parts), "zz", rng.choice(parts)]) if i % 3 else None if i % 2 else "far away " * 9, str(i)) for i in range(200)], "doc_id int, text string, `a.b` string")
    docs = docs.unionByName(docs.where("doc_id < 20"))
    monkeypatch.setattr(decontaminate, "SHARE", 7)
    want = decontaminate.hit_digest(decontaminate.find_hits(docs, items))
    found = decontaminate.find_hits(docs, items, max_shard_words=150)
    assert sorted(map(tuple, decontaminate.hit_digest(found).collect())) == sorted(map(tuple, want.collect()))
    assert want.where("contaminated").count() > 100
    scans = lambda frame: frame._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD")
    assert scans(found) == scans(docs), "documents are read once beside the hits"
    one, many = (decontaminate.decontaminate(docs, items, max_shard_words=n) for n in (100_000, 150))
    assert sorted(map(repr, one.collect())) == sorted(map(repr, many.collect()))
    assert decontaminate.find_hits(docs.limit(0), items, max_shard_words=150).count() == 0


def test_a_page_without_an_id_and_page_minus_one_are_two(spark):
    from tidemark.llm import warc

    pages = spark.createDataFrame([(-1, "http://a.org/", "minus"), (None, "http://a.org/", "none"), (None, None, None), (3, "http://a.org/", "y" * 1000), (-1, "http://b.org/", "y" * 1000)], "page_id bigint, url string, html string")
    archive = warc.write(pages)
    out = warc.read(archive, warc.lookup(archive, warc.wanted_of(pages))).select("page_id", "payload_bytes", "record_type", "refers_to").collect()
    assert sorted(map(repr, map(tuple, out))) == sorted(map(repr, [(-1, 5, "response", None), (None, 4, "response", None), (None, 0, "response", None), (3, 1000, "response", None), (-1, 1000, "revisit", 3)]))
